from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from placeweave.constants import SURVEY_TERMS
from placeweave.sources import documents, features

CONFIG = {
    "key": "XX", "state_code": "UT", "address_parts": ["no", "dir", "street"], "name_upper_to_title": True, "skip_generic_names": True, "state_name_field": "st",
    "field_map": {"name": ["n1", "n2"], "city": ["city"], "county": ["county"], "state_record_id": ["id"], "nris_refnum": ["ref"], "date_listed": ["listed"], "date_constructed": ["built"]},
    "where": "coalesce(attributes['keep'], 'y') <> 'n'",
}


@pytest.fixture()
def landed(spark, tmp_path):
    rows = [
        {"attributes": {"n1": " ", "n2": "GRAND MILL", "no": 67, "dir": "E", "street": "SOUTH TEMPLE", "city": "Town", "id": 5, "listed": 1030683600000, "st": "Nevada"}, "geometry": {"x": -111.0, "y": 40.5}},
        {"attributes": {"n1": "Many Points", "listed": "May 1990"}, "geometry": {"points": [[-110.0, 41.0], [0, 0]]}},
        {"attributes": {"n1": "A Ring"}, "geometry": {"rings": [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]]]}},
        {"attributes": {"n1": "Barn - old"}, "geometry": {"x": -111.0, "y": 40.5}},
        {"attributes": {"n1": ""}, "geometry": {"x": 1, "y": 1}},
        {"attributes": {"n1": "No place"}, "geometry": None},
        {"attributes": {"n1": "Dropped", "keep": "n"}, "geometry": {"x": 1, "y": 1}},
    ]
    path = tmp_path / "features.json"
    path.write_text(json.dumps(rows))
    return features.read_features(spark, str(path))


def test_parse_source(landed):
    got = {r["name"]: r for r in features.parse_source(landed, CONFIG, SURVEY_TERMS).collect()}
    assert set(got) == {"Grand Mill", "Many Points", "A Ring"}
    mill = got["Grand Mill"]
    assert (mill["address"], mill["state"], mill["state_designation_date"], mill["state_record_id"]) == ("67 E SOUTH TEMPLE", "NV", "2002-08-30", "5")
    assert (got["Many Points"]["longitude"], got["Many Points"]["state_designation_date"], got["Many Points"]["state"]) == (-110.0, "May 1990", "UT")
    assert (got["A Ring"]["longitude"], got["A Ring"]["latitude"]) == (2.0, 1.0)
    assert mill["primary_source"] == "shpo_XX" and mill["source_shpo"] is True


def test_federal_and_collection(spark, tmp_path):
    row = {"attributes": {"ResName": "Fort", "RefNum": "66000001", "CertDate": -307929600000, "State": "PA"}, "geometry": {"x": -75.0, "y": 40.0}}
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"features": [row, {"attributes": {"ResName": ""}, "geometry": {"x": 1, "y": 2}}, {"attributes": {"ResName": "x"}, "geometry": {}}], "exceededTransferLimit": False}))
    got = features.parse_federal(features.read_collection(spark, str(path))).collect()
    assert [(r["name"], r["nrhp_cert_date"], r["latitude"]) for r in got] == [("Fort", "1960-03-30", 40.0)]
    both = features.union_sources([features.parse_federal(features.read_collection(spark, str(path))), spark.createDataFrame([("y",)], "name string")])
    assert both.count() == 2


def test_area_centroid(spark):
    ring = F.lit(None).cast("array<array<double>>")
    square = F.array(*[F.array(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))])
    row = spark.range(1).select(features.area_centroid(square).alias("a"), features.area_centroid(ring).alias("b")).first()
    assert (row["a"]["lon"], row["a"]["lat"]) == pytest.approx((1.0, 1.0)) and row["b"] is None


def test_read_list(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text('Ref#,Property Name,State,City,CritA,CritB,Military,Areas of Significance,NHL Date\n66000001.0,Fort,PA,nan,X,,Y,"Art; Law",1/2/1960\n2,Hall,OH,Akron,,yes,,"Art; Law, Nothing",\n3,,OH,,,,,,\n')
    got = documents.read_list(spark, str(path), landmark=True).orderBy("nris_refnum").collect()
    assert [(r["nris_refnum"], r["name"], r["city"], r["criteria"], r["areas"]) for r in got] == [("2", "Hall", "Akron", ["B"], ["art", "law"]), ("66000001", "Fort", None, ["A"], ["military"])]
    assert json.loads(got[0]["raw_data_json"])["State"] == "OH" and got[0]["designation_type"] == "Federal NHL"


def test_parks(spark):
    row = ("1", "abcd", "Old Fort", "Fort", "d" * 600, "u", "WY,MT,ID", "lat:39.9, long:-75.1", [({"monday": "9-5", "tuesday": "Closed", "sunday": "10-4"},)], [("0.00", "Walk"), ("35.00", "Car")])
    got = documents.parse_parks(spark.createDataFrame([row], documents.PARK)).first()
    assert (got["state"], got["latitude"], got["longitude"], got["visiting_hours"], got["admission_info"]) == ("WY", 39.9, -75.1, "Monday: 9-5; Sunday: 10-4", "Walk: Free; Car: $35.00")
    assert len(got["short_description"]) == 500 and len(got["full_description"]) == 600
    bare = ("2", None, None, "X", "short", None, "PA", "lat:, long:3", [], [])
    got = documents.parse_parks(spark.createDataFrame([bare], documents.PARK)).first()
    assert (got["name"], got["latitude"], got["longitude"], got["visiting_hours"], got["admission_info"], got["full_description"]) == ("X", None, 3.0, None, None, None)


def test_battlefields(spark, tmp_path):
    shape = lambda kind, c: {"type": kind, "coordinates": c}
    ring = [[0, 0], [3, 0], [3, 3], [0, 0]]
    rows = [("BULL RUN", "VA/WV", shape("Polygon", [ring])), ("two parts", "PA", shape("MultiPolygon", [[ring], [[[9, 9], [9, 9]]]])), ("", "PA", shape("Polygon", [ring]))]
    path = tmp_path / "b.json"
    path.write_text(json.dumps({"features": [{"properties": {"NAME": n, "STATE": s}, "geometry": g} for n, s, g in rows]}))
    got = documents.parse_battlefields(spark.read.schema(documents.GEOJSON).option("multiLine", True).json(str(path)), "civil").collect()
    assert [(r["name"], r["state"], r["latitude"], r["longitude"]) for r in got] == [("Bull Run", "VA", 0.75, 1.5), ("Two Parts", "PA", 3.5, 4.0)]


def test_pages(spark):
    listing = '<table><tr><th>h</th></tr><tr><td><a href="/Detail/N24">Old Mill</a></td><td></td><td>01/02/1970</td><td>Napa (Napa County)</td></tr><tr><td>New Mill (N25)</td><td>x</td></tr></table>'
    detail = "<div><strong>NPS Number:</strong> 66000001<br><strong>County:</strong> Napa<br><strong>Year Built:</strong> 1880</div>"
    rows = documents.listing_rows(spark.createDataFrame([(1, listing)], "page_id long, html string")).orderBy("row_no").collect()
    assert [(r["name"], r["refnum"], r["date"], r["city"], r["county"]) for r in rows] == [("Old Mill", "N24", "01/02/1970", "Napa", "Napa County"), ("New Mill", "N25", None, None, None)]
    got = documents.detail_fields(spark.createDataFrame([(1, detail)], "page_id long, html string")).first()
    assert (got["nps_number"], got["county"], got["year_built"], got["architect"]) == ("66000001", "Napa", "1880", None)


def test_replies(spark):
    lines = ['"1","a, b","Match","Exact","A","-75.1,40.2"', '"2","a","No_Match"', '"3","a","Tie","","",""', '"4","a","Non_Exact","x","A","-70,41"', '"5","a","Match","x","A","bad"']
    got = documents.geocoder_replies(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r["id"], r["lat"], r["lon"], r["quality"]) for r in got] == [("1", 40.2, -75.1, "exact"), ("4", 41.0, -70.0, "interpolated")]
    texts = ['text ```json\n[{"site_id": 1, "confidence": 0.5}]\n``` end', '[{"site_id": 2, "conf', "none", None]
    got = documents.array_replies(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "batch int, text string"), "site_id:bigint,confidence:double").collect()
    assert [(r["batch"], r["site_id"], r["confidence"]) for r in got] == [(0, 1, 0.5)]
    got = documents.object_replies(spark.createDataFrame([(1, 'x {"style": "a", "confidence": 0.2} y')], "id int, text string"), "style:string,confidence:double").collect()
    assert [(r["style"], r["method"]) for r in got] == [("a", "extraction_low_confidence")]
