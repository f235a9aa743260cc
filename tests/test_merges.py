"""Merges, runs and files on a few rows of our own."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from placeweave.operators import merges, profile, tables
from placeweave.plans import registry
from placeweave.sinks import exports
from placeweave.sources import features

DATA = "/root/testdata/sf0.001"


def test_merge_points_is_idempotent(spark):
    cols = "nris_refnum string, name string, state string, city string, latitude double, longitude double, source_arcgis boolean"
    now = spark.createDataFrame([(1, "r1", "Old", "PA", "", 40.0, -75.0, None), (2, None, "Free", "NJ", None, None, None, None)], f"site_id long, {cols}")
    new = spark.createDataFrame([(11, "r1", "New", "pennsylvania", "TOWN", None, None, True), (12, "r2", "Two", "ohio", None, 40.0, -82.0, True), (13, "r2", "Later", "OH", "ville", 1.0, 1.0, True), (14, None, "None", "zz", None, None, None, True)], f"arrival long, {cols}")
    out = merges.merge_points(now, new, "arcgis", ["source_arcgis"])
    got = {r.site_id: (r.nris_refnum, r.name, r.state, r.city, r.source_arcgis) for r in out["sites"].collect()}
    assert got == {1: ("r1", "Old", "PA", "Town", True), 2: (None, "Free", "NJ", None, None), 12: ("r2", "Two", "OH", "Ville", True), 14: (None, "None", "ZZ", None, True)}
    assert {r.arrival: (r.site_id, r.outcome) for r in out["outcomes"].collect()} == {11: (1, "updated"), 12: (12, "inserted"), 13: (12, "updated"), 14: (14, "inserted")}
    assert {(r.site_id, r.source_name, r.source_record_id) for r in out["sources"].collect()} == {(1, "arcgis", "r1"), (12, "arcgis", "r2"), (14, "arcgis", None)}
    again = merges.merge_points(out["sites"], new.where("nris_refnum is not null"), "arcgis", ["source_arcgis"])["sites"]
    assert sorted(map(str, again.collect())) == sorted(map(str, out["sites"].collect()))


def test_unchanged_records_are_skipped(spark):
    new = spark.createDataFrame([(1, "r1", "c", True), (2, "r2", "d", True)], "arrival long, nris_refnum string, city string, source_shpo boolean")
    start = spark.createDataFrame([], "site_id long, nris_refnum string, city string, source_shpo boolean, data_checksum string, updated_at string")
    once = merges.upsert_changed(start, new, ["source_shpo"], F.lit("t1"))
    changed = new.withColumn("city", F.when(F.col("nris_refnum") == "r2", "e").otherwise(F.col("city")))
    twice = merges.upsert_changed(once, changed, ["source_shpo"], F.lit("t2"))
    assert {r.nris_refnum: (r.city, r.updated_at) for r in once.collect()} == {"r1": ("c", "t1"), "r2": ("d", "t1")}
    assert {r.nris_refnum: (r.city, r.updated_at == "t2") for r in twice.collect()} == {"r1": ("c", False), "r2": ("d", True)}


def test_broken_sources_do_not_stop_the_rest(spark):
    lines = spark.createDataFrame([("a", '{"k": 1}'), ("a", "{oops"), ("b", "no json"), ("c", '{"k": 3}'), ("c", None)], "source string, value string")
    good, bad = merges.quarantined(lines, "k int")
    assert sorted((r.source, r.k) for r in good.collect()) == [("a", 1), ("c", 3)]
    assert {r.source: r.status for r in merges.source_statuses(good, bad, "source").collect()} == {"a": "partial", "b": "failed", "c": "partial"}


def test_outcomes_cover_every_record(spark):
    rows = registry.QUERIES["cascade_outcomes"](spark, DATA).collect()
    incoming = spark.read.parquet(f"{DATA}/customer.parquet").count() + spark.read.parquet(f"{DATA}/supplier.parquet").count()
    assert sum(r.n for r in rows) == incoming
    assert {r.outcome for r in rows} <= {"matched_nris", "matched_address", "matched_fuzzy", "inserted"} and any(r.outcome == "inserted" for r in rows)


def test_audit_file_columns(spark):
    found = registry.QUERIES["audit_file"](spark, DATA)
    assert found.columns == [
        "risk", "source_key", "state", "incoming_name", "incoming_city", "incoming_address", "incoming_refnum",
        "matched_name", "matched_city", "matched_address", "matched_id", "score", "distance_km", "match_type", "would_match",
    ]
    for r in found.collect():
        assert r.would_match == ("CANDIDATE" if r.match_type == "name_match" else "YES") and r.incoming_name and r.matched_name


def test_feature_collections_are_json(spark, tmp_path):
    sites = spark.createDataFrame([(k, f"n{k}", "PA", 40.0 + k, -75.0) for k in range(5)], "site_id long, name string, state string, latitude double, longitude double")
    exports.feature_collection(exports.geojson_features(sites).coalesce(2), str(tmp_path / "all"))
    read = [json.loads(p.read_text()) for p in (tmp_path / "all").glob("part-*")]
    assert sorted(f["properties"]["name"] for c in read for f in c["features"]) == [f"n{k}" for k in range(5)]


def test_centroid_of_a_polygon_with_a_hole(spark):
    outer = [[0.0, 0.0], [0.0, 4.0], [4.0, 4.0], [4.0, 0.0], [0.0, 0.0]]
    hole = [[2.0, 1.0], [4.0, 1.0], [4.0, 3.0], [2.0, 3.0], [2.0, 1.0]]
    df = spark.createDataFrame([([outer],), ([outer, hole],), ([],), (None,)], "rings array<array<array<double>>>")
    got = [r[0] for r in df.select(features.polygon_centroid(F.col("rings"))).collect()]
    assert (got[0].lon, got[0].lat) == (2.0, 2.0)
    assert round(got[1].lon, 9) == round((16 * 2 - 4 * 3) / 12, 9) and got[1].lat == 2.0
    assert got[2] is None and got[3] is None


def test_layer_states_and_plain_names(spark):
    rows = [({"N": "A​ SITE", "S": s}, (1.0, 2.0, None, None)) for s in ("Virgin Islands", "PALAU", "U.S. Virgin Islands", "ohio", None)]
    config = {"key": "nat", "state_code": "XX", "state_name_field": "S", "name_upper_to_title": True, "field_map": {"name": ["N"]}}
    df = spark.createDataFrame(rows, features.FEATURE)
    assert [r.state for r in features.parse_source(df, config).collect()] == ["VI", "PW", "XX", "OH", "XX"]
    assert {r.name for r in features.parse_source(df, config | {"adapter": "gdb"}).collect()} == {"A​ SITE"}


def test_ranks_in_parts_of_a_group(spark):
    df = spark.createDataFrame([(k * 37 % 1000, "ab"[k % 2] if k % 5 else None) for k in range(1000)], "id long, g string")
    got = tables.numbered(df, ["g"], ["id"], F.floor(F.col("id") / 10), "place").collect()
    for g in ("a", "b", None):
        ids = sorted(r.id for r in got if r.g == g)
        assert {r.id: r.place for r in got if r.g == g} == {x: k for k, x in enumerate(ids)}


def test_summary_and_runs(spark):
    one = spark.range(3).select(F.col("id").alias("site_id"))
    assert {r.what: r.n for r in profile.summary(one, one.limit(0), one).collect()} == {"total_sites": 3, "total_sources": 0, "total_designations": 3}
    log = merges.run_events(spark.createDataFrame([(1, 5)], "run_id int, n int"), F.lit("s"), F.lit(1)).withColumn("at", F.col("step"))
    assert [(r.status, r.records_processed) for r in tables.latest_runs(log).collect()] == [("completed", 5)]
