from __future__ import annotations

import math
import random
import re

from pyspark.sql import functions as F

from placeweave.operators import batches, enrich, resolve, scoring, tables
from placeweave.plans import registry
from placeweave.sinks import exports
from placeweave.streaming import incremental


def test_upsert_is_idempotent_and_folds(spark):
    now = spark.createDataFrame([("k1", "A", "", True), ("k2", None, "c", None), (None, "free", "x", None)], "ref string, name string, city string, flag boolean")
    new = spark.createDataFrame([("k1", "B", None, None, 1), ("k1", "C", "first", True, 2), ("k1", "D", "second", None, 3), ("k3", "E", "", None, 4)], "ref string, name string, city string, flag boolean, at int")
    once = tables.upsert_first_wins(now, new, "ref", "at", ["flag"])
    got = {r["ref"]: (r["name"], r["city"], r["flag"]) for r in once.collect()}
    assert got["k1"] == ("A", "first", True) and got["k2"] == (None, "c", False) and got["k3"][:2] == ("E", None) and got[None] == ("free", "x", None)
    twice = tables.upsert_first_wins(once, new, "ref", "at", ["flag"])
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_insert_or_ignore(spark):
    now = spark.createDataFrame([(1, "A", 0.5)], "site_id int, c string, conf double")
    new = spark.createDataFrame([(1, "A", 0.9, 1), (1, "B", 1.5, 2), (1, "B", 0.4, 3), (1, "B", 0.3, 4), (2, "E", 0.1, 5)], "site_id int, c string, conf double, at int")
    sound = F.col("c").isin("A", "B", "C", "D") & F.col("conf").between(0, 1)
    once = tables.insert_or_ignore(now, new, ["site_id", "c"], sound, "at")
    assert sorted(map(tuple, once.collect())) == [(1, "A", 0.5), (1, "B", 0.4)]
    assert sorted(map(tuple, tables.insert_or_ignore(once, new, ["site_id", "c"], sound, "at").collect())) == [(1, "A", 0.5), (1, "B", 0.4)]


def test_fill_and_overwrite(spark):
    rows = [(1, "", "x", "arcgis", "seen", False), (2, "", "x", "manual", "seen", False), (3, None, "x", None, None, False), (4, "", "x", "manual", None, False), (5, "", "x", None, "seen", False)]
    sites = spark.createDataFrame(rows, "site_id int, city string, url string, primary_source string, reviewer_notes string, hit boolean")
    found = spark.createDataFrame([(k, "new", "y") for k in range(1, 6)], "site_id int, city string, url string")
    filled = {r["site_id"]: (r["city"], r["url"], r["hit"]) for r in tables.fill_empty(sites, found, ["city", "url"], "hit").collect()}
    assert filled == {1: ("new", "x", True), 2: ("", "x", False), 3: (None, "x", False), 4: ("", "x", False), 5: ("", "x", False)}
    over = {r["site_id"]: (r["city"], r["url"], r["hit"]) for r in tables.overwrite_fields(sites, found, ["city", "url"], "hit").collect()}
    assert over == {1: ("new", "y", True), 2: ("", "x", False), 3: ("new", "y", True), 4: ("new", "y", True), 5: ("", "x", False)}


def test_geocodes_and_runs(spark):
    sites = spark.createDataFrame([(k, None, None, None, None) for k in (1, 2, 3)], "site_id int, latitude double, longitude double, geocode_quality string, coordinates_source string")
    hits = spark.createDataFrame([(1, 40.0, -75.0, "exact", "c"), (2, -75.0, 40.0, "exact", "c"), (3, 0.0, 0.0, "exact", "c")], "site_id int, lat double, lon double, quality string, source string")
    plain = {r["site_id"]: r["latitude"] for r in tables.apply_geocodes(sites, hits, corrected=False).collect()}
    fixed = {r["site_id"]: r["latitude"] for r in tables.apply_geocodes(sites, hits, corrected=True).collect()}
    assert plain == {1: 40.0, 2: -75.0, 3: None} and fixed == {1: 40.0, 2: 40.0, 3: None}
    log = spark.createDataFrame([(1, 1, "started"), (1, 2, "complete"), (2, 1, "started")], "run_id int, at int, status string")
    assert {r["run_id"]: r["status"] for r in tables.latest_runs(log).collect()} == {1: "complete", 2: "started"}


def test_review_actions(spark):
    sites = spark.createDataFrame([(1, "a", "flagged", 9, None), (2, "b", "flagged", 9, None)], "site_id int, name string, review_status string, review_priority int, primary_source string")
    acts = spark.createDataFrame([(1, "approve", None, None, 1), (1, "flag", "n", None, 2), (2, "edit", None, {"name": "B"}, 1)], "site_id int, action string, notes string, fields map<string,string>, at int")
    got = {r["site_id"]: tuple(r)[1:] for r in scoring.apply_actions(sites, acts).collect()}
    assert got == {1: ("a", "flagged", 1, None), 2: ("B", "flagged", 9, "manual")}  # test_source_merges.py has longer logs


def test_classifications(spark):
    now = spark.createDataFrame([], "site_id int, kind string, category int, rank int, confidence double, source string")
    cols = "site_id int, kind string, slug string, rank int, confidence double, source string, arrival int"
    derived = spark.createDataFrame([(1, "era", "colonial", 1, 0.9, "nrhp_derived", 1)], cols)
    replies = spark.createDataFrame([(1, "era", "colonial", 2, 0.1, None, 1), (1, "era", "modern", None, None, None, 2), (1, "era", "nope", 1, 0.5, None, 3), (1, "era", "wwii", 4, 0.5, None, 4), (1, "era", "wwii", 1, 1.2, None, 5)], cols)
    dim = spark.createDataFrame([("era", "colonial", 2), ("era", "modern", 12), ("era", "wwii", 10)], "kind string, slug string, category int")
    got = sorted(tuple(r) for r in enrich.apply_classifications(now, derived, replies, dim).collect())
    assert got == [(1, "era", 2, 1, 0.9, "nrhp_derived"), (1, "era", 12, 1, 0.5, "ai")]


def test_leaders_equal_a_sequential_model(spark):
    """Rounds over sets give what inserting one record after the other gives."""
    r = random.Random(7)
    for n in (1, 12, 40):
        edges = {(i, j) for i in range(n) for j in range(i) if r.random() < 0.12}
        taken = {i for i in range(n) if r.random() < 0.2}
        model: set[int] = set()
        for i in range(n):
            if i not in taken and not any((i, j) in edges for j in model):
                model.add(i)
        rows = spark.createDataFrame([(i,) for i in range(n)], "id long")
        e = spark.createDataFrame(sorted(edges), "later long, earlier long")
        got = batches.leaders(rows, e, spark.createDataFrame([(i,) for i in taken], "id long"))
        assert {x["id"] for x in got.collect() if x["leader"]} == model


def places(spark, id: str, start: int, n: int, seed: int):
    """Keyed records of a few similar names, a third without coordinates, some without a city."""
    r = random.Random(seed)
    words = ["Oldham", "Mill", "Stone", "Bridge", "Harbor", "Chapel", "Grange", "Barn"]
    rows = []
    for k in range(n):
        name = " ".join(r.sample(words, 3)) + r.choice(["", "s", " No. 1", " No. 2"])
        at = (None, None) if r.random() < 0.35 else (40.0 + r.choice([0, 0.003, 0.03, 0.4]), -75.0)
        rows.append((start + k, f"R{k % 50}" if r.random() < 0.1 else None, name, r.choice(["PA", "NJ"]), r.choice(["Town", "Ville", None]), r.choice([None, None, f"{k % 9} Main St"]), *at))
    df = spark.createDataFrame(rows, f"{id} long, nris_refnum string, name string, state string, city string, address string, latitude double, longitude double")
    return resolve.keyed(df, id)


def score(a: str, b: str) -> float:
    last = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
        last = row
    return 200.0 * last[-1] / (len(a) + len(b))


def fuzzy_model(i, sites) -> list[tuple]:
    """(score, site, km, type) of all that a record sees, best first, one pair after the other."""
    found = []
    for e in sites:
        near = not i.placed or not e.placed or abs(i.cx - e.cx) <= 1 and abs(i.cy - e.cy) <= 1
        if i.state == e.state and near and min(len(i.plain), len(e.plain)) / max(len(i.plain), len(e.plain)) >= 0.4:
            s = score(i.tokens, e.tokens)
            km = abs(i.latitude - e.latitude) * 111.195 if i.placed and e.placed else None
            kind = "proximity_match" if km is not None and km <= 0.5 and s >= 70 else "name_only_match" if s >= 90 else "name_match" if s >= 85 else None
            if kind:
                found.append((s, e.id, km, kind))
    return sorted(found, key=lambda x: (-x[0], x[1]))


NUMBER = re.compile(r"\d+(?:st|nd|rd|th)?\b")


def only_numbers_differ(a: str, b: str) -> bool:
    x, y = a.strip().lower(), b.strip().lower()
    return NUMBER.sub("#", x) == NUMBER.sub("#", y) and NUMBER.findall(x) != NUMBER.findall(y)


def kilometres(i, e) -> float | None:
    if None in (i.latitude, i.longitude, e.latitude, e.longitude):
        return None
    p, q = math.radians(i.latitude), math.radians(e.latitude)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(e.longitude - i.longitude) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


def cascade_model(i, stored) -> tuple | None:
    """(pass, site) of one record, every site after the other."""
    found = []
    for e in stored:
        if i.nris_refnum is not None and i.nris_refnum == e.nris_refnum:
            found.append((1, -100.0, e.id))
        if i.state != e.state:
            continue
        if i.address_key and i.city_key and (i.address_key, i.city_key) == (e.address_key, e.city_key):
            found.append((2, -score(*(" ".join(sorted(x.name.split())) for x in (i, e))), e.id))
        if min(len(i.plain), len(e.plain)) / max(len(i.plain), len(e.plain)) < 0.4 or only_numbers_differ(i.name, e.name):
            continue
        cells = i.placed and e.placed and abs(i.cx - e.cx) <= 1 and abs(i.cy - e.cy) <= 1
        if not (cells or not i.placed or not e.placed):
            continue
        s, km = score(i.tokens, e.tokens), kilometres(i, e)
        if km is not None and km <= 0.5:
            if s >= 70:
                found.append((3, -s, e.id))
        elif (s >= 90 and i.city_key == e.city_key) or (s >= 95 and i.city_key is None):
            found.append((4, -s, e.id))
    return min(found) if found else None


def test_cascade_equals_a_sequential_model(spark):
    inc, sites = places(spark, "record_id", 1000, 140, 13).cache(), places(spark, "site_id", 1, 140, 14).cache()
    stored = sites.collect()
    want = {i.id: m for i in inc.collect() if (m := cascade_model(i, stored))}
    got = {r.record_id: (r["pass"], r.site_id) for r in resolve.cascade(inc, sites).collect()}
    assert got == {k: (m[0], m[2]) for k, m in want.items()} and {m[0] for m in want.values()} == {1, 2, 3, 4}


def test_parks_and_battlefields_equal_a_sequential_model(spark):
    inc, sites = places(spark, "record_id", 1000, 60, 23).cache(), places(spark, "site_id", 1, 90, 24).cache()
    stored = sites.collect()
    comparable = lambda i, e: min(len(i.plain), len(e.plain)) / max(len(i.plain), len(e.plain)) >= 0.4
    parks, fields = {}, {}
    for i in inc.collect():
        scored = [(score(i.tokens, e.tokens), e) for e in stored if comparable(i, e)]
        if best := [(-s, e.id) for s, e in scored if s >= 85]:
            parks[i.id] = min(best)[1]
        near = [(1, -s, e.id) for s, e in scored if i.placed and e.placed and abs(i.cx - e.cx) <= 1 and abs(i.cy - e.cy) <= 1 and s >= 70 and kilometres(i, e) <= 0.5]
        sees = lambda e: not i.placed or not e.placed or abs(i.cx - e.cx) <= 1 and abs(i.cy - e.cy) <= 1  # noqa: E731, B023
        if best := near + [(2, -s, e.id) for s, e in scored if s >= 92 and sees(e)]:
            fields[i.id] = min(best)[2]
    assert {r.record_id: r.site_id for r in resolve.park_matches(inc, sites).collect()} == parks
    assert {r.record_id: r.site_id for r in resolve.battlefield_matches(inc, sites).collect()} == fields


def test_name_pairs_lose_nothing(spark):
    """Every two names of the least score or more come out of the prefix filter, short and empty ones too."""
    r = random.Random(5)
    words = ["Oldham", "Mill", "Stone", "aa", "a", "b", "", "Bridge", "Harbor", "Éire", "Chapel"]
    names = {" ".join(sorted(" ".join(r.sample(words, r.choice([1, 1, 2, 3]))).split())) + r.choice(["", "", "s", "x"]) for _ in range(150)} | {"", "a", "ab"}
    left, right = sorted(names)[::2], sorted(names)[1::2] + sorted(names)[:20]
    frame = lambda xs: spark.createDataFrame([("PA", x) for x in xs], "state string, tokens string")
    ratio = lambda a, b: 100.0 if a == b else score(a, b)
    for least in (85.0, 90.0, 95.0):
        want = {(a, b) for a in left for b in right if (a or b) and ratio(a, b) >= least or a == b}
        assert {(x.a, x.b) for x in resolve.name_pairs(frame(left), frame(right), least).collect()} == want


def test_audit_and_near_misses_see_what_has_no_coordinates(spark):
    inc, sites = places(spark, "record_id", 1000, 120, 3).cache(), places(spark, "site_id", 1, 120, 4).cache()
    records, stored = inc.collect(), sites.collect()
    numbers = {e.nris_refnum for e in stored} - {None}
    tops = {i.id: fuzzy_model(i, stored)[0] for i in records if fuzzy_model(i, stored)}
    plain = {x.id: x.name.lower().replace(".", "") for x in records + stored}
    want = {(i.id, tops[i.id][1], tops[i.id][3]) for i in records if i.id in tops and i.nris_refnum not in numbers and tops[i.id][0] < 100 and plain[i.id] != plain[tops[i.id][1]]}
    got = resolve.match_audit(inc, sites).collect()
    assert {(x.record_id, x.site_id, x.match_type) for x in got} == want
    assert any(x.km is None for x in got)
    matched = resolve.cascade(inc, sites).select("record_id").cache()
    taken = {x.record_id for x in matched.collect()}
    missed = resolve.near_misses(inc, sites, matched).collect()
    assert {(x.record_id, x.site_id) for x in missed} == {(i, t[1]) for i, t in tops.items() if i not in taken}
    assert any(x.km is None for x in missed)


def test_registered_near_misses_have_no_match(spark):
    data = "/root/testdata/sf0.001"
    accepted = registry.QUERIES["match_cascade"](spark, data)
    assert registry.QUERIES["near_misses"](spark, data).join(accepted, "record_id", "left_semi").count() == 0


def test_inserts_meet_all_passes(spark):
    """Each record meets stored sites and earlier inserts by number, address, distance and name."""
    cols = "nris_refnum string, name string, state string, city string, address string, latitude double, longitude double"
    stored = [(1, None, "Alder Mill", "PA", "Town", "1 Main St", None, None), (2, None, "Birch Bridge", "PA", "Town", None, 40.0, -75.0), (3, None, "Cedar Chapel", "PA", "Ville", None, None, None), (4, "R4", "Dogwood Barn", "NJ", "Town", None, None, None)]
    rows = [
        (11, None, "Other Name", "PA", "Town", "1 Main St", None, None), (12, None, "Birch Bridges", "PA", None, None, 40.001, -75.0), (13, None, "Cedar Chapel", "PA", "Ville", None, None, None), (14, "R4", "Any", "PA", None, None, None, None),
        (21, "R9", "Elm Grange", "PA", "Town", "7 Oak St", 41.0, -75.0), (22, "R9", "Quite Different", "PA", None, None, None, None), (23, None, "Unlike", "PA", "Town", "7 Oak St", None, None), (24, None, "Elm Granges", "PA", "Ville", None, 41.001, -75.0),
        (25, None, "Elm Grange", "PA", "Town", None, None, None), (26, None, "Elm Grange", "NJ", "Town", None, None, None), (27, None, "Unlike", "PA", "Ville", None, None, None), (28, None, "Elm Grange", "PA", "Ville", None, 43.0, -75.0),
    ]
    inc, sites = resolve.keyed(spark.createDataFrame(rows, f"record_id long, {cols}"), "record_id"), resolve.keyed(spark.createDataFrame(stored, f"site_id long, {cols}"), "site_id")
    got = {x["id"]: x["leader"] for x in batches.insert_leaders(inc, sites).collect()}
    assert len(got) == len(rows) and {k for k, v in got.items() if v} == {21, 26, 27, 28}


def test_registered_inserts_match_no_site(spark):
    data = "/root/testdata/sf0.001"
    inserted = registry.QUERIES["insert_leaders"](spark, data).where("leader").select(F.col("id").alias("record_id"))
    assert inserted.join(registry.QUERIES["match_cascade"](spark, data), "record_id", "left_semi").count() == 0


def test_exports(spark, tmp_path):
    sites = spark.createDataFrame([(1, "A & B", "PA", "Town", 40.0, -75.0, "flagged", 3, 0.25), (2, "C", None, None, None, None, "approved", 1, 0.9)],
        "site_id int, name string, state string, city string, latitude double, longitude double, review_status string, review_priority int, confidence_score double")
    features = exports.geojson_features(sites).collect()
    assert len(features) == 1 and '"coordinates":[-75.0,40.0]' in features[0]["feature"] and "address" not in features[0]["feature"]
    mark = exports.kml_placemarks(sites).first()
    assert mark["part"] is None and "A &amp; B" in mark["placemark"] and "<b>Confidence:</b> 0.25" in mark["placemark"]
    exports.write_csv(exports.review_rows(sites), str(tmp_path / "review"))
    assert spark.read.option("header", True).csv(str(tmp_path / "review")).count() == 1
    kinds = spark.createDataFrame([(1, "Tribal"), (1, "Federal NRHP")], "site_id int, designation_type string")
    marker = exports.map_markers(sites, kinds).first()
    assert (marker["colour"], marker["layer"]) == ("blue", "Federal NRHP")
    exports.write_by_state(exports.geojson_features(sites), str(tmp_path / "states"), "feature")
    assert [p.name for p in (tmp_path / "states").glob("state=*")] == ["state=PA"]


def test_redelivery(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES (1, 'x', timestamp'2024-01-01 00:00:00'), (1, 'x', timestamp'2024-01-01 00:01:00'), (1, 'y', timestamp'2024-01-01 00:02:00') AS t(id, v, fetched_at)")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = incremental.landing_stream(spark, str(tmp_path / "in"), rows.schema)
    query = incremental.without_redelivery(stream, ["id"]).writeStream.format("memory").queryName("delivered").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination()
    assert spark.table("delivered").count() == 2
