"""Typed landing, marker tiles and totals."""

from __future__ import annotations

import json
from collections import Counter

import pytest

from placeweave.operators import profile
from placeweave.sinks import tiles
from placeweave.sources import landing

FEATURES = [
    {"attributes": {"NAME": " Mill ", "TYPE": "A", "SIZE": 12, "LISTED": 86400000, "OID": 7, "X Y": "odd"}, "geometry": {"x": -75.5, "y": 40.25}},
    {"attributes": {"NAME": "Barn", "TYPE": "A", "SIZE": "12", "LISTED": "19650101", "OID": 7.5}, "geometry": {"points": [[-75.0, 40.0], [1.0, 2.0]]}},
    {"attributes": {"NAME": "Inn", "TYPE": "B", "SIZE": 99, "LISTED": None, "OID": True}, "geometry": {"x": 1.0, "y": 2.0}},
    {"attributes": {"NAME": 5, "TYPE": "A", "SIZE": 30, "OID": "x"}, "geometry": {"rings": [[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 0.0]]]}},
    {"attributes": {"NAME": "", "TYPE": "A", "SIZE": 30}, "geometry": {"x": 1.0, "y": 2.0}},
    {"attributes": {"NAME": "No place", "TYPE": "A", "SIZE": 30}},
    {},
]
CONFIG = {"key": "t", "state_code": "PA", "field_map": {"name": ["MISSING", "NAME"], "state_record_id": ["OID"], "date_listed": ["LISTED"], "city": ["X Y"]}}


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    lines = spark.createDataFrame([(json.dumps(f), k) for k, f in enumerate(FEATURES)] + [("{broken", 90), (None, 91), ("[1]", 92)], "value string, line int")
    return landing.land(landing.typed_features(lines, ["NAME", "TYPE", "SIZE", "LISTED"]), str(tmp_path_factory.mktemp("landed") / "t"))


def test_numbers_and_texts_stay_apart(landed):
    rows = {r.line: r for r in landed.select("line", "t_SIZE", "n_SIZE", "t_NAME", "broken").collect()}
    assert (rows[0].t_SIZE, rows[0].n_SIZE) == (None, 12.0) and (rows[1].t_SIZE, rows[1].n_SIZE) == ("12", None)
    assert rows[90].broken == "{broken" and rows[92].broken is None and len(rows) == 10
    got = sorted((r.name, r.state_record_id, r.state_designation_date, r.city, round(r.latitude, 6), round(r.longitude, 6)) for r in landing.parse_landed(landed, CONFIG).collect())
    assert got == [("5", "x", None, None, 0.5, 1.0), ("Barn", "7.5", "19650101", None, 40.0, -75.0), ("Inn", None, None, None, 2.0, 1.0), ("Mill", "7", "1970-01-02", "odd", 40.25, -75.5)]


def test_a_predicate_reaches_the_scan(landed, capsys):
    rows = landing.parse_landed(landed, CONFIG | {"where": "t_TYPE = 'A' AND n_SIZE >= 12"})
    assert {r.name for r in rows.collect()} == {"Mill", "5"}
    rows.explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(t_TYPE,A)" in plan and "GreaterThanOrEqual(n_SIZE,12.0)" in plan
    read = next(x for x in plan.splitlines() if x.startswith("ReadSchema"))
    assert "t_NAME" in read and "broken" not in read and "line" not in read


def test_tiles_against_loops(spark):
    spots = [(k, -60.0 + k * 1.7, -179.0 + k * 7.9, "ab"[k % 2] if k % 5 else None) for k in range(40)] + [(90, None, 1.0, "a"), (91, 90.0, 180.0, "a"), (92, -90.0, -180.0, "b"), (93, -90.0, -180.0, "b")]
    found = {(r.zoom, r.tile, r.layer): (r.n, r.site_id) for r in tiles.marker_tiles(spark.createDataFrame(spots, "site_id int, latitude double, longitude double, layer string"), 6).collect()}
    want, ids = Counter(), {}
    for k, lat, lon, layer in spots:
        if lat is None:
            continue
        x, y = (min(max(int(v), 0), 63) for v in ((lon + 180) / 360 * 64, (90 - lat) / 180 * 64))
        path = "".join(str((x >> 5 - i & 1) + 2 * (y >> 5 - i & 1)) for i in range(6))
        for zoom in range(7):
            want[zoom, path[:zoom], layer] += 1
            ids.setdefault((zoom, path[:zoom], layer), k)
    assert found == {k: (n, ids[k] if n == 1 else None) for k, n in want.items()}


def test_totals_are_one_pass(spark, capsys):
    rows = [("PA", "inserted"), ("PA", "matched_nris"), ("PA", "matched_fuzzy"), (None, "inserted"), ("NJ", "matched_nris")]
    found = profile.totals(spark.createDataFrame(rows, "state string, outcome string"), ["state"])
    got = {(r.state, r.outcome, r.level): r.n for r in found.collect()}
    assert got == {
        ("PA", "inserted", 1): 1, ("PA", "matched_nris", 1): 1, ("PA", "matched_fuzzy", 1): 1, ("PA", "total", 1): 3, ("PA", "updated", 1): 2, (None, "inserted", 1): 1, (None, "total", 1): 1,
        ("NJ", "matched_nris", 1): 1, ("NJ", "total", 1): 1, ("NJ", "updated", 1): 1, (None, "inserted", 0): 2, (None, "matched_nris", 0): 2, (None, "matched_fuzzy", 0): 1, (None, "total", 0): 5, (None, "updated", 0): 3,
    }
    profile.distributions(spark.createDataFrame(rows, "state string, outcome string"), ["state", "outcome"]).explain()
    assert capsys.readouterr().out.count("Expand") == 1
    assert [(r.total, r.rate) for r in profile.coordinate_coverage(spark.createDataFrame([], "state string, latitude double, longitude double")).collect()] == [(0, 0.0)]
