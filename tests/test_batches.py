"""Records that arrive one after the other, against loops over them."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from placeweave.operators import batches, resolve
from test_tables import cascade_model, kilometres, places, score


def sequential(records, stored, accepts):
    """What a loop does: (record, site, leader, pass, inserted); ``accepts`` gives (pass, -score, id) of what a record meets."""
    now, out = list(stored), []
    inserted = []
    for i in sorted(records, key=lambda r: r.id):
        old, new = accepts(i, now), accepts(i, inserted)
        choice = min([(*m[:2], 0, m[2]) for m in old] + [(*m[:2], 1, m[2]) for m in new], default=None)
        if choice is None:
            inserted.append(i)
            out.append((i.id, None, i.id, None, True))
        else:
            out.append((i.id, None if choice[2] else choice[3], choice[3] if choice[2] else None, choice[0], False))
    return sorted(out)


def state_accepts(i, sites):
    found = [m for e in sites if (m := cascade_model(i, [e]))]
    return found


def park_accepts(i, sites):
    return [(1, -s, e.id) for e in sites if min(len(i.plain), len(e.plain)) / max(len(i.plain), len(e.plain)) >= 0.4 and (s := score(i.tokens, e.tokens)) >= 85]


def field_accepts(i, sites):
    out = []
    for e in sites:
        cells = i.placed and e.placed and abs(i.cx - e.cx) <= 1 and abs(i.cy - e.cy) <= 1
        if min(len(i.plain), len(e.plain)) / max(len(i.plain), len(e.plain)) < 0.4 or not (cells or not i.placed or not e.placed):
            continue
        s, km = score(i.tokens, e.tokens), kilometres(i, e)
        if km is not None and km <= 0.5:
            if s >= 70:
                out.append((1, -s, e.id))
        elif s >= 92:
            out.append((2, -s, e.id))
    return out


@pytest.mark.parametrize("kind, accepts", [("state", state_accepts), ("parks", park_accepts), ("battlefields", field_accepts)])
def test_assignments_equal_a_loop(spark, kind, accepts):
    inc, sites = places(spark, "record_id", 1000, 130, 31).cache(), places(spark, "site_id", 1, 25, 32).cache()
    again = inc.where("id % 5 = 0").withColumn("id", F.col("id") + 500)  # equal match keys, later
    inc = inc.unionByName(again).cache()
    want = sequential(inc.collect(), sites.collect(), accepts)
    got = sorted((r.record_id, r.site_id, r.leader_id, r["pass"], r.inserted) for r in batches.assignments(inc, sites, kind).collect())
    assert got == want
    assert any(x[4] for x in want) and any(x[2] and not x[4] for x in want) and any(x[1] for x in want)


def test_exact_passes_only(spark):
    """Equal records that no rule of these passes matches are inserted each."""
    inc = places(spark, "record_id", 1000, 150, 41)
    inc, sites = inc.unionByName(inc.where("id % 3 = 0").withColumn("id", F.col("id") + 500)).cache(), places(spark, "site_id", 1, 20, 42).cache()
    exact = lambda i, found: [m for e in found if (m := cascade_model_exact(i, e))]
    want = sequential(inc.collect(), sites.collect(), exact)
    got = sorted((r.record_id, r.site_id, r.leader_id, r["pass"], r.inserted) for r in batches.assignments(inc, sites, passes=(1, 2)).collect())
    assert got == want


def cascade_model_exact(i, e):
    if i.nris_refnum is not None and i.nris_refnum == e.nris_refnum:
        return (1, -100.0, e.id)
    if i.state == e.state and i.address_key and i.city_key and (i.address_key, i.city_key) == (e.address_key, e.city_key):
        return (2, -score(*(" ".join(sorted(x.name.split())) for x in (i, e))), e.id)
    return None


def test_a_clique_makes_no_pairs(spark):
    """Ten thousand records of one address, and as many of one name, stay linear: groups, no edges."""
    cols = "record_id long, nris_refnum string, name string, state string, city string, address string, latitude double, longitude double"
    r = random.Random(3)
    names = ["Alder", "Birch", "Cedar", "Dogwood", "Elm"]
    rows = [(k, None, f"{r.choice(names)} {k}", "PA", "Town", "1 Main St", None, None) for k in range(10_000)]
    rows += [(20_000 + k, None, "Old School", "PA", "Ville", None, 40 + r.random() / 50, -75 + r.random() / 50) for k in range(10_000)]
    inc = resolve.keyed(spark.createDataFrame(rows, cols), "record_id").cache()
    sites = inc.where("false")
    began = time.time()
    edges, belongs, sees = batches.state_groups(inc.where("id >= 20000"))
    assert edges.count() == 0 and belongs.count() + sees.count() <= 16 * 10_000
    got = batches.assignments(inc, sites, passes=(1, 2)).groupBy("leader_id").count().collect()
    found = {x.leader_id: x["count"] for x in got}
    assert found[0] == 10_000 and len(found) == 10_001
    named = batches.assignments(inc.where("id >= 20000"), sites).groupBy("leader_id").count().collect()
    assert [(x.leader_id, x["count"]) for x in named] == [(20_000, 10_000)]
    assert time.time() - began < 300


def test_repeated_sites_make_no_pairs(spark):
    """Of sites that no rule can tell apart one comes out."""
    cols = "id long, nris_refnum string, name string, state string, city string, address string, latitude double, longitude double"
    rows = [(k, None, "Old Mill", "PA", "Town", "1 Main St", 40.0, -75.0) for k in range(5000)]
    sites = resolve.keyed(spark.createDataFrame(rows, cols), "id")
    inc = resolve.keyed(spark.createDataFrame([(k + 10_000, *x) for k, *x in rows], cols), "id")
    found = resolve.candidates(inc.limit(100), sites)
    assert {(x["pass"], x.e_id, x["count"]) for x in found.groupBy("pass", "e_id").count().collect()} == {(2, 0, 100), (3, 0, 100)}
    assert resolve.cascade(inc, sites).where("site_id <> 0").count() == 0


def test_fine_cells_lose_no_near_pair(spark):
    r = random.Random(8)
    cols = "id long, nris_refnum string, name string, state string, city string, address string, latitude double, longitude double"
    corners = [(0.005, 0.005), (40.0, -75.0), (64.8, -147.7), (-14.27, -170.7), (71.3, 179.999), (71.3, -179.999), (88.0, 10.0), (89.9, 10.0), (-96.2, 40.0)]
    rows = []
    for k in range(540):
        lat, lon = corners[k % len(corners)]
        rows.append((k, None, f"Mill {k % 3}", "PA", None, None, lat + r.uniform(-0.008, 0.008), lon + r.uniform(-0.02, 0.02)))
    df = resolve.keyed(spark.createDataFrame(rows, cols), "id").cache()
    plain = sorted(df.collect(), key=lambda x: x.id)
    want = {(i.id, e.id) for i in plain for e in plain if (km := kilometres(i, e)) is not None and km <= 0.5 and abs(i.cx - e.cx) <= 1 and abs(i.cy - e.cy) <= 1}
    i, e = resolve.fine_cells(df, df, 0.5)
    km = resolve.distance_km(*[F.col(c) for c in ("i_latitude", "i_longitude", "e_latitude", "e_longitude")])
    got = [(x.i_id, x.e_id) for x in i.join(e, ["fy", "fx"]).where((km <= 0.5) & resolve._visible()).select("i_id", "e_id").collect()]
    assert set(got) == want and len(got) == len(want)
    scored = [(x.i_id, x.e_id) for x in resolve.near_pairs(df, df).collect()]
    assert sorted(scored) == sorted((a, b) for a, b in want if score(plain[a].tokens, plain[b].tokens) >= 70)
