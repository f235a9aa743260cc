"""The master table and the registered streams."""

from __future__ import annotations

import random
from pathlib import Path

from placeweave.operators.tables import upsert_first_wins
from placeweave.streaming import master

SCHEMA = "ref string, name string, city string, flag boolean, at int"


def stored(spark, path, version=None):
    return sorted(map(repr, (tuple(r) for r in master.read_master(spark, path, version).collect())))


def test_upserts_equal_one_batch(spark, tmp_path):
    """Leaves split as the table grows; all batches together give what one gives; repeated batches change nothing."""
    r = random.Random(3)
    path = str(tmp_path / "m")
    rows, at = [], 0
    for number in range(6):
        part = []
        for _ in range([0, 150, 3, 200, 1, 40][number]):
            at += 1
            part.append((r.choice([None, *[f"k{k}" for k in range(300)]]), r.choice([None, "", f"n{at}"]), r.choice([None, f"c{at}"]), r.choice([None, True, False]), at))
        rows += part
        batch = spark.createDataFrame(part, SCHEMA)
        master.upsert(spark, path, batch, number, "ref", "at", ["flag"], leaf_rows=20)
        once = stored(spark, path)
        master.upsert(spark, path, batch, number, "ref", "at", ["flag"], leaf_rows=20)
        assert stored(spark, path) == once
        want = upsert_first_wins(spark.createDataFrame([], SCHEMA).drop("at"), spark.createDataFrame(rows, SCHEMA), "ref", "at", ["flag"])
        assert once == sorted(map(repr, (tuple(x) for x in want.collect())))
        leaves = master.manifest(spark, path, number).collect()
        assert sum(x.rows for x in leaves) == len(once) and all(x.rows <= 20 or x.depth < 0 for x in leaves)
    assert master.versions(spark, path) == [4, 5] and stored(spark, path, 4) != once
    listed = {x.path for v in (4, 5) for x in master.manifest(spark, path, v).collect() if x.path}
    there = {str(p) for p in Path(path, "data").glob("v=*/leaf=*")}
    assert there == {p.removeprefix("file:") for p in listed}


def test_a_batch_touches_its_leaves_only(spark, tmp_path):
    path = str(tmp_path / "m")
    many = spark.range(20_000).selectExpr("concat('k', id) AS ref", "concat('n', id) AS name", "cast(null AS string) AS city", "false AS flag", "cast(id AS int) AS at")
    master.upsert(spark, path, many, 0, "ref", "at", ["flag"], leaf_rows=500)
    leaves = master.manifest(spark, path, 0).count()
    few = spark.createDataFrame([("k5", None, "c", True, 1), ("new", "N", None, None, 2)], SCHEMA)
    master.upsert(spark, path, few, 1, "ref", "at", ["flag"], leaf_rows=500)
    size = lambda v: sum(p.stat().st_size for p in Path(path, f"data/v={v}").rglob("*.parquet"))
    fresh = master.manifest(spark, path, 1).where("path like '%v=1%'").count()
    assert leaves >= 40 and fresh <= 2 and size(1) < size(0) / 10
    got = {r.ref: tuple(r)[1:] for r in master.read_master(spark, path).where("ref in ('k5', 'new', 'k6')").collect()}
    assert got == {"k5": ("n5", "c", True), "new": ("N", None, False), "k6": ("n6", None, False)}
    assert master.read_master(spark, path).count() == 20_001


def test_loose_rows_are_put_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(master, "LOOSE", 2)
    path = str(tmp_path / "m")
    for number in range(5):
        master.upsert(spark, path, spark.createDataFrame([(None, f"n{number}", None, None, number)], SCHEMA), number, "ref", "at", ["flag"])
    assert master.read_master(spark, path).count() == 5
    assert master.manifest(spark, path, 4).where("depth < 0").count() <= 2
