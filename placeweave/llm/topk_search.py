"""Exact top-k search as a Voronoi kNN join (operator 9).

Vectors become integers and are grouped by their nearest pivot and their distance
ring around it.  From each group's size and radius follows the most that any of
its members can score with a query (inner product with the pivot plus query norm
times radius).  A sample of witnesses gives each query a score that its k-th best
certainly reaches, so a query is sent only to units (small groups together, large
ones in parts) that may hold something better.  Queries of one pivot form blocks,
and a unit's rows go only to blocks with a query that was sent to it; units are
solved locally and the best k of the local bests remain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeweave.llm.shared import discard, released, staged

#: Bounds of what is broadcast: pivots (as many as the root of the rows, between these),
#: rings around each, witnesses.
PIVOTS, RINGS, WITNESSES = (16, 1024), 8, 4096
#: Rows of a unit and of a block of queries, about.
UNIT_ROWS, QUERY_ROWS = 4096, 1024
_ROUNDING = float(np.finfo(np.float64).eps)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dim)


def _error(dim: int, norm: np.ndarray, other: np.ndarray) -> np.ndarray:
    """More than what rounding can change an inner product of vectors of these norms by."""
    return 4 * (dim + 2) * _ROUNDING * norm * other


def _whole_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers of any size."""
    whole = [int(c) for c in q]
    return np.array([sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in x], dtype=object)


def _pack_vectors(df: DataFrame, id: str, vector: str, dim: int) -> DataFrame:
    """(id, v): floor(64 x) of every component, as packed doubles, short ones padded by 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(1)
            flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum([len(x) for x in rows])
            out = np.zeros((len(rows), dim))
            at = np.repeat(np.arange(len(rows)), np.diff(np.concatenate([[0], ends])))
            out[at, np.arange(len(flat)) - np.concatenate([[0], ends])[at]] = np.floor(64 * flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in out], pa.binary())], names=["id", "v"])

    return df.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).mapInArrow(run, "id long, v binary")


def _dealt(groups: list[tuple[int, int]], room: int) -> tuple[dict[int, int], dict[int, int]]:
    """(first part, number of parts) of groups (number, rows): small neighbouring ones share
    a part of about ``room`` rows, a large one is dealt over several of its own."""
    first, parts, part, left = {}, {}, -1, 0
    for group, n in groups:
        if n > left:
            part, left = part + 1, room
        first[group], parts[group] = part, max(1, -(-n // room))
        left -= n
        if parts[group] > 1:
            part, left = part + parts[group] - 1, 0
    return first, parts


def _sample(rows: DataFrame, n: int, seed: int) -> list:
    return rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(n).collect()


def voronoi_knn_join(
    data: DataFrame, queries: F.Column, k: int = 20, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Rows (query_id, rank, id, score): the k best rows of every query, all if fewer.

    ``queries`` is a condition on ``data``; candidates are all rows of another id.
    Ties go to the smaller id.  Rows with a null id, a null vector or a null or
    non-finite component take no part; shorter vectors count as padded by zeros.
    An id that is repeated is a candidate each time and asks once.  Scores are exact
    at any size: bounds and floors allow for rounding, and those that a double may not
    hold are taken again in whole numbers.  Scores beyond a long are given as the nearest
    long, in no order among themselves.
    Equal vectors are one group, whatever their number; it is solved in parts.
    """
    v = F.col(vector).cast("array<double>")
    sound = F.col(id).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = data.where(F.coalesce(sound, F.lit(False)))
    dim = usable.agg(F.max(F.size(vector))).first()[0] or 1
    context = data.sparkSession.sparkContext
    asked = usable.where(queries).select(F.col(id).cast("long").alias("id")).distinct()

    packed = staged(_pack_vectors(usable, id, vector, dim))
    witnesses = _sample(packed, WITNESSES, 1)
    if not witnesses:
        return packed.sparkSession.createDataFrame([], f"query_id long, rank int, `{id}` long, score long")
    witness = context.broadcast((np.array([r["id"] for r in witnesses]), np.frombuffer(b"".join(r["v"] for r in witnesses)).reshape(-1, dim)))
    wanted = min(max(PIVOTS[0], int(packed.count() ** 0.5)), PIVOTS[1])
    pivots = np.unique(np.frombuffer(b"".join(r["v"] for r in witnesses[:wanted])).reshape(-1, dim), axis=0)
    shared = context.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            cell = ((p * p).sum(axis=1) - 2 * x @ p.T).argmin(axis=1)
            radius = np.sqrt(((x - p[cell]) ** 2).sum(axis=1)) * (1 + _ROUNDING)  # from the difference, which does not cancel
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell.astype(np.int32)), pa.array(radius), batch.column(1)], names=["id", "cell", "radius", "v"])

    placed = staged(packed.mapInArrow(released(assign), "id long, cell int, radius double, v binary"))
    discard(packed)
    reach = placed.groupBy("cell").agg(F.max("radius").alias("reach"))  # a row a pivot
    ring = F.when(F.col("reach") > 0, F.least(F.floor(F.col("radius") / F.col("reach") * RINGS), F.lit(RINGS - 1))).otherwise(0).cast("int")
    grouped = placed.join(F.broadcast(reach), "cell").withColumn("group", F.col("cell") * RINGS + ring).drop("reach")
    groups = grouped.groupBy("group").agg(F.count("*").alias("n"), F.max("radius").alias("r")).orderBy("group").collect()  # pivots * RINGS at most

    first, parts = _dealt([(g["group"], g["n"]) for g in groups], UNIT_ROWS)
    spark = data.sparkSession
    dealt = spark.createDataFrame([(g, first[g], parts[g]) for g in first], "group int, first int, parts long")
    in_units = grouped.join(F.broadcast(dealt), "group").withColumn("unit", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int"))
    names = np.array([g["group"] for g in groups])
    radii = np.array([g["r"] for g in groups])
    bounds = context.broadcast((pivots[names // RINGS], radii, np.array([first[g] for g in names]), np.array([parts[g] for g in names])))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The units a query has to see, with the score its k-th best reaches."""
        ids, w = witness.value
        p, r, begin, wide = bounds.value
        far = np.sqrt((p * p).sum(axis=1)) + r
        longest = np.sqrt((w * w).sum(axis=1)).max()
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(at, QUERY_ROWS)
                own, x = part.column(0).to_numpy(zero_copy_only=False), _matrix(part.column(1), dim)
                norm = np.sqrt((x * x).sum(axis=1))
                known = x @ w.T
                known[own[:, None] == ids] = -np.inf
                floor = np.partition(known, -k, axis=1)[:, -k] if known.shape[1] >= k else np.full(len(x), -np.inf)
                floor = floor - _error(dim, norm, longest)
                most = x @ p.T + norm[:, None] * r
                query, group = np.nonzero(~(most + _error(dim, norm[:, None], far) < floor[:, None]))
                n = wide[group]
                unit = np.repeat(begin[group] - np.cumsum(n) + n, n) + np.arange(n.sum())
                i, unit = np.divmod(np.unique(np.repeat(query, n) * (begin[-1] + wide[-1]) + unit), begin[-1] + wide[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[i]), pa.array(unit.astype(np.int32)), pa.array(floor[i]), *(part.column(k).take(pa.array(i)) for k in (1, 2))],
                    names=["id", "unit", "floor", "v", "block"],
                )

    # queries of neighbouring pivots see much the same units, so they share blocks
    query_rows = placed.join(asked, "id", "left_semi").dropDuplicates(["id"]).select("id", "v", "cell")
    asked_of = [(r["cell"], r["n"]) for r in query_rows.groupBy("cell").agg(F.count("*").alias("n")).orderBy("cell").collect()]  # a row a pivot
    block, shares = _dealt(asked_of, QUERY_ROWS)
    blocks = spark.createDataFrame([(c, block[c], shares[c]) for c in block], "cell int, first int, parts long")
    asking = query_rows.join(F.broadcast(blocks), "cell").select("id", "v", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("block"))
    routed = staged(asking.mapInArrow(released(route), "id long, unit int, floor double, v binary, block int"))
    met = routed.select(F.col("unit").alias("unit"), F.col("block").alias("block")).distinct()
    copied = in_units.select("id", "unit", "v").join(met, "unit")

    def solve(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            x_ids = right.column("id").to_numpy()
            order = np.argsort(x_ids, kind="stable")
            x_ids, x = x_ids[order], _matrix(right.column("v"), dim)[order]
            q_ids, q, floor = left.column("id").to_numpy(), _matrix(left.column("v"), dim), left.column("floor").to_numpy()
            longest = np.sqrt((x * x).sum(axis=1)).max()
            for at in range(0, len(q), 256):
                score = q[at : at + 256] @ x.T
                score[q_ids[at : at + 256, None] == x_ids] = -np.inf
                least = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(score), -np.inf)
                least = np.maximum(least, floor[at : at + 256])
                top = np.sqrt((q[at : at + 256] ** 2).sum(axis=1)) * longest
                for i in range(len(score)):
                    slack = 0.0 if top[i] < 2**52 else 2 * _error(dim, top[i], 1.0)
                    hit = np.flatnonzero((score[i] >= least[i] - slack) & (score[i] > -np.inf))
                    whole = score[i][hit].astype(np.int64) if slack == 0 else _whole_scores(q[at + i], x[hit])
                    hit, whole = (a[np.argsort(-whole, kind="stable")][:k] for a in (hit, whole))  # ids ascend among equal scores
                    out[0].append(np.full(len(hit), q_ids[at + i]))
                    out[1].append(x_ids[hit])
                    out[2].append(np.clip(whole, -(2**63) + 1, 2**63 - 1).astype(np.int64))
        return pa.table({n: pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for n, c in zip(("query_id", "id", "score"), out, strict=True)})

    local = routed.groupBy("unit", "block").cogroup(copied.groupBy("unit", "block")).applyInArrow(solve, "query_id long, id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id), "score")
