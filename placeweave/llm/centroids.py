"""Centroid clustering by a bisector tournament (operator 11).

Vectors and centroids are whole numbers.  For every pair of centroids i < j the
normal of their bisector and its threshold are made once a round, so that the sign
of one inner product tells which of the two is nearer to a vector; zero leaves the
smaller number.  A vector meets k - 1 such tests, each of which eliminates one
centroid, and only the distance to the one that is left is computed.  Tasks add up
the members of each cluster; what reaches the driver is k rows of sums a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm.shared import released, staged

#: Largest bytes of the normals of all pairs, which every worker holds.
NORMAL_BYTES = 1 << 28
#: Rows that are judged together.
BLOCK_ROWS = 2048


def largest_component(dim: int) -> int:
    """The components up to which squared distances of ``dim`` components fit a long:
    dim * (2 c) ** 2 < 2 ** 62."""
    return int((2**60 / dim) ** 0.5) - 1


class Bisectors:
    """Normals and thresholds of all pairs of the given centroids (k, dim)."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        norms = (centroids * centroids).sum(axis=1)
        #: normals[i, j] . x > thresholds[i, j] where j is nearer to x than i
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        self.thresholds = norms[None, :] - norms[:, None]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row, the smaller one of two, and the squared distance.

        The champion always has the smaller number, so that only a positive test lets the challenger win.
        """
        champion = np.zeros(len(x), dtype=np.int64)
        for challenger in range(1, len(self.centroids)):
            side = np.einsum("rd,rd->r", self.normals[champion, challenger], x) - self.thresholds[champion, challenger]
            champion[side > 0] = challenger
        away = x - self.centroids[champion]
        return champion, np.einsum("rd,rd->r", away, away)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _whole_numbers(data: DataFrame, id: str, vector: str, dim: int, scale: int) -> DataFrame:
    """(id, x) of the vectors that take part: floor(scale * component) of each component."""
    v = F.col(vector).cast("array<double>")
    sound = (F.size(v) == dim) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    limit = float(largest_component(dim))
    fits = F.lit(f"a component beyond {limit:.0f}: its squared distances do not fit a long")
    whole = F.transform(v, lambda c: F.when(F.abs(c * scale) <= limit, F.floor(c * scale)).otherwise(F.raise_error(fits).cast("long")))
    return data.where(F.coalesce(sound, F.lit(False))).select(F.col(id).alias("id"), whole.alias("x"))


def bisector_clusters(
    data: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: str = "2:", id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Rows (id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one a vector.

    Vectors have ``dim`` components that are all finite numbers; others take no part.
    Components become floor(scale * x).  Centroids start as the ``k`` vectors with the
    smallest SHA-256 of ``seed`` and id (all, if fewer), those without an id last, equal
    hashes by their components.  In each round all vectors go to the nearest centroid, the
    smaller number of two equally near, and each centroid with vectors moves to the floor of
    their mean; one without stays.  ``centroid_sha256`` is that of the final centroid's
    components joined by commas.  Repeated rows count and come back each time, rows with a
    null id too; further columns are ignored; an empty table gives no rows.  A component
    too large for a squared distance in a long is an error.
    """
    if k * k * dim * 8 > NORMAL_BYTES:
        raise ValueError(f"the normals of {k} centroids take more than {NORMAL_BYTES} bytes")
    spark = data.sparkSession
    context = spark.sparkContext
    rows = staged(_whole_numbers(data, id, vector, dim, scale))
    hashed = rows.withColumn("h", F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256))
    starts = hashed.orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()
    centroids = np.array([r["x"] for r in starts], dtype=np.int64).reshape(-1, dim)

    for _ in range(rounds if starts else 0):
        shared = context.broadcast(Bisectors(centroids))

        def add_up(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            bisectors = shared.value
            n, sums = np.zeros(len(bisectors.centroids), np.int64), np.zeros_like(bisectors.centroids)
            for batch in batches:
                vectors = _vectors(batch.column(0), dim)
                for at in range(0, len(vectors), BLOCK_ROWS):
                    x = vectors[at : at + BLOCK_ROWS]
                    cluster, _ = bisectors.nearest(x)
                    n += np.bincount(cluster, minlength=len(n))
                    order = np.argsort(cluster, kind="stable")
                    met, first = np.unique(cluster[order], return_index=True)
                    sums[met] += np.add.reduceat(x[order], first, axis=0)
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(n[met]), pa.array(list(sums[met]), pa.list_(pa.int64()))], names=["cluster", "n", "x"])

        parts = rows.select("x").mapInArrow(released(add_up), "cluster long, n long, x array<long>")
        place = parts.select("cluster", "n", F.posexplode("x").alias("place", "x"))
        whole = place.groupBy("cluster", "place").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n"))
        centroids = centroids.copy()
        for r in whole.collect():  # k * dim rows
            centroids[r["cluster"], r["place"]] = int(r["x"]) // r["n"]
        shared.unpersist()

    if not starts:
        return spark.createDataFrame([], f"`{id}` {rows.schema['id'].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    final = context.broadcast(Bisectors(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column(1), dim)
            for at in range(0, len(vectors), BLOCK_ROWS):
                x = vectors[at : at + BLOCK_ROWS]
                cluster, distance = final.value.nearest(x)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(x)), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    assigned = staged(rows.mapInArrow(released(assign), f"id {rows.schema['id'].dataType.simpleString()}, cluster int, distance long"))
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    inertia = int(sum(r["s"] for r in sums))
    told = spark.createDataFrame([(r["cluster"], int(r["s"]), inertia, names[r["cluster"]]) for r in sums], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(told), "cluster").select(F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
