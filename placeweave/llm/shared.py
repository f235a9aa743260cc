"""Bounded membership filters and distributed components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.session import discard, shared_folder, staged

__all__ = ["components", "discard", "member_filter", "passes", "released", "shared_folder", "shuffle_width", "staged"]

#: Least and most bits of a membership filter, 16 for each id between: two megabytes at most.
LEAST_BITS, MOST_BITS = 1 << 18, 1 << 24
_BITMAP_BITS = 32_768
Batches = Iterator[pa.RecordBatch]


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, with its worker's free memory given back to the system at the end."""

    def call(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # only where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return call


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _filter_slot(column: str, bits: int) -> F.Column:
    return F.pmod(F.col(column).bitwiseXOR(F.shiftright(column, 23)), F.lit(bits))


def passes(found: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids may be in the filter, inside a task."""
    bits = (len(found) - 2) * _BITMAP_BITS
    part, bit = _bucket((ids ^ (ids >> 23)) % bits)
    return ((found[part, bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)


def member_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A bit per hashed id: at most MOST_BITS bits reach the driver.

    Ids that are absent may pass (the more, the more ids there are), ids that
    are present always do; an exact join has to follow.
    """
    bits = LEAST_BITS
    wanted = 16 * ids.count()
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    slot = _filter_slot(column, bits)
    rows = (
        ids.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()
    )
    found = np.zeros((bits // _BITMAP_BITS + 2, _BITMAP_BITS // 8), dtype=np.uint8)
    for row in rows:
        found[row["part"]] |= np.frombuffer(row["bits"], dtype=np.uint8)
    return found


def _bucket(slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What bitmap_bucket_number and bitmap_bit_position give for slots >= 0."""
    part = np.where(slot > 0, 1 + (slot - 1) // _BITMAP_BITS, 0)
    bit = np.where(slot > 0, (slot - 1) % _BITMAP_BITS, -slot % _BITMAP_BITS)
    return part, bit


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): the smallest id it reaches.

    Alternates large-star and small-star steps (Kiveris et al., "Connected
    components in MapReduce and beyond", SoCC 2014) until no edge changes.  Each
    round is a few joins over the edges alone, staged in the shared folder; the
    driver sees one count and one checksum.  Self-loops and nulls are ignored,
    repeated edges count once.
    """
    now = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if seen["n"] == 0 or (before is not None and (seen["n"], seen["s"]) == before):
            break
        before = (seen["n"], seen["s"])
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(now).groupBy("u", "v").agg(F.lit(1).alias("one")).drop("one")
        last, now = now, staged(_stars(large))
        discard(last)
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _stars(edges: DataFrame) -> DataFrame:
    """Small-star: every id and its smaller neighbours point to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
