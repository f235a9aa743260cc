"""N-gram Jaccard join of whole documents (operator 1).

Shingles of five words are hashed to 64 bits.  The candidate tiles come from an
exact prefix filter: two sets of similarity t or more share one of the first
``n - ceil(t n) + 1`` shingles of each in any common order of shingles.  The order
puts frequent shingles last (a bounded summary of the whole corpus says which),
so a passage that very many documents share opens no tile for most of them.  In
size-banded tiles, bit counts of hashed bitmaps bound the overlap from above
before the sorted arrays are intersected; see tiles.py.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm.shared import discard, passes, released, staged
from placeweave.llm.text_arrays import set_digest, shingle_sets
from placeweave.llm.tiles import BODIES, ITEMS, POSTINGS, Postings, bitmap, bucket_count, hash_arrays, link_counts, open_tiles, similar_components

#: Most shingles that count as frequent; the broadcast is 16 bytes for each.
FREQUENT = 1 << 18
#: Rarer shingles are never moved.
FREQUENT_FROM = 12
_SUMMARY = 1 << 17
_BUFFER = 1 << 21
#: Prefixes hold the smallest hashes of a set, so only the lower half is counted.
_LOWER_HALF = np.uint64(1 << 63)


def _summary(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """A task's most frequent shingles, with counts that are too low by a bounded error."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    held: list[np.ndarray] = []
    size = 0

    def fold() -> None:
        nonlocal keys, counts, held, size
        new, at = np.unique(np.concatenate(held), return_counts=True)
        more = at > 1
        new, at = np.concatenate([keys, new[more]]), np.concatenate([counts, at[more]])
        keys, where = np.unique(new, return_inverse=True)
        counts = np.bincount(where, weights=at).astype(np.int64)
        if len(keys) > _SUMMARY:
            top = np.argpartition(-counts, _SUMMARY)[:_SUMMARY]
            keys, counts = keys[top], counts[top]
        held, size = [], 0

    for batch in batches:
        for _, hashes in shingle_sets(batch.column(0), width):
            hashes = hashes[: np.searchsorted(hashes, _LOWER_HALF)]
            held.append(hashes)
            size += len(hashes)
            if size >= _BUFFER:
                fold()
    if held:
        fold()
    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["h", "c"])


def frequent_shingles(docs: DataFrame, text: str = "text", width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, their rank by frequency) of at most FREQUENT shingles.

    Only the order of work depends on it, never the result.
    """
    found = (
        docs.select(text)
        .mapInArrow(released(lambda batches: _summary(batches, width)), "h long, c long")
        .groupBy("h")
        .agg(F.sum("c").alias("c"))
        .where(F.col("c") >= FREQUENT_FROM)
        .orderBy(F.desc("c"), "h")
        .limit(FREQUENT)
        .toArrow()
    )
    hashes = found.column("h").to_numpy().view(np.uint64)
    rank = np.arange(len(hashes), 0, -1)
    order = np.argsort(hashes)
    return hashes[order], rank[order]


def _prefix(hashes: np.ndarray, length: int, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    if len(frequent) == 0:
        return hashes[:length]
    at = np.searchsorted(frequent, hashes)
    at[at == len(frequent)] = 0
    often = frequent[at] == hashes
    if not often.any():
        return hashes[:length]
    rare = hashes[~often]
    if len(rare) >= length:
        return rare[:length]
    return np.concatenate([rare, hashes[often][np.argsort(rank[at[often]])][: length - len(rare)]])


def ngram_jaccard_join(
    docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 5, num: int = 3, den: int = 4, count_links: bool = True
) -> DataFrame:
    """Rows (id, n_shingles, component_id, n_links) of the links with similarity num/den or more.

    Words are runs of bytes other than space and \\t..\\r, A-Z counted as a-z; a
    document's set are its distinct shingles of ``width`` words, with fewer words
    the whole sequence.  ``n_links`` is the number of other rows a row is linked
    with, copies included; without ``count_links`` it is left out, and pairs inside a
    component are no longer compared.  Null and empty texts have the empty set and no links.
    Repeated rows and repeated ids each give a row; rows of one id are one
    document to the components.  Rows with a null id keep a null component and
    take no part.  An empty table gives no rows; further columns are ignored.
    """
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    known = rows.where("id is not null")
    buckets = bucket_count(docs)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(frequent_shingles(known, "text", width))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = shared.value
        packer = Postings(buckets)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            at, sizes, digests, keys, counts, held = [], [], [], [], [], 0
            for row, hashes in shingle_sets(batch.column(1), width):
                n = len(hashes)
                key = _prefix(hashes, n - -(-num * n // den) + 1, frequent, rank) if n else hashes
                at.append(row)
                sizes.append(n)
                # an empty set equals no other: its digest is its own
                digests.append(set_digest(hashes) if n else int(ids[row]))
                keys.append(key)
                counts.append(len(key))
                held += len(key)
                if held > 1 << 18:
                    yield from packer.add(*_chunk(ids, at, sizes, digests, keys, counts))
                    at, sizes, digests, keys, counts, held = [], [], [], [], [], 0
            if at:
                yield from packer.add(*_chunk(ids, at, sizes, digests, keys, counts))
        yield from packer.close()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            held = []
            for row, hashes in shingle_sets(batch.column(1), width):
                n = len(hashes)
                held.append((int(ids[row]), n, set_digest(hashes) if n else int(ids[row]), bitmap(hashes)))
            yield _batch(held, ["id", "n", "digest", "bits"])

    def bodies(found: np.ndarray) -> DataFrame:
        wanted = context.broadcast(found)

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                hit = passes(wanted.value, ids)
                ids, texts = ids[hit], batch.column(1).filter(pa.array(hit))
                held, size = [], 0
                for row, hashes in shingle_sets(texts, width):
                    held.append((int(ids[row]), set_digest(hashes), hashes.tobytes()))
                    size += len(hashes)
                    if size > 1 << 18:
                        yield _batch(held, ["id", "digest", "body"])
                        held, size = [], 0
                if held:
                    yield _batch(held, ["id", "digest", "body"])

        return known.mapInArrow(released(sets), BODIES)

    items = staged(known.mapInArrow(released(describe), ITEMS))
    tiles = staged(open_tiles(known.mapInArrow(released(post), POSTINGS), num, den))
    classes = items.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("weight"), F.first("n").alias("n"))
    classes = staged(classes)
    copies = items.join(classes.where("weight > 1").select("digest", "first"), "digest").where("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b"))
    found = staged(similar_components(tiles, bodies, hash_arrays, num, den, copies, items))
    discard(tiles)
    if not count_links:
        joined = items.join(found, "id", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
        nulls = rows.where("id is null").select("id", *[F.lit(None).cast("long").alias(c) for c in ("n_shingles", "component_id")])
        return joined.unionByName(nulls).withColumnRenamed("id", id)
    members = classes.where("n > 0").join(found, F.col("first") == F.col("id")).select(F.col("first").alias("id"), "digest", "n", F.col("component").alias("c"), "weight")
    counted = link_counts(members, bodies, hash_arrays, num, den)
    # other texts, and the other copies of its own
    links = F.when(F.col("n") > 0, F.coalesce("links", F.lit(0)) + F.col("weight") - 1).otherwise(0).cast("long")
    known_classes = classes.join(counted, "digest", "left").select("digest", F.col("first").alias("leader"), links.alias("n_links"))
    joined = items.join(known_classes, "digest").join(found.withColumnRenamed("id", "leader"), "leader", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "leader").alias("component_id"), "n_links"
    )
    nothing = F.lit(None).cast("long")
    nulls = rows.where("id is null").select("id", nothing.alias("n_shingles"), nothing.alias("component_id"), nothing.alias("n_links"))
    return joined.unionByName(nulls).withColumnRenamed("id", id)


def _chunk(ids, at, sizes, digests, keys, counts):
    return ids[at], np.array(sizes, np.int64), np.array(digests, np.int64), np.concatenate(keys), np.array(counts)


def _batch(held: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"bits": pa.binary(), "body": pa.binary()}
    cells = zip(*held, strict=True) if held else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(x), kinds.get(k, pa.int64())) for x, k in zip(cells, names, strict=True)], names=names)


def without_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    found = ngram_jaccard_join(docs, id, text, count_links=False).where(F.col(id) != F.col("component_id")).select(id).distinct()
    return docs.join(found, id, "left_anti")
