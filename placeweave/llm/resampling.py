"""Importance resampling towards a target distribution (operator 13).

Runs of words are hashed into buckets.  The counts of all documents and of all
target texts give each bucket a whole-number gain, which is cut into bit planes over
the buckets, the last of them that of the sign.  The bucket counts of a document
become bit planes as well; its weight is the sum of the bits that two planes share,
times the power of two of the pair.  Scores add a Gumbel draw from a hash of the id,
so the highest are a sample without replacement in proportion to exp(weight / 1000).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeweave.llm.shared import released, staged
from placeweave.llm.text_arrays import blocks, text_buffer

#: Bytes of a text that are split into words at once.
PIECE_BYTES = 1 << 20
#: Documents whose planes are held at once.
BLOCK_DOCS = 64

#: A-Z as a-z; all bytes that are no letter, digit or part of a longer character as spaces.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def word_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about PIECE_BYTES; no word is cut."""
    at = 0
    while at < len(text):
        piece = text[at : at + PIECE_BYTES].translate(_WORD_BYTES)
        end = at + len(piece)
        while end < len(text) and piece[-1] != 32:  # up to the end of the word
            more = text[end : end + PIECE_BYTES].translate(_WORD_BYTES)
            stop = more.find(b" ")
            piece += more if stop < 0 else more[: stop + 1]
            end = at + len(piece)
        yield piece.split()
        at = end


def feature_buckets(text: bytes, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """(words, bucket of each feature) of a text: all runs of 1 to ``longest`` words."""
    n, found, before = 0, [], []
    for words in word_pieces(text):
        n += len(words)
        found.append(np.fromiter(map(crc32, words), np.uint32, len(words)))
        if longest > 1:
            both = before + words
            for size in range(2, longest + 1):
                runs = list(map(b" ".join, zip(*(both[max(0, len(before) - size + 1) + k :] for k in range(size)), strict=False)))
                found.append(np.fromiter(map(crc32, runs), np.uint32, len(runs)))
            before = both[len(both) - longest + 1 :] if len(both) >= longest else both
    return n, np.concatenate(found) % np.uint32(buckets) if found else np.zeros(0, np.uint32)


def bucket_totals(texts: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """How many features of all texts each bucket holds: a number a bucket reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            raw, ends = text_buffer(batch.column(0))
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                sums += np.bincount(feature_buckets(raw[a:b].tobytes(), longest, buckets)[1], minlength=buckets)
        met = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(sums[met])], names=["bucket", "n"])

    parts = texts.select(F.col(text).cast("string")).mapInArrow(released(run), "bucket long, n long")
    totals = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[r["bucket"]] = r["n"]
    return totals


def bucket_gains(held: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share of a bucket in the target over that in the documents)."""
    buckets, of_held, of_target = len(held), float(held.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (of_held + buckets) / ((s + 1) * (of_target + buckets)))) for s, t in zip(held.tolist(), target.tolist(), strict=True)], np.int64)


def _set_bits(at: np.ndarray, words: int) -> np.ndarray:
    """``words`` 64-bit words with the bits at the given ascending places."""
    out = np.zeros(words, np.uint64)
    if len(at):
        word = at >> 6
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
    return out


def gain_planes(gains: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(factor, plane) of the bits of the gains in two's complement; the sign's factor is negative."""
    bits = max(int(np.abs(gains).max()).bit_length(), 1)
    words = -(-len(gains) // 64)
    return [(1 << q if q < bits else -(1 << bits), _set_bits(np.flatnonzero((gains >> q) & 1), words)) for q in range(bits + 1)]


def count_planes(doc: np.ndarray, bucket: np.ndarray, docs: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(factor, planes) of the bits of the bucket counts of ``docs`` documents."""
    words = -(-buckets // 64)
    place, n = np.unique(doc * (words * 64) + bucket, return_counts=True)
    for p in range(int(n.max()).bit_length() if len(n) else 0):
        yield 1 << p, _set_bits(place[(n >> p) & 1 == 1], docs * words).reshape(docs, words)


def sliced_sums(doc: np.ndarray, bucket: np.ndarray, docs: int, gains: list[tuple[int, np.ndarray]], buckets: int) -> np.ndarray:
    """The sum of the gains of each document's features, by bits that planes share."""
    sums = np.zeros(docs, np.int64)
    for times, planes in count_planes(doc, bucket, docs, buckets):
        for factor, plane in gains:
            sums += times * factor * np.bitwise_count(planes & plane).sum(axis=1, dtype=np.int64)
    return sums


def gumbel(id: str, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(docs: DataFrame, id: str, text: str, gains: np.ndarray, longest: int, seed: int) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every document."""
    buckets = len(gains)
    shared = docs.sparkSession.sparkContext.broadcast(gain_planes(gains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = text_buffer(batch.column(1))
            for first, last in blocks(ends):
                for at in range(first, last, BLOCK_DOCS):
                    rows = range(at, min(at + BLOCK_DOCS, last))
                    found = [feature_buckets(raw[ends[k] : ends[k + 1]].tobytes(), longest, buckets) for k in rows]
                    n = np.array([len(b) for _, b in found], np.int64)
                    doc, bucket = np.repeat(np.arange(len(found)), n), np.concatenate([b for _, b in found]).astype(np.int64)
                    weight = sliced_sums(doc, bucket, len(found), shared.value, buckets) // np.maximum(n, 1)
                    ids = batch.column(0).slice(at, len(found))
                    drawn = np.array([gumbel("" if x is None else str(x), seed) for x in ids.to_pylist()], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([w for w, _ in found], pa.int64()), pa.array(n), pa.array(weight), pa.array(weight + drawn)],
                        names=["id", "n_words", "n_features", "weight", "score"],
                    )

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(released(run), "id long, n_words long, n_features long, weight long, score long")


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
    id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """Rows (id, n_features, weight, score, rank), one for each row of ``docs``.

    A-Z are lower-cased; words are runs of letters a-z, digits and characters beyond ASCII,
    features all runs of 1 to ``longest`` words.  ``weight`` is the floored mean gain of a
    document's features, 0 without any.  Of the documents with ``least_words`` words the
    floor(percent * N / 100) highest scores are drawn and ranked from 1, ties to the smaller id;
    for others ``rank`` is null.  A null text has no features.  A null id hashes as an empty
    one and comes before others of its score; repeated ids are drawn each for itself, in any
    order among equal rows.  Empty tables give no rows, or gains over no features.  Further columns are ignored.
    """
    gains = bucket_gains(bucket_totals(docs, text, longest, buckets), bucket_totals(target, target_text, longest, buckets))
    rows = staged(_scored(docs, id, text, gains, longest, seed))
    can = F.col("n_words") >= least_words
    # whole-number scores lie in a fixed range (gains and draws are logarithms of longs), so this is a bounded table
    by_score = sorted(((r["score"], r["n"]) for r in rows.where(can).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted, above, starts = percent * sum(n for _, n in by_score) // 100, 0, []
    for score, n in by_score:
        if above >= wanted:
            break
        starts.append((score, above))
        above += n
    cut = starts[-1][0] if starts else None
    high = can & (F.col("score") >= cut) if starts else F.lit(False)
    ahead = docs.sparkSession.createDataFrame(starts, "score long, ahead long")
    place = F.row_number().over(Window.partitionBy("score").orderBy("id", "n_features", "weight"))
    drawn = rows.where(high).join(F.broadcast(ahead), "score").withColumn("rank", F.col("ahead") + place)
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    out = drawn.select("id", "n_features", "weight", "score", "rank").unionByName(rows.where(~high).select("id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank")))
    return out.withColumnRenamed("id", id)
