"""Fuzzy line deduplication by MinHash (operator 7).

A line is the set of its character shingles.  Minima of random orders of the
shingles give signatures, bands of them open tiles; lines of one tile are verified
by their exact Jaccard similarity (tiles.py).  A shorter line loses too large a share
of its shingles to a single edit, so lines are also linked where one inserted, deleted
or replaced character, a twentieth of the line or less, is all they differ by; where
that does not follow from the similarity such pairs are found exactly.  Components
come from a distributed union-find, and one line of each component stays: the first
by document id and place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from placeweave.llm.shared import discard, member_filter, passes, released, staged
from placeweave.llm.text_arrays import _POWERS as POWERS
from placeweave.llm.text_arrays import mix64, text_buffer
from placeweave.llm.tiles import POSTINGS, Postings, bucket_count, open_tiles, similar_components

SHINGLE = 8
#: A pair of similarity s shares a tile with probability 1 - (1 - s**ROWS)**BANDS:
#: 0.9998 at 0.75, 0.99998 at 0.8, above 0.999999998 at 0.9.
BANDS, ROWS = 16, 3
#: An edit that is at most this share of the longer line is a link at every length; from
#: EDIT_SEEN characters on it leaves a similarity above 0.75, which the bands find.
EDIT_SHARE, EDIT_SEEN = 1 / 20, 80
#: Characters of a block, whose tables stay in a core's cache, and of it those whose shingles are hashed together.
_BLOCK_CHARS = 1 << 16
_CACHED_CHARS = 1 << 15
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Odd, so that a product is an order of all 32-bit hashes.
_FACTORS = (mix64(np.arange(101, BANDS * ROWS + 101, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_LINE_END = 10
#: Lines that are told of together.
_HELD_LINES = 1 << 14


_CODES = mix64(np.arange(256, dtype=np.uint64) + _ODD)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: A set's hashes have 52 bits; the 12 above hold the line's place while lines are sorted together.
_TOGETHER, _SET_BITS = 1 << 12, np.uint64(52)
#: From so many shingles a line on lines are sorted one by one.
_EACH = 64


class _Lines:
    """The non-blank lines of a block of documents, as arrays of code points."""

    def __init__(self, texts: list[str], number: int = 0) -> None:
        joined = "\n".join(texts) + "\n"
        try:  # a byte a character where all have code points below 256
            points = low = np.frombuffer(joined.encode("latin-1"), np.uint8)
            code = _CODES[points]
        except UnicodeEncodeError:
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            code, low = mix64(points.astype(np.uint64) + _ODD), points.astype(np.uint8)
        self.text = joined
        ends = np.flatnonzero(points == _LINE_END)
        starts = np.concatenate([[0], ends[:-1] + 1])
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        doc_starts = np.cumsum(lengths) - lengths
        doc = np.searchsorted(doc_starts, starts, side="right") - 1
        number = number + np.arange(len(starts)) - np.searchsorted(starts, doc_starts[doc])
        use = ~_BLANK[np.minimum(points[starts], 255)]
        for k in np.flatnonzero(~use).tolist():  # begins with a blank
            use[k] = not _BLANK[np.minimum(points[starts[k] : ends[k]], 255)].all()
        self.starts, self.ends, self.doc, self.number = starts[use], ends[use], doc[use], number[use]
        POWERS.need(len(code) + 1)
        self.inverse = POWERS.down
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(code) + 1, dtype=np.uint64)
            np.cumsum(code * POWERS.up[: len(code)], out=self.sums[1:])
            #: the low bytes of SHINGLE characters from each place on, and sums of what else they have
            self.eights = np.ndarray(max(0, len(low) - SHINGLE + 1), "<u8", low, strides=(1,))
            self.others = None
            if low is not points:
                self.others = np.zeros(len(code) + 1, dtype=np.uint64)
                np.cumsum(np.where(points < 256, np.uint64(0), code * POWERS.up[: len(code)]), out=self.others[1:])
            size = (self.ends - self.starts).astype(np.uint64)
            self.ids = mix64((self.sums[self.ends] - self.sums[self.starts]) * self.inverse[self.starts] + size * _ODD).view(np.int64)

    def line(self, k: int) -> str:
        return self.text[self.starts[k] : self.ends[k]]

    def _shingles(self, at: slice | np.ndarray) -> np.ndarray:
        """Hashes of the shingles that start at the given places, the same in any block."""
        found = self.eights[at].astype(np.uint64)
        if self.others is not None:
            with np.errstate(over="ignore"):
                found ^= mix64((self.others[SHINGLE:][at] - self.others[at]) * self.inverse[at])
        return _mixed(found)

    def _all_shingles(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, number of each line, where each line's begin) of lines of SHINGLE characters or more."""
        starts, stops = self.starts[which], self.ends[which] - SHINGLE + 1
        counts = stops - starts
        at = np.cumsum(counts) - counts
        low, high, total = int(starts.min()), int(stops.max()), int(counts.sum())
        if high - low > 2 * total:
            return self._shingles(np.arange(total) + np.repeat(starts - at, counts)), counts, at
        # most of a stretch of the text, which is read in a row
        hashes = self._shingles(slice(low, high))
        return np.concatenate([hashes[a:b] for a, b in zip((starts - low).tolist(), (stops - low).tolist(), strict=True)]), counts, at

    def _runs(self, which: np.ndarray) -> Iterator[slice]:
        """Some lines at a time, so that the passes over their shingles stay in a core's cache."""
        ends = np.cumsum(self.ends[which] - self.starts[which])
        first = 0
        while first < len(which):
            begun = ends[first - 1] if first else 0
            last = min(max(first + 1, int(np.searchsorted(ends, begun + _CACHED_CHARS, side="right"))), first + _TOGETHER, len(which))
            yield slice(first, last)
            first = last

    def long(self) -> np.ndarray:
        return np.flatnonzero(self.ends - self.starts >= SHINGLE)

    def bands(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys (lines x BANDS) and set sizes of lines of SHINGLE characters or more."""
        least, sizes = np.empty((BANDS * ROWS, len(which)), dtype=np.uint32), np.zeros(len(which), dtype=np.int64)
        for run in self._runs(which):
            hashes, counts, at = self._all_shingles(which[run])
            sizes[run] = _set_sizes(hashes, counts)
            short = (hashes >> np.uint64(32)).astype(np.uint32)
            del hashes
            mixed = np.empty_like(short)
            for k in range(BANDS * ROWS):
                np.multiply(short, _FACTORS[k], out=mixed)
                np.minimum.reduceat(mixed, at, out=least[k, run])
        keys = np.zeros((BANDS, len(which)), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(BANDS * ROWS):
                keys[k // ROWS] = (keys[k // ROWS] + least[k] + np.uint64(1)) * _ODD
            keys = mix64(keys.T + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
        return keys, sizes

    def sets(self, which: np.ndarray) -> list[np.ndarray]:
        """The sorted distinct shingle hashes of lines of SHINGLE characters or more."""
        return [x for run in self._runs(which) for x in _sorted_sets(*self._all_shingles(which[run])[:2])]

    def short(self) -> np.ndarray:
        size = self.ends - self.starts
        return np.flatnonzero((size * EDIT_SHARE >= 1) & (size <= EDIT_SEEN))

    def halves(self, which: np.ndarray) -> np.ndarray:
        """Four keys a line: two lines that differ by one edit share one or more.

        An edit of the longer of two lines, of n characters, leaves its first n // 2
        or its other characters as they are; a line may be the longer or the shorter.
        """
        starts, ends = self.starts[which], self.ends[which]
        keys = np.zeros((len(which), 4), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(2):
                n = ends - starts + k
                first, rest = n // 2, n - n // 2
                for side, (a, b) in enumerate(((starts, starts + first), (ends - rest, ends))):
                    tag = (2 * n + side).astype(np.uint64) * _ODD
                    keys[:, 2 * k + side] = mix64((self.sums[b] - self.sums[a]) * self.inverse[a] + tag)
        return keys.view(np.int64)

    def edits(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, what is left at one place, what is left) of lines without one character each.

        The first key is shared by lines that differ at that place only; the second
        is the id of the line that is left.
        """
        starts, ends = self.starts[which], self.ends[which]
        counts = ends - starts
        owner = np.repeat(np.arange(len(which)), counts)
        place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        s, e, at = starts[owner], ends[owner], starts[owner] + place
        with np.errstate(over="ignore"):
            left = ((self.sums[at] - self.sums[s]) + (self.sums[e] - self.sums[at + 1]) * self.inverse[1]) * self.inverse[s]
            size = counts[owner].astype(np.uint64)
            rest = mix64(left + (size - np.uint64(1)) * _ODD).view(np.int64)
            here = mix64((rest.view(np.uint64) + place.astype(np.uint64)) * _ODD).view(np.int64)
        return self.ids[which][owner], here, rest


def _mixed(x: np.ndarray) -> np.ndarray:
    """``mix64(x)`` in the place of x."""
    y = np.empty_like(x)
    with np.errstate(over="ignore"):
        x ^= np.right_shift(x, np.uint64(31), out=y)
        x *= np.uint64(0x7FB5D329728EA185)
        x ^= np.right_shift(x, np.uint64(27), out=y)
        x *= np.uint64(0x81DADEF4BC2DD44D)
        x ^= np.right_shift(x, np.uint64(33), out=y)
    return x


def _in_order(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of each line in order, cut to _SET_BITS, which are new in it, where each line begins) of at most _TOGETHER lines."""
    at = np.cumsum(counts) - counts
    part = hashes >> np.uint64(12)
    if len(part) < _EACH * len(counts):  # short lines are sorted together
        part |= np.repeat(np.arange(len(counts), dtype=np.uint64) << _SET_BITS, counts)
        part.sort()
        part &= np.uint64((1 << 52) - 1)
    else:
        for first, n in zip(at.tolist(), counts.tolist(), strict=True):
            part[first : first + n].sort()
    fresh = np.ones(len(part), dtype=bool)
    np.not_equal(part[1:], part[:-1], out=fresh[1:])
    fresh[at] = True
    return part, fresh, at


def _sorted_sets(hashes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct hashes, cut to _SET_BITS, of each of at most _TOGETHER lines."""
    part, fresh, at = _in_order(hashes, counts)
    part, ends = part[fresh], np.cumsum(np.add.reduceat(fresh, at, dtype=np.int64)).tolist()
    return [part[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _set_sizes(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The number of distinct hashes, cut to _SET_BITS, in each of at most _TOGETHER lines."""
    _, fresh, at = _in_order(hashes, counts)
    return np.add.reduceat(fresh, at, dtype=np.int64)


def line_sets(bodies: list[bytes]) -> list[np.ndarray]:
    """The shingle sets of lines given as UTF-8, each of SHINGLE characters or more."""
    found: list[np.ndarray] = []
    texts, chars = [], 0
    for k, body in enumerate(bodies):
        texts.append(body.decode())
        chars += len(body)
        if chars >= _BLOCK_CHARS or k == len(bodies) - 1:
            found += _Lines(texts).sets(np.arange(len(texts)))
            texts, chars = [], 0
    return found


def _line_blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, _Lines]]:
    """(first row, lines) of blocks of documents of a batch (doc, text).

    A longer document comes in pieces that end where lines end, so only a very long
    line is held whole.
    """
    _, offsets = text_buffer(batch.column(1))
    texts = batch.column(1).fill_null("")
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _BLOCK_CHARS, side="right")) - 1)
        if offsets[last] - offsets[first] <= _BLOCK_CHARS:
            yield first, _Lines(texts.slice(first, last - first).to_pylist())
        else:
            number = 0
            for piece in _pieces(texts[first].as_py()):
                yield first, _Lines([piece], number)
                number += piece.count("\n") + 1
                POWERS.shrink()
        first = last


def _pieces(text: str) -> Iterator[str]:
    """A text in parts of about _BLOCK_CHARS that end before line ends."""
    at = 0
    while at <= len(text):
        end = text.rfind("\n", at, at + _BLOCK_CHARS) if len(text) - at > _BLOCK_CHARS else len(text)
        if end < 0:
            end = text.find("\n", at + _BLOCK_CHARS)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end + 1


_SCAN = f"doc long, number int, line long, halves array<long>, {POSTINGS}"
_NEEDED = "kind int, key long, id long, body binary"
_REPLACED, _SHORTENED, _WHOLE, _BODY = range(4)


def _widened(schema: StructType, columns: dict[str, pa.Array], rows: int) -> pa.RecordBatch:
    names = schema.fieldNames()
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(rows, to_arrow_type(f.dataType)) for f in schema], names=names)


def _scan(docs: DataFrame) -> DataFrame:
    """One pass over the texts: a row for each line, and the postings of the bands."""
    buckets, schema = bucket_count(docs), StructType.fromDDL(_SCAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Postings(buckets)

        def wide(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in found:
                yield _widened(schema, dict(zip(x.schema.names, x.columns, strict=True)), x.num_rows)

        held: list[tuple[np.ndarray, ...]] = []

        def told() -> Iterator[pa.RecordBatch]:
            if held:
                doc, number, ids, counts, keys = (np.concatenate(x) for x in zip(*held, strict=True))
                held.clear()
                halves = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(keys))
                own = {"doc": pa.array(doc), "number": pa.array(number), "line": pa.array(ids), "halves": halves}
                yield _widened(schema, own, len(ids))

        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            yield from told()
            for first, lines in _line_blocks(batch):
                short = lines.short()
                counts = np.zeros(len(lines.ids), dtype=np.int32)
                counts[short] = 4
                held.append((doc[first + lines.doc], lines.number.astype(np.int32), lines.ids, counts, lines.halves(short).ravel()))
                if sum(len(x[2]) for x in held) >= _HELD_LINES:
                    yield from told()
                which = lines.long()
                _, once = np.unique(lines.ids[which], return_index=True)
                which = which[np.sort(once)]  # in the order of the text
                if packer.seen:  # posted by this task before
                    which = which[[x not in packer.seen for x in lines.ids[which].tolist()]]
                if len(which):
                    ids = lines.ids[which]
                    keys, size = lines.bands(which)
                    yield from wide(packer.add(ids, size, ids, keys.ravel(), np.full(len(which), BANDS)))
        yield from told()
        yield from wide(packer.close())

    return docs.mapInArrow(released(run), _SCAN)


def _needed(docs: DataFrame, tiled: np.ndarray, halves: np.ndarray) -> DataFrame:
    """A second pass: the lines that may be in a tile, and the short ones that may
    share a half with another, without one character each."""
    shared, schema = docs.sparkSession.sparkContext.broadcast((tiled, halves)), StructType.fromDDL(_NEEDED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiled, halves = shared.value
        seen: set[int] = set()
        bodies: list[tuple[np.ndarray, list[bytes]]] = []

        def told() -> Iterator[pa.RecordBatch]:
            if bodies:
                id = np.concatenate([x for x, _ in bodies])
                own = {"id": pa.array(id), "body": pa.array([x for _, part in bodies for x in part], pa.binary()), "kind": pa.array(np.full(len(id), _BODY, np.int32))}
                bodies.clear()
                yield _widened(schema, own, len(id))

        for batch in batches:
            yield from told()
            for _, lines in _line_blocks(batch):
                _, once = np.unique(lines.ids, return_index=True)
                once = once[[x not in seen for x in lines.ids[once].tolist()]] if seen else once
                if len(seen) > 1 << 18:
                    seen.clear()
                seen.update(lines.ids[once].tolist())
                hit = once[passes(tiled, lines.ids[once]) & (lines.ends[once] - lines.starts[once] >= SHINGLE)]
                if len(hit):
                    bodies.append((lines.ids[hit], [lines.line(k).encode() for k in hit]))
                if sum(len(x) for x, _ in bodies) >= _HELD_LINES:
                    yield from told()
                which = np.intersect1d(once, lines.short())
                if len(which):
                    which = which[passes(halves, lines.halves(which).ravel()).reshape(-1, 4).any(axis=1)]
                if len(which):
                    id, here, rest = lines.edits(which)
                    own = lines.ids[which]
                    kind = np.repeat(np.array([_REPLACED, _SHORTENED, _WHOLE], dtype=np.int32), [len(id), len(id), len(own)])
                    rows = {"kind": pa.array(kind), "key": pa.array(np.concatenate([here, rest, own])), "id": pa.array(np.concatenate([id, id, own]))}
                    yield _widened(schema, rows, len(kind))
        yield from told()

    return docs.mapInArrow(released(run), _NEEDED)


def _edited(parts: DataFrame) -> DataFrame:
    """Links (a, b) between short lines that differ by one edit.

    Of lines that differ at one place each is linked with the least, so no pairs are
    enumerated.
    """
    place = parts.where(F.col("kind") == _REPLACED).select("key", "id")
    least = place.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("hi")).where("a <> hi")
    replaced = place.join(least, "key").where("id <> a").select("a", F.col("id").alias("b"))
    whole = parts.where(F.col("kind") == _WHOLE).select("key").distinct()
    inserted = parts.where(F.col("kind") == _SHORTENED).select("key", "id").join(whole, "key").select(F.col("key").alias("a"), F.col("id").alias("b"))
    return replaced.unionByName(inserted)


def line_components(docs: DataFrame, num: int = 3, den: int = 4) -> tuple[DataFrame, DataFrame]:
    """((doc, number, line) of all non-blank lines, (id, component) of similar ones).

    ``docs``: (doc, text).  ``line`` is a 64-bit id of the line's characters.  Texts
    are read twice: for ids and bands, and for the lines that bands brought together.
    """
    scanned = staged(_scan(docs))
    lines = scanned.where("line is not null").select("doc", "number", "line", "halves")
    tiles = staged(open_tiles(scanned.where("bucket is not null").select(*StructType.fromDDL(POSTINGS).fieldNames()), num, den))
    keys = lines.where("size(halves) > 0").select(F.explode("halves").alias("key"), "line")
    common = staged(keys.groupBy("key").agg(F.min("line").alias("lo"), F.max("line").alias("hi")).where("lo <> hi").select("key"))
    tiled = staged(tiles.select("id").unionByName(tiles.where("other is not null").select(F.col("other").alias("id"))).distinct())
    parts = staged(_needed(docs, member_filter(tiled, "id"), member_filter(common, "key")))
    bodies = staged(parts.where(F.col("kind") == _BODY).join(tiled, "id", "left_semi").groupBy("id").agg(F.first("body").alias("body")))
    edits = staged(_edited(parts))
    discard(common, tiled, parts)
    found = staged(similar_components(tiles, lambda _: bodies, line_sets, num, den, edits))
    discard(tiles, bodies, edits)
    return lines.drop("halves"), found


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", num: int = 3, den: int = 4) -> DataFrame:
    """``docs`` with n_lines, n_dropped and the text without repeated lines.

    Lines end at ``\\n``.  Of lines that are equal, or linked by a Jaccard similarity
    of num/den or more over SHINGLE characters, or by one inserted, deleted or replaced
    character that is at most EDIT_SHARE of each, the one with
    the smallest (id, place) stays and the others go, with their line ends.  Lines
    of fewer than SHINGLE characters match equal ones only; blank lines stay.  Null and empty
    texts stay as they are; rows with a null id are returned unchanged and take no
    part; rows of one id are one document and lose the same lines.  ``n_lines``
    counts all lines.  Columns of ``docs`` named like an added one are replaced.
    """
    known = docs.where(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("doc"), F.col(text).alias("text"))
    lines, found = line_components(known, num, den)
    # a document and a line's number there as one number, of which a hash aggregate keeps the least
    ids = known.agg(F.min("doc").alias("least"), F.max("doc").alias("most")).first()
    narrow = ids["least"] is None or (ids["least"] >= -(1 << 31) and ids["most"] < 1 << 31)
    place = F.col("doc").cast("long" if narrow else "decimal(20,0)") * F.lit(1 << 31) + F.col("number")
    each = lines.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    each = each.join(found.withColumnRenamed("id", "line"), "line", "left").where("n > 1 or component is not null").select("line", "first", F.coalesce("component", "line").alias("c"))
    each = staged(each)  # read twice
    groups = each.groupBy("c").agg(F.min("first").alias("first"))
    kept_line = each.select("line", "c").join(groups, "c").select("line", "first")
    gone = lines.join(kept_line, "line").where(place != F.col("first"))
    per_doc = gone.groupBy(F.col("doc").alias("__doc")).agg(F.collect_set("number").alias("__gone"))  # of one document
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    parts = F.split(F.col(text), "\n", -1)
    return (
        docs.select(*kept)
        .join(per_doc.hint("shuffle_hash"), F.col(id) == F.col("__doc"), "left")
        .withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1))
        .withColumn("n_dropped", F.coalesce(F.size("__gone"), F.lit(0)))
        .withColumn(text, F.when(F.col("__gone").isNotNull(), _without(parts, F.col("__gone"))).otherwise(F.col(text)))
        .select(*kept, "n_lines", "n_dropped")
    )


def _without(parts: F.Column, gone: F.Column) -> F.Column:
    """The parts whose numbers are not gone, joined again, in time linear in their number."""
    left = F.transform(F.array(parts), lambda p: F.transform(F.array_except(F.sequence(F.lit(0), F.size(p) - 1), gone), lambda k: F.get(p, k)))
    return F.array_join(F.element_at(left, 1), "\n")
