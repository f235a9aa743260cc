"""Set-similarity links from tiles: who shares a key, bounded, then verified.

An item is a set of 64-bit hashes under a 64-bit id.  ``Postings`` packs the keys
of many items as a few binary rows per task and bucket, so a shuffle moves plain
arrays instead of millions of rows.  Items that share a key form a tile; inside a
tile, items are banded by size, since two sets of very different sizes cannot be
similar.  Three steps find every link with no pair enumeration inside a group of
copies:

1. every item of a tile is paired with one leader of its size band;
2. pairs are bounded from above by the bit counts of hashed bitmaps, survivors
   are verified by intersecting the sorted arrays, links give components;
3. only items of one tile that are still in different components are compared,
   in cells of bounded size: by bitmaps first, then exactly, and a cell gives at
   most one link for each item, so no pairs leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm.shared import components, discard, member_filter, released, shuffle_width, staged
from placeweave.llm.text_arrays import mix64

#: Keys with the place of their item in the lists of ids (from ``base`` on) and sizes;
#: whole numbers take as few bytes as the row's largest needs, keys KEY_BYTES: two keys of
#: one bucket that agree in those only open a tile more.
KEY_BYTES = 5
POSTINGS = "bucket int, keys binary, owners binary, base long, items long, ids binary, sizes binary"
ITEMS = "id long, n long, digest long, bits binary"
BODIES = "id long, digest long, body binary"
#: Items and elements of a part of a cell, about; a larger tile is cut into parts that meet.
CELL_ITEMS, CELL_ELEMENTS = 2048, 1 << 21
#: Cells of so many items are verified without bounding first.
FEW = 8
#: Gives the rows (ITEMS or BODIES) of the ids that pass a membership filter.
Fetch = Callable[[np.ndarray], DataFrame]
#: Gives the sorted distinct hashes of each body.
Sets = Callable[[list[bytes]], list[np.ndarray]]
#: Cells of at most so many items, each of at most so many elements, are bounded together
#: by bitmaps of SMALL_BITS, FLUSH_PAIRS pairs at a time.
SMALL_ITEMS, SMALL_ELEMENTS, SMALL_BITS, FLUSH_PAIRS = 128, 1024, 2048, 1 << 12
_TRIANGLES = [np.triu_indices(m, 1) for m in range(SMALL_ITEMS + 1)]
FLUSH_KEYS = 1 << 20
FLUSH_ITEMS = 1 << 16


def hash_arrays(bodies: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in bodies]


class Postings:
    """Packs chunks of (ids, sizes, digests, keys, number of keys of each id).

    Items of the same digest are the same set; within a task only the first is
    posted, so a set that fills a third of the corpus arrives once per task.
    """

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.seen: set[int] = set()
        self.held: list[tuple] = []
        self.keys = self.items = 0

    def add(self, *chunk: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append(chunk)
        self.keys += len(chunk[3])
        self.items += len(chunk[0])
        if self.keys >= FLUSH_KEYS or self.items >= FLUSH_ITEMS:
            yield from self.close()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield from _pack(self.held, self.seen, self.buckets)
        self.held, self.keys, self.items = [], 0, 0
        if len(self.seen) > 4 * FLUSH_ITEMS:
            self.seen.clear()


def _pack(held: list[tuple], seen: set[int], buckets: int) -> Iterator[pa.RecordBatch]:
    ids, sizes, digests, keys, counts = (np.concatenate(x) for x in zip(*held, strict=True))
    fresh = np.zeros(len(ids), dtype=bool)
    _, first = np.unique(digests, return_index=True)
    fresh[first] = True
    if seen:
        fresh &= np.fromiter((d not in seen for d in digests.tolist()), dtype=bool, count=len(digests))
    seen.update(digests[fresh].tolist())
    owner = np.repeat(np.arange(len(ids), dtype=np.uint32), counts)
    use = fresh[owner]
    owner, keys = owner[use], keys[use]
    part = (mix64(keys) % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int32)
    order = np.argsort(part, kind="stable")
    owner, keys, part = owner[order], keys[order], part[order]
    edges = np.searchsorted(part, np.arange(buckets + 1))
    rows: list[tuple] = []
    for b in range(buckets):
        s = slice(edges[b], edges[b + 1])
        if s.start < s.stop:
            fresh = _fresh(owner[s])  # owners ascend
            who, at = owner[s][fresh], np.cumsum(fresh) - 1
            own, least = ids[who], int(ids[who].min())
            if int(own.max()) - least < 1 << 32:
                own = (own - least).astype(np.uint32)
            kind = np.uint16 if len(who) < 1 << 16 else np.uint32
            n = sizes[who].astype(np.uint16 if sizes[who].max() < 1 << 16 else np.uint32)
            rows.append((b, _short(keys[s]), at.astype(kind).tobytes(), least, len(who), own.tobytes(), n.tobytes()))
    kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    names = ("bucket", "keys", "owners", "base", "items", "ids", "sizes")
    for at in range(0, len(rows), 16):
        cells = zip(*rows[at : at + 16], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(cells, kinds, strict=True)], names=list(names))


def _short(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _long(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // KEY_BYTES, 8), dtype=np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, KEY_BYTES)
    return out.view("<u8").ravel()


def _whole(raw: bytes, count: int) -> np.ndarray:
    kind = {2: np.uint16, 4: np.uint32, 8: np.int64}[len(raw) // count]
    return np.frombuffer(raw, kind).astype(np.int64)


def bucket_count(df: DataFrame) -> int:
    return max(64, 4 * shuffle_width(df.sparkSession))


def _fresh(x: np.ndarray) -> np.ndarray:
    """Where x differs from what comes before."""
    found = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=found[1:])
    return found


def _repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys in order, their places) of keys of KEY_BYTES that come more than once."""
    if len(key) < 1 << 64 - 8 * KEY_BYTES:  # key and place are sorted as one number
        bits = np.uint64(64 - 8 * KEY_BYTES)
        both = key << bits | np.arange(len(key), dtype=np.uint64)
        both.sort()
        key, at = both >> bits, (both & np.uint64((1 << int(bits)) - 1)).view(np.int64)
    else:
        at = np.argsort(key, kind="stable")
        key = key[at]
    alone = _fresh(key)
    alone[:-1] &= alone[1:]
    return key[~alone], at[~alone]


def open_tiles(postings: DataFrame, num: int, den: int) -> DataFrame:
    """Leader pairs (tile null) and the items of tiles of three or more (other null),
    where tiles of one smallest id are taken together."""
    band = np.log(den / num)

    def group(table: pa.Table) -> pa.Table:
        keys, owners, ids, sizes, base = [], [], [], [], 0
        columns = ("keys", "owners", "base", "items", "ids", "sizes")
        for k, o, least, count, i, n in zip(*(table.column(c).to_pylist() for c in columns), strict=True):
            keys.append(_long(k))
            owners.append(_whole(o, len(keys[-1])) + base)
            ids.append(_whole(i, count) + (least if len(i) < 8 * count else 0))
            sizes.append(_whole(n, count))
            base += count
        key, own, item, n = (np.concatenate(x) for x in (keys, owners, ids, sizes))
        key, at = _repeated(key)
        own = own[at]
        order = np.lexsort((item[own], key))
        key, own = key[order], own[order]
        once = _fresh(key) | _fresh(item[own])
        key, own = key[once], own[once]
        run = _fresh(key)
        tile = np.cumsum(run) - 1
        size = np.bincount(tile)
        shared = size[tile] >= 2
        key, tile, own = key[shared], tile[shared], own[shared]
        item, n, size = item[own], n[own], size[tile]
        level = np.floor(np.log(np.maximum(n, 1)) / band).astype(np.int64)
        order = np.lexsort((item, level, tile))
        key, tile, item, n, level, size = (x[order] for x in (key, tile, item, n, level, size))
        lead = np.concatenate([[True], (tile[1:] != tile[:-1]) | (level[1:] != level[:-1])]) if len(tile) else np.zeros(0, bool)
        at = np.maximum.accumulate(np.where(lead, np.arange(len(tile)), 0))
        pair = _compatible(n, n[at], num, den) & (item != item[at])
        # leaders of neighbouring bands are paired with each other
        heads = np.flatnonzero(lead)
        next_to = np.flatnonzero((tile[heads[1:]] == tile[heads[:-1]]) & (level[heads[1:]] == level[heads[:-1]] + 1))
        left, right = heads[next_to], heads[next_to + 1]
        near = _compatible(n[left], n[right], num, den) & (item[left] != item[right])
        a = np.concatenate([item[at][pair], item[left][near]])
        b = np.concatenate([item[pair], item[right][near]])
        a, b = np.minimum(a, b), np.maximum(a, b)
        if len(a):
            a, b = np.unique(np.stack([a, b]), axis=1)
        # a tile of two is settled by its leader pair; larger ones go under their smallest id,
        # so the many tiles of one group of documents become one
        many = size >= 3
        tile, item, n = tile[many], item[many], n[many]
        first = item
        if len(tile):
            starts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
            first = np.repeat(np.minimum.reduceat(item, starts), np.diff(np.append(starts, len(tile))))
            order = np.lexsort((item, first))
            first, item, n = first[order], item[order], n[order]
            once = np.concatenate([[True], (first[1:] != first[:-1]) | (item[1:] != item[:-1])])
            first, item, n = first[once], item[once], n[once]
        return pa.table(
            {
                "tile": pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(first)]),
                "id": pa.array(np.concatenate([a, item])),
                "other": pa.concat_arrays([pa.array(b), pa.nulls(len(item), pa.int64())]),
                "n": pa.array(np.concatenate([np.zeros(len(a), np.int64), n])),
            }
        )

    return postings.groupBy("bucket").applyInArrow(group, "tile long, id long, other long, n long")


def _compatible(n: np.ndarray, m: np.ndarray, num: int, den: int) -> np.ndarray:
    return den * np.minimum(n, m) >= num * np.maximum(n, m)


def _similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Whether two sorted sets have a Jaccard similarity of num / den or more."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")  # two sorted runs are merged
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return den * common >= num * (len(both) - common)


def bitmap(hashes: np.ndarray) -> bytes:
    """A hashed bitmap of about two bits per element, a power of two wide."""
    return _bits(hashes, 2, 16)


def _bits(hashes: np.ndarray, times: int, most: int) -> bytes:
    width = 1 << min(max(int(times * len(hashes)).bit_length(), 8), most)
    bits = np.zeros(width, dtype=bool)
    bits[(hashes & np.uint64(width - 1)).view(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def overlap_bound(n: int, a: bytes, m: int, b: bytes) -> int:
    """No two sets with these sizes and bitmaps share more elements than this.

    Every bit that only one side has stands for an element the other side lacks.
    A wider bitmap is folded to the width of the other first.
    """
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))


class _Bounds:
    """Items of a cell (id, label, part, size, bitmap); those of different parts meet,
    or all, if there is one part only."""

    def __init__(self, rows: list[tuple], num: int, den: int) -> None:
        self.ids, self.label, self.part, self.n = (np.array(x, dtype=np.int64) for x in list(zip(*rows, strict=True))[:4])
        self.bits = [np.frombuffer(r[4], np.uint64) for r in rows]
        self.num, self.den = num, den

    def _candidates(self, open_with: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """Each item with those behind it whose size and bitmap allow a link."""
        n, num, den = self.n, self.num, self.den
        crossing = self.part.min() != self.part.max()
        if not len(self.bits[0]):  # so few that a bound does not pay
            for k in range(len(n) - 1):
                later = np.arange(k + 1, len(n))
                ok = _compatible(n[later], n[k], num, den) & open_with(k, later)
                if crossing:
                    ok &= self.part[later] != self.part[k]
                if ok.any():
                    yield k, later[ok]
            return
        width = np.array([len(x) for x in self.bits])
        for w in np.unique(width):
            # similar sizes have bitmaps of one width or of neighbouring widths
            equal, wide = np.flatnonzero(width == w), np.flatnonzero(width == 2 * w)
            both = np.concatenate([equal, wide])
            table = np.stack([self.bits[k] for k in equal] + [self.bits[k][:w] | self.bits[k][w:] for k in wide])
            for i, k in enumerate(equal):
                ok = _compatible(n[both], n[k], num, den) & open_with(k, both)
                ok[: i + 1] = False
                if crossing:
                    ok &= self.part[both] != self.part[k]
                ok = np.flatnonzero(ok)
                if not len(ok):
                    continue
                x, y = table[i], table[ok]
                most = np.minimum(
                    n[k] - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), n[both[ok]] - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64)
                )
                hits = both[ok[(num + den) * most >= num * (n[k] + n[both[ok]])]]
                if len(hits):
                    yield k, hits

    def hopeful(self) -> np.ndarray:
        """Ids that may be linked with an item of another label."""
        some = np.zeros(len(self.ids), dtype=bool)
        for k, hits in self._candidates(lambda k, both: self.label[both] != self.label[k]):
            some[k] = some[hits] = True
        return self.ids[some]


class _Cell(_Bounds):
    """Items of a cell (id, label, part, body) with their sets."""

    def __init__(self, rows: list[tuple], found: list[np.ndarray], num: int, den: int) -> None:
        few = len(rows) <= FEW
        super().__init__([(*r[:3], len(x), b"" if few else _bits(x, 8, 15)) for r, x in zip(rows, found, strict=True)], num, den)
        self.found, self.at = found, np.concatenate([[0], np.cumsum(self.n)])

    @cached_property
    def codes(self) -> np.ndarray:
        """Small numbers for the hashes, made where a bound left two items to be verified."""
        return np.unique(np.concatenate(self.found), return_inverse=True)[1]

    @cached_property
    def mark(self) -> np.ndarray:
        return np.zeros(int(self.codes.max()) + 1 if len(self.codes) else 1, dtype=bool)

    def _own(self, k: int) -> np.ndarray:
        return self.codes[self.at[k] : self.at[k + 1]]

    def _enough(self, common: np.ndarray | int, k: int, j: np.ndarray | int):
        return self.den * common >= self.num * (self.n[k] + self.n[j] - common)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Verified links between labels, at most one for each two labels that they join."""
        c = self.label
        left, right = [], []
        for k, hits in self._candidates(lambda k, both: c[both] != c[k]):
            self.mark[self._own(k)] = True
            for j in hits:
                if c[j] != c[k] and self._enough(int(np.count_nonzero(self.mark[self._own(j)])), k, j):
                    left.append(self.ids[k])
                    right.append(self.ids[j])
                    c[c == c[j]] = c[k]
            self.mark[self._own(k)] = False
        a, b = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)
        return np.minimum(a, b), np.maximum(a, b)

    def counts(self) -> np.ndarray:
        """For each item the labels (weights here) of all items that it is linked with, added up."""
        total = np.zeros(len(self.ids), dtype=np.int64)
        anyone = np.ones(1, dtype=bool)
        for k, hits in self._candidates(lambda k, both: anyone):
            self.mark[self._own(k)] = True
            if len(hits) > 32:
                common = np.add.reduceat(self.mark[self.codes], self.at[:-1], dtype=np.int64)[hits]
            else:
                common = np.array([np.count_nonzero(self.mark[self._own(j)]) for j in hits])
            self.mark[self._own(k)] = False
            linked = hits[self._enough(common, k, hits)]
            total[k] += self.label[linked].sum()
            total[linked] += self.label[k]
        return total


def _small_links(cells: list[tuple[list[tuple], list[np.ndarray]]], num: int, den: int) -> Iterator[tuple[int, int]]:
    """Verified links between labels of small cells (rows, sets), as ``_Cell.links`` gives them.

    All pairs of the cells are bounded together, by bitmaps of one width; those that are
    left are verified one by one.
    """
    rows, sets = [r for held, _ in cells for r in held], [x for _, found in cells for x in found]
    left, right = [], []
    at = 0
    for held, _ in cells:
        a, b = _TRIANGLES[len(held)]
        left.append(a + at)
        right.append(b + at)
        at += len(held)
    ids, label, part = (np.array(x, dtype=np.int64) for x in list(zip(*rows, strict=True))[:3])
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    own = np.repeat(np.arange(len(cells)), [len(held) for held, _ in cells])
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    crossing = np.minimum.reduceat(part, starts) != np.maximum.reduceat(part, starts)
    k, j = np.concatenate(left), np.concatenate(right)
    may = (label[k] != label[j]) & _compatible(n[k], n[j], num, den) & ((part[k] != part[j]) | ~crossing[own[k]])
    k, j = k[may], j[may]
    bits = np.zeros((len(sets), SMALL_BITS), dtype=bool)
    place = (np.concatenate(sets) & np.uint64(SMALL_BITS - 1)).view(np.int64)
    place += np.repeat(np.arange(len(sets)) * SMALL_BITS, n)
    bits.ravel()[place] = True
    bits = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    joined = label.copy()  # labels joined so far; a label may be in several cells
    for first in range(0, len(k), FLUSH_PAIRS):
        a, b = k[first : first + FLUSH_PAIRS], j[first : first + FLUSH_PAIRS]
        x, y = bits[a], bits[b]
        most = np.minimum(n[a] - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), n[b] - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))
        near = (num + den) * most >= num * (n[a] + n[b])
        for p, q in zip(a[near].tolist(), b[near].tolist(), strict=True):
            if joined[p] != joined[q] and _similar(sets[p], sets[q], num, den):
                mine = slice(starts[own[p]], starts[own[p]] + len(cells[own[p]][0]))
                joined[mine][joined[mine] == joined[q]] = joined[p]
                yield min(ids[p], ids[q]), max(ids[p], ids[q])


def _parts(items: str, elements: str) -> F.Column:
    return F.ceil(F.greatest(F.col(items) / CELL_ITEMS, F.col(elements) / CELL_ELEMENTS)).cast("int")


CELL = ["tile", "p", "q"]


def _by_cell(rows: DataFrame, make: Callable[[list[tuple[tuple, list[tuple]]]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What ``make`` gives for some cells at a time, each with its rows as tuples."""
    kept = [c for c in rows.columns if c not in CELL]
    ordered = rows.repartition(*CELL).sortWithinPartitions(*CELL, "id").select(*CELL, *kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, full, count = None, [], [], 0
        for batch in batches:
            for tile, p, q, *item in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (tile, p, q) != cell:
                    if len(held) > 1:
                        full.append((cell, held))
                        count += len(held)
                    if count >= CELL_ITEMS:
                        yield from make(full)
                        full, count = [], 0
                    cell, held = (tile, p, q), []
                held.append(tuple(item))
        if len(held) > 1:
            full.append((cell, held))
        if full:
            yield from make(full)

    return ordered.mapInArrow(released(run), schema)


def _cells(full: list[tuple[tuple, list[tuple]]], sets: Sets, num: int, den: int) -> Iterator[_Cell]:
    """The cells of rows (id, label, part, body); the sets of all are made together."""
    for held, found in _with_sets(full, sets):
        yield _Cell(held, found, num, den)


def _with_sets(full: list[tuple[tuple, list[tuple]]], sets: Sets) -> Iterator[tuple[list[tuple], list[np.ndarray]]]:
    """(rows, the set of each) of cells of rows (id, label, part, body); a body that comes again is made a set once."""
    bodies = list(dict.fromkeys(r[3] for _, held in full for r in held))
    found = dict(zip(bodies, sets(bodies), strict=True))
    for _, held in full:
        yield held, [found[r[3]] for r in held]


def _cell_links(full: list[tuple[tuple, list[tuple]]], sets: Sets, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of cells of rows (id, label, part, body)."""
    small, found = [], []
    for held, own in _with_sets(full, sets):
        if len(held) <= SMALL_ITEMS and max(map(len, own)) <= SMALL_ELEMENTS:
            small.append((held, own))
        else:
            found.append(np.stack(_Cell(held, own, num, den).links()))
    if small:
        found.append(np.array(list(_small_links(small, num, den)), dtype=np.int64).reshape(-1, 2).T)
    return tuple(np.concatenate(found, axis=1))


def _promising(rows: DataFrame, items: DataFrame, num: int, den: int) -> DataFrame:
    """Those rows of cells that, by bitmaps alone, may have a link to another component."""

    def make(cells: list[tuple[tuple, list[tuple]]]) -> Iterator[pa.RecordBatch]:
        found = [(cell, _Bounds(held, num, den).hopeful()) for cell, held in cells]
        columns = [pa.array([cell[k] for cell, ids in found for _ in ids], kind) for k, kind in enumerate((pa.int64(), pa.int32(), pa.int32()))]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate([ids for _, ids in found]))], names=[*CELL, "id"])

    full = rows.join(items.select("id", "n", "bits"), "id").select(*CELL, "id", "label", "part", "n", "bits")
    return rows.join(_by_cell(full, make, "tile long, p int, q int, id long"), [*CELL, "id"], "left_semi")


def _open_links(placed: DataFrame, items: DataFrame | None, bodies: Fetch, sets: Sets, num: int, den: int) -> DataFrame | None:
    """Verified links between items of one tile and different components ``c``.

    The members of a tile's largest component are never compared with each other:
    they are cut into parts that meet only the parts of the other items.  With
    ``items`` bitmaps say first which rows of a cell are worth their bodies.  Returns
    None where no tile has two components.
    """
    by_component = placed.groupBy("tile", "c").agg(F.count("*").alias("m"), F.sum("n").alias("s"))
    totals = by_component.groupBy("tile").agg(
        F.count("*").alias("k"), F.sum("m").alias("m"), F.sum("s").alias("s"), F.max(F.struct("m", "s", "c")).alias("main")
    )
    totals = totals.where("k > 1").select(
        "tile", F.col("main.c").alias("main"), F.col("main.m").alias("main_m"), F.col("main.s").alias("main_s"),
        (F.col("m") - F.col("main.m")).alias("rest_m"), (F.col("s") - F.col("main.s")).alias("rest_s"),
    )
    totals = staged(totals.select("tile", "main", _parts("main_m", "main_s").alias("mains"), _parts("rest_m", "rest_s").alias("rests")))
    if totals.isEmpty():
        discard(totals)
        return None
    largest, draw, rests, mains = F.col("c") == F.col("main"), F.xxhash64("id"), F.col("rests"), F.col("mains")
    part = F.when(largest, rests + F.pmod(draw, mains.cast("long"))).otherwise(F.pmod(draw, rests.cast("long")))
    met = F.when(largest, F.sequence(F.lit(0), rests - 1)).otherwise(F.sequence(F.lit(0), rests + mains - 1))
    rows = placed.join(totals, "tile").select("tile", "id", F.col("c").alias("label"), part.cast("int").alias("part"), F.explode(met).alias("other"))
    rows = rows.select("tile", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "id", "label", "part")
    if items is not None:
        cells = staged(rows)
        rows = _promising(cells, items, num, den)
    rows = staged(rows)

    def make(cells: list[tuple[tuple, list[tuple]]]) -> Iterator[pa.RecordBatch]:
        a, b = _cell_links(cells, sets, num, den)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    full = rows.join(bodies(member_filter(rows, "id")).select("id", "body"), "id").select(*CELL, "id", "label", "part", "body")
    links = staged(_by_cell(full, make, "a long, b long").distinct())
    discard(totals, rows, *([cells] if items is not None else []))
    return links


def link_counts(members: DataFrame, bodies: Fetch, sets: Sets, num: int, den: int) -> DataFrame:
    """(digest, links): the weights of all sets of a set's component that it is linked with.

    ``members`` (id, digest, n, c, weight) are different sets, a row each, under an
    id that has it.  A component is cut into parts and every two parts meet once;
    only sums leave a cell.
    """
    totals = members.groupBy("c").agg(F.count("*").alias("m"), F.sum("n").alias("s")).where("m > 1").select("c", _parts("m", "s").alias("parts"))
    part = F.pmod(F.xxhash64("digest"), F.col("parts").cast("long")).cast("int")
    rows = members.join(totals, "c").select(
        F.col("c").alias("tile"), "id", "digest", F.col("weight").alias("label"), part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    )
    rows = staged(rows.select("tile", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), F.col("id").alias("doc"), F.col("digest").alias("id"), "label", "part"))

    def make(cells: list[tuple[tuple, list[tuple]]]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(cells, sets, num, den):
            yield pa.RecordBatch.from_arrays([pa.array(cell.ids), pa.array(cell.counts())], names=["digest", "links"])

    each = bodies(member_filter(rows, "doc")).groupBy(F.col("digest").alias("id")).agg(F.first("body").alias("body"))
    full = rows.join(each, "id").select(*CELL, "id", "label", "part", "body")
    counted = staged(_by_cell(full, make, "digest long, links long").groupBy("digest").agg(F.sum("links").alias("links")))
    discard(rows)
    return counted


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))


def _linked(pairs: DataFrame, items: DataFrame | None, bodies: Fetch, sets: Sets, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of num / den or more.

    ``items`` (ITEMS) is None where bodies are so small that bounding first does not pay.
    """

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [batch.column(k).to_pylist() for k in ("n", "bits", "m", "bits2")]
            keep = [(num + den) * overlap_bound(*row) >= num * (row[0] + row[2]) for row in zip(*cells, strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a leader is in many pairs; each body of a batch is made a set once
            both = pa.chunked_array([batch.column("x"), batch.column("y")]).combine_chunks().dictionary_encode()
            found, of, rows = sets(both.dictionary.to_pylist()), both.indices.to_pylist(), batch.num_rows
            keep = [_similar(found[i], found[j], num, den) for i, j in zip(of[:rows], of[rows:], strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    survivors = pairs
    if items is not None:
        left = items.select(F.col("id").alias("a"), "n", "bits")
        right = items.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("bits").alias("bits2"))
        met = pairs.join(left, "a").join(right, "b").select("a", "b", "n", "bits", "m", "bits2")
        survivors = staged(met.mapInArrow(released(bounded), "a long, b long"))
    whole = bodies(member_filter(_ids(survivors), "id"))
    x, y = (whole.select(F.col("id").alias(side), F.col("body").alias(name)) for side, name in (("a", "x"), ("b", "y")))
    met = survivors.join(y, "b").join(x, "a").select("a", "b", "x", "y")  # a, the leader, is in many pairs: they come together
    links = staged(met.mapInArrow(released(exact), "a long, b long"))
    if items is not None:
        discard(survivors)
    return links


def similar_components(
    tiles: DataFrame, bodies: Fetch, sets: Sets, num: int, den: int, equal: DataFrame | None = None, items: DataFrame | None = None
) -> DataFrame:
    """(id, component) of the ids that have a link.

    ``tiles``: what ``open_tiles`` gives.  ``bodies`` and ``sets``: an item's body and
    the set it stands for.  ``items``: sizes and bitmaps, see ``_linked``.  ``equal``:
    pairs (a, b) that are known to be linked, such as copies.
    """
    pairs = tiles.where("tile is null").select(F.col("id").alias("a"), F.col("other").alias("b")).distinct()
    pairs = staged(pairs)
    links = _linked(pairs, items, bodies, sets, num, den)
    found = staged(components(links if equal is None else links.unionByName(equal)))
    discard(pairs, links)

    grouped = tiles.where("tile is not null").select("tile", "id", "n").distinct()
    placed = staged(grouped.join(found, "id", "left").select("tile", "id", "n", F.coalesce("component", "id").alias("c")))
    late = _open_links(placed, items, bodies, sets, num, den)
    discard(placed)
    if late is None or late.isEmpty():
        return found
    return components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(late))
