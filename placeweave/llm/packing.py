"""Sequence packing along a space-filling curve (operator 5).

A document's hashed byte trigrams are projected to three dimensions and its place
on the Hilbert curve is its key.  Keys are cut into ranges at quantiles; in each
range documents are sorted along the curve and packed one behind the other, cut
where a sequence is full.  What is left at the end of a range is cut into
sequences of powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm.shared import released, shuffle_width
from placeweave.llm.text_arrays import blocks, mix64, span_hashes, text_buffer, words
from placeweave.llm.token_counts import CACHE, LONGEST, check_split, load_tokenizer

AXES, AXIS_BITS = 3, 10
#: Low bits of a key: a hash of the id, so a range can end inside equal places.
TIE_BITS = 30
_TRIGRAMS = 1 << 16
#: Bytes of text for which a key counts once more when ranges are cut.
RANGE_UNIT = 4096


def _projection() -> np.ndarray:
    signs = mix64(np.arange(_TRIGRAMS, dtype=np.uint64) + np.uint64(0x51ED270B))
    return np.stack([((signs >> np.uint64(k)) & np.uint64(1)).astype(np.float32) * 2 - 1 for k in range(AXES)])


_AXIS_SIGNS = _projection()


def hilbert(places: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with ``bits`` bits on each axis (columns).

    Follows Skilling, "Programming the Hilbert curve" (2004), for whole arrays.
    """
    x = places.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        for i in range(axes):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(high, x[0] ^ (q - 1), x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] & (1 << level)) != 0, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def curve_keys(ids: np.ndarray, column: pa.Array) -> np.ndarray:
    """The key of every row: 30 bits of the curve, then 30 of the id's hash."""
    raw_all, offsets_all = text_buffer(column)
    places = np.zeros((len(column), AXES), dtype=np.int64)
    for first, last in blocks(offsets_all):
        raw = raw_all[offsets_all[first] : offsets_all[last]]
        if len(raw) < 3:
            continue
        b = raw.astype(np.uint16)
        tri = b[:-2] * np.uint16(40503) + b[1:-1] * np.uint16(30011) + b[2:] * np.uint16(257)
        starts = offsets_all[first:last] - offsets_all[first]
        counts = np.diff(offsets_all[first : last + 1])
        some = (counts > 0) & (starts < len(tri))
        for axis in range(AXES):
            sums = np.add.reduceat(_AXIS_SIGNS[axis][tri], starts[some], dtype=np.float64)
            z = sums / np.maximum(counts[some], 1)
            # tanh spreads the usual range of a mean of signs over the axis
            places[first:last, axis][some] = ((np.tanh(4 * z) + 1) / 2 * ((1 << AXIS_BITS) - 1)).astype(np.int64)
    tie = (mix64(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - TIE_BITS)).astype(np.int64)
    return (hilbert(places, AXIS_BITS) << TIE_BITS) | tie


#: How this vocabulary family splits lower-cased text (a fixed value).
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others for U+0100 and up in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


#: White space beyond ASCII, as UTF-8; the library's pattern drops it too (fixed values).
_WIDE_SPACES = [*"\u0085\u00a0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B))]
#: Pieces and ids that a worker's table keeps; when it is full it starts anew.
KEPT_PIECES, KEPT_IDS = 1 << 20, 1 << 23


def _without_wide_spaces(raw: np.ndarray) -> np.ndarray:
    """The bytes with spaces in place of white space beyond ASCII."""
    leads = {c.encode()[0] for c in _WIDE_SPACES}
    at = np.flatnonzero(np.isin(raw, np.array(sorted(leads), np.uint8)))
    if not len(at):
        return raw
    after = np.concatenate([raw, np.zeros(3, np.uint8)])
    out = None
    for c in _WIDE_SPACES:
        code = c.encode()
        hit = at[after[at] == code[0]]
        for k in range(1, len(code)):
            hit = hit[after[hit + k] == code[k]]
        if len(hit):
            out = raw.copy() if out is None else out
            for k in range(len(code)):
                out[hit + k] = 0x20
    return raw if out is None else out


class _Table:
    """Numbers of 64-bit hashes in the order in which they came: open addressing on arrays."""

    def __init__(self, room: int) -> None:
        self.room, self.mask = room, np.int64(2 * room - 1)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(2 * self.room, dtype=np.uint64)
        self.numbers = np.zeros(2 * self.room, dtype=np.int32)
        self.count = 0

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(20)).astype(np.int64) & self.mask

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash (none is 0), -1 where it is new."""
        slot = self._slots(hashes)
        found = np.full(len(hashes), -1, dtype=np.int64)
        key = self.keys[slot]
        hit = key == hashes
        found[hit] = self.numbers[slot[hit]]
        left = np.flatnonzero(~hit & (key != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            key = self.keys[slot[left]]
            hit = key == hashes[left]
            found[left[hit]] = self.numbers[slot[left[hit]]]
            left = left[~hit & (key != 0)]
        return found

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of hashes that are all new and different."""
        numbers = np.arange(self.count, self.count + len(hashes))
        slot, left = self._slots(hashes), np.arange(len(hashes))
        while len(left):
            free = self.keys[slot[left]] == 0
            here, first = np.unique(slot[left[free]], return_index=True)
            placed = left[free][first]
            self.keys[here], self.numbers[here] = hashes[placed], numbers[placed]
            stay = np.ones(len(left), dtype=bool)
            stay[np.flatnonzero(free)[first]] = False
            left = left[stay]
            slot[left] = (slot[left] + 1) & self.mask
        self.count += len(hashes)
        return numbers


class _Grown:
    """An array that is added to at its end."""

    def __init__(self, kind: type) -> None:
        self.data, self.size = np.zeros(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> None:
        need = self.size + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data[: self.size], np.zeros(2 * need - self.size, self.data.dtype)])
        self.data[self.size : need] = values
        self.size = need


class _Encoder:
    """Ids of whole texts, from the ids of their pieces between white space.

    This vocabulary family drops white space and nothing it matches spans it, so
    the pieces of a text encode independently.  All pieces of a block are hashed
    together and looked up; only new ones are coded: one of plain Latin letters and
    marks is split into words, each merged by the library's model; any other goes
    through the whole library.  Two pieces of a worker's table have the same 64-bit
    hash with a probability of about 1e-8.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = load_tokenizer(path)
        self.model = self.tokenizer.model
        # letters below U+0250 are composed already and lower-case one by one, but for U+0130
        self.foreign = regex.compile("[^\x21-\x7e\xa1-\u012f\u0131-\u024f]|<\\|")
        self.word = regex.compile(WORD)
        self.letters = _byte_letters()
        self.table = _Table(KEPT_PIECES)
        self._clear()

    def _clear(self) -> None:
        self.table.clear()
        self.words: dict[str, bytes] = {}
        self.ids, self.starts, self.counts = _Grown(np.uint32), _Grown(np.int64), _Grown(np.int32)

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = array("I", [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))]).tobytes()
            if len(self.words) < CACHE and len(word) < LONGEST:
                self.words[word] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece, four bytes each; letters alone or before one mark need no splitting pattern."""
        if self.foreign.search(piece):
            return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        low = piece.lower()
        if low.isalpha():
            return self._word(low)
        if low[-1] in ",." and low[:-1].isalpha():
            return self._word(low[:-1]) + self._word(low[-1])
        return b"".join(map(self._word, self.word.findall(low)))

    def encode(self, raw: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after the other, number of them in each row), ``end_id`` behind each row."""
        raw = _without_wide_spaces(raw)
        starts, ends, row = words(raw, offsets)
        hashes = span_hashes(raw, starts, ends) if len(starts) else np.zeros(0, np.uint64)
        hashes[hashes == 0] = 1
        if self.table.count + len(hashes) > self.table.room or self.ids.size > KEPT_IDS:
            # room for whatever the block brings; a block of more pieces than the table holds gets a larger one
            if len(hashes) > self.table.room:
                self.table = _Table(1 << len(hashes).bit_length())
            self._clear()
        number = self.table.find(hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            fresh, first = np.unique(hashes[new], return_index=True)
            first = new[first]
            data = raw.tobytes()
            coded = [self._piece(data[a:b].decode()) for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            counts = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
            more = np.frombuffer(b"".join(coded), np.uint32)
            self.table.add(fresh)
            self.starts.add(self.ids.size + np.cumsum(counts) - counts)
            self.counts.add(counts)
            self.ids.add(more)
            number[new] = self.table.find(hashes[new])
        counts = self.counts.data[number]
        before = np.cumsum(counts) - counts
        total = int(counts.sum())
        rows = len(offsets) - 1
        out = np.empty(total + rows, dtype=np.uint32)
        steps = np.arange(total)
        out[steps + np.repeat(row, counts)] = self.ids.data[steps + np.repeat(self.starts.data[number] - before, counts)]
        sizes = np.bincount(row, weights=counts, minlength=rows).astype(np.int64) + 1
        out[np.cumsum(sizes) - 1] = end_id
        return out, sizes


_encoders: dict[str, _Encoder] = {}


def pack_documents(
    docs: DataFrame, path: str, length: int = 2048, end_id: int = 1, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows (id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one for
    each piece of a document.

    A document is the library's ids for its text (a null text: none) and
    ``end_id``.  Every id lies in exactly one piece; a sequence has at most
    ``length`` ids and is gapless from offset 0.  Repeated rows are packed each
    time; a null id is packed under null.  Equal texts share a place on the curve
    but not a key, so a hot group is spread over ranges.  An empty table gives no
    rows; further columns are ignored.
    """
    check_split(path, ["NFC", "Replace", "Lowercase"], WORD)
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            _, offsets = text_buffer(batch.column(1))
            # a key for every so many bytes, so that ranges are equal in bytes
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(curve_keys(ids, batch.column(1)), 1 + np.diff(offsets) // RANGE_UNIT))], names=["key"])

    ranges = 2 * shuffle_width(docs.sparkSession)
    shares = [k / ranges for k in range(1, ranges)]
    cuts = rows.mapInArrow(released(keys), "key long").agg(F.percentile_approx("key", shares, 10 * ranges)).first()[0] or []
    bounds = np.array(sorted(set(cuts)), dtype=np.int64)  # fewer than there are ranges

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = _Encoder(path)
        encoder = _encoders[path]
        narrow = encoder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
        unit = 2 if narrow else 4
        for batch in batches:
            ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False)
            key = curve_keys(ids, batch.column(1))
            place = np.searchsorted(bounds, key, side="right").astype(np.int32)
            raw, offsets = text_buffer(batch.column(1))
            for first, last in blocks(offsets):
                coded, sizes = encoder.encode(raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], end_id)
                ends = np.concatenate([[0], np.cumsum(sizes * unit)])
                data = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(coded.astype(f"<u{unit}"))]
                column = pa.Array.from_buffers(pa.large_binary(), last - first, data).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place[first:last]), pa.array(key[first:last]), batch.column(0).slice(first, last - first), column, pa.array(np.full(last - first, unit, np.int32))],
                    names=["place", "key", "id", "ids", "unit"],
                )

    coded = rows.mapInArrow(released(encode), "place int, key long, id long, ids binary, unit int")
    ordered = coded.repartitionById(ranges, F.col("place")).sortWithinPartitions("place", "key", "id")
    schema = f"`{id}` long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    names = [id, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(length)
        for batch in batches:
            cells = [batch.column(k).to_pylist() for k in range(5)]
            for place, _, doc, ids, unit in zip(*cells, strict=True):
                packer.add(place, doc, np.frombuffer(ids, f"<u{unit}"))
                if len(packer.out) >= 8192:
                    yield packer.rows(names)
        packer.close()
        if packer.out:
            yield packer.rows(names)

    return ordered.mapInArrow(released(pack), schema)


class _Packer:
    """Fills sequences of one range after the other; holds less than one sequence."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.place, self.count = None, 0
        self.open: list[tuple[int | None, int, int, np.ndarray]] = []  # id, start, ids of the document, ids
        self.filled = 0
        self.out: list[tuple] = []

    def add(self, place: int, doc: int | None, ids: np.ndarray) -> None:
        if place != self.place:
            self.close()
            self.place, self.count = place, 0
        at = 0
        while at < len(ids):
            part = ids[at : at + self.length - self.filled]
            self.open.append((doc, at, len(ids), part))
            self.filled += len(part)
            at += len(part)
            if self.filled == self.length:
                self._emit(self.open)
                self.open, self.filled = [], 0

    def _emit(self, pieces: list[tuple]) -> None:
        sequence = (self.place << 32) | self.count
        offset = 0
        for doc, start, total, part in pieces:
            self.out.append((doc, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), total, sequence, offset))
            offset += len(part)
        self.count += 1

    def close(self) -> None:
        """Cut what is open into sequences of powers of two, the largest first."""
        rest, pieces = self.filled, self.open
        while rest:
            take, now = 1 << (rest.bit_length() - 1), []
            rest -= take
            while take:
                doc, start, total, part = pieces[0]
                now.append((doc, start, total, part[:take]))
                if len(part) > take:
                    pieces[0] = (doc, start + take, total, part[take:])
                else:
                    pieces = pieces[1:]
                take -= len(now[-1][3])
            self._emit(now)
        self.open, self.filled = [], 0

    def rows(self, names: list[str]) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*self.out, strict=True)], names=names)
        self.out = []
        return batch
