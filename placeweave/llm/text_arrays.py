"""Vectorised views of text columns: words, shingle hashes and packed blocks.

Everything here works on one Arrow batch inside a task.  Bytes of many documents
are handled together in blocks of about half a megabyte, so temporaries stay small
whatever the size of the batch; a longer document is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (xor-shift, multiply, twice)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _MULT)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def need(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            with np.errstate(over="ignore"):
                self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, m, 1 << 64))])
                self.down = np.concatenate([self.down, self.down * np.uint64(pow(_BASE_INVERSE, m, 1 << 64))])

    def shrink(self) -> None:
        """Forget what only a very long span needed."""
        if len(self.up) > 4 * BLOCK_BYTES:
            self.up, self.down = self.up[: 2 * BLOCK_BYTES].copy(), self.down[: 2 * BLOCK_BYTES].copy()


_POWERS = _Powers()


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about ``limit`` bytes each."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (a run of bytes that are no white space)."""
    n = len(raw)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~_SEPARATOR[raw]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] = inside[edges]
    stops[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span, from running polynomial sums.

    ``starts`` and ``ends`` ascend.  Long texts are summed in pieces, so temporaries are
    those of a block or of the longest span, and the table of powers stays that small.
    """
    out = np.zeros(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(starts, base + BLOCK_BYTES))
        piece = raw[base : ends[j - 1]]
        _POWERS.need(len(piece) + 1)
        s, e = starts[i:j] - base, ends[i:j] - base
        with np.errstate(over="ignore"):
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODE[piece] * _POWERS.up[: len(piece)], out=sums[1:])
            out[i:j] = mix64((sums[e] - sums[s]) * _POWERS.down[s] + (e - s).astype(np.uint64) * _MULT)
        _POWERS.shrink()
        i = j
    return out


def shingle_sets(column: pa.Array, width: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row of a text column.

    A-Z count as a-z.  A text of fewer than ``width`` words gives its whole word
    sequence as one shingle, a text without words (or null) an empty set.
    """
    raw_all, offsets_all = text_buffer(column)
    for first, last in blocks(offsets_all):
        base = offsets_all[first]
        raw = _LOWER[raw_all[base : offsets_all[last]]]
        offsets = offsets_all[first : last + 1] - base
        starts, ends, row = words(raw, offsets)
        count = np.bincount(row, minlength=last - first) if len(row) else np.zeros(last - first, np.int64)
        at = np.concatenate([[0], np.cumsum(count)])
        with np.errstate(over="ignore"):
            h = span_hashes(raw, starts, ends)
            m = len(h) - width + 1
            if m > 0:
                s = h[:m].copy()
                for k in range(1, width):
                    s *= _MULT
                    s += h[k : k + m]
                s = mix64(s)
            for i in range(last - first):
                a, b = at[i], at[i + 1]
                if b - a >= width:
                    yield first + i, np.unique(s[a : b - width + 1])
                elif b > a:
                    x = np.uint64(b - a)
                    for v in h[a:b]:
                        x = x * _MULT + v
                    yield first + i, mix64(np.array([x], dtype=np.uint64))
                else:
                    yield first + i, np.zeros(0, np.uint64)


def set_digest(hashes: np.ndarray) -> int:
    """A signed 64-bit digest of a set of hashes, the same in any order."""
    with np.errstate(over="ignore"):
        x = np.array([hashes.sum(dtype=np.uint64) * _MULT + np.uint64(len(hashes))], dtype=np.uint64)
        if len(hashes):
            x ^= np.bitwise_xor.reduce(mix64(hashes))
    return int(mix64(x).view(np.int64)[0])
