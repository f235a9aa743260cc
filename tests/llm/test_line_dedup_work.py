"""Operator 7: what is counted, bounded and verified many at a time gives what one at a time gives."""

from __future__ import annotations

import numpy as np

from placeweave.llm import line_dedup, tiles


def test_set_sizes():
    rng = np.random.default_rng(3)
    for spread in (1, 5, 1000, 1 << 50):
        counts = rng.integers(1, 90, 700)
        hashes = (rng.integers(0, spread, int(counts.sum())).astype(np.uint64) << np.uint64(12)) * np.uint64(3)
        at = np.cumsum(counts) - counts
        want = [len(np.unique(hashes[a : a + n] >> np.uint64(12))) for a, n in zip(at, counts, strict=True)]
        assert line_dedup._set_sizes(hashes, counts).tolist() == want


def test_products_find_pairs_of_least_similarity():
    rng = np.random.default_rng(4)
    missed, pairs = 0, 20_000
    for n in (8, 60, 280):  # of 8n different shingles 6n are shared
        both = rng.integers(0, 1 << 32, (pairs, 8 * n // 4), dtype=np.uint32)
        own = both.shape[1] // 8
        agree = np.ones((line_dedup.BANDS, pairs), dtype=bool)
        for k, factor in enumerate(line_dedup._FACTORS):
            mixed = both * factor
            agree[k // line_dedup.ROWS] &= mixed[:, own:].min(axis=1) == mixed[:, :-own].min(axis=1)
        missed += int((~agree.any(axis=0)).sum())
    assert missed <= 3 * pairs * 0.0004


def _groups(links, label):
    joined = dict(label)
    for a, b in links:
        x, y = joined[a], joined[b]
        joined = {k: min(x, y) if v in (x, y) else v for k, v in joined.items()}
    return joined


def test_small_cells_are_linked_as_pair_by_pair():
    rng = np.random.default_rng(5)
    full, made, want = [], [], []
    for tile, m in enumerate((2, 3, 9, 40, tiles.SMALL_ITEMS, tiles.SMALL_ITEMS + 1, 6)):
        base = rng.integers(0, 1 << 52, 1500 if tile == 6 else 60).astype(np.uint64)
        held = []
        for i in range(m):
            own = base.copy()
            own[rng.random(len(own)) < rng.choice([0.02, 0.12, 0.2])] = rng.integers(0, 1 << 52)
            held.append((1000 * tile + i, 1000 * tile + (i if i % 3 else 0), i % 2 if tile % 2 else 0, np.unique(own).tobytes()))
        full.append(((tile, 0, 0), held))
    full.append(((99, 0, 0), [(9000 + i, 9000 + i, 0, r[3]) for i, r in enumerate(full[2][1])]))  # bodies that came before

    def sets(bodies):
        made.extend(bodies)
        return tiles.hash_arrays(bodies)

    a, b = tiles._cell_links(full, sets, 3, 4)
    assert len(made) == len(set(made))  # before, a body was made a set in each cell that has it
    label = {r[0]: r[1] for _, held in full for r in held}
    for _, held in full:
        crossing = len({r[2] for r in held}) > 1
        body = {r[0]: set(np.frombuffer(r[3], np.uint64).tolist()) for r in held}
        for i, r in enumerate(held):
            for s in held[:i]:
                x, y = body[r[0]], body[s[0]]
                if (not crossing or r[2] != s[2]) and 4 * len(x & y) >= 3 * len(x | y):
                    want.append((r[0], s[0]))
    assert want and _groups(zip(a.tolist(), b.tolist(), strict=True), label) == _groups(want, label)


def test_first_line_of_large_ids(spark):
    line = "a line that several documents have in common, of some length"
    ids = [2**62 + 1, 2**62, -(2**62), 7]
    rows = [(i, f"own text of number {i}\n{line}\n{line}") for i in ids]
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[-(2**62)] == 1 and all(got[i] >= 2 for i in ids if i != -(2**62))


def test_shingles_are_the_same_in_any_block():
    wide = "你好 \U0001f600 0123456789 été 0123456789"
    lines = ["plain words of one line, and then of one line", "café ÿ\x00\x01 and more of it", "A" * 40]
    alone = line_dedup.line_sets([x.encode() for x in lines])
    mixed = line_dedup.line_sets([x.encode() for x in [wide, *lines]])
    assert all((a == b).all() for a, b in zip(alone, mixed[1:], strict=True))
    for text, found in zip([wide, *lines], mixed, strict=True):
        assert len(found) == len({text[k : k + 8] for k in range(len(text) - 7)})
    # characters that agree in their low bytes only
    a, b = line_dedup.line_sets(["Łbcdefghij".encode(), "Abcdefghij".encode()])
    assert len(np.intersect1d(a, b)) == 2
    keys, sizes = line_dedup._Lines(lines).bands(np.arange(3))
    same, same_sizes = line_dedup._Lines([wide, *lines]).bands(np.arange(1, 4))
    assert (keys == same).all() and (sizes == same_sizes).all()


def test_sizes_and_sets_of_long_lines():
    rng = np.random.default_rng(6)
    for spread in (1, 50, 1 << 50):
        counts = rng.integers(1, 900, 60)
        hashes = rng.integers(0, spread, int(counts.sum())).astype(np.uint64) << np.uint64(12)
        at = np.cumsum(counts) - counts
        want = [np.unique(hashes[a : a + n] >> np.uint64(12)) for a, n in zip(at, counts, strict=True)]
        assert line_dedup._set_sizes(hashes, counts).tolist() == list(map(len, want))
        assert all((x == y).all() for x, y in zip(line_dedup._sorted_sets(hashes, counts), want, strict=True))


def test_keys_that_come_once_open_no_tile(monkeypatch):
    rng = np.random.default_rng(7)
    key = rng.integers(0, 3000, 4000).astype(np.uint64) << np.uint64(20)
    values, n = np.unique(key, return_counts=True)
    for size in (tiles.KEY_BYTES, 7):  # 7: too many rows for one number of key and place
        monkeypatch.setattr(tiles, "KEY_BYTES", size)
        found, at = tiles._repeated(key)
        assert (found == np.repeat(values[n > 1], n[n > 1])).all() and (key[at] == found).all() and len(np.unique(at)) == len(at)
    assert all(len(x) == 0 for x in tiles._repeated(key[:0]))


def test_cells_without_hope_are_not_coded():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 52, 300).astype(np.uint64)) for _ in range(20)]
    rows = [(i, i, 0, b"") for i in range(20)]
    cell = tiles._Cell(rows, sets, 3, 4)
    assert len(cell.links()[0]) == 0 and "codes" not in vars(cell)  # before, all hashes of a cell were sorted first
    cell = tiles._Cell([*rows, (20, 20, 0, b"")], [*sets, sets[3][5:]], 3, 4)
    assert [x.tolist() for x in cell.links()] == [[3], [20]]


def test_lines_are_read_twice_for_the_result(spark):
    rows = [(i, f"own text of number {i}\na line that all documents have in common") for i in range(5)]
    result = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    # places and lines that go; before, places were taken once for the groups and once for the lines
    assert result._jdf.queryExecution().optimizedPlan().toString().count("Relation [doc#") == 1
    assert sum(r.n_dropped for r in result.collect()) >= 4
