"""Corpus operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from placeweave.llm import gif, tiles
from placeweave.llm.jaccard_join import ngram_jaccard_join, without_near_copies
from placeweave.llm.language_id import _word_trigrams, held_out, identify, learn
from placeweave.llm.line_dedup import BANDS, ROWS, dedup_lines
from placeweave.llm.mixing import calibrated_sample, mix_sources, sampled, shares
from placeweave.llm.packing import _Encoder, hilbert, pack_documents
from placeweave.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path
from placeweave.llm.shared import components
from placeweave.llm.sharding import kd_shards
from placeweave.llm.text_arrays import text_buffer
from placeweave.llm.tiles import bitmap, overlap_bound
from placeweave.llm.token_counts import load_tokenizer, proven_whole, token_counts
from placeweave.llm.topk_search import voronoi_knn_join
from placeweave.llm.url_filters import judge_urls

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, n long, doc long, slot string, component_id string"


def prose(seed: int, n: int) -> str:
    r = np.random.default_rng(seed)
    return " ".join(WORDS[k] + str(r.integers(40)) for k in r.integers(len(WORDS), size=n))


def awkward() -> list[tuple]:
    """Nulls, blanks, one very long text, copies, near copies, repeated rows, clashing columns."""
    long = prose(1, 6000)
    base = prose(2, 120)
    words = base.split()
    near = [" ".join(words[:k] + ["changed"] + words[k + 1 :]) for k in (0, 3, 60, 119)]
    texts = [None, "", " \n ", "one", "One", "one two three four", "ONE two\tthree\nfour", long, long + " tail", base, base, *near, prose(3, 80), "a b c d e", "é ü 日本 <|endoftext|> x", "a\n\nb\n"]
    rows = [(k, t, [None, "en", "fr"][k % 3], ["src0", None, "src1"][k % 3 if k > 5 else 0], 0, "x", 1, 2, "y", "z") for k, t in enumerate(texts)]
    return [*rows, rows[9], (None, base, "en", "src0", 0, "x", 1, 2, "y", "z")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


def find(parent: dict, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def shingles(text: str | None) -> frozenset:
    low = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
    w = re.findall(rb"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(texts: dict[int, str | None]) -> dict[int, int]:
    sets = {k: shingles(t) for k, t in texts.items()}
    parent = {k: k for k in sets}
    by = defaultdict(list)
    for k, s in sets.items():
        for x in s:
            by[x].append(k)
    for a, b in {p for v in by.values() for p in itertools.combinations(sorted(v), 2)}:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = find(parent, a), find(parent, b)
            parent[max(x, y)] = min(x, y)
    return {k: find(parent, k) for k in sets}


def test_jaccard_awkward(spark, docs, empty):
    got = ngram_jaccard_join(docs).collect()
    texts = {r[0]: r[1] for r in awkward() if r[0] is not None}
    want = brute_components(texts)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == sorted(
        (k, len(shingles(texts[k])), want[k]) for k in [*texts, 9]
    )
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert ngram_jaccard_join(empty).count() == 0
    kept = {r.doc_id for r in without_near_copies(docs).collect()}
    assert kept == {k for k, c in want.items() if k == c} | {None}


def test_jaccard_hot_group(spark):
    """Many near copies of one text, some far from the first, and a passage in all the others."""
    base, passage = prose(5, 60).split(), prose(6, 30)
    r = np.random.default_rng(0)
    rows = []
    for k in range(150):
        w = list(base)
        for j in r.choice(60, size=k % 6, replace=False):
            w[j] = f"new{r.integers(1000)}"
        rows.append((k, " ".join(w)))
    rows += [(200 + k, prose(100 + k, 40) + " " + passage) for k in range(100)]
    got = {r.doc_id: r.component_id for r in ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(dict(rows))


def brute_links(texts: list[tuple]) -> dict[int, int]:
    """Other rows that each row's text is linked with."""
    sets = [(k, shingles(t)) for k, t in texts]
    found = Counter({k: 0 for k, _ in sets})
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * (c := len(x & y)) >= 75 * (len(x) + len(y) - c):
            found[a] += 1
            found[b] += 1
    return dict(found)


def test_jaccard_table(spark, table):
    rows = QUERIES["op1_ngram_jaccard"](spark, SF).collect()
    texts = [(r.doc_id, r.text) for r in table("documents").select("doc_id", "text").collect()]
    assert {r.doc_id: r.component_id for r in rows} == brute_components(dict(texts))
    assert {r.doc_id: r.n_links for r in rows} == brute_links(texts)


def test_jaccard_links_in_cells(spark, monkeypatch):
    """Counts over many parts of a component, with exact copies; a template at 0.70 gives no pairs."""
    monkeypatch.setattr(tiles, "CELL_ITEMS", 16)
    base, r = prose(31, 90).split(), np.random.default_rng(2)
    texts = []
    for k in range(90):
        w = list(base)
        for j in r.choice(90, size=k % 5, replace=False):
            w[j] = f"new{r.integers(9)}"
        texts.append((k, " ".join(w)))
    for k in range(60):  # all like one template, below the threshold to each other and to it
        w = list(base)
        for j in (10, 30, 50):
            w[j] = f"own{k}x{j}"
        texts.append((100 + k, " ".join(w)))
    rows = ngram_jaccard_join(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {x.doc_id: x.component_id for x in rows} == brute_components(dict(texts))
    assert {x.doc_id: x.n_links for x in rows} == brute_links(texts)


def test_cell_links_are_few():
    """2,000 sets that share 0.70 with one template and no more with each other: no link leaves the
    cell; with one set near all of them, at most one for each."""
    r = np.random.default_rng(5)
    template = np.unique(r.integers(0, 1 << 62, size=200, dtype=np.uint64))
    sets = [np.unique(np.concatenate([r.choice(template, 166, replace=False), r.integers(0, 1 << 62, size=36, dtype=np.uint64)])) for _ in range(2000)]
    a, _ = tiles._Cell([(k, k, 0) for k in range(len(sets))], sets, 3, 4).links()
    assert len(a) == 0
    near = [np.unique(np.concatenate([template[5:], x[:3]])) for x in sets]
    a, b = tiles._Cell([(k, k, 0) for k in range(len(near) + 1)], [template, *near], 3, 4).links()
    assert len(a) == 2000




def test_overlap_bound():
    r = np.random.default_rng(3)
    for n, m, common in ((5, 9, 3), (400, 900, 350), (300, 310, 0), (1, 1, 1)):
        pool = r.integers(0, 1 << 63, size=n + m, dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:common], pool[n : n + m - common]]))
        assert len(np.intersect1d(a, b)) <= overlap_bound(len(a), bitmap(a), len(b), bitmap(b)) <= min(len(a), len(b))


def test_components(spark):
    r = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 300, size=(220, 2))] + [(1, 1), (7, 8), (8, 7)] + [(k, k + 1) for k in range(400, 460)]
    parent = {k: k for e in edges for k in e}
    for a, b in edges:
        x, y = find(parent, a), find(parent, b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(k, k) == find(parent, k) for k in parent)


def test_token_counts(spark, docs, empty, table):
    path = tokenizer_path("byte_bpe_50k.json")
    library = load_tokenizer(path)
    size = lambda t: len(library.encode(t or "", add_special_tokens=False))
    for df in (docs, table("documents")):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = [tuple(r) for r in token_counts(df, path).collect()]
        assert Counter(got) == Counter((k, len((t or "").encode()), size(t), size(t) > 512) for k, t in rows)
    assert token_counts(empty, path).count() == 0
    whole = proven_whole(path)
    assert " the" in whole and all(size(t) == 1 for t in sorted(whole)[::500])


RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"), ("org", "/es/", "allow")]


@pytest.mark.parametrize(
    "url, want",
    [
        ("http://A.Example.COM/en/7x?y", ("a.example.com", "/en/7x", "example.com/en/7", "allow")), ("http://example.com/en/8", ("example.com", "/en/8", "com/en/", "block")),
        ("http://notexample.net/de/8", ("notexample.net", "/de/8", "net/de/", "allow")), ("http://x.example.net/de/8#a", ("x.example.net", "/de/8", "example.net/de/8", "block")),
        ("https://org/es/", ("org", "/es/", "org/es/", "block")), ("http://a.org?/es/", ("a.org", "", None, "allow")), ("no scheme.com/en/", ("", "", None, "allow")),
        (None, ("", "", None, "allow")), ("http://..com/en/", ("..com", "/en/", "com/en/", "block")), ("x://y://z.com/en/", ("y:", "//z.com/en/", None, "allow")),
    ],
)
def test_url_filters(spark, url, want):
    pages = spark.createDataFrame([(1, url, "h"), (1, url, "h"), (2, url, "k")], "page_id long, url string, host string")
    got = judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got) == Counter([(1, *want), (1, *want), (2, *want)])


def test_url_filters_long(spark):
    """A very long path, a host of very many labels, nothing but a scheme, one URL on a third of the rows."""
    urls = ["http://x.net/de/" + "a" * 200_000, "http://" + "a." * 400 + "com/en/q", "://", None, "", *["http://y.org/es/1"] * 40]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect()}
    assert got[0] == ("net/de/", "allow") and got[1] == ("com/en/", "block") and got[2] == got[3] == got[4] == (None, "allow")
    assert len(got) == len(urls) and {got[k] for k in range(5, 45)} == {("org/es/", "block")}


def test_url_filters_without_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r)[2:] for r in judge_urls(pages, none).collect()] == [("a.b", "/c", None, "allow")]
    assert judge_urls(pages.where("false"), none).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF).toPandas(), connection.execute(ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    plain = lambda f: sorted(map(repr, f[columns].astype(object).where(f[columns].notna(), None).values.tolist()))
    assert plain(got) == plain(want)


def test_language(spark, docs, empty, table):
    real = table("documents")
    model = learn(real.where(~held_out("doc_id")))
    got = QUERIES["op4_language_id"](spark, SF).join(real.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(got) == real.count() and len(held) > 20 and (held.lang == held.lang_pred).mean() > 0.95
    assert got.held_out.tolist() == [zlib.crc32(str(k).encode()) % 4 == 2 for k in got.doc_id]
    odd = identify(docs, model).collect()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in odd if not re.search(r"[^\W\d_]", r.text or "")) and len(odd) == len(awkward())
    assert all(0 <= r.score <= 1 for r in odd)
    assert identify(empty, model).count() == 0
    blank = learn(empty)
    assert {r.lang_pred for r in identify(docs, blank).collect()} == {"und"}


def test_language_mixture(spark, table):
    """Half of one language and half of another: both proportions come out."""
    rows = {r.lang: r.text for r in table("documents").where("length(text) > 1500").collect()}
    model = learn(table("documents"))
    mixed = spark.createDataFrame([(rows["en"][:1500] + " " + rows["de"][:1500],)], "text string")
    got = identify(mixed, model).first()
    assert got.lang_pred in ("en", "de") and 0.4 < got.score < 0.65


def mixture_model(score: np.ndarray, steps: int = 8) -> np.ndarray:
    """Proportions of one document from its words' log-likelihoods (words x languages): plain
    loops of expectation maximisation, nested sets of languages, Bayes' information criterion."""

    def run(languages):
        share = {k: 1 / len(languages) for k in languages}
        part = lambda row: {k: share[k] * math.exp(row[k] - max(row)) for k in languages}
        for _ in range(steps):
            sums = dict.fromkeys(languages, 0.0)
            for row in score:
                p = part(row)
                for k in languages:
                    sums[k] += p[k] / max(sum(p.values()), 1e-30)
            share = {k: v / len(score) for k, v in sums.items()}
        return share, sum(math.log(max(sum(part(row).values()), 1e-30)) + max(row) for row in score)

    n, languages = len(score), score.shape[1]
    single = score.sum(axis=0)
    best, cost = {int(single.argmax()): 1.0}, -2 * single.max()
    order = sorted(range(languages), key=lambda k: -run(range(languages))[0][k]) if languages > 1 else [0]
    for size in range(2, languages + 1):
        share, log = run(order[:size])
        now = -2 * log + (size - 1) * math.log(n)
        if now < cost:
            best, cost = share, now
    return np.array([best.get(k, 0.0) for k in range(languages)])


def test_language_mixture_against_loops(spark):
    """Documents of up to six languages: proportions as plain loops give them."""
    r = np.random.default_rng(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = [["".join(letters[(k * 4 + j) % 26] for j in r.integers(0, 9, size=r.integers(3, 8))) for _ in range(40)] for k in range(6)]
    speak = lambda k, n: [vocabulary[k][j] for j in r.integers(40, size=n)]
    model = learn(spark.createDataFrame([(" ".join(speak(k, 300)), f"l{k}") for k in range(6) for _ in range(4)], "text string, lang string"))
    texts = [" ".join(w for k in r.permutation(6)[:size] for w in speak(k, int(r.integers(10, 60)))) for size in (1, 2, 3, 5, 5, 6, 6) for _ in range(3)]
    got = identify(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()
    many = 0
    for row in got:
        raw = np.frombuffer(row.text.encode(), np.uint8)
        bins, starts, _ = _word_trigrams(raw, np.array([0, len(raw)]))
        score = np.stack([np.add.reduceat(model.logp[k][bins].astype(float), starts) for k in range(6)], axis=1)
        want = mixture_model(score)
        many += (want > 0.02).sum() >= 5
        assert row.lang_pred == f"l{want.argmax()}" and row.score == pytest.approx(want.max(), abs=0.005)
    assert many >= 5


def test_language_of_a_text_alone(spark, table):
    """A row's answer is the same alone, in any order and beside any others."""
    model = learn(table("documents").where(~held_out("doc_id")))
    r = np.random.default_rng(12)
    words = {x.lang: x.text.split() for x in table("documents").where("lang is not null and length(text) > 300").collect()}
    langs = sorted(words)
    texts = []
    for _ in range(150):
        used = [langs[k] for k in r.choice(len(langs), size=int(r.integers(1, len(langs) + 1)), replace=False)]
        texts.append(" ".join(words[x][k] for x in used for k in r.integers(len(words[x]), size=int(r.integers(1, 12)))))
    schema = "doc_id long, text string"
    rows = list(enumerate(texts))
    together = {x.doc_id: (x.lang_pred, x.score) for x in identify(spark.createDataFrame(rows, schema).coalesce(1), model).collect()}
    turned = {x.doc_id: (x.lang_pred, x.score) for x in identify(spark.createDataFrame(rows[::-1], schema).repartition(5), model).collect()}
    alone = {x.doc_id: (x.lang_pred, x.score) for x in identify(spark.createDataFrame(rows, schema).repartition(150), model).collect()}
    assert together == turned == alone and len({x for x, _ in together.values()}) == len(langs)


def test_hilbert():
    side = 8
    points = np.array(list(itertools.product(range(side), repeat=3)))
    order = points[np.argsort(hilbert(points, 3))]
    assert sorted(hilbert(points, 3)) == list(range(side**3))
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def check_packing(rows, texts: list[tuple], path: str, length: int):
    library = load_tokenizer(path)
    want = Counter()
    for k, t in texts:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[k, len(ids), zlib.crc32(ids.tobytes())] += 1
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for pieces in by_sequence.values():
        ends = list(itertools.accumulate(n for _, n in sorted(pieces)))
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]]
        assert ends[-1] == length or ends[-1] & (ends[-1] - 1) == 0 and ends[-1] < length
    assert sum(r.length for r in rows) == sum(n * c for (_, n, _), c in want.items())
    library_ids = {k: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for k, t in texts}
    for r in rows:
        if r.doc_id is not None:
            ids = library_ids[r.doc_id]
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())


ODD_CHARACTERS = [chr(k) for k in range(0x250)] + list("\u0300\u0301\u0327\u0345\u0384\u1100\u1161\u11a8\u1680\u2003\u2028\u2029\u202f\u205f\u212a\u212b\u3000\ufb01\uff21\U0001d400\U0001f600日本ΣσςİıſẞǅŒ")


def odd_texts(n: int, seed: int) -> list[str]:
    """Texts of odd characters, contractions, special strings and some plain words."""
    r = np.random.default_rng(seed)
    plain = [*"abcxyzABC'\"<|>.,;0123456789 \n\t", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|", "word", " Word", "can't ", "ÉCOLE ", "straße", "e\u0301"]
    picks = r.integers(0, 3, size=(n, 24))
    return ["".join(plain[r.integers(len(plain))] if p else ODD_CHARACTERS[r.integers(len(ODD_CHARACTERS))] for p in row[: r.integers(1, 24)]) for row in picks]


def test_packing_gives_every_id():
    """Ids of texts with control characters, marks, odd spaces and special strings: the library's."""
    path = tokenizer_path("word_bpe_49k.json")
    texts = ["a\x00b \x1b[0m bell\x07", "x\x7fy", "\x7f", "\x01 \x02a.\x03", *odd_texts(10_000, 11)]
    coded = load_tokenizer(path).encode_batch(texts, add_special_tokens=False)
    want = [[*e.ids, 1] for e in coded]
    encoder = _Encoder(path)
    raw, offsets = text_buffer(pa.array(texts))
    for _ in range(2):  # with pieces that are new, then known
        ids, sizes = encoder.encode(raw, offsets, 1)
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert [t for t, a, b in zip(texts, got, want, strict=True) if a != b] == []


def test_packing(spark, docs, empty, table):
    path = tokenizer_path("word_bpe_49k.json")
    for df, length in ((docs, 64), (table("documents"), 2048)):
        texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        check_packing(pack_documents(df, path, length).collect(), texts, path, length)
    assert pack_documents(empty, path).count() == 0


def test_sharding(spark, docs, empty, table):
    for df, shards in ((docs, 3), (table("documents"), 24)):
        rows = kd_shards(df, shards).collect()
        given = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in df.collect())
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == given
        assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None} and all(0 <= r.shard < shards for r in rows)
        slots = defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert kd_shards(empty, 3).count() == 0


def test_sharding_balance(spark):
    """A hot source and a group of copies with a third of all bytes: shards stay near equal."""
    rows = [(k, "x" * (50 + k % 60), "en", "hot" if k % 3 else f"s{k % 7}") for k in range(2000)] + [(5000 + k, "copy of one text" * 5, "en", "hot") for k in range(1000)]
    got = kd_shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 7).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    sizes = [r.b for r in got]
    assert len(sizes) == 7 and max(sizes) < 1.03 * sum(sizes) / 7


def tree_model(rows: list[tuple], shards: int) -> dict[int, int]:
    """The shard of each (id, text, source, lang), one cut of sorted keys after the other."""
    from placeweave.llm import sharding as S

    h = lambda x: xxhash.xxh64_intdigest(x, seed=42)
    size = {k: len((t or "").encode()) + 8 for k, t, *_ in rows}
    crc = {k: zlib.crc32((t or "").encode()) for k, t, *_ in rows}
    value = {k: [h((x or "").encode()) % S.VALUES for x in (s, g)] + [min(S.VALUES - 1, int(math.log2(size[k] - 7) * S.VALUES / 32))] for k, _, s, g in rows}
    places = []
    for d in range(3):
        mass = Counter()
        for k in size:
            mass[value[k][d]] += size[k]
        places.append({v: sum(m for w, m in mass.items() if w < v) * ((1 << S.DIM_BITS) - 1) // sum(mass.values()) for v in mass})
    leader = {}
    for k in sorted(size):
        leader.setdefault((crc[k], size[k]), k)
    at = {k: [places[0][value[leader[crc[k], size[k]]][0]], places[1][value[leader[crc[k], size[k]]][1]], places[2][value[k][2]]] for k in size}
    tie = {k: (crc[k] << S.ID_BITS) + h(k.to_bytes(8, "little", signed=True)) % (1 << S.ID_BITS) for k in size}
    out = {}

    def split(ids: list[int], first: int, k: int) -> None:
        if k == 1 or not ids:
            out.update(dict.fromkeys(ids, first))
            return
        d = max(range(3), key=lambda j: max(at[i][j] for i in ids) - min(at[i][j] for i in ids))
        key = {i: (at[i][d] << (S.KEY_BITS - S.DIM_BITS)) + tie[i] for i in ids}
        goal, cut = sum(size[i] for i in ids) * (k // 2) / k, None
        for bits in (S.ID_BITS, 0):
            sums = Counter()
            for i in ids:
                sums[key[i] >> bits] += size[i]
            before = 0
            for x in sorted(sums):
                if before + sums[x] >= goal:
                    break
                before += sums[x]
            if bits == 0 or sum(key[i] >> bits == x for i in ids) == 1:
                cut = (x + (goal - before > before + sums[x] - goal)) << bits
                break
        split([i for i in ids if key[i] < cut], first, k // 2)
        split([i for i in ids if key[i] >= cut], first + k // 2, k - k // 2)

    split(list(size), 0, shards)
    return out


def test_sharding_is_the_tree(spark):
    r = np.random.default_rng(17)
    rows = [(k, prose(k, int(r.integers(1, 80))), f"s{min(int(r.integers(9)), 4)}", ["en", "fr", None][k % 3]) for k in range(300)]
    rows += [(400 + k, "one text of many copies " * 4, f"s{k % 3}", "en") for k in range(120)] + [(600, None, None, None), (601, "", "s0", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    for shards in (2, 5, 7):
        assert {x.doc_id: x.shard for x in kd_shards(df, shards).collect()} == tree_model(rows, shards)
    plain = kd_shards(df.select("doc_id", "text"), 3)  # without metadata
    assert plain.count() == len(rows) and plain.select("shard").distinct().count() == 3


def brute_lines(texts: list[tuple]) -> dict:
    filled = sorted({(k, i, line) for k, t in texts if k is not None for i, line in enumerate((t or "").split("\n")) if line.strip(" \t\r\n\x0b\x0c")})
    sets = {line: {line[i : i + 8] for i in range(len(line) - 7)} if len(line) >= 8 else {line} for _, _, line in filled}
    parent = {line: line for line in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if 4 * (c := len(sets[a] & sets[b])) >= 3 * (len(sets[a]) + len(sets[b]) - c):
            parent[find(parent, b)] = find(parent, a)
    first = {}
    for k, i, line in filled:
        first.setdefault(find(parent, line), (k, i))
    keep, known = set(first.values()), {(k, i) for k, i, _ in filled}
    return {k: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (k, i) not in known or (k, i) in keep) for k, t in texts if k is not None}


def test_line_dedup(spark, docs, empty):
    line = prose(9, 40)
    near = line[:100] + "changes here" + line[104:]
    extra = spark.createDataFrame([(100, f"{line}\nshort\n\nshort"), (101, f"new start of text\n{near}\nshort"), (102, line.upper())], "doc_id long, text string")
    for df in (docs.select("doc_id", "text", "doc", "n"), extra):
        texts = [(r.doc_id, r.text) for r in df.collect()]
        rows = dedup_lines(df).collect()
        want = brute_lines(texts)
        assert len(rows) == len(texts)
        assert all(r.text == want[r.doc_id] for r in rows if r.doc_id is not None)
    assert dedup_lines(empty).count() == 0


def test_line_dedup_short_edits(spark):
    """A single edit in a line of 20 to 62 characters; two edits of a short line are no link."""
    assert (1 - 0.75**ROWS) ** BANDS < 0.0002
    rows, gone, r = [], set(), np.random.default_rng(8)
    for n in range(20, 63):
        line = "".join(chr(97 + k) if k < 26 else " " for k in r.integers(28, size=n - 2))
        line = f"a{line}z"
        at = int(r.integers(1, n - 1))
        edited = [line[:at] + "é" + line[at + 1 :], line[:at] + "日" + line[at:], line[:at] + line[at + 1 :] if n > 20 else line]
        twice = f"a{line[1 : n // 3]}X{line[n // 3 + 1 : 2 * n // 3]}Y{line[2 * n // 3 + 1 :]}"
        for k, x in enumerate([line, *edited, *([twice] if n < 60 else [])]):
            rows.append((10 * n + k, f"{x}\n\n-"))
            if 0 < k < 4:
                gone.add(10 * n + k)
    got = {x.doc_id: x.text for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {k: "" if k in gone else t.split("\n")[0] + "\n" for k, t in rows}
    want[200] += "\n-"
    assert got == want


def test_line_dedup_recall(spark):
    """Planted pairs of lines at similarities from 0.75 to 0.9: at least 99 % share a tile and are linked."""
    r, letters = np.random.default_rng(41), np.array(list("abcdefghijklmnopqrstuvwxyz     "))
    sets = lambda x: {x[i : i + 8] for i in range(len(x) - 7)}
    rows, pairs = [], 0
    while pairs < 3000:
        line = "".join(letters[r.integers(len(letters), size=int(r.integers(90, 300)))]).strip() + "."
        other = list(line)
        for at in r.choice(len(line) - 1, size=max(1, int(len(line) * r.uniform(0.008, 0.018))), replace=False):
            other[at] = "#"
        other = "".join(other)
        x, y = sets(line), sets(other)
        if 0.75 <= len(x & y) / len(x | y) < 0.9:
            rows += [(2 * pairs, line), (2 * pairs + 1, other)]
            pairs += 1
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).where("doc_id % 2 = 1 and n_dropped = 1").count()
    assert got >= 0.99 * pairs


def test_line_dedup_long_document(spark):
    """A document of very many repeated lines takes time linear in its lines."""
    rows = [(1, "\n".join(["the same line again and again"] * 300_000 + ["a last line of its own"]))]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).first()
    assert got.text == "the same line again and again\na last line of its own" and got.n_dropped == 299_999


def frame(index, palette=b"\0\0\0\xff\0\0\0\xff\0\0\0\xff", flags=0x81, disposal=0, clear=None, left=0, top=0, w=2, h=2, interlace=False, delay=7) -> bytes:
    """A frame of four colours (root of two bits): a clear code before each sample keeps codes at three bits."""
    bits = "".join(f"{c:03b}"[::-1] for s in index for c in (4, s)) + f"{5:03b}"[::-1]
    bits += "0" * (-len(bits) % 8)
    stream = bytes(int(bits[k : k + 8][::-1], 2) for k in range(0, len(bits), 8))
    u = lambda n: n.to_bytes(2, "little")
    control = b"\x21\xf9\x04" + bytes([disposal << 2 | (clear is not None)]) + u(delay) + bytes([clear or 0, 0])
    return control + b"\x2c" + u(left) + u(top) + u(w) + u(h) + bytes([flags | (0x40 if interlace else 0)]) + palette + b"\x02" + gif._blocks(stream)


def picture(*frames: bytes, w=2, h=2) -> bytes:
    return b"GIF89a" + w.to_bytes(2, "little") + h.to_bytes(2, "little") + b"\0\0\0" + b"\x21\xfe\x02hi\0" + b"".join(frames) + b"\x3b"


def pixels(f) -> list:
    return f.canvas.reshape(-1, 4).tolist()


def test_gif_rules():
    black, red, green, blue, none = [0, 0, 0, 255], [255, 0, 0, 255], [0, 255, 0, 255], [0, 0, 255, 255], [0, 0, 0, 0]
    shown = [pixels(f) for f in iter_frames(picture(frame([0, 1, 2, 3]), frame([1], clear=1, w=1, h=1), frame([2], disposal=2, w=1, h=1), frame([3], left=1, w=1, h=1)))]
    assert shown == [[black, red, green, blue], [black, red, green, blue], [green, red, green, blue], [none, blue, green, blue]]
    shown = [pixels(f) for f in iter_frames(picture(frame([0, 0, 0, 0]), frame([1], disposal=3, w=1, h=1), frame([2], left=1, top=1, w=1, h=1)))]
    assert shown[1][0] == red and shown[2] == [black, black, black, green]
    rows = [pixels(f) for f in iter_frames(picture(frame([0, 2, 1, 3], w=1, h=4, interlace=True), w=1, h=4))]
    assert rows == [[black, red, green, blue]]
    assert [f.delay_ms for f in gif.read_gif(picture(frame([0, 1, 2, 3])))] == [70]
    for broken in (b"", b"GIF89a", b"PNG" * 9, picture(frame([0, 1]))[:-1], picture(frame([0, 1, 2, 3], flags=0, palette=b"")), picture(frame([0], left=5, w=1, h=1))):
        with pytest.raises((ValueError, IndexError)):
            list(gif.read_gif(broken))


def iter_frames(data: bytes):
    for f in gif.read_gif(data):
        f.canvas = f.canvas.copy()
        yield f


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 3838, 3839, 3840, 5000, 70_000])
def test_lzw_round_trip(n):
    for data in (np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8).tobytes(), b"ab" * (n // 2), bytes(n), (prose(n, n // 5 + 1).encode())[:n]):
        assert gif.lzw_unpack(gif.lzw_pack(data), 8, len(data)) == data


def test_lzw_deferred_clear():
    """A full table without a clear code goes on with codes of twelve bits."""
    data = np.random.default_rng(5).integers(0, 4, 60_000, dtype=np.uint8).tobytes()
    table, width, following, bits, prefix = {bytes([k]): k for k in range(256)}, 9, 258, [(256, 9)], b""
    for k in range(len(data)):
        word = prefix + data[k : k + 1]
        if word in table:
            prefix = word
            continue
        bits.append((table[prefix], width))
        if following < 4096:
            table[word] = following
            following += 1
            if following - 1 == 1 << width and width < 12:
                width += 1
        prefix = data[k : k + 1]
    bits += [(table[prefix], width), (257, width)]
    text = "".join(f"{c:0{w}b}"[::-1] for c, w in bits)
    text += "0" * (-len(text) % 8)
    stream = bytes(int(text[k : k + 8][::-1], 2) for k in range(0, len(text), 8))
    assert gif.lzw_unpack(stream, 8, len(data)) == data


def plain_lzw(stream: bytes, root: int) -> bytes:
    """The samples of a code stream, one code after the other from a string of bits."""
    bits = "".join(f"{b:08b}"[::-1] for b in stream)
    clear, out, at, width, table, before = 1 << root, [], 0, root + 1, {}, None
    while True:
        code = int(bits[at : at + width][::-1], 2)
        at += width
        if code == clear:
            table, width, before = {k: bytes([k]) for k in range(clear)}, root + 1, None
            continue
        if code == clear + 1:
            return b"".join(out)
        word = table[code] if code in table else before + before[:1]
        if before is not None and len(table) + 2 < 4096:
            table[len(table) + 2] = before + word[:1]
            if len(table) + 2 == 1 << width and width < 12:
                width += 1
        out.append(word)
        before = word


def plain_gif(data: bytes) -> tuple[bytes, int, Counter]:
    """(samples of all frames, frames, colours) of a file as write_gif lays it out."""
    palette, at, frames = data[13 : 13 + 768], 13 + 768, []
    while data[at] != 0x3B:
        at += 8  # the control block
        assert data[at] == 0x2C
        root, at, stream = data[at + 10], at + 11, b""
        while data[at]:
            stream, at = stream + data[at + 1 : at + 1 + data[at]], at + 1 + data[at]
        at += 1
        frames.append(plain_lzw(stream, root))
    samples = b"".join(frames)
    return samples, len(frames), Counter((c, palette[3 * s + c] >> 4) for s in samples for c in range(3))


def test_lines_of_long_documents_in_pieces(monkeypatch):
    from placeweave.llm import line_dedup

    text = "\n".join([prose(k, 3 + k % 9) for k in range(60)] + ["", "x" * 900, "", "end"])
    batch = pa.record_batch([pa.array([1, 2]), pa.array(["a\nb", text])], names=["doc", "text"])
    told = lambda: [(first + int(d), int(n), int(i)) for first, x in line_dedup._line_blocks(batch) for d, n, i in zip(x.doc, x.number, x.ids, strict=True)]
    whole = told()
    monkeypatch.setattr(line_dedup, "_BLOCK_CHARS", 200)
    assert told() == whole and len(whole) == 64


def test_spans_of_long_texts_in_pieces(monkeypatch):
    from placeweave.llm import text_arrays

    column = pa.array([prose(1, 400), None, "x" * 5000 + " y", prose(2, 30)])
    whole = [(k, x.tolist()) for k, x in text_arrays.shingle_sets(column, 3)]
    monkeypatch.setattr(text_arrays, "BLOCK_BYTES", 64)
    assert [(k, x.tolist()) for k, x in text_arrays.shingle_sets(column, 3)] == whole
    assert len(text_arrays._POWERS.up) <= 4 * 64


def test_media_against_plain_decoder(spark):
    """What is stored, decoded by a plain reader: payload, frames and colours; nothing depends on order."""
    texts = ["", "abc", "é日" * 40, prose(21, 700), "aaaa" * 6000, prose(22, 9000)]
    rows = gif.media_digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for row in rows:
        raw = texts[row.doc_id].encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        stored = gif.write_gif(payload)
        samples, frames, colours = plain_gif(stored)
        assert samples == payload and (row.media_bytes, row.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        bins = ",".join(str(colours[c, b]) for c in range(3) for b in range(16))
        assert row.feature == f"frames={frames};ms={100 * frames};histogram={bins}"


def test_gif_too_large():
    huge = b"GIF89a\xff\xff\xff\xff\0\0\0"
    with pytest.raises(ValueError, match="pixels"):
        list(gif.read_gif(huge))


def test_media(spark, docs, empty, table):
    for df in (docs, table("documents")):
        texts = [(r.doc_id, r.text) for r in df.collect()]
        want = Counter()
        for k, t in texts:
            raw = (t or "").encode()
            payload = raw + bytes(-len(raw) % 64 if raw else 64)
            want[k, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])] += 1
        rows = gif.media_digests(df).collect()
        assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == want
        assert all(r.feature.startswith("frames=") for r in rows)
    assert gif.media_digests(empty).count() == 0
    bad = gif.with_frames(spark.createDataFrame([(b"no",), (None,)], "media binary")).collect()
    assert [(r.frames, r.error is not None) for r in bad] == [(None, True), (None, False)]


def test_topk(spark):
    r = np.random.default_rng(6)
    vectors = [(k, [float(x) for x in r.normal(size=4)]) for k in range(300)] + [(300 + k, [0.5, 0.5, 0.5, 0.5]) for k in range(150)]
    odd = [(600, None), (620, [1.0, None, 0.0, 0.0]), (640, [float("nan"), 0.0, 0.0, 0.0]), (660, [float("inf"), 0.0, 0.0, 0.0]), (680, [1.0]), (700, [])]
    got = voronoi_knn_join(spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 5).collect()
    ints = {k: np.floor(64 * np.array(v)).astype(int) for k, v in vectors} | {680: np.array([64, 0, 0, 0]), 700: np.zeros(4, int)}
    want = set()
    for q in (k for k in ints if k % 20 == 0):
        best = sorted((-int(ints[q] @ v), k) for k, v in ints.items() if k != q)[:5]
        want |= {(q, i + 1, k, -s) for i, (s, k) in enumerate(best)}
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in got} == want
    twice = spark.createDataFrame([*[(k, v, "x", 1, None) for k, v in vectors[:60]], (20, vectors[20][1], "y", 2, None)], "vec_id long, embedding array<double>, unit string, block int, cell int")
    again = [(r.query_id, r.rank, r.vec_id) for r in voronoi_knn_join(twice, F.col("vec_id") % 20 == 0, 4).collect()]
    plain = []
    for q in (0, 20, 40):
        best = sorted((-int(ints[q] @ ints[k]), k) for k in [*range(60), 20] if k != q)[:4]
        plain += [(q, i + 1, k) for i, (_, k) in enumerate(best)]
    assert sorted(again) == sorted(plain)  # a repeated id is a candidate each time and asks once
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in voronoi_knn_join(few, F.col("vec_id") % 20 == 0, 5).collect()] == [(0, 1, 1, 64 * 128)]
    assert voronoi_knn_join(few.where("false"), F.col("vec_id") % 20 == 0, 5).count() == 0


@pytest.mark.parametrize("scale", [1.0, 1000.0, 1e6, 1e7])
def test_topk_large_and_negative(spark, monkeypatch, scale):
    """One query against thousands of equal or opposite vectors; all scores may be negative; several units."""
    from placeweave.llm import topk_search

    same = [(0, [-scale, 0.0])] + [(k, [scale, 0.0]) for k in range(1, 5701)]
    got = sorted(tuple(x) for x in voronoi_knn_join(spark.createDataFrame(same, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, 20).collect())
    assert got == [(0, k, k, -int(64 * scale) ** 2) for k in range(1, 21)]
    r = np.random.default_rng(8)
    around = [(k, [float(x) for x in scale * (np.array([3.0, 3.0, 1.0]) + r.normal(size=3) * 0.01)]) for k in range(1, 900)]
    rows = around + [(1000 + 20 * k, [float(x) for x in -scale * (np.array([3.0, 2.0, 1.0]) + r.normal(size=3))]) for k in range(9)]
    monkeypatch.setattr(topk_search, "UNIT_ROWS", 50)
    monkeypatch.setattr(topk_search, "QUERY_ROWS", 4)
    got = sorted(tuple(x) for x in voronoi_knn_join(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") >= 1000, 7).collect())
    ints = {k: [int(np.floor(64 * x)) for x in v] for k, v in rows}
    want = []
    for q in (k for k in ints if k >= 1000):
        best = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=True)), k) for k, v in ints.items() if k != q)[:7]
        want += [(q, i + 1, k, -s) for i, (s, k) in enumerate(best)]
    assert got == sorted(want)


def test_mixing(spark, docs, empty):
    rows = mix_sources(docs).collect()
    assert len(rows) == len(awkward()) and all(0 <= r.probability <= 1 for r in rows)
    assert mix_sources(empty).count() == 0
    many = spark.range(4000).selectExpr("id as doc_id", "repeat('word ', 20) as text", "if(id % 10 < 7, 'big', 'small') as source", "if(id % 3 = 0, 'en', 'fr') as lang")
    share = lambda *xs: spark.createDataFrame(list(xs), "value string, share double")
    targets = {"source": share(("big", 0.5), ("small", 0.5)), "lang": share(("en", 0.4), ("fr", 0.6)), "topic": share(("prose", 1.0))}
    mixed = mix_sources(many, targets=targets, keep=0.5)
    raked = {r.source: r.w for r in mixed.groupBy("source").agg(F.sum(F.col("weight") * F.col("n_tokens")).alias("w")).collect()}
    assert raked["big"] == pytest.approx(raked["small"], rel=1e-6)
    kept = Counter(r.source for r in mixed.where("kept").collect())
    assert abs(kept["big"] - kept["small"]) < 0.15 * sum(kept.values())


def test_mixing_reaches_its_targets(spark):
    """Rare values with weights far above 1 / keep: only copies reach their share."""
    many = spark.range(20_000).selectExpr("id as doc_id", "repeat('word ', 20) as text", "if(id % 50 = 0, 'rare', 'big') as source", "if(id % 20 = 1, 'es', 'en') as lang")
    share = lambda *xs: spark.createDataFrame(list(xs), "value string, share double")
    goals = {"source": {"rare": 0.3, "big": 0.7}, "lang": {"es": 0.2, "en": 0.8}, "topic": {"prose": 1.0}}
    mixed = mix_sources(many, targets={d: share(*g.items()) for d, g in goals.items()}).cache()
    rows = mixed.collect()
    assert all(r.kept == (r.copies > 0) and abs(r.copies - 0.8 * r.weight) < 1 for r in rows) and max(r.copies for r in rows) > 5
    taken = sampled(mixed).cache()
    assert taken.count() == sum(r.copies for r in rows) == taken.select("doc_id", "copy").distinct().count()
    whole = sum(r.n_tokens for r in rows)
    assert taken.agg(F.sum("n_tokens")).first()[0] == pytest.approx(0.8 * whole, rel=0.02)
    for d, goal in goals.items():
        got = {r[0]: r[1] for r in taken.groupBy(d).agg(F.sum("n_tokens")).collect()}
        assert {v: n / sum(got.values()) for v, n in got.items()} == pytest.approx(goal, abs=0.01)


def test_mixing_sample_table(spark, table):
    """The registered sample has each cell's raked tokens, up to a copy's rounding."""
    mixed = mix_sources(table("documents")).collect()
    got = Counter(r.doc_id for r in QUERIES["op10_mixing_sample"](spark, SF).collect())
    assert max(got.values()) > 1 and all(abs(got[r.doc_id] - 0.8 * r.weight) < 1 for r in mixed)


def test_calibrated_sample(spark, docs, empty, table):
    """Expected marginals are the targets, whatever the weights; kept ones within sampling error."""
    many = spark.range(60_000).selectExpr("id as doc_id", "repeat('word ', 20) as text", "if(id % 10 < 9, 'big', 'small') as source", "if(id % 7 = 1, 'es', 'en') as lang")
    share = lambda *xs: spark.createDataFrame(list(xs), "value string, share double")
    goals = {"source": {"small": 0.5, "big": 0.5}, "lang": {"es": 0.3, "en": 0.7}, "topic": {"prose": 1.0}}
    targets = {d: share(*g.items()) for d, g in goals.items()}
    mixed = calibrated_sample(many, targets=targets).cache()
    assert mixed.agg(F.max("probability")).first()[0] == pytest.approx(1.0)
    for d, goal in goals.items():
        for how, tolerance in ((F.col("probability") * F.col("n_tokens"), 1e-8), (F.when(F.col("kept"), F.col("n_tokens")), 0.015)):
            got = {r[0]: r[1] for r in mixed.groupBy(d).agg(F.sum(how)).collect()}
            assert {v: n / sum(got.values()) for v, n in got.items()} == pytest.approx(goal, abs=tolerance)
    report = {(r.dimension, r.value): r for r in shares(mixed, targets).collect()}
    assert all(report[d, v].target == x and report[d, v].expected == pytest.approx(x, abs=1e-8) for d, g in goals.items() for v, x in g.items())
    for r in shares(calibrated_sample(table("documents"))).collect():
        assert r.expected == pytest.approx(r.target, abs=1e-7)
    odd = calibrated_sample(docs).collect()
    assert len(odd) == len(awkward()) and all(0 <= r.probability <= 1 for r in odd)
    assert len({(r.doc_id, r.kept) for r in odd if r.doc_id == 9}) == 1
    assert calibrated_sample(empty).count() == 0
    own = calibrated_sample(many, topic_of=F.when(F.col("doc_id") % 2 == 0, "even"), tokens_of=F.lit(3).cast("long")).first()
    assert own.n_tokens == 3 and own.topic in ("even", None)


def test_other_vocabularies_are_refused(spark, docs):
    with pytest.raises(ValueError, match="split"):
        token_counts(docs, tokenizer_path("word_bpe_49k.json"))
    with pytest.raises(ValueError, match="split"):
        pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


def test_pipeline_awkward(spark, docs, empty):
    """Nulls, blanks, repeated rows and clashing columns pass every stage; an empty table stays empty."""
    import corpus_pipeline

    for start in (docs, empty):
        now = start
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before, now = now, stage(spark, now, SF)
            if k < 4:
                assert now.columns == before.columns
                now = now.cache()
            assert now.count() <= before.count() or k == 4
        assert (start is docs) == (now.count() > 0)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()} if k < 5 else {}
        docs = stage(spark, docs, SF)
        if k < 4:
            docs = docs.cache()
            assert docs.columns == names
            after = {r.doc_id: r.text for r in docs.collect()}
            assert set(after) <= set(before) and len(after) > 0.4 * len(before)
            if k == 1:
                want = brute_lines(list(before.items()))
                assert after == {i: t for i, t in want.items() if t == before[i] or (t or "").strip()}
            elif k == 2:
                found = brute_components(before)
                assert set(after) == {i for i, c in found.items() if i == c}
            else:
                assert all(after[i] == before[i] for i in after)
    path = tokenizer_path("word_bpe_49k.json")
    check_packing(docs.collect(), [(i, t) for i, t in before.items()], path, 2048)
    assert len(texts) >= len(before)

