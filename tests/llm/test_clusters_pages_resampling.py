"""Centroid clusters, main texts and resampling against plain models and planted pages."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from placeweave.llm import resampling
from placeweave.llm.centroids import Bisectors, bisector_clusters, largest_component
from placeweave.llm.main_text import content_lines, extract_main_text, main_text
from placeweave.llm.resampling import count_planes, feature_buckets, gain_planes, importance_resample, sliced_sums

# --- centroid clusters -----------------------------------------------------------


def plain_clusters(rows, k, rounds, dim, scale, seed="2:"):
    """The same rounds with whole distances, in Python's integers."""
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    digest = lambda i: "~" if i is None else hashlib.sha256(f"{seed}{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((square(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(c) // len(members[n]) for c in zip(*members[n], strict=True)] if n in members else old for n, old in enumerate(centroids)]
    found = [(i, *nearest(v)) for i, v in kept]
    sums = Counter()
    for _, d, n in found:
        sums[n] += d
    name = lambda n: hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()
    return sorted(repr((i, n, d, sums[n], sum(sums.values()), name(n))) for i, d, n in found)


VECTORS = "vec_id long, embedding array<double>, cluster string, id int, x string, h int"


def test_clusters_against_whole_distances(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(c) for c in np.round(r.normal(size=3) * 2) / 4]) for i in range(300)]  # coarse: many ties
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0]), (904, [math.nan, 0.0, 0.0]), (905, [math.inf, 0.0, 0.0]), (None, [0.5, 0.5, 0.5])]
    rows += [rows[3]] * 40 + [(7, [0.25, 0.25, 0.25]), (None, [0.5, 0.5, 0.5])]
    df = spark.createDataFrame([(i, v, "a", 1, "b", 2) for i, v in rows], VECTORS)
    for k, rounds in ((1, 2), (7, 0), (7, 3), (40, 5), (500, 2)):
        got = sorted(repr(tuple(x)) for x in bisector_clusters(df, k=k, rounds=rounds, dim=3, scale=4).collect())
        assert got == plain_clusters(rows, k, rounds, 3, 4), (k, rounds)
    shuffled = sorted(repr(tuple(x)) for x in bisector_clusters(df.repartition(7), k=7, rounds=3, dim=3, scale=4).collect())
    assert shuffled == plain_clusters(rows, 7, 3, 3, 4)


def test_clusters_edges(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "a", 1, "b", 2)], VECTORS)
    assert bisector_clusters(df.where("false"), dim=2).collect() == []
    assert bisector_clusters(df, dim=3).collect() == []
    assert [r.cluster for r in bisector_clusters(df, dim=2).collect()] == [0]
    with pytest.raises(ValueError, match="bytes"):
        bisector_clusters(df, k=100_000, dim=2)
    with pytest.raises(Exception, match="do not fit a long"):
        bisector_clusters(spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>"), dim=2).collect()


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 5), st.integers(0, 10_000), st.booleans())
def test_tournament_is_the_nearest(k, dim, seed, large):
    r = np.random.default_rng(seed)
    top = largest_component(dim) if large else 3
    c, x = r.integers(-top, top + 1, (k, dim)), r.integers(-top, top + 1, (50, dim))
    x[:k] = c
    number, distance = Bisectors(c).nearest(x)
    for row, n, d in zip(x.tolist(), number, distance, strict=True):
        whole = [sum((a - b) ** 2 for a, b in zip(row, other, strict=True)) for other in c.tolist()]
        assert (int(n), int(d)) == (whole.index(min(whole)), min(whole))


# --- main text ---------------------------------------------------------------------

PARAGRAPHS = ["The first paragraph of the article is long enough to be read as such by anyone.", "Short one.", "A third one, with <b>bold</b> words &amp; signs &lt;p&gt; and a <a href='/x'>link</a> in it."]
PLAIN = ["The first paragraph of the article is long enough to be read as such by anyone.", "Short one.", "A third one, with bold words & signs <p> and a link in it."]
AROUND = [
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>All news</a></li></ul></nav>",
    "<header><h1>The site's name</h1><p>With a long tagline that says what it is all about, every day anew.</p></header>",
    "<div class='ad'>Buy this now, it is the best that was ever made, and it costs nothing at all today.</div>",
    "<div id='cookie-notice' role='alert'>We use cookies to make this page better for you, and for others too.</div>",
    "<aside><p>Most read: a long list of other things that people have read on this page today.</p></aside>",
    "<div class='widget sidebarLeft'><p>About us: we write about a lot of things and we like to do so.</p></div>",
    "<form action='/s'><label>Name</label><input name='n'><p>Please fill in all the fields of this form below.</p><button>Go</button></form>",
    "<section class='comments'><h2>Comments</h2><article class='comment'><p>I do not agree with anything that is said above, as I said before.</p></article></section>",
    "<script>var t='</p><p>no text of any kind, however long it may be, is part of it</p>';</script><style>p{margin:0}</style>",
    "<!-- <p>nothing in here is part of the article, it is only a comment</p> --><noscript><p>Please turn on scripts to read this page in full.</p></noscript>",
    "<footer>&copy; somebody &middot; all rights are reserved, in all countries of the world, for ever.</footer>",
    "<div style='display: none'><p>Nobody can see this text as it is hidden from all that read the page.</p></div>",
]


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>Of a page</title></head><body class='has-sidebar comments-open'>{body}</body></html>"


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main><article>{}</article></main>", "<main>{}</main>", "<div class='page'><div class='post-content'>{}</div></div>", "<div itemprop='articleBody'>{}</div>", "{}"])
@pytest.mark.parametrize("around", AROUND)
def test_planted_parts_go(wrap, around):
    paragraphs = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    inner = f"<h1>A heading</h1>{paragraphs}"
    want = "\n\n".join(["A heading", *PLAIN])
    assert main_text(page(around + wrap.format(inner) + AROUND[-2])) == want
    if around.startswith("<header>") and re.search("article|main", wrap):  # an article's own head keeps its headings
        return
    assert main_text(page(wrap.format(inner + around) + around)) == want
    assert main_text(page(wrap.format(f"<h1>A heading</h1>{around}{paragraphs}"))) == want


def test_blocks_of_an_article():
    told = "<article><h1>T</h1>loose<p>a<br>b<p><b>c<p>d<ul><li>e<li>f <i>g</i></ul><table><tr><td>h<td>i</table><blockquote><p>j</blockquote>\n k\n\tl&nbsp;m <pre>n\n  o</pre></article>"
    assert main_text(page(told)).split("\n\n") == ["T", "loose", "a b", "c", "d", "e", "f g", "h", "i", "j", "k l m", "n o"]
    assert main_text("<article><header><h2>T</h2><span>by someone</span></header><p>x</p><article>a comment</article><p>y</p></article>") == "T\n\nx\n\ny"
    assert main_text(page("<nav><ul><li>m<article><p>menus that nothing closes end at the article</p></article>")) == "menus that nothing closes end at the article"
    assert main_text(page("<div><ul>" + "<li><a href='/'>link</a></li>" * 30 + "</ul></div><div><p>Here is what there is to say.</p><p>No more.</p></div>")) == "Here is what there is to say.\n\nNo more."


def test_whole_pages_cut_pages_and_odd_ones():
    long = "x" * 3_000_000 + " " + "y &amp; " * 300_000
    assert main_text(f"<article><p>{long}</p></article>") == " ".join(long.replace("&amp;", "&").split())
    many = "".join(f"<p>p{k}</p>" for k in range(20_000))
    assert main_text(page(f"<article>{many}")).split("\n\n") == [f"p{k}" for k in range(20_000)]
    deep = "<div>" * 3000 + "<p>deep down</p>"
    assert main_text(deep) == "deep down"
    for odd in ("", "   ", "<article>", "</article></p>", "<nav>only a menu</nav>", "<script>", "<!-- x", "<p", "<article><p></p></article>"):
        assert main_text(odd) == "", odd
    assert main_text("<article><p>a < b & c <!-- <p>x</p>") == "a < b & c"
    assert main_text("<article><p>one <b>two</b> <a hre") == "one two"
    assert main_text("just words, no tags") == "just words, no tags"
    assert main_text(page("<article><p>cut off in the mid")) == "cut off in the mid"


def test_content_lines_part_two_clusters():
    chars = np.array([4, 5, 6, 4, 200, 180, 20, 220, 5, 6, 4, 5])
    found = content_lines(chars, np.array([2] * 4 + [1] * 4 + [2] * 4))
    assert found[4:8].all() and not found[[0, 1, 10, 11]].any()
    assert content_lines(np.zeros(0, int), np.zeros(0, int)).tolist() == []
    assert content_lines(np.array([5, 5]), np.array([1, 1])).all()


def test_pages_table(spark):
    rows = [(1, "http://a", page("<article><p>x</p></article>"), "t", 1), (None, None, None, None, None), (2, "u", "", "t", 2), (2, "u", "", "t", 2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted(map(repr, (tuple(r) for r in extract_main_text(df).collect())))
    assert got == sorted(map(repr, [(1, "http://a", "x", 1), (None, None, "", 0), (2, "u", "", 0), (2, "u", "", 0)]))
    assert extract_main_text(df.where("false")).collect() == []


# --- resampling ----------------------------------------------------------------------


def plain_resample(docs, target, percent, least, longest, buckets, seed):
    def features(text):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        runs = [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(x.encode()) % buckets for x in runs]

    held, wanted = Counter(), Counter()
    found = [(i, *features(t)) for i, t in docs]
    for _, _, f in found:
        held.update(f)
    for t in target:
        wanted.update(features(t)[1])
    of_held, of_wanted = sum(held.values()), sum(wanted.values())
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (of_held + buckets) / ((held[b] + 1) * (of_wanted + buckets))))
    out = []
    for i, n, f in found:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    can = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], -1 if x[0] is None else x[0]))
    for k, x in enumerate(can[: percent * len(can) // 100]):
        x[5] = k + 1
    return sorted(repr((i, n, w, s, r)) for i, _, n, w, s, r in out)


@pytest.mark.parametrize("percent, least, longest, buckets", [(10, 20, 1, 10_000), (50, 2, 1, 7), (100, 0, 2, 100), (35, 1, 3, 64), (0, 1, 1, 1000)])
def test_resampling_against_counters(spark, monkeypatch, percent, least, longest, buckets):
    monkeypatch.setattr(resampling, "PIECE_BYTES", 64)
    r = np.random.default_rng(9)
    words = [*"abcdefghij", "Été", "日本", "x1", "don't", "_", "A-B", "ZÜRICH"]
    texts = [" ".join(words[k] for k in r.integers(len(words), size=n)) for n in r.integers(0, 60, 200)]
    rows = list(enumerate(texts)) + [(300, None), (301, ""), (302, " \n"), (None, "a b c " * 30), (303, "x" * 5000 + " a " + "y" * 3000), (304, "a " * 4000)]
    rows += [rows[5]] * 3 + [(400 + k, texts[7]) for k in range(30)]
    target = [texts[3], None, "", "a b c d e f g h", "日本 " * 9]
    docs = spark.createDataFrame([(i, t, 1, "a", 2) for i, t in rows], "doc_id long, text string, rank int, id string, n_words int")
    goals = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string")
    # small pieces in the workers too: what they import is the module's own value, so the long texts above are cut there as well
    got = sorted(repr((x.doc_id, x.n_features, x.weight, x.score, x.rank)) for x in importance_resample(docs, goals, percent, least, longest, buckets, seed=3).collect())
    assert got == plain_resample(rows, target, percent, least, longest, buckets, 3)


def test_resampling_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = docs.where("false")
    assert importance_resample(none, docs).collect() == []
    assert [(r.doc_id, r.rank) for r in importance_resample(docs, none, percent=100, least_words=1).collect()] == [(1, 1)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 200), st.integers(0, 5))
def test_planes_give_the_sums(seed, buckets, docs):
    r = np.random.default_rng(seed)
    gains = r.integers(-3000, 3000, buckets)
    doc = np.sort(r.integers(0, max(docs, 1), 300 if docs else 0))
    bucket = np.minimum(r.geometric(0.1, len(doc)) - 1, buckets - 1)
    want = np.bincount(doc, weights=gains[bucket], minlength=docs) if docs else np.zeros(0)
    assert sliced_sums(doc, bucket, docs, gain_planes(gains), buckets).tolist() == want.tolist()
    assert all(p.shape == (docs, -(-buckets // 64)) for _, p in count_planes(doc, bucket, docs, buckets))


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 1 << 20])
def test_words_are_not_cut(monkeypatch, piece):
    monkeypatch.setattr(resampling, "PIECE_BYTES", piece)
    text = "Ein Wort, zwei WÖRTER; 日本 und x1\n" * 9
    assert feature_buckets(text.encode(), 3, 1000)[0] == 7 * 9
    monkeypatch.setattr(resampling, "PIECE_BYTES", 1 << 20)
    whole = sorted(feature_buckets(text.encode(), 3, 1000)[1].tolist())
    monkeypatch.setattr(resampling, "PIECE_BYTES", piece)
    assert sorted(feature_buckets(text.encode(), 3, 1000)[1].tolist()) == whole
