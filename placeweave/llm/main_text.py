"""Main text of web pages by text-to-tag ratios (operator 12).

The standard library's parser streams a page as events.  Text between two block
borders is a line, with the number of tags it took.  The ratios of text to tags are
smoothed by a Gaussian over neighbouring lines and clustered by a threshold into
content and the rest.  The region is the article that holds most content or, on
pages without one, the innermost container that holds nearly all content and no
paragraph beside it.  All lines of the region are kept, however short, but for parts
that say what they are: menus, forms, adverts, notices, comments and the like.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm.shared import released
from placeweave.llm.text_arrays import blocks, text_buffer

#: Width of the Gaussian in lines, and how far it reaches.
SIGMA, REACH = 1.0, 3
#: Share of a container's content that one inner container has to hold to be the region instead.
NEARLY_ALL = 0.8

# Elements and the names that pages give to parts of them.
#: Elements that begin and end a line.
CONTAINERS = frozenset("address article aside blockquote body details dialog div dl fieldset figure footer form header hgroup main menu nav ol section table tbody template tfoot thead ul".split())
PARAGRAPHS = frozenset("caption center dd dt figcaption h1 h2 h3 h4 h5 h6 legend li p pre summary td th tr".split())
BLOCKS = CONTAINERS | PARAGRAPHS | frozenset(["hr", "html", "head"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose text is never part of an article.
NEVER = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form iframe label legend map menu nav noscript object optgroup option output script select style svg template textarea title video".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words in the class or id of parts that are no article.
NAMES = frozenset(
    """ad ads advert adverts advertisement advertisements advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies
    copyright disclaimer disqus footer footnav gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup
    promo promoted promotion recommended related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tagcloud
    toolbar topbar trending widget widgets""".split()
)
#: Words in the class or id of heads of pages.
HEADS = frozenset("branding head header tagline".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an open element of a kind is closed by, when it was not closed itself.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}

#: What ends where a block begins, parts that an article never lies in, and elements that may lie around an article.
LOOSE = HEADINGS | {"p"}
ENDED_BY_ARTICLE = frozenset("form header li nav ol ul".split())
WRAPPERS = frozenset("body div main section table tbody td tr".split())

_SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_CUT = re.compile(r"<[A-Za-z/!?]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Node:
    """An element that holds lines."""

    __slots__ = ("tag", "parent", "skips", "article", "inside", "mass", "chars", "links", "direct", "kept")

    def __init__(self, tag: str, parent: _Node | None, skips: bool, article: bool) -> None:
        self.tag, self.parent, self.skips, self.article = tag, parent, skips, article
        self.inside = article or tag == "main" or (parent is not None and parent.inside)
        #: characters of content lines, of all lines and of links; whether a paragraph stands in it beside its containers
        self.mass = self.chars = self.links = 0
        self.direct = self.kept = False


class _Lines(HTMLParser):
    """Lines (text, characters of links, tags, node) from the parser's events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [_Node("", None, False, False)]  # parents come before what they hold
        self.open = self.nodes[:]
        self.lines: list[tuple[str, int, int, _Node]] = []
        self.text: list[str] = []
        self.links = self.tags = self.in_link = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text or self.tags:
            self.lines.append((text, self.links, self.tags, self.open[-1]))
        self.text, self.links, self.tags = [], 0, 0

    def skips(self, tag: str, told: dict) -> bool:
        """Whether an element says that it is no part of an article."""
        if tag in ("html", "body", "main"):
            return False
        inside = self.open[-1].inside
        if "hidden" in told or _HIDDEN.search(told.get("style") or ""):
            return True
        if tag in NEVER or (told.get("role") or "").lower() in ROLES or (tag == "header" and not inside):
            return True
        if tag == "article" and any(n.article for n in self.open):
            return True  # an article in an article is a comment on it
        words = {w.lower() for key in ("class", "id") for w in _SPLIT.split(told.get(key) or "")}
        return bool(words & NAMES) or (not inside and bool(words & HEADS))

    def leave(self, names: set[str], border: set[str] | frozenset[str]) -> None:
        """Leave the innermost open element of these names, with all in it, unless a border lies between."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in names:
                del self.open[k:]
                return
            if self.open[k].tag in border:
                return

    def begin_block(self, tag: str) -> None:
        """End the line and what cannot go on over the border of a block."""
        self.end_line()
        while len(self.open) > 1 and (self.open[-1].tag in LOOSE or self.open[-1].tag not in BLOCKS | NEVER):
            self.open.pop()
        if tag in CLOSED_BY:
            self.leave(*CLOSED_BY[tag])
        if tag in ("article", "main"):
            while self.open[-1].tag in ENDED_BY_ARTICLE:
                self.open.pop()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.text.append(" ")
        elif tag == "a":
            self.in_link = 1
        if tag in BLOCKS:
            self.begin_block(tag)
        self.tags += 1
        if tag in VOID or tag in ("html", "head"):
            return
        told = dict(attrs)
        skips = self.open[-1].skips or self.skips(tag, told)
        if tag in BLOCKS or skips:
            article = not skips and (tag == "article" or told.get("role") == "article" or told.get("itemprop") == "articleBody")
            self.open.append(_Node(tag, self.open[-1], skips, article))
            self.nodes.append(self.open[-1])

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in BLOCKS:  # as browsers do: a block stays open
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.in_link = 0
        if tag in BLOCKS:
            self.end_line()
        self.leave({tag}, frozenset() if tag in BLOCKS else BLOCKS)

    def handle_data(self, data: str) -> None:
        if not self.open[-1].skips:
            self.text.append(data)
            self.links += self.in_link * len(data)


def content_lines(chars: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Which lines are content: smoothed text-to-tag ratios above the threshold between two clusters.

    The threshold starts at the mean and moves half way between the means of both sides until it stays.
    """
    if len(chars) == 0:
        return np.zeros(0, bool)
    ratio = chars / np.maximum(tags, 1)
    reach = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    smooth = np.convolve(ratio, kernel / kernel.sum(), mode="full")[REACH : REACH + len(ratio)]
    threshold = smooth.mean()
    for _ in range(len(smooth)):  # each step moves a line to the other side, or the threshold stays
        above = smooth > threshold
        if not above.any() or above.all():
            break
        moved = (smooth[above].mean() + smooth[~above].mean()) / 2
        if moved == threshold:
            break
        threshold = moved
    return (smooth >= threshold) & (chars > 0)


def _region(nodes: list[_Node]) -> _Node:
    """The element whose lines are the article; ``nodes`` know what they hold."""
    articles = [n for n in nodes if n.article and n.chars]
    if articles:
        return max(articles, key=lambda n: (n.mass, n.chars))
    inner: dict[_Node, _Node] = {}  # of each node the one that holds most
    for n in nodes:
        if n.tag in CONTAINERS and not n.skips:
            holder = _container(n.parent)
            if holder not in inner or (n.mass, n.chars) > (inner[holder].mass, inner[holder].chars):
                inner[holder] = n
    region = nodes[0]
    while region in inner and not region.direct and inner[region].chars and inner[region].tag in WRAPPERS and inner[region].mass >= NEARLY_ALL * region.mass:
        region = inner[region]
    return region


def _container(node: _Node) -> _Node:
    while node.parent is not None and node.tag not in CONTAINERS:
        node = node.parent
    return node


def main_text(html: str) -> str:
    """The article of a page: its blocks in page order, joined by an empty line."""
    page = _Lines()
    page.feed(html)
    if _CUT.match(page.rawdata):  # the page ends inside a tag or a comment
        page.rawdata = ""
    page.close()
    page.end_line()
    content = content_lines(np.array([len(line[0]) for line in page.lines]), np.array([line[2] for line in page.lines]))
    for (text, linked, _, node), is_content in zip(page.lines, content, strict=True):
        node.chars += len(text)
        node.mass += len(text) * bool(is_content)
        node.links += linked
        if text:
            holder = _container(node)
            holder.direct |= node is holder or node.tag == "p" or node.tag in HEADINGS
    for node in reversed(page.nodes[1:]):
        node.parent.chars += node.chars
        node.parent.mass += node.mass
        node.parent.links += node.links
    region = _region(page.nodes)
    for node in page.nodes:
        node.kept = node is region or (node.parent is not None and node.parent.kept)
        if node is region:
            continue
        if node.tag == "header" or (node.parent is not None and node.parent.tag == "header"):
            node.kept &= node.tag in HEADINGS or node.tag == "header"
        if not region.inside and node.tag in CONTAINERS and 2 * node.links > node.chars:
            node.kept = False  # a list of links on a page that marks no article
    return "\n\n".join(text for text, _, _, node in page.lines if text and node.kept and (node.tag != "header"))


def extract_main_text(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows (id, url, text, n_chars), one for each row of ``pages``.

    ``text`` is the article's blocks (headings, paragraphs, list items, cells), references
    decoded, white space inside a block as one space, joined by an empty line; ``n_chars``
    counts code points.  A null or empty page and one without an article's text give an
    empty text.  Pages may be cut off, long, or have elements that nothing closes.  Null ids
    and urls and repeated rows are passed through; further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, ends = text_buffer(batch.column(2))
            for first, last in blocks(ends):
                part = batch.slice(first, last - first)
                texts = [main_text(page.as_py() or "") for page in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id).alias("id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(released(run), f"id {kind}, url string, text string, n_chars long")
    return found.select(F.col("id").alias(id), F.col("url").alias(url), "text", "n_chars")
