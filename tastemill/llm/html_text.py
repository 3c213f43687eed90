"""Main text of HTML pages: flat text blocks, judged by a small decision tree.

A page becomes a list of text blocks in page order. Each is described by its words, its share of linked words, the
same of its neighbours, and what the elements around it say. The tree is trained on a small labelled table (below) of
blocks of example pages; the blocks it accepts, joined by line breaks, are the page's text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z) | <!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z) | <[!?][^>]*(?:>|\Z)
      | <(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*"|'[^']*')*+)>
      | </?[A-Za-z][^>]*(?:>|\Z)""",
    re.S | re.X,
)
_TAG_BROKEN = re.compile(
    r"""<!--.*?(?:-->|\Z) | <!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z) | <[!?][^>]*(?:>|\Z)
      | <(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>[^>]*)>
      | </?[A-Za-z][^>]*\Z""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_PART = re.compile(r"[a-z]+")

#: Elements whose text is not markup.
RAW = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in ("script", "style", "noscript", "textarea", "iframe", "xmp", "title")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stay inside the block around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rp rt s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Opening one of these ends an open element of the same kind.
SELF_ENDING = frozenset("p li dt dd tr td th option thead tbody tfoot".split())
#: Elements and roles of what is not the article; they count for everything inside them.
OUTSIDE = frozenset(
    "nav footer aside head title select button template svg math canvas object audio video dialog menu fieldset label "
    "option datalist legend".split()
)
#: Those that stay inside the block where they stand in the middle of a paragraph.
FLOWING = frozenset(("label", "button", "option"))
PARAGRAPHS = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6"))
LISTS = frozenset(("ul", "ol", "dl"))
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
#: Name parts that hint at it: an article or main inside wins its place back, and nearly all of a page is not outside.
OUTSIDE_NAMES = frozenset(
    "header ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside rail widget footer foot masthead topbar toolbar cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus "
    "replies reply respond discussion share sharing social related recommended recommendations teaser teasers pager "
    "pagination skip copyright legal tagcloud hidden search form".split()
)
#: Those whose own parts may be articles.
OF_ARTICLES = frozenset("comment comments commentlist disqus replies reply respond teaser teasers related ad sponsored promo".split())
#: A name with one of these tells of something elsewhere, or not there; with one of the others and a part of INSIDE_NAMES it holds both.
ELSEWHERE = frozenset("has no not without with hide".split())
WRAPPERS = frozenset("wrap wrapper layout container grid".split())
#: Share and number of the page's plain words from which an element with a hint is a wrapper of the page.
WRAPPER_SHARE, WRAPPER_WORDS = 0.9, 40
INSIDE = frozenset(("article", "main"))
INSIDE_ROLES = frozenset(("main", "article"))
INSIDE_NAMES = frozenset("article articlebody content main post entry story body text".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


class Hinted:
    """An element with a hint at something else, the next such element around it, and the plain words it holds."""

    __slots__ = ("around", "number", "words")

    def __init__(self, number: int, around: Hinted | None):
        self.number, self.around, self.words = number, around, 0.0


@dataclass
class Block:
    text: str
    words: int
    linked: int
    #: -1 in something that is not the article, 1 in the article, 0 unknown
    place: int
    heading: bool
    #: nearest element around with a hint at something else, and whether one hints at the article
    hint: Hinted | None = None
    named: bool = False
    #: number of the outermost list around, 0 for none
    list_: int = 0


@dataclass(frozen=True)
class _Around:
    place: int = 0
    hint: Hinted | None = None
    of_articles: bool = False
    named: bool = False
    list_: int = 0


@dataclass(frozen=True)
class _Open:
    """An open element: what it says of its text, links and headings open with it, whether it stays in its block."""

    name: str
    around: _Around
    links: int
    headings: int
    inline: bool


def _hints(value: str) -> set[str]:
    """Parts of class names or an id that hint at something that is not the article."""
    found: set[str] = set()
    for name in value.split():
        parts = set(_NAME_PART.findall(name))
        if name != "hidden":  # a name of its own; "hidden-gems" are not hidden
            parts.discard("hidden")
        if not (parts & ELSEWHERE or parts & WRAPPERS and parts & INSIDE_NAMES):
            found |= parts & OUTSIDE_NAMES
    return found


def _place(name: str, rest: str, around: _Around, number: int) -> _Around:
    """What an element inside another says of its text."""
    if around.place < 0 or name in OUTSIDE:
        return _Around(-1)
    inside, names, hints = name in INSIDE, set(), set()
    if rest.strip():
        for m in _ATTRIBUTE.finditer(rest):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key in ("class", "id"):
                names.update(_NAME_PART.findall(value))
                hints |= _hints(value)
            elif key == "role":
                if value in OUTSIDE_ROLES:
                    return _Around(-1)
                inside |= value in INSIDE_ROLES
                hints |= {value} & {"form"}
            elif key == "itemprop":
                inside |= value == "articlebody"
            elif key == "hidden" or (key == "aria-hidden" and value == "true"):
                return _Around(-1)
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return _Around(-1)
    own = names & {"article", "post", "entry", "story"}
    if name == "header" and around.place == 0 and not around.named and not own:
        return _Around(-1)
    if "header" in hints and (own or around.place == 1 or around.named):
        hints.discard("header")  # an article's own header belongs to it
    if name == "form":
        hints.add("form")
    if name in ("html", "body", "main") or name == "article" and not hints & OF_ARTICLES:
        hints.clear()
    of_articles = around.of_articles or bool(hints & OF_ARTICLES)
    named = around.named or bool(names & INSIDE_NAMES) and name not in ("html", "body")
    list_ = around.list_ or (number if name in LISTS else 0)
    if inside and not of_articles:
        return _Around(1, Hinted(number, None) if hints else None, False, named, list_)
    return _Around(around.place, Hinted(number, around.hint) if hints else around.hint, of_articles, named, list_)


class _Elements:
    """Open elements of a page. Every step takes the same time however deep they are nested."""

    def __init__(self) -> None:
        self.stack: list[_Open] = []
        self.at: dict[str, list[int]] = {}  # places of each name, and of what isn't inline
        self.outer: list[int] = []

    @property
    def around(self) -> _Around:
        return self.stack[-1].around if self.stack else _Around()

    @property
    def links(self) -> int:
        return self.stack[-1].links if self.stack else 0

    @property
    def headings(self) -> int:
        return self.stack[-1].headings if self.stack else 0

    def block_name(self) -> str:
        """Name of the nearest element that isn't inline."""
        return self.stack[self.outer[-1]].name if self.outer else ""

    def open(self, name: str, around: _Around, inline: bool) -> None:
        self.at.setdefault(name, []).append(len(self.stack))
        if not inline:
            self.outer.append(len(self.stack))
        self.stack.append(_Open(name, around, self.links + (name == "a"), self.headings + (name in HEADINGS), inline))

    def cut(self, depth: int) -> None:
        """Close all elements from a depth on."""
        while len(self.stack) > depth:
            last = self.stack.pop()
            self.at[last.name].pop()
            if not last.inline:
                self.outer.pop()

    def close(self, name: str) -> None:
        """Close the last element of a name, inline names only within their block."""
        places = self.at.get(name)
        if places and not (name in INLINE and self.outer and self.outer[-1] > places[-1]):
            self.cut(places[-1])

    def end_same(self, name: str) -> None:
        """Close an element of the same kind that the new one ends."""
        for k in range(len(self.stack) - 1, max(-1, len(self.stack) - 5), -1):
            now = self.stack[k].name
            if now == name:
                self.cut(k)
                return
            if now not in INLINE and name == "p" or now in LISTS or now == "table":
                return


def blocks(page: str) -> list[Block]:
    """Text blocks in page order. Never fails: what is not markup is text, what stays open ends with the page."""
    out: list[Block] = []
    elements = _Elements()
    pieces: list[tuple[str, bool]] = []
    number = 0
    around, headings = _Around(), 0
    tag = _TAG

    def close_block() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
            if text:
                linked = sum(len(html.unescape(p).split()) for p, is_link in pieces if is_link)
                out.append(
                    Block(text, len(text.split()), linked, around.place, headings > 0, around.hint, around.named, around.list_)
                )
            pieces.clear()

    at = 0
    end_of_page = len(page)
    while at < end_of_page:
        m = tag.search(page, at)
        if m is None:
            pieces.append((page[at:], elements.links > 0))
            break
        if m.start() > at:
            pieces.append((page[at : m.start()], elements.links > 0))
        at = m.end()
        if m["data"] is not None:
            pieces.append((html.escape(m["data"], quote=False), elements.links > 0))
        if m["name"] is None:
            if page[m.start() + 1 : m.start() + 2] not in ("!", "?"):
                tag = _TAG_BROKEN  # a quote that never ends: looking for its end once is enough
            continue
        name = m["name"].lower()
        if not m["end"]:
            if name in RAW:
                if name not in ("title", "noscript"):
                    pieces.append((" ", elements.links > 0))
                found = RAW[name].search(page, at)
                at = found.end() if found else end_of_page
                continue
            inline = name in INLINE or name in FLOWING and elements.block_name() in PARAGRAPHS
            if not inline:
                close_block()
                if name in SELF_ENDING:
                    elements.end_same(name)
            elif name in ("br", "img", "wbr"):
                if name != "wbr":
                    pieces.append((" ", elements.links > 0))
                continue
            if name in VOID or m["rest"].rstrip().endswith("/") and name not in INLINE | INSIDE and name != "div":
                continue
            inner = elements.around
            if not inline:
                number += 1
                inner = _place(name, m["rest"], inner, number)
            elements.open(name, inner, inline)
        elif name in INLINE:
            elements.close(name)
        else:
            places = elements.at.get(name)
            if not (places and elements.stack[places[-1]].inline):
                close_block()
            elements.close(name)
        around, headings = elements.around, elements.headings
    close_block()
    return out


#: What the tree sees of a block.
FEATURES = (
    "words", "link_density", "place", "name", "heading", "words_before", "link_density_before", "words_after",
    "link_density_after", "sentence_end", "words_of_longest_near",
)


def _places(found: list[Block], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place (-1 outside, 0 beside a marked article, 0.5 on a page that marks none, 1 in it) and name (-1, 0, 1) of blocks.

    Plain words decide what names are worth: an element that holds nearly all of them is a wrapper whatever it is
    called, and names mark an article only where more than half of them stand.
    """
    place = np.array([b.place for b in found], float)
    plain = plain * (place >= 0)
    held: dict[int, Hinted] = {}
    for b, w in zip(found, plain.tolist(), strict=True):
        h = b.hint
        while h is not None and h.number not in held:
            h.words, held[h.number] = 0.0, h
            h = h.around
        if b.hint is not None:
            b.hint.words += w
    for number in sorted(held, reverse=True):  # inner elements have the greater numbers
        h = held[number]
        if h.around is not None:
            h.around.words += h.words
    bound = max(WRAPPER_WORDS, WRAPPER_SHARE * plain.sum())
    # the innermost holds the least of those around a block
    other = np.array([b.hint is not None and b.hint.words < bound for b in found], bool)
    named = np.array([b.named for b in found], bool) & ~other & (place >= 0)
    name = np.where(other, -1.0, named)
    if 2 * (plain * named).sum() > (plain * ~other).sum():
        place[named] = 1
    if not ((place == 1) & ~other).any():
        place[place == 0] = 0.5
    return place, name


def features(found: list[Block]) -> np.ndarray:
    n = len(found)
    words = np.array([b.words for b in found], float)
    density = np.array([min(1.0, b.linked / b.words) for b in found])
    place, name = _places(found, words * (density < 0.5))
    plain = np.pad(words * (density < 0.5) * (place >= 0) * (name >= 0), 3)
    near = np.max([plain[k : k + n] for k in range(7)], axis=0) if n else words
    return np.column_stack(
        [
            words, density, place, name, [b.heading for b in found],
            np.append(0.0, words[:-1]), np.append(0.0, density[:-1]), np.append(words[1:], 0.0), np.append(density[1:], 0.0),
            [b.text[-1] in ".!?:;\"'”»…)" for b in found], near,
        ]
    ) if n else np.zeros((0, len(FEATURES)))


class Tree:
    """Binary decision tree by Gini impurity; leaves answer with the majority of their rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2):
        self.nodes: list[tuple[int, float, int, int, bool]] = []  # feature (-1: leaf), bound, left, right, answer
        self._grow(x, y, depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int) -> int:
        me = len(self.nodes)
        self.nodes.append((-1, 0.0, 0, 0, bool(2 * y.sum() >= len(y))))
        best = (2 * y.mean() * (1 - y.mean()) - 1e-9, -1, 0.0) if len(y) else (0.0, -1, 0.0)
        if depth and 0 < y.sum() < len(y):
            for f in range(x.shape[1]):
                order = np.argsort(x[:, f], kind="stable")
                v, t = x[order, f], y[order]
                k = np.nonzero(v[1:] > v[:-1])[0] + 1
                k = k[(k >= least) & (len(y) - k >= least)]
                if not len(k):
                    continue
                left = np.cumsum(t)[k - 1]
                right = t.sum() - left
                a, b = left / k, right / (len(y) - k)
                impurity = (2 * a * (1 - a) * k + 2 * b * (1 - b) * (len(y) - k)) / len(y)
                j = int(np.argmin(impurity))
                if impurity[j] < best[0]:
                    best = (impurity[j], f, (v[k[j] - 1] + v[k[j]]) / 2)
        if best[1] >= 0:
            low = x[:, best[1]] <= best[2]
            left = self._grow(x[low], y[low], depth - 1, least)
            right = self._grow(x[~low], y[~low], depth - 1, least)
            self.nodes[me] = (best[1], best[2], left, right, self.nodes[me][4])
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        feature, bound, left, right, answer = (np.array(c) for c in zip(*self.nodes, strict=True))
        while (inner := feature[at] >= 0).any():
            rows = np.nonzero(inner)[0]
            low = x[rows, feature[at[rows]]] <= bound[at[rows]]
            at[rows] = np.where(low, left[at[rows]], right[at[rows]])
        return answer[at]


@lru_cache(maxsize=1)
def trained() -> Tree:
    """The tree for the labelled table; the same on every worker."""
    from .html_examples import labelled_blocks

    x, y = [], []
    for page, labels in labelled_blocks():
        found = blocks(page)
        if len(found) != len(labels):
            raise ValueError(f"{len(found)} blocks, {len(labels)} labels: {[b.text[:20] for b in found]}")
        x.append(features(found))
        y.append(np.array(labels, float))
    return Tree(np.concatenate(x), np.concatenate(y))


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    x = features(found)
    keep = tree.predict(x).astype(bool)
    # a list in a marked article stays or goes as a whole, as most of its words do
    items = (x[:, FEATURES.index("place")] == 1) & (x[:, FEATURES.index("name")] >= 0)
    lists = np.array([b.list_ for b in found]) * items
    if lists.any():
        number, where = np.unique(lists, return_inverse=True)
        words = x[:, FEATURES.index("words")]
        kept = np.bincount(where, weights=words * keep)
        keep = np.where(lists > 0, (2 * kept >= np.bincount(where, weights=words))[where], keep)
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: the main text of every page, a row per row.

    Null and empty pages have empty texts, broken markup is read as far as it goes, a page of any length is read
    whole, ties and repeated pages give equal rows. Blocks are trimmed, white space in them is one space.
    """
    kinds = ", ".join(f"{n} {pages.schema[c].dataType.simpleString()}" for n, c in (("page_id", page_id), ("url", url)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained()
        for batch in batches:
            texts = [main_text(p.as_py(), tree) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(page_id), F.col(url), F.col(page))
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars long")


def query(spark, sf_dir):
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
