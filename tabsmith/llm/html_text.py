"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into blocks of text at its block-level tags. Each block is
described by its word count and link density, those of the blocks before and
after it, and where it stands: inside an element that by its tag or its class
and id words is a page's frame, and inside the article where the page has one.
A decision tree, grown on the small table ``LABELLED``, keeps or drops it.

A name made of frame words only ("ad-box", "cookie-notice") marks a frame. Any
other name with such a word ("content-sidebar-wrap") may be that of a wrapper,
and so may a form: these are frames only for what stands in no article of their
own, and not if they hold half of the page's running text. Names that tell of a
state ("has-sidebar", "no-header") mark nothing. Articles that are frames
(comments) or hold little beside the running text outside (teaser cards) do not
make a page one with an article.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import arrow_table, map_batches, slices

# Tags of HTML by what they do to a block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre search section select summary "
    "svg table tbody td template tfoot th thead tr ul video".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea xmp iframe noembed noframes".split())
FRAME_TAGS = frozenset("nav aside footer header form menu dialog noscript button select option svg template head search".split())
FRAME_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar rail nav navbar navigation "
    "menu breadcrumb breadcrumbs masthead header footer copyright cookie cookies consent gdpr notice notices notification popup modal overlay "
    "newsletter subscribe subscription signup login signin search form share sharing social related recommended recommendations trending "
    "comment comments commentlist respond reply replies responses reviews discussion disqus pagination pager widget toolbar skip alert".split()
)
# of these, the ones that also mark a few words within a line
INLINE_WORDS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion popup".split())
# parts of a name that leave it a frame's, and words that are often a wrapper's
BOX_WORDS = frozenset(
    "article articles area bar block box bottom button buttons container entry global group inner item items left link links list main outer page "
    "panel post posts primary reader readers right secondary section site slot top unit user users wrap wrapper".split()
)
# parts of a name that may be that of an element around the whole page
WIDE_WORDS = frozenset("body container content global main outer page site wrap wrapper".split())
WRAPPER_WORDS = frozenset("form widget".split())
STATE_WORDS = frozenset("has have hide no non not show with without".split())
PROSE = 10  # words of a block that count as running text, if few of them are links
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"(?<![\w-])(class|id|role|style|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW_TAGS}


@dataclass
class Block:
    text: str
    words: int
    linked: int
    frame: bool
    article: bool
    heading: bool = False
    unsure: int = -1  # the innermost element around it that is a frame or a wrapper
    outer: int = 0  # the outermost article around it, 0 inside <main>

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


@dataclass(frozen=True)
class _Place:
    """What the open elements make of a block, carried along with each of them."""

    frame: bool = False
    unsure: int = -1
    outer: int = 0
    main: bool = False


@dataclass
class _Page:
    open: list[tuple[str, _Place]] = field(default_factory=list)
    counts: Counter = field(default_factory=Counter)  # of the open elements, by tag
    elements: int = 0
    around: list[int] = field(default_factory=list)  # of every perhaps-frame, the one around it
    parts: list[tuple[str, bool]] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    link: int = 0
    heading: bool = False
    mute: tuple[str, int, int] | None = None  # an unwanted inline element: tag, how often open, blocks around it

    def text(self, value: str) -> None:
        if value and self.mute is None:
            self.parts.append((html.unescape(value) if "&" in value else value, self.link > 0))

    def cut(self) -> None:
        words = "".join([p for p, _ in self.parts]).split()
        if words:
            linked = sum(len(p.split()) for p, link in self.parts if link)
            at = self.place()
            self.blocks.append(Block(" ".join(words), len(words), min(linked, len(words)), at.frame, at.outer > 0, self.heading, at.unsure, 0 if at.main else at.outer))
        self.parts = []
        self.heading = False

    def place(self) -> _Place:
        return self.open[-1][1] if self.open else _Place()

    def push(self, tag: str, sure: int, article: int) -> None:
        """``sure``: 2 for a frame, 1 for perhaps one. ``article``: 1, or 2 for <main>."""
        self.elements += 1
        at = self.place()
        frame, unsure, outer, main = at.frame, at.unsure, at.outer, at.main
        if article:
            unsure, outer = -1, outer or self.elements
            if article == 2:
                frame, main = False, True
        if sure == 2:
            frame = True
        elif sure:
            self.around.append(unsure)
            unsure = len(self.around) - 1
        self.open.append((tag, _Place(frame, unsure, outer, main)))
        self.counts[tag] += 1

    def pop(self) -> str:
        tag, _ = self.open.pop()
        self.counts[tag] -= 1
        if self.mute and len(self.open) < self.mute[2]:
            self.mute = None
        return tag

    def inline(self, tag: str, attrs: str) -> None:
        """Advertisements and hidden words within a line are not text."""
        if self.mute:
            if tag == self.mute[0]:
                self.mute = (tag, self.mute[1] + 1, self.mute[2])
        elif attrs and tag not in VOID_TAGS and tag not in RAW_TAGS:
            for name, *values in _ATTR.findall(attrs):
                value, kind = "".join(values), name.lower()
                named = kind in ("class", "id") and any(_named(t, False) == 2 and not INLINE_WORDS.isdisjoint(_words(t)) for t in value.split())
                if named or kind == "hidden" or (kind == "style" and _UNSEEN.search(value)):
                    self.mute = (tag, 1, len(self.open))

    def begin(self, tag: str, attrs: str) -> None:
        if tag == "a":
            self.link = 1  # a link in a link closes the first
        if tag not in BLOCK_TAGS:
            if tag == "br":
                self.text(" ")
            self.inline(tag, attrs)
            return
        self.cut()
        self.link = 0
        self.close_implied(tag)
        if tag in VOID_TAGS:
            return
        self.heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        article = {"article": 1, "main": 2}.get(tag, 0)
        inside = self.place().outer > 0
        sure = 2 if self.mute else 0
        if tag in FRAME_TAGS and not (tag == "header" and inside):
            sure = 1 if tag in WRAPPER_WORDS else 2
        if tag not in ("html", "body", "main"):
            for name, *values in _ATTR.findall(attrs):
                value, kind = "".join(values), name.lower()
                if kind == "role":
                    words = set(_words(value))
                    article = max(article, 2 * ("main" in words), int("article" in words))
                    if words & {"banner", "navigation", "complementary", "contentinfo", "search", "dialog", "alert"}:
                        sure = 2
                    sure = max(sure, int("form" in words))
                elif kind == "hidden":
                    sure = 2
                elif kind == "style":
                    sure = 2 if _UNSEEN.search(value) else sure
                else:
                    sure = max([sure, *(_named(token, inside) for token in value.split())])
        if article and sure == 1:
            sure = 0
        self.push(tag, sure, article)

    def close_implied(self, tag: str) -> None:
        """A paragraph ends where another block begins, an item where its next one does."""
        if self.open and self.open[-1][0] == "p":
            self.pop()
        group = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
        while self.open and self.open[-1][0] in group.get(tag, ()):
            self.pop()

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link = 0
        if tag not in BLOCK_TAGS:
            if self.mute and tag == self.mute[0]:
                self.mute = (tag, self.mute[1] - 1, self.mute[2]) if self.mute[1] > 1 else None
            return
        self.cut()
        if self.counts[tag]:  # else a stray end, which closes nothing
            while self.pop() != tag:
                pass


def _words(name: str) -> list[str]:
    """The words of a name: at hyphens, underscores and capitals."""
    return [w.lower() for w in _WORDS.findall(name)]


def _named(name: str, inside: bool) -> int:
    """2 if a class or id is a frame's name, 1 if it may be, else 0."""
    words = _words(name)
    frames = FRAME_WORDS - {"header"} if inside else FRAME_WORDS
    if frames.isdisjoint(words) or words[0] in STATE_WORDS:
        return 0
    return 2 if (frames - WRAPPER_WORDS).union(BOX_WORDS - WIDE_WORDS).issuperset(words) else 1


def _settle(found: list[Block], around: list[int]) -> None:
    """Decide which elements are frames or wrappers, and whether the articles
    of the page are its main text. ``around``: of every element that may be
    either, the next one around it."""

    def prose(some: Iterable[Block]) -> int:
        return sum(b.words - b.linked for b in some if b.words >= PROSE and b.density < 0.5)

    open_text = [b for b in found if not b.frame]
    least = PROSE if prose(open_text) else 1  # a page of short blocks is judged by these
    within = [0] * len(around)
    all_words = 0
    for b in open_text:
        if b.words >= least and b.density < 0.5:
            all_words += b.words - b.linked
            if b.unsure >= 0:
                within[b.unsure] += b.words - b.linked
    for k in range(len(around) - 1, -1, -1):  # inner ones come after outer ones
        if around[k] >= 0:
            within[around[k]] += within[k]
    clear: list[bool] = []
    for k, outer in enumerate(around):
        clear.append(0 < all_words <= 2 * within[k] and (outer < 0 or clear[outer]))
    for b in open_text:
        b.frame = b.unsure >= 0 and not clear[b.unsure]
    articles = Counter()
    for b in found:
        if b.article and not b.frame:
            articles[b.outer] += b.words - b.linked
    if articles and 0 not in articles and 2 * max(articles.values()) < prose(b for b in found if not (b.article or b.frame)):
        for b in found:
            b.frame |= b.article


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order. Character references are decoded and
    white space within a block is one space; markup that is cut off at the end
    of the page is not text."""
    out = _Page()
    at = 0
    while m := _TOKEN.search(page, at):
        out.text(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            out.end(tag)
        else:
            out.begin(tag, m["attrs"] or m["attrs2"] or "")
            if tag in RAW_TAGS:
                stop = _RAW_END[tag].search(page, at)
                at = stop.start() if stop else len(page)
    out.text(page[at:])
    out.cut()
    _settle(out.blocks, out.around)
    return out.blocks


FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "frame", "place", "heading")


def describe(found: list[Block]) -> np.ndarray:
    """One row of ``FEATURES`` per block. place: 1 inside the article, -1 outside
    it on a page that has one, 0 on a page without."""
    has_article = any(b.article and not b.frame for b in found)
    words = np.array([0, *(b.words for b in found), 0], dtype=float)
    density = np.array([0, *(b.density for b in found), 0], dtype=float)
    own = np.array([(b.frame, 1 if b.article else -1 if has_article else 0, b.heading) for b in found], dtype=float).reshape(-1, 3)
    return np.column_stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], own])


#: Labelled blocks: the columns of FEATURES, then 1 for main text.
LABELLED = np.array(
    [
        # in the article: long and short, with and without links, headings, last and first
        (80, 0.0, 8, 0.0, 60, 0.0, 0, 1, 0, 1), (3, 0.0, 90, 0.0, 70, 0.0, 0, 1, 0, 1), (1, 0.0, 40, 0.0, 0, 0.0, 0, 1, 0, 1), (9, 0.0, 6, 1.0, 80, 0.0, 0, 1, 1, 1),
        (2, 0.0, 3, 1.0, 5, 0.0, 0, 1, 0, 1), (25, 0.2, 1, 0.0, 2, 0.0, 0, 1, 0, 1), (12, 0.5, 30, 0.0, 8, 0.0, 0, 1, 0, 1), (4, 0.0, 10, 0.0, 12, 0.0, 0, 1, 0, 1),
        (150, 0.05, 1, 1.0, 1, 1.0, 0, 1, 0, 1), (6, 1.0, 50, 0.0, 50, 0.0, 0, 1, 0, 1), (7, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (300, 0.0, 9, 0.0, 9, 0.0, 0, 1, 0, 1),
        (1, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1), (1, 0.0, 0, 0.0, 1, 0.0, 0, 1, 0, 1), (1, 0.0, 1, 0.0, 0, 0.0, 0, 1, 0, 1), (2, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 1),
        (2, 0.0, 0, 0.0, 2, 0.0, 0, 1, 0, 1), (4, 0.0, 2, 0.0, 0, 0.0, 0, 1, 0, 1),
        (20, 0.0, 2, 1.0, 0, 0.0, 0, 1, 0, 1), (5, 0.0, 3, 1.0, 0, 0.0, 0, 1, 0, 1), (3, 0.0, 6, 1.0, 4, 1.0, 0, 1, 0, 1),
        # in a frame, within the article or not
        (30, 0.0, 60, 0.0, 60, 0.0, 1, 1, 0, 0), (4, 0.0, 60, 0.0, 60, 0.0, 1, 1, 0, 0), (90, 0.0, 20, 0.0, 0, 0.0, 1, 1, 0, 0), (8, 1.0, 60, 0.0, 8, 1.0, 1, 1, 0, 0),
        (1, 1.0, 1, 1.0, 1, 1.0, 1, -1, 0, 0), (12, 0.0, 1, 1.0, 9, 0.0, 1, -1, 0, 0), (45, 0.0, 80, 0.0, 0, 0.0, 1, -1, 0, 0), (5, 0.0, 60, 0.0, 0, 0.0, 1, -1, 1, 0),
        (2, 1.0, 0, 0.0, 2, 1.0, 1, 0, 0, 0), (60, 0.0, 2, 1.0, 70, 0.0, 1, 0, 0, 0), (7, 0.3, 70, 0.0, 0, 0.0, 1, 0, 0, 0), (20, 0.1, 15, 0.0, 25, 0.0, 1, 0, 1, 0),
        # outside the article of a page that has one
        (30, 0.0, 1, 1.0, 9, 0.0, 0, -1, 0, 0), (5, 0.0, 60, 0.0, 0, 0.0, 0, -1, 0, 0), (70, 0.0, 80, 0.0, 40, 0.0, 0, -1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, -1, 0, 0),
        (6, 0.0, 2, 1.0, 50, 0.0, 0, -1, 1, 0), (15, 0.6, 10, 0.0, 10, 0.0, 0, -1, 0, 0),
        # no article on the page: long runs of text, headings before them, short lines between them
        (60, 0.0, 50, 0.0, 70, 0.0, 0, 0, 0, 1), (25, 0.1, 4, 0.0, 40, 0.0, 0, 0, 0, 1), (18, 0.0, 30, 0.0, 0, 0.0, 0, 0, 0, 1), (120, 0.2, 2, 1.0, 1, 1.0, 0, 0, 0, 1),
        (16, 0.0, 2, 1.0, 20, 0.0, 0, 0, 0, 1), (6, 0.0, 2, 1.0, 60, 0.0, 0, 0, 1, 1), (4, 0.0, 50, 0.0, 45, 0.0, 0, 0, 0, 1), (3, 0.0, 40, 0.0, 30, 0.1, 0, 0, 1, 1),
        (8, 0.0, 35, 0.0, 22, 0.0, 0, 0, 0, 1), (5, 0.0, 25, 0.0, 5, 0.0, 0, 0, 0, 1), (5, 0.0, 5, 0.0, 25, 0.0, 0, 0, 0, 1),
        # ... short pages and lists: lines beside lines without links, the first and the last, a page of one block
        (5, 0.0, 6, 0.0, 5, 0.0, 0, 0, 0, 1), (7, 0.0, 7, 0.0, 0, 0.0, 0, 0, 0, 1), (11, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 1), (6, 0.0, 0, 0.0, 7, 0.0, 0, 0, 0, 1),
        (3, 0.0, 0, 0.0, 6, 0.0, 0, 0, 1, 1), (8, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (2, 0.0, 2, 0.0, 2, 0.0, 0, 0, 0, 1), (1, 0.0, 1, 0.0, 0, 0.0, 0, 0, 0, 1),
        (2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 1, 1), (6, 0.0, 3, 0.0, 0, 0.0, 0, 0, 0, 1), (5, 0.0, 2, 1.0, 6, 0.0, 0, 0, 1, 1), (6, 0.0, 5, 0.0, 2, 1.0, 0, 0, 0, 1),
        (4, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (3, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (2, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0), (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 0),
        (5, 0.0, 1, 0.0, 0, 0.0, 0, 0, 0, 1), (2, 0.0, 2, 0.0, 0, 0.0, 0, 0, 0, 1), (40, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 1), (1, 0.0, 0, 0.0, 5, 0.0, 0, 0, 0, 1), (1, 0.0, 0, 0.0, 3, 0.0, 0, 0, 1, 1),
        (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (6, 1.0, 40, 0.0, 6, 1.0, 0, 0, 0, 0), (14, 0.9, 10, 1.0, 12, 0.8, 0, 0, 0, 0),
        (3, 0.0, 2, 0.0, 2, 1.0, 0, 0, 0, 0), (2, 0.5, 1, 1.0, 0, 0.0, 0, 0, 0, 0), (5, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 0), (30, 0.8, 40, 0.0, 3, 1.0, 0, 0, 0, 0), (20, 0.7, 2, 1.0, 50, 0.0, 0, 0, 0, 0),
    ]
)


@dataclass
class Tree:
    feature: int = -1  # a leaf
    limit: float = 0.0
    keep: bool = False
    low: Tree | None = None
    high: Tree | None = None

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.keep)
        below = rows[:, self.feature] <= self.limit
        out = np.empty(len(rows), dtype=bool)
        out[below], out[~below] = self.low.predict(rows[below]), self.high.predict(rows[~below])
        return out


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 16) -> Tree:
    """A binary tree of the splits that lower Gini impurity most; of equal
    splits the first feature's, at the middle between two values."""

    def impurity(n: np.ndarray, ones: np.ndarray) -> np.ndarray:
        return 2 * ones * (n - ones) / np.maximum(n, 1)

    best, found = impurity(np.array(len(labels)), np.array(labels.sum())) - 1e-9, None
    if depth and 0 < labels.sum() < len(labels):
        for feature in range(rows.shape[1]):
            order = np.argsort(rows[:, feature], kind="stable")
            values, ones = rows[order, feature], np.cumsum(labels[order])
            n = np.arange(1, len(labels))
            cost = impurity(n, ones[:-1]) + impurity(len(labels) - n, ones[-1] - ones[:-1])
            cost[values[1:] == values[:-1]] = np.inf
            if cost.min() < best:
                best, at = cost.min(), int(cost.argmin())
                found = feature, (values[at] + values[at + 1]) / 2
    if found is None:
        return Tree(keep=bool(labels.mean() >= 0.5))
    below = rows[:, found[0]] <= found[1]
    return Tree(found[0], found[1], False, grow(rows[below], labels[below], depth - 1), grow(rows[~below], labels[~below], depth - 1))


def default_tree() -> Tree:
    return grow(LABELLED[:, :-1], LABELLED[:, -1])


def main_text(page: str, tree: Tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    return "\n".join([b.text for b, keep in zip(found, tree.predict(describe(found)), strict=True) if keep])


def extract(pages: DataFrame, tree: Tree | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row: the kept blocks in page
    order, joined by line breaks; n_chars counts code points.

    A null or empty page, or one without main text, has the text ``""``.
    Repeated rows each give their row; an empty table gives none; other columns
    are ignored.
    """
    grown = tree or default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, found in slices(batch, "html"):
                texts = [main_text(p, grown) for p in found]
                columns = {"page_id": part.column("page_id"), "url": part.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}
                yield arrow_table(columns, {"text": pa.string(), "n_chars": pa.int64()})

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return map_batches(rows, run, "page_id long, url string, text string, n_chars long")
