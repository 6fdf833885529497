"""Main text of web pages from flat text blocks and a decision tree.

A page is read once into flat blocks: text between block-level tags, with
character references decoded and white space collapsed.  A block's features
are its word count and link density, those of the blocks before and after it,
and where it stands (the kind of the landmark element around it).  A decision
tree, grown at first use from the small labelled table below, keeps or drops
each block; kept blocks are joined by one space.
"""

from __future__ import annotations

import functools
import html
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# HTML element names and the usual words of class, id and role attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object canvas select head".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
CONTENT = frozenset("article main".split())
ASIDE = frozenset("nav footer aside form menu dialog button fieldset".split())
HINTS = re.compile(r"(?<![a-z])(ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
                   r"nav\w*|menu|breadcrumbs?|pagination|pager|sidebar|side|widget|footer|masthead|header|topbar|toolbar|comments?|"
                   r"disqus|respond|replies|share|sharing|social|related|recommend\w*|newsletter|subscribe|signup|login|search|"
                   r"copyright|contentinfo|complementary|navigation|skip)(?![a-z])", re.I)

OPEN, KEPT, DROPPED = 0, 1, 2  # landmark around a block: none, main content, boilerplate

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+>|[^>]*(?:>|\Z))|[^<]+|<",
                   re.S)
ATTR = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    words: int
    link_density: float
    landmark: int


def _landmark(name: str, attrs: str, around: int) -> int:
    """Boilerplate stays boilerplate inside; a page's header is one, an article's header is part of it."""
    if around == DROPPED or name in ASIDE:
        return DROPPED
    if name in CONTENT:
        return KEPT
    if name == "header" and around == OPEN:
        return DROPPED
    if attrs and name not in ("html", "body"):
        for m in ATTR.finditer(attrs):
            value = m[1] or m[2] or m[3] or ""
            if value.lower() in ("main", "article"):
                return KEPT
            if HINTS.search(value):
                return DROPPED
    return around


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page in order. Unclosed and stray tags are taken as they come; comments, scripts and
    other elements without reading text are skipped."""
    out: list[Block] = []
    stack: list[tuple[str, int]] = []  # open elements and the landmark around them
    here, skip, linked = OPEN, None, 0
    parts: list[tuple[str, bool]] = []

    def end_block():
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(t for t, _ in parts))).strip()
            if text:
                in_links = sum(len(html.unescape(t).split()) for t, a in parts if a)
                n = len(text.split())
                out.append(Block(text, n, min(1.0, in_links / n), here))
            parts.clear()

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            first = m[0]
            if first[0] != "<" or first == "<":
                parts.append((first, linked > 0))
            continue
        name = name.lower()
        if m[1]:  # an end tag
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if name == "a":
                linked = 0
            if name not in INLINE:
                end_block()
                if depth is not None:
                    here = stack[depth][1]
                    del stack[depth:]
            continue
        if name in RAW:
            if not m[3].endswith("/>"):
                close = re.compile(r"</" + re.escape(name) + r"(?![a-zA-Z])[^>]*(?:>|\Z)", re.I).search(page, at)
                if close is None and name == "head":
                    continue
                at = close.end() if close else end
            continue
        if name in INLINE:
            linked = 1 if name == "a" else linked
            # an inline element may be a landmark too, such as a hidden notice; it makes a block then
            if (kind := _landmark(name, m[3], here)) != here and not m[3].endswith("/>"):
                end_block()
                close = re.compile(r"</" + re.escape(name) + r"\s*>", re.I).search(page, at)
                if close:
                    inner = SPACE.sub(" ", html.unescape(re.sub(r"<[^>]*>", " ", page[at:close.start()]))).strip()
                    if inner:
                        out.append(Block(inner, len(inner.split()), 0.0, kind))
                    at, linked = close.end(), 0
            continue
        end_block()
        if name not in VOID and not m[3].endswith("/>"):
            stack.append((name, here))
            here = _landmark(name, m[3], here)
            linked = 0
    end_block()
    return out


# The labelled table: words, link density, words and link density of the block before, of the block after, landmark,
# and whether the block is main text.  The landmarks cover both pages that mark their parts and pages that do not.
LABELLED = np.array([
    # marked main content, of any size and beside anything
    (120, 0.0, 90, 0.0, 60, 0.0, 1, 1), (1, 0.0, 80, 0.0, 70, 0.0, 1, 1), (3, 0.0, 1, 1.0, 60, 0.0, 1, 1),
    (9, 0.0, 4, 1.0, 9, 0.0, 1, 1), (9, 0.0, 9, 0.0, 5, 0.0, 1, 1), (2, 0.0, 2, 0.0, 6, 0.5, 1, 1),
    (40, 0.1, 12, 0.0, 8, 0.3, 1, 1), (6, 1.0, 50, 0.0, 40, 0.0, 1, 1), (300, 0.02, 0, 0.0, 0, 0.0, 1, 1),
    (1, 1.0, 30, 0.0, 30, 0.0, 1, 1), (15, 0.0, 1, 1.0, 1, 1.0, 1, 1), (4, 0.0, 0, 0.0, 0, 0.0, 1, 1),
    # marked boilerplate, of any size and beside anything
    (1, 1.0, 1, 1.0, 1, 1.0, 2, 0), (2, 1.0, 0, 0.0, 1, 1.0, 2, 0), (12, 0.0, 1, 1.0, 9, 0.0, 2, 0),
    (60, 0.0, 3, 1.0, 90, 0.0, 2, 0), (8, 0.0, 70, 0.0, 0, 0.0, 2, 0), (120, 0.0, 90, 0.0, 30, 0.0, 2, 0),
    (5, 0.4, 40, 0.0, 0, 0.0, 2, 0), (25, 0.0, 25, 0.0, 25, 0.0, 2, 0), (3, 0.0, 40, 0.0, 40, 0.0, 2, 0),
    (40, 0.0, 6, 0.0, 4, 0.0, 2, 0), (200, 0.0, 3, 0.0, 1, 1.0, 2, 0), (1, 0.0, 1, 1.0, 20, 0.0, 2, 0),
    # unmarked running text
    (80, 0.0, 60, 0.0, 70, 0.0, 0, 1), (35, 0.05, 50, 0.0, 45, 0.0, 0, 1), (150, 0.02, 4, 0.0, 90, 0.1, 0, 1),
    (22, 0.0, 40, 0.0, 30, 0.0, 0, 1), (18, 0.1, 60, 0.0, 2, 1.0, 0, 1), (45, 0.0, 3, 1.0, 50, 0.0, 0, 1),
    (30, 0.2, 25, 0.1, 4, 0.0, 0, 1), (60, 0.0, 0, 0.0, 0, 0.0, 0, 1), (25, 0.0, 8, 0.0, 3, 1.0, 0, 1),
    # unmarked short blocks inside running text: headings, one-word paragraphs
    (5, 0.0, 60, 0.0, 70, 0.0, 0, 1), (1, 0.0, 50, 0.0, 40, 0.0, 0, 1), (8, 0.0, 30, 0.0, 60, 0.0, 0, 1),
    (3, 0.0, 20, 0.0, 25, 0.0, 0, 1), (12, 0.0, 12, 0.0, 40, 0.0, 0, 1), (10, 0.0, 45, 0.0, 14, 0.0, 0, 1),
    (7, 0.0, 1, 1.0, 50, 0.0, 0, 1), (6, 0.0, 2, 1.0, 35, 0.0, 0, 1),
    # unmarked link lists and teasers
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0), (3, 1.0, 2, 1.0, 60, 0.0, 0, 0), (2, 1.0, 50, 0.0, 3, 1.0, 0, 0),
    (6, 0.8, 5, 1.0, 6, 1.0, 0, 0), (15, 0.7, 12, 0.8, 14, 0.9, 0, 0), (30, 0.6, 25, 0.7, 20, 0.8, 0, 0),
    (8, 0.5, 3, 1.0, 2, 1.0, 0, 0), (10, 0.6, 60, 0.0, 50, 0.0, 0, 0), (25, 0.9, 40, 0.0, 3, 1.0, 0, 0),
    # unmarked short blocks away from running text: slogans, captions of forms, copyright lines
    (3, 0.0, 2, 1.0, 1, 1.0, 0, 0), (2, 0.0, 4, 0.0, 1, 1.0, 0, 0), (6, 0.0, 1, 1.0, 2, 0.0, 0, 0),
    (5, 0.0, 60, 0.0, 0, 0.0, 0, 0), (8, 0.2, 80, 0.0, 2, 0.5, 0, 0), (4, 0.25, 3, 0.0, 0, 0.0, 0, 0),
    (2, 0.0, 3, 0.0, 3, 0.0, 0, 0), (7, 0.0, 2, 1.0, 4, 1.0, 0, 0), (9, 0.3, 2, 1.0, 3, 0.3, 0, 0),
])


class Tree:
    """A binary decision tree by Gini impurity; a split is (feature, threshold, left, right), a leaf a label."""

    def __init__(self, table: np.ndarray, depth: int = 7):
        self.root = self._grow(table[:, :-1], table[:, -1], depth)

    def _grow(self, x, y, depth):
        if depth == 0 or y.min() == y.max():
            return int(y.mean() >= 0.5)
        best = None
        for f in (x.shape[1] - 1, *range(x.shape[1] - 1)):  # among equal splits the landmark comes first
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                score = sum(part.sum() * p * (1 - p) for part in (left, ~left) for p in [y[part].mean()])
                if best is None or score < best[0] - 1e-12:
                    best = (score, f, float(cut), left)
        if best is None:
            return int(y.mean() >= 0.5)
        _, f, cut, left = best
        return f, cut, self._grow(x[left], y[left], depth - 1), self._grow(x[~left], y[~left], depth - 1)

    def keep(self, row) -> bool:
        node = self.root
        while not isinstance(node, int):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return bool(node)


@functools.cache
def default_tree() -> Tree:
    return Tree(LABELLED)


def features(bs: list[Block]) -> list[tuple]:
    edge = Block("", 0, 0.0, OPEN)
    return [(b.words, b.link_density, a.words, a.link_density, c.words, c.link_density, b.landmark)
            for a, b, c in zip([edge, *bs[:-1]], bs, [*bs[1:], edge])]


def main_text(page: str, tree: Tree | None = None) -> str:
    tree = tree or default_tree()
    bs = blocks(page)
    return " ".join(b.text for b, row in zip(bs, features(bs)) if tree.keep(row))


def extract_text(page: Column | str) -> Column:
    """Main text of each page; null and empty pages give ''."""
    @F.pandas_udf("string")
    def extract(s):
        import pandas as pd
        return pd.Series([main_text(p if isinstance(p, str) else "") for p in s], dtype=object)
    return extract(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page; one row per row of ``pages``, other columns are ignored."""
    return (pages.select("page_id", "url", extract_text(F.coalesce("html", F.lit(""))).alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
