"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut at block-level tags into blocks of text. Every block has its number of
words and link density and those of its neighbours on both sides, and two facts
about where it stands: inside an article or main element, and inside an element
whose tag, role, class or id says that it is not content. A decision tree, grown here
by Gini impurity on a small table of labelled blocks, says which blocks are content.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rollbook.llm.words import slices, texts_of

# fixed values: tags by what they mean here
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav noframes ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noframes noembed xmp svg math select object".split())
_OUTSIDE = frozenset("nav footer aside form head script style noscript template button fieldset menu dialog iframe select textarea object svg math".split())
_INSIDE = frozenset("article main".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
# words that mark what is not content, if a class or an id is made of them and of the plain words below
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead comment comments reply replies respond "
    "disqus share sharing social related recommended recommendations widget widgets login signup toolbar pagination pager skip".split()
)
_PLAIN = frozenset(
    "area bar block bottom box container content div extra fixed footer global group header inner item items left link links list main outer page panel primary right row "
    "secondary section sidebar site slot sticky top unit wrap wrapper".split()
)

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)(>?)|<[!?][^>]*>?|</[^>]*>?", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_WORDS = re.compile(r"[^\W_]+")


class Block(NamedTuple):
    """Text of a block, its words, those of them in links, and where it stands."""

    text: str
    words: int
    linked: int
    inside: bool
    outside: bool


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if text:
        for m in _ATTRIBUTE.finditer(text):
            if m.start() == 0 or text[m.start() - 1] in " \t\n\f\r\"'/":
                found.setdefault(m[1].lower(), (m[2] or "").strip("\"'"))
    return found


def _not_content(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether tag, role or visibility say that an element is not content."""
    if tag in _OUTSIDE or tag == "header" and not inside:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return True
    return attributes.get("role", "").lower() in _ROLES


def _marked(tag: str, attributes: dict[str, str]) -> bool:
    """Whether a class or the id, as a whole, names something that is not content: "cookie-notice", but not "has-sidebar"."""
    if tag in ("html", "body", "article", "main"):
        return False
    for name in (*attributes.get("class", "").split(), attributes.get("id", "")):
        words = {w.lower() for w in re.split(r"[^A-Za-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name)) if w}
        if words & _MARKS and words <= _MARKS | _PLAIN:
            return True
    return False


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, without empty ones. Time in proportion to the page."""
    found: list[Block] = []
    parts: list[str] = []
    links: list[str] = []
    # open elements: tag, inside an article, not content by tag or role, not content by class or id
    stack: list[tuple[str, bool, bool, bool]] = [("", False, False, False)]
    in_link = 0

    def close() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append(Block(text, len(text.split()), len("".join(links).split()), stack[-1][1], stack[-1][2] or stack[-1][3]))
            parts.clear()
            links.clear()

    def add(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if in_link:
            links.append(text + " ")

    at = 0
    size = len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            add(page[at:])
            break
        m = _TAG.match(page, mark)
        if not m:
            # a lone sign, unless the page ends within a tag
            add(page[at : mark + 1])
            at = mark + 1
            continue
        if mark > at:
            add(page[at:mark])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if not m[4]:
            if at < size and page.find(">", at) >= 0:
                at = page.find(">", at) + 1
            else:
                break
        if m[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            if tag in _BLOCK:
                close()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK:
            close()
            if stack[-1][0] == "p":
                stack.pop()
            if tag == "body":
                # an open head ends here
                stack[1:] = [s for s in stack[1:] if s[0] == "html"]
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "a":
            in_link += 1
        if tag in _VOID or m[3].endswith("/"):
            continue
        attributes = _attributes(m[3])
        _, inside, outside, marked = stack[-1]
        if tag in _BLOCK or attributes:
            # an article in a marked wrapper is an article
            named = tag not in _INSIDE and (marked or _marked(tag, attributes))
            now = (tag, inside or tag in _INSIDE, outside or _not_content(tag, attributes, inside), named)
            changed = now[2:] != (outside, marked)
            if tag in _BLOCK and tag not in ("p", "li", "td", "tr", "th", "dd", "dt", "option") or changed:
                if changed and tag not in _BLOCK:
                    close()
                stack.append(now)
    close()
    return found


def features(found: list[Block]) -> np.ndarray:
    """Per block: words and link density of the one before, itself and the next; inside; outside."""
    own = np.array([(b.words, b.linked / max(b.words, 1)) for b in found], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    before, after = np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])
    place = np.array([(b.inside, b.outside) for b in found], float).reshape(-1, 2)
    return np.hstack([before, own, after, place]) if len(found) else np.zeros((0, 8))


# fixed values: labelled blocks. Words and link density of the block before, the block and the block after; inside an
# article or main element; inside an element that is not content; whether the block is content
LABELLED = (
    (0, 0.0, 3, 1.0, 4, 1.0, 0, 1, 0), (3, 1.0, 2, 1.0, 3, 1.0, 0, 1, 0), (2, 1.0, 1, 1.0, 12, 0.0, 0, 1, 0), (4, 1.0, 9, 0.0, 8, 0.0, 0, 1, 0),
    (9, 0.0, 8, 0.0, 60, 0.0, 1, 0, 1), (8, 0.0, 60, 0.0, 80, 0.0, 1, 0, 1), (60, 0.0, 120, 0.02, 1, 0.0, 1, 0, 1), (120, 0.0, 1, 0.0, 90, 0.0, 1, 0, 1),
    (90, 0.0, 2, 0.0, 14, 0.0, 1, 0, 1), (50, 0.1, 14, 0.0, 0, 0.0, 0, 1, 0), (14, 0.0, 40, 0.0, 25, 0.0, 0, 1, 0), (40, 0.0, 30, 0.0, 22, 0.1, 1, 1, 0),
    (30, 0.0, 6, 0.0, 70, 0.0, 1, 0, 1), (70, 0.0, 18, 0.5, 45, 0.0, 1, 0, 1), (45, 0.0, 55, 0.0, 9, 0.0, 1, 1, 0), (9, 0.0, 3, 0.0, 9, 0.0, 1, 1, 0),
    (200, 0.0, 150, 0.0, 12, 0.0, 1, 0, 1), (12, 0.0, 7, 1.0, 33, 0.0, 1, 0, 1), (0, 0.0, 45, 0.0, 60, 0.0, 0, 0, 1), (45, 0.0, 70, 0.1, 30, 0.0, 0, 0, 1),
    (70, 0.0, 25, 0.05, 3, 1.0, 0, 0, 1), (3, 1.0, 5, 1.0, 4, 1.0, 0, 0, 0), (5, 1.0, 6, 0.8, 2, 1.0, 0, 0, 0), (2, 1.0, 30, 0.7, 4, 0.9, 0, 0, 0),
    (4, 1.0, 3, 0.0, 2, 1.0, 0, 0, 0), (3, 0.0, 5, 0.0, 4, 0.5, 0, 0, 0), (6, 0.0, 8, 0.0, 50, 0.0, 0, 0, 1), (50, 0.0, 4, 0.0, 65, 0.0, 0, 0, 1),
    (65, 0.0, 9, 0.0, 0, 0.0, 0, 0, 0), (60, 0.0, 80, 0.0, 70, 0.0, 0, 1, 0), (0, 0.0, 500, 0.0, 0, 0.0, 1, 0, 1), (0, 0.0, 1, 0.0, 0, 0.0, 1, 0, 1),
    (0, 0.0, 35, 0.0, 0, 0.0, 0, 0, 1), (1, 1.0, 4, 0.5, 1, 0.0, 1, 0, 1), (0, 0.0, 2, 0.5, 0, 0.0, 0, 0, 0), (20, 0.0, 300, 0.3, 10, 0.0, 0, 1, 0),
    (60, 0.0, 2, 0.0, 0, 0.0, 1, 0, 1), (0, 0.0, 2, 0.0, 0, 0.0, 1, 0, 1), (30, 0.0, 12, 0.0, 0, 0.0, 1, 0, 1), (5, 1.0, 6, 0.3, 3, 1.0, 1, 0, 1),
    (4, 1.0, 2, 1.0, 5, 1.0, 1, 0, 1), (12, 0.0, 15, 0.0, 0, 0.0, 1, 0, 1), (3, 0.0, 5, 0.0, 2, 0.0, 1, 0, 1), (2, 0.0, 5, 0.0, 0, 0.0, 0, 0, 0),
    (25, 0.0, 12, 0.0, 0, 0.0, 0, 0, 0), (3, 0.0, 3, 0.0, 30, 0.6, 1, 0, 1), (0, 0.0, 18, 0.0, 0, 0.0, 1, 0, 1), (8, 0.5, 9, 0.0, 2, 0.5, 1, 0, 1),
)


class Tree(NamedTuple):
    """A split (feature, threshold, lower and upper branch), or a leaf with its answer."""

    feature: int
    threshold: float
    lower: "Tree | None"
    upper: "Tree | None"
    answer: bool


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6) -> Tree:
    """A binary tree of least Gini impurity; ties go to the first feature and threshold."""
    share = y.mean()
    leaf = Tree(-1, 0.0, None, None, bool(share >= 0.5))
    if depth == 0 or share in (0.0, 1.0):
        return leaf
    best, least = None, len(y) * share * (1 - share) - 1e-9
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, j] <= cut
            impurity = sum(n * p * (1 - p) for n, p in ((part.size, part.mean()) for part in (y[low], y[~low])))
            if impurity < least:
                best, least = (j, cut, low), impurity
    if best is None:
        return leaf
    j, cut, low = best
    return Tree(j, float(cut), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1), leaf.answer)


def trained(labelled=LABELLED) -> Tree:
    table = np.array(labelled, float)
    return grow(table[:, :-1], table[:, -1])


def content(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Which rows the tree takes for content."""
    out = np.zeros(len(x), bool)
    todo = [(tree, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if node.lower is None:
            out[rows] = node.answer
        else:
            low = x[rows, node.feature] <= node.threshold
            todo += [(node.lower, rows[low]), (node.upper, rows[~low])]
    return out


def main_text(page: str | None, tree: Tree) -> str:
    """Content blocks of a page, in order, separated by an empty line."""
    found = blocks(page or "")
    return "\n\n".join(b.text for b, keep in zip(found, content(tree, features(found))) if keep)


def _extract(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(p, tree) for p in texts_of(batch, "html").to_pylist()]
            rest = [batch.column(c) for c in batch.schema.names if c != "html"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*(c for c in batch.schema.names if c != "html"), "text", "n_chars"])

    return run


def extract_main_text(pages: DataFrame, labelled=LABELLED) -> DataFrame:
    """``page_id, url, text`` and ``n_chars`` (code points) of every row of ``pages``.

    A null or empty page, and one without content, has the empty text. Character
    references are decoded, white space inside a block is one space. Other columns
    are ignored; repeated rows stay. One pass, no shuffle.
    """
    return pages.select("page_id", "url", "html").mapInArrow(_extract(trained(labelled)), "page_id long, url string, text string, n_chars long")
