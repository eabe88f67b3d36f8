"""Main text of web pages: flat text blocks judged by a small decision tree.

A page becomes a list of blocks, stretches of text between block tags. Each is described by
its own words and link density, those of its neighbours, the kind of region it stands in
and whether it is a heading; a tree grown on a small labelled table keeps or drops it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FEATURES = ("prev_words", "prev_link", "words", "link", "next_words", "next_link", "region", "heading")

# Labelled blocks, a row each: the features above, then 1 for main text and 0 for the rest.
# ``region`` is 1 within an article, -1 within a menu, footer, sidebar and the like, else 0.
LABELLED = (
    # within an article: long and short paragraphs, titles, lists, quotes, one linked word
    (0, 0.0, 9, 0.0, 60, 0.0, 1, 1, 1), (9, 0.0, 60, 0.0, 45, 0.0, 1, 0, 1), (60, 0.0, 3, 0.0, 40, 0.0, 1, 0, 1),
    (45, 0.0, 1, 0.0, 80, 0.0, 1, 0, 1), (3, 0.0, 120, 0.05, 10, 0.0, 1, 0, 1), (40, 0.0, 5, 0.0, 50, 0.0, 1, 1, 1),
    (80, 0.0, 30, 0.3, 20, 0.0, 1, 0, 1), (10, 0.0, 250, 0.0, 0, 0.0, 1, 0, 1), (0, 0.0, 4, 0.0, 0, 0.0, 1, 0, 1),
    (6, 1.0, 12, 0.0, 30, 0.0, 1, 0, 1), (8, 0.0, 2, 0.0, 6, 0.0, 1, 0, 1), (25, 0.0, 14, 0.4, 30, 0.1, 1, 0, 1),
    # ends of articles, single paragraphs and titles beside menus
    (60, 0.0, 30, 0.0, 1, 1.0, 1, 0, 1), (60, 0.0, 6, 0.0, 2, 1.0, 1, 0, 1), (2, 1.0, 9, 0.0, 3, 1.0, 1, 0, 1),
    (1, 1.0, 2, 0.0, 1, 1.0, 1, 1, 1), (2, 1.0, 5, 0.0, 1, 1.0, 1, 0, 1), (1, 1.0, 20, 0.2, 4, 1.0, 1, 0, 1),
    (0, 0.0, 60, 0.0, 0, 0.0, 0, 0, 1), (1, 1.0, 45, 0.0, 1, 1.0, 0, 0, 1), (0, 0.0, 90, 0.1, 2, 1.0, 0, 0, 1),
    (2, 1.0, 34, 0.0, 4, 0.0, 0, 0, 1), (3, 0.0, 42, 0.1, 0, 0.0, 0, 0, 1), (5, 1.0, 30, 0.0, 5, 1.0, 0, 0, 1),
    # within an article: link lists, share and read-more lines
    (50, 0.0, 2, 1.0, 3, 1.0, 1, 0, 0), (2, 1.0, 3, 1.0, 2, 1.0, 1, 0, 0), (3, 1.0, 4, 1.0, 0, 0.0, 1, 0, 0),
    (90, 0.0, 8, 0.9, 40, 0.0, 1, 0, 0), (20, 0.0, 6, 1.0, 70, 0.0, 1, 0, 0), (0, 0.0, 10, 0.8, 5, 0.9, 1, 0, 0),
    # menus, page headers and footers, sidebars, notices, adverts, forms, reader comments
    (0, 0.0, 1, 1.0, 1, 1.0, -1, 0, 0), (1, 1.0, 2, 1.0, 1, 1.0, -1, 0, 0), (4, 1.0, 10, 0.0, 8, 0.0, -1, 0, 0),
    (200, 0.0, 12, 0.0, 0, 0.0, -1, 0, 0), (80, 0.0, 60, 0.0, 50, 0.0, -1, 0, 0), (50, 0.0, 150, 0.0, 30, 0.0, -1, 0, 0),
    (30, 0.0, 25, 0.2, 4, 1.0, -1, 0, 0), (0, 0.0, 6, 0.0, 9, 0.0, -1, 1, 0), (10, 0.0, 3, 0.0, 70, 0.0, -1, 0, 0),
    (3, 0.0, 40, 0.0, 60, 0.0, -1, 0, 0), (70, 0.0, 5, 0.0, 25, 0.0, -1, 1, 0), (1, 1.0, 300, 0.0, 2, 1.0, -1, 0, 0),
    # no region known: long paragraphs and what stands between them is text
    (0, 0.0, 40, 0.0, 50, 0.0, 0, 0, 1), (40, 0.0, 50, 0.0, 35, 0.0, 0, 0, 1), (2, 1.0, 70, 0.02, 3, 1.0, 0, 0, 1),
    (60, 0.0, 8, 0.0, 45, 0.0, 0, 0, 1), (50, 0.0, 25, 0.1, 60, 0.0, 0, 0, 1), (35, 0.0, 18, 0.0, 22, 0.0, 0, 0, 1),
    (2, 1.0, 7, 0.0, 65, 0.0, 0, 1, 1), (0, 0.0, 5, 0.0, 48, 0.0, 0, 1, 1), (55, 0.0, 4, 0.0, 42, 0.0, 0, 1, 1),
    (30, 0.0, 20, 0.0, 0, 0.0, 0, 0, 1), (44, 0.0, 16, 0.0, 3, 0.0, 0, 0, 1), (5, 0.0, 33, 0.1, 28, 0.1, 0, 0, 1),
    # no region known: short paragraphs and titles with text behind them
    (50, 0.0, 9, 0.0, 30, 0.0, 0, 0, 1), (38, 0.0, 6, 0.0, 28, 0.0, 0, 0, 1), (25, 0.0, 11, 0.0, 44, 0.0, 0, 0, 1),
    (18, 0.0, 7, 0.0, 35, 0.0, 0, 0, 1), (64, 0.0, 12, 0.0, 14, 0.0, 0, 0, 1), (12, 0.0, 28, 0.0, 9, 0.0, 0, 0, 1),
    (9, 0.0, 13, 0.0, 10, 0.0, 0, 0, 1), (8, 0.0, 9, 0.0, 50, 0.0, 0, 1, 1), (11, 0.0, 4, 0.0, 22, 0.0, 0, 1, 1),
    (9, 0.0, 9, 0.0, 12, 0.0, 0, 0, 1), (30, 0.0, 9, 0.0, 8, 0.0, 0, 0, 1), (16, 0.0, 14, 0.0, 15, 0.0, 0, 0, 1),
    # no region known: notices behind menus, closing lines behind the text
    (1, 1.0, 8, 0.0, 9, 0.0, 0, 0, 0), (1, 1.0, 12, 0.0, 6, 0.0, 0, 0, 0), (1, 1.0, 10, 0.0, 12, 0.0, 0, 0, 0),
    (1, 1.0, 7, 0.0, 15, 0.0, 0, 0, 0), (45, 0.0, 11, 0.0, 0, 0.0, 0, 0, 0), (30, 0.0, 9, 0.0, 0, 0.0, 0, 0, 0),
    (70, 0.0, 14, 0.0, 0, 0.0, 0, 0, 0), (52, 0.0, 8, 0.0, 0, 0.0, 0, 0, 0), (12, 0.0, 13, 0.0, 0, 0.0, 0, 0, 0),
    # no region known: menus, scattered short lines, link lists, copyright lines
    (0, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0), (2, 1.0, 1, 1.0, 3, 1.0, 0, 0, 0), (40, 0.0, 3, 1.0, 2, 1.0, 0, 0, 0),
    (3, 1.0, 5, 0.0, 2, 1.0, 0, 0, 0), (0, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0), (4, 0.0, 3, 0.0, 4, 0.5, 0, 0, 0),
    (2, 1.0, 6, 0.0, 0, 0.0, 0, 0, 0), (30, 0.0, 12, 0.8, 9, 0.9, 0, 0, 0), (9, 0.9, 20, 0.9, 14, 0.8, 0, 0, 0),
    (3, 0.0, 8, 0.0, 5, 0.0, 0, 0, 0), (6, 0.0, 5, 0.0, 2, 1.0, 0, 1, 0), (1, 1.0, 4, 0.0, 4, 1.0, 0, 1, 0),
    (7, 0.0, 9, 0.3, 0, 0.0, 0, 0, 0), (20, 0.9, 30, 0.7, 10, 0.9, 0, 0, 0), (60, 0.0, 5, 0.0, 1, 1.0, 0, 0, 0),
)


@dataclass
class Node:
    """A leaf with a verdict, or a split: rows whose feature is at most ``bound`` go to ``low``."""

    keep: bool = False
    feature: int = -1
    bound: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Node:
    """Tree with the purest splits by Gini; ties go to the first feature and lowest bound."""
    if depth == 0 or y.min() == y.max():
        return Node(keep=bool(y.mean() >= 0.5))
    best = (np.inf, 0, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for bound in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= bound
            impurity = sum(part.mean() * (1 - part.mean()) * len(part) for part in (y[low], y[~low]))
            best = min(best, (round(float(impurity), 9), f, float(bound)))
    if best[0] == np.inf:
        return Node(keep=bool(y.mean() >= 0.5))
    _, f, bound = best
    low = x[:, f] <= bound
    return Node(False, f, bound, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))


def trained(table: tuple = LABELLED) -> Node:
    rows = np.array(table, np.float64)
    return grow(rows[:, :-1], rows[:, -1])


def judge(tree: Node, row: tuple) -> bool:
    while tree.feature >= 0:
        tree = tree.low if row[tree.feature] <= tree.bound else tree.high
    return tree.keep


# Fixed word lists: tags by what they do to the text, and words of classes and ids.
SILENT = frozenset("script style template head title svg select option textarea button iframe".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr input label object canvas audio video "
    "math semantics mrow mi mo mn ms mtext mspace mfrac msqrt mroot msup msub msubsup mover munder munderover mstyle".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTER = frozenset("nav header footer aside form menu dialog fieldset".split())
INNER = frozenset("article main".split())
OUTER_WORDS = frozenset(
    "nav navbar navigation menu menus header masthead topbar footer foot sidebar aside ad ads adv advert adverts advertisement "
    "advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification alert comment comments "
    "disqus reply replies respond responses discussion share sharing social related recommended breadcrumb breadcrumbs login signin signup "
    "newsletter subscribe subscription form search popup modal overlay pagination pager widget widgets copyright toolbar skip".split()
)
INNER_WORDS = frozenset("article content post entry story main text prose body maincontent".split())
OUTER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
OUTER_HEADINGS = frozenset(
    "comments|reader comments|leave a comment|leave a reply|related|related articles|related posts|share|share this|advertisement|"
    "sponsored|newsletter|subscribe|read more|more stories|sign up|log in".split("|")
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_NO_LETTER = re.compile(r"[^a-z]+")


def region_of(tag: str, attributes: str, in_article: bool = False) -> int:
    """-1 for what frames a page, 1 for what holds its text, 0 when nothing tells.

    The header of an article is part of it.
    """
    if tag in OUTER and not (in_article and tag == "header"):
        return -1
    found = 1 if tag in INNER else 0
    if not attributes or tag in ("html", "body"):
        return found
    outer = inner = False
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        if name.lower() == "role":
            outer |= value in OUTER_ROLES
            inner |= value in ("main", "article")
        else:
            words = set(_NO_LETTER.split(value))
            outer |= not words.isdisjoint(OUTER_WORDS)
            inner |= not words.isdisjoint(INNER_WORDS)
    if outer and not inner and tag not in INNER:
        return -1
    return 1 if inner and not outer else found


@dataclass
class Block:
    text: str
    words: int
    link: float
    region: int
    heading: bool


def blocks(page: str) -> list[Block]:
    """Text between block tags, in page order; unclosed tags end where their parent ends.

    Time is proportional to the page, however deep or unclosed its tags are.
    """
    out: list[Block] = []
    # Open tags that are not inline: name, region with those around it, blocks before it.
    stack: list[tuple[str, int, int]] = []
    opened: Counter[str] = Counter()
    endless: set[str] = set()  # silent tags that end nowhere in the rest of the page
    parts: list[tuple[str, bool]] = []  # text of the running block, and whether a link holds it
    links, heading, at = 0, False, 0

    def pop() -> str:
        name = stack.pop()[0]
        opened[name] -= 1
        return name

    def drop_section() -> None:
        """The section or box that opens with the last heading frames the page, like the heading."""
        k = len(stack) - 1
        while k >= 0 and stack[k][0] in _HEADINGS:
            k -= 1
        if k >= 0 and stack[k][0] in ("section", "div") and stack[k][2] == len(out) - 1:
            stack[k:] = [(name, -1, n) for name, _, n in stack[k:]]

    def flush() -> None:
        nonlocal parts
        whole = " ".join(html.unescape("".join(t for t, _ in parts)).split())
        if whole:
            linked = len(html.unescape(" ".join(t for t, a in parts if a)).split())
            n = len(whole.split())
            out.append(Block(whole, n, min(1.0, linked / n), stack[-1][1] if stack else 0, heading))
            if heading and whole.lower().strip(" :.!") in OUTER_HEADINGS:
                out[-1].region = -1
                drop_section()
        parts = []

    while True:
        token = _TOKEN.search(page, at)
        parts.append((page[at : token.start() if token else len(page)], links > 0))
        if not token:
            break
        at = token.end()
        if not token[2]:
            continue
        tag, closing, attributes = token[2].lower(), bool(token[1]), token[3]
        if tag in SILENT:
            # what it holds is no text of the page, and its tags do not count
            if not closing and not attributes.rstrip().endswith("/") and tag not in endless:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if end:
                    at = end.end()
                elif tag in ("script", "style", "template", "svg"):
                    at = len(page)
                else:
                    endless.add(tag)
            continue
        if tag == "a":
            links = max(0, links - 1) if closing else links + 1
            continue
        if tag == "br":
            parts.append((" ", links > 0))
            continue
        if tag in INLINE:
            continue
        flush()
        links = 0
        if closing:
            if opened[tag]:
                while pop() != tag:
                    pass
        elif tag not in VOID:
            # a paragraph, item, heading or cell ends where the next one starts
            while stack and stack[-1][0] in _SHORT and (tag in _SHORT or stack[-1][0] == "p"):
                if stack[-1][0] == "li" and tag == "p" or stack[-1][0] in ("td", "th", "dd") and tag not in ("td", "th", "tr", "dt", "dd"):
                    break
                pop()
            around = stack[-1][1] if stack else 0
            own = region_of(tag, attributes, opened["article"] > 0)
            stack.append((tag, -1 if own < 0 else around or own, len(out)))
            opened[tag] += 1
        heading = any(t in _HEADINGS for t, _, _ in stack[-2:])
    flush()
    return out


_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SHORT = frozenset("p li dt dd td th tr option h1 h2 h3 h4 h5 h6".split())


def main_text(page: str | None, tree: Node) -> str:
    """Blocks that the tree keeps, joined by an empty line."""
    found = blocks(page or "")
    kept = []
    for k, b in enumerate(found):
        before = found[k - 1] if k else None
        after = found[k + 1] if k + 1 < len(found) else None
        row = (
            before.words if before else 0, before.link if before else 0.0, b.words, b.link,
            after.words if after else 0, after.link if after else 0.0, b.region, int(b.heading),
        )
        if judge(tree, row):
            kept.append(b.text)
    return "\n\n".join(kept)


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, main text and its code points.

    A null or empty page gives an empty text. Repeated rows give a row each; other columns
    are ignored.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                texts = [main_text(page.as_py(), tree) for page in piece.column("html")]
                columns = [piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(extract, schema)
