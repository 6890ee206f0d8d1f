"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into flat blocks of text at block-level tags. Each block is described by its words and link density,
those of the block before and after it, and by the containers it lies in. A decision tree, grown once on the small
labelled table :data:`LABELLED`, says which blocks are article text; the kept ones are joined in page order.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeops.llm.common import carried, keeps_inner_names_apart, prepare_workers, whole_text

# Element names of the HTML standard, by role.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody"
    " td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup and ends with their end tag, or with the page.
RAW = frozenset("script style title textarea iframe".split())
#: Elements that hold markup which is no text of the page. Without an end tag of their own they hold nothing.
EMBEDDED = frozenset("noscript template object svg canvas math select button audio video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ASIDE = frozenset("nav footer aside form menu dialog search".split())
#: Words in class, id and role names that mark what is not the article.
CUES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar topbar tabs toc"
    " sidebar aside widget widgets related recommended trending complementary"
    " footer foot colophon contentinfo copyright masthead header topheader"
    " cookie cookies consent gdpr notice alert warning popup modal overlay newsletter subscribe subscription signup disclaimer paywall"
    " comment comments commentlist reply replies respond discussion disqus reactions"
    " share sharing social login search form feedback".split()
)
_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_EMBEDDED = re.compile(rf"<(?:{'|'.join(sorted(EMBEDDED))})(?=[\s/>])", re.I)
#: First words of a name that says what its element goes with, not what it is ("with-sidebar", "no-comments").
BESIDE = frozenset("with has have no not without".split())
#: What follows "social" where a subject is named, not a bar of buttons.
SUBJECTS = frozenset("science sciences studies history work policy security".split())

FEATURES = (
    "words",
    "link_density",
    "words_before",
    "link_density_before",
    "words_after",
    "link_density_after",
    "in_article",
    "in_main",
    "marked_within",
    "marked_around",
    "heading",
    "page_has_article",
)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    in_article: bool
    in_main: bool
    marked_within: bool
    marked_around: bool
    heading: bool


def _marks(name: str, attributes: str) -> bool:
    """Whether an element is marked as something else than the article."""
    if name in ASIDE:
        return True
    if not attributes or name in ("html", "body", "article", "main") and "omment" not in attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    return any(_names_a_cue(one) for value in _NAMES.findall(attributes) for one in value.strip("\"'").split())


def _names_a_cue(name: str) -> bool:
    words = [w.lower() for w in _WORD.findall(name)]
    subject = len(words) > 1 and words[0] == "social" and words[1] in SUBJECTS
    return any(w in CUES for w in words) and words[0] not in BESIDE and not subject


def _raw_end(page: str, name: str, at: int) -> int:
    """Where a raw element ends whose content begins at ``at``."""
    closing = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(page, at)
    return closing.end() if closing else len(page)


def _embedded_ends(page: str) -> dict[int, int]:
    """For each embedded element with an end tag: where its content begins, and where the element ends."""
    ends: dict[int, int] = {}
    if not _EMBEDDED.search(page):
        return ends
    opened: dict[str, list[int]] = {name: [] for name in EMBEDDED}
    at = 0
    while (tag := _TAG.search(page, at)) is not None:
        at = tag.end()
        name = (tag[2] or "").lower()
        if name in RAW and not tag[1]:
            at = _raw_end(page, name, at)
        elif name in opened:
            if not tag[1]:
                if not tag[3].endswith("/"):
                    opened[name].append(at)
            elif opened[name]:
                # An end tag belongs to the last open one, so an element that was left open ends nowhere.
                ends[opened[name].pop()] = at
    return ends


def blocks(page: str) -> list[Block]:
    """Flat text blocks of a page, in order. Markup that is broken off or never closed is read as browsers do."""
    found: list[Block] = []
    #: Open elements that matter: name, and whether it marks its content.
    opened: list[tuple[str, bool]] = []
    pieces: list[str] = []
    linked = 0

    def piece(text: str) -> None:
        nonlocal linked
        if text:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if any(name == "a" for name, _ in opened):
                linked += len(text.split())

    def flush() -> None:
        nonlocal linked
        if pieces:
            words = "".join(pieces).split()
            if words:
                at = max((k for k, (name, _) in enumerate(opened) if name in ("article", "main")), default=-1)
                names = {name for name, _ in opened}
                found.append(
                    Block(
                        " ".join(words),
                        len(words),
                        min(linked, len(words)),
                        "article" in names,
                        "main" in names,
                        any(marked for _, marked in opened[max(at, 0) :]),
                        any(marked for _, marked in opened[: max(at, 0)]),
                        bool(names & HEADINGS),
                    )
                )
            pieces.clear()
        linked = 0

    at, end, embedded = 0, len(page), _embedded_ends(page)
    while at < end:
        tag = _TAG.search(page, at)
        if tag is None:
            piece(page[at:])
            break
        piece(page[at : tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            if name in BLOCK:
                flush()
            where = next((k for k in range(len(opened) - 1, -1, -1) if opened[k][0] == name), None)
            if where is not None:
                if name in BLOCK or not any(n in BLOCK for n, _ in opened[where + 1 :]):
                    del opened[where:]
                else:
                    del opened[where]
            continue
        if name in RAW:
            at = _raw_end(page, name, at)
            continue
        if name in EMBEDDED:
            at = embedded.get(at, at)
            continue
        if name == "br":
            pieces.append(" ")
        if name in BLOCK:
            flush()
            if name in ("p", "li") or name in HEADINGS:
                # An open paragraph, item or heading ends where the next begins.
                for k in range(len(opened) - 1, -1, -1):
                    if opened[k][0] == name:
                        del opened[k:]
                        break
                    if opened[k][0] in BLOCK:
                        break
        if name == "a":
            opened[:] = [o for o in opened if o[0] != "a"]
        attributes = tag[3]
        if name not in VOID and not (attributes.endswith("/") and name not in BLOCK):
            marked = _marks(name, attributes)
            if marked or name in BLOCK or name == "a":
                opened.append((name, marked))
    flush()
    return found


def describe(found: list[Block]) -> np.ndarray:
    """One row of :data:`FEATURES` for each block of a page."""
    n = len(found)
    rows = np.zeros((n, len(FEATURES)))
    if not n:
        return rows
    words = np.array([b.words for b in found], dtype=float)
    density = np.array([b.linked for b in found]) / words
    rows[:, 0], rows[:, 1] = words, density
    rows[1:, 2], rows[1:, 3] = words[:-1], density[:-1]
    rows[:-1, 4], rows[:-1, 5] = words[1:], density[1:]
    rows[:, 6] = [b.in_article for b in found]
    rows[:, 7] = [b.in_main for b in found]
    rows[:, 8] = [b.marked_within for b in found]
    rows[:, 9] = [b.marked_around for b in found]
    rows[:, 10] = [b.heading for b in found]
    rows[:, 11] = rows[:, 6].any()
    return rows


class Tree:
    """A binary decision tree: at each node one feature against one threshold."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, depth: int = 10):
        self.share = float(labels.mean()) if len(labels) else 0.0
        self.feature = -1
        best = (self._impurity(labels) - 1e-9, -1, 0.0)
        if depth and 0 < self.share < 1:
            for feature in range(rows.shape[1]):
                levels = np.unique(rows[:, feature])
                for threshold in (levels[1:] + levels[:-1]) / 2:
                    low = rows[:, feature] <= threshold
                    cost = self._impurity(labels[low]) + self._impurity(labels[~low])
                    if cost < best[0] - 1e-9:
                        best = (cost, feature, float(threshold))
        if best[1] >= 0:
            self.feature, self.threshold = best[1], best[2]
            low = rows[:, self.feature] <= self.threshold
            self.low, self.high = Tree(rows[low], labels[low], depth - 1), Tree(rows[~low], labels[~low], depth - 1)

    @staticmethod
    def _impurity(labels: np.ndarray) -> float:
        share = labels.mean() if len(labels) else 0.0
        return len(labels) * share * (1 - share)

    def keeps(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0 or not len(rows):
            return np.full(len(rows), self.share >= 0.5)
        low = rows[:, self.feature] <= self.threshold
        out = np.zeros(len(rows), dtype=bool)
        out[low], out[~low] = self.low.keeps(rows[low]), self.high.keeps(rows[~low])
        return out


_LONG = "A long sentence of the story tells what happened there in the town that day and who saw it happen. " * 2
_MID = "The mayor spoke for some minutes and then left the hall."
#: The labelled table: pages, and which of their blocks (in order) are article text. Written by hand.
LABELLED: list[tuple[str, str]] = [
    (
        f"<nav><a>Home</a><ul><li><a>News</a><li><a>Sport today</a></ul></nav><article><h1>Town hall</h1><p>{_LONG}<p>Yes.<p>{_MID}"
        f"</article><footer>&copy; The paper, all rights reserved by us</footer>",
        "0001111" + "0",
    ),
    (
        f"<header class='site-header'><a>The Paper</a></header><div class='ad'>{_MID}</div><article><header><h1>Snow</h1></header><p>{_LONG}</p>"
        f"<div class='ad'>{_LONG}</div><p>One <a>link</a> here</p><p>{_LONG}</p><section class='comments'><p>{_LONG}</p><p>Nice.</p></section>"
        f"</article><aside><p>{_LONG}</p><a>More</a></aside><footer><p>{_LONG}</p></footer>",
        "00" + "11011" + "00" + "00" + "0",
    ),
    (
        f"<div id='menu'><a>Start</a> <a>About us</a></div><div id='content'><h1>A walk</h1><p>{_LONG}</p><p>{_MID}</p><p>Why?</p><p>{_LONG}</p>"
        f"</div><div class='sidebar'><p>{_LONG}</p></div><div id='footer'>{_MID}</div>",
        "0" + "11111" + "00",
    ),
    (
        f"<div><a>Home</a> | <a>Contact</a></div><div><h2>Rain</h2></div><div>{_LONG}</div><div>{_LONG}</div><div><a>Next story</a></div>"
        f"<div><a>Imprint</a> <a>Privacy</a></div>",
        "0" + "111" + "00",
    ),
    (
        f"<main><div class='cookie-notice'>{_MID}</div><h1>Bread</h1><p>{_LONG}</p><ul><li>flour</li><li>water and salt</li></ul><p>{_MID}</p>"
        f"<form><p>{_MID}</p><label>Your name</label></form><div class='newsletter'><p>{_MID}</p></div></main>",
        "0" + "11111" + "000",
    ),
    (
        f"<article><h1>List</h1><p>{_MID}</p><ol><li>one</li><li>two <a>three</a></li></ol><table><tr><td>7</td><td>8</td></tr></table>"
        f"<blockquote>{_MID}</blockquote><div class='share'><a>Send</a></div><div class='related'><a>Other story of the day</a></div></article>",
        "1111111" + "00",
    ),
    (
        f"<aside><article><h2>Teaser</h2><p>{_MID}</p></article></aside><article><h1>Real</h1><p>{_LONG}</p></article>"
        f"<section id='comments'><article class='comment'><p>{_LONG}</p></article></section>",
        "00" + "11" + "0",
    ),
    (
        f"<main><article><p><a>All of this paragraph is one link</a></p><p>{_MID}</p><p>No</p></article><nav><a>Older</a></nav></main>"
        f"<div class='notice'><p>{_LONG}</p></div><p>Printed in town</p>",
        "111" + "000",
    ),
    (f"<body><p>{_LONG}</p><p>{_MID}</p><p>End.</p></body>", "111"),
    ("<article><p>Short.</p></article>", "1"),
    ("<body><ul><li><a>Home</a></li><li><a>Mail</a></li></ul></body>", "00"),
    (f"<nav><a>Home</a></nav><article><h1>Broken off</h1><p>{_MID}</p><p>{_LONG}", "0" + "111"),
    (f"<article><p>{_LONG}</p><p>{_MID}</p></article>", "11"),
    (f"<article><h1>Alone</h1><p>{_MID}</article>", "11"),
    (f"<article><p>{_LONG}</p><p>Three short words</p></article><p>Printed in our town hall</p><p>All rights reserved</p>", "11" + "00"),
    (f"<p>Sign in or register now</p><article><h1>First</h1><p>One two.</p><p>{_LONG}</p></article><p>{_MID}</p>", "0" + "111" + "0"),
    (f"<p>Edition of the day</p><p>{_MID}</p><article><p>{_MID}</p><p>{_MID}</p></article><p><a>Top</a></p>", "00" + "11" + "0"),
    (f"<main><p>{_LONG}</p><p>{_MID}", "11"),
    (f"<main><h1>Heading here</h1><p>{_LONG}", "11"),
    (f"<div><a>Home</a></div><h1>Some heading</h1><p>{_LONG}</p><p>{_MID}", "0" + "111"),
    (f"<div><p>{_LONG}</p></div><div>{_MID}</div>", "11"),
    (f"<article><h1>Links</h1><p><a>Read this whole story</a></p><p>{_LONG}</p><p><a>And this one</a></p></article>", "1111"),
    (f"<main><h1>Title</h1><p>Ok.</p><p>{_MID}</p><p>{_LONG}</p></main><footer>{_MID}</footer>", "1111" + "0"),
]


def labelled() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page, marks in LABELLED:
        found = blocks(page)
        if len(found) != len(marks):
            raise ValueError(f"{len(found)} blocks, {len(marks)} labels: {[b.text[:20] for b in found]}")
        rows.append(describe(found))
        labels += [int(m) for m in marks]
    return np.concatenate(rows), np.array(labels)


def main_text(page: str, tree: Tree) -> str:
    """Text of the kept blocks, one line each."""
    found = blocks(page)
    return "\n".join(b.text for b, kept in zip(found, tree.keeps(describe(found)), strict=True) if kept)


@keeps_inner_names_apart
def extract(df: DataFrame, html_column: str = "html", out: str = "text") -> DataFrame:
    """Add ``out``, the main text of each whole page: the empty string if there is none.

    NULL and empty pages give the empty string. Rows stay one to one, repeated ones too; a column called like the
    result is replaced, the others are kept but for the page's source.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    tree = Tree(*labelled())
    keep = [c for c in carried(df, [out]) if c.lower() != html_column.lower()]
    schema = T.StructType([*df.select(*keep).schema, T.StructField(out, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [blocks(p) for p in batch.column("_page").to_pylist()]
            rows = np.concatenate([describe(found) for found in pages]) if pages else np.zeros((0, len(FEATURES)))
            kept, texts, at = tree.keeps(rows), [], 0
            for found in pages:
                texts.append("\n".join(b.text for b, k in zip(found, kept[at : at + len(found)], strict=True) if k))
                at += len(found)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(texts, pa.string())], names=[*keep, out])

    return df.select(*keep, whole_text(html_column).alias("_page")).mapInArrow(run, schema)


