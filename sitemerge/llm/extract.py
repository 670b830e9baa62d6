"""Main text of raw HTML from flat text blocks and a decision tree.

A page is read as a flat row of text blocks, the texts between the borders of
block elements.  Each block is described by its own number of words and share of
linked words, by those of the blocks before and after it, and by the zone that
its open elements put it in: the main part (article, main, or containers named
like it; of several kinds on a page the most telling counts), or one of menus,
headers, footers, sidebars, notices, adverts, forms and reader comments, by
element, role or words of class and id.  A decision tree tells main text from
the rest.  It is grown (Gini impurity) from the small labelled table
``LABELLED`` whenever ``train`` is called; nothing else is learned.

Elements are closed as a browser would in the usual cases: a new block ends an
open paragraph, an item its predecessor, an end tag everything inside; stray end
tags count for nothing; a tag cut off at the end of the page is no text.

Tasks are independent (no shuffle); a page is read whole, however long.

Defined results: null or empty html, and pages without main text, give the
empty text; row order and repeated rows stay; an empty table gives an empty
table; other columns are passed on, and input columns named like an output are
replaced by it.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import giving_back, text_slices

# Elements by what they do to the text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search "
    "section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes plaintext script style textarea title xmp".split())
NO_TEXT = frozenset("audio button canvas datalist noscript object select svg template video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPES = frozenset("caption html table td th".split())
# an open element that a new one of the same row ends, and where the search for it stops
ROW_OF = {"li": (("li",), ("ol", "ul", "menu")), "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",)),
          "tr": (("tr",), ("table",)), "td": (("td", "th"), ("table", "tr")), "th": (("td", "th"), ("table", "tr"))}

# Zones by element, role, and words of class and id.
ASIDE_TAGS = frozenset("aside dialog footer menu nav search".split())
WEAK_ASIDE_TAGS = frozenset("form header".split())  # an article inside them is still one
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
                        "note search toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies copyright disqus disclaimer footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notification pager pagination popup promo promoted promotion recommended "
    "related respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar "
    "topbar widget widgets".split())
MAIN_WORDS = frozenset("article articlebody content entry main post story".split())
NOT_WORDS = frozenset("has no with without".split())  # `has-sidebar` is a layout, not a sidebar

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(
    r"(?<![^\s\"'/])(class|id|role|hidden|style|aria-hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?(?![^\s=/])", re.I)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
_IDEOGRAPHS = re.compile("[぀-ヿ㐀-䶿一-鿿]")

FEATURES = ("words", "linked", "words_before", "linked_before", "words_after", "linked_after",
            "in_main", "in_aside", "heading", "page_has_main")

# The labelled table: a page a line, its blocks in page order, each as
# zone (m main, a aside, p plain), h for a heading, words/linked words, label (+ main text, - not).
LABELLED = """
a1/1- a1/1- a2/2- a1/1- a8/0- mh9/0+ m24/0+ m120/0+ m60/3+ a12/0-
a1/1- a1/1- a1/1- a30/0- mh6/0+ m6/0+ m1/0+ m14/14+ m90/0+ m2/0+ a9/1-
a2/2- a3/3- a40/2- mh12/0+ m8/0+ m3/0+ m45/0+ a60/0- m35/0+ a16/0- a25/0-
p5/0- p20/0- a3/3- mh4/0+ m7/0+ m300/12+ m5/5+ m18/0+ p45/0- p12/4- a30/30-
ph3/0- p28/0- m2/0+ m4/0+ m9/0+ p60/0- a7/0- p3/3- p3/3-
a1/1- a80/0- a45/3- p15/0- mh7/0+ m1/1+ m2/2+ m70/5+ p30/0- p2/0-
a50/0- a120/4- a90/0- m11/0+ a200/0- a150/2- m3/0+ a70/0-
p1/1- p1/1- p2/2- ph8/0+ p40/0+ p85/2+ p9/0+ p60/0+ p4/4- p5/5- p6/0-
p2/2- p2/2- p1/1- p1/1- ph6/0+ p25/0+ p110/6+ ph4/0+ p75/0+ p3/0- p1/1- p2/2-
p3/3- p4/4- p30/0+ p55/1+ p18/0+ p140/0+ p8/8- p9/9- p7/7-
a1/1- a2/2- ph10/0+ p22/0+ p12/0+ p48/4+ p33/0+ a40/0- a9/3- p5/5- p4/0-
p2/0- p5/5- p6/6- p7/7- p20/20- p18/16- p4/4- p5/0- p6/6-
ph5/0+ p150/0+ p200/9+ p70/0+
p70/0+
ph9/0+ p12/0+
p1/1- p3/3- p6/0- p2/2- p4/4- p3/0- a20/0- a40/40-
p3/2- ph3/0+ p25/0+ p33/0+ p19/0+ a21/0- p4/4- p1/1-
ph2/0+ p40/0+ ph5/0+ p90/2+ p2/0-
a35/0- ph7/0+ p16/0+ p26/2+ p10/0+ a35/12- p2/2- p3/3- p2/0-
"""


def labelled_rows(table: str = LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the table's blocks."""
    xs, ys = [], []
    for line in table.split("\n"):
        found = re.findall(r"([map])(h?)(\d+)/(\d+)([+-])", line)
        if found:
            blocks = [(z == "m", z == "a", bool(h), int(n), int(k)) for z, h, n, k, _ in found]
            xs.append(features(blocks, [0, len(blocks)]))
            ys += [y == "+" for *_, y in found]
    return np.concatenate(xs), np.array(ys)


def features(blocks: list[tuple], edges: list[int]) -> np.ndarray:
    """One row per block (in_main, in_aside, heading, words, linked words); pages
    start at ``edges``.  Beyond a page's ends words and links are 0."""
    b = np.array(blocks, dtype=np.float64).reshape(-1, 5)
    n = len(b)
    words, linked = b[:, 3], b[:, 4] / np.maximum(b[:, 3], 1)
    out = np.zeros((n, len(FEATURES)))
    out[:, 0], out[:, 1] = words, linked
    out[1:, 2], out[1:, 3], out[:-1, 4], out[:-1, 5] = words[:-1], linked[:-1], words[1:], linked[1:]
    edges = np.asarray(edges)
    some = np.diff(edges) > 0
    out[edges[:-1][some], 2:4] = 0
    out[edges[1:][some] - 1, 4:6] = 0
    out[:, 6:9] = b[:, 0:3]
    page = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    out[:, 9] = np.bincount(page, weights=b[:, 0], minlength=len(edges) - 1)[page] > 0
    return out


class Tree:
    """A binary decision tree: rows with x[feature] <= cut go left."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8):
        self.feature, self.cut, self.left, self.right, self.share = [], [], [], [], []
        self._grow(x, y.astype(np.float64), depth)

    def _grow(self, x, y, depth) -> int:
        me = len(self.share)
        self.share.append(float(y.mean()))
        for side in (self.feature, self.cut, self.left, self.right):
            side.append(-1)
        best = None
        if depth and 0 < y.sum() < len(y):
            for f in range(x.shape[1]):
                order = np.argsort(x[:, f], kind="stable")
                v, up = x[order, f], np.cumsum(y[order])
                at = np.flatnonzero(np.diff(v) > 0)
                if len(at):
                    n = at + 1.0
                    a, b, m = up[at], up[-1] - up[at], len(y) - n
                    gini = a * (1 - a / n) + b * (1 - b / m)
                    i = int(np.argmin(gini))
                    if best is None or gini[i] < best[0] - 1e-12:
                        best = (gini[i], f, (v[at[i]] + v[at[i] + 1]) / 2)
        if best:
            _, f, cut = best
            low = x[:, f] <= cut
            self.feature[me], self.cut[me] = f, cut
            self.left[me] = self._grow(x[low], y[low], depth - 1)
            self.right[me] = self._grow(x[~low], y[~low], depth - 1)
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of main blocks in each row's leaf."""
        feature, cut = np.array(self.feature), np.array(self.cut, dtype=np.float64)
        left, right, share = np.array(self.left), np.array(self.right), np.array(self.share)
        at = np.zeros(len(x), dtype=np.int64)
        while len(x):
            f = feature[at]
            if (f < 0).all():
                break
            low = x[np.arange(len(x)), np.maximum(f, 0)] <= cut[at]
            at = np.where(f < 0, at, np.where(low, left[at], right[at]))
        return share[at]


def train(table: str = LABELLED) -> Tree:
    return Tree(*labelled_rows(table))


class _Reader:
    """Reads one page into blocks [rank of main zone, in_aside, heading, words, linked words, text]."""

    def __init__(self):
        self.blocks: list[list] = []
        self.parts: list[str] = []
        self.linked = 0
        self.stack: list[tuple] = []  # (name, zone before it)
        self.open: Counter[str] = Counter()
        # rank of the main zone (0 none), aside, weak aside, no text, heading
        self.zone = (0, False, False, False, False)

    def flush(self):
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                rank, aside, weak, _, heading = self.zone
                n = text.count(" ") + 1 + len(_IDEOGRAPHS.findall(text)) // 2
                self.blocks.append([rank, aside or weak, heading, n, min(self.linked, n), text])
            self.parts = []
        self.linked = 0

    def text(self, piece: str):
        if not self.zone[3]:
            if "&" in piece:
                piece = unescape(piece)
            self.parts.append(piece)
            if self.open["a"]:
                self.linked += len(piece.split()) + len(_IDEOGRAPHS.findall(piece)) // 2

    def pop_to(self, at: int):
        zone = self.stack[at][1]
        if zone[:4] != self.zone[:4]:
            self.flush()
        for name, _ in self.stack[at:]:
            self.open[name] -= 1
        del self.stack[at:]
        self.zone = zone

    def find(self, names: tuple, until=frozenset()) -> int:
        """Where the innermost open element of these names is, or -1."""
        if any(self.open[n] for n in names):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in names:
                    return i
                if self.stack[i][0] in until:
                    return -1
        return -1

    def start(self, name: str, attributes: str):
        if name == "br":
            self.parts.append(" ")
            return
        if name in BLOCKS:
            self.flush()
            if (at := self.find(("p",), BLOCKS - {"p"})) >= 0:
                self.pop_to(at)
        if name in ROW_OF:
            names, until = ROW_OF[name]
            if (at := self.find(names, frozenset(until))) >= 0:
                self.pop_to(at)
        if name == "a" and (at := self.find(("a",), SCOPES)) >= 0:
            self.pop_to(at)
        if name in VOID:
            return
        zone = self.zone_of(name, attributes)
        if zone[:4] != self.zone[:4]:
            self.flush()
        self.stack.append((name, self.zone))
        self.open[name] += 1
        self.zone = zone

    def end(self, name: str):
        if name in BLOCKS:
            self.flush()
            until = SCOPES if name not in SCOPES else frozenset()
        else:
            until = BLOCKS  # an inline end tag ends nothing outside its block
        if name == "a":
            until = SCOPES
        if (at := self.find((name,), until - {name})) >= 0:
            self.pop_to(at)

    def zone_of(self, name: str, attributes: str) -> tuple:
        rank, aside, weak, silent, heading = self.zone
        silent = silent or name in NO_TEXT
        heading = name in HEADINGS or (heading and name not in BLOCKS)
        words, named = set(), ""
        if attributes and name not in ("html", "body"):
            for key, *values in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), unescape("".join(values))
                if key == "hidden" or (key == "aria-hidden" and value == "true") or (
                        key == "style" and re.search(r"display:none|visibility:hidden", re.sub(r"\s", "", value.lower()))):
                    aside = True
                elif key == "role":
                    aside = aside or value.lower() in ASIDE_ROLES
                    if value.lower() in ("main", "article"):
                        named = value.lower()
                elif key == "itemprop" and value.lower() == "articlebody":
                    named = "article"
                elif key in ("class", "id"):
                    for part in value.split():
                        found = {w.lower() for w in _WORD.findall(part)}
                        if not found & NOT_WORDS:
                            words |= found
        aside = aside or name in ASIDE_TAGS or bool(words & ASIDE_WORDS)
        if not aside:
            if name in ("article", "main"):
                named = name
            if named:
                rank, weak = max(rank, 3 if named == "article" else 2), False
            elif words & MAIN_WORDS and name in BLOCKS and not weak:
                rank = max(rank, 1)
            elif name in WEAK_ASIDE_TAGS and (name == "form" or rank < 2):
                weak = True
        return rank, aside, weak, silent, heading

    def read(self, page: str) -> list[list]:
        at, size = 0, len(page)
        while at < size:
            m = _TOKEN.search(page, at)
            if m is None:
                self.text(page[at:])
                break
            if m.start() > at:
                self.text(page[at:m.start()])
            at, name = m.end(), m.group(2)
            if name and page[at - 1] == ">":
                name = name.lower()
                if m.group(1):
                    self.end(name)
                elif name in RAW:
                    # the rest of the page where it is never closed
                    close = _RAW_END[name].search(page, at)
                    at = close.start() if close and name != "plaintext" else size
                else:
                    self.start(name, m.group(3))
        self.flush()
        return self.blocks


def read_blocks(page: str | None) -> list[tuple]:
    """(in_main, in_aside, heading, words, linked words, text) in page order.  Of the
    main zones the kind of highest rank counts: article, then main, then class and id."""
    found = _Reader().read(page) if page else []
    best = max((b[0] for b in found if not b[1]), default=0)
    return [(best > 0 and b[0] == best and not b[1], *b[1:]) for b in found]


def _extract_batches(batches, html: str, keep: list[str], tree: Tree):
    for batch in batches:
        for part in text_slices(batch, html):
            blocks, edges = [], [0]
            for page in part.column(html):
                blocks += read_blocks(page.as_py())
                edges.append(len(blocks))
            main = tree.predict(features([b[:5] for b in blocks], edges)) > 0.5
            texts = [" ".join(b[5] for b, m in zip(blocks[i:j], main[i:j]) if m)
                     for i, j in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), pa.array(texts, pa.string()), pa.array(np.diff(edges), pa.int32())],
                names=[*keep, "text", "n_blocks"])


def extract_text(df: DataFrame, html_col: str = "html", tree: Tree | None = None) -> DataFrame:
    """``df`` with ``text``, the main text of the page, and ``n_blocks``, its text blocks."""
    outputs = ("text", "n_blocks")
    if html_col in outputs:
        raise ValueError(f"the html column may not be named {html_col}")
    keep = [c for c in df.columns if c not in outputs]
    tree = tree or train()
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema]
    schema = ", ".join([*fields, "text string", "n_blocks int"])
    return df.select(*keep).mapInArrow(
        lambda it: giving_back(_extract_batches(it, html_col, keep, tree)), schema)
