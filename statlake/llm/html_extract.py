"""Main text of web pages: flat text blocks, shallow features of neighbours, a trained decision tree."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import ship, slices

#: Elements inside a block; every other element ends it. A line break is white space inside a block.
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements without text of their own.
_RAW = frozenset("script style noscript template title textarea select option svg math iframe object canvas audio video head".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements, roles and words of class and id that mark what is not the article, and what is.
_AWAY = frozenset("nav aside footer header form menu dialog button fieldset".split())
_AWAY_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar tablist".split())
_AWAY_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot banner breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright "
    "disclaimer disqus dropdown feedback footer form header login masthead menu modal nav navbar navigation newsletter notice notification "
    "pager pagination paywall popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup skip "
    "social sponsor sponsored subscribe subscription tags teaser toolbar topbar widget widgets".split()
)
#: Those of them that mark lists whose members are articles, too.
_LISTS = frozenset("comment comments commentlist disqus promo promoted recommended related replies reply respond sponsored teaser".split())
#: Before a word of a class, these say what the page has, not what the element is.
_STATES = frozenset("has have hide hides no not show shows with without".split())
_WHOLE = frozenset(["html", "body"])
_HERE = frozenset(["article", "main"])
_HERE_WORDS = frozenset("article articlebody content entry main post story".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I | re.S)
_PARTS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "away", "here", "heading", "item")


@dataclass
class Block:
    text: str
    words: int
    links: float
    away: int
    here: int
    heading: int
    item: int


def _class_words(value: str) -> tuple[set[str], set[str]]:
    """The words of a class or id, and those that are a name of their own; none after a word of state."""
    words, alone = set(), set()
    for name in value.split():
        parts = _PARTS.findall(_CAMEL.sub(r"\1 \2", name).lower())
        state = next((i for i, part in enumerate(parts) if part in _STATES), len(parts))
        words.update(parts[:state])
        if len(parts) == 1:
            alone.update(parts[:state])
    return words, alone


def _marks(name: str, rest: str) -> tuple[bool, bool, bool]:
    """Whether an element is marked as away from the article, as away by a class that may be its layout's, and as the article."""
    away, soft, here = name in _AWAY, False, name in _HERE
    if "=" in rest or "hidden" in rest.lower():
        for key, *values in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), "".join(values)
            low = value.lower()
            if key == "role":
                away, here = away or low in _AWAY_ROLES, here or low in _HERE
            elif key == "hidden" or key == "aria-hidden" and low == "true" or key == "style" and re.search(r"display\s*:\s*none", low):
                away = True
            elif key in ("class", "id") and name not in _WHOLE:
                words, alone = _class_words(value)
                if name in _HERE:
                    # a compound says what an article is in or about
                    away = away or bool(alone & _AWAY_WORDS)
                else:
                    away, soft = away or bool(words & _LISTS), soft or bool(words & _AWAY_WORDS)
                    here = here or bool(words & _HERE_WORDS)
    return away, soft, here and not away and not soft


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order; unclosed and stray tags and a cut end are tolerated.

    Blocks within an element that a class marks as away are away, unless that would leave less of the
    page than the article in it has: if no article or main is outside of such elements, those around
    the least enclosed ones are a layout, and their marks are lifted.
    """
    out: list[Block] = []
    none: frozenset[int] = frozenset()
    open_: list[tuple[str, int, int, frozenset[int]]] = []  # element; away, here and class marks of it and what it is in
    marks: list[tuple[int, frozenset[int]]] = []  # away and class marks of each block
    inside: list[frozenset[int]] = []  # the class marks around each article
    free = False
    pieces: list[str] = []
    linked: list[str] = []
    in_link = False
    state = (0, 0, none)

    def flush() -> None:
        nonlocal pieces, linked
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            n = len(text.split())
            links = len(html.unescape("".join(linked)).split())
            names = [x[0] for x in open_]
            marks.append((state[0], state[2]))
            out.append(Block(text, n, min(1.0, links / n), int(state[0] or bool(state[2])), state[1], int(bool(_HEADINGS & set(names))), int("li" in names)))
        pieces, linked = [], []

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        piece = page[at : m.start() if m else size]
        pieces.append(piece)
        if in_link:
            linked.append(piece)
        if not m:
            break
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in _RAW and not m["end"]:
            if not m["rest"].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}(?![^\s/>])[^>]*(?:>|\Z)|(?=<body\b)" if name == "head" else rf"</{re.escape(name)}(?![^\s/>])[^>]*(?:>|\Z)", re.I)
                found = close.search(page, at)
                at = found.end() if found else size
            continue
        if name == "br":
            pieces.append(" ")
        if name in _INLINE:
            if name == "a":
                in_link = not m["end"]
                if in_link:
                    linked.append(" ")
            away, soft, here = _marks(name, m["rest"]) if m["rest"] and not m["end"] else (False, False, False)
            if not (away or soft) or name in _VOID:
                continue
        flush()
        in_link = False
        if m["end"]:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    del open_[i:]
                    break
        elif name not in _VOID and not m["rest"].endswith("/"):
            if name in ("p", "li") and open_ and open_[-1][0] == name:
                open_.pop()
            away, soft, here = _marks(name, m["rest"])
            above = open_[-1][1:] if open_ else (0, 0, none)
            if here and not above[0]:
                free = free or name in _HERE and not above[2]
                inside.append(above[2])
            open_.append((name, int(away or above[0]), int(here or above[1]), above[2] | {at} if soft else above[2]))
        state = open_[-1][1:] if open_ else (0, 0, none)
    flush()
    around = [x for x in inside if x]
    if around and not free:
        fewest = min(map(len, around))
        layout = none.union(*(x for x in around if len(x) == fewest))
        lifted = [b for b, (firm, soft) in zip(out, marks, strict=True) if soft and soft <= layout and not firm]
        if sum(b.words for b in lifted) > sum(b.words for b in out if not b.away):
            for b in lifted:
                b.away = 0
    return out


def table(found: list[Block]) -> np.ndarray:
    """The blocks' features, those of the neighbours included."""
    own = np.array([[b.words, b.links] for b in found], float).reshape(-1, 2)
    edge = np.zeros((1, 2))
    rest = np.array([[b.away, b.here, b.heading, b.item] for b in found], float).reshape(-1, 4)
    return np.hstack([own, np.vstack([edge, own[:-1]])[: len(own)], np.vstack([own[1:], edge])[: len(own)], rest])


#: The labelled pages: +n and -n stand for n words of main text and of something else.
LABELLED_PAGES = (
    "<body><header><h1>-3</h1><p>-9</p></header><nav><ul><li><a>-1</a></li><li><a>-2</a></li></ul></nav><article><h1>+7</h1><p>+60</p><p>+3</p><p>+1</p><p>+25</p></article><footer>-12</footer></body>",
    "<body><nav><a>-1</a><a>-1</a></nav><div class='ad'>-10</div><main><h1>+1</h1><p>+2</p><p>+45</p><h2>+4</h2><p>+120</p></main><aside><p>-40</p><p>-30</p></aside><footer>-25</footer></body>",
    "<body><div id='cookie-notice'>-30</div><div class='menu'><a>-2</a></div><div class='content'><h1>+9</h1><p>+80</p><ul><li>+6</li><li>+12</li></ul><div class='share'><a>-1</a><a>-1</a></div><p>+33</p></div><section id='comments'><p>-25</p><p>-60</p></section></body>",
    "<body><div><a>-2</a> <a>-1</a> <a>-3</a></div><div><h1>+8</h1><p>+70</p><p>+55</p><p>+14</p><p>+42</p></div><div><a>-4</a></div><div>-6</div><div><a>-2</a> -1</div></body>",
    "<body><form><p>-20</p></form><p>-3</p><p><a>-5</a></p><h1>+6</h1><p>+90</p><p>+22</p><p>+75</p><p>-4</p><p><a>-3</a></p></body>",
    "<body><article><header><p>-6</p></header><p>+1</p><p>+5</p><p>+12</p><p><a>+3</a></p><aside>-50</aside><div class='advert'>-35</div><p>+18</p><footer>-8</footer></article></body>",
    "<body><article><h1>+2</h1><p>+150</p><p>+1</p></article><div class='related'><h2>-2</h2><ul><li><a>-8</a></li><li><a>-11</a></li></ul></div><div class='newsletter'><p>-45</p></div></body>",
    "<body><ul><li><a>-1</a></li><li><a>-1</a></li><li>-2</li></ul><p>+50</p><p>+16</p><p>+65</p><ul><li><a>-6</a></li><li><a>-7</a></li></ul><p>-7</p></body>",
    "<body class='single has-sidebar'><div id='page' class='no-sidebar'><ul><li><a>-2</a></li><li><a>-3</a></li></ul><main class='site-content with-nav'><article class='post search-result'><h1>+6</h1><p>+70</p><p>+2</p><p>+40</p></article></main><div class='sidebar'><p>-30</p></div></div></body>",
    "<body class='search'><div class='sidebar-layout'><div><a>-2</a> <a>-1</a></div><article><h2>+5</h2><p>+110</p><p>+15</p><div class='share-bar'><a>-1</a></div></article><div id='comments'><article class='comment-body'><p>-35</p></article></div></div></body>",
)


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """The labelled table: features and labels of the blocks of LABELLED_PAGES."""
    features, labels = [], []
    for page in LABELLED_PAGES:
        marks = [re.findall(r"[+-]\d+", b.text) for b in blocks(page)]
        grown = re.sub(r"([+-])(\d+)", lambda m: " ".join(["w"] * int(m[2])), page)
        features.append(table(blocks(grown)))
        labels += [int(m[0][0] == "+") for m in marks]
    return np.vstack(features), np.array(labels)


@dataclass
class Tree:
    """A node asks whether a feature is at most a bound; a leaf has a share of main text."""

    share: float
    feature: int = -1
    bound: float = 0.0
    sides: list = field(default_factory=list)

    def predict(self, rows: np.ndarray) -> np.ndarray:
        if not self.sides:
            return np.full(len(rows), self.share)
        out = np.empty(len(rows))
        low = rows[:, self.feature] <= self.bound
        out[low], out[~low] = self.sides[0].predict(rows[low]), self.sides[1].predict(rows[~low])
        return out


def fit_tree(rows: np.ndarray, labels: np.ndarray, depth: int = 8, least: int = 1) -> Tree:
    """Binary splits by least Gini impurity; ties go to the first feature and lowest bound."""
    node = Tree(float(labels.mean()))
    if depth == 0 or len(labels) < 2 * least or node.share in (0.0, 1.0):
        return node
    impurity = lambda y: len(y) * y.mean() * (1 - y.mean()) if len(y) else 0.0
    best = (impurity(labels) - 1e-9, None)
    for f in (6, 7, *range(6), 8, 9):
        values = np.unique(rows[:, f])
        for bound in (values[:-1] + values[1:]) / 2:
            low = rows[:, f] <= bound
            if min(low.sum(), (~low).sum()) >= least:
                cost = impurity(labels[low]) + impurity(labels[~low])
                if cost < best[0] - 1e-9:
                    best = (cost, (f, bound, low))
    if best[1] is None:
        return node
    node.feature, node.bound, low = best[1]
    node.sides = [fit_tree(rows[s], labels[s], depth - 1, least) for s in (low, ~low)]
    return node


@lru_cache(maxsize=1)
def trained_tree() -> Tree:
    return fit_tree(*labelled_blocks())


def main_text(page: str | None, tree: Tree | None = None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    keep = (tree or trained_tree()).predict(table(found)) >= 0.5
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def _extracted(batches: Iterable[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html"):
        texts = [main_text(page, tree) for page in batch.column("html").to_pylist()]
        lengths = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), lengths], names=["page_id", "url", "text", "n_chars"]
        )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """The main text of pages (page_id, url, html): page_id, url, text, n_chars, one row for each row.

    A page is cut into flat text blocks at all but inline elements; script, style and other raw
    elements, comments and tags have no text. Character references are decoded, white space becomes
    one space, and the blocks that the tree takes as main text are joined by a line feed. The tree
    (trained on LABELLED_PAGES) sees a block's words and share of linked words, those of the blocks
    before and after it, and whether it is within an element marked as the article or as away from it.

    A null or empty page, or one without main text, has the empty text. Nulls in page_id and url are
    kept, repeated rows are extracted each, and other columns are ignored. Nothing is shuffled.
    """
    ship(pages.sparkSession)
    tree = trained_tree()
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(lambda it: _extracted(it, tree), "page_id long, url string, text string, n_chars long")
