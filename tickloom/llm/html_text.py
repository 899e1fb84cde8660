"""Main text of HTML pages: flat text blocks, classified by a decision tree over their own and their neighbours' shape."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.words import batches

# Names of HTML elements.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "textarea", "select", "title", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CHROME = frozenset("nav footer aside form button fieldset dialog menu label".split())
CLOSED_BY_BLOCK = frozenset(("p",))
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Words in class, id or role that mark furniture of a page, or its main part.
FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banner|breadcrumbs?|byline|comments?|contentinfo|complementary|consent|cookies?|copyright|disqus|"
    r"dropdown|footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|overlay|pagination|pager|popup|promo|promoted|promotion|"
    r"recommended|related|replies|reply|respond|search|share|sharing|sidebar|signup|skip|social|sponsor|sponsored|subscribe|subscription|tags|toolbar|"
    r"warning|alert|widget|widgets|toc|feedback|login|discussion|reader|readers)(?:$|[\s_-]|\d)", re.I,
)
MAIN = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text)(?:$|[\s_-]|\d)", re.I)

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[^>])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/=>]+)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]+)))?""")
# Class words of a layout that say what else is on the page, not what this element is.
_AROUND = re.compile(r"(?:^|\s)(?:has|with|no|without|is|js)[_-]\S*", re.I)
_REMARKS = re.compile(r"(?:^|[\s_-])(?:comments?|discussion|disqus|feedback|recommended|related|replies|reply|respond)(?:$|[\s_-]|\d)", re.I)
_TITLED = re.compile(r"<(?:h1|(/article))[\s/>]", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after", "in_main", "in_furniture", "heading", "listed")


@dataclass(slots=True)
class Block:
    """Text between two block borders."""

    text: str
    words: int
    link_density: float
    in_main: bool
    in_furniture: bool
    heading: bool
    listed: bool


def attributes(tag: str) -> dict[str, str]:
    """The attributes of a start tag by lower-case name; of two with one name the first counts, and one without a value is ""."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(tag):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


class _Reader:
    """One pass over a page's tags, with a stack of open elements: name, in the main part, in furniture (2: for good), heading, list, hidden."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.open: list[tuple[str, bool, int, bool, bool, bool]] = [("", False, 0, False, False, False)]
        self.parts: list[str] = []
        self.linked: list[str] = []
        self.links = self.breaks = 0

    def border(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            words = len(text.split(" "))
            _, main, furniture, heading, listed, _ = self.open[-1]
            self.blocks.append(Block(text, words, len("".join(self.linked).split()) / words, main, furniture > 0, heading, listed))
        self.parts, self.linked, self.breaks = [], [], 0

    def text(self, raw: str) -> None:
        if self.open[-1][5]:
            return
        text = html.unescape(raw)
        if self.breaks > 1 and not text.isspace():
            self.border()
        if text and not text.isspace():
            self.breaks = 0
        self.parts.append(text)
        if self.links:
            self.linked.append(f" {text} ")

    def start(self, name: str, marks: str, titled: Callable[[], bool]) -> None:
        """Open an element with the attributes in `marks`; `titled` tells whether it holds a first-level heading."""
        if name == "br":
            self.breaks += 1
            self.parts.append(" ")
            return
        if name in ("body", "html"):
            self.border()
            return
        if name not in INLINE:
            self.border()
            for other in SELF_CLOSING.get(name, ("p",)):
                self.close(other, stop=("ul", "ol", "dl", "table", "div", "section", "article", "main"))
        elif name == "a":
            self.links += 1
        if name in VOID:
            return
        _, main, furniture, heading, listed, hidden = self.open[-1]
        own = attributes(marks)
        named = _AROUND.sub(" ", f"{own.get('class', '')} {own.get('id', '')}")
        role = own.get("role", "").lower()
        hidden = hidden or "hidden" in own or own.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(own.get("style", "")))
        is_main, is_article = name == "main" or role == "main", name == "article" or role == "article"
        if furniture == 1 and (is_main or (is_article and titled())):
            furniture = 0  # a layout's class names what surrounds its main part
        if is_main or is_article or (not main and name in ("div", "section") and MAIN.search(named) and not FURNITURE.search(named)):
            main = True
        if name in CHROME or (name == "header" and not main):
            furniture = 2
        elif name not in ("article", "main") and name not in HEADINGS and (FURNITURE.search(named) or FURNITURE.search(role)):
            furniture = max(furniture, 2 if main or _REMARKS.search(named) else 1)
        self.open.append((name, main, furniture, heading or name in HEADINGS, listed or name in ("li", "td", "th", "dt", "dd"), hidden))

    def end(self, name: str) -> None:
        if name == "br":
            self.breaks += 1
            self.parts.append(" ")
        elif name == "a":
            self.links = max(0, self.links - 1)
        if name not in INLINE:
            self.border()
        self.close(name)

    def close(self, name: str, stop: tuple[str, ...] = ()) -> None:
        """Pop the open elements down to the last one called `name`, if there is one above the elements in `stop`."""
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == name:
                del self.open[k:]
                return
            if self.open[k][0] in stop:
                return


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, without comments, scripts, styles and hidden elements.

    Block elements part blocks, inline elements do not; one line break is white space and two in a row part blocks. Runs
    of white space are one space. Broken markup is read as far as it goes.
    """
    reader, at = _Reader(), 0
    while True:
        m = _TOKEN.search(page, at)
        reader.text(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            reader.end(name)
            continue
        if name in RAW:
            if not m[3].rstrip().endswith("/"):
                done = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = done.end() if done else len(page)
            if name not in ("svg", "math", "iframe"):
                reader.border() if name not in ("script", "noscript", "template") else None
            continue
        reader.start(name, m[3], lambda at=at: bool((found := _TITLED.search(page, at)) and not found[1]))
    reader.border()
    return reader.blocks


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block."""
    words = np.array([0, *(b.words for b in found), 0], float)
    density = np.array([0, *(b.link_density for b in found), 0], float)
    own = np.array([[b.in_main, b.in_furniture, b.heading, b.listed] for b in found], float).reshape(-1, 4)
    shape = [words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:]]
    return np.column_stack([*shape, own])


@dataclass
class Tree:
    """Binary decision tree: feature, threshold, left and right child of each node (feature -1: a leaf), share of text."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), int)
        while (inner := np.flatnonzero(self.feature[node] >= 0)).size:
            at = node[inner]
            node[inner] = np.where(x[inner, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.share[node] > 0.5


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2) -> Tree:
    """Tree of the splits that lower Gini impurity most, of at most `depth` levels and `least` rows in a leaf."""
    rows: list[list[float]] = []

    def gini(k: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 2 * k * (1 - k / n)

    def node(at: np.ndarray, level: int) -> int:
        me, n, k = len(rows), len(at), float(y[at].sum())
        rows.append([-1, 0, 0, 0, k / n])
        best = (1e-9, -1, 0.0)
        if level < depth and 0 < k < n:
            for f in range(x.shape[1]):
                order = at[np.argsort(x[at, f], kind="stable")]
                values = x[order, f]
                left = np.arange(1, n)
                hits = np.cumsum(y[order])[:-1]
                gain = gini(np.array([k]), np.array([n]))[0] - gini(hits, left) - gini(k - hits, n - left)
                gain[(values[1:] == values[:-1]) | (left < least) | (n - left < least)] = 0
                i = int(np.argmax(gain)) if n > 1 else 0
                if n > 1 and gain[i] > best[0]:
                    best = (float(gain[i]), f, (values[i] + values[i + 1]) / 2)
        if best[1] >= 0:
            low = x[at, best[1]] <= best[2]
            rows[me][:2] = [best[1], best[2]]
            rows[me][2] = node(at[low], level + 1)
            rows[me][3] = node(at[~low], level + 1)
        return me

    node(np.arange(len(y)), 0)
    feature, threshold, left, right, share = np.array(rows).T
    return Tree(feature.astype(int), threshold, left.astype(int), right.astype(int), share)


def labelled_pages() -> list[tuple[str, set[str]]]:
    """The small labelled table: pages put together from parts, and the texts of their blocks that are main text."""
    from tickloom.llm.html_labels import pages

    return pages()


def train(pages: list[tuple[str, set[str]]] | None = None) -> Tree:
    """Decision tree fitted to labelled pages."""
    x, y = [], []
    for page, wanted in pages or labelled_pages():
        found = blocks(page)
        x.append(features(found))
        y += [b.text in wanted for b in found]
    return grow(np.concatenate(x), np.array(y, float))


def main_text(page: str | None, tree: Tree) -> str:
    """Main-text blocks of a page, one a line."""
    found = blocks(page or "")
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, tree.predict(features(found)), strict=True) if keep)


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html).

    text is "" for a NULL or empty html and for a page without main text; n_chars counts its code points. Repeated rows give
    repeated rows, NULLs in page_id or url stay, other columns are not looked at. Pages are read one by one where they lie.
    """
    tree = tree or train()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream, "html"):
            texts = [main_text(page, tree) for page in batch.column("html").to_pylist()]
            out = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.record_batch(out, names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
