"""Main text of web pages by tag-path ratios.

1. A page is parsed leniently into blocks: text between block-level tags, with its path of tags from the
   root (class and id names of a tag count as part of it). Unclosed paragraphs and list items end where HTML ends them.
2. For each path, text length, punctuation, number of blocks and length of link texts are summed.
3. Two ratios follow: characters per block, and punctuation per block, both without link text. Along the
   page each block takes its path's ratios, which are smoothed with a Gaussian over neighbours.
4. Path ratio times smoothed ratio, fused over both features, is a block's weight; paths
   whose mean weight is above the threshold, the standard deviation of the page's weights, hold content.
5. The container of the chosen paths is the marked article that has most of their text, or else the innermost element
   with ``MOST`` of it. Headings, lists and short blocks inside the container belong to the article.
6. Marks weigh in before the threshold: text in elements that tag or name call a menu, page header, footer, aside, form, advert,
   notice or comment weighs nothing, unless the element holds the article or nearly all text. The name of a paragraph or another text element alone is a
   weak mark: its path has to reach ``NAMED`` of the mean weight of the chosen ones. On pages without such marks the ratios decide alone.

Elements are numbered with their parents, and sums over elements run once up and once down, so time and memory are in proportion to the
page however deep it nests. A page is one row, so nothing is shuffled. Null html gives the empty text. Repeated rows are extracted each for itself, other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.llm.shared import bounded

# Tags of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr img br input button select".split()
)
SILENT = frozenset("script style template noscript svg math iframe object video audio canvas select textarea button head title".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog header".split())
CONTENT_TAGS = frozenset(["article", "main"])
HEAD_TAGS = frozenset("head base basefont bgsound link meta title style script noscript noframes template".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
# Words in class, id and role names of what is not the article.
BOILERPLATE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adbox|banner|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice\w*|alert|popup|modal|overlay|newsletter|subscribe|signup|share|sharing|social|"
    r"comments?|commentlist|disqus|replies|reply|respond|reactions|sidebar\w*|related|recommend\w*|feedback|responses|talkback|guestbook|disclaimer|paywall|adsbygoogle|outbrain|taboola|menu\w*|nav|navbar|navigation|breadcrumbs?|footer|masthead|site-header|page-header|"
    r"toolbar|pagination|pager|login|legal|copyright|contentinfo|complementary|skip)(?=$|[\s_-])|(?:^|\s)(?:header|widget|search|form)(?=$|\s)",
    re.IGNORECASE,
)
# Names that say what lies elsewhere on the page, not what the element is.
_ABOUT = re.compile(r"(?:^|(?<=[\s_-]))(?:has|with|without|no|layout)[_-]\S+", re.IGNORECASE)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：·]")
# Elements that hold text rather than parts of a page.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption".split())
#: Share of the mean weight of chosen paths that a text element with such a name has to reach.
NAMED = 0.5
#: Share of the picked text that its container holds, where no element is marked as the article.
MOST = 0.8
#: An element with this share of the page's text is no part beside the article, whatever its name.
ALL_BUT = 0.97
_SPACE = re.compile(r"\s+")


@dataclass
class Element:
    parent: int
    path: int  # of the block-level elements down to here
    tag: str
    outside: bool = False  # marked by its tag
    named: bool = False  # marked by its name
    weak: bool = False  # a text element with such a name
    content: bool = False  # an article or main part


@dataclass
class Block:
    element: int
    text: list[str] = field(default_factory=list)
    links: int = 0

    def content(self) -> str:
        return _SPACE.sub(" ", "".join(self.text)).strip()


class _Pages(HTMLParser):
    """Elements and blocks of one page in order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements = [Element(-1, 0, "")]
        self.paths: dict[tuple[int, str], int] = {}
        self.open: list[tuple[str, int]] = []  # tag, element
        self.count: dict[str, int] = {}  # open elements by tag
        self.blocks: list[Block] = []
        self.current: Block | None = None
        self.silent = 0

    def _end_block(self) -> None:
        self.current = None

    def _in_content(self) -> bool:
        return any(self.count.get(t) for t in CONTENT_TAGS)

    def _marked_by_name(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
        """Whether names say that the element is not the article, and whether it is hidden."""
        if tag in ("html", "body", "main") or tag == "article" and not self._in_content():
            return False, False
        names = _ABOUT.sub(" ", " ".join(v or "" for k, v in attrs if k in ("class", "id", "role", "aria-label")))
        hidden = any(k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and v and re.search(r"display\s*:\s*none", v)) for k, v in attrs)
        return bool(names and BOILERPLATE_NAMES.search(names)), hidden

    def _end_head(self, tag: str) -> None:
        """Closes an open head that its end tag does not: at the body, and at what cannot stand in it."""
        if self.open and self.open[-1][0] == "head" and tag not in HEAD_TAGS:
            self._pop(len(self.open) - 1)
        elif tag == "body":
            self._close("head", {"body"})

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.silent:
            self._end_head(tag)
        if tag == "br":
            self._text(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self._end_block()
            return
        if tag in CLOSES_P:
            self._close("p", {"table", "td", "th", "div", "article", "section", "body", "li", "blockquote"})
        if tag == "li":
            self._close("li", {"ul", "ol", "menu"})
        elif tag in ("dt", "dd"):
            self._close("dt", {"dl"})
            self._close("dd", {"dl"})
        elif tag in ("td", "th", "tr"):
            for t in ("td", "th", *(["tr"] * (tag == "tr"))):
                self._close(t, {"table"})
        elif tag == "option":
            self._close("option", {"select"})
        if tag not in INLINE:
            self._end_block()
        names = next((v for k, v in attrs if k == "class" and v), "") or next((v for k, v in attrs if k == "id" and v), "")
        parent = self.open[-1][1] if self.open else 0
        path = self.elements[parent].path
        if tag not in INLINE:
            path = self.paths.setdefault((path, f"{tag}.{names}" if names else tag), len(self.paths) + 1)
        named, hidden = self._marked_by_name(tag, attrs)
        text = tag in TEXT_TAGS or tag in INLINE
        element = Element(
            parent, path, tag, outside=tag in BOILERPLATE_TAGS and not (tag == "header" and self._in_content()),
            named=hidden or named and not text, weak=named and text, content=tag in CONTENT_TAGS and not named and not hidden,
        )
        self.open.append((tag, len(self.elements)))
        self.elements.append(element)
        self.count[tag] = self.count.get(tag, 0) + 1
        self.silent += tag in SILENT

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, tag: str, stop: set[str]) -> None:
        if not self.count.get(tag):
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self._pop(k)
                return
            if self.open[k][0] in stop:
                return

    def _pop(self, k: int) -> None:
        for tag, _ in self.open[k:]:
            self.count[tag] -= 1
            self.silent -= tag in SILENT
            if tag not in INLINE:
                self._end_block()
        del self.open[k:]

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self._text(" ")
            return
        if not self.count.get(tag):
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self._pop(k)
                return
            # A stray end tag does not close what lies around its container.
            if self.open[k][0] in ("table", "article", "body") and tag not in ("article", "body", "html", "main"):
                return

    def handle_data(self, data: str) -> None:
        self._text(data)

    def unknown_decl(self, data: str) -> None:
        if data.startswith("CDATA["):
            self._text(data[6:])

    def _text(self, data: str) -> None:
        if self.silent and data.strip():
            self._end_head("")
        if self.silent or not data:
            return
        if self.current is None:
            if not data.strip():
                return
            self.current = Block(self.open[-1][1] if self.open else 0)
            self.blocks.append(self.current)
        self.current.text.append(data)
        if self.count.get("a"):
            self.current.links += len(data.strip())


def _smoothed(values: np.ndarray, width: float = 1.0, reach: int = 2) -> np.ndarray:
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * width**2))
    sums = np.convolve(values, kernel, "full")[reach : reach + len(values)]
    return sums / np.convolve(np.ones(len(values)), kernel, "full")[reach : reach + len(values)]


def path_weights(paths: list[int], lengths: np.ndarray, punctuation: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """The weight of each block: path ratios of length and punctuation, each times itself smoothed along the page, fused.

    ``prior`` is what marks leave of a block's ratios.
    """
    _, of = np.unique(np.array(paths), return_inverse=True)
    blocks = np.bincount(of)
    weights = np.ones(len(paths))
    for feature in (lengths, punctuation):
        ratio = (np.bincount(of, feature) / blocks)[of] * prior
        weights *= ratio * _smoothed(ratio) + 1e-9
    return np.sqrt(np.sqrt(weights))


def mean_by_path(paths: list[int], weights: np.ndarray) -> np.ndarray:
    """For each block the mean weight of its path."""
    _, of = np.unique(np.array(paths), return_inverse=True)
    return (np.bincount(of, weights) / np.bincount(of))[of]


def content_blocks(elements: list[Element], blocks: list[Block], threshold: float = 1.0) -> list[str]:
    """The texts of content blocks, in order. A path is chosen if its mean weight is above ``threshold`` times the deviation of the page's weights."""
    found = [(b, t) for b in blocks if (t := b.content())]
    if not found:
        return []
    blocks, texts = [b for b, _ in found], [t for _, t in found]
    sizes = np.array([len(t) for t in texts])
    own = np.maximum(0, sizes - np.array([b.links for b in blocks]))
    # Upwards: text of each element, and whether it holds an article or main part.
    held = [0] * len(elements)
    for b, size in zip(blocks, own.tolist(), strict=True):
        held[b.element] += size
    holds = [e.content for e in elements]
    for k in range(len(elements) - 1, 0, -1):
        held[elements[k].parent] += held[k]
        holds[elements[k].parent] |= holds[k]
    # Downwards: whether an element is part of one that is marked and not around the article.
    within_content = [False] * len(elements)
    outside, weak = [False] * len(elements), [False] * len(elements)
    for k, e in enumerate(elements[1:], 1):
        around = holds[k] and not e.content or held[k] >= ALL_BUT * held[0]
        outside[k] = outside[e.parent] or (e.outside and not (around and not within_content[e.parent])) or (e.named and not around)
        weak[k] = weak[e.parent] or e.weak
        within_content[k] = within_content[e.parent] or e.content
    inside = np.array([not outside[b.element] for b in blocks])
    paths = [elements[b.element].path for b in blocks]
    marks = np.array([len(_PUNCTUATION.findall(t)) for t in texts]) * own / sizes
    weights = path_weights(paths, own, marks, inside)
    heavy = mean_by_path(paths, weights)
    picked = inside & (heavy > threshold * weights.std())
    if not picked.any():
        return []
    # A text element's name alone counts for little: its path has to weigh enough beside the others.
    unnamed = np.array([not weak[b.element] for b in blocks])
    usual = heavy[picked & unnamed].mean() if (picked & unnamed).any() else 0.0
    fits = inside & (unnamed | (heavy >= NAMED * usual))
    container = _container(elements, blocks, sizes, picked & fits, fits)
    under = [False] * len(elements)
    for k, e in enumerate(elements):
        under[k] = k == container or k > 0 and under[e.parent]
    return [t for b, t, fit in zip(blocks, texts, fits.tolist(), strict=True) if fit and under[b.element]]


def _container(elements: list[Element], blocks: list[Block], sizes: np.ndarray, picked: np.ndarray, fits: np.ndarray) -> int:
    """The element that holds the content: the marked article or main part with most picked text (or, with none, most text that fits), else the innermost
    element with most of the picked text."""

    level = [0] * len(elements)  # the block-level element that each lies in
    for k, e in enumerate(elements[1:], 1):
        level[k] = level[e.parent] if e.tag in INLINE else k

    def held_by(chosen: np.ndarray) -> tuple[list[int], set[int]]:
        held, leaf = [0] * len(elements), set()
        for k in np.flatnonzero(chosen).tolist():
            at = level[blocks[k].element]
            held[at] += int(sizes[k])
            leaf.add(at)
        for k in range(len(elements) - 1, 0, -1):
            held[elements[k].parent] += held[k]
        return held, leaf

    held, leaf = held_by(picked)
    fitting, _ = held_by(fits)
    marked = [k for k, e in enumerate(elements) if e.tag in CONTENT_TAGS and fitting[k]]
    if marked:
        return max(marked, key=lambda k: (elements[k].tag == "article", held[k], fitting[k], -k))
    most = [k for k, size in enumerate(held) if size >= MOST * held[0] and elements[k].tag not in INLINE]
    # A lone paragraph is no container: the element around it is.
    return max((k for k in most if k not in leaf), default=max(most, default=0))


def main_text(page: str) -> str:
    parser = _Pages()
    parser.feed(page)
    parser.close()
    return "\n\n".join(content_blocks(parser.elements, parser.blocks))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first in range(0, rows.num_rows, 128):
                part = rows.slice(first, 128)
                texts = [main_text(p or "") for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    columns = [F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")]
    return bounded(pages).select(*columns).mapInArrow(extract, "page_id long, url string, text string, n_chars long")
