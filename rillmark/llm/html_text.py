"""Main text of web pages by smoothed text-to-tag ratios.

Parser events give a line per block of the page, with its characters of text, its tags and the elements around it.
The ratios of text to tags are smoothed with a Gaussian along the page and parted into two clusters by a threshold.
The region is the element that holds the lines of the upper cluster: from the body downward as long as one child
holds most of them; an article or main element with text wins at any share. All lines of the region count, short ones
too, except those in menus, forms, notices, adverts and the like, which never count. A form, or a name in parts such as
"layout-sidebar", tells nothing if the element is around the page's own frame: a header, a menu, a footer or the like; a
name of its own, such as "overlay", only if the page's title, main element, sidebar or comments are in it. How much text
an element holds tells nothing. All steps are linear in the page.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import map_batches, text_or_empty

#: Elements without content, elements that make a block, elements that are no article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
NO_TEXT = frozenset("button canvas datalist head iframe math noscript object script select style svg template textarea title".split())
OUTSIDE = frozenset("aside dialog footer form menu nav".split())
OUTSIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status".split())
OUTSIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies disclaimer discussion disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices "
    "notification overlay pagination popup promo promotion recommended related replies reply respond responses share sharing sidebar "
    "signup skyscraper social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
FRAME_NAMES = frozenset("masthead sidebar".split())
COMMENT_NAMES = frozenset("comment comments commentlist discussion disqus replies reply respond responses".split())
#: Words of names that tell what is around or not: has-sidebar, no-comments, with-ads. Last words that tell a state: share-enabled.
ABOUT = frozenset("has have no non with without".split())
STATES = frozenset("allowed closed disabled enabled hidden off on open shown".split())
#: What marks an element as outside: readers' comments, its kind for good, a name of its own, a name in parts or a form.
COMMENTS, FIRM, NAMED, LOOSE = range(4)
#: Elements of a page's own frame: what holds one is around the page, not a part of it. A name of its own is only overruled by the latter.
FRAME = frozenset("article aside footer header nav".split())
HEART = frozenset("h1 main".split())
CONTAINERS = frozenset("article body center div main section table tbody td".split())
#: Elements that an opening block closes if they are still open.
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
NAME = re.compile(r"[a-z]+")


@dataclass
class Line:
    text: str
    tags: int
    #: the innermost container, and the innermost element around it that is marked as outside; 0 for none
    region: int
    mark: int


@dataclass
class Open:
    """An open element, with what holds inside it, so that nothing has to walk up the stack."""

    tag: str
    region: int
    hidden: bool
    mark: int
    #: within an article; within an article or main
    article: bool
    content: bool
    #: places in the stack of the innermost paragraph or heading that a block closes, and of the innermost block; -1 for none
    para: int
    block: int


class PageLines(HTMLParser):
    """Collects the lines of a page from parser events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open = [Open("", 0, False, 0, False, False, -1, -1)]
        self.places: dict[str, list[int]] = {}
        #: by number of container: tag, the container around it, and whether an article is around it
        self.kinds, self.parents, self.inner = ["page"], [0], [False]
        #: by number of mark: kind, the mark around it, and whether it is around the page's frame
        self.marks: list[int] = [FIRM]
        self.around: list[int] = [0]
        self.frames: list[bool] = [False]
        #: places in the stack of loosely marked and of named elements that hold no part of the frame yet
        self.loose: list[int] = []
        self.named: list[int] = []
        self.frame_named = False
        self.parts: list[str] = []
        self.tags = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            top = self.open[-1]
            self.lines.append(Line(text, self.tags, top.region, top.mark))
            self.tags = 0
        self.parts.clear()

    def kind(self, tag: str, attrs: list[tuple[str, str | None]], content: bool) -> int | None:
        """How the element is marked as outside, if it is."""
        if tag in OUTSIDE or tag == "header" and not content:
            return LOOSE if tag == "form" else FIRM
        if tag in ("html", "body", "article", "main"):
            return None
        found = set()
        for name, value in attrs:
            value = (value or "").lower()
            for token in value.split() if name in ("class", "id") else ():
                words = NAME.findall(token)
                if not OUTSIDE_NAMES.isdisjoint(words) and ABOUT.isdisjoint(words) and words[-1] not in STATES:
                    whole = OUTSIDE_NAMES.issuperset(words)
                    self.frame_named |= not FRAME_NAMES.isdisjoint(words)
                    found.add(COMMENTS if not COMMENT_NAMES.isdisjoint(words) else NAMED if whole else LOOSE)
            if name == "role" and value in OUTSIDE_ROLES or name == "hidden":
                found.add(FIRM)
            if name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
                found.add(FIRM)
        return min(found, default=None)

    def marked(self, kind: int, around: int) -> int:
        self.marks.append(kind)
        self.around.append(around)
        self.frames.append(False)
        return len(self.marks) - 1

    def frame_found(self, waiting: list[int]) -> None:
        """All of these elements that are open are around the page's frame; each is told so once."""
        for k in waiting:
            self.frames[self.open[k].mark] = True
        waiting.clear()

    def pop_to(self, place: int) -> None:
        for gone in self.open[place:]:
            self.places[gone.tag].pop()
        for waiting in (self.loose, self.named):
            while waiting and waiting[-1] >= place:
                waiting.pop()
        del self.open[place:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
            # an open inline element doesn't keep a paragraph from being closed
            while self.open[-1].para >= 0:
                self.pop_to(self.open[-1].para)
        elif tag in ("br", "td", "th"):
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        up, place = self.open[-1], len(self.open)
        if tag in FRAME:
            self.frame_found(self.loose)
        elif tag in HEART:
            self.frame_found(self.loose)
            self.frame_found(self.named)
        region, mark = up.region, up.mark
        if tag in CONTAINERS:
            region = len(self.kinds)
            self.kinds.append(tag)
            self.parents.append(up.region)
            self.inner.append(up.article)
        if tag in ("article", "main") and mark and not up.article and self.marks[mark] == LOOSE:
            # it starts afresh; in a menu, an aside or the like it may be a teaser
            mark = 0
        self.frame_named = False
        if (kind := self.kind(tag, attrs, up.content)) is not None:
            if kind == COMMENTS or self.frame_named:
                self.frame_found(self.loose)
                self.frame_found(self.named)
            mark = self.marked(kind, mark)
            if kind in (NAMED, LOOSE):
                (self.loose if kind == LOOSE else self.named).append(place)
        para = place if tag in CLOSED_BY_BLOCK else -1 if tag in BLOCKS or tag in CONTAINERS else up.para
        self.open.append(
            Open(tag, region, up.hidden or tag in NO_TEXT, mark, up.article or tag == "article", up.content or tag in ("article", "main"),
                 para, place if tag in BLOCKS else up.block)
        )
        self.places.setdefault(tag, []).append(place)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # only void elements close themselves
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        places = self.places.get(tag)
        # an inline element isn't closed across a block
        if places and (tag in BLOCKS or places[-1] > self.open[-1].block):
            self.pop_to(places[-1])

    def handle_data(self, data: str) -> None:
        if not self.open[-1].hidden:
            self.parts.append(data)

    def outside(self) -> list[bool]:
        """For each mark whether text within it is outside: it, or a mark around it, tells so."""
        out = [False]
        for k in range(1, len(self.marks)):
            out.append(out[self.around[k]] or self.marks[k] < NAMED or not self.frames[k])
        return out


def read_page(html: str) -> PageLines:
    parser = PageLines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    return parser


def smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    """A Gaussian mean along the page; at the ends over what is there."""
    reach = max(1, int(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(values, weights)[reach:-reach] / np.convolve(np.ones(len(values)), weights)[reach:-reach]


def threshold(values: np.ndarray) -> float:
    """The border between two clusters: halfway between their means, moved until it stays."""
    border = float(values.mean())
    for _ in range(100):
        upper = values >= border
        if upper.all() or not upper.any():
            return border
        moved = float(values[upper].mean() + values[~upper].mean()) / 2
        if abs(moved - border) < 1e-9:
            break
        border = moved
    return border


def within(parents: list[int], of: list[int]) -> list[int]:
    """Sums over each container and all in it; inner ones have larger numbers."""
    total = list(of)
    for k in range(len(total) - 1, 0, -1):
        total[parents[k]] += total[k]
    return total


def main_text(html: str, sigma: float = 1.5, most: float = 0.6) -> str:
    """The article's blocks in page order, joined by line ends; empty if there is none."""
    page = read_page(html)
    lines = page.lines
    if not lines:
        return ""
    ratios = smoothed(np.array([len(x.text) / (x.tags + 1) for x in lines]), sigma)
    upper = ratios >= threshold(ratios)
    marks = page.outside()
    outside = [marks[x.mark] for x in lines]
    if all(outside):
        return ""
    own: list[list[int]] = [[0] * len(page.kinds) for _ in range(2)]
    for x, o, u in zip(lines, outside, upper):
        if not o:
            own[0][x.region] += len(x.text) * bool(u)
            own[1][x.region] += len(x.text)
    mass, whole = within(page.parents, own[0]), within(page.parents, own[1])
    if not mass[0]:
        mass = whole
    region = article_of(page, whole)
    if not region:
        children: dict[int, list[int]] = {}
        for k in range(1, len(page.kinds)):
            if mass[k]:
                children.setdefault(page.parents[k], []).append(k)
        while inner := [k for k in children.get(region, ()) if mass[k] >= most * mass[region]]:
            region = inner[0]
    inside = [k == region for k in range(len(page.kinds))]
    for k in range(1, len(inside)):
        inside[k] = inside[k] or inside[page.parents[k]]
    return "\n".join(x.text for x, o in zip(lines, outside) if not o and (not region or inside[x.region]))


def article_of(page: PageLines, whole: list[int]) -> int:
    """The article with most of the text of all outermost articles, else the main element with most text; 0 if there is none."""
    articles = [k for k, tag in enumerate(page.kinds) if tag == "article" and whole[k] and not page.inner[k]]
    best = max(articles, key=lambda k: (whole[k], -k), default=0)
    mains = [k for k, tag in enumerate(page.kinds) if tag == "main" and whole[k]]
    main = max(mains, key=lambda k: (whole[k], -k), default=0)
    if best and (not main or 2 * whole[best] >= sum(whole[k] for k in articles)):
        return best
    return main


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    sigma: float = 1.5,
    most: float = 0.6,
) -> DataFrame:
    """One row per page: ``id_col, url, text, n_chars``.

    * Null and empty pages, and pages without article text, have an empty text. Pages may be of any length; no line
      of the region is dropped, however short.
    * Broken markup is read as far as it goes: open elements end with the page.
    * Repeated rows and null ids give a row each. Other columns are ignored. An empty table gives an empty result.
    """
    id_type = pages.schema[id_col].dataType.simpleString()

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(t.as_py(), sigma, most) for t in batch.column(2)]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=[id_col, "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col), F.col(url_col).cast("string"), text_or_empty(html_col))
    return map_batches(rows, read, f"`{id_col}` {id_type}, url string, text string, n_chars bigint")
