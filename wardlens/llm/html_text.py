"""Main text of web pages (operator 4): text-to-tag ratios, smoothed and clustered.

The standard library's parser streams events; block elements cut the page into lines. Each line
has a ratio of text to tags; ratios are smoothed with a Gaussian along the page and split at a
threshold between two clusters. Lines that stand in menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles or comment sections never count as content. A content region is
the nearest enclosing ``article`` or ``main`` element, else the nearest section-like element; the regions with lines
above the threshold are kept whole, so that short paragraphs inside them stay. Articles only break ties:
beside a chosen one, a region counts by lines of its own ratio, not by smoothed ones of its neighbours.

Special cases: a null, empty or tagless html gives its text or an empty one; unclosed and
misnested elements are closed with their parents; repeated pages are extracted as often as they
occur. Pages are processed one by one; nothing is cut off.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardlens.llm.common import ship_package, slices

#: Elements without content; they open nothing.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that start a line of their own.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol optgroup option p pre
    section summary table tbody td tfoot th thead title tr ul""".split())
#: Elements that never hold content.
SKIPPED = frozenset("""head title script style noscript template nav header footer aside form iframe object svg canvas
    button select textarea dialog menu map audio video datalist""".split())
#: Whole tokens of class or role that mark what isn't content; outside articles, on containers, ids and
#: compounds of nothing but marks and fillers too.
MARKS = frozenset("""ad ads advert advertisement advertising banner sponsor sponsored promo promotion nav navbar
    navigation menu sidebar side breadcrumb breadcrumbs header masthead footer cookie cookies consent notice notification
    alert popup modal overlay newsletter subscribe signup login comment comments disqus reply replies respond share
    sharing social related recommended widget toolbar pagination pager copyright legal disclaimer skip search
    complementary contentinfo dialog""".split())
#: Marks that text itself may have; inside articles they count on containers only.
AMBIGUOUS = frozenset("""side share header legal related recommended comment comments reply replies respond search skip notice
    notification alert copyright disclaimer menu promotion banner dialog""".split())
CONTAINERS = frozenset("div section ul ol dl table fieldset details".split())
FILLERS = frozenset("""site main page top bottom left right bar box container wrapper wrap inner outer block area list links
    items section content buttons global primary secondary""".split())
REGIONS = frozenset("article main".split())
SECTIONS = frozenset("body section div table".split())
#: A start tag of the first kind ends an open element of the second.
P_ENDS = BLOCKS - frozenset("html body caption option optgroup title tr td th tbody thead tfoot legend summary dt dd li".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table select article main section div body html blockquote".split())
WORDS = re.compile(r"[a-z]+")
SIGMA = 2.0


class _Lines(HTMLParser):
    """Collects lines: text, tags before its end, and the region it stands in (-1: never content)."""

    CDATA_CONTENT_ELEMENTS = ("script", "style")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int]] = []
        self.text: list[str] = []
        self.tags = 0
        self.parents = [-1]
        self.articles: set[int] = set()
        # (element, region, kind of region: 0 page, 1 section, 2 article)
        self.stack: list[tuple[str, int, int]] = [("", 0, 0)]

    def cut(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, max(1, self.tags), self.stack[-1][1]))
            self.tags = 0
        self.text = []

    def close_to(self, depth: int) -> None:
        self.cut()
        del self.stack[depth:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag == "br" or tag == "hr" or tag == "wbr":
            self.text.append("" if tag == "wbr" else " ")
            return
        if tag in VOID:
            return
        if tag in BLOCKS:
            self.cut()
            if tag in P_ENDS:
                self.end_open("p", ("p",))
            if tag in SIBLINGS:
                self.end_open(tag, SIBLINGS[tag])
        _, region, kind = self.stack[-1]
        if region >= 0:
            if tag in SKIPPED or attrs and self.marked(tag, attrs, kind == 2):
                self.cut()
                region = -1
            elif tag in REGIONS and kind < 2:
                region, kind = self.new_region(region), 2
                self.articles.add(region)
            elif tag in SECTIONS and kind < 2:
                region, kind = self.new_region(region), 1
                if tag == "body":
                    self.parents[region] = -2  # what it holds isn't one region
        self.stack.append((tag, region, kind))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def new_region(self, parent: int) -> int:
        """A region inside another one; those directly in the page or its body have no parent."""
        self.parents.append(parent if parent > 0 and self.parents[parent] != -2 else -1)
        return len(self.parents) - 1

    @staticmethod
    def marked(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
        """Whether an element, inside an article or not, never holds content."""
        if tag in ("html", "body", "article", "main"):
            return False
        container = tag in CONTAINERS
        for name, value in attrs:
            if name == "hidden":
                return True
            if not value or name not in ("class", "id", "role") or name == "id" and (inside or not container):
                continue
            for token in value.lower().split():
                if token in MARKS and (container or not inside or token not in AMBIGUOUS):
                    return True
                if container and not inside:
                    words = set(WORDS.findall(token))
                    if not words.isdisjoint(MARKS) and words <= MARKS | FILLERS:
                        return True
        return False

    def end_open(self, tag: str, ends: tuple[str, ...]) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.stack[depth][0]
            if name in ends:
                self.close_to(depth)
                return
            if name in SCOPES:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in VOID:
            return
        if tag in BLOCKS:
            self.cut()
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth][0] == tag:
                if self.stack[depth][1] != self.stack[depth - 1][1]:
                    self.cut()
                del self.stack[depth:]
                return
            if tag not in BLOCKS and self.stack[depth][0] in BLOCKS:
                return  # a stray inline end tag closes no block

    def handle_data(self, data: str) -> None:
        if self.stack[-1][1] >= 0:
            self.text.append(data)


def _smooth(ratios: np.ndarray) -> np.ndarray:
    reach = int(np.ceil(3 * SIGMA))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    sums = np.convolve(ratios, kernel)[reach:reach + len(ratios)]
    return sums / np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]


def _threshold(values: np.ndarray) -> float:
    """Middle between the means of two clusters, found by alternating assignment."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        middle = (low + high) / 2
        below, above = values[values <= middle], values[values > middle]
        if not len(above) or not len(below):
            break
        low, high = float(below.mean()), float(above.mean())
    return (low + high) / 2


def extract_text(html: str | None) -> str:
    """Main text of a page; its blocks are joined by line ends."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.cut()
    lines = [line for line in parser.lines if line[2] >= 0]
    if not lines:
        return ""
    ratios = np.array([len(text) / tags for text, tags, _ in lines], float)
    regions = np.array([region for _, _, region in lines])
    single = np.log1p(ratios)
    smooth = _smooth(single)
    threshold = _threshold(smooth)
    chosen = set(regions[smooth >= threshold].tolist())
    if marked := parser.articles & chosen:
        chosen = marked | chosen.intersection(regions[single >= threshold].tolist())

    def inside(region: int) -> bool:
        while region >= 0:
            if region in chosen:
                return True
            region = parser.parents[region]
        return False

    kept = {region for region in set(regions.tolist()) if inside(region)}
    return "\n".join(text for text, _, region in lines if region in kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    ship_package(pages.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [extract_text(html) for html in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(text) for text in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(extract, "page_id long, url string, text string, n_chars long")
