"""Main text of web pages from streaming parser events and the text-to-tag ratio of lines.

Parser events are cut into lines, one per block of the page. Each line has the
ratio of its characters to its tags; ratios are smoothed with a Gaussian and
lines above a threshold form clusters. The regions (article, main) with
clustered text are the content, with those around and in them; their lines
outside menus, adverts, forms and the like are kept. Inside a region a class
or id that merely contains such a word decides nothing by itself: its block
stays if it is as dense in text as the threshold asks and mostly no link text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, strings

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head title script style noscript template iframe object svg math canvas audio video select textarea button".split())
CHROME = frozenset("nav aside footer form menu dialog fieldset".split())
LEFT_OPEN = frozenset("nav form menu header".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
# words of class and id attributes that mark what is not content
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs footer comment "
    "comments commentlist disqus reply replies reader-comments share sharing social related recommended newsletter subscribe "
    "subscription signup login popup modal overlay widget toolbar pagination pager skip".split())
COMMENTS = frozenset("comment comments commentlist disqus reply replies".split())
# elements that hold content whatever they are named
SHOWN = frozenset("figure figcaption blockquote table pre".split())
TEASERS = frozenset("teaser teasers".split())  # the same, of an article beside others
HEADS = frozenset("header masthead topbar head".split())
SPLIT = re.compile(r"[\s_-]+")
# an element that ends when a like one begins
REOPENS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr", "td": "td th", "th": "td th", "option": "option"}
SCOPES = frozenset("article aside blockquote body div fieldset figure footer form header html main nav ol section table ul dl".split())
RADIUS = 2
SIGMA = 1.0
SHARE = 0.5  # of the standard deviation of smoothed ratios: the threshold


@dataclass(slots=True)
class Line:
    """One block: its text, its tags, how much of it is link text, where it stands, and whether it is chrome."""

    text: str
    tags: int
    linked: int
    region: int
    parent: int
    chrome: bool
    links: int
    suspect: int


@dataclass(slots=True)
class Element:
    tag: str
    number: int
    chrome: bool
    silent: bool
    region: int
    suspect: int


class Events(HTMLParser):
    """Collects the lines of a page while its events stream by."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[Element] = []
        self.lines: list[Line] = []
        self.regions: dict[int, tuple[int, bool]] = {}  # the region around, and whether marked as comment, teaser or the like
        self.pieces: list[str] = []
        self.tags = self.linked = self.links = self.made = self.anchors = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
            if tag in ("article", "main"):  # content is never inside chrome left open
                root = next((depth for depth, e in enumerate(self.stack) if e.chrome), None)
                if root is not None and self.stack[root].tag in LEFT_OPEN:
                    self.drop(root)
            self.close_within("p")
        elif tag in ("br", "td", "th", "img"):
            self.pieces.append(" ")
        for other in REOPENS.get(tag, "").split():
            self.close_within(other)
        self.tags += 1
        if tag in VOID:
            return
        self.links += tag == "a"
        self.anchors += tag == "a"
        self.made += 1
        above = self.stack[-1] if self.stack else None
        region = self.made if tag in ("article", "main") else above.region if above else 0
        if region == self.made:
            self.regions[region] = (above.region if above else 0, bool(self.words(attrs) & (MARKS | TEASERS)))
        inherits = above is not None and above.chrome
        chrome = inherits or self.is_chrome(tag, attrs, region)
        # chrome inside a line is left out of it
        silent = (above is not None and above.silent) or tag in SILENT or chrome and not inherits and tag not in BLOCKS
        suspect = above.suspect if above else 0
        if not suspect and region and not chrome and tag not in ("article", "main") and self.words(attrs) & MARKS:
            suspect = self.made
        self.stack.append(Element(tag, self.made, chrome, silent, region, suspect))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.tags += 1
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth].tag == tag:
                self.drop(depth)
                return
            if tag not in SCOPES and self.stack[depth].tag in SCOPES:
                return

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1].silent:
            return
        self.pieces.append(data)
        if self.links:
            self.linked += len(data)

    def close(self) -> None:
        super().close()
        self.end_line()

    def close_within(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth].tag == tag:
                self.end_line()
                self.drop(depth)
                return
            if self.stack[depth].tag in SCOPES:
                return

    def drop(self, depth: int) -> None:
        for element in self.stack[depth:]:
            self.links -= element.tag == "a"
        del self.stack[depth:]

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not needed

    def end_line(self) -> None:
        if not self.pieces:
            return
        text = " ".join("".join(self.pieces).split())
        if text:
            block = next((e for e in reversed(self.stack) if e.tag in BLOCKS), None)
            outer = next((e for e in reversed(self.stack) if e.tag in SCOPES), None)
            chrome = block is not None and self.stack[-1].chrome
            self.lines.append(Line(text, self.tags, self.linked, block.region if block else 0, outer.number if outer else 0, chrome,
                                   self.anchors, self.stack[-1].suspect if self.stack else 0))
            self.tags = 0
        self.pieces, self.linked, self.anchors = [], 0, self.links

    @staticmethod
    def words(attrs: list[tuple[str, str | None]]) -> set[str]:
        """The words of class and id."""
        return {word for name, value in attrs if name in ("class", "id") and value for word in SPLIT.split(value.lower())}

    @staticmethod
    def is_chrome(tag: str, attrs: list[tuple[str, str | None]], region: int) -> bool:
        if tag in CHROME or tag == "header" and not region:
            return True
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "role" and value in ROLES:
                return True
            if name in ("class", "id") and value and tag not in ("article", "main", "body", "html"):
                words = set(SPLIT.split(value.lower()))
                if not region and words & (MARKS | HEADS) or words & COMMENTS:
                    return True
                # inside a region only a whole name says so
                if not MARKS.isdisjoint(value.lower().split()) and tag not in SHOWN:
                    return True
        return False


def smoothed(ratios: np.ndarray, radius: int = RADIUS, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian means of neighbouring ratios; the ends use the neighbours they have."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    both = np.zeros(2 * len(ratios) + 2 * radius)  # ratios, a gap, and ones for the weights
    both[:len(ratios)], both[len(ratios) + 2 * radius:] = ratios, 1.0
    sums = np.convolve(both, kernel)[radius:len(both) + radius]
    return sums[:len(ratios)] / sums[len(ratios) + 2 * radius:]


def content_regions(weight: dict[int, int], regions: dict[int, tuple[int, bool]]) -> set[int]:
    """The regions with clustered text and all around or in them, but of marked ones only the heaviest of the page."""
    heaviest = max(weight, key=lambda r: (weight[r], -r))
    # regions are numbered in page order, so the one around comes first
    barred: dict[int, bool] = {0: False}
    inside: dict[int, bool] = {0: False}
    for region, (above, marked) in sorted(regions.items()):
        barred[region] = region != heaviest and (marked or barred[above])
        inside[region] = not barred[region] and (region in weight or inside[above])
    kept = {region for region, chosen in inside.items() if chosen}
    for region in sorted(kept):
        above = regions[region][0]
        while above and above not in kept:
            kept.add(above)
            above = regions[above][0]
    return kept


def is_link_row(line: Line, threshold: float) -> bool:
    """Whether a line is a menu without a mark: three links or more, nearly all of its text, and a ratio below the threshold."""
    return line.links >= 3 and 5 * line.linked >= 4 * len(line.text) and (len(line.text) - line.linked) / max(1, line.tags) < threshold


def sparse_blocks(lines: list[Line], threshold: float) -> set[int]:
    """The suspect blocks below the threshold or mostly of link text."""
    sums: dict[int, list[int]] = {}
    for line in lines:
        if line.suspect:
            found = sums.setdefault(line.suspect, [0, 0, 0])
            for k, value in enumerate((len(line.text), line.linked, line.tags)):
                found[k] += value
    return {block for block, (size, linked, tags) in sums.items() if 2 * linked > size or (size - linked) / max(1, tags) < threshold}


def content_lines(lines: list[Line], regions: dict[int, tuple[int, bool]]) -> list[Line]:
    """The lines of the content regions, in page order."""
    own = [line for line in lines if not line.chrome]
    if not own:
        return []
    ratios = np.array([0.0 if line.chrome else (len(line.text) - line.linked) / max(1, line.tags) for line in lines])
    smooth = smoothed(ratios)
    threshold = max(SHARE * float(smooth.std()), 1e-9)
    dense = smooth >= threshold
    weight: dict[int, int] = {}
    for line, chosen in zip(lines, dense):
        if chosen and not line.chrome:
            weight[line.region] = weight.get(line.region, 0) + len(line.text) - line.linked
    named = {region: w for region, w in weight.items() if region}
    if named:
        content = content_regions(named, regions)
        sparse = sparse_blocks(own, threshold)
        return [line for line in own if line.region in content and line.suspect not in sparse and not is_link_row(line, threshold)]
    # without article or main: clustered lines, and their neighbours in the same container that are not link lists
    parents = {line.parent for line, chosen in zip(lines, dense) if chosen and not line.chrome}
    return [line for line, chosen in zip(lines, dense) if not line.chrome and (
        chosen or line.parent in parents) and line.linked <= len(line.text) / 2]


def main_text(html: str) -> str:
    """Text of the content blocks joined by newlines; empty for a page without."""
    events = Events()
    events.feed(html)
    events.close()
    return "\n".join(line.text for line in content_lines(events.lines, events.regions))


def extract(html: str | Column) -> Column:
    """Main text of an HTML column; null counts as empty."""

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(h) for h in strings(batch)], pa.string())

    return of(html)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: ``page_id, url, text, n_chars``.

    Null or empty pages have an empty text. Repeated and null ids keep their
    rows; further columns are ignored; no rows give no rows.
    """
    bound_batches(pages.sparkSession)
    return pages.select("page_id", "url", extract(F.col("html")).alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
