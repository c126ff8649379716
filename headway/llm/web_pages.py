"""Main text of web pages by text-to-tag ratios.

One pass of the standard library's streaming parser turns a page into lines (the
runs of text between block elements) with the number of tags each took.  Their
text-to-tag ratios are smoothed with a Gaussian and split by two-means clustering;
the element that holds the bulk of the high cluster is the content region, and its
lines, without what is marked as something else, are the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Fixed: elements that end a line.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary
table tbody td tfoot th thead title tr ul""".split())
#: Fixed: elements whose text is never content.
SKIPPED = frozenset("""head title nav footer aside form script style noscript template button select textarea input iframe object svg
math canvas dialog menu search audio video map""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Fixed: roles and class or id words of what surrounds an article.
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored sponsor promo promotion banner nav navbar
navigation menu submenu breadcrumb breadcrumbs sidebar sidenav footer header masthead topbar toolbar comment comments disqus reply
replies respond cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
share sharing social related recommended pagination pager copyright""".split())
#: Elements that keep their content whatever their class says, unless it says comment.
ROOTS = frozenset("html body main article".split())
#: Elements that never are the region; nor is one without elements in it.
LEAVES = frozenset("p pre li dt dd td th tr h1 h2 h3 h4 h5 h6 caption figcaption legend summary option".split())
#: Part of the content lines' text that the region holds where no article or main tells it.
BULK = 0.9
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Elements that a new one of the same kind ends, in which of their parents.
_CLOSES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


class Lines(HTMLParser):
    """Lines of a page: text, tags, enclosing elements (by number), content or not."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = [("", 0, False)]  # tag, number, skipped
        self.names = [""]
        self.parents = [0]
        self.lines: list[tuple[str, int, int]] = []  # text, tags, element
        self.parts: list[str] = []
        self.tags = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append((text, self.tags, self.open[-1][1]))
            self.tags = 0
        self.parts.clear()

    def handle_starttag(self, tag: str, attrs) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
            if tag in _CLOSES:
                self._close({tag, "dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}, _CLOSES[tag])
            if self.open[-1][0] == "p" or any(x[0] == "p" for x in self.open[-8:]):
                self._close({"p"}, BLOCKS - {"p"})
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in BLOCKS or tag in SKIPPED:
            skipped = self.open[-1][2] or self._skips(tag, attrs)
            if skipped != self.open[-1][2]:
                self.end_line()
            self.names.append(tag)
            self.parents.append(self.open[-1][1])
            self.open.append((tag, len(self.names) - 1, skipped))
        elif attrs and self._skips(tag, attrs):
            self.end_line()
            self.names.append(tag)
            self.parents.append(self.open[-1][1])
            self.open.append((tag, len(self.names) - 1, True))
        elif self.open[-1][0] == tag and self.open[-1][2]:
            self.open.append((tag, self.open[-1][1], True))  # keeps count of equal inline elements

    def handle_startendtag(self, tag: str, attrs) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.tags += 1

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # an unknown declaration is a comment, and the page goes on
            return self.parse_bogus_comment(i, report)

    def _skips(self, tag: str, attrs) -> bool:
        if tag in SKIPPED:
            return True
        if tag == "header" and not any(x[0] in ("article", "main") for x in self.open):
            return True
        for name, value in attrs:
            value = value or ""
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value):
                return True
            if name == "role" and value.lower() in ROLES:
                return True
            if name in ("class", "id"):
                words = set(_WORD.findall(value.lower()))
                if words & (MARKS if tag not in ROOTS else {"comment", "comments"}):
                    return True
        return False

    def _close(self, tags, within) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in tags:
                del self.open[i:]
                return
            if self.open[i][0] in within:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                if self.open[i][2] and tag not in BLOCKS:
                    self.end_line()
                del self.open[i:]
                return
            if self.open[i][0] in ("article", "main", "body", "td", "table") and tag not in ("article", "main", "body", "html", "table", "tr"):
                return

    def handle_data(self, data: str) -> None:
        if not self.open[-1][2]:
            self.parts.append(data)


def smoothed(ratios: np.ndarray, sigma: float = 1.5) -> np.ndarray:
    """Gaussian smoothing; the ends are weighted by what there is."""
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel, "full")[reach:reach + len(ratios)] / np.convolve(np.ones(len(ratios)), kernel, "full")[reach:reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """Where two means, from the least and the greatest value on, part the values."""
    low, high = float(values.min()), float(values.max())
    for _ in range(20):
        cut = (low + high) / 2
        upper = values > cut
        if upper.all() or not upper.any():
            return cut
        new = float(values[~upper].mean()), float(values[upper].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def main_text(html: str | None) -> str:
    """The article's lines, joined by a line end; empty if there is none."""
    page = Lines()
    try:
        page.feed(html or "")
        page.close()
    except (AssertionError, ValueError):  # a malformed declaration: what was read so far counts
        pass
    page.end_line()
    if not page.lines:
        return ""
    ratios = np.array([len(text) / max(tags, 1) for text, tags, _ in page.lines])
    smooth = smoothed(ratios)
    content = smooth >= threshold(smooth)
    # Text of the content lines in every element.  An article or main around most of it is
    # the region; else the deepest element with the bulk, but no leaf.
    weight = np.zeros(len(page.names))
    for (text, _, element), good in zip(page.lines, content):
        if good:
            weight[element] += len(text)
    total = weight.sum()
    for k in range(len(weight) - 1, 0, -1):
        weight[page.parents[k]] += weight[k]
    inner = set(page.parents[1:])
    region = max(k for k in range(len(weight)) if k == 0 or (weight[k] >= BULK * total and k in inner and page.names[k] not in LEAVES))
    at = max(k for k in range(len(weight)) if weight[k] * 2 > total or k == 0)
    while at:  # a part of an article stands for the whole of it
        if page.names[at] in ("article", "main"):
            region = at
        at = page.parents[at]
    inside = np.zeros(len(page.names), bool)
    inside[region] = True
    for k in range(region + 1, len(page.names)):
        inside[k] = inside[page.parents[k]]
    return "\n".join(text for text, _, element in page.lines if inside[element])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            rows = batch.slice(lo, 256)
            text = [main_text(h) for h in rows.column("html").to_pylist()]
            yield pa.record_batch([rows.column("page_id"), rows.column("url"), pa.array(text, pa.string())], ["page_id", "url", "text"])


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Lines are the runs of text between block elements, white space in them is one space,
    character references are decoded; an inline break counts as a space.  A null or empty
    page, or one without text, gives an empty text.  Rows are independent: repeated rows
    and null ids or urls are each reported.  Further columns are ignored.
    """
    return (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
            .mapInArrow(_texts, "page_id long, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
