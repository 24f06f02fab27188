"""Main text of web pages: streaming parser events, text-to-tag ratio per line, smoothing and clustering.

The standard library's event parser cuts a page into *lines*: block-level text units in page order, each with its
text length, its tag and link counts and its container. Only what is no text of the page is left out as events arrive
(scripts, styles, forms and their controls, embedded media); menus, headers, footers and sidebars are lines like any other. The
(logarithmic) text-to-tag ratio of the lines, linked text aside, is smoothed with a Gaussian kernel and split in two clusters at
a threshold (mean of the two cluster means, iterated). The split counts only if the cluster means are at least ``APART`` apart; otherwise
all lines but those made of links are high. Then the page's article and main elements are weighed: if they hold at
least half of the text of the high lines, those with a high line belong to the content region whole, else they count
like any other element. The region is every line from the first to the last that is high (smoothed or own ratio) or in such an
element, plus headings directly before, plus the adjoining lines with few links (where elements were accepted, only
lines inside article or main elements). Lines inside the region are never dropped for being short.

An exact check follows: lines of the region go if an element around them says outright that it is none of the article, by its name
(``nav``, ``footer``, ``aside``, a ``header`` outside the article and so on), by its role, or by a whole class or id name such as ``ad`` or
``comments``. A longer name that merely begins or ends with such a word (``share-price``, ``comment-body``) says nothing.

Defined results: null and empty pages, and pages without text, give the empty text; unclosed and stray tags are
tolerated (an end tag closes everything opened inside it, one without a start is ignored), in time linear in the page; equal rows get equal
results, a null id is kept; an empty table gives an empty result; other columns are not read. Nothing is capped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of the HTML standard by their role for text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
REGIONS = ("article", "main")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
NEVER = frozenset("script style noscript template head title form button select textarea iframe object svg canvas audio video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements, roles and whole class or id names that say what is no part of an article.
NAMED = frozenset("nav header footer aside menu dialog".split())
NAMED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
NAMED_CLASSES = frozenset(
    "ad ads advert adverts advertisement advertisements adsense sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs"
    " pagination pager sidebar side-bar footer header masthead page-header page-footer site-header site-footer site-nav comment comments"
    " comment-list reader-comments disqus disqus_thread respond cookie cookies cookie-banner cookie-notice cookie-consent consent gdpr notice notices"
    " popup modal overlay newsletter newsletter-signup subscribe signup login sharing social related-posts skip-link".split()
)
#: Least distance of the cluster means, in natural logarithms of the ratio, for a split to count.
APART = 1.5
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class _Lines(HTMLParser):
    """Collects lines as ``(text, tags, linked characters, heading, region, named)``; region counts article elements, named: an
    element around the line says that it is none of the article."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool, int, bool]] = []
        self.stack: list[tuple[str, bool, bool]] = []  # element, whether it is never text, whether it is named
        self.open: Counter[str] = Counter()
        self.never = self.named = self.links = self.region = self.regions = 0
        self.parts: dict[bool, list[str]] = {False: [], True: []}
        self.linked = {False: 0, True: 0}
        self.tags = 0

    def flush(self) -> None:
        for named, parts in self.parts.items():
            text = " ".join("".join(parts).split())
            if text:
                heading = any(x[0] in HEADINGS for x in self.stack[-3:])
                self.lines.append((text, self.tags, self.linked[named], heading, self.region, named))
                self.tags = 0
            self.parts[named], self.linked[named] = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        if tag == "br" and not self.never:
            self.parts[self.named > 0].append(" ")
        if tag in VOID:
            return
        if tag in _CLOSES:
            while self.stack and self.stack[-1][0] in _CLOSES[tag]:
                self._pop()
        never, named = tag in NEVER, self._says(tag, attrs)
        self.never += never
        self.named += named
        self.links += tag == "a"
        if tag in REGIONS and not self.never and not self.region:
            self.regions += 1
            self.region = self.regions
        self.stack.append((tag, never, named))
        self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        if tag in VOID or not self.open[tag]:
            return
        while self._pop() != tag:
            pass

    def _pop(self) -> str:
        name, never, named = self.stack.pop()
        self.open[name] -= 1
        self.never -= never
        self.named -= named
        self.links -= name == "a"
        if name in REGIONS and not any(self.open[x] for x in REGIONS):
            self.region = 0
        return name

    def _says(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in ("html", "body", *REGIONS):
            return False
        # a header that belongs to an article holds its title
        if tag in NAMED and not (tag == "header" and self.region):
            return True
        for name, value in attrs:
            if name in ("class", "id") and value and not NAMED_CLASSES.isdisjoint(value.lower().split()):
                return tag != "header"
            if name == "role" and value and value.strip().lower() in NAMED_ROLES:
                return True
        return False

    def handle_data(self, data: str) -> None:
        if not self.never:
            self.parts[self.named > 0].append(data)
            if self.links:
                self.linked[self.named > 0] += len(data.strip())

    def close(self) -> None:
        super().close()
        self.flush()


def smooth(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing with the kernel cut at three sigma and renormalised at the ends."""
    reach = int(3 * sigma)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel, "full")[reach : reach + len(ratios)] / np.convolve(np.ones(len(ratios)), kernel, "full")[reach : reach + len(ratios)]


def two_clusters(values: np.ndarray) -> float:
    """Threshold between a low and a high cluster: the middle of their means, until it stays."""
    threshold = float(values.mean())
    for _ in range(50):
        high, low = values[values >= threshold], values[values < threshold]
        if not len(high) or not len(low):
            break
        after = (float(high.mean()) + float(low.mean())) / 2
        if abs(after - threshold) < 1e-9:
            break
        threshold = after
    return threshold


def content_region(lines: list[tuple[str, int, int, bool, int, bool]]) -> tuple[int, int]:
    """The first and the last line of the content region."""
    # on a logarithmic scale long and short paragraphs stay together, apart from lines of links
    sizes = np.array([max(0, len(text) - linked) for text, _, linked, *_ in lines])
    ratios = np.log1p(sizes / np.array([max(1, line[1]) for line in lines]))
    few_links = np.array([2 * linked < len(text) for text, _, linked, *_ in lines])
    region = np.array([line[4] for line in lines])
    level = smooth(ratios)
    threshold = two_clusters(level)
    upper, lower = level[level >= threshold], level[level < threshold]
    if len(lower) and upper.mean() - lower.mean() >= APART:
        high = (level >= threshold) | (ratios >= threshold)
    else:
        high = few_links if few_links.any() else np.ones(len(lines), bool)
    marked = region > 0
    trusted = marked.any() and 2 * sizes[high & marked].sum() >= sizes[high].sum()
    inside = np.flatnonzero(high | (np.isin(region, region[high & marked]) & marked) if trusted else high)
    first, last = int(inside[0]), int(inside[-1])
    adjoins = few_links & marked if trusted else few_links
    while first and (lines[first - 1][3] or adjoins[first - 1]):
        first -= 1
    while last + 1 < len(lines) and adjoins[last + 1]:
        last += 1
    return first, last


def lines_of(html: str | None) -> list[tuple[str, int, int, bool, int, bool]]:
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    return parser.lines


def main_text(html: str | None) -> str:
    """Blocks of the main text in page order, one per line."""
    lines = lines_of(html)
    if not lines:
        return ""
    first, last = content_region(lines)
    return "\n".join(line[0] for line in lines[first : last + 1] if not line[5])


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``page_id, url, text`` for every row; an Arrow map, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array((main_text(h.as_py()) for h in batch.column(2)), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=["page_id", "url", "text"])

    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return narrow.mapInArrow(run, "page_id long, url string, text string")
