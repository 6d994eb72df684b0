"""Main text of web pages: streaming parser events, text-to-tag ratios, Gaussian
smoothing and threshold clustering.

1. The standard library's HTML parser streams events; each block element starts a
   line with its text and its number of tags; lines without text are dropped.
2. A line's text-to-tag ratio counts its characters outside of links. In menus, headers, footers,
   asides, forms and containers named as adverts, notices, sidebars or comments, a prior of
   ``PRIOR`` scales it: such names make a line unlikely, they do not exclude it.
3. The ratios are smoothed by a Gaussian and split in two clusters by their means. The lines above
   the threshold are the page's dense text.
4. The content region is the innermost container with ``SHARE`` of that text's characters, widened to the
   article or main that holds it, if any. Its lines are the content, in page order, the
   short ones between and around the dense ones too; lines that the prior made unlikely must reach the
   threshold themselves, unless the whole region is inside such an element.

Results for odd input: null, empty and tagless html give an empty text or the
text itself; unclosed and stray tags are tolerated, at any depth in linear time; each row gives one row, in
no order; page_id and url may be null or repeat; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship

SIGMA = 1.0
#: Weight of a line in a menu, advert, comment and the like.
PRIOR = 0.01
#: Share of the dense text's characters that the content region holds.
SHARE = 0.8

# Elements by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption "
            "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary "
            "table tbody td tfoot th thead title tr ul".split())
SILENT = set("script style noscript template svg math head title iframe object canvas audio video "
             "select textarea button".split())
ASIDE = set("nav header footer aside form menu dialog".split())
REGION = set("article main section div td body".split())
CLOSED_BY_BLOCK = {"p"}
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|sidebar|side|aside|"
    r"nav(?:bar|igation)?|menu|breadcrumbs?|header|masthead|footer|foot|cookies?|consent|gdpr|notice|notification|"
    r"alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|"
    r"comments?|disqus|replies|respond|pagination|pager|toolbar|widget|copyright|legal)(?:$|[\s_-]|\d)", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog"}


@dataclass
class Line:
    region: int
    asides: int  # elements around it that make it unlikely
    parts: list[str] = field(default_factory=list)
    tags: int = 1
    link_chars: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


class Lines(HTMLParser):
    """Collects the lines of a page, and its regions, from the parser's events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int, bool]] = []  # tag, region, asides, silent
        self.count: Counter = Counter()  # open elements by tag
        self.regions: list[tuple[str, int, int]] = [("body", 0, 0)]  # tag, enclosing region, asides
        self.lines: list[Line] = []
        self.begin()

    def state(self) -> tuple[int, int, bool]:
        return self.open[-1][1:] if self.open else (0, 0, False)

    def begin(self) -> None:
        region, asides, _ = self.state()
        self.lines.append(Line(region, asides))

    def close_last(self) -> str:
        tag = self.open.pop()[0]
        self.count[tag] -= 1
        return tag

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK and self.open and self.open[-1][0] in CLOSED_BY_BLOCK and tag != "br":
            self.close_last()
        region, asides, silent = self.state()
        if tag not in VOID:
            given = {k: v or "" for k, v in attrs}
            named = tag not in ("html", "body", "article", "main") and bool(
                NAMED.search(f"{given.get('class', '')} {given.get('id', '')}"))
            asides += tag in ASIDE or named or given.get("role") in ROLES or "hidden" in given
            silent = silent or tag in SILENT
            if tag in REGION:
                self.regions.append((tag, region, asides))
                region = len(self.regions) - 1
            self.open.append((tag, region, asides, silent))
            self.count[tag] += 1
        if tag in BLOCK:
            self.begin()
        self.lines[-1].tags += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.lines[-1].tags += 1
        if self.count[tag]:
            while self.close_last() != tag:
                pass
        if tag in BLOCK:
            self.begin()

    def handle_data(self, data: str) -> None:
        if not self.state()[2]:
            self.lines[-1].parts.append(data)
            if self.count["a"]:
                self.lines[-1].link_chars += len(data.strip())


def smooth(x: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing with the kernel cut at three sigmas; edges are renormalised."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(x)):
        lo, hi = max(0, i - reach), min(len(x), i + reach + 1)
        k = kernel[lo - i + reach:hi - i + reach]
        out.append(sum(a * b for a, b in zip(x[lo:hi], k, strict=True)) / sum(k))
    return out


def threshold(x: list[float]) -> float:
    """Midpoint of the two clusters' means; the least value if there is one cluster only."""
    lo, hi = min(x), max(x)
    while lo < hi:
        cut = (lo + hi) / 2
        low, high = [v for v in x if v < cut], [v for v in x if v >= cut]
        if not low or not high:
            break
        new = (sum(low) / len(low), sum(high) / len(high))
        if new == (lo, hi):
            break
        lo, hi = new
    return (lo + hi) / 2 if lo < hi else lo


def weights(lines: list[tuple[Line, str]]) -> list[float]:
    """Text-to-tag ratio of every line under its prior."""
    return [max(0, len(t) - x.link_chars) / x.tags * (PRIOR if x.asides else 1.0) for x, t in lines]


def content_region(regions: list[tuple[str, int, int]], dense: list[tuple[int, int]]) -> int:
    """The innermost region with SHARE of the dense characters (region, characters), or the article around it."""
    mass = [0] * len(regions)
    for region, chars in dense:
        mass[region] += chars
    for i in range(len(regions) - 1, 0, -1):  # a region comes after those around it
        mass[regions[i][1]] += mass[i]
    best = 0
    for i in range(1, len(regions)):
        if regions[i][1] == best and mass[i] >= SHARE * mass[0]:
            best = i
    at = best
    while at:
        if regions[at][0] in ("article", "main"):
            return at
        at = regions[at][1]
    return best


def within(regions: list[tuple[str, int, int]], top: int) -> list[bool]:
    """Which regions are the top one or inside it."""
    inside = [i == top for i in range(len(regions))]
    for i in range(1, len(regions)):
        inside[i] = inside[i] or inside[regions[i][1]]
    return inside


def main_text(html: str, cut: float | None = None) -> str:
    """The article's blocks, in page order, joined by one space; ``cut``: a threshold in place of the clusters'."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    lines = [(x, t) for x in parser.lines if (t := x.text)]
    ratios = weights(lines)
    if not any(ratios):  # nothing but links, if anything
        ratios = [len(t) / x.tags * (PRIOR if x.asides else 1.0) for x, t in lines]
    if not any(ratios):
        return ""
    level = smooth(ratios)
    cut = threshold(level) if cut is None else cut
    dense = [(x.region, len(t)) for (x, t), v, r in zip(lines, level, ratios, strict=True) if r and v >= cut]
    top = content_region(parser.regions, dense)
    inside, asides = within(parser.regions, top), parser.regions[top][2]
    return " ".join(t for (x, t), r in zip(lines, ratios, strict=True)
                    if inside[x.region] and (x.asides <= asides or r >= cut))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [main_text(h.as_py() or "") for h in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
