"""Main text of web pages: parser events, text-to-tag ratios, smoothing and clustering."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, slices

# Element names of HTML by their role for text extraction.
CONTAINERS = frozenset("html body main article section div nav header footer aside form ul ol dl table tbody thead tfoot tr blockquote figure figcaption fieldset details menu dialog address center".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th caption pre hr title summary legend option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Never text.
NO_TEXT = frozenset("head title script style noscript template iframe object svg canvas select button textarea".split())
#: Hints at text beside the content.
HINT_TAGS = frozenset("nav header footer aside form menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_ITSELF = frozenset("li dt dd td th tr option caption".split())
HINT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
HINT_WORDS = frozenset("ad ads advert adverts advertisement banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs sidebar footer header masthead notice notices cookie cookies consent popup modal newsletter subscribe signup share sharing social related recommended comment comments disqus respond reply replies pagination pager toolbar".split())

#: Width of the Gaussian in lines.
SIGMA = 1.5
#: What is left of a line's ratio in an element with a hint.
HINTED = 0.01
#: Part of the page's text from which on an element is no part beside the content, whatever its hints.
MOST = 0.5
#: Characters outside links that make an element without paragraphs one with text of its own.
LONG_TEXT = 200
#: Part of the upper cluster's text that an article or main element must hold to be the region.
HELD = 0.9
#: Part of a line's characters from which on links make it a menu where no other text is beside it.
LINKED = 0.5
_WORDS = re.compile(r"[a-z]+|[0-9]+")


@dataclass
class Line:
    text: str
    tags: int
    container: int
    hint: int
    linked: int  # characters in links, blanks aside
    heading: bool


class _Lines(HTMLParser):
    """Turns parser events into lines, with the containers and the hints around them.

    Containers and elements with hints are numbered as they open, 0 is the page; of both only the
    names and parents are kept, no tree. Text of elements that hold none is dropped here.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parents, self.names = [-1], [""]
        self.hint_parents = [-1]
        self.heads, self.paragraphs = [0], [0]  # of each hint: first headline, main and article; all headings and paragraphs
        self.seen: set[str] = set()
        self.open: list[tuple[str, int, int, bool]] = []  # name, container, hint, without text
        self.open_names: Counter[str] = Counter()
        self.inside, self.hints = [0], [0]  # containers and hints that are open
        self.out = 0
        self.text: list[str] = []
        self.tags = 0
        self.anchor = False
        self.linked = 0
        self.heading = False

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text and not self.out:
            self.lines.append(Line(text, self.tags, self.inside[-1], self.hints[-1], self.linked, self.heading))
        if text:
            self.tags = 0
        self.text.clear()
        self.linked = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            self.heading = tag in HEADINGS
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag == "a":
            self.anchor = any(name == "href" for name, _ in attrs)
        elif tag in CONTAINERS:
            self.anchor = False
        if tag == "body":
            self.close_to(0)
        elif tag in BLOCKS and self.open and (self.open[-1][0] == "p" or self.open[-1][0] == tag and tag in ENDS_ITSELF):
            self.close_to(len(self.open) - 1)
        if tag in VOID:
            return
        first = tag not in self.seen
        if first and tag in ("h1", "main", "article"):
            self.seen.add(tag)
            self.heads[self.hints[-1]] += 1
        if tag in HEADINGS or tag in ("main", "article", "p"):
            self.paragraphs[self.hints[-1]] += 1
        if not (tag in CONTAINERS or tag in NO_TEXT or attrs):
            return
        hinted, no_text = tag in HINT_TAGS, tag in NO_TEXT
        for name, value in attrs:
            value = (value or "").lower()
            if name in ("class", "id"):
                hinted |= tag not in ("html", "body", "main") and not (first and tag == "article") and not HINT_WORDS.isdisjoint(_WORDS.findall(value))
            elif name == "role":
                hinted |= value in HINT_ROLES
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                hinted = True
        if tag not in CONTAINERS and not hinted and not no_text:
            return
        if (hinted or no_text) and tag not in BLOCKS:
            self.flush()
        container = hint = -1
        if tag in CONTAINERS:
            container = len(self.names)
            self.parents.append(self.inside[-1])
            self.names.append(tag)
            self.inside.append(container)
        if hinted:
            hint = len(self.hint_parents)
            self.hint_parents.append(self.hints[-1])
            self.heads.append(0)
            self.paragraphs.append(0)
            self.hints.append(hint)
        self.open.append((tag, container, hint, no_text))
        self.open_names[tag] += 1
        self.out += no_text

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS or tag in NO_TEXT:
            self.flush()
            self.heading = False
        if tag == "a" or tag in CONTAINERS:
            self.anchor = False
        if not self.open_names[tag]:  # an end without a start costs no search
            return
        k = next(k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == tag)
        self.flush()
        self.close_to(k)

    def close_to(self, k: int) -> None:
        for name, container, hint, no_text in self.open[k:]:
            self.open_names[name] -= 1
            self.out -= no_text
            if container >= 0:
                self.inside.pop()
            if hint >= 0:
                self.hints.pop()
        del self.open[k:]

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if self.anchor:
            self.linked += len("".join(data.split()))

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """As in browsers, ``<![`` opens a comment that ends at the next ``>``, so none fails or
        swallows what follows; only CDATA sections that are closed run to their own end."""
        end = super().parse_marked_section(i, report) if self.rawdata[i : i + 9].lower() == "<![cdata[" else -1
        return end if end >= 0 else self.parse_bogus_comment(i, report)


def smoothed(values: list[float], sigma: float = SIGMA, units: list[int] | None = None) -> list[float]:
    """Gaussian smoothing; the kernel is normalised over the lines it finds in the same unit."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(reach + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for j in range(max(0, i - reach), min(len(values), i + reach + 1)):
            if units is None or units[i] == units[j]:
                total += kernel[abs(i - j)] * values[j]
                weight += kernel[abs(i - j)]
        out.append(total / weight)
    return out


def two_clusters(values: list[float], weights: list[int] | None = None) -> float:
    """The threshold between the two clusters of least squared error in sorted order."""
    ordered = sorted(zip(values, weights or [1] * len(values), strict=True))
    n, total = sum(w for _, w in ordered), sum(v * w for v, w in ordered)
    best, threshold, seen, below = -1.0, ordered[0][0], 0, 0.0
    for (v, w), (after, _) in pairwise(ordered):
        seen += w
        below += v * w
        between = seen * (n - seen) * (below / seen - (total - below) / (n - seen)) ** 2
        if after > v and between > best:
            best, threshold = between, after
    return threshold


def _totals(sizes: list[int], parents: list[int]) -> list[int]:
    """Sums over whole subtrees; children have larger numbers than their parents."""
    sums = sizes.copy()
    for c in range(len(sums) - 1, 0, -1):
        sums[parents[c]] += sums[c]
    return sums


def _aside(parser: _Lines) -> list[bool]:
    """Of each hint, whether its element stands beside the content: it or an element around it.

    An element with most of the page's text does not, if it holds the first headline, main element
    or article, or if there are no headings or paragraphs outside of hints but some inside.
    """
    sizes, plain = [0] * len(parser.hint_parents), [0] * len(parser.hint_parents)
    for line in parser.lines:
        sizes[line.hint] += len(line.text)
        plain[line.hint] += max(0, len(line.text) - line.linked)
    held, plain, heads, paragraphs = (_totals(x, parser.hint_parents) for x in (sizes, plain, parser.heads, parser.paragraphs))
    aside = [False] * len(held)
    for h in range(1, len(held)):
        texts = paragraphs[h] or plain[h] >= LONG_TEXT
        content = held[h] >= MOST * held[0] and (heads[h] or not parser.paragraphs[0] and texts)
        aside[h] = aside[parser.hint_parents[h]] or not content
    return aside


def content_lines(parser: _Lines, clusters: Callable[[list[float], list[int]], float] = two_clusters) -> list[Line]:
    """The lines of the content region; ``clusters`` gives the threshold between ratios."""
    lines, parents = parser.lines, parser.parents
    if not lines:
        return []
    aside = _aside(parser)
    hinted = [aside[x.hint] for x in lines]
    linked = [not x.heading and x.linked >= LINKED * len(x.text.replace(" ", "")) for x in lines]
    menus = not all(m or h for m, h in zip(linked, hinted, strict=True))  # a page of nothing but links is no menu
    plain = [not h and not (menus and m) for h, m in zip(hinted, linked, strict=True)]
    raw = [(max(0, len(x.text) - x.linked) + HINTED * min(x.linked, len(x.text))) * (HINTED if h else 1) / (x.tags + 1) for x, h in zip(lines, hinted, strict=True)]

    def upper(part: list[int], region: int) -> list[int]:
        """Of some lines those of the upper cluster, after smoothing inside each part of a region."""
        below = _children(parents, region)
        units = [2 * below[lines[i].container] + hinted[i] for i in part]
        ratios = [math.sqrt(r) for r in smoothed([raw[i] for i in part], units=units)]
        threshold = clusters(ratios, [len(lines[i].text) for i in part])
        return [i for i, r in zip(part, ratios, strict=True) if r >= threshold]

    if not menus:
        return [x for x, h in zip(lines, hinted, strict=True) if not h]
    outer = [0] * len(parents)  # the article or main element around each container, or 0
    for c in range(1, len(parents)):
        outer[c] = outer[parents[c]] or (c if parser.names[c] in ("article", "main") else 0)
    part = list(range(len(lines)))
    region = _common(parents, [x.container for x in lines])
    content = upper(part, region)
    # an article or main element with nearly all of the content is the region
    held = Counter()
    for i in content:
        held[outer[lines[i].container]] += len(lines[i].text)
    best = max(held, key=lambda c: (held[c], -c))
    if best and held[best] >= HELD * sum(held.values()):
        region = best
    else:
        # down to the only part with content, as long as the region has no text beside its parts
        while True:
            below = _children(parents, region)
            parts = {below[lines[i].container] for i in content}
            if len(parts) > 1 or region in parts or any(plain[i] and lines[i].container == region for i in part):
                break
            only = parts.pop()
            part = [i for i in part if below[lines[i].container] == only]
            region = _common(parents, [lines[i].container for i in part])
            content = upper(part, region)
    below = _children(parents, region)
    part = [i for i in range(len(lines)) if below[lines[i].container] >= 0]
    # containers with nothing but lines of links are menus; links beside other text are text
    texts = [0] * len(parents)
    for i in part:
        texts[lines[i].container] += plain[i]
    texts = _totals(texts, parents)
    return [lines[i] for i in part if not hinted[i] and texts[lines[i].container]]


def _children(parents: list[int], region: int) -> list[int]:
    """For each container the one below ``region`` that it lies in; the region is its own, and -1
    stands for containers outside."""
    below = [-1] * len(parents)
    below[region] = region
    for c in range(region + 1, len(parents)):
        if parents[c] == region:
            below[c] = c
        elif below[parents[c]] > region:
            below[c] = below[parents[c]]
    return below


def _common(parents: list[int], containers: list[int]) -> int:
    """The innermost container around all of some."""
    counted = Counter(containers)
    sizes = [counted[c] for c in range(len(parents))]
    held = _totals(sizes, parents)
    return max(c for c in range(len(parents)) if held[c] == len(containers))


def main_text(html: str, clusters: Callable[[list[float], list[int]], float] = two_clusters) -> str:
    """The blocks of the main content, one per line.

    Parser events cut the page into lines, one per block. A line's ratio is its text by its tags;
    text in links hardly counts, nor do lines in elements whose tag, role or class hints at a menu,
    header, footer, form, advert, notice or comment. Ratios are smoothed by a Gaussian inside each
    part of the page and parted into two clusters. The content region is the innermost container
    of all lines of the upper cluster, or the article or main element around it: what it holds
    stays, short lines among it, but for lines with a hint and menus (containers with nothing but
    lines of links). A hint does not count where its element holds most of the page's text, so
    names of layouts, forms around whole pages and elements that are never closed lose no article.
    """
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    return "\n".join(x.text for x in content_lines(parser, clusters))


def extract_main_text(df: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, ``text`` (empty if there is none) and ``n_chars``, its code points.

    Null html counts as empty; null ids and urls pass through; repeated rows all stay. Pages are
    parsed whole, however long, in time that grows with their length; cut markup gives the text up
    to there, and what follows broken declarations stays. Each page is handled alone, in Arrow
    batches, without a shuffle; an empty table gives an empty one. Other columns are not read,
    whatever their names.
    """
    bound_batches(df.sparkSession)
    narrow = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, html in slices(batches, "html"):
            texts = [main_text(h) for h in html.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return narrow.mapInArrow(extract, f"`{id_col}` {kinds['id']}, `{url_col}` {kinds['url']}, text string, n_chars long")
