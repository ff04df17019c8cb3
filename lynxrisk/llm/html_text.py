"""Main text of HTML pages: tag ratios of lines, smoothed and clustered.

A page is read once as a stream of events of the standard library's parser. Each block element's text is a line with
its ratio of characters to tags. The ratios are smoothed by a Gaussian along the page and clustered in two by a threshold; lines above
it are content. A cluster only finds where the content is: short paragraphs have low ratios, and a footer can read like a
paragraph. So content lines choose a region of the page, the article (main element, or the least element) that holds them, and
all of its lines are the text, but for those inside elements that say what they are (menus, adverts, forms, ...). Such lines take part
in the smoothing and are never content.

Each page is worked on by itself: no shuffle, and a task holds a group of pages of bounded size.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lynxrisk.llm.common import groups_of, replace

#: Standard deviation of the smoothing, in lines.
SIGMA = 1.5

# HTML elements by what they do to the text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form iframe label menu nav noscript object optgroup option"
    " script search select style svg template textarea title video".split()
)
#: What a class, id or role says of an element that is no part of the article; a name counts by its first or its last part.
NEVER_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie cookies disqus"
    " footer gdpr login menu modal nav navbar navigation newsletter notice notices pager pagination paywall popup promo promotion recommended related replies"
    " respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget widgets".split()
)
HEADER_NAMES = frozenset("header masthead".split())
NOT_NAMES = frozenset("has is js no not with without".split())
#: Elements that are a line, or a row of lines, rather than a part of the page.
_SINGLE = frozenset("caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre summary tbody td th tr".split())
#: A region holds at least so much of the content lines' text: smoothing also raises some short lines beside them.
SHARE = 0.9
_KEPT_WHOLE = frozenset("html body main article".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}


def _names(attrs: list[tuple[str, str | None]]) -> set[str]:
    """First and last parts of an element's class names, id and role."""
    found: set[str] = set()
    for key, value in attrs:
        if key in ("class", "id", "role") and value:
            for name in value.split():
                parts = [p for p in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if p]
                if parts and parts[0] not in NOT_NAMES:
                    found.update((parts[0], parts[-1]))
    return found


def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and v and "display:none" in v.replace(" ", "").lower()) for k, v in attrs)


class Lines(HTMLParser):
    """The lines of a page: for each its text, tags, whether it may be content, and the element that it stands in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool, bool]] = [("", 0, False, False)]  # tag, node, never content, header
        self.open: Counter[str] = Counter()
        self.parents, self.roles, self.names = [-1], [""], [""]
        self.never = self.headers = self.skipped = 0
        self.pieces: list[str] = []
        self.tags = 0
        self.text: list[str] = []
        self.n_tags: list[int] = []
        self.may: list[bool] = []
        self.node: list[int] = []

    def read(self, html: str) -> Lines:
        self.feed(html)
        if re.match(r"<[a-zA-Z/!?]", self.rawdata) and ">" not in self.rawdata:
            self.rawdata = ""  # the page ends inside a tag
        self.ending = True
        self.close()
        self._line()
        return self

    ending = False

    def parse_comment(self, i: int, report: bool = True) -> int:
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 and self.ending else end

    def parse_marked_section(self, i: int, report: bool = True) -> int:
        return self.parse_bogus_comment(i, report)

    def _line(self) -> None:
        """End the line at hand; ``tags`` are those since the line before."""
        text = " ".join("".join(self.pieces).split())
        self.pieces.clear()
        if text:
            tag = self.stack[-1][0]
            self.text.append(text)
            self.n_tags.append(max(self.tags, 1))
            self.may.append(not self.never and (not self.headers or tag in HEADINGS))
            self.node.append(self.stack[-1][1])
            self.tags = 0

    def _push(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        names = _names(attrs) if attrs else set()
        whole = tag in _KEPT_WHOLE and not (tag == "article" and names & {"comment", "comments"})
        never = tag in NEVER or (not whole and (bool(names & NEVER_NAMES) or (bool(attrs) and _hidden(attrs))))
        header = not whole and (tag == "header" or bool(names & HEADER_NAMES))
        if header and not (self.open["article"] or self.open["main"]):
            never, header = True, False
        if tag not in BLOCKS and not never:
            return
        role = ""
        if tag == "article" or ("role", "article") in attrs or ("itemprop", "articleBody") in attrs:
            role = "article"
        elif tag == "main" or ("role", "main") in attrs:
            role = "main"
        self.parents.append(self.stack[-1][1])
        self.roles.append(role)
        self.names.append(tag)
        self.stack.append((tag, len(self.parents) - 1, never, header))
        self.open[tag] += 1
        self.never += never
        self.headers += header
        self.skipped += tag not in BLOCKS

    def _pop(self, upto: tuple[str, ...]) -> None:
        """Close the open elements up to the innermost of these."""
        while len(self.stack) > 1:
            tag, _, never, header = self.stack.pop()
            self.open[tag] -= 1
            self.never -= never
            self.headers -= header
            self.skipped -= tag not in BLOCKS
            if tag in upto:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body":
            self._line()
            while len(self.stack) > 1:
                self._pop(("",))
        if tag in BLOCKS:
            self._line()
            if self.open["p"]:
                self._pop(("p",))
            for other in _CLOSES.get(tag, ()):
                if self.stack[-1][0] == other:
                    self._pop((other,))
        elif tag == "br":
            self.pieces.append(" ")
        self.tags += 1
        if tag not in VOID:
            self._push(tag, attrs)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do: only void elements have no end

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._line()
        if self.open[tag]:
            self._pop((tag,))
        self.tags += 1

    def handle_data(self, data: str) -> None:
        if not self.skipped:  # inside a line, such as a script or a button: the line goes on after it
            self.pieces.append(data)


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing along the page; at the ends the weights that are left count."""
    reach = int(np.ceil(3 * sigma))
    at = np.arange(-reach, reach + 1)
    kernel = np.exp(-(at**2) / (2 * sigma**2))
    same = slice(reach, reach + len(ratios))
    return np.convolve(ratios, kernel)[same] / np.convolve(np.ones(len(ratios)), kernel)[same]


def threshold(values: np.ndarray) -> float:
    """The border of two clusters: half way between the means of the values on either side, repeated until it stays."""
    border = (values.min() + values.max()) / 2
    for _ in range(50):
        high = values >= border
        if high.all() or not high.any():
            break
        new = (values[high].mean() + values[~high].mean()) / 2
        if new == border:
            break
        border = new
    return float(border)


def content_lines(lines: Lines) -> np.ndarray:
    """Which lines are content by themselves: above the threshold, and not inside an element that says it is none."""
    may = np.array(lines.may, dtype=bool)
    ratios = np.array([len(t) for t in lines.text], dtype=float) / np.array(lines.n_tags)
    smoothed = smooth(ratios)
    chosen = may & (smoothed >= threshold(smoothed))
    if may.any() and not chosen.any():
        chosen[np.flatnonzero(may)[np.argmax(smoothed[may])]] = True
    return chosen


def _under(lines: Lines, wanted: list[bool]) -> list[int]:
    """For each node, the outermost wanted node at or above it; -1 without one. Parents come before their children."""
    found = [-1] * len(lines.parents)
    for node, parent in enumerate(lines.parents):
        found[node] = found[parent] if parent >= 0 and found[parent] >= 0 else (node if wanted[node] else -1)
    return found


def main_text(html: str | None) -> str:
    """Main text of one page: a line for each block of its article; empty for a null or empty page."""
    lines = Lines().read(html or "")
    if not any(lines.may):
        return ""
    chosen = np.flatnonzero(content_lines(lines)).tolist()
    size = lambda at: sum(len(lines.text[i]) for i in at)
    region: list[bool] | None = None
    for role in ("article", "main"):
        top = _under(lines, [r == role for r in lines.roles])
        inside = [i for i in chosen if top[lines.node[i]] >= 0]
        if 2 * size(inside) >= size(chosen) and inside:
            tops = {top[lines.node[i]] for i in inside}
            region = [top[n] in tops for n in lines.node]
            break
    if region is None:
        region = _least_region(lines, chosen)
    return "\n".join(t for t, m, r in zip(lines.text, lines.may, region, strict=True) if m and r)


def _least_region(lines: Lines, chosen: list[int]) -> list[bool]:
    """Lines of the least element around the content lines: its own, those of its parts with content, and all between content."""
    holds = [0] * len(lines.parents)
    for i in chosen:
        holds[lines.node[i]] += len(lines.text[i])
    for node in range(len(holds) - 1, 0, -1):
        holds[lines.parents[node]] += holds[node]
    least = max(n for n, h in enumerate(holds) if h >= SHARE * holds[0])  # the innermost has the greatest number
    while lines.names[least] in _SINGLE:
        least = lines.parents[least]
    inside = _under(lines, [n == least for n in range(len(holds))])
    part = _under(lines, [p == least for p in lines.parents])
    within = [i for i in chosen if inside[lines.node[i]] == least]
    parts = {part[lines.node[i]] for i in within}
    return [
        inside[node] == least and (node == least or part[node] in parts or within[0] <= i <= within[-1] or lines.names[part[node]] in _SINGLE)
        for i, node in enumerate(lines.node)
    ]


def extracted(html: Column) -> Column:
    """Main text of a column of pages."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(h) for group in groups_of(batch) for h in group], pa.string())

    return texts(html.cast("string"))


def extract(pages: DataFrame) -> DataFrame:
    """All rows and columns of the pages, with ``text`` (their main text) and ``n_chars`` (its code points, long).

    A null or empty page, and one without any text outside menus and the like, has an empty text. Character references are decoded; white space inside
    a block, ``br`` included, is one space; blocks are joined by \\n. A header inside an article gives its headings. Pages are read whole, however long; a page
    that ends inside a tag or comment ends there. Repeated rows are treated alike; an empty table gives an empty result.
    Input columns named text or n_chars (in any case) are replaced.
    """
    with_text = replace(pages, text=extracted(F.col("html")))
    return replace(with_text, n_chars=F.length("text").cast("long"))
