"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing and clustering.

The standard library's streaming parser turns a page into lines: a line is the text between two
block-level tags, with the tags that stand in it and the element it stands in.  Each line's ratio of
text to tags is smoothed with a Gaussian over its neighbours, and the smoothed ratios are cut
into two clusters at the threshold that separates them best.  Lines of the upper cluster are
content; their share chooses the content region: the article, with the articles beside it that hold
at least a quarter as much, if these hold half of all content; else a main element that does; else the
smallest element that holds nearly all content outside of articles and mains, or all articles
together, whichever is more.  All lines of the region are text, short ones too.

Elements that by their tag, role, class or id are navigation, header, footer, sidebar, notice,
advert, form, script, style or comments are left out.  A form, or a class or id that only may mean one of
them ("popular-science", "overflow-hidden"), counts as a plain element if it holds ten times the
prose of all that is left without it: such an element is the page's wrapper.

White space inside a block becomes one space; blocks are trimmed and joined by an empty line.
Null and empty pages give the empty text; broken and cut-off markup is read as far as it goes.
Every row gives one row, repeated ones too, and an empty table none; of regions that hold equally much
the first one counts.  The work grows with the length of a page, however deep its tags nest.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from realmwatch.llm.texts import map_texts

# HTML elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img br".split()
)
NEVER = frozenset(
    "script style noscript template head title nav footer aside form button select option textarea input iframe svg "
    "canvas object embed audio video dialog menu datalist map".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# Opening one of these ends an open paragraph; opening the key ends an open element of its values.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar note "
    "status".split()
)
# Words of a class or id that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar side aside rail widget widgets footer foot header masthead topbar "
    "cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup login "
    "comment comments reply replies respond discussion disqus related recommended recommendations trending popular "
    "share sharing social toolbar pagination pager form search skip hidden copyright".split()
)
# Those of them that never mean a wrapper of the page.
CERTAIN = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored nav navbar navigation breadcrumb breadcrumbs "
    "sidebar footer cookie cookies consent gdpr popup newsletter subscribe subscription signup login comment comments "
    "reply replies respond disqus pagination pager copyright".split()
)
# Whole classes that make an article one that is not the page's.
ASIDES = frozenset("ad advert comment promo related reply sponsored teaser".split())
LAYOUT = frozenset("has with no without".split())
CONTENT = frozenset("article main".split())
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


_PLAIN, _DOUBTFUL, _OUT = 0, 1, 2
_PROSE = 40  # characters that make a line one of prose, and no label or link


@dataclass
class _Element:
    tag: str
    parent: int
    mark: int


@dataclass
class _Line:
    element: int
    parts: list[str] = field(default_factory=list)
    tags: int = 1


class _Lines(HTMLParser):
    """Streams parser events into lines and the tree of elements they stand in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements = [_Element("", -1, _PLAIN)]
        self.stack = [0]
        self.blocks = [0]  # places in the stack of those that are not inline
        self.open: Counter[str] = Counter()
        self.lines = [_Line(0)]

    def _mark(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        if tag in NEVER:
            return _DOUBTFUL if tag == "form" else _OUT
        if tag in ("html", "body"):
            return _PLAIN
        if tag == "header":
            return _PLAIN if any(self.open[c] for c in CONTENT) else _OUT
        mark = _PLAIN
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return _OUT
            if name == "role" and value and value.lower() in ROLES:
                mark = max(mark, _DOUBTFUL if value.lower() in ("form", "search") else _OUT)
            if name == "style" and value and re.search(r"display\s*:\s*none", value, re.I):
                return _OUT
            if name in ("class", "id") and value and tag not in HEADINGS:
                for part in value.split():  # a layout that has a sidebar is none
                    if tag in CONTENT:
                        mark = max(mark, _OUT if tag == "article" and part.lower() in ASIDES else _PLAIN)
                        continue
                    words = {w.lower() for w in _NAME.findall(part)}
                    if words & MARKS and not words & LAYOUT:
                        mark = max(mark, _OUT if words & CERTAIN else _DOUBTFUL)
        return mark

    def _line(self) -> None:
        last = self.lines[-1]
        if not last.parts:
            last.element = self.stack[-1]
            last.tags += 1
        else:
            self.lines.append(_Line(self.stack[-1]))

    def _close(self, at: int) -> None:
        closed = [self.elements[e] for e in self.stack[at:]]
        del self.stack[at:]
        while self.blocks[-1] >= at:
            self.blocks.pop()
        self.open.subtract(x.tag for x in closed)
        if any(x.mark or x.tag not in INLINE for x in closed):
            self._line()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br" or tag == "wbr":
            self.lines[-1].parts.append(" " if tag == "br" else "")
            return
        if tag in VOID:
            self.lines[-1].tags += 1
            if tag == "hr":
                self._line()
            return
        block = tag not in INLINE
        if block:
            open_tag = self.elements[self.stack[self.blocks[-1]]].tag
            if open_tag == "p" or open_tag in ENDS.get(tag, ()):
                self._close(self.blocks[-1])
            self.blocks.append(len(self.stack))
        mark = self._mark(tag, attrs)
        self.elements.append(_Element(tag, self.stack[-1], mark))
        self.stack.append(len(self.elements) - 1)
        self.open[tag] += 1
        if block or mark:
            self._line()
        else:
            self.lines[-1].tags += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash does not close an HTML element

    def handle_endtag(self, tag: str) -> None:
        if self.open[tag]:
            at = len(self.stack) - 1
            while self.elements[self.stack[at]].tag != tag:
                at -= 1
            self._close(at)
        elif tag == "p":
            self._line()

    def handle_data(self, data: str) -> None:
        self.lines[-1].parts.append(data)


def _smooth(ratios: np.ndarray, sigma: float) -> np.ndarray:
    reach = max(1, math.ceil(2 * sigma))
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * sigma**2))
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight


def _threshold(values: np.ndarray) -> float:
    """The cut into two clusters with the least variance inside them."""
    ordered = np.sort(values)
    n = len(ordered)
    if n < 2 or ordered[0] == ordered[-1]:
        return float(ordered[0])
    sums = np.cumsum(ordered)
    k = np.arange(1, n)
    between = (sums[-1] * k / n - sums[:-1]) ** 2 / (k * (n - k))
    between[ordered[1:] == ordered[:-1]] = -1
    return float(ordered[int(between.argmax()) + 1])


def _below(elements: list[_Element], own: list[int], cut: Callable[[_Element], bool]) -> list[int]:
    """What every element and those below it have of their `own`, not counting the ones below a `cut` element."""
    total = list(own)
    for e in range(len(elements) - 1, 0, -1):  # elements are numbered as they open
        if not cut(elements[e]):
            total[elements[e].parent] += total[e]
    return total


def _left_out(elements: list[_Element], prose: list[int]) -> list[bool]:
    """Which elements are left out, once the wrappers among the doubtful ones are plain."""
    while True:
        total = _below(elements, prose, lambda x: x.mark > _PLAIN)
        out, skipped = [False] * len(elements), [False] * len(elements)
        best = 0
        for e, x in enumerate(elements):
            above = x.parent >= 0
            out[e] = x.mark == _OUT or (above and out[x.parent])
            skipped[e] = x.mark > _PLAIN or (above and skipped[x.parent])
            if x.mark == _DOUBTFUL and not out[e] and total[e] > total[best] * (10 if not best else 1):
                best = e
        if not best:
            return skipped
        while best >= 0:
            elements[best].mark = _PLAIN
            best = elements[best].parent


def _regions(elements: list[_Element], mass: list[int], size: list[int], share: float) -> list[int]:
    """The elements that hold the content, given the `mass` of content and the `size` of all text in each."""
    total = _below(elements, mass, lambda x: False)
    text = _below(elements, size, lambda x: False)
    outer = _outer(elements, "article", text)
    beside: dict[int, list[int]] = {}
    for e in outer:
        beside.setdefault(elements[e].parent, []).append(e)

    def joined(found: list[int]) -> list[int]:
        return [e for e in found if 4 * text[e] >= max(text[x] for x in found)]

    groups = [joined(g) for g in beside.values()]
    groups += [[e] for e in _outer(elements, "main", text)]
    for group in groups[: len(beside)], groups[len(beside) :]:
        best = max(group, key=lambda g: sum(total[e] for e in g), default=[])
        if best and 2 * sum(total[e] for e in best) >= total[0]:
            return best
    rest = _below(elements, mass, lambda x: x.tag in CONTENT)
    if outer and sum(total[e] for e in joined(outer)) >= rest[0]:
        return joined(outer)
    holders = [e for e, x in enumerate(elements) if rest[e] >= share * rest[0] and x.tag not in INLINE]
    region = max(holders, key=lambda e: (elements[e].tag not in CONTENT or rest[e] > 0, e))  # the smallest
    if elements[region].tag in ("p", *HEADINGS) and elements[region].parent >= 0:
        region = elements[region].parent
    return [region]


def _outer(elements: list[_Element], tag: str, text: list[int]) -> list[int]:
    """Elements of a tag that hold text and stand in no other one of that tag."""
    inside, found = [False] * len(elements), []
    for e, x in enumerate(elements):
        above = x.parent >= 0 and inside[x.parent]
        inside[e] = above or x.tag == tag
        if x.tag == tag and not above and text[e]:
            found.append(e)
    return found


def extract_text(html: str | None, sigma: float = 1.0, share: float = 0.9) -> str:
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    if re.match("<[a-zA-Z/!?]", page.rawdata):  # markup that is cut off
        page.rawdata = ""
    page.close()
    elements = page.elements
    found = [(line, _SPACE.sub(" ", "".join(line.parts)).strip()) for line in page.lines]
    prose = [0] * len(elements)
    for line, text in found:
        prose[line.element] += len(text) if len(text) >= _PROSE else 0
    skipped = _left_out(elements, prose)
    found = [(line, text) for line, text in found if text and not skipped[line.element]]
    if not found:
        return ""
    smooth = _smooth(np.array([len(text) / line.tags for line, text in found]), sigma)
    content = smooth >= _threshold(smooth)
    mass, size = [0] * len(elements), [0] * len(elements)
    for (line, text), counts in zip(found, content.tolist(), strict=True):
        mass[line.element] += len(text) if counts else 0
        size[line.element] += len(text)
    inside = [False] * len(elements)
    for e in _regions(elements, mass, size, share):
        inside[e] = True
    for e, x in enumerate(elements):
        inside[e] = inside[e] or (x.parent >= 0 and inside[x.parent])
    return "\n\n".join(text for line, text in found if inside[line.element])


def extract_pages(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """`keep` columns, the main text and its length in code points for every page."""

    def rows(pages: list[str | None]) -> list[list]:
        texts = [extract_text(p) for p in pages]
        return [texts, [len(t) for t in texts]]

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return map_texts(pages, html_col, keep, rows, fields)
