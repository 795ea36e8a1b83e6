"""Main text of web pages by smoothed text-to-tag ratios.

The events of the standard library's streaming parser are cut into lines, one for each block
of text, that carry their characters, their characters within links, the tags met
since the line before, and the containers around. A line's ratio is its text outside
links against its tags; text in a part of the page that says it isn't content (a menu, a form, an
advert) counts nothing. Ratios are smoothed along the page with a Gaussian, a
threshold splits them into two clusters, and the runs of lines above it are the content
regions. Regions name the page's content container: in it, lines too short to stand out
belong to the text as well, while what lies outside stays out.

One page is one row: no shuffle, and any page's work depends on that page alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from clickscope.llm.common import fresh

SIGMA = 1.0        # of the Gaussian, in lines
RADIUS = 3
LINKED = 0.5       # a line with this share of its text in links isn't text
RIVAL = 1 / 3      # a second article is content from this share of the largest one's text on
CONTAINED = 2 / 3  # the content container holds this share of the regions' text

# Fixed values of HTML: elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style template noscript iframe object svg canvas audio video map math".split())
APART = frozenset("nav aside footer form button select option textarea dialog menu fieldset".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th
thead tr ul""".split())
SECTIONS = frozenset("html body main article section div td th center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An open element that the start of another one ends: the element, and what bounds the search for it.
ENDED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
            "option": ({"option"}, {"select"})}
# Words in a class, an id or a role that name a part of the page other than its content.
BOILERPLATE = frozenset("""ad ads adsense advert adverts advertisement advertising alert alertdialog banner breadcrumb breadcrumbs
byline captcha comment comments complementary consent contentinfo cookie cookies copyright dialog disclaimer disqus footer form
gdpr login masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination paywall popup promo
promoted promotion recommended related replies reply respond search share sharebar sharing sidebar sidebars signup skip
social sponsor sponsored subscribe subscription tags teaser toc toolbar topbar widget widgets""".split())
NEGATED = frozenset("has with no without".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Line:
    __slots__ = ("text", "tags", "linked", "apart", "heading", "path")

    def __init__(self, text, tags, linked, apart, heading, path):
        self.text, self.tags, self.linked, self.apart, self.heading, self.path = text, tags, linked, apart, heading, path


def _names(attrs: dict) -> Iterator[str]:
    """The words of class, id and role; a name like ``has-sidebar`` says nothing about the element itself."""
    for value in (attrs.get("class"), attrs.get("id"), attrs.get("role")):
        for name in (value or "").split():
            words = [w.lower() for w in _NAME.findall(name)]
            if not NEGATED.intersection(words):
                yield from words


class Lines(HTMLParser):
    """The lines of a page. ``sections`` has each container as (parent, is it the landmark of an article)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.sections: list[tuple[int, int]] = [(-1, 0)]
        self.stack: list[tuple[str, str, int]] = []  # tag, how it is apart ("" if not), section
        self.parts: list[str] = []
        self.tags = self.linked = self.in_link = 0

    # -- events

    def parse_marked_section(self, i, report=1):  # in HTML a comment, whatever its name
        return self.parse_bogus_comment(i, report)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
            self._end({"p"}, {"button", *SECTIONS})
        if tag in ENDED_BY:
            self._end(*ENDED_BY[tag])
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        own = dict(attrs)
        apart, at = (self.stack[-1][1], self.stack[-1][2]) if self.stack else ("", 0)
        landmark = 1 if tag == "article" or own.get("itemprop") == "articleBody" else 2 if tag == "main" or own.get("role") == "main" else 0
        if tag in HIDDEN or "hidden" in own:
            apart = "hidden"
        elif apart != "hidden":
            named = tag not in ("html", "body", "main") and not BOILERPLATE.isdisjoint(_names(own))
            if tag in APART or tag == "header" or named:
                inside = any(self.sections[s][1] for s in self._chain(at))
                # the heading above an article's text belongs to it
                apart = apart or ("header" if inside and (tag == "header" or "header" in set(_names(own))) else
                                  "form" if tag == "form" else "named" if tag not in APART and tag != "header" else "tag")
            elif landmark and apart in ("form", "named"):
                apart = ""  # a form or a wrapper around the whole article
        if tag in SECTIONS or landmark:
            self.sections.append((at, landmark))
            at = len(self.sections) - 1
        if tag == "a":
            if self.in_link:
                self._end({"a"}, set(SECTIONS))
            self.in_link += 1
        self.stack.append((tag, apart, at))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        elif tag not in VOID:
            self._end({tag}, set() if tag in BLOCKS or tag in HIDDEN else set(SECTIONS))

    def handle_data(self, data):
        apart = self.stack[-1][1] if self.stack else ""
        if apart != "hidden":
            self.parts.append(data)
            if self.in_link:
                self.linked += len("".join(data.split()))

    # -- state

    def _chain(self, at: int) -> Iterator[int]:
        while at >= 0:
            yield at
            at = self.sections[at][0]

    def _end(self, tags: set, bounds: set) -> None:
        """Close the innermost element of ``tags``, and what is open in it, unless one of ``bounds`` lies between."""
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] in tags:
                self.in_link -= sum(t == "a" for t, _, _ in self.stack[k:])
                del self.stack[k:]
                return
            if self.stack[k][0] in bounds:
                return

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            _, apart, at = self.stack[-1] if self.stack else ("", "", 0)
            heading = any(t in HEADINGS for t, _, _ in self.stack[-4:])
            chars = len(text) - text.count(" ")
            self.lines.append(Line(text, self.tags, min(self.linked, chars), apart, heading, at))
            self.tags = self.linked = 0
        else:
            self.linked = 0

    def read(self, html: str) -> None:
        """Parse a whole page; markup that is cut off at its end is no text."""
        self.feed(html)
        while self.rawdata and self.cdata_elem is None:
            rest = self.rawdata
            if rest[0] != "<":
                self.close()
                break
            to = -1 if rest.startswith("<!--") else rest.find(">", 1)
            if to < 0:
                break
            self.rawdata = ""
            self.feed(rest[to + 1:])
        self.flush()


# ---------------------------------------------------------------- regions

def smoothed(ratios: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """Gaussian smoothing; at the ends the weights that are left count as a whole."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return (np.convolve(ratios, kernel)[radius:radius + len(ratios)]
            / np.convolve(np.ones(len(ratios)), kernel)[radius:radius + len(ratios)])


def threshold(values: np.ndarray) -> float:
    """The border between two clusters: the middle of their means, until it stays."""
    border = values.mean()
    for _ in range(100):
        low, high = values[values < border], values[values >= border]
        if not len(low) or not len(high):
            break
        new = (low.mean() + high.mean()) / 2
        if math.isclose(new, border, rel_tol=1e-9):
            break
        border = new
    return float(border)


def content_lines(lines: list[Line], sections: list[tuple[int, int]]) -> list[int]:
    """Numbers of the lines that are the page's main text, in page order."""
    size = np.array([len(x.text) - x.text.count(" ") for x in lines], float)
    linked = np.array([x.linked for x in lines], float)
    fine = np.array([not x.apart or (x.apart == "header" and x.heading) for x in lines])
    own = np.where(fine, size - linked, 0.0)
    if not own.any():
        return []
    # on a logarithmic scale, or one long paragraph would put all others into the lower cluster
    value = np.log1p(smoothed(own / np.array([max(x.tags, 1) for x in lines])))
    region = (value >= threshold(value)) & (own > 0)

    mass = np.zeros(len(sections))  # text of the regions in each container, nested ones included
    for i in np.flatnonzero(region):
        at = lines[i].path
        while at >= 0:
            mass[at] += own[i]
            at = sections[at][0]
    allowed = _content_containers(sections, mass)

    def inside(at: int) -> bool:
        while at >= 0:
            if at in allowed:
                return True
            at = sections[at][0]
        return False

    bearing = {lines[i].path for i in np.flatnonzero(region)}
    text = fine & ((linked < LINKED * size) | np.array([x.heading for x in lines]))
    marked = {s for s in allowed if sections[s][1]}
    return [i for i, x in enumerate(lines) if text[i] and inside(x.path)
            and (region[i] or marked or x.path in bearing)]


def _content_containers(sections: list[tuple[int, int]], mass: np.ndarray) -> set[int]:
    """The containers whose text is the content: articles, else a main part, else the
    innermost container with most of the regions' text."""
    def below(at, top):
        while at >= 0:
            if at == top:
                return True
            at = sections[at][0]
        return False

    for kind in (1, 2):
        marked = [s for s, (_, k) in enumerate(sections) if k == kind and mass[s] > 0]
        marked = [s for s in marked if not any(s != t and below(s, t) for t in marked)]  # outermost
        if marked:
            most = max(mass[s] for s in marked)
            if kind == 2 or most >= mass[0] * RIVAL:
                return {s for s in marked if mass[s] >= most * RIVAL}
    at = 0
    while True:
        inner = [s for s, (up, _) in enumerate(sections) if up == at and mass[s] >= CONTAINED * mass[0]]
        if not inner:
            return {at}
        at = max(inner, key=lambda s: mass[s])


def main_text(html: str | None) -> str:
    """The blocks of a page's main text, joined by blank lines (none: empty)."""
    page = Lines()
    page.read(html or "")
    return "\n\n".join(page.lines[i].text for i in content_lines(page.lines, page.sections)) if page.lines else ""


# ---------------------------------------------------------------- the operator

def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and its length ``n_chars`` in code points.

    ``text`` is the main text of the whole page: menus, headers, footers, sidebars, notices, adverts, forms,
    scripts, styles, comments and markup are left out, character references decoded, white
    space within a block made one space, blocks joined by an empty line in page order. A null or empty page,
    or one without text, gives an empty text. Markup that is cut off at the end of a page is dropped. Every row and other
    column is kept; the two columns replace input columns of these names. No shuffle.
    """
    @arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in batches:
            yield pa.array([main_text(p.as_py()) for p in some], pa.string())

    (t,) = fresh(pages.columns, "_text")
    found = pages.withColumn(t, run.asNondeterministic()(F.col(html).cast("string")))  # evaluated once
    return found.withColumns({"text": F.col(t), "n_chars": F.length(t).cast("bigint")}).drop(t)
