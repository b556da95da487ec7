"""Main text of web pages from tag ratios.

A page streams through the standard library's HTML parser. Its events make *lines*: the text between block-level tags,
with the number of tags seen since the line before. A line's score is its characters outside links for each tag. What an
element's tag, role, class or id says is a feature of it, no more: inside an element that is marked as boilerplate a score
counts NAMED or STRUCTURAL times; classes and ids are compared whole, and ids of headings and sections name their subject, so they mark
only reader comments. Scores are smoothed with a Gaussian along the page, and a threshold (two-means clustering of the
smoothed scores) tells *content lines* from the others; a marked line must by itself reach what those have on average.

Content lines choose the regions. The innermost element that holds all of them is searched, widened to the main element
around it, and unmarked articles beside it count as well. Of what these hold is given:

* lines of article and main elements, and lines whose container (div, section, cell, ...) holds a content line or that lie
  between content lines: so headings, short paragraphs and the end of a text stay;
* not marked lines that aren't content, nor lines of nothing but links outside of articles, nor articles of nothing but
  links.

Where everything is marked, marks say nothing. No region is left out for its size.

Edge cases: a null or empty page, or one without content, gives the empty string; tags that are never closed and bare
text give what a lenient parser sees; equal pages give equal texts, repeated rows a row each; very long pages are worked on
whole; an empty table gives no rows; other columns are not looked at, keep names those that are passed on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm import common

# Elements of HTML by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
HIDDEN = frozenset("script style noscript template head title iframe object svg math canvas audio video select datalist".split())
BOILERPLATE = frozenset("nav footer aside form button menu dialog search fieldset input textarea label".split())
REGION = frozenset("article main".split())
CONTAINER = REGION | frozenset("html body div section td th center blockquote details dd".split())
#: Elements whose id names their subject.
TITLED = frozenset("h1 h2 h3 h4 h5 h6 section".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Whole classes and ids of reader comments, and those of any boilerplate.
COMMENTS = frozenset("comment comments commentlist comment-list disqus disqus_thread respond replies reply".split())
NAMES = COMMENTS | frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs footer sidebar "
    "aside widget related recommended share sharing social newsletter subscribe subscription signup login popup modal overlay cookie cookies cookie-banner consent "
    "gdpr notice pagination pager toolbar masthead skip site-header site-footer site-nav page-header page-footer main-menu main-nav".split()
)
#: Those that mark an article element itself (others, like a theme's "sidebar", say nothing about it).
OWN_NAMES = COMMENTS | frozenset("ad ads advert advertisement sponsored promo related recommended teaser".split())
#: Closing one of these is implied when a block of its kind opens.
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"}
_SPACES = re.compile(r"\s+")
SIGMA, RADIUS = 1.0, 2
#: What a score counts in elements marked by a name, and in those that are boilerplate by their tag or role.
NAMED, STRUCTURAL = 0.1, 0.02
_WEIGHTS = [math.exp(-(i * i) / (2 * SIGMA * SIGMA)) for i in range(-RADIUS, RADIUS + 1)]


class Line(NamedTuple):
    text: str
    tags: int
    linked: int  # characters inside links
    container: int  # number of the innermost container
    region: int  # number of the innermost article or main element; 0: none
    weight: float  # below 1 if an element around it is marked as boilerplate


class State(NamedTuple):
    tag: str = ""
    hidden: bool = False
    weight: float = 1.0
    container: int = 0
    region: int = 0
    link: bool = False


class Lines(HTMLParser):
    """Collects the lines of a page, and of each container the one around it and its tag."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[State] = [State()]
        self.text: list[str] = []
        self.tags = self.linked = 0
        self.around, self.names_of, self.kept = [-1], [""], [True]

    def line(self) -> None:
        if self.text:
            text = _SPACES.sub(" ", "".join(self.text)).strip()
            self.text.clear()
            if text:
                now = self.open[-1]
                self.lines.append(Line(text, self.tags, min(self.linked, len(text)), now.container, now.region, now.weight))
                self.tags = 0
            self.linked = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.line()
            if tag in CLOSES_P:
                self.close_implied("p", until=BLOCK - {"p"})
            if tag == "li":
                self.close_implied("li", until={"ul", "ol", "menu", "dir"})
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        up = self.open[-1]
        a = {k: (v or "").lower() for k, v in attrs} if attrs else {}
        hidden = up.hidden or tag in HIDDEN or "hidden" in a or "display:none" in a.get("style", "").replace(" ", "")
        weight = min(up.weight, self.marks(tag, a, bool(up.region)))
        container, region = up.container, up.region
        if tag in CONTAINER:
            self.around.append(container)
            self.names_of.append(tag)
            self.kept.append(weight == 1)
            container = len(self.around) - 1
            region = container if tag in REGION else region
        self.open.append(State(tag, hidden, weight, container, region, up.link or tag == "a"))

    @staticmethod
    def marks(tag: str, a: dict[str, str], inside: bool) -> float:
        """What an element's own tag or attributes let scores in it count; inside: in an article or main element."""
        classes, name = set(a.get("class", "").split()), {a.get("id", "").strip()}
        if tag in REGION:
            return NAMED if (classes | name) & OWN_NAMES else 1.0
        if tag in ("html", "body"):
            return 1.0
        if tag in BOILERPLATE or (tag == "header" and not inside) or a.get("role") in ROLES:
            return STRUCTURAL
        titles = (classes & COMMENTS if tag in TITLED - {"section"} else classes & NAMES) or name & (COMMENTS if tag in TITLED else NAMES)
        return NAMED if titles else 1.0

    def close_implied(self, tag: str, until: frozenset | set) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in until:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.line()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                if tag not in BLOCK and any(x.tag in BLOCK for x in self.open[i + 1 :]):
                    return  # a stray inline end tag closes no block
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        if not self.open[-1].hidden:
            self.text.append(data)
            if self.open[-1].link:
                self.linked += len(data)

    def finish(self) -> None:
        self.close()
        self.line()


def smoothed(ratios: list[float]) -> list[float]:
    out = []
    for i in range(len(ratios)):
        total = weight = 0.0
        for d, w in enumerate(_WEIGHTS, i - RADIUS):
            if 0 <= d < len(ratios):
                total += w * ratios[d]
                weight += w
        out.append(total / weight)
    return out


def threshold(values: list[float]) -> float:
    """Where two-means clustering parts the values; below all of them if they are one cluster."""
    lo, hi = min(values), max(values)
    if lo == hi:
        return lo
    for _ in range(20):
        cut = (lo + hi) / 2
        low, high = [v for v in values if v < cut], [v for v in values if v >= cut]
        now = sum(low) / len(low) if low else lo, sum(high) / len(high) if high else hi
        if now == (lo, hi):
            break
        lo, hi = now
    return (lo + hi) / 2


def line_scores(page: Lines) -> list[float]:
    """Characters outside links for each tag, less where marks speak against a line."""
    return [x.weight * (len(x.text) - x.linked) / max(1, x.tags) for x in page.lines]


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.finish()
    lines = page.lines
    if not lines:
        return ""
    if all(x.weight < 1 for x in lines):
        lines[:] = [x._replace(weight=1.0) for x in lines]
        page.kept = [True] * len(page.kept)
    own = line_scores(page)
    scores = smoothed(own)
    cut = threshold(scores)
    high = [s for s in scores if s >= cut]
    usual = sum(high) / len(high)
    content = [s >= cut and (x.weight == 1 or o >= usual) for x, s, o in zip(lines, scores, own, strict=True)]
    if not any(content):
        content = [s >= cut for s in scores]

    def path(c: int) -> list[int]:
        out = [c]
        while page.around[out[-1]] >= 0:
            out.append(page.around[out[-1]])
        return out[::-1]

    held = [path(x.container) for x in lines]
    common = None
    for p, c in zip(held, content, strict=True):
        if c:
            same = p if common is None else [a for a, b in zip(common, p, strict=False) if a == b]
            common = same
    common = common or [0]
    # Widened to the outermost main element around, if there is one.
    roots = {next((c for c in common if page.names_of[c] == "main"), common[-1])}
    with_content = {x.container for x, c in zip(lines, content, strict=True) if c}
    told = {x.region for x, c, o in zip(lines, content, own, strict=True) if x.region and (c or o > 0)}  # articles of more than links
    if any(page.names_of[c] in REGION for c in common):
        roots |= {r for r in told if page.kept[r]}
    first, last = content.index(True), len(lines) - 1 - content[::-1].index(True)
    out = []
    for i, (x, p) in enumerate(zip(lines, held, strict=True)):
        inside = x.region in told if x.region else own[i] > 0 and (x.container in with_content or first <= i <= last)
        if content[i] or (inside and x.weight == 1 and not roots.isdisjoint(p)):
            out.append(x.text)
    return "\n".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(x.as_py()) for x in b.column("_html")]
        kept = [i for i, name in enumerate(b.schema.names) if name != "_html"]
        yield pa.RecordBatch.from_arrays([*(b.column(i) for i in kept), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*(b.schema.names[i] for i in kept), "text", "n_chars"])


def extract_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns in keep, with text and n_chars of each page's main text; narrow."""
    common.ship(pages.sparkSession)
    rows = pages.select(*keep, F.col(html_col).alias("_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_html") + ", text string, n_chars long"
    return rows.mapInArrow(_extract, schema)
