"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing and a threshold.

The standard library's parser streams a page's events; no tree is built. Every block element starts a new line, and each line
has its text, its number of tags and the text inside links. What lies in menus, page headers, footers, sidebars, notices,
adverts, forms, scripts, styles, hidden elements and reader comments (by element, role, or class and id names) is no line.
A line's ratio is its text outside links by its tags; the ratios are smoothed with a Gaussian and those above ``SPREAD``
standard deviations of the page's ratios are content. The text is that of the part of the page with most content: an article or
main element, or what lies in none. That an element says so is a prior: its content counts ``PRIOR`` times against what lies in
none. Other parts with at least ``SIBLING`` of the chosen one's content join. Of an element, content lines are taken, and
others with a sign or more for each tag that aren't mostly links, so short paragraphs stay and rows of links and buttons go.
Outside of elements it is the lines from the first content line to the last, with a heading right before them, without lines that
are mostly links.

Character references are decoded, white space in a line becomes one space, lines are joined by a line feed; a line break
element is white space. A null, empty or broken page gives what can be read, at worst an empty text. Rows that share a
page_id, or have none, are read one by one. An empty table gives no rows. Long pages are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import pieces

RADIUS = 1
SPREAD = 0.5
MOST_LINKS = 0.5
PRIOR = 2
SIBLING = 0.25
LEAST_RATIO = 1.0

# HTML elements by their meaning.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template svg canvas iframe object audio video select option button textarea datalist dialog "
    "head title".split()
)
ASIDE = frozenset("nav aside footer form menu".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
REGIONS = frozenset(("article", "main"))
SPACED = frozenset(("br", "td", "th", "img", "wbr"))
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
# Start tags that close an open element of the same group.
CLOSES = {
    "p": {"p"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
# First words of class and id names of what isn't the article; after those that an article may be about only such words may
# follow as name a part of a page.
PARTS = (
    r"([-_]?(ads?|area|articles?|bar|block|box|buttons?|content|container|form|icons?|inner|items?|links?|list|media|nav|outer|panel|"
    r"posts?|section|stories|this|toggle|tools?|widgets?|wrap|wrapper)([-_].*)?|\d*)"
)
NAMES = re.compile(
    r"(ads?|adv|advert\w*|adsense|adslot|bread-?crumbs?|comments?|commentlist|consent|cookies?|disqus|"
    r"disclaimer|footer|gdpr|header|masthead|menu|modal|nav\w*|newsletter|notification|pagination|"
    r"pager|popup|promo\w*|respond|sidebar|signup|"
    r"skyscraper|sponsor\w*|subscribe|subscription|toolbar|topbar)"
    r"([-_].*|\d*|[A-Z].*)?"
    r"|(banner|login|notices?|related|recommend\w*|reply|replies|search|share|sharing|skip|social|teaser|widget)" + PARTS
)
LASTS = re.compile(
    r".*[-_](ads?|advert\w*|banner|comments?|cookies?|footer|menu|nav|navigation|newsletter|notice|popup|promo|related|"
    r"share|sidebar|social|sponsor\w*|widget)"
)
CHOSEN = re.compile(r"(has|with|no|is|not|without)[-_].*")
READERS = re.compile(
    r"(comments?|commentlist|disqus|respond)([-_].*)?|(related|recommend\w*|reply|replies|teaser)" + PARTS + r"|.*[-_](comments?|related)"
)
# End tags that may close what isn't the article; any other end tag inside it closes nothing outside.
OUTER = ASIDE | REGIONS | {"body", "html", "header", "div", "section"}
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Line:
    __slots__ = ("heading", "linked", "parts", "region", "tags")

    def __init__(self, region: int):
        self.parts: list[str] = []
        self.linked, self.tags, self.region, self.heading = 0, 0, region, False


class Lines(HTMLParser):
    """The page's lines, from its events."""

    def __init__(self, forms: bool = True):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.forms = forms
        # Open elements: (tag, kind); kind is "" for neutral, "out" for what isn't the article, "readers" for what others
        # wrote or what points to other pages, "region" for article and main.
        self.open: list[tuple[str, str]] = []
        self.regions: list[int] = []
        self.out = self.links = self.heads = self.found = 0
        self.line: Line | None = None

    def _new(self) -> None:
        self.line = None

    def _kind(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        if tag in REGIONS:
            return "region"
        if tag in SILENT:
            return "out"
        if tag in ASIDE and (self.forms or tag != "form"):
            return "readers" if tag in ("aside", "footer") else "out"
        if tag == "header":
            return "heads" if self.regions else "out"
        if tag in ("html", "body") or not attrs:
            return ""
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return "out"
            if name == "style" and value and HIDDEN.search(value):
                return "out"
            if name == "role" and value and value.strip().lower() in ROLES:
                return "out"
            if name in ("class", "id") and value and tag not in HEADINGS:
                for word in value.split():
                    word = word.lower() if word.isupper() else word
                    if not CHOSEN.fullmatch(word):
                        if READERS.fullmatch(word):
                            return "readers"
                        if NAMES.fullmatch(word) or LASTS.fullmatch(word):
                            return "out"
        return ""

    def _pop(self, to: int) -> None:
        while len(self.open) > to:
            tag, kind = self.open.pop()
            if kind in ("out", "readers"):
                self.out -= 1
            elif kind == "heads":
                self.heads -= 1
            elif kind == "region":
                self.regions.pop()
            if tag == "a":
                self.links -= 1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._new()
        if self.line is not None:
            self.line.tags += 1
            if tag in SPACED:
                self.line.parts.append(" ")
        if tag in VOID:
            return
        if tag == "body":
            self._pop(0)
        if closes := CLOSES.get(tag):
            # An open element of the group ends here, unless a list, table or other block lies between.
            for at in range(len(self.open) - 1, -1, -1):
                name, kind = self.open[at]
                if name in closes:
                    self._pop(at)
                    break
                if name in BLOCK or kind:
                    break
        elif tag in BLOCK:
            for at in range(len(self.open) - 1, -1, -1):
                name, kind = self.open[at]
                if name == "p":
                    self._pop(at)
                    break
                if name in BLOCK or kind:
                    break
        kind = self._kind(tag, attrs)
        if kind == "region" and self.out and not any(k == "readers" for _, k in self.open):
            # An article isn't part of a menu or a form: what is open around it was never closed, or wraps the page.
            self.open = [(t, "" if k == "out" else k) for t, k in self.open]
            self.out = 0
        if kind in ("out", "readers"):
            self.out += 1
            self._new()
        elif kind == "heads":
            self.heads += 1
        elif kind == "region":
            self.found += 1
            self.regions.append(self.found)
        if tag == "a":
            self.links += 1
        self.open.append((tag, kind))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._new()
        elif self.line is not None:
            self.line.tags += 1
            if tag in SPACED:
                self.line.parts.append(" ")
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                if self.open[at][1] in ("out", "readers"):
                    self._new()
                self._pop(at)
                return
            if self.open[at][1] in ("region", "out", "readers") and tag not in OUTER:
                return

    def handle_data(self, data: str) -> None:
        if self.out or not data:
            return
        heading = any(t in HEADINGS for t, _ in self.open[-4:])
        if self.heads and not heading:
            return
        if self.line is None:
            if data.isspace():
                return
            self.line = Line(self.regions[0] if self.regions else 0)
            self.line.tags = 1
            self.line.heading = heading
            self.lines.append(self.line)
        self.line.parts.append(data)
        if self.links:
            self.line.linked += len(data.strip())


def page_lines(html: str, forms: bool = True) -> list[Line]:
    parser, rest = Lines(forms), html
    while rest:
        try:
            parser.feed(rest)
            parser.close()
            break
        except AssertionError:  # a declaration that the parser refuses: go on behind its first two characters
            rest = parser.rawdata[2:]
            parser.rawdata = ""
    return parser.lines


def smoothed(ratios: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """A Gaussian average over ``radius`` lines to each side; the ends are repeated."""
    reach = np.arange(-radius, radius + 1)
    weight = np.exp(-(reach**2) / (2 * radius**2))
    padded = np.pad(ratios, radius, mode="edge")
    return np.convolve(padded, weight / weight.sum(), mode="valid")


def main_text(html: str | None) -> str:
    if not html:
        return ""
    lines = page_lines(html) or page_lines(html, forms=False)
    texts = [" ".join("".join(x.parts).split()) for x in lines]
    lines, texts = [x for x, t in zip(lines, texts) if t], [t for t in texts if t]
    if not lines:
        return ""
    ratios = np.array([max(len(t) - x.linked, 0) / x.tags for x, t in zip(lines, texts)])
    smooth = smoothed(ratios)
    content = smooth >= min(SPREAD * float(np.std(ratios)), float(smooth.max()))
    weights: dict[int, int] = {}
    for x, t, is_content in zip(lines, texts, content):
        weights[x.region] = weights.get(x.region, 0) + (len(t) - x.linked if is_content else 0)
    best = max(weights, key=lambda k: (weights[k] * (PRIOR if k else 1), k != 0, -k))
    joined = {k for k, v in weights.items() if k == best or v and v >= SIBLING * weights[best]}
    plain = [x.region == 0 for x in lines]
    at = np.flatnonzero(content & np.array(plain))
    first, last = (int(at[0]), int(at[-1])) if len(at) else (0, -1)
    while first and lines[first - 1].heading and plain[first - 1]:
        first -= 1
    out = []
    for i, (x, t) in enumerate(zip(lines, texts)):
        written = x.linked <= MOST_LINKS * len(t)
        if x.region == 0:
            taken = first <= i <= last and (x.heading or written)
        else:
            taken = content[i] or x.heading or written and ratios[i] >= LEAST_RATIO
        if taken and x.region in joined:
            out.append(t)
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "html"):
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    kept = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return kept.mapInArrow(run, "page_id long, url string, text string, n_chars long")
