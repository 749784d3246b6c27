"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams a page's tags and texts. Block tags end a line; each line has
its text, its count of tags, its link text and the containers that it stands in. Elements that are
never content (navigation, footers, forms, what is hidden) are passed over. Lines' ratios of text to tags are
smoothed with a Gaussian and clustered by a threshold (their standard deviation); lines above it are
content. The content lines select a region: the landmark (main, article) that holds most of them, or
else the smallest container that holds nearly all. The region's lines, short ones too, are the text,
but for lines that are mostly links: those stay only in a landmark, among lines above the threshold.

Containers whose class or id says that they are no content (adverts, sidebars, comments, ...) are set
aside before, unless they are or hold the landmark with most text, or hold most of the page's text that is
no link. Containers of comments are set aside even then, unless nothing else is left.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernel

# HTML's element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose text is never content.
NEVER = frozenset("script style noscript template head title nav aside footer form button select textarea input option dialog iframe object svg canvas audio video menu search map datalist".split())
LANDMARKS = frozenset(("main", "article"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
#: What an open element of the key is closed by.
CLOSED_BY = {"p": BLOCK - {"html", "body"}, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "tbody", "tfoot")), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")), "option": frozenset(("option",))}
# Words of class and id names of containers that are not content. The third list's count outside a landmark only;
# the last has words that make a name say that something is or is not there, not that this is it.
_COMMENTS = "comments?|commentlist|disqus|replies|respond"
_NAMES = (
    "ads?|adverts?|advertisements?|advertising|adsense|adslot|adbox|dfp|banners?|breadcrumbs?|consent|cookies?|footer|footnav|gdpr|login|masthead|menus?|menubar|modal|nav|navbar|navigation|"
    "newsletter|notices?|overlay|pager|pagination|popup|promos?|promoted|recommended|related|reviews|search|searchbox|share|sharing|sidebar|sidenav|signup|skip|social|sponsored|sponsors?|subscribe|"
    "subscription|toolbar|topbar|widgets?"
)
_OUTSIDE = "header|head|alert|aside|tags|meta|top|bottom"
_SAYS = "no|non|not|without|with|has|have|had|hide|hides|hidden|show|shows|is|category|cat|tag|type|format|supports|layout"
_NAMED = re.compile(rf"(?:^|[\s_-])(?:(?P<comments>{_COMMENTS})|(?P<names>{_NAMES})|(?P<outside>{_OUTSIDE}))(?:$|[\s_-])", re.IGNORECASE)
_SAID = re.compile(rf"(?:{_SAYS})[_-]", re.IGNORECASE)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)

#: Elements whose content is raw text to browsers: no comment opens in them.
RAW = ("title", "textarea", "iframe", "noembed", "noframes", "noscript", "xmp")
#: How a comment ends, at once or later.
_EMPTY, _ENDED = re.compile("-?>"), re.compile(r"--(?:\s*|!)>")

#: Standard deviation, in lines, of the smoothing.
SIGMA = 1.0
#: Share of the content that the smallest container must hold where there is no landmark.
MOST = 0.9
#: Share of a line's text that makes it a line of links.
LINKS = 0.6

#: Elements that stand inside a line, and cannot be containers of lines.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: What a container's name says: nothing, that it is no content, or that it holds comments.
PLAIN, NAMED, COMMENTS = range(3)

_KERNEL = np.exp(-0.5 * (np.arange(-3, 4) / SIGMA) ** 2)
_KERNEL /= _KERNEL.sum()


class _Lines(HTMLParser):
    """Collects (text, tags, link characters, container) of each line that is not passed over.

    Every tag costs a constant time, taken over the page: each open element is closed once.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int]] = [("", False, 0)]  # name, passed over, container
        self.open: Counter[str] = Counter()
        self.blocks: list[int] = []  # where blocks stand in the stack
        # Of containers, which are numbered in page order; 0 is the page.
        self.parents, self.is_landmark, self.in_landmark, self.named = [0], [False], [False], [PLAIN]
        self.lines: list[tuple[str, int, int, int]] = []
        self.text: list[str] = []
        self.tags = self.links = 0
        self.unended = False  # whether a comment was left open, so that none ends after it

    def parse_comment(self, i: int, report: bool = True) -> int:
        """Where a comment ends; one that nothing ends runs to the page's end, as in browsers."""
        match = _EMPTY.match(self.rawdata, i + 4) or (None if self.unended else _ENDED.search(self.rawdata, i + 4))
        if match:
            return match.end()
        self.unended = True
        if any(self.open[name] for name in RAW):
            self.handle_data("<!--")
            return i + 4
        return len(self.rawdata)

    def end_line(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.lines.append((text, self.tags, self.links, self.stack[-1][2]))
                self.tags = 0
            self.text = []
        self.links = 0

    def handle_starttag(self, name: str, attrs: list[tuple[str, str | None]]) -> None:
        block = name in BLOCK
        if block:
            if self.blocks:  # an end tag that may be left out
                open_ = self.stack[self.blocks[-1]][0]
                if open_ in CLOSED_BY and name in CLOSED_BY[open_]:
                    self._close(self.blocks[-1])
            self.end_line()
        self.tags += 1
        if name in VOID:
            if name in ("br", "hr", "img", "wbr"):
                self.text.append("" if name == "wbr" else " ")
            return
        _, aside, container = self.stack[-1]
        inside = self.in_landmark[container]
        aside = aside or name in NEVER or (name == "header" and not inside) or (name not in ("html", "body") and self._hidden(attrs))
        named = PLAIN if aside or name in ("html", "body") else self._named(attrs, inside)
        if named and name in INLINE:
            aside, named = True, PLAIN
        if named and not block:
            self.end_line()
        if named or (block and name not in ("p", "li", "dt", "dd", "tr", "td", "th")):
            self.parents.append(container)
            self.is_landmark.append(name in LANDMARKS or any(k == "role" and v in LANDMARKS for k, v in attrs))
            self.in_landmark.append(inside or self.is_landmark[-1])
            self.named.append(named)
            container = len(self.parents) - 1
        if block:
            self.blocks.append(len(self.stack))
        self.open[name] += 1
        self.stack.append((name, aside, container))

    @staticmethod
    def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
        return any(
            (key == "role" and value in ROLES) or key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and value and HIDDEN.search(value)) for key, value in attrs
        )

    @staticmethod
    def _named(attrs: list[tuple[str, str | None]], inside: bool) -> int:
        found = PLAIN
        for key, value in attrs:
            if key in ("class", "id") and value:
                for token in value.split():
                    match = None if _SAID.match(token) else _NAMED.search(token)
                    if match and match["comments"]:
                        return COMMENTS
                    if match and (match["names"] or not inside):
                        found = NAMED
        return found

    def handle_endtag(self, name: str) -> None:
        self.tags += 1
        if self.open[name]:
            at = len(self.stack) - 1
            while self.stack[at][0] != name:
                at -= 1
            if name in BLOCK:
                self.end_line()
            self._close(at)
        elif name in BLOCK:
            self.end_line()

    def _close(self, at: int) -> None:
        container = self.stack[at - 1][2]
        if (self.blocks and self.blocks[-1] >= at) or self.stack[-1][2] != container:
            self.end_line()
        while self.blocks and self.blocks[-1] >= at:
            self.blocks.pop()
        while len(self.stack) > at:
            self.open[self.stack.pop()[0]] -= 1

    def handle_data(self, data: str) -> None:
        if not self.stack[-1][1]:
            self.text.append(data)
            if self.open["a"]:
                self.links += len(data.strip())


def _whole(html: str) -> str:
    """The page without a tag that its end cuts off, which is no text."""
    cut = re.compile("<[A-Za-z/!?]").search(html, html.rfind(">") + 1)
    return html[: cut.start()] if cut else html


def _lines(html: str) -> _Lines:
    html = _whole(html)
    try:
        parser = _Lines()
        parser.feed(html)
        parser.close()
    except AssertionError:  # how the parser refuses malformed marked sections
        parser = _Lines()
        parser.feed(html.replace("<![", "&lt;!["))
        parser.close()
    parser.end_line()
    return parser


def content(lines: list[tuple[str, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which lines are content by their smoothed ratio of text to tags, and which stand among such lines."""
    ratio = np.array([(len(text) - links) / max(tags, 1) for text, tags, links, _ in lines])
    smooth = np.convolve(np.pad(ratio, 3, mode="edge"), _KERNEL, mode="valid")
    high = smooth >= min(smooth.std(), smooth.max())
    return high & (ratio > 0), high


def _set_aside(parser: _Lines) -> list[tuple[str, int, int, int]]:
    """The lines without those of containers whose names say that they are no content."""
    n = len(parser.parents)
    if not any(parser.named):
        return parser.lines
    spoken = [False] * n  # whether it is in a container of comments
    for c in range(1, n):
        spoken[c] = spoken[parser.parents[c]] or parser.named[c] == COMMENTS
    plain = [0] * n  # characters outside links and comments in each container, those below included
    for text, _, links, c in parser.lines:
        plain[c] += 0 if spoken[c] else len(text) - links
    for c in range(n - 1, 0, -1):  # a container stands after its parent
        plain[parser.parents[c]] += plain[c]
    needed = [False] * n  # what is or holds the largest landmark
    marked = [c for c in range(n) if parser.is_landmark[c] and parser.named[c] != COMMENTS and plain[c]]
    if marked:
        c = max(marked, key=lambda c: (plain[c], -c))
        while c:
            needed[c] = True
            c = parser.parents[c]
    aside = [False] * n
    for c in range(1, n):
        large = needed[c] or 2 * plain[c] > plain[0]
        aside[c] = spoken[c] or aside[parser.parents[c]] or (parser.named[c] == NAMED and not large)
    return [line for line in parser.lines if not aside[line[3]]] or parser.lines


def extract(html: str | None) -> str:
    """The main text of a page: its blocks in order, joined by newlines; null or no text: empty."""
    if not html:
        return ""
    parser = _lines(html)
    lines = _set_aside(parser)
    if not lines:
        return ""
    chosen, high = content(lines)
    weight = [0] * len(parser.parents)  # characters of content in each container, those below included
    total = [0] * len(parser.parents)
    for (text, _, _, container), is_content in zip(lines, chosen, strict=True):
        weight[container] += len(text) if is_content else 0
        total[container] += len(text)
    for c in range(len(weight) - 1, 0, -1):
        weight[parser.parents[c]] += weight[c]
        total[parser.parents[c]] += total[c]
    marked = [c for c in range(len(weight)) if parser.is_landmark[c] and total[c]]
    if marked:
        region = max(marked, key=lambda c: (weight[c], total[c], -c))
    else:
        # Containers are numbered in page order, so the last that holds enough is a smallest one.
        region = max(c for c in range(len(weight)) if weight[c] >= MOST * weight[0])
    inside = [False] * len(weight)
    for c, parent in enumerate(parser.parents):
        inside[c] = c == region or inside[parent]
    kept = [text for (text, _, links, c), near in zip(lines, high, strict=True) if inside[c] and (links < LINKS * len(text) or (marked and near))]
    return "\n".join(kept)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html).

    The whole html is read (null: empty). Text inside a block has single spaces; blocks are joined by
    newlines; nothing else is dropped or cut. Bytes that are no UTF-8 are read as U+FFFD. Malformed markup is read as browsers do, roughly: end
    tags may lack, stray ones are passed over. Repeated rows and null ids stay, row by row; other
    columns are left out; an empty table gives an empty result.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in kernel.chunks(batch.column(2)):
                texts = [extract(data[a:b].tobytes().decode("utf-8", "replace")) for a, b in zip(offs[:-1], offs[1:], strict=True)]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"]
                )

    return kernel.map_arrow(pages.select("page_id", "url", "html"), run, f"page_id {kind}, url string, text string, n_chars bigint")
