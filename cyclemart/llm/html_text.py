"""Main text of web pages: parser events, text-to-tag ratios, smoothing, threshold clusters.

The standard library's streaming parser turns a page into blocks: runs of text between
block-level tags. What belongs to menus, page headers and footers, sidebars, notices, adverts,
forms, scripts and reader comments (by element, role, class or id) never becomes a block.
Each block has its ratio of characters to tags; links count as tags without characters. The ratios are smoothed by
a Gaussian over neighbouring blocks, and blocks above a threshold in proportion to
the ratios' standard deviation form the content clusters. A cluster selects its whole region (the
article or main element around it, else the nearest section), so short paragraphs and
headings inside the article stay. Where articles exist, other regions go. A class or id name never drops an
article or main element, nor one inside it, unless the page has an article outside such names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Kinds of HTML elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
UNREAD = set(
    "script style noscript template head title nav aside footer form button select textarea input iframe embed "
    "svg annotation annotation-xml canvas audio video dialog menu".split()
)
#: Elements that may stand in a head; any other ends it, as does text.
IN_HEAD = set("head title base link meta style script noscript template".split())
#: Elements that end an open one of their kind, and what bounds the search for it.
ENDS_OPEN = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: Inside an article an id marks only these; elsewhere it is more often the target of a link.
NAMED_BY_ID = set("div ul ol dl".split())
CLOSED_BY_BLOCK = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
REGION = set("article main section div td body".split())
UNREAD_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Words of class and id names that mark what is not the article.
UNREAD_NAMES = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets "
    "cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription signup login "
    "comment comments reply replies respond disqus discussion share sharing social related recommended "
    "footer masthead copyright".split()
)
#: Words that may stand beside those in a name; with any other word (has-sidebar, comments-open) it says something else.
BESIDE = set(
    "site page main top bottom left right primary secondary global header mobile bar box container wrapper wrap inner outer "
    "list area section block item items link links button buttons form icons panel slot unit zone post posts entry article body text title".split()
)
_PART = re.compile(r"[-_:.]+|(?<=[a-z])(?=[0-9])")
_TAG = re.compile(r"<(?:[A-Za-z/!?]|$)")
_COMMENT_END = re.compile(r"--!?>")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    region: int
    in_article: bool
    doubtful: bool = False
    tags: int = 0
    linked: int = 0
    parts: list[str] = field(default_factory=list)


class _Blocks(HTMLParser):
    """Collects blocks from the parser's events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, bool, bool, bool]] = []  # tag, unread, region, in article, named unread, doubtful
        self.depth: Counter[str] = Counter()  # open elements by tag
        self.blocks: list[Block] = []
        self.current: Block | None = None
        self.tags = self.regions = 0

    def _state(self) -> tuple[bool, int, bool, bool, bool]:
        return self.open[-1][1:] if self.open else (False, 0, False, False, False)

    def parse_comment(self, i: int, report: int = 1) -> int:
        """Comments may end in ``--!>`` too."""
        end = _COMMENT_END.search(self.rawdata, i + 2)
        return end.end() if end else -1

    def finish(self) -> None:
        """Ends the page without the tag or comment in which it breaks off, which is what the parser still holds."""
        rest = self.rawdata
        if self.cdata_elem is None and _TAG.match(rest) and (rest.startswith("<!--") or ">" not in rest):
            self.rawdata = ""
        self.close()

    def _cut(self, size: int) -> None:
        """Leave only the first ``size`` open elements."""
        for tag, *_ in self.open[size:]:
            self.depth[tag] -= 1
        del self.open[size:]

    def _end_head(self) -> None:
        if self.open and self.open[-1][0] == "head":
            self._cut(len(self.open) - 1)

    def _end_block(self) -> None:
        self.current = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in IN_HEAD:
            self._end_head()
        if tag in BLOCK:
            self._end_block()
            if any(self.depth[t] for t in CLOSED_BY_BLOCK):  # an unclosed paragraph ends here
                self._close_through(CLOSED_BY_BLOCK)
        if tag in ENDS_OPEN:
            self._end_open(*ENDS_OPEN[tag])
        self.tags += 1
        if tag == "br" and self.current is not None:
            self.current.parts.append(" ")
        if tag in VOID:
            return
        unread, region, in_article, named, doubtful = self._state()
        unread = unread or tag in UNREAD or (tag == "header" and not in_article) or _marked(attrs, tag)
        if tag in ("article", "main") and not in_article:  # names around an article are those of a layout, or of lists of others
            named, doubtful = False, named
        else:
            named = named or _named(attrs, tag, in_article)
        if tag in REGION and not in_article:
            self.regions += 1
            region = self.regions
        self.open.append((tag, unread, region, in_article or tag in ("article", "main"), named, doubtful))
        self.depth[tag] += 1

    def _close_through(self, tags: set[str]) -> None:
        """Ends an open paragraph with the inline elements left open in it, but no section around."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                self._cut(i)
                return
            if self.open[i][0] in BLOCK:
                return

    def _end_open(self, tags: set[str], bounds: set[str]) -> None:
        """Ends an open list item or cell whose end tag was left out."""
        if any(self.depth[t] for t in tags):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in tags:
                    self._cut(i)
                    return
                if self.open[i][0] in bounds:
                    return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._end_block()
        self.tags += 1
        if not self.depth[tag]:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self._cut(i)
                return
            if self.open[i][0] in REGION and tag not in BLOCK:
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._end_head()
        unread, region, in_article, named, doubtful = self._state()
        if unread or named:
            return
        if self.current is None:
            self.current = Block(region, in_article, doubtful, self.tags)
            self.tags = 0
            self.blocks.append(self.current)
        else:
            self.current.tags += self.tags
            self.tags = 0
        self.current.parts.append(data)
        if self.depth["a"]:
            self.current.linked += len(data)


def _marked(attrs: list, tag: str) -> bool:
    if tag in ("html", "body"):
        return False
    for name, value in attrs:
        if not value:
            continue
        if name == "role" and value.lower() in UNREAD_ROLES:
            return True
    return any(name == "hidden" for name, _ in attrs)


def _named(attrs: list, tag: str, in_article: bool) -> bool:
    """Whether a whole class or id name marks what is not the article. Inside one, headings are never
    marked, and a section's id (discussion, notices) names its subject."""
    if tag in ("html", "body") or (in_article and tag in HEADINGS):
        return False
    marks = ("class", "id") if not in_article or tag in NAMED_BY_ID else ("class",)
    for name, value in attrs:
        if name in marks and value:
            for token in value.lower().split():
                parts = {p for p in _PART.split(token) if p and not p.isdigit()}
                if parts & UNREAD_NAMES and parts <= UNREAD_NAMES | BESIDE:
                    return True
    return False


def smoothed(ratios: np.ndarray, radius: int = 1) -> np.ndarray:
    """Gaussian mean over ``radius`` neighbours on each side (standard deviation ``radius``)."""
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / radius) ** 2)
    total = np.convolve(ratios, weights)[radius:radius + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), weights)[radius:radius + len(ratios)]


def main_text(html: str | None, spread: float = 0.5) -> str:
    """The main text; blocks are joined by newlines, white space in a block is one space."""
    if not html:
        return ""
    parser = _Blocks()
    parser.feed(html)
    parser.finish()
    blocks = [(b, _SPACE.sub(" ", "".join(b.parts)).strip()) for b in parser.blocks]
    blocks = [(b, text) for b, text in blocks if text]
    if not blocks:
        return ""
    ratios = smoothed(np.array([max(0, len(text) - b.linked) / (1 + b.tags) for b, text in blocks]))
    content = ratios >= spread * ratios.std()
    chosen = {b.region for (b, _), good in zip(blocks, content, strict=True) if good}
    articles = {b.region for b, _ in blocks if b.in_article and not b.doubtful} or {b.region for b, _ in blocks if b.in_article}
    if articles:
        chosen = chosen & articles or articles
    return "\n".join(text for b, text in blocks if b.region in chosen)


def _extracted(html: str):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(html)
            texts = [main_text(page.as_py()) for page in batch.column(place)]
            kept = [i for i in range(batch.num_columns) if i != place]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [batch.schema.field(i).name for i in kept] + ["text", "n_chars"],
            )

    return extract


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` without its html, with text (empty if there is none) and n_chars (its code points).

    Columns of ``pages`` called text or n_chars are replaced; a null page is empty.
    """
    pages = pages.drop(*[c for c in ("text", "n_chars") if c != html])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name != html)
    return pages.mapInArrow(_extracted(html), f"{schema}, text string, n_chars long" if schema else "text string, n_chars long")
