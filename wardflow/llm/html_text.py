"""Main text of HTML pages by text-to-tag ratio.

The standard library's parser streams its events over a page in pieces. Block
elements cut the page into lines; each has its text, its tags, the chain of block
elements around it, and whether it lies in a part that is no content by its
meaning (navigation, page header and footer, sidebar, form, script ...). A part whose
class or id is a role that nothing else has (advert, comment-list, cookie-notice, newsletter ...) is
none either, unless it holds the h1, the main element or all the text, which makes it the page's
wrapper. One that only has a word of such parts (notice, discussion, related ...) is
suspected: outside an article it is no core and, where the region is the whole body, no
text; inside the article or region it goes only if many of its characters are links or
its text-to-tag ratio is low. For a paragraph or heading only links tell, and a section
named by one word that begins with a heading isn't suspected. Then, by page:

1. a line's ratio is its characters by its tags (0 in a part without content);
2. a Gaussian kernel smooths the ratios along the page;
3. lines above a threshold, a share of the ratios' standard deviation, are the core;
4. the region is the smallest container that holds the whole core, or the article around
   it, with the articles or sections beside it if it is one; all its lines that lie in no
   part without content are the text, so short paragraphs between long ones stay, and so
   do headings right before it if it has no h1 of its own; a copyright line that
   ends them outside an article goes.

Defined results: null, empty and text-free pages give the empty text; repeated rows
give equal results; broken or cut markup is read as far as it goes; the whole page
is read however long it is, and however many elements are open. The column ``text`` or
``n_chars`` of the input is replaced; others stay.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import free_name, table

FEED = 1 << 16  # characters given to the parser at once
SIGMA, RADIUS = 1.0, 2  # of the kernel, in lines
THRESHOLD = 0.5  # standard deviations of the smoothed ratios

# Fixed sets of HTML element names
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split())
CONTAINER = frozenset("article body center div html main section table td".split())
NO_CONTENT = frozenset("aside button datalist dialog footer form head iframe menu nav noscript object script search select style svg template "
                       "textarea title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SHORT = HEADINGS | {"p"}  # short by nature: their ratio tells nothing
CELL = frozenset("td th br".split())
NO_CONTENT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
LINKED = 1 / 3  # share of characters in links from which a suspected part goes
LOW = 0.6  # share of the page's usual ratio below which a suspected part goes
# Words in class names and ids of parts that may be no content
NO_CONTENT_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
                             "disqus discussion footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
                             "popup promo promoted promotion recommended related replies reply respond responses share sharing sidebar signup skip "
                             "social sponsor sponsored subscribe subscription toolbar widget".split())
# Words that name such a part by themselves, and words that may stand beside them in its name
ROLES = frozenset("ad ads adsbygoogle advert adverts advertisement advertisements advertising breadcrumb breadcrumbs comment commentlist comments "
                  "consent cookie cookies disqus footer gdpr masthead nav navbar newsletter pagination popup sidebar sponsored subscribe".split())
BESIDE = frozenset("area article banner bar block body bottom box container content form footer header inline item label list message notice page "
                   "panel popup post reader readers section signup site slot thread top unit user widget wrap wrapper".split())
NOTICE = re.compile(r"(?:\u00a9|\(c\)|copyright\b)(?=.*(?:\b(?:19|20)\d\d\b|rights reserved)).{0,200}", re.I)


def _no_content(tag: str, attrs: list[tuple[str, str | None]], inside_article: bool) -> bool:
    if tag in NO_CONTENT or tag == "header" and not inside_article:
        return True
    for name, value in attrs:
        if name == "role" and (value or "").strip().lower() in NO_CONTENT_ROLES:
            return True
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
    return False


def _words(name: str) -> list[str]:
    return [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w]


def _role(name: str) -> bool:
    """Whether a class or id is the name of a part without content and nothing more."""
    words = set(_words(name))
    return not ROLES.isdisjoint(words) and words <= ROLES | BESIDE


def _suspected(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[str, bool]:
    """Whether a class or id has a word of parts without content ("" no, "name" only as a section's one-word id, "yes"), and is their role."""
    found, role = "", False
    if tag in ("html", "body", "main"):
        return found, role
    for name, value in attrs:
        if name in ("class", "id") and value:
            is_role = tag not in HEADINGS and any(map(_role, value.split()))
            words = _words(value)
            if is_role or tag != "article" and not NO_CONTENT_WORDS.isdisjoint(words):
                role |= is_role
                if found != "yes":
                    found = "yes" if name == "class" or tag != "section" or len(words) > 1 else "name"
    return found, role


class Line(NamedTuple):
    text: str
    tags: int
    box: int  # innermost open container, or -1
    bad: bool  # in a part without content
    heading: str  # around it, or ""
    part: int  # innermost suspected part around it, or -1
    linked: int  # characters in links


class Open(NamedTuple):
    tag: str
    bad: bool  # without content, or inside such
    box: int  # innermost container, itself included
    heading: str  # outermost heading, itself included
    part: int  # innermost suspected part, itself included


OUTSIDE = Open("", False, -1, "", -1)


class Lines(HTMLParser):
    """Collects the lines of a page. Elements are numbered as they open and know the one around them: nothing is kept for each open element of a line."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[Open] = []
        self.at: defaultdict[str, list[int]] = defaultdict(list)  # places in the stack by name
        self.lines: list[Line] = []
        self.names: list[str] = []
        self.up: list[int] = []  # by number: the innermost container around it
        self.article: list[int] = []  # by number: the outermost article or main around it, itself included
        self.over: dict[int, int] = {}  # of a suspected part: the innermost one around it
        self.suspects: dict[int, tuple[str, bool]] = {}
        self.wraps: set[int] = set()  # suspected parts with the main element directly in them
        self.parts: list[str] = []
        self.tags = 0
        self.link = False
        self.linked = 0

    def top(self) -> Open:
        return self.stack[-1] if self.stack else OUTSIDE

    def cut(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                top = self.top()
                self.lines.append(Line(text, self.tags, top.box, top.bad, top.heading, top.part, self.linked))
            self.parts = []
            self.tags = self.linked = 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in VOID:
            if tag == "hr":
                self.cut()
            elif tag == "br":
                self.parts.append(" ")
            return
        bad = _no_content(tag, attrs, bool(self.at["article"]))
        suspect = _suspected(tag, attrs) if attrs and not bad else ("", False)
        if tag in BLOCK or bad or suspect[0]:
            self.cut()
            if tag in BLOCK:  # a block closes an open paragraph, and an item its sibling
                self._close("p", stop=CONTAINER)
                if tag in ("li", "dt", "dd", "tr"):
                    self._close(tag, stop=("ul", "ol", "dl", "menu", "table"))
        elif tag in CELL:
            self.parts.append(" ")
        if tag == "a":
            self.link = True
        if tag in BLOCK or tag in CONTAINER or bad or suspect[0]:
            self._open(tag, bad, suspect)

    def _open(self, tag: str, bad: bool, suspect: tuple[str, bool]) -> None:
        top, number = self.top(), len(self.names)
        self.names.append(tag)
        self.up.append(top.box)
        outer = self.article[top.box] if top.box >= 0 else -1
        self.article.append(number if outer < 0 and tag in ("article", "main") else outer)
        if suspect[0]:
            self.suspects[number], self.over[number] = suspect, top.part
        if tag == "main":
            self.wraps.add(top.part)
        self.at[tag].append(len(self.stack))
        self.stack.append(Open(tag, bad or top.bad, number if tag in CONTAINER else top.box, top.heading or (tag if tag in HEADINGS else ""),
                               number if suspect[0] else top.part))
        if tag in BLOCK:
            self.tags = 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, tag: str, stop: Iterable[str] = ()) -> None:
        """Close the innermost open ``tag`` and what is open in it, unless it lies beyond one of ``stop``."""
        if not self.at[tag]:
            return
        place = self.at[tag][-1]
        if any(self.at[s] and self.at[s][-1] > place for s in stop):
            return
        self.cut()
        while len(self.stack) > place:
            self.at[self.stack.pop().tag].pop()

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.link = False
        if tag in BLOCK or self.at[tag]:
            self.cut()
            self._close(tag, CONTAINER if tag == "p" else ())
        elif tag in CELL:
            self.parts.append(" ")

    def handle_data(self, data):
        self.parts.append(data)
        if self.link:
            self.linked += len(" ".join(data.split()))


def lines_of(html: str) -> Lines:
    page = Lines()
    for at in range(0, len(html), FEED):
        page.feed(html[at:at + FEED])
    page.close()
    page.cut()
    return page


class Suspects:
    """What the suspected parts of a page hold, and which of them are no content. Outer parts have smaller numbers."""

    def __init__(self, page: Lines, bad: np.ndarray, size: np.ndarray, tags: np.ndarray):
        self.page = page
        first: dict[int, Line] = {}
        sums = {part: np.zeros(4) for part in page.suspects}  # characters, tags, characters in links, lines of the h1
        for i, x in enumerate(page.lines):
            if x.part >= 0 and not bad[i]:
                first.setdefault(x.part, x)
                sums[x.part] += (size[i], tags[i], x.linked, x.heading == "h1")
        wraps = set(page.wraps)
        order = {id(x): i for i, x in enumerate(page.lines)}
        for part in sorted(page.suspects, reverse=True):
            outer = page.over[part]
            if outer >= 0:
                sums[outer] += sums[part]
                if part in wraps:
                    wraps.add(outer)
                if part in first and (outer not in first or order[id(first[part])] < order[id(first[outer])]):
                    first[outer] = first[part]
        by_name = {p for p, (how, _) in page.suspects.items() if how == "name" and p in first and first[p].heading}
        clean = ~bad & np.array([x.part < 0 for x in page.lines])
        usual = float((size[clean] ** 2 / tags[clean]).sum() / size[clean].sum()) if clean.any() else 0.0  # of a character's line
        every = size[~bad].sum()
        self.out: set[int] = set()  # no content
        self.strong: set[int] = set()  # not only short or a section's name, or inside such
        for part in sorted(page.suspects):
            chars, n_tags, linked, h1 = sums[part]
            short, outer = page.names[part] in SHORT, page.over[part]
            if outer in self.strong or not (short or part in by_name):
                self.strong.add(part)
            if outer in self.out:
                self.out.add(part)
            elif part in by_name or not chars:
                continue
            elif page.suspects[part][1] and not h1 and part not in wraps and chars < every:
                self.out.add(part)
            elif page.names[part] != "article" and (linked >= LINKED * chars or not short and chars / n_tags < LOW * usual):
                self.out.add(part)

    def lines(self, parts: set[int]) -> np.ndarray:
        return np.array([x.part in parts for x in self.page.lines])


def _holders(page: Lines, which: np.ndarray) -> np.ndarray:
    """How many of the lines each container holds."""
    n = np.zeros(len(page.names), int)
    for x, yes in zip(page.lines, which, strict=True):
        if yes and x.box >= 0:
            n[x.box] += 1
    for c in range(len(n) - 1, -1, -1):
        if n[c] and page.up[c] >= 0:
            n[page.up[c]] += n[c]
    return n


def _region(page: Lines, core: np.ndarray, apart: np.ndarray) -> tuple[int, np.ndarray]:
    """The container of the core, or the article around it (-1 if none), and which lines lie in it or beside it in its like."""
    whole = np.flatnonzero(_holders(page, core) == core.sum())
    if not len(whole):
        return -1, np.ones(len(core), dtype=bool)
    region = int(whole[-1])  # the innermost opened last
    if page.article[region] >= 0:
        region = page.article[region]
    within = np.zeros(len(page.names), dtype=bool)
    within[region] = True
    if page.names[region] in ("article", "section"):  # its siblings of that kind belong to it
        held = _holders(page, ~apart)
        for c, name in enumerate(page.names):
            if name == page.names[region] and page.up[c] == page.up[region] and held[c]:
                within[c] = True
    for c, outer in enumerate(page.up):
        if outer >= 0 and within[outer]:
            within[c] = True
    return region, np.array([x.box >= 0 and bool(within[x.box]) for x in page.lines])


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = lines_of(html)
    if not page.lines:
        return ""
    size = np.array([len(x.text) for x in page.lines], float)
    tags = np.maximum(1, [x.tags for x in page.lines])
    bad = np.array([x.bad for x in page.lines])
    in_article = np.array([x.box >= 0 and page.article[x.box] >= 0 for x in page.lines])
    apart = np.zeros(len(bad), dtype=bool)  # suspected, and in no article: no core, but text if the region holds them
    suspects = None
    if page.suspects:
        suspects = Suspects(page, bad, size, tags)
        bad = bad | suspects.lines(suspects.out)
        apart = ~bad & ~in_article & np.array([x.part >= 0 for x in page.lines])
        if (bad | apart).all():
            apart[:] = False
    if bad.all():
        return ""
    ratio = np.where(bad | apart, 0.0, size / tags)
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    smooth = np.convolve(np.pad(ratio, RADIUS, mode="edge"), kernel / kernel.sum(), mode="valid")
    core = ~bad & ~apart & (smooth >= THRESHOLD * smooth.std())
    if not core.any():
        core = ~bad & ~apart
    region, within = _region(page, core, apart)
    if suspects and (region < 0 or page.names[region] in ("body", "html")):  # the whole page is no choice of a region: suspected parts go
        bad = bad | apart & suspects.lines(suspects.strong)
    keep = (~bad & within).tolist()
    if not any(k and x.heading == "h1" for k, x in zip(keep, page.lines, strict=True)):
        for i in range(keep.index(True) - 1, -1, -1):
            if not (bad[i] or apart[i] or page.lines[i].heading):
                break
            keep[i] = not bad[i] and not apart[i]
    kept = [i for i, k in enumerate(keep) if k]
    while len(kept) > 1 and not in_article[kept[-1]] and NOTICE.fullmatch(page.lines[kept[-1]].text):
        kept.pop()
    return "\n".join(page.lines[i].text for i in kept)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points)."""

    @F.pandas_udf("text string, n_chars long")
    def run(html: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in html:
            text = [main_text(x if isinstance(x, str) else None) for x in batch]
            yield pd.DataFrame({"text": text, "n_chars": [len(t) for t in text]})

    own = free_name(pages, "page")
    out = pages.withColumn(own, run.asNondeterministic()(F.col(html_col)))
    return out.withColumns({c: F.col(own)[c] for c in ("text", "n_chars")}).drop(own)


def op4_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
