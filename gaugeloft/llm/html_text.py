"""Main text of web pages, from parser events and text-to-tag ratios.

The standard parser's events are read once. Block elements cut the page into lines; each line has its text
and the tags met since the one before. The ratio of text to tags, smoothed over neighbouring lines with a
Gaussian, tells content from menus: lines above one standard deviation of the smoothed ratios are clusters
of content. The content region is the article element with the most clustered text, or without one the
deepest container that holds all of it, together with headings, paragraphs and sections that stand beside
it or its parents. Of the region everything stays but what its own markup names as something else.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloft.llm.common import put, text_of, workers

#: Fixed values of HTML: elements without an end tag, and those that start a new line of text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody tfoot thead title tr ul".split()
)
SPACED = frozenset("br td th".split())
CONTAINERS = frozenset("html body div section main article table tbody tr td center form fieldset details".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BESIDE = HEADINGS | {"p", "section", "hgroup"}
#: Never text of an article.
UNSEEN = frozenset("script style noscript template head title svg canvas iframe object select option button textarea input label datalist audio video map".split())
APART = frozenset("nav footer aside form menu dialog search fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar note status".split())
#: Words of class and id names that mark what is no article text.
NAMES = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar sidebars aside nav navbar navigation "
    "menu menus breadcrumb breadcrumbs footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login social share sharing related recommended recommendations comment comments commentlist disqus discussion reply "
    "replies respond responses pagination pager widget widgets copyright form search skip".split()
)
TOP_NAMES = frozenset("header siteheader pageheader".split())
SURROUND = frozenset("html body main article".split())
REMARKS = frozenset("comment comments reply replies related teaser sponsored ad advert promo".split())
#: Words of names that say nothing either way; a name of other words beside a marking one, such as share-price, marks nothing.
NEUTRAL = frozenset(
    "site page main global top bottom left right box boxes bar list lists item items block blocks container wrapper wrap area section inner outer link links slot "
    "unit units button buttons icon icons post posts articles stories content header head title col column row group panel module js primary secondary left right "
    "small large mobile desktop sticky fixed inline area thread count form field input".split()
)
#: Marking words that an article's own container may bear, too: they yield where most of the page's text lies below.
DOUBTFUL = frozenset(
    "form search share sharing social widget widgets notice notices alert banner promo promotion popup modal overlay skip subscribe subscription login signup copyright".split()
)
_parts = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_cut_tag = re.compile(r"<[/!?a-zA-Z][^<>]*\Z")
_hidden = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Marks of an element: none, by its name alone, by a name that may be its article's, for sure; or the top of a page or article.
PLAIN, TOP, DOUBT, MARKED = 0, 1, 2, 3
LIST_STOPS = frozenset("ul ol dl table select menu".split())
LIST_ITEMS = frozenset("li option dt dd tr".split())
SIGMA = 1.0
MOST = 0.5


def _marking(names: str, words: frozenset[str]) -> frozenset[str]:
    """The marking words of class and id names, of names that hold nothing else but neutral words."""
    found: set[str] = set()
    for name in names.split():
        parts = {p.lower() for p in _parts.findall(name)} | ({name.lower()} & words)
        if name.lower() in words or parts and all(p in words or p in NEUTRAL or p.isdigit() for p in parts):
            found |= parts & words
    return frozenset(found)


def _mark(tag: str, attributes: dict[str, str | None]) -> int:
    """Whether an element holds something other than an article's text."""
    if tag in UNSEEN or tag in APART:
        return MARKED
    if attributes:
        if "hidden" in attributes or _hidden.search(attributes.get("style") or "") or (attributes.get("role") or "").lower() in ROLES:
            return MARKED
        names = f"{attributes.get('class') or ''} {attributes.get('id') or ''}"
        if names.strip():
            if found := _marking(names, REMARKS if tag in SURROUND else NAMES):
                return DOUBT if found <= DOUBTFUL else MARKED
            if tag not in SURROUND and _marking(names, TOP_NAMES):
                return TOP
    return TOP if tag == "header" else PLAIN


class Lines(HTMLParser):
    """Collects elements (parent, tag, mark, whether an article) and lines.

    A line has its block element, its pieces of text, each with the inline element that may cut it out, the tags met and
    the letters in links. Open elements are also kept by tag, so that closing one never searches the others.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parents, self.tags, self.marks, self.articles = [-1], ["html"], [PLAIN], [False]
        self.lines: list[tuple[int, list[tuple[int, str]], int, int]] = []
        self.cuts, self.never = [-1], [False]
        self.open = [0]
        self.depths: dict[str, list[int]] = {}
        self.containers, self.stops, self.blocks = [0], [0], [0]
        self.met = self.linked = 0
        self.pieces: list[tuple[int, str]] = []
        self.blank = True
        self.at = 0

    def end_line(self) -> None:
        if not self.blank:
            self.lines.append((self.at, self.pieces, self.met, self.linked))
            self.met = 0
        self.pieces, self.linked, self.blank = [], 0, True

    def enter(self, node: int, tag: str) -> None:
        depth = len(self.open)
        self.open.append(node)
        self.depths.setdefault(tag, []).append(depth)
        for group, of in ((self.containers, CONTAINERS), (self.stops, LIST_STOPS), (self.blocks, BLOCK)):
            if tag in of:
                group.append(depth)

    def leave(self, depth: int) -> None:
        while len(self.open) > depth:
            tag = self.tags[self.open.pop()]
            self.depths[tag].pop()
            for group, of in ((self.containers, CONTAINERS), (self.stops, LIST_STOPS), (self.blocks, BLOCK)):
                if tag in of:
                    group.pop()

    def close_above(self, tag: str, barrier: int) -> None:
        """Closes the innermost open element of a tag, if it lies inside the barrier."""
        depths = self.depths.get(tag)
        if depths and depths[-1] > barrier:
            self.leave(depths[-1])

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.met += 1
        if tag in BLOCK:
            self.end_line()
            if tag not in UNSEEN:
                self.close_above("p", self.containers[-1])
                self.close_above("head", 0)
            if tag in LIST_ITEMS:
                self.close_above(tag, self.stops[-1])
        elif tag in SPACED:
            self.pieces.append((-1, " "))
        if tag in VOID:
            return
        attributes, parent, node = dict(attrs), self.open[-1], len(self.tags)
        self.parents.append(parent)
        self.tags.append(tag)
        self.marks.append(_mark(tag, attributes))
        inline = tag not in BLOCK
        self.never.append(tag in UNSEEN or inline and self.never[parent])
        above = self.cuts[parent] if inline else -1
        self.cuts.append(above if above >= 0 else node if inline and self.marks[node] >= DOUBT else -1)
        self.articles.append(tag in ("article", "main") or attributes.get("role") in ("main", "article") or "articlebody" in (attributes.get("itemprop") or "").lower())
        self.enter(node, tag)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "iframe", "script", "object", "canvas"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.met += 1
        if tag in BLOCK:
            self.end_line()
        elif tag in SPACED:
            self.pieces.append((-1, " "))
        self.close_above(tag, 0)

    def handle_data(self, data: str) -> None:
        node = self.open[-1]
        if self.never[node]:
            return
        if self.blank and not data.isspace():
            self.blank, self.at = False, self.open[self.blocks[-1]]
        self.pieces.append((self.cuts[node], data))
        if self.depths.get("a"):
            self.linked += len(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    radius = int(3 * SIGMA)
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / SIGMA) ** 2)
    return np.convolve(np.pad(ratios, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


def _down(parents: list[int], own: list[bool], reset: set[int] | frozenset[int] = frozenset()) -> list[bool]:
    """For every element whether it or one above it has a trait; elements of ``reset`` start anew without it."""
    out: list[bool] = []
    for node, parent in enumerate(parents):
        out.append(node not in reset and (own[node] or parent >= 0 and out[parent]))
    return out


def _up(parents: list[int], at: list[int], values: list[float]) -> list[float]:
    """Sums of the lines' values over each element and all below it."""
    out = [0.0] * len(parents)
    for node, value in zip(at, values, strict=True):
        out[node] += value
    for node in range(len(parents) - 1, 0, -1):
        out[parents[node]] += out[node]
    return out


def main_text(html: str | None) -> str:
    """Blocks of the content region in page order, one to a line; empty if there are none.

    A tag that the end of the page cuts off is left out. Time grows in proportion to the page, however deeply or
    unclosed its elements lie.
    """
    page = Lines()
    page.feed(_cut_tag.sub("", html or ""))
    page.close()
    page.end_line()
    if not page.lines:
        return ""
    parents, tags, marks = page.parents, page.tags, page.marks
    whole = [" ".join("".join(t for _, t in pieces).split()) for _, pieces, _, _ in page.lines]
    at = [node for node, *_ in page.lines]
    links = [linked for *_, linked in page.lines]
    lengths = np.array([max(0, len(text) - linked) for text, linked in zip(whole, links, strict=True)], dtype=float)
    ratio = smoothed(lengths / np.array([max(1, met) for _, _, met, _ in page.lines]))
    in_cluster = ratio >= min(ratio.std(), ratio.max())
    own = np.where(in_cluster, lengths, 0.0).tolist()

    surely = _down(parents, [m == MARKED for m in marks])
    held = _up(parents, at, [0.0 if surely[n] else x for n, x in zip(at, own, strict=True)])
    # A doubtful name yields where most of the text lies below it.
    marks = [PLAIN if m == DOUBT and held[n] > MOST * held[0] else MARKED if m == DOUBT else m for n, m in enumerate(marks)]
    other = _down(parents, [m == MARKED for m in marks])
    any_mark = _down(parents, [m != PLAIN for m in marks])
    seen = _up(parents, at, lengths.tolist())
    kept = _up(parents, at, [0.0 if any_mark[n] else x for n, x in zip(at, own, strict=True)])

    texts = []
    for (_, pieces, _, _), text in zip(page.lines, whole, strict=True):
        if any(cut >= 0 and marks[cut] == MARKED for cut, _ in pieces):
            text = " ".join("".join(t for cut, t in pieces if cut < 0 or marks[cut] != MARKED).split())
        texts.append(text)

    present = _up(parents, at, [1.0] * len(at))
    found = [n for n, article in enumerate(page.articles) if article and present[n] and not other[n]]
    if found:
        region = max(found, key=lambda n: (kept[n], seen[n], -n))
    else:
        region, children = 0, {}
        for n in range(1, len(parents)):
            if present[n] and tags[n] in CONTAINERS and kept[n]:
                children.setdefault(parents[n], []).append(n)
        while inner := [n for n in children.get(region, ()) if kept[n] == kept[region]]:
            region = inner[0]
    around, node = set(), region
    while node >= 0:
        around.add(node)
        node = parents[node]
    inside = _down(parents, [n == region for n in range(len(parents))])
    below = {
        name: _down(parents, [trait(n) for n in range(len(parents))], around)
        for name, trait in {
            "marked": lambda n: marks[n] == MARKED, "top": lambda n: marks[n] == TOP, "heading": lambda n: tags[n] in HEADINGS,
            "h1": lambda n: tags[n] == "h1", "item": lambda n: tags[n] == "li",
        }.items()
    }
    beside = _down(parents, [parents[n] in around and tags[n] in BESIDE for n in range(len(parents))], around)
    article = page.articles[region] and region > 0
    first = next(i for i, n in enumerate(at) if inside[n])
    out = []
    for i, (n, text, linked) in enumerate(zip(at, texts, links, strict=True)):
        mostly_link = bool(linked) and linked >= len(whole[i]) - 1
        if not inside[n] and (found or mostly_link or not (beside[n] or i < first and below["h1"][n])):
            continue
        menu = linked >= len(whole[i]) - 1 and below["item"][n] and not page.articles[region]
        if text and not below["marked"][n] and (not below["top"][n] or article and below["heading"][n]) and not menu:
            out.append(text)
    return "\n".join(out)


def extract_text(df: DataFrame, html_column: str = "html") -> DataFrame:
    """Adds ``text`` and ``n_chars`` (its code points); input columns of these names are replaced.

    A page that is null, empty or without text gives empty text. Character references are decoded, white
    space within a block becomes one space, blocks follow each other in page order with one line feed
    between. Pages are taken whole and one by one: repeated pages give repeated texts, an empty table
    an empty one. A page is held in memory once as text and once as lines.
    """

    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pages.map(main_text)

    texts = put(workers(df), {"text": extract(text_of(html_column))})
    return put(texts, {"n_chars": F.length("text").cast("bigint")})
