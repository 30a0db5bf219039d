"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams events into lines, one for each block element's text, each with its number of
tags and its share of text in links. Blocks inside menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments
(by element, role, or the words of class and id) are set aside; forms, dialogs, headers and what only the words of a class or id speak against stay candidates
until it is known whether the page has other text. The ratios of text to tags of the other lines are smoothed
with a Gaussian and parted in two clusters by a threshold between their means. Lines of the upper cluster are seeds; the region is the article
or main elements that hold the seeds' text, or else whatever lies from the first seed to the last, and about them as far as a list of links, without
such lists. All lines of the region come out, in page order, short ones too.

Nulls and the like: a null, empty or textless page has an empty text; broken markup is read as the parser recovers it, and declarations that
HTML does not know are comments; unclosed and deeply nested elements cost no more than others; repeated rows come out as often as they came in;
columns of pages beside the first three are left out.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stemma.llm.common import tune

# HTML elements by the way they are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
ASIDE = frozenset("script style noscript template svg math head title nav aside footer iframe object canvas audio video select button textarea menu search noframes applet map".split())
ROLES = frozenset("navigation banner contentinfo complementary search alertdialog alert menu menubar toolbar tablist".split())
#: Elements and roles that are boilerplate unless so many times the text outside suspects lies in one of them.
SOFT = {"form": 1, "dialog": 3}
#: Words of class and id that say what an element is, wherever they stand in a name.
WORDS = frozenset(
    "advert adverts advertisement advertising adsense sponsored cookie cookies consent gdpr newsletter subscribe subscription sidebar sidebars navbar navigation topnav breadcrumb breadcrumbs pagination masthead topbar footer bottombar comments commentlist disqus recommendations login signin signup".split()
)
#: Words that say so only in a name made of such words, of numbers, and of words for parts of a page.
VAGUE = frozenset(
    "ad ads adv banner banners sponsor sponsors promo promos promotion notice notices notification notifications alert alerts popup modal overlay aside widget widgets menu menus nav navi pager header foot comment reply replies respond discussion share sharing social related recommended register search searchbox form hidden skip".split()
)
PARTS = frozenset(
    "a area bar block body bottom box btn button buttons card center col column container content cta css div element entry field fixed group head holder icon icons id info inner item items js large left link links list lists main medium mobile module outer page pane panel placeholder plugin popup position post posts primary right row secondary section site slot small sticky story stories text thread title toggle tools top unit view wrap wrapper zone".split()
)
#: Words that may stand beside the unmistakable ones in a name within an article; beside others these tell what the text is about.
BESIDE = frozenset("all add article banners blog disqus email facebook fb footer free get hide html join latest leave load mail more new notice our page public read reader readers recent save show sign up user users view visitor visitors website wp write your".split())
#: Elements beyond which an open paragraph is not looked for.
SCOPES = ("applet", "button", "caption", "marquee", "object", "table", "td", "template", "th")
CLOSES_P = BLOCK - frozenset("body html head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PART = re.compile(r"[^a-z0-9]+")
_UNSEEN = re.compile(r"display\s*:\s*none")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


#: Element that begins: open elements that it closes, as far as one of STOPS.
LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = ("ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "select", "body")


class Line:
    __slots__ = ("heading", "home", "linked", "suspect", "tags", "text", "top")

    def __init__(self, text: str, tags: int, linked: int, home: int, suspect: int, heading: bool, top: bool):
        self.text, self.tags, self.linked, self.home, self.suspect, self.heading, self.top = text, tags, linked, home, suspect, heading, top


def speaks_against(value: str, within: bool = False) -> bool:
    """Whether the words of a class or id say that an element is no content; within an article, unless other words say what it is about."""
    for name in _CAMEL.sub("-", value).split():
        parts = [x for x in _PART.split(name.lower()) if x]
        known = all(x in WORDS or x in VAGUE or x in PARTS or x in BESIDE or x.isdigit() for x in parts)
        if any(x in WORDS for x in parts) and (not within or known and name.lower() not in ("cookie", "cookies")):
            return True
        if any(x in VAGUE for x in parts) and all(x in VAGUE or x in PARTS or x.isdigit() for x in parts):
            return True
    return False


class Lines(HTMLParser):
    """Collects the lines that are not set aside. home: number of the innermost article or main around a line, or 0; suspect: of the
    outermost element around it whose class or id speaks against it, or 0."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int]] = []  # element, set aside, home, suspect
        self.at: dict[str, list[int]] = {}  # places of open elements by name
        self.lines: list[Line] = []
        self.parents = {0: 0}
        self.buffer: list[str] = []
        self.tags = self.linked = self.suspects = 0
        self.soft: dict[int, str] = {}  # suspects that an element or role alone makes

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                _, _, home, suspect = self.stack[-1] if self.stack else ("", False, 0, 0)
                self.lines.append(Line(text, self.tags, self.linked, home, suspect, any(self.at.get(h) for h in HEADINGS), bool(self.at.get("h1"))))
                self.tags = 0
            self.buffer, self.linked = [], 0

    def within(self) -> bool:
        return bool(self.at.get("article") or self.at.get("main"))

    def aside(self, tag: str, attrs: list) -> bool:
        """Whether the element itself, its role or its being hidden sets it aside."""
        if tag in ASIDE:
            return True
        if tag in ("html", "body", "main"):
            return False
        for name, value in attrs:
            if name == "role" and value and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
                return True
            if name == "style" and value and _UNSEEN.search(value):
                return True
        return False

    def doubtful(self, tag: str, attrs: list) -> str:
        """The element or role that makes it likely that this is no content, if any does."""
        if tag in SOFT or tag == "header" and not self.within():
            return tag
        role = next((value.lower() for name, value in attrs if name == "role" and value), "")
        return role if role in SOFT and tag not in ("html", "body", "main", "article") else ""

    def suspicious(self, tag: str, attrs: list) -> bool:
        within = self.within()
        if tag in ("html", "body", "main") or within and (tag == "p" or tag in HEADINGS):
            return False
        return any(name in ("class", "id") and value and speaks_against(value, within) for name, value in attrs)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.buffer.append(" ")
            return
        if tag in BLOCK:
            self.flush()
            if tag in CLOSES_P and self.at.get("p") and self.at["p"][-1] > max((x[-1] for t in SCOPES if (x := self.at.get(t))), default=-1):
                self.close_to(self.at["p"][-1])
            if tag in LIKE:
                self.close_like(tag)
        if tag in VOID:
            return
        _, off, home, suspect = self.stack[-1] if self.stack else ("", False, 0, 0)
        off = off or self.aside(tag, attrs)
        # A name within a soft suspect counts, but not the other way round.
        if not off and (not suspect or suspect in self.soft) and self.suspicious(tag, attrs):
            self.suspects += 1
            suspect = self.suspects
        elif not off and not suspect and (kind := self.doubtful(tag, attrs)):
            self.suspects += 1
            suspect = self.suspects
            self.soft[suspect] = kind if kind != "header" or self.stack and self.stack[-1][0] != "body" else "page header"
        if tag in ("article", "main") and not off:
            new = len(self.parents)
            self.parents[new] = home
            home = new
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, off, home, suspect))

    def handle_startendtag(self, tag, attrs):
        # A slash does not close an element in HTML.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        if self.at.get(tag):
            self.close_to(self.at[tag][-1])

    def close_to(self, place: int) -> None:
        """Closes the element at a place of the stack and all in it."""
        while len(self.stack) > place:
            self.at[self.stack.pop()[0]].pop()

    def close_like(self, tag: str) -> None:
        stops = (*STOPS, "tr") if tag in ("td", "th") else STOPS
        beyond = max((x[-1] for t in stops if (x := self.at.get(t))), default=-1)
        places = [x[i] for t in LIKE[tag] if (x := self.at.get(t)) and (i := bisect_right(x, beyond)) < len(x)]
        if places:
            self.close_to(min(places))

    def handle_data(self, data):
        if self.stack and self.stack[-1][1]:
            return
        self.buffer.append(data)
        if self.at.get("a"):
            self.linked += len(data)

    def parse_marked_section(self, i, report=1):
        # Sections belong to XML; in HTML they are comments up to the next >.
        return self.parse_bogus_comment(i)


def smoothed(values: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    r = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    padded = np.convolve(values, kernel)[r : r + len(values)]
    return padded / np.convolve(np.ones(len(values)), kernel)[r : r + len(values)]


def threshold(values: np.ndarray) -> float:
    """Between two clusters' means, by alternation from the overall mean; least value where all are alike."""
    t = float(values.mean())
    for _ in range(50):
        low, high = values[values < t], values[values >= t]
        if not len(low) or not len(high):
            return float(values.min())
        new = (float(low.mean()) + float(high.mean())) / 2
        if new == t:
            break
        t = new
    return t


def main_text(html: str) -> str:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    # Text of each suspect. Where nearly all text of a page lies in one that its name made one, the name misleads; of those that an element made one, forms
    # and dialogs come back if most text is theirs.
    size: dict[int, int] = {}
    for x in parser.lines:
        size[x.suspect] = size.get(x.suspect, 0) + len(x.text) - x.linked
    rest = size.get(0, 0)
    back = {0}
    most = max(size, key=size.get, default=0)
    if size and size[most] > (SOFT.get(parser.soft[most], 20) if most in parser.soft else 20) * rest:
        back.add(most)
    # A header that stands in another element than the page's own is the text's if it has a heading, no links, and the page no other first heading.
    if not any(x.top and x.suspect in back for x in parser.lines):
        for k, kind in parser.soft.items():
            mine = [x for x in parser.lines if x.suspect == k] if kind == "header" else []
            if any(x.top for x in mine) and not any(x.linked for x in mine):
                back.add(k)
                break
    lines = [x for x in parser.lines if x.suspect in back]
    if not lines:
        return ""
    ratio = np.array([(len(x.text) - x.linked) / max(1, x.tags) for x in lines])
    smooth = smoothed(ratio)
    seeds = smooth >= threshold(smooth)
    # Text of the seeds, and of all lines but for their links, by article or main element around it, inner ones counting for outer ones.
    weight: dict[int, int] = {}
    prose: dict[int, int] = {}
    total = 0
    for x, seed in zip(lines, seeds, strict=True):
        total += seed * len(x.text)
        home = x.home
        while home:
            weight[home] = weight.get(home, 0) + seed * len(x.text)
            prose[home] = prose.get(home, 0) + len(x.text) - x.linked
            home = parser.parents[home]
    # The element with most; of equals the outer one, and its like beside it.
    best = max(weight, key=lambda h: (weight[h], -h), default=0)
    region = {h for h in weight if parser.parents[h] == parser.parents[best] and prose[h] * 3 >= prose[best]}
    if best and sum(weight[h] for h in region) * 2 >= total:
        known: dict[int, bool] = {0: False}

        def inside(home: int) -> bool:
            path = []
            while home not in known and home not in region:
                path.append(home)
                home = parser.parents[home]
            found = home in region or known[home]
            known.update(dict.fromkeys(path, found))
            return found

        keep = [x for x in lines if inside(x.home)]
    else:
        at = np.flatnonzero(seeds | (ratio >= threshold(smooth)))
        first, last = int(at[0]), int(at[-1])
        plain = [x.linked < 0.5 * len(x.text) for x in lines]
        while first and plain[first - 1]:
            first -= 1
        while last + 1 < len(lines) and plain[last + 1]:
            last += 1
        keep = [x for x in lines[first : last + 1] if x.linked < 0.8 * len(x.text) or x.heading]
    return "\n".join(x.text for x in keep)


def extract(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html, more...) -> page_id, url, text, n_chars."""
    tune(pages.sparkSession)
    key, url, html = pages.columns[:3]
    pages = pages.select(key, url, F.col(html).cast("string").alias(html))
    schema_of = pages.select(key, url, F.col(html).cast("string").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches):
        for b in batches:
            texts = [main_text(x) if x else "" for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[key, url, "text", "n_chars"])

    return pages.mapInArrow(run, schema_of)


