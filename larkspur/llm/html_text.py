"""Main text of HTML pages from flat text blocks and a decision tree.

A page becomes a flat list of text blocks: what stands between block-level
tags, with its number of words and the share of them in links. A block's
features are those of itself and of its two neighbours: whether it stands in an
element that is never the article (navigation, footer, form, readers' comments,
by tag, role or container), whether in an article or main element, whether it
is a heading, and how much the names of the elements around it and its
neighbours tell (a whole name of a container more than a part of one, or one of
the element that holds the text). A small decision tree, grown from the labelled
table below, says which blocks are text; a name alone decides nothing.

One narrow pass over the pages; the scanner looks at every character once,
whatever the markup. Null and empty pages, and pages without text, give an empty
text. Unclosed and stray tags are taken as browsers do: a tag that the page's
end cuts is dropped, and a quote counts only after an equals sign. Repeated
pages each give a row. Other columns do not matter.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import ready

#: Elements whose content is never shown as text.
HIDDEN = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "title", "textarea", "select", "button", "canvas", "audio", "video", "head", "datalist"}
#: Of those, the ones in which markup is plain text.
RAW = {"script", "style", "title", "textarea", "noscript", "iframe"}
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a new one of the same group closes, up to the list or table around them.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SCOPES = {"ul", "ol", "menu", "dl", "table", "tbody", "thead", "tfoot", "body", "article", "div", "section", "main"}

NEVER = {"nav", "footer", "aside", "menu", "dialog", "search"}
#: Not the article, unless an article or main element stands in them.
FORMS = {"form", "fieldset"}
NEVER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
#: Names of containers that readers' comments stand in.
TALK_NAMES = {"comment", "comments", "disqus", "replies", "respond"}
WEAK_NAMES = TALK_NAMES | set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget related recommended "
    "recommendations share sharing social footer masthead toolbar pagination pager reply discussion search skip".split()
)
#: Names that say so at the start of a longer one too, as in ad-slot.
FIRST_NAMES = {"ad", "ads", "advert", "cookie", "cookies"}
ARTICLE_NAMES = {"article", "post", "entry", "content", "story"}
#: Elements that hold text themselves: a name of theirs says less than a container's.
HOLDERS = set("p li dd dt td th blockquote pre figcaption caption h1 h2 h3 h4 h5 h6 summary".split())
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LETTER = re.compile(r"[a-zA-Z]")
OPEN = re.compile(r"<(?=[a-zA-Z!?])|</")
TAG = re.compile(r"[^\s/>]+")
ATTRIBUTE = re.compile(r"[^\s/>=][^\s/>=]*|=[^\s/>=]*")
BLANK = re.compile(r"[\s/]*")
EQUALS = re.compile(r"\s*=\s*")
PLAIN = re.compile(r"[^\s>]*")


#: Labelled blocks: in an element that is never the article, in an article,
#: heading, words, share of words in links, words and link share of the block
#: before and after; 1: main text. Names: see NAMED.
PLAIN_TABLE = [
    (1, 0, 0, 5, 1.0, 0, 0.0, 4, 1.0, 0), (1, 0, 0, 3, 1.0, 5, 1.0, 4, 1.0, 0), (1, 0, 0, 1, 1.0, 1, 1.0, 1, 1.0, 0),
    (1, 0, 0, 6, 0.0, 1, 1.0, 10, 0.0, 0), (1, 0, 0, 12, 0.0, 2, 1.0, 9, 0.0, 0), (1, 0, 0, 40, 0.0, 60, 0.0, 30, 0.0, 0),
    (1, 0, 0, 70, 0.0, 80, 0.0, 0, 0.0, 0), (1, 0, 0, 25, 0.1, 90, 0.0, 0, 0.0, 0), (1, 1, 0, 18, 0.0, 30, 0.0, 22, 0.0, 0),
    (1, 1, 0, 55, 0.0, 40, 0.0, 60, 0.0, 0), (1, 1, 1, 4, 0.0, 50, 0.0, 20, 0.0, 0), (1, 1, 0, 3, 1.0, 70, 0.0, 3, 1.0, 0),
    (1, 0, 1, 7, 0.0, 2, 1.0, 5, 0.0, 0), (1, 0, 0, 9, 0.5, 0, 0.0, 0, 0.0, 0), (1, 0, 0, 120, 0.0, 3, 1.0, 100, 0.0, 0),
    (0, 1, 1, 10, 0.0, 8, 0.0, 60, 0.0, 1), (0, 1, 0, 60, 0.0, 10, 0.0, 45, 0.0, 1), (0, 1, 0, 3, 0.0, 40, 0.0, 50, 0.0, 1),
    (0, 1, 0, 1, 0.0, 30, 0.0, 0, 0.0, 1), (0, 1, 0, 150, 0.02, 60, 0.0, 90, 0.0, 1), (0, 1, 0, 20, 0.6, 50, 0.0, 50, 0.0, 1),
    (0, 1, 0, 4, 1.0, 30, 0.0, 30, 0.0, 1), (0, 1, 0, 8, 0.0, 5, 1.0, 0, 0.0, 1), (0, 1, 1, 2, 0.0, 0, 0.0, 2, 0.0, 1),
    (0, 1, 0, 35, 0.0, 14, 0.0, 8, 0.0, 1), (0, 1, 1, 5, 0.0, 1, 1.0, 3, 0.0, 1), (0, 1, 0, 90, 0.3, 12, 0.0, 40, 0.1, 1),
    (0, 0, 0, 80, 0.0, 8, 0.0, 70, 0.0, 1), (0, 0, 0, 45, 0.05, 60, 0.0, 80, 0.0, 1), (0, 0, 0, 30, 0.0, 10, 0.0, 40, 0.0, 1),
    (0, 0, 0, 22, 0.1, 60, 0.0, 4, 0.0, 1), (0, 0, 1, 8, 0.0, 3, 1.0, 70, 0.0, 1), (0, 0, 1, 5, 0.0, 60, 0.0, 55, 0.0, 1),
    (0, 0, 0, 12, 0.0, 50, 0.0, 45, 0.0, 1), (0, 0, 0, 7, 0.0, 40, 0.0, 60, 0.0, 1), (0, 0, 0, 16, 0.0, 35, 0.0, 9, 0.0, 1),
    (0, 0, 0, 60, 0.25, 20, 0.0, 45, 0.0, 1), (0, 0, 0, 200, 0.0, 2, 1.0, 5, 0.9, 1), (0, 0, 0, 28, 0.0, 4, 1.0, 3, 1.0, 1),
    (0, 0, 0, 4, 1.0, 3, 1.0, 5, 1.0, 0), (0, 0, 0, 2, 1.0, 60, 0.0, 2, 1.0, 0), (0, 0, 0, 6, 0.8, 5, 1.0, 30, 0.0, 0),
    (0, 0, 0, 3, 0.0, 2, 1.0, 4, 1.0, 0), (0, 0, 0, 5, 0.0, 3, 1.0, 6, 0.0, 0), (0, 0, 0, 9, 0.0, 4, 0.0, 3, 1.0, 0),
    (0, 0, 0, 30, 0.7, 5, 1.0, 8, 1.0, 0), (0, 0, 0, 50, 0.8, 12, 0.9, 20, 1.0, 0), (0, 0, 0, 8, 0.9, 40, 0.0, 6, 1.0, 0),
    (0, 0, 0, 2, 0.0, 0, 0.0, 3, 0.0, 0), (0, 0, 0, 6, 0.3, 8, 0.0, 0, 0.0, 0), (0, 0, 1, 4, 0.0, 6, 0.6, 2, 1.0, 0),
    (0, 1, 0, 60, 0.0, 40, 0.0, 2, 1.0, 1), (0, 1, 0, 15, 0.0, 20, 0.0, 4, 1.0, 1), (0, 1, 0, 90, 0.1, 5, 1.0, 6, 1.0, 1),
    (0, 1, 0, 1, 1.0, 4, 1.0, 3, 1.0, 1), (0, 1, 0, 4, 0.5, 3, 1.0, 2, 1.0, 1), (0, 1, 1, 3, 1.0, 2, 1.0, 30, 0.0, 1),
    (0, 1, 0, 30, 1.0, 30, 1.0, 30, 1.0, 1), (0, 1, 0, 6, 0.9, 0, 0.0, 0, 0.0, 1), (0, 0, 0, 60, 0.0, 2, 1.0, 3, 1.0, 1),
    (0, 0, 0, 45, 0.0, 30, 0.0, 2, 1.0, 1), (0, 0, 0, 110, 0.1, 4, 1.0, 2, 1.0, 1), (0, 0, 0, 35, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 0, 20, 0.0, 0, 0.0, 50, 0.0, 1), (0, 0, 0, 40, 0.9, 30, 0.0, 50, 0.0, 0), (0, 0, 0, 15, 0.9, 60, 0.0, 40, 0.0, 0),
    (1, 1, 0, 60, 0.0, 50, 0.0, 70, 0.0, 0), (1, 1, 0, 1, 0.0, 20, 0.0, 30, 0.0, 0), (1, 0, 0, 200, 0.0, 100, 0.0, 90, 0.0, 0),
    # blocks as in the given pages: lists of links in nav, an advert before the article, paragraphs, a footer
    (1, 0, 0, 1, 1.0, 0, 0.0, 1, 1.0, 0), (1, 0, 0, 1, 1.0, 1, 1.0, 7, 0.0, 0), (0, 1, 1, 7, 0.0, 7, 0.0, 7, 0.0, 1), (0, 1, 0, 3, 0.0, 40, 0.0, 60, 0.0, 1),
    (0, 1, 0, 7, 0.0, 7, 0.0, 30, 0.0, 1), (0, 1, 0, 90, 0.0, 25, 0.0, 6, 0.0, 1), (1, 0, 0, 6, 0.0, 90, 0.0, 0, 0.0, 0), (0, 1, 0, 400, 0.0, 10, 0.0, 12, 0.0, 1),
    # a page of one block or two
    (0, 0, 0, 1, 0.0, 0, 0.0, 0, 0.0, 1), (0, 0, 0, 3, 0.0, 0, 0.0, 0, 0.0, 1), (0, 0, 0, 14, 0.0, 0, 0.0, 0, 0.0, 1), (0, 0, 0, 2, 1.0, 0, 0.0, 0, 0.0, 0),
]

#: Blocks with a telling name around them: 1 if only a part of a name tells or
#: the block's own element has it, 2 if a container's name does; then whether a
#: neighbour stands in such a container.
NAMED = [
    (0, 0, 0, 5, 0.0, 1, 1.0, 60, 0.0, 2, 0, 0), (0, 0, 0, 12, 0.0, 0, 0.0, 60, 0.0, 2, 0, 0), (0, 0, 0, 40, 0.0, 60, 0.0, 30, 0.0, 2, 0, 0), (0, 0, 0, 80, 0.0, 4, 0.0, 70, 0.0, 2, 2, 0),
    (0, 0, 0, 25, 0.1, 90, 0.0, 0, 0.0, 2, 0, 0), (0, 1, 0, 18, 0.0, 30, 0.0, 22, 0.0, 2, 0, 0), (0, 1, 0, 1, 0.0, 40, 0.0, 60, 0.0, 2, 0, 0), (0, 1, 1, 2, 0.0, 60, 0.0, 30, 0.0, 2, 2, 0),
    (0, 0, 0, 3, 1.0, 0, 0.0, 3, 1.0, 2, 2, 0), (0, 0, 0, 9, 0.0, 0, 0.0, 26, 0.0, 2, 2, 0), (0, 0, 0, 26, 0.0, 9, 0.0, 4, 0.0, 2, 2, 0), (0, 1, 0, 90, 0.0, 26, 0.0, 45, 0.0, 2, 2, 0),
    (0, 1, 0, 40, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1), (0, 1, 0, 30, 0.0, 20, 0.0, 50, 0.0, 1, 0, 1), (0, 1, 0, 6, 0.0, 30, 0.0, 40, 0.0, 1, 0, 1), (0, 1, 1, 5, 0.0, 0, 0.0, 60, 0.0, 1, 1, 1),
    (0, 0, 0, 45, 0.0, 20, 0.0, 60, 0.0, 1, 1, 1), (0, 0, 0, 30, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1), (0, 0, 0, 90, 0.1, 3, 1.0, 5, 0.0, 1, 1, 1), (0, 0, 0, 4, 0.0, 3, 1.0, 4, 1.0, 1, 1, 0),
    (0, 0, 0, 2, 1.0, 3, 1.0, 2, 1.0, 1, 1, 0), (0, 1, 1, 6, 0.0, 8, 0.0, 60, 0.0, 0, 2, 1), (0, 1, 0, 50, 0.0, 12, 0.0, 40, 0.0, 0, 2, 1), (0, 0, 0, 60, 0.0, 8, 0.0, 50, 0.0, 0, 2, 1),
    (0, 0, 1, 5, 0.0, 6, 0.0, 60, 0.0, 0, 2, 1), (0, 0, 1, 4, 0.0, 30, 0.0, 80, 0.0, 0, 2, 1), (0, 0, 1, 8, 0.0, 7, 0.0, 25, 0.0, 0, 2, 1), (0, 0, 1, 2, 0.0, 50, 0.0, 40, 0.0, 2, 2, 0),
    (0, 0, 1, 6, 0.0, 1, 1.0, 30, 0.0, 0, 2, 1), (0, 0, 1, 5, 0.0, 1, 1.0, 100, 0.0, 0, 2, 1), (0, 0, 1, 7, 0.0, 40, 0.0, 70, 0.0, 0, 0, 1), (0, 1, 1, 7, 0.0, 7, 0.0, 7, 0.0, 0, 2, 1),
    (0, 1, 0, 1, 0.0, 7, 0.0, 9, 0.0, 0, 0, 1), (0, 1, 0, 3, 0.0, 9, 0.0, 0, 0.0, 0, 0, 1), (0, 1, 0, 4, 0.0, 100, 0.0, 6, 0.0, 0, 0, 1), (0, 1, 0, 2, 0.0, 2, 0.0, 2, 0.0, 0, 0, 1),
    (0, 0, 0, 35, 0.0, 50, 0.0, 12, 0.0, 0, 2, 1), (0, 1, 0, 4, 0.0, 60, 0.0, 12, 0.0, 0, 2, 1), (0, 0, 0, 3, 0.0, 12, 0.0, 0, 0.0, 0, 2, 0), (0, 0, 0, 5, 0.0, 30, 0.0, 6, 0.0, 0, 2, 0),
]

TABLE = [(*row[:-1], 0, 0, row[-1]) for row in PLAIN_TABLE] + NAMED


def grow(rows: list[tuple], depth: int = 8) -> tuple:
    """A tree of (feature, value, tree if at most, tree if above), leaves 0 or
    1, by Gini impurity; of equal splits the first feature and least value."""
    ones = sum(r[-1] for r in rows)
    if not depth or ones in (0, len(rows)):
        return int(2 * ones >= len(rows))
    gini = lambda part: len(part) - sum((sum(r[-1] == c for r in part)) ** 2 for c in (0, 1)) / len(part)
    best = None
    for k in range(len(rows[0]) - 1):
        values = sorted({r[k] for r in rows})
        for a, b in zip(values, values[1:], strict=False):
            cut = (a + b) / 2
            low, high = [r for r in rows if r[k] <= cut], [r for r in rows if r[k] > cut]
            cost = gini(low) + gini(high)
            if best is None or cost < best[0] - 1e-9:
                best = (cost, k, cut, low, high)
    if best is None:
        return int(2 * ones >= len(rows))
    return (best[1], best[2], grow(best[3], depth - 1), grow(best[4], depth - 1))


@lru_cache(1)
def tree() -> tuple:
    return grow(TABLE)


def is_text(features: tuple) -> bool:
    node = tree()
    while isinstance(node, tuple):
        node = node[2] if features[node[0]] <= node[1] else node[3]
    return bool(node)


def telling(name: str) -> int:
    """How much one class or id says that it is not the article: 2 if its last
    word or all of it does, 1 if another word of it does."""
    words = [w.lower() for w in NAME.findall(name)]
    weak = [w in WEAK_NAMES for w in words]
    if not any(weak):
        return 0
    return 2 if weak[-1] or all(weak) or words[0] in FIRST_NAMES else 1


@dataclass(slots=True)
class Element:
    """What an open element says of the blocks in it."""

    tag: str = ""
    never: bool = False
    form: bool = False
    article: bool = False
    hidden: bool = False
    heading: bool = False
    name: int = 0


def opened(tag: str, attributes: list[tuple[str, str]], around: Element) -> Element:
    e = Element(tag, around.never, around.form, around.article, around.hidden or tag in HIDDEN, around.heading or tag in HEADINGS, around.name)
    if tag in ("article", "main"):  # what stands around an article may well name its own sidebar or form
        e.article, e.form, e.name = True, False, 0
    e.never |= tag in NEVER or (tag == "header" and not around.article)
    e.form |= tag in FORMS
    for name, value in attributes:
        if name in ("class", "id") and tag not in ("body", "html"):
            words = value.split()
            level = max(map(telling, words), default=0)
            if level == 2 and tag in HOLDERS:
                level = 1
            e.name = max(e.name, level)
            parts = {w.lower() for w in NAME.findall(value)}
            e.never |= level == 2 and any([p.lower() for p in NAME.findall(w)][-1:] and [p.lower() for p in NAME.findall(w)][-1] in TALK_NAMES for w in words)
            e.article |= bool(parts & ARTICLE_NAMES) and not level
        elif name == "role":
            e.never |= value.lower() in NEVER_ROLES
            e.article |= value.lower() in ("main", "article")
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            e.hidden = True
    return e


def attributes_of(page: str, at: int) -> tuple[list[tuple[str, str]], int, bool]:
    """The attributes from ``at`` on, where the tag ends (-1: the page ends
    before), and whether by />. Every character is looked at once. A quote
    means something only after an equals sign, as in browsers."""
    found = []
    while True:
        begin, at = at, BLANK.match(page, at).end()
        if at >= len(page):
            return found, -1, False
        if page[at] == ">":
            return found, at + 1, page[begin:at].endswith("/")
        m = ATTRIBUTE.match(page, at)
        name, at, value = m[0].lower(), m.end(), ""
        if eq := EQUALS.match(page, at):
            at = eq.end()
            quote = page[at : at + 1]
            if quote in ("'", '"') and quote:
                end = page.find(quote, at + 1)
                if end < 0:
                    return found, -1, False
                value, at = page[at + 1 : end], end + 1
            else:
                value = PLAIN.match(page, at)[0]
                at += len(value)
        if name in ("class", "id", "role", "hidden", "aria-hidden", "style"):
            found.append((name, html.unescape(value)))


class Scanner:
    """One pass over a page; see ``blocks``."""

    def __init__(self, page: str):
        self.page = page
        self.lower = re.sub("[A-Z]+", lambda m: m[0].lower(), page)
        self.out: list = []
        self.stack = [Element()]
        #: Of each tag, and of all scopes, where the open ones stand on the stack.
        self.places: dict[str, list[int]] = defaultdict(list)
        self.text: list[str] = []
        self.linked: list[str] = []
        self.links = 0

    def close(self) -> None:
        if not self.text:
            self.linked.clear()
            return
        words = "".join(self.text).split()
        if words:
            e = self.stack[-1]
            linked = min(len("".join(self.linked).split()), len(words))
            self.out.append((" ".join(words), len(words), linked, e.never or e.form, e.article, e.heading, e.name))
        self.text.clear(), self.linked.clear()

    def add(self, raw: str) -> None:
        if raw and not self.stack[-1].hidden:
            raw = html.unescape(raw) if "&" in raw else raw
            self.text.append(raw)
            if self.links:
                self.linked.append(raw)

    def push(self, e: Element) -> None:
        self.places[e.tag].append(len(self.stack))
        if e.tag in SCOPES:
            self.places["scope"].append(len(self.stack))
        self.stack.append(e)

    def pop_to(self, size: int) -> None:
        while len(self.stack) > size:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            if tag in SCOPES:
                self.places["scope"].pop()

    def last(self, *tags: str) -> int:
        return max((self.places[t][-1] for t in tags if self.places[t]), default=0)

    def end_tag(self, tag: str) -> None:
        if tag == "a":
            self.links = max(0, self.links - 1)
            self.linked.append(" ")
        elif tag in BLOCKS or tag in HIDDEN:
            place = self.places[tag][-1] if self.places[tag] else 0
            if tag in BLOCKS:
                self.close()
            if place:
                self.pop_to(place)

    def start_tag(self, tag: str, attributes: list[tuple[str, str]], alone: bool) -> None:
        if tag == "a":
            self.links += 1
            self.linked.append(" ")
        elif tag == "br":
            self.add(" ")
        elif tag in BLOCKS or tag in HIDDEN:
            if tag in BLOCKS:
                self.close()
                self.links = 0
                if self.stack[-1].tag == "p":
                    self.pop_to(len(self.stack) - 1)
                if tag in CLOSES and (place := self.last(*CLOSES[tag])) > self.last("scope"):
                    self.pop_to(place)
                while tag == "body" and self.stack[-1].hidden:  # an open head ends here
                    self.pop_to(len(self.stack) - 1)
            if tag not in VOID and not (alone and tag not in BLOCKS):
                self.push(opened(tag, attributes, self.stack[-1]))

    def run(self) -> list:
        page, at = self.page, 0
        while True:
            if not (mark := OPEN.search(page, at)):
                break
            begin = mark.start()
            close = mark[0] == "</"
            name = mark.end()
            if not LETTER.match(page, name):
                self.add(page[at:begin])
                mark, end = ("-->", begin + 4) if page.startswith("!--", begin + 1) else ("]]>", begin + 9) if page.startswith("![CDATA[", begin + 1) else (">", begin + 2)
                if mark == "-->" and page.startswith((">", "->"), begin + 4):
                    mark = ">"
                stop = page.find(mark, end)
                at = len(page) if stop < 0 else stop + len(mark)
                continue
            self.add(page[at:begin])
            m = TAG.match(page, name)
            tag = m[0].lower()
            attributes, at, alone = ([], m.end() + 1, False) if page.startswith(">", m.end()) else attributes_of(page, m.end())
            if at < 0:  # the page ends in a tag
                at = len(page)
            elif close:
                self.end_tag(tag)
            elif tag in RAW:
                end = at
                while (end := self.lower.find(f"</{tag}", end)) >= 0 and self.lower[end + 2 + len(tag) : end + 3 + len(tag)] not in (" ", "\t", "\n", "\r", "\f", "/", ">", ""):
                    end += 2
                after = page.find(">", end) if end >= 0 else -1
                at = len(page) if after < 0 else after + 1
            else:
                self.start_tag(tag, attributes, alone)
        self.add(page[at:])
        self.close()
        return self.out


def blocks(page: str) -> list[tuple[str, int, int, bool, bool, bool, int]]:
    """Text, words, words in links, never, article, heading, name of each block."""
    return Scanner(page).run()


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    share = [b[2] / b[1] for b in found]
    kept = []
    for k, (text, words, _, never, article, heading, name) in enumerate(found):
        before = (found[k - 1][1], share[k - 1]) if k else (0, 0.0)
        after = (found[k + 1][1], share[k + 1]) if k + 1 < len(found) else (0, 0.0)
        near = max((found[j][6] for j in (k - 1, k + 1) if 0 <= j < len(found)), default=0)
        if is_text((never, article, heading, words, share[k], *before, *after, name, near)):
            kept.append(text)
    return "\n\n".join(kept)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of each page."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            texts = [main_text(x.as_py()) for x in frame.column("html")]
            yield pa.RecordBatch.from_arrays([frame.column("page_id"), frame.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    ready(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
