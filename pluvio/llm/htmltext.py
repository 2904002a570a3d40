"""Main text of web pages by a minimum cut over their blocks.

A page is cut into blocks of text at block-level tags. A linear classifier over the words, links and containers of a block gives
the cost of calling it content or boilerplate; these are the capacities from the source and to the sink. Blocks that follow each
other, and blocks of one parent, are tied by capacities that fall with their distance in the DOM. The maximum flow separates
content from boilerplate (see maxflow.py). Rows are worked where they lie.

Names (class, id, role) of boilerplate, and forms, exclude what is below them, but for four cases. One that holds most words of the page
while no main text stands outside it wraps the page and only counts as evidence against its blocks. What follows has-, with- or no- in a name says
what a page has, not what the element is. A name of boilerplate beside one of content only counts against a block, as evidence. And
an <article> or <main> below such a name is content again, with that evidence against it; an <article> in a list of comments, of
related pages or of advertisements is an item of that list and stays out.

A null or empty page has empty text. Broken markup is read as browsers do in the main: unclosed elements end with their parent, an
unfinished tag at the end is dropped, a lone '<' is text. Repeated rows get equal texts.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from pluvio.llm.common import batches, strings, table
from pluvio.llm.maxflow import source_side

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?P<close>>|\Z)"
    r"|<(?P<odd>/?[a-zA-Z][^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr",
}
#: An opening tag of the key ends an open element of these names that has the same parent.
ENDS = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
    "option": {"option"}, "body": {"head"},
}
UNSEEN = {"head", "svg", "math", "object", "audio", "video", "canvas", "map", "datalist"}
AWAY_TAGS = {"nav", "footer", "aside", "form", "button", "select", "fieldset", "dialog", "menu"}
MAIN_TAGS = {"article", "main"}
AWAY_NAMES = {
    "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "footer", "foot", "bottombar", "sidebar", "aside", "rail",
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adbox", "sponsor", "sponsored", "promo", "promotion", "banner",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "toast", "disclaimer",
    "newsletter", "subscribe", "subscription", "signup", "login", "register", "form", "search", "share", "sharing", "social", "follow",
    "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "discussion", "reactions", "related", "recommended",
    "recommendations", "teaser", "teasers", "widget", "widgets", "pagination", "pager", "copyright", "legal", "toolbar", "topbar", "skip", "masthead",
    "complementary", "contentinfo",
}
#: Lists whose items are often marked up as articles.
LIST_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adbox", "sponsor", "sponsored", "promo", "promotion",
    "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "discussion", "reactions", "related", "recommended",
    "recommendations", "teaser", "teasers",
}
#: What follows these in a name is had, or not, by the page; names that end in one of the others tell a state.
HAVING = {"has", "have", "with", "without", "no", "not", "show", "hide"}
STATES = {"open", "closed", "enabled", "disabled", "layout"}
#: Labels of an article's subject.
SUBJECTS = {"category", "tag"}
WRAPS = {"wrap", "wrapper", "container", "row", "grid", "page", "columns"}
LANDMARKS = {"navigation", "complementary", "contentinfo", "search", "banner", "dialog", "alertdialog", "menu", "menubar", "toolbar"}
HEAD_NAMES = {"header", "masthead", "banner"}
MAIN_NAMES = {"article", "content", "main", "post", "entry", "story", "body", "text", "maincontent", "articlebody"}
WRAPPERS = {"html", "body"}


class Element:
    """An element of a page. What it says of its content is found once the whole page is read (see judge)."""

    __slots__ = ("tag", "attrs", "parent", "depth", "solid", "links", "heading", "unseen", "words", "titled", "within", "hint", "best", "away", "doubt", "main")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.depth = parent.depth + 1 if parent else 0
        self.solid = parent.solid if parent and tag in INLINE else self  # the nearest element that is not inline
        self.links = tag == "a" or bool(parent and parent.links)
        self.heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6") or bool(parent and parent.heading)
        self.unseen = tag in UNSEEN or bool(parent and parent.unseen)
        self.words = 0  # words below it that are not in menus, footers or the like
        self.titled = 0  # those below elements named or marked up as main text
        self.within = False  # whether it is below such an element
        self.hint = 0  # -2 away, 0 none, 1 main by name, 2 main by tag
        self.best = 0  # the highest hint of it and what it is in
        self.away = 0  # 0 not, 1 by a name or form, 2 by the name of a list of items, 3 by tag, role or hidden
        self.doubt = False  # a name of boilerplate counts against it
        self.main = False


@dataclass
class Block:
    text: str
    element: Element
    words: int
    linked: int


@lru_cache(4096)
def _names(joined: str, article: bool = False) -> list[list[str]]:
    """The parts of every name of an element that say what it is; of an article, not those of its subject."""
    out = []
    for name in joined.split():
        parts = [p.lower() for p in NAME_PART.findall(name)]
        if len(parts) > 1 and (parts[-1] in STATES or article and parts[0] in SUBJECTS):
            continue
        had = next((k for k, p in enumerate(parts) if p in HAVING), len(parts))
        out.append([*parts, name.lower()] if had == len(parts) else parts[:had])
    return out


def _content_first(parts: list[str]) -> bool:
    """Whether a name is that of a wrapper around content and something else, as content-sidebar-wrap."""
    return parts[0] in MAIN_NAMES and len(parts) > 2 and parts[-2] in WRAPS


@lru_cache(4096)
def _named(joined: str, main: bool) -> tuple[int, int, bool]:
    """hint, away and doubt of an element by its names."""
    compounds = _names(joined)
    names = {p for parts in compounds for p in parts}
    if names & HEAD_NAMES and (main or names & MAIN_NAMES) and not names & (AWAY_NAMES - HEAD_NAMES):
        return 0, 0, False
    away = [parts for parts in compounds if "header" in parts or not AWAY_NAMES.isdisjoint(parts)]
    if not away:
        return (1 if names & MAIN_NAMES else 0), 0, False
    if names & LIST_NAMES:
        return -2, 2, False
    if any(not MAIN_NAMES.isdisjoint(parts) for parts in compounds if parts not in away) or all(map(_content_first, away)):
        return 1, 0, True
    return -2, 1, False


def _joined(attrs: dict[str, str]) -> str:
    return f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '').strip().lower()}" if attrs else ""


def _own(e: Element) -> tuple[int, int, bool]:
    """hint, away and doubt of an element by its tag and names. What it is in is judged already."""
    attrs, tag = e.attrs, e.tag
    away, main = (e.parent.away, e.parent.main) if e.parent else (0, False)
    hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower()
    role = attrs.get("role", "").strip().lower()
    if tag in AWAY_TAGS or hidden:
        return -2, 1 if tag in ("form", "fieldset") and not hidden else 3, False
    if tag == "header":
        return (0, 0, False) if main else (-2, 3, False)
    if tag in MAIN_TAGS or role == "main":
        names = {p for parts in _names(_joined(attrs), True) for p in parts}
        if names & {"comment", "comments", "reply", "ad", "advert", "sponsored", "promo", "teaser", "related"}:
            return -2, 2, False
        return (2, 0, away > 0) if away < (3 if "main" in (tag, role) else 2) else (0, 0, False)
    if tag not in WRAPPERS and attrs:
        hint, own, unsure = _named(_joined(attrs), main)
        return (-2, 3, False) if role in LANDMARKS and (own or unsure) else (hint, own, unsure)
    return 0, 0, False


def _titled(e: Element) -> bool:
    """Whether tag, role or names say main text, whatever it is in."""
    if e.tag in MAIN_TAGS or e.attrs.get("role", "").strip().lower() == "main":
        return True
    return e.tag not in WRAPPERS and bool(e.attrs) and _named(_joined(e.attrs), False)[0] == 1


def judge(elements: list[Element], found: list[Block]) -> None:
    """Set hints of all elements, parents before children. elements: as they were opened.

    An element that is away by its name, or as a form, is only in doubt if it holds most of the page's words and hardly any main text
    stands outside it (a list of items: nine tenths, and none outside): then it wraps the page. Words in menus, footers and the like, and of links, are not counted.
    """
    for block in found:
        block.element.words += block.words - block.linked
    hard = {id(e) for e in elements if e.tag in AWAY_TAGS and e.tag not in ("form", "fieldset") or e.tag in ("header", "a")}
    titled = {id(e) for e in elements if _titled(e)}
    for e in elements:
        e.within = bool(e.parent and (e.parent.within or id(e.parent) in titled))
    for e in reversed(elements):
        if id(e) in hard:
            e.words = e.titled = 0
        if id(e) in titled:
            e.titled = e.words
        if e.parent:
            e.parent.words += e.words
            e.parent.titled += e.titled
    whole = elements[0]
    for e in elements:
        hint, own, unsure = _own(e)
        if own in (1, 2) and hint == -2:
            share, apart = (0.5, 0.1) if own == 1 else (0.9, 0.0)
            outside = whole.titled - (e.words if e.within else e.titled)
            if e.words and e.words >= share * whole.words and outside <= apart * whole.words:
                hint, own, unsure = 0, 0, True
        up = e.parent
        cleared = hint == 2
        e.hint, e.best = hint, max(hint, up.best if up else 0)
        e.away = max(0 if cleared or not up else up.away, own)
        e.doubt = bool(up and up.doubt) or unsure
        e.main = (bool(up and up.main) or hint > 0) and hint != -2


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, each with its element."""
    root = here = Element("#root", {}, None)
    elements, open_ = [root], Counter()  # all elements, and how many of each tag are open
    out: list[Block] = []
    held: list[tuple[str, bool]] = []

    def flush(element: Element) -> None:
        if held:
            text = " ".join(html_lib.unescape("".join(t for t, _ in held)).split())
            if text:
                linked = sum(len(t.split()) for t, link in held if link)
                element = element.solid
                if not element.unseen:
                    out.append(Block(text, element, len(text.split()), linked))
            held.clear()

    def closed(element: Element, tag: str) -> Element:
        """What is open after the end of the innermost element of this tag."""
        while True:
            open_[element.tag] -= 1
            if element.tag == tag:
                return element.parent
            element = element.parent

    at, size = 0, len(page)
    while at < size:
        found = TOKEN.search(page, at)
        end = found.start() if found else size
        if end > at:
            held.append((page[at:end], here.links))
        if not found:
            break
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if found["close"] != ">":
            break
        if found["end"]:
            if not open_[tag]:
                if tag == "p":
                    flush(here)
                continue
            if tag not in INLINE:
                flush(here)
            here = closed(here, tag)
            continue
        if tag == "br" or tag == "hr":
            if tag == "hr":
                flush(here)
            held.append((" ", False))
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            if tag not in ("script", "style", "template"):
                flush(here)
            at = close.end() if close else size
            continue
        if tag not in INLINE:
            flush(here)
            ends = ENDS.get(tag, {"p"})
            up, last = here.solid, None
            while up is not root and up.tag in ends:
                last, up = up, up.parent.solid
            while last is not None and here is not last.parent:
                open_[here.tag] -= 1
                here = here.parent
        attrs = {}
        if found["attrs"] and len(found["attrs"]) > 1:
            attrs = {m[1].lower(): html_lib.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(found["attrs"])}
        if not found["attrs"].endswith("/") or tag not in ("svg", "path", "use"):
            here = Element(tag, attrs, here)
            elements.append(here)
            open_[tag] += 1
    flush(here)
    judge(elements, out)
    return out


#: Weights of the classifier: positive means content.
WEIGHTS = {"start": -0.4, "words": 3.0, "links": -4.0, "sentence": 0.5, "heading": 0.5, "main_tag": 6.0, "main_name": 3.0, "away": -9.0, "doubt": -2.0}
FULL_WORDS = 40
#: Capacity between blocks that follow each other in one parent, and between those of one parent further apart.
FOLLOWING, SIBLING = 1.5, 0.5


def evidence(block: Block) -> float:
    """Log-odds of a block being content."""
    w = WEIGHTS
    score = w["start"] + w["words"] * min(block.words, FULL_WORDS) / FULL_WORDS + w["links"] * min(1.0, block.linked / max(1, block.words))
    score += w["sentence"] * (block.text[-1] in ".!?…:;\"'”»") + w["heading"] * block.element.heading
    if block.element.away:
        return score + w["away"]
    score += w["doubt"] * block.element.doubt
    best = block.element.best
    return score + (w["main_tag"] if best == 2 else w["main_name"] if best == 1 else 0.0)


def dom_steps(a: Element, b: Element) -> int:
    """Steps from one element to the other through their nearest common ancestor."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def label(found: list[Block]) -> list[bool]:
    """Which blocks are content."""
    odds = [evidence(b) for b in found]
    ties: list[tuple[int, int, float]] = []
    last: dict[int, int] = {}
    for k, block in enumerate(found):
        if k:
            ties.append((k - 1, k, FOLLOWING / (1 + dom_steps(found[k - 1].element, block.element))))
        parent = id(block.element.parent)
        if parent in last and last[parent] < k - 1:
            ties.append((last[parent], k, SIBLING))
        last[parent] = k
    return source_side([max(o, 0.0) for o in odds], [max(-o, 0.0) for o in odds], ties)


def main_text(page: str) -> str:
    found = blocks(page)
    return " ".join(b.text for b, keep in zip(found, label(found), strict=True) if keep)


def extract(pages: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """keys, text and n_chars of every page."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [main_text(p) for p in strings(part.column(part.num_columns - 1))]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keys, "text", "n_chars"])

    fields = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    return batches(pages.select(*keys, html), read, f"{fields}, text string, n_chars long")


def op10_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
