"""Main text of web pages by tag-path ratios.

A page becomes a sequence of text nodes, each with its root-to-leaf tag path. Per path, text length and
punctuation are aggregated; both ratios are smoothed along the page, fused into one score and compared with
its spread. The nodes above it are content. They decide three things: which element holds the article (the deepest one with
nearly all content, or the article or main elements with a good part of it); whether a class that sounds like a menu, an advert
or a comment is one (not if most of the content lies in it); and which runs of bare links are menus (those
without content, where no article element vouches for them). From the article's element every block is kept but for
these and the parts whose tag or role says that they are furniture.

Elements are numbered as they open and paths as they first appear; sums run once over the elements, from the last one up. So time
grows with the page alone, whatever is left open in it. Each page is handled in one piece by a worker; pages
are spread over the cluster as they are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casegauge.llm.common import packed, text_bytes, texts_of, unpacked, with_columns

# fixed values: element names of HTML and usual class names of page furniture
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
          "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
FURNITURE = {"nav", "aside", "footer", "form", "head", "template", "svg", "canvas", "object", "button", "select", "menu", "dialog"} | RAW
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "dialog", "alert", "form"}
CLASSES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
           "cookie", "cookies", "consent", "copyright", "disclaimer", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal",
           "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification", "pagination", "pager", "popup", "promo", "promotion",
           "recommended", "related", "replies", "reply", "respond", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
           "sponsored", "subscribe", "toolbar", "topbar", "widget"}
SAYS_OF_PAGE = {"no", "has", "with", "without"}  # first parts of names that say what stands beside an element
OWN_HEADER = {"article", "entry", "post", "story"}  # first parts of the names of an article's own header
ADVERT = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored"}
DISCUSSION = {"comment", "comments", "disqus", "replies", "reply", "respond"}
BESIDE = ADVERT | DISCUSSION  # may be longer than the article
# Words that a class begins with when its last word only says that it is a box, a list or a side.
BEGINNINGS = {"ad", "ads", "advert", "breadcrumb", "comment", "comments", "cookie", "cookies", "newsletter", "recommended", "related", "share", "sharing",
              "sidebar", "social", "sponsored", "subscribe"}
BOXES = {"area", "articles", "bar", "block", "box", "buttons", "container", "count", "form", "icons", "left", "link", "links", "list", "panel", "popup", "posts",
         "right", "section", "stories", "thread", "wrap", "wrapper"}
ARTICLE = {"article", "main"}
CLOSED_BY_BLOCK = {"p"}
SAME_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"table", "ul", "ol", "dl", "select", "article", "section", "div", "body", "html", "main", "aside", "nav", "footer", "header", "td", "th"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
                    re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")


def _hint(value: str, in_article: bool) -> str | None:
    """The word for furniture that one of the names in a class or id is, ends with, or begins with in front of a box."""
    for name in value.split():
        parts = _WORDS.findall(name)
        if len(parts) > 1 and parts[0] in BEGINNINGS and parts[-1] in BOXES:
            return parts[0]
        if not parts or parts[-1] not in CLASSES or (len(parts) > 1 and parts[0] in SAYS_OF_PAGE):
            continue
        if parts[-1] == "header" and (in_article or (len(parts) > 1 and parts[0] in OWN_HEADER)):
            continue
        return parts[-1]
    return None


def _furniture(tag: str, attributes: str, in_article: bool) -> tuple[bool, str | None]:
    """Whether an element holds page furniture by tag or role, and the word by which its class or id hints at it."""
    if tag in FURNITURE or (tag == "header" and not in_article):
        return True, None
    hint = None
    if not attributes or tag in ("html", "body"):
        return False, None
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value in ROLES):
            return True, None
        if name in ("class", "id") and tag not in ARTICLE and hint is None:
            hint = _hint(value, in_article)
    return False, hint


class _Node:
    """An element: its place among all that were opened, and the number of its tag path."""

    __slots__ = ("tag", "parent", "dropped", "hint", "in_article", "linked", "path", "number")

    def __init__(self, tag: str, parent: _Node | None, attributes: str, path: int, number: int):
        self.tag, self.parent, self.path, self.number = tag, parent, path, number
        self.in_article = parent is not None and (parent.in_article or parent.tag in ARTICLE)
        self.linked = tag == "a" or (parent is not None and parent.linked)
        self.dropped, self.hint = (False, None) if parent is None else (True, None) if parent.dropped else _furniture(tag, attributes, self.in_article)


class _Open:
    """The open elements, with the places of each tag, so that none has to be looked for."""

    def __init__(self, top: _Node):
        self.stack, self.places = [top], defaultdict(list)

    def push(self, node: _Node) -> None:
        self.places[node.tag].append(len(self.stack))
        self.stack.append(node)

    def close(self, names: set[str], scope: set[str]) -> None:
        """Close the innermost element of these names, with all inside it, unless one of the scope stands in between."""
        last = lambda tags: max((self.places[t][-1] for t in tags if self.places[t]), default=0)
        at = last(names)
        if at and at >= last(scope - names):
            for node in reversed(self.stack[at:]):
                self.places[node.tag].pop()
            del self.stack[at:]


class _Page:
    """Elements in the order of their opening, and text nodes in page order: element, number of the block, text."""

    def __init__(self, page: str):
        paths: dict[tuple[int, str], int] = {}
        top = _Node("", None, "", 0, 0)
        self.elements, self.texts = [top], []
        opened, block, at, n = _Open(top), 0, 0, len(page)

        def text(raw: str) -> None:
            if raw and not opened.stack[-1].dropped:
                self.texts.append((opened.stack[-1], block, html.unescape(raw)))

        while at < n:
            m = _TOKEN.search(page, at)
            if m is None:
                text(page[at:])
                break
            text(page[at:m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            inline = tag in INLINE
            if not inline:
                block += 1
            if m[1] or m[4]:
                opened.close({tag}, ARTICLE | {"body"} if tag not in ARTICLE | {"body", "html"} else set())
                continue
            if not inline:
                opened.close(CLOSED_BY_BLOCK, SCOPE)
            if tag in SAME_KIND:
                opened.close(SAME_KIND[tag], SCOPE - {"td", "th"} if tag == "tr" else SCOPE - {tag})
            if tag == "br" or tag in VOID:
                if tag == "br" and self.texts and self.texts[-1][1] == block:
                    text(" ")
                continue
            attributes = m[3] or m[6] or ""
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                at = n if end is None else end.start()
            if attributes.endswith("/") and tag == "svg":
                continue
            around = opened.stack[-1]
            path = paths.setdefault((around.path, tag), len(paths) + 1)
            node = _Node(tag, around, attributes, path, len(self.elements))
            self.elements.append(node)
            opened.push(node)

    def inside(self, picked: Iterable[tuple[_Node, int, str]]) -> list[int]:
        """Characters of some text nodes inside each element."""
        out = [0] * len(self.elements)
        for node, _, t in picked:
            out[node.number] += len(t)
        for e in reversed(self.elements):
            if e.parent is not None:
                out[e.parent.number] += out[e.number]
        return out


def _smooth(x: np.ndarray, width: int = 2) -> np.ndarray:
    weights = np.exp(-np.arange(-width, width + 1) ** 2 / 2.0)
    return np.convolve(np.pad(x, width, mode="edge"), weights / weights.sum(), mode="valid")


def _scores(nodes: list[tuple[_Node, int, str]]) -> np.ndarray:
    """For each text node, the smoothed and fused ratios of its tag path."""
    size, dots, count = Counter(), Counter(), Counter()
    for node, _, t in nodes:
        size[node.path] += len(t)
        dots[node.path] += len(_PUNCTUATION.findall(t))
        count[node.path] += 1
    length = np.array([size[n.path] / count[n.path] for n, _, _ in nodes])
    points = np.array([dots[n.path] / count[n.path] for n, _, _ in nodes])
    return _smooth(length) * _smooth(1.0 + points)


def _content(nodes: list[tuple[_Node, int, str]]) -> list[tuple[_Node, int, str]]:
    """The text nodes whose score reaches the spread of the scores: the content that decides about the page."""
    score = _scores(nodes)
    least = min(score.std(), score.max())
    return [x for x, s in zip(nodes, score) if s >= least]


def _confirmed(page: _Page) -> list[tuple[_Node, int, str]]:
    """The text nodes outside elements that are furniture by their class. Such a hint does not hold for an element
    around the article element, nor (but for adverts and discussions) for one with most of the content and of all text."""
    full = [x for x in page.texts if x[2].strip()]
    if not full or not any(e.hint for e in page.elements):
        return page.texts
    content = _content(full)
    inside, total = page.inside(content), sum(len(t) for _, _, t in content)
    articles = [e for e in page.elements if e.tag in ARTICLE and inside[e.number]]
    every, size = page.inside(full), sum(len(t) for _, _, t in full)
    spared = {e.number for e in page.elements if e.hint and e.hint not in BESIDE and 2 * inside[e.number] > total and 2 * every[e.number] > size}
    e = max(articles, key=lambda a: inside[a.number]) if articles else None
    while e is not None:
        spared.add(e.number)
        e = e.parent
    kept = [True] * len(page.elements)
    for e in page.elements[1:]:
        kept[e.number] = kept[e.parent.number] and (not e.hint or e.number in spared)
    return [x for x in page.texts if kept[x[0].number]]


def _holders(page: _Page, content: list[tuple[_Node, int, str]]) -> set[int]:
    """The elements that hold the article: article or main elements with a good part of the content, else the deepest element
    with nearly all of it."""
    inside, total = page.inside(content), sum(len(t) for _, _, t in content)
    articles = {e.number for e in page.elements if e.tag in ARTICLE and inside[e.number] >= 0.3 * total and inside[e.number]}
    if articles:
        return articles
    best = max((e for e in page.elements if inside[e.number] >= 0.9 * total and e.tag not in INLINE), key=lambda e: e.number)
    if best.tag not in SCOPE and best.parent is not None:  # one paragraph: its neighbours belong to it
        best = best.parent
    return {best.number}


def _menus(blocks: dict[int, list[tuple[_Node, str]]], content: set[int]) -> set[int]:
    """Blocks in runs of two or more that are nothing but links and hold no content."""
    out: set[int] = set()
    run: list[int] = []
    for block, parts in [*blocks.items(), (-1, [])]:
        words = [node for node, t in parts if t.strip()]
        if not words and block >= 0:
            continue
        if words and block not in content and all(node.linked and not node.in_article for node in words):
            run.append(block)
            several = len(run) > 1 or sum(node.tag == "a" for node in words) > 1
            if several:
                out.update(run)
        else:
            run = []
    return out


def main_text(text: str) -> str:
    """The article's blocks, joined by a line end; empty if there are none."""
    page = _Page(text)
    nodes = _confirmed(page)
    full = [x for x in nodes if x[2].strip()]
    if not full:
        return ""
    content = _content(full)
    roots = _holders(page, content)
    within = [False] * len(page.elements)
    for e in page.elements:
        within[e.number] = e.number in roots or (e.parent is not None and within[e.parent.number])
    blocks: dict[int, list[tuple[_Node, str]]] = {}
    for node, block, t in nodes:
        if within[node.number]:
            blocks.setdefault(block, []).append((node, t))
    menus = _menus(blocks, {block for _, block, _ in content})
    lines = (" ".join("".join(t for _, t in parts).split()) for block, parts in blocks.items() if block not in menus)
    return "\n".join(line for line in lines if line)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [main_text(raw.decode("utf-8", "replace")) for raw in texts_of(batch, "html")]
        yield with_columns(batch, ["html"], text=pa.array(out, pa.string()))


def main_texts(pages: DataFrame, html_col: str = "html", carry: Sequence[str] | None = None) -> DataFrame:
    """Every row with `text`, the main text of its page, and `n_chars`, its code points.

    A null, empty or textless page has an empty text; broken markup is read as far as it goes. Repeated rows are
    handled one by one; an empty table gives an empty result. `carry` names the columns passed on (None: all); a
    result column replaces an input column of its name."""
    rows = packed(pages, carry, html=text_bytes(pages[html_col]))
    out = rows.mapInArrow(_extract, rows.select("row", F.lit("").alias("text")).schema)
    return unpacked(out, carry, pages.columns, text=F.col("text"), n_chars=F.char_length("text").cast("long"))
