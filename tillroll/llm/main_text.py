"""The main text of a web page by a minimum cut through its blocks.

Each block is a node. What its words, links and enclosing elements say is its terminal
capacity: towards the source for content, towards the sink for boilerplate. Blocks that
follow each other, and blocks of one parent element, are joined by smoothness edges that are
the stronger the closer they stand in the document tree. The cheapest cut labels all blocks.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slices import map_text

# Elements and the words in class, id and role that tell their part.
_SKIPPED = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s"
    " samp small span strike strong sub sup time tt u var wbr br".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_CLOSED_BY_PEER = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
}
_HEAD_TAGS = frozenset("base link meta title style script noscript template".split())
_BOILER_TAGS = frozenset("nav footer aside dialog menu button select head".split())
_LAYOUT_TAGS = frozenset("form fieldset header".split())
#: What is never the article, however long it is.
_BOILER_WORDS = frozenset(
    "ad ads advert advertisement advertising adsense comment comments commentlist consent cookie"
    " cookies copyright disqus gdpr notice notification popup promoted replies reply respond"
    " sponsor sponsored warning".split()
)
#: Parts of a page's layout, which also stand in the names of wrappers around everything.
_LAYOUT_WORDS = frozenset(
    "banner breadcrumb breadcrumbs footer form header login masthead menu modal nav navbar"
    " navigation newsletter pager pagination promo related search share sharing sidebar signup"
    " social subscribe subscription tags teaser toolbar widget".split()
)
_CONTENT_WORDS = frozenset("article content entry main post story text".split())
#: Words before what an element has or has not, or what its text is about.
_ABOUT = frozenset("about category format has hide is no not show tag topic with without".split())

_RAW = "|".join(_SKIPPED)
_QUOTED = r"""\s*+(?:"[^"]*+"|'[^']*+')"""
#: Quotes open a value behind = only, and only if they are closed in the rest of the page; values
#: have any length. A tag ends at its >, or at the next angle bracket if it has a quoted value.
#: Linear: what is read through a value is a tag, and without one a tag holds no angle bracket.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    rf"|<(?P<raw>{_RAW})\b[^<>]*+>.*?(?:</(?P=raw)[^<>]*+(?:>|\Z)|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*+)"
    rf"""(?P<attrs>(?:[^<>"'=]++|["']|=(?!{_QUOTED}))*+"""
    rf"""(?:(?=>)|={_QUOTED}(?:[^<>"'=]++|={_QUOTED}|["'=])*+))(?:>|(?=<)|\Z)"""
    r"|<[!?][^>]*+(?:>|\Z)|</?[a-z][^>]*+\Z",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(
    r"""([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]++))?""",
)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Element:
    """What an element says about its text: `hidden` and `named` text is not the article,
    `layout` text may be, if the element stands around the article or holds long prose."""

    tag: str
    depth: int
    parent: Element | None
    hidden: bool = False
    named: bool = False
    layout: bool = False
    content: bool = False
    prose: int = 0

    @property
    def boiler(self) -> bool:
        return self.hidden or self.named or self.layout


@dataclass
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @cached_property
    def text(self) -> str:
        return " ".join(html.unescape("".join(self.parts)).split())


def _words(value: str) -> set[str]:
    """The words of class names, each up to a word such as `has` or `no`."""
    found = set()
    for name in value.split():
        for word in _NAME_PART.findall(name):
            if word.lower() in _ABOUT:
                break
            found.add(word.lower())
    return found


def _element(tag: str, attrs: str, parent: Element) -> Element:
    """An element with what its own tag and attributes say."""
    made = Element(tag, parent.depth + 1, parent, tag in _BOILER_TAGS, layout=tag in _LAYOUT_TAGS)
    made.content = tag in ("article", "main")
    for name, value in _ATTRIBUTE.findall(attrs) if attrs else ():
        name, value = name.lower(), value.strip("\"'")
        if name in ("hidden", "aria-hidden"):
            made.hidden |= value.lower() != "false"
        elif name == "style":
            made.hidden |= "display:none" in value.replace(" ", "").lower()
        elif name in ("class", "id", "role"):
            words = _words(value)
            if tag not in ("body", "html"):
                made.named |= bool(words & _BOILER_WORDS)
                made.layout |= bool(words & _LAYOUT_WORDS) and tag not in ("article", "main")
            made.content |= bool(words & _CONTENT_WORDS)
    return made


def _sum_prose(elements: list[Element], found: list[Block], counted: Callable) -> None:
    """Characters of sentences without links, for each element with all that it holds."""
    for element in elements:
        element.prose = 0
    for block in found:
        if block.text.count(" ") >= 7 and counted(block.element):
            block.element.prose += max(0, len(block.text) - block.linked)
    for element in reversed(elements):
        if element.parent:
            element.parent.prose += element.prose


def judge(elements: list[Element], found: list[Block]) -> None:
    """Make each element know what it and those around it say. `elements` are in page order.

    The article's wrappers are never boilerplate by their names, nor are forms and headers around
    it. The article is the `article` or `main` with the most prose, those inside something like
    comments only if they hold most of the page's; on a page without one, the innermost element
    with more than half of the prose, and then only layout words of its wrappers are overruled.
    """
    inside = {id(elements[0]): (False, False)}
    for element in elements[1:]:
        hidden, named = inside[id(element.parent)]
        inside[id(element)] = hidden or element.hidden, named or element.named
    _sum_prose(elements, found, lambda x: not inside[id(x)][0])
    candidates = [
        x for x in elements if x.tag in ("article", "main") and x.prose and not inside[id(x)][0]
    ]
    article = max(candidates, key=lambda x: (not inside[id(x)][1], x.prose), default=None)
    if article and inside[id(article)][1] and 2 * article.prose <= elements[0].prose:
        article = None
    kept_words = article is None
    if article is None:
        _sum_prose(elements, found, lambda x: not any(inside[id(x)]))
        most = [x for x in elements if 2 * x.prose > elements[0].prose]
        article = max(most, key=lambda x: x.depth, default=None)
    around = article
    while around:
        around.layout = False
        around.named &= kept_words
        around = around.parent
    for element in elements[1:]:
        above = element.parent
        if element.tag == "header" and above.content:
            element.layout = False
        element.hidden |= above.hidden
        element.named |= above.named
        element.layout |= above.layout
        element.content |= above.content


def blocks(page: str) -> list[Block]:
    """Stretches of text between block-level tags, in page order, with their elements."""
    root = Element("html", 0, None)
    stack, found, links, at = [root], [], 0, 0
    elements, opened = [root], Counter()
    current: Block | None = None

    def add(text: str) -> None:
        nonlocal current
        if not text:
            return
        if current is None:
            if text.isspace():
                return
            current = Block(stack[-1])
            found.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text.strip())

    def close() -> str:
        tag = stack.pop().tag
        opened[tag] -= 1
        return tag

    for mark in _MARKUP.finditer(page):
        add(page[at : mark.start()])
        at = mark.end()
        tag = (mark["tag"] or "").lower()
        if not tag:
            continue
        if tag in _INLINE:
            if tag == "br":
                add(" ")
            elif tag == "a":
                links = 0 if mark["close"] else 1
            continue
        current, links = None, 0
        if mark["close"]:
            if opened[tag]:
                while close() != tag:
                    pass
            continue
        closes = _CLOSED_BY_PEER.get(tag, ())
        if stack[-1].tag in ("p", *closes) and len(stack) > 1:
            close()
        if stack[-1].tag == "head" and tag not in _HEAD_TAGS:
            close()
        if tag in _VOID:
            continue
        element = _element(tag, mark["attrs"], stack[-1])
        elements.append(element)
        if not mark["attrs"].endswith("/"):
            stack.append(element)
            opened[tag] += 1
    add(page[at:])
    found = [block for block in found if block.text]
    judge(elements, found)
    return found


def leaning(block: Block) -> float:
    """Log-odds of content: above 0 a capacity from the source, below 0 one to the sink."""
    text = block.text
    words = text.count(" ") + 1
    score = -1.0 + 1.2 * (words >= 8) + 0.8 * (words >= 25)
    score += 0.5 * text.endswith((".", "!", "?", "…", '"', "”", "»", ":"))
    score -= 3.0 * min(1.0, block.linked / len(text))
    element = block.element
    score += 1.0 * (element.tag in ("p", "blockquote", "pre"))
    score += 0.5 * (element.tag in ("h1", "h2", "h3", "li", "td", "dd", "figcaption"))
    score += 2.5 * element.content
    if element.hidden or element.named:
        return score - 7.0
    # Long prose without links outweighs a name of the layout.
    if words > 25 and not block.linked:
        score += min(2.5, 0.6 * math.log2(words / 25))
    return score - 4.5 * element.layout


def distance(a: Element, b: Element) -> int:
    """Steps between two elements in the document tree."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth and a.parent is not None:
            a = a.parent
        elif b.parent is not None:
            b = b.parent
        else:
            break
        steps += 1
    return steps


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours on the page and between next blocks of one parent."""
    edges, last = [], {}
    for i, block in enumerate(found):
        if i:
            steps = distance(found[i - 1].element, block.element)
            edges.append((i - 1, i, 1.0 / (1 + steps)))
        holder = id(block.element.parent or block.element)
        if holder in last and last[holder] != i - 1:
            edges.append((last[holder], i, 0.5))
        last[holder] = i
    return edges


def source_side(leanings: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Nodes on the source's side of a minimum cut, by maximum flow along shortest paths."""
    size = len(leanings)
    room = [max(0.0, x) for x in leanings]
    drain = [max(0.0, -x) for x in leanings]
    flow: list[dict[int, float]] = [{} for _ in range(size)]
    for a, b, weight in edges:
        flow[a][b] = flow[a].get(b, 0.0) + weight
        flow[b][a] = flow[b].get(a, 0.0) + weight
    tiny = 1e-9
    while True:
        # Nodes by their distance from the source.
        level = [0 if room[i] > tiny else -1 for i in range(size)]
        queue, reached = deque(i for i in range(size) if level[i] == 0), False
        while queue:
            i = queue.popleft()
            reached |= drain[i] > tiny
            for j, left in flow[i].items():
                if left > tiny and level[j] < 0:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not reached:
            return [x >= 0 for x in level]
        untried = [list(x) for x in flow]
        for start in range(size):
            while level[start] == 0 and room[start] > tiny:
                path = [start]
                while path and drain[path[-1]] <= tiny:
                    i = path[-1]
                    while untried[i]:
                        j = untried[i][-1]
                        if level[j] == level[i] + 1 and flow[i][j] > tiny:
                            path.append(j)
                            break
                        untried[i].pop()
                    else:
                        path.pop()
                        if path:
                            untried[path[-1]].pop()
                if not path:
                    break
                steps = list(zip(path, path[1:], strict=False))
                most = min([room[start], drain[path[-1]], *(flow[i][j] for i, j in steps)])
                room[start] -= most
                drain[path[-1]] -= most
                for i, j in steps:
                    flow[i][j] -= most
                    flow[j][i] = flow[j].get(i, 0.0) + most


def main_text(page: str) -> str:
    """Content blocks in page order, joined by an empty line."""
    found = blocks(page)
    kept = source_side([leaning(block) for block in found], smoothness(found))
    return "\n\n".join(block.text for block, keep in zip(found, kept, strict=True) if keep)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars): the registered query.

    One row per row of `pages`, repeated rows included; other columns are not read. A null or
    empty page, and one without content, has an empty text. Pages may have any length; broken
    and truncated markup is read as far as it goes.
    """

    def prepare():
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = [main_text(page) for page in part.column("html").to_pylist()]
            columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])

        return work

    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    kind = rows.schema["page_id"].dataType.simpleString()
    url = rows.schema["url"].dataType.simpleString()
    found = map_text(rows, f"page_id {kind}, url {url}, text string", prepare, "html")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
