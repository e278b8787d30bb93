"""Main text of HTML pages by minimum-cut labelling.

A page is cut into blocks. A linear classifier over the block and its containers
gives each block a cost of being called content or boilerplate; these are the
capacities to two terminals. Neighbouring blocks are joined by edges, stronger
the nearer they are in the document tree, as are blocks of one parent. The
minimum cut between the terminals is the cheapest labelling: a doubtful block
goes with its neighbours.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from biomeframe.llm.common import shipped

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt"
    " ruby s samp small span strike strong sub sup time tt u var br wbr img".split()
)
#: Elements without text of the page; the first four end only at their own end tag.
RAW = frozenset("script style textarea title".split())
SILENT = RAW | frozenset(
    "head noscript template svg math iframe object canvas audio video select button datalist".split()
)
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT = frozenset("article main".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())
BAD_WORDS = frozenset(
    "nav navbar navigation navi menu menus submenu sidebar aside footer foot masthead topbar banner"
    " cookie cookies consent gdpr notice notices notification alert ad ads adbox advert adverts"
    " advertisement advertising sponsor sponsored promo promotion comment comments disqus respond"
    " reply replies share sharing social related recommended recommendations breadcrumb breadcrumbs"
    " pagination pager widget widgets popup modal overlay newsletter subscribe subscription signup"
    " login signin search toolbar copyright form hidden skip".split()
)
GOOD_WORDS = frozenset("article content post entry story body text main page".split())
#: Reader comments and adverts, also where they are marked up as articles.
ALIEN_WORDS = frozenset("comment comments ad ads".split())
#: Behind these words, or before those, a name tells of a page's layout, not of its own text.
BEFORE = frozenset("has have with without no not".split())
AFTER = frozenset("open opened closed enabled disabled on off".split())
#: Words that say what an element is only as the last of its name, or before a word for a container.
LAST_ONLY = frozenset("form search alert notice social share skip reply hidden related promo".split())
CONTAINERS = frozenset(
    "area bar block body box button buttons container content group inner item items left list"
    " links message outer panel posts right row section text top bottom wrap wrapper".split()
)
#: Headings of link lists that stand in an article but are no part of it.
LIST_TITLES = frozenset((
    "advertisement", "also read", "comments", "more articles", "more like this", "more stories",
    "most read", "read also", "read more", "recommended", "related", "related articles",
    "related content", "related links", "related posts", "related stories", "related topics",
    "share", "share this", "tags", "you may also like",
))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: The classifier: added up for each block; above 0 speaks for content.
BIAS = 0.3
IN_BOILERPLATE, IN_ARTICLE, IN_GOOD_CLASS = -5.0, 3.0, 1.5
ALL_LINK, LONG, SHORT, FULL_STOP = -3.0, 2.0, -0.3, 0.5
BY_TAG = {"p": 0.5, "h1": 0.4, "h2": 0.4, "h3": 0.4, "li": -0.3}
#: Edge between blocks side by side in one parent; halved for each step further apart.
SIDE_BY_SIDE, ONE_PARENT = 1.0, 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|\S+))?", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Room below this is rounding.
_NOTHING = 1e-12
_NEUTRAL, _GOOD, _ARTICLE, _BAD_CLASS, _BAD = range(5)


def _names(found: dict[str, str]) -> set[str]:
    """Words of the class and the id that may tell what an element is."""
    out = set()
    for name in (found.get("class", "") + " " + found.get("id", "")).split():
        words = [w.lower() for w in _WORD.findall(name)]
        for k, word in enumerate(words):
            after = words[k + 1 :]
            layout = BEFORE.intersection(words[:k]) or after and after[0] in AFTER
            inexact = word in LAST_ONLY and not CONTAINERS.issuperset(after)
            if not layout and not inexact:
                out.add(word)
    return out


class _Element(NamedTuple):
    tag: str
    attributes: str
    parent: int
    depth: int


def _look(tag: str, attributes: str) -> tuple[bool, bool, set[str]]:
    """Whether an element is surely boilerplate, whether it is an article, words of its names."""
    found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    role = found.get("role", "").lower()
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    hidden = hidden or "display:none" in found.get("style", "").replace(" ", "").lower()
    named = set() if tag in ("html", "body") else _names(found)
    return hidden or tag in BOILERPLATE or role in BAD_ROLES, tag in CONTENT or role == "main", named


def _kinds(elements: list[_Element]) -> list[int]:
    """What the text in each element is taken for.

    Names are evidence that the page's structure outweighs: a wrapper that holds an
    article is no sidebar whatever it is called. An article in an article is a
    comment or a teaser, as is one without the headline beside one with it.
    """
    looks: dict[tuple[str, str], tuple[bool, bool, set[str]]] = {}
    seen = []
    for e in elements:
        key = (e.tag, e.attributes)
        if key not in looks:
            looks[key] = _look(*key)
        seen.append(looks[key])
    n = len(elements)
    holds, titled = [False] * n, [False] * n  # an article, the headline
    for k in range(n - 1, 0, -1):
        up = elements[k].parent
        holds[up] = holds[up] or holds[k] or seen[k][1]
        titled[up] = titled[up] or titled[k] or elements[k].tag == "h1"
    led = any(e.tag == "article" and titled[k] for k, e in enumerate(elements))
    out = [_NEUTRAL] * n
    in_article = [False] * n
    for k in range(1, n):
        tag, _, up, _ = elements[k]
        inside, (sure, article, named) = out[up], seen[k]
        in_article[k] = in_article[up] or tag == "article"
        if tag == "form" and holds[k] and sure:
            sure = False  # a form around the whole page
        comment = tag == "article" and (in_article[up] or led and not titled[k])
        if inside == _BAD or sure or comment:
            out[k] = _BAD
        elif named & ALIEN_WORDS and not (titled[k] and (article or holds[k])):
            out[k] = _BAD
        elif article:
            out[k] = _ARTICLE
        elif named & BAD_WORDS and not holds[k]:
            out[k] = _BAD_CLASS
        elif inside == _BAD_CLASS:
            out[k] = inside
        else:
            good = bool(named & GOOD_WORDS)
            if tag == "header" or "header" in named and not holds[k]:
                out[k] = inside if good or inside in (_ARTICLE, _GOOD) else _BAD
            else:
                out[k] = max(inside, _GOOD) if good else inside
    return out


class Block(NamedTuple):
    """A piece of text, its share of linked text, and the element it is in."""

    text: str
    linked: float
    element: int


def parse(html: str) -> tuple[list[Block], list[_Element]]:
    """Blocks with text in page order, and all elements; element 0 is the page."""
    out: list[Block] = []
    elements = [_Element("", "", 0, 0)]
    stack = [0]
    open_tags: Counter[str] = Counter()
    silent, link_depth = 0, 0
    parts: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append(Block(text, min(linked / len(text), 1.0), stack[-1]))
            parts.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if not silent and text:
            parts.append(text)
            if link_depth:
                linked += len(text.strip())

    def close_last() -> str:
        tag = elements[stack.pop()].tag
        open_tags[tag] -= 1
        return tag

    at = 0
    while True:
        found = _TOKEN.search(html, at)
        if not found:
            say(html[at:])
            break
        if found.start() > at:
            say(html[at : found.start()])
        at = found.end()
        close, name, attributes, loose, loose_attributes = found.groups()
        name, attributes = name or loose, attributes or loose_attributes or ""
        if close:
            close = close.lower()
            if close == "a":
                link_depth = 0
            if close in INLINE:
                continue
            if open_tags[close] or close in ("p", "br"):
                flush()
            if open_tags[close]:
                tag = ""
                while tag != close:
                    tag = close_last()
                    silent -= tag in SILENT
                if link_depth > len(stack):
                    link_depth = 0
        elif name:
            name = name.lower()
            if name in INLINE:
                if name == "a":
                    link_depth = len(stack)
                elif name in ("br", "wbr", "img"):
                    say(" " if name != "wbr" else "")
                continue
            flush()
            last = elements[stack[-1]].tag
            if last == "p" or last == name and name in ("li", "dt", "dd", "td", "th", "tr", "option"):
                silent -= close_last() in SILENT
            if name in VOID or attributes.endswith("/") and name in ("svg", "path"):
                continue
            if name in RAW:
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
                continue
            silent += name in SILENT
            elements.append(_Element(name, attributes, stack[-1], len(stack)))
            stack.append(len(elements) - 1)
            open_tags[name] += 1
    flush()
    return out, elements


def scores(blocks: list[Block], elements: list[_Element]) -> list[float]:
    """Of each block; above 0 speaks for content."""
    kinds = _kinds(elements)
    out = []
    under = -1  # the element that holds the heading of a list of links
    for block in blocks:
        e = elements[block.element]
        listed = e.tag == "li" or block.linked > 0.5
        if e.tag in HEADINGS:
            under = e.parent if block.text.lower().rstrip(":") in LIST_TITLES else -1
            listed = True
        elif not listed:
            under = -1
        kind = kinds[block.element]
        out.append(_score(block, e.tag, _BAD if under >= 0 and listed else kind))
    return out


def _score(block: Block, tag: str, kind: int) -> float:
    words = block.text.count(" ") + 1
    score = BIAS + SHORT + LONG * min(words, 40) / 40 + ALL_LINK * block.linked
    score += BY_TAG.get(tag, 0.0) + FULL_STOP * (block.text[-1] in ".!?…:;\"”»")
    return score + {
        _BAD: IN_BOILERPLATE, _BAD_CLASS: IN_BOILERPLATE, _ARTICLE: IN_ARTICLE, _GOOD: IN_GOOD_CLASS
    }.get(kind, 0.0)


def edges(places: list[int], elements: list[_Element]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in the page, and neighbours among one parent's blocks.

    The way between neighbours in the tree crosses only elements opened or closed
    between them, so all ways together are no longer than the page.
    """
    out = []
    last: dict[int, int] = {}
    for k, place in enumerate(places):
        if k:
            a, b, apart = places[k - 1], place, 0
            while a != b:
                apart += 1
                if elements[a].depth >= elements[b].depth:
                    a = elements[a].parent
                else:
                    b = elements[b].parent
            out.append((k - 1, k, SIDE_BY_SIDE * 0.5 ** (max(apart, 2) - 2)))
        parent = elements[place].parent
        if parent in last and last[parent] != k - 1:
            out.append((last[parent], k, ONE_PARENT))
        last[parent] = k
    return out


def min_cut(scores: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Content side of the minimum cut.

    A block whose score outweighs all its edges keeps its own label in every
    minimum cut; it is merged into its terminal first. Ties go to boilerplate.
    """
    n = len(scores)
    weight = [0.0] * n
    for a, b, w in links:
        weight[a] += w
        weight[b] += w
    source, sink = n, n + 1
    node = [source if s > w else sink if -s > w else k for k, (s, w) in enumerate(zip(scores, weight))]
    room: dict[int, dict[int, float]] = {source: {}, sink: {}}

    def add(a: int, b: int, one: float, other: float) -> None:
        if a != b:
            for x, y, w in ((a, b, one), (b, a, other)):
                row = room.setdefault(x, {})
                row[y] = row.get(y, 0.0) + w

    for k, s in enumerate(scores):
        if node[k] == k:
            add(source, k, max(s, 0.0), 0.0)
            add(k, sink, max(-s, 0.0), 0.0)
    for a, b, w in links:
        if {node[a], node[b]} != {source, sink}:
            add(node[a], node[b], w, w)
    # One flow for each set of undecided blocks that hang together.
    content = {source}
    met: set[int] = {source, sink}
    for start in list(room):
        if start in met:
            continue
        met.add(start)
        part = [start]
        for x in part:
            for y in room[x]:
                if y not in met:
                    met.add(y)
                    part.append(y)
        content |= _max_flow(part, room, source, sink)
    return [x in content for x in node]


def _max_flow(part: list[int], room: dict[int, dict[int, float]], source: int, sink: int) -> set[int]:
    """Nodes that the source still reaches after a maximum flow through ``part``.

    In each phase a search from the sink gives all distances, then paths of just
    that length are filled, none of the edges being looked at twice in vain.
    """
    out = [x for x in part if source in room[x]]
    while True:
        far = {sink: 0}
        queue = deque(x for x in part if room[x].get(sink, 0.0) > _NOTHING)
        for x in queue:
            far[x] = 1
        while queue:
            x = queue.popleft()
            for y in room[x]:
                if y not in far and y != source and room[y].get(x, 0.0) > _NOTHING:
                    far[y] = far[x] + 1
                    queue.append(y)
        arcs = {x: iter(room[x].items()) for x in far if x != sink}
        moved = False
        for first in out:
            while first in far and room[source].get(first, 0.0) > _NOTHING:
                path = [first]
                while path and path[-1] != sink:
                    x = path[-1]
                    for y, w in arcs[x]:
                        if w > _NOTHING and far.get(y, -1) == far[x] - 1:
                            path.append(y)
                            break
                    else:
                        path.pop()
                        del far[x]
                if not path:
                    break
                steps = list(zip([source, *path], path))
                flow = min(room[a][b] for a, b in steps)
                moved = True
                for a, b in steps:
                    room[a][b] -= flow
                    room[b][a] += flow
                for x in path[:-1]:  # an edge with room left is looked at again
                    arcs[x] = iter(room[x].items())
        if not moved:
            break
    reached = {x for x in out if room[source].get(x, 0.0) > _NOTHING}
    queue = deque(reached)
    while queue:
        x = queue.popleft()
        for y, w in room[x].items():
            if w > _NOTHING and y not in reached and y not in (source, sink):
                reached.add(y)
                queue.append(y)
    return reached


def main_text(html: str | None) -> str:
    """The content blocks of a page, one a line; empty for null and for pages without any."""
    blocks, elements = parse(html or "")
    keep = min_cut(scores(blocks, elements), edges([b.element for b in blocks], elements))
    return "\n".join(b.text for b, good in zip(blocks, keep) if good)


def extract_text(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """page_id, url, text, n_chars, one row for each row of ``pages``.

    A null or empty html gives an empty text; null ids and urls stay null;
    repeated rows stay; other columns are not read. White space of any kind
    inside a block is one space. Pages are independent: no shuffle.
    """
    shipped(pages.sparkSession)
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    )
    schema = StructType([
        rows.schema["page_id"], rows.schema["url"],
        StructField("text", StringType()), StructField("n_chars", LongType()),
    ])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = [main_text(x.as_py()) for x in batch.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=schema.names,
                )

    return rows.mapInArrow(of, schema)
