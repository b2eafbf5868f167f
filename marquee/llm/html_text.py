"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into text blocks with the elements they stand in.  A linear classifier
gives each block a cost for being called content and one for being called
boilerplate; these are the capacities to the two terminals.  Neighbouring blocks are
joined by smoothness edges, stronger if they share more of the DOM.  The minimum cut
(maximum flow) is the cheapest labelling; blocks on the source side are the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: A comment, a declaration, or a tag; what has no end before the next "<" is text.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^<>]*>|<(/?)([A-Za-z][^\s/<>]*)"
                  r"((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_LABEL = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# Names from the HTML standard and words that pages use for their parts.
_RAW = frozenset("script style template iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol "
    "p pre search section summary table tbody td textarea tfoot th thead title tr ul".split())
_FRAME = frozenset("nav footer aside menu button dialog search head noscript textarea".split())
_MAIN = frozenset(("article", "main"))
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
         "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LISTS = frozenset("ul ol dl table menu".split())
_HEADING = frozenset("h2 h3 h4 h5 h6".split())
_LAYOUT_WORD = re.compile(
    r"banner\w*|breadcrumbs?|footer|header|masthead|menu|nav(?:bar|igation)?|pagination|pager|sidebar|toolbar|widget", re.I)
_TALK_WORD = re.compile(r"comments?|disqus|repl(?:y|ies)|respond|responses?", re.I)
_EXTRA_WORD = re.compile(
    r"ads?|advert\w*|consent|cookies?|login|modal|newsletter|notices?|popup|promo\w*|related|share|sharing|signup|"
    r"social|sponsor\w*|subscribe", re.I)
_CONTENT_WORD = re.compile(r"article|content|entry|main|post|story", re.I)
#: After these a name says what its element has or lacks, not what it is.
_WITH_WORD = re.compile(r"has|have|no|not|with|without", re.I)
_TALK_HEADING = re.compile(
    r"(?:\d+\s+)?(?:reader |user )?comments?(?:\s*\(?\d+\)?)?\s*:?|\d+\s+(?:responses?|replies)|leave a (?:reply|comment)|"
    r"(?:\d+\s+)?(?:kommentare?|commentaires?|comentarios?)(?:\s*\(?\d+\)?)?\s*:?", re.I)

#: What stands in an element tells about its blocks: nothing, or that they are in a form, in
#: the frame of the page, extras, or readers' talk.
CLEAR, FORM, FRAME, EXTRA, TALK = range(5)
#: Cost of calling a block content in each case, against the gain of standing in the main part.
_COST = {CLEAR: 0.0, FORM: 1.0, FRAME: 10.0, EXTRA: 10.0, TALK: 10.0}
_MAIN_GAIN = 3.0


class Block:
    """A block's text; how many of its characters are links; what it stands in; its depth, the
    least depth between it and the block before (where their paths meet), and its parent."""

    __slots__ = ("text", "linked", "stands", "main", "depth", "meet", "parent")

    def __init__(self, text: str, linked: int, stands: int, main: bool, depth: int, meet: int, parent: int):
        self.text, self.linked, self.stands, self.main = text, linked, stands, main
        self.depth, self.meet, self.parent = depth, meet, parent


def _labelled(attributes: str) -> tuple[int, bool]:
    """What class, id and role say of an element: its kind, and whether it is called content."""
    kind, content = CLEAR, False
    for name in " ".join(a or b or c for a, b, c in _LABEL.findall(attributes)).split():
        parts = [part for part in re.split(r"[_-]+", name) if part]
        for k, part in enumerate(parts):
            if _WITH_WORD.fullmatch(part):
                parts = parts[:k]
                break
        called = any(_CONTENT_WORD.fullmatch(part) for part in parts)
        for part in parts:
            if _TALK_WORD.fullmatch(part):
                kind = max(kind, TALK)
            elif _EXTRA_WORD.fullmatch(part):
                kind = max(kind, EXTRA)
            elif _LAYOUT_WORD.fullmatch(part) and not (called and part.lower() == "header"):
                kind = max(kind, FRAME)
        content |= called
    return kind, content and kind == CLEAR


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, character references decoded, white space collapsed."""
    found: list[Block] = []
    # open elements: name, number, what it stands in, in the main part, in a link, blocks around it
    stack: list[tuple[str, int, int, bool, bool, int]] = [("", 0, CLEAR, False, False, 0)]
    pieces: list[str] = []
    where, linked, number, at, meet = stack[-1], 0, 0, 0, 0
    talk: tuple[int, int] | None = None  # the element, and its place, that a heading like "3 comments" stands in
    parents = [0]

    def flush() -> None:
        nonlocal linked, meet, talk
        if pieces:
            text = "".join(pieces)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                depth, place = where[5], max(0, min(where[5], len(parents) - 1) - 1)
                parent, stands = parents[place], where[2]
                if len(text) < 40 and stack[-1][0] in _HEADING and _TALK_HEADING.fullmatch(text):
                    talk = parent, place
                if talk and talk[1] < len(parents) and parents[talk[1]] == talk[0]:
                    stands = TALK
                found.append(Block(text, linked, stands, where[3], depth, min(meet, depth), parent))
                meet = depth
            pieces.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked, where
        if text:
            if not text.isspace():
                where = stack[-1]
                linked += len(text) if where[4] else 0
            pieces.append(text)

    def close_to(index: int) -> None:
        nonlocal meet
        inner = [e for e in stack[index:] if e[0] in _BLOCK]
        if inner:
            flush()
            del parents[len(parents) - len(inner):]
        del stack[index:]
        meet = min(meet, stack[-1][5])

    while m := _TAG.search(page, at):
        say(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    close_to(i)
                    break
            continue
        if name in _RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in _BLOCK:
            flush()
            if name in _ENDS:  # an item ends the item before it in the same list
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in _LISTS:
                        break
                    if stack[i][0] in _ENDS[name]:
                        close_to(i)
                        break
            else:  # a block ends an open paragraph
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        close_to(i)
                        break
                    if stack[i][0] in _BLOCK:
                        break
        if name in _VOID or m[3].endswith("/"):
            continue
        number += 1
        above = stack[-1]
        stands, main = above[2], above[3]
        kind, called = _labelled(m[3]) if m[3] and name not in ("html", "body") else (CLEAR, False)
        if name in _FRAME or name == "header" and not main:
            kind = max(kind, FRAME)
        elif name == "form":
            kind = max(kind, EXTRA if main else FORM)
        if name in _MAIN and kind < FRAME:
            # the main part is what it is, whatever it stands in, but for readers' talk
            stands, main = stands if stands == TALK else CLEAR, True
        else:
            if called:  # so named within the frame of the page, it is not of the frame
                main = True
                if stands in (FORM, FRAME):
                    stands = CLEAR
            stands = max(stands, kind)
        if name in _BLOCK:
            parents.append(number)
        stack.append((name, number, stands, main, above[4] or name == "a", above[5] + (name in _BLOCK)))
    say(page[at:])
    flush()
    return found


def score(block: Block) -> float:
    """Cost of calling the block boilerplate less that of calling it content: longer blocks,
    whole sentences and the main part speak for content, links and what the block stands in
    against it."""
    words = block.text.count(" ") + 1
    value = -0.3 + min(words, 60) / 15 + (0.5 if block.text[-1] in ".!?:;\"”»)" else 0.0)
    value -= 2.0 * block.linked / max(1, len(block.text))
    return value + (_MAIN_GAIN if block.main else 0.0) - _COST[block.stands]


def smoothness(a: Block, b: Block, meet: int) -> float:
    """Strength of the edge between two blocks whose paths meet at a depth: adjacency and the
    share of common elements; weak between blocks that stand in different things."""
    strength = 0.3 + 0.9 * meet / max(1, a.depth - 1, b.depth - 1)
    return strength if a.stands == b.stands else 0.3 * strength


def _settled(scores: list[float], edges: list[tuple[int, int, float]]) -> list[int]:
    """1 or -1 for nodes whose own score outweighs all their open edges, 0 for the others.

    Such a node takes its own side in a minimum cut; its edges then count towards its
    neighbours' scores (which are changed), and may settle them in turn.
    """
    near: list[list[tuple[int, float]]] = [[] for _ in scores]
    around = [0.0] * len(scores)
    for a, b, w in edges:
        near[a].append((b, w))
        near[b].append((a, w))
        around[a] += w
        around[b] += w
    side, todo = [0] * len(scores), list(range(len(scores)))
    while todo:
        node = todo.pop()
        if side[node] or abs(scores[node]) < around[node]:
            continue
        side[node] = 1 if scores[node] >= 0 else -1
        for other, w in near[node]:
            if not side[other]:
                scores[other] += w * side[node]
                around[other] -= w
                todo.append(other)
    return side


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source side of a minimum cut (the largest such side).

    Node i hangs on the source with capacity max(score, 0) and on the sink with
    max(-score, 0).  Nodes that outweigh their edges are settled first, which leaves short
    stretches of a page open; on each the maximum flow is found by blocking flows along
    layers of shortest paths.
    """
    scores = list(scores)
    side = _settled(scores, edges)
    open_nodes = [i for i, s in enumerate(side) if not s]
    if open_nodes:
        at = {node: k for k, node in enumerate(open_nodes)}
        inner = [(at[a], at[b], w) for a, b, w in edges if a in at and b in at]
        for node, chosen in zip(open_nodes, _maximum_flow([scores[i] for i in open_nodes], inner)):
            side[node] = 1 if chosen else -1
    return [s > 0 for s in side]


def _maximum_flow(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    n, tiny = len(scores), 1e-9
    supply = [max(s, 0.0) for s in scores]
    demand = [max(-s, 0.0) for s in scores]
    rest: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        rest[a][b] = rest[a].get(b, 0.0) + w
        rest[b][a] = rest[b].get(a, 0.0) + w
    while True:
        layer = [0 if s > tiny else -1 for s in supply]
        queue = [i for i in range(n) if not layer[i]]
        met = False
        for node in queue:
            met = met or demand[node] > tiny
            for other, left in rest[node].items():
                if left > tiny and layer[other] < 0:
                    layer[other] = layer[node] + 1
                    queue.append(other)
        if not met:
            break
        ways = [iter(list(rest[i])) for i in range(n)]
        for start in [i for i in range(n) if supply[i] > tiny]:
            path = [start]
            while path and supply[start] > tiny:
                node = path[-1]
                if demand[node] > tiny:
                    flow = min([supply[start], demand[node], *[rest[a][b] for a, b in zip(path, path[1:])]])
                    supply[start] -= flow
                    demand[node] -= flow
                    cut = len(path)
                    for k, (a, b) in enumerate(zip(path, path[1:])):
                        rest[a][b] -= flow
                        rest[b][a] += flow
                        if rest[a][b] <= tiny:
                            cut = min(cut, k + 1)
                    del path[cut:]
                    continue
                for other in ways[node]:
                    if layer[other] == layer[node] + 1 and rest[node][other] > tiny:
                        path.append(other)
                        break
                else:
                    layer[node] = -1  # nothing leads on from here
                    path.pop()
    # whatever can still reach the sink is on its side
    reach = [i for i in range(n) if demand[i] > tiny]
    sink = set(reach)
    for node in reach:
        for other in rest[node]:
            if rest[other][node] > tiny and other not in sink:
                sink.add(other)
                reach.append(other)
    return [i not in sink for i in range(n)]


def _graph(parts: list[Block]) -> tuple[list[float], list[tuple[int, int, float]]]:
    """Scores of the blocks, and edges between neighbours and between siblings."""
    edges, last = [], {}
    for i, block in enumerate(parts):
        if i:
            edges.append((i - 1, i, smoothness(parts[i - 1], block, block.meet)))
        sibling = last.get(block.parent)
        if sibling is not None and sibling != i - 1:
            edges.append((sibling, i, 0.5 if parts[sibling].stands == block.stands else 0.15))
        last[block.parent] = i
    return [score(b) for b in parts], edges


def main_text(page: str) -> str:
    """The content blocks of a page, joined by blank lines."""
    parts = blocks(page)
    if not parts:
        return ""
    return "\n\n".join(b.text for b, chosen in zip(parts, minimum_cut(*_graph(parts))) if chosen)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of the whole html.

    Null and empty html give the empty text, as does a page without content; equal
    pages get equal texts; a column named like ``text_col`` is replaced.  Very long and
    very deep pages take time in proportion to their size, but for stretches of blocks that
    only the cut can tell apart.
    """
    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for sources in batches:
            yield pd.Series([main_text(s) for s in sources], dtype=object)

    return pages.withColumn(text_col, texts(F.coalesce(F.col(html_col).cast("string"), F.lit(""))))
