"""Main text of web pages by a minimum cut between content and boilerplate.

A page's text blocks are the nodes of a graph. A linear classifier over a block's
text, links and enclosing elements gives its log-odds of being content; positive
odds are the capacity from the source, negative ones the capacity to the sink.
Neighbouring blocks, and consecutive blocks of one container, are joined by
smoothness edges. The minimum cut labels all blocks of the page at once:
those left with the source are the main text. Nodes whose terminal capacity is at least that
of all their edges are settled beforehand (they lie on their own side in some minimum cut);
the rest go through a max-flow.

Pages are independent rows: nothing is shuffled. Defined results: null, empty or
textless html gives an empty text; unclosed and stray tags are tolerated; an
unclosed script or comment runs to the end of the page; equal rows give equal rows; an empty table
gives an empty result; columns other than those asked for are not looked at.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

# Elements of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE = frozenset("nav footer aside form menu button select option label fieldset dialog head title".split())
ROOTS = frozenset("html body article main".split())
CLOSED_BY_BLOCK = frozenset({"p"})
SAME_CLOSES = frozenset("li dt dd tr td th option".split())
# Words of class, id and role that name parts around the article. Reader comments stay that whatever is in them;
# the parts of the second list are left again by an article or main element below them; the third's names also stand on
# wrappers of articles, so they are one weight among the others.
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies reply respond".split())
PART_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts breadcrumb breadcrumbs complementary consent contentinfo cookie cookies copyright footer gdpr "
    "login masthead menu modal nav navbar navigation newsletter pager pagination popup promo promoted promotion signup sponsor "
    "sponsored subscribe subscription".split()
)
DOUBTFUL_WORDS = frozenset(
    "alert banner dropdown form header notice notification recommended related search share sharing sidebar skip social tagcloud toolbar "
    "topbar widget".split()
)
GOOD_WORDS = frozenset("article articlebody body content entry main post story text".split())
QUALIFIERS = frozenset("has with no without show hide".split())


@dataclass(frozen=True)
class Weights:
    """The classifier's log-odds per feature, and the smoothness capacities."""

    base: float = -0.5
    per_100_chars: float = 1.0  # up to ``most_chars``
    most_chars: int = 400
    sentence: float = 1.0
    comma: float = 0.3          # up to three
    link_share: float = -6.0
    article: float = 4.0
    heading: float = 0.5
    list_item: float = -0.5
    copyright: float = -4.0
    good_word: float = 1.5
    bad_part: float = -25.0
    doubtful_name: float = -6.0
    neighbours: float = 0.5
    siblings: float = 0.8


@dataclass
class Block:
    text: str
    links: int
    container: int
    article: bool
    bad: bool
    good: bool
    doubtful: bool = False
    heading: bool = False
    listed: bool = False


@dataclass
class Open:
    """An open element, with what holds for the text in it."""

    name: str
    number: int
    bad: bool = False       # an element around the article, hidden, or reader comments
    part: bool = False      # named as a part around the article
    doubtful: bool = False
    good: bool = False
    article: bool = False
    holder: int = 0         # number of the container that its blocks belong to
    block: int = 0          # place in the stack of the innermost block element


_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|object|textarea)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:\s(?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*)?)/?>"
    r"|<[a-z/!?][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)


def _names(attrs: str) -> tuple[bool, bool, bool, bool]:
    """Whether class, id or role hide the element or name reader comments; a part around the article; perhaps such a part; the article."""
    bad = part = doubtful = good = False
    for key, value in _NAMES.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            bad = True
        elif key in ("class", "id", "role"):
            for name in value.split():
                words = [w for w in re.split(r"[^a-z]+", name) if w]
                if not words or words[0] in QUALIFIERS:
                    continue
                bad = bad or not COMMENT_WORDS.isdisjoint(words)
                part = part or not PART_WORDS.isdisjoint(words) and words[0] not in GOOD_WORDS
                doubtful = doubtful or not DOUBTFUL_WORDS.isdisjoint(words)
                good = good or not GOOD_WORDS.isdisjoint(words)
    return bad, part, doubtful and not good, good


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order, with white space collapsed and character references decoded."""
    out: list[Block] = []
    stack = [Open("", 0)]
    open_names: Counter[str] = Counter()
    number = links = 0
    parts: list[str] = []

    def flush() -> None:
        nonlocal links, parts
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                e = stack[-1]
                heading, listed = any(open_names[h] for h in HEADINGS), open_names["li"] > 0
                out.append(Block(text, links, e.holder, e.article, e.bad or e.part, e.good, e.doubtful, heading, listed))
        parts, links = [], 0

    def text_of(s: str) -> None:
        nonlocal links
        if s:
            parts.append(s)
            if open_names["a"]:
                links += len(s.strip())

    def close(size: int) -> None:
        while len(stack) > size:
            open_names[stack.pop().name] -= 1

    at = 0
    for m in _TOKEN.finditer(page):
        text_of(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            parts.append(" ")
            continue
        if name in BLOCK:
            flush()
        if m["close"]:
            if open_names[name]:
                size = len(stack)
                while stack[size - 1].name != name:
                    size -= 1
                close(size - 1)
            continue
        if name in VOID:
            continue
        if name in BLOCK and stack[-1].name in CLOSED_BY_BLOCK or name in SAME_CLOSES and stack[-1].name == name:
            close(len(stack) - 1)
        if name in BLOCK and name != "div" and name != "section":  # formatting left open inside a paragraph ends with it
            inner = stack[-1].block
            if stack[inner].name in CLOSED_BY_BLOCK:
                close(inner)
        number += 1
        up = stack[-1]
        bad, part, doubtful, good = _names(m["attrs"] or "") if name not in ROOTS else (False, False, False, True)
        if name == "article":  # an article element may be a reader's comment
            bad = _names(m["attrs"] or "")[0]
        whole = name in ("article", "main")
        reset = whole or good and not part
        out_of = Open(
            name, number, up.bad or bad or name in BOILERPLATE or name == "header" and not up.article, up.part and not whole or part,
            up.doubtful and not reset or doubtful, up.good or good and name not in ("html", "body"), up.article or whole, up.holder, up.block,
        )
        if name in BLOCK:
            out_of.block = len(stack)
            if name != "p" and name not in HEADINGS:
                out_of.holder = number
        stack.append(out_of)
        open_names[name] += 1
    text_of(page[at:])
    flush()
    return out


def odds(b: Block, w: Weights) -> float:
    """Log-odds of a block being content."""
    n = len(b.text)
    s = w.base + w.per_100_chars * min(n, w.most_chars) / 100 + w.link_share * min(1.0, b.links / n)
    if b.text[-1] in ".!?…:;»”\"')":
        s += w.sentence
    s += w.comma * min(3, b.text.count(","))
    s += w.article * b.article + w.good_word * (b.good and not b.article)
    s += w.heading * b.heading + w.list_item * b.listed
    if n < 200 and ("©" in b.text or "all rights reserved" in b.text.lower()) and not b.article:
        s += w.copyright
    return s + w.bad_part * b.bad + w.doubtful_name * b.doubtful


def min_cut(unary: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Per node whether it stays with the source in a minimum cut.

    Node i has capacity ``unary[i]`` from the source, or ``-unary[i]`` to the sink; edges count both ways.
    """
    n = len(unary)
    cost = list(unary)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:  # settle nodes that no neighbour can outweigh, and charge their edges to the neighbours
        i = todo.popleft()
        if side[i] is None and abs(cost[i]) >= sum(near[i].values()):
            side[i] = cost[i] > 0
            for j, c in near[i].items():
                del near[j][i]
                cost[j] += c if side[i] else -c
                todo.append(j)
            near[i] = {}
    left = [i for i in range(n) if side[i] is None]
    if left:
        kept = _max_flow_side(left, cost, near)
        for i in left:
            side[i] = i in kept
    return [bool(s) for s in side]


def _max_flow_side(nodes: list[int], cost: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes reachable from the source once no augmenting path is left (shortest paths first)."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in nodes} | {source: {}, sink: {}}
    for i in nodes:
        if cost[i] > 0:
            room[source][i] = cost[i]
            room[i][source] = 0.0
        elif cost[i] < 0:
            room[i][sink] = -cost[i]
            room[sink][i] = 0.0
    while True:
        came = {source: source}
        queue = deque([source])
        while queue and sink not in came:
            i = queue.popleft()
            for j, c in room[i].items():
                if c > 1e-9 and j not in came:
                    came[j] = i
                    queue.append(j)
        if sink not in came:
            return set(came)
        path, j = [], sink
        while j != source:
            path.append((came[j], j))
            j = came[j]
        flow = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= flow
            room[b][a] = room[b].get(a, 0.0) + flow


def smoothness(found: list[Block], w: Weights) -> list[tuple[int, int, float]]:
    """Edges between neighbouring blocks, and between consecutive blocks of one container."""
    edges, last = [], {}
    for i, b in enumerate(found):
        if i:
            edges.append((i - 1, i, w.neighbours))
        if b.container in last:
            edges.append((last[b.container], i, w.siblings))
        last[b.container] = i
    return edges


def main_text(page: str | None, w: Weights = Weights()) -> str:
    """The main text of one page; empty if it has none."""
    found = blocks(page or "")
    kept = min_cut([odds(b, w) for b in found], smoothness(found, w))
    return "\n\n".join(b.text for b, k in zip(found, kept) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", weights: Weights = Weights()) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; ``n_chars`` counts code points."""
    types = dict(pages.dtypes)
    schema = f"page_id {types[id_col]}, url {types[url_col]}, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [main_text(p, weights) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.select(id_col, url_col, html_col).mapInArrow(run, schema)
