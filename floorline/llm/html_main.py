"""The main text of web pages by a minimum cut.

A page becomes blocks of text.  A fixed linear classifier gives each block a
logit for being content, from its tag, its containers' tags and names, its length
and its share of link text; the logit is the block's capacity to the source or to
the sink.  Smoothness edges join neighbouring blocks and, through their container,
blocks that are close in the DOM.  The maximum flow separates the page: what the
source still reaches is the content.

Pages are independent: Spark maps over them, a page at a time in each task.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_ROWS = 64

# Fixed words of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
             "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
             "td tfoot th thead tr ul".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("head script style noscript template textarea title svg math iframe object audio video canvas select option "
             "datalist button xmp noembed noframes".split())
# What an opening tag closes first, within the nearest of the containers named.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
          "option": ({"option"}, {"select"})}
P_KEEPS = {"td", "th", "button", "object", "caption", "table", "html"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)", re.S)
NAMED = re.compile(r"(?:^|\s)(class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=\s|=|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none)", re.I)
WORDS = re.compile(r"[a-z]+")

# Containers that never hold the article, and names that say so.
APART = set("nav footer aside form menu dialog".split())
APART_NAMES = set(
    "ad ads advert adverts advertisement advertising adsense alert alerts announcement banner billboard breadcrumb breadcrumbs byline captcha colophon "
    "comment comments commentlist complementary consent contentinfo cookie cookies copyright disclaimer disqus dialog discussion "
    "feedback foot footer form gdpr head header legal login masthead menu message modal nav navbar navigation newsletter notice "
    "notices notification notifications overlay pager pagination paywall popup privacy promo promotion rail recommended register related replies reply "
    "respond responses search share sharing shoutbox sidebar sidenav signin signup skip skyscraper social sponsor sponsored "
    "subscribe subscription supplemental tags teaser toc toolbar topbar tracking trending warning widget widgets".split())
MAIN = {"article", "main"}
MAIN_NAMES = set("article articlebody blog body content entry main page post story text".split())

# Weights of the classifier, in logits, and capacities of the smoothness edges.
BIAS, APART_WEIGHT, MAIN_WEIGHT, MAIN_NAME_WEIGHT = -0.5, -6.0, 4.0, 1.5
TAG_WEIGHT = {"": 1.4, "p": 1.4, "pre": 0.8, "blockquote": 0.8, "h1": 0.8, "h2": 0.5, "h3": 0.5, "li": -0.3, "td": -0.2, "th": -0.4}
LENGTH_WEIGHT, LENGTH_FROM, STOP_WEIGHT, LINK_WEIGHT, COPYRIGHT_WEIGHT = 0.7, 40, 0.5, -4.0, -1.5
BESIDE, ACROSS, TO_PARENT, UPWARD = 0.6, 0.15, 0.4, 0.3
MOST_TEXT = 0.6


@dataclass
class Node:
    """An element: its place in the tree and what it says about its text."""

    name: str
    parent: Node | None
    apart: bool = False
    main: bool = False
    named_main: bool = False
    unseen: bool = False
    holds_article: bool = False
    number: int = -1
    size: int = 0


@dataclass
class Block:
    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def element(name: str, attributes: str, parent: Node | None) -> Node:
    words = set()
    for _, value in NAMED.findall(attributes) if attributes else ():
        words |= set(WORDS.findall(value.lower()))
    inside_article = inherited(parent, "main")
    apart = name in APART or bool(words & APART_NAMES) and name not in ("html", "body") or name == "header" and not inside_article
    if name in ("h1", "h2", "header") and inside_article:
        apart = False
    return Node(name, parent, apart, name in MAIN or "main" in words and not apart, bool(words & MAIN_NAMES),
                name in UNSEEN or bool(attributes and HIDDEN.search(attributes)))


def inherited(node: Node | None, what: str) -> bool:
    while node is not None:
        if getattr(node, what):
            return True
        node = node.parent
    return False


def blocks_of(page: str) -> list[Block]:
    """The page's visible blocks that hold text, in order."""
    root = Node("", None)
    stack, found, current = [root], [], None
    at, links, unseen, main_text_seen = 0, 0, 0, False

    def add(text: str) -> None:
        nonlocal current
        if unseen:
            return
        if current is None:
            holder = next(n for n in reversed(stack) if n.name in BLOCKS or n is root)
            current = Block(holder)
        current.parts.append(text)
        if links:
            current.linked += len(text.strip())

    def flush() -> None:
        nonlocal current, main_text_seen
        if current is not None and current.text:
            found.append(current)
            main_text_seen |= inherited(current.node, "main") and current.node.name != "h1"
        current = None

    def pop(to: int) -> None:
        nonlocal links, unseen
        for node in stack[to:]:
            links -= node.name == "a"
            unseen -= node.unseen
            if node.name in BLOCKS:
                flush()
        del stack[to:]

    def close(names: set[str], within: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                return pop(i)
            if stack[i].name in within:
                return None

    while at < len(page):
        token = TOKEN.search(page, at)
        if token is None:
            add(html.unescape(page[at:]))
            break
        if token.start() > at:
            add(html.unescape(page[at:token.start()]))
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if token["close"]:
            if name == "br":
                add("\n")
            elif any(n.name == name for n in stack):
                pop(max(i for i, n in enumerate(stack) if n.name == name))
            elif name in BLOCKS:
                flush()
            continue
        if name in BLOCKS:
            close({"p"}, P_KEEPS)
        if name in CLOSES:
            close(*CLOSES[name])
        if name == "a":
            close({"a"}, BLOCKS)
        if name == "br":
            add("\n")
        if name in BLOCKS:
            flush()
        if name in VOID:
            continue
        node = element(name, token["attributes"], stack[-1])
        if not main_text_seen and (name in MAIN or name == "h1" and inherited(stack[-1], "main")):
            # A container of the page's article, or of its title, is not set apart by its name; comments come after it.
            up = stack[-1]
            while up is not None:
                up.holds_article = True
                up = up.parent
        if token["attributes"].endswith("/") and name in ("svg", "math", "path"):
            continue
        stack.append(node)
        links += name == "a"
        unseen += node.unseen
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            at = end.start() if end else len(page)
    flush()
    if not any(inherited(b.node, "main") for b in found):
        widest(found)
    return found


def widest(blocks: list[Block]) -> None:
    """On a page without a marked article: a container of most of its text is not set apart by its name alone."""
    for block in blocks:
        up: Node | None = block.node
        while up is not None:
            up.size += len(block.text)
            up = up.parent
    total = sum(len(b.text) for b in blocks)
    for block in blocks:
        up = block.node
        while up is not None:
            up.holds_article |= up.size > MOST_TEXT * total and up.name not in APART | {"header"}
            up = up.parent


def logit(block: Block) -> float:
    """How much the block looks like content."""
    text, node = block.text, block.node
    value = BIAS + TAG_WEIGHT.get(node.name, 0.0)
    apart = main = named = False
    up: Node | None = node
    while up is not None:
        apart |= up.apart and not up.holds_article
        main |= up.main
        named |= up.named_main
        up = up.parent
    if apart:
        value += APART_WEIGHT
    elif main:
        value += MAIN_WEIGHT
    elif named:
        value += MAIN_NAME_WEIGHT
    value += LENGTH_WEIGHT * min(4.0, max(-1.0, math.log2(max(1, len(text)) / LENGTH_FROM)))
    value += STOP_WEIGHT * (text[-1] in ".!?…:;\"'»”")
    value += LINK_WEIGHT * min(1.0, block.linked / max(1, len(text))) * (0.5 if main and not apart else 1.0)
    return value + COPYRIGHT_WEIGHT * (text[0] in "©®")


class Flow:
    """A maximum flow by Dinic's method; edges may have capacity both ways."""

    def __init__(self, nodes: int):
        self.edges: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[float] = []

    def join(self, a: int, b: int, there: float, back: float) -> None:
        self.edges[a].append(len(self.to))
        self.edges[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [there, back]

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.edges)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.edges[a]:
                if self.room[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def cut(self, source: int, sink: int) -> list[bool]:
        """Which nodes the source still reaches once the flow is at its maximum."""
        while (level := self.levels(source))[sink] >= 0:
            nexts, path = [0] * len(self.edges), []
            at = source
            while True:
                if at == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    full = next(i for i, e in enumerate(path) if self.room[e] <= 1e-9)
                    at = self.to[path[full] ^ 1]
                    del path[full:]
                elif nexts[at] < len(self.edges[at]):
                    e = self.edges[at][nexts[at]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[at] + 1:
                        path.append(e)
                        at = self.to[e]
                    else:
                        nexts[at] += 1
                elif path:
                    at = self.to[path.pop() ^ 1]
                    nexts[at] += 1
                else:
                    break
        return [x >= 0 for x in level]


def apart_root(node: Node | None) -> Node | None:
    """The outermost container set apart that a block lies in."""
    found = None
    while node is not None:
        found = node if node.apart and not node.holds_article else found
        node = node.parent
    return found


def content_blocks(blocks: list[Block]) -> list[Block]:
    """The blocks on the source's side of the minimum cut."""
    costs = [logit(b) for b in blocks]
    if all(c <= 0 for c in costs):
        return []
    regions = [apart_root(b.node) for b in blocks]
    n, containers = len(blocks), 0
    links = []
    for i, block in enumerate(blocks):
        if i:
            links.append((i - 1, i, BESIDE if regions[i] is regions[i - 1] else ACROSS))
        below, node, weight = i, block.node.parent, TO_PARENT
        # A container set apart is not close to what lies around it.
        stop = regions[i]
        while node is not None and block.node is not stop:
            known = node.number >= 0
            if not known:
                node.number = containers
                containers += 1
            links.append((below, -1 - node.number, weight))
            if known or node is stop:
                break
            below, node, weight = -1 - node.number, node.parent, UPWARD
    source, sink = n + containers, n + containers + 1
    flow = Flow(n + containers + 2)
    for i, cost in enumerate(costs):
        if cost > 0:
            flow.join(source, i, cost, 0.0)
        elif cost < 0:
            flow.join(i, sink, -cost, 0.0)
    place = lambda x: x if x >= 0 else n - 1 - x
    for a, b, weight in links:
        flow.join(place(a), place(b), weight, weight)
    reached = flow.cut(source, sink)
    return [b for i, b in enumerate(blocks) if reached[i]]


def main_text(page: str | None) -> str:
    return " ".join(b.text for b in content_blocks(blocks_of(page))) if page else ""


def extract_main_text(pages: DataFrame, html_column: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text in ``into`` (a column of that name is replaced).

    Character references are decoded, white space within a block becomes one
    space, blocks are joined by one.  A null or empty page, or one without
    content, gives an empty text.  Rows may repeat; all other columns stay.
    """
    shaped = pages.withColumn(into, F.lit("")) if into != html_column else pages
    schema = shaped.schema

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                texts = pa.array([main_text(p.as_py()) for p in batch[html_column]], pa.string())
                yield batch.set_column(batch.schema.get_field_index(into), into, texts)

    return shaped.mapInArrow(extract, schema)
