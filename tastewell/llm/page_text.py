"""Main text of web pages by a tree-structured graphical model over the DOM.

Nodes are the block elements of a page and, as leaves, its runs of text. A node is content (on the way to
main text) or not. Its features give a potential of its own; each edge has a potential of the two labels,
which depends on the kind of the child. Sum-product messages pass from the leaves to the root and back and
give every node's marginal; the text of the runs that are more likely content is the main text. Weights
maximise the likelihood of labelled pages.
"""

from __future__ import annotations

import html
import re
import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The usual tag as a whole, which never reaches past the next "<", or else the beginning of one.
OPENING = re.compile(
    r"<(/?)([a-zA-Z][^\s/<>\"']*)(?=[\s/>])((?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>"
    r"|<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)(?=[a-zA-Z])",
    re.S | re.I,
)
NAME_END = re.compile(r"[\s/>]")
EVENT = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"(class|id|role|aria-label|itemprop|style|hidden|aria-hidden|data-main|data-not)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Fixed values of the HTML language.
RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in "script style noscript textarea title iframe noframes".split()}  # by what ends them
SKIPPED = frozenset(["svg", "select", "template"])  # elements without text of the page
# Start tags that end an svg they stand in, and the elements of it that may hold them.
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
FOREIGN = frozenset(["foreignobject", "desc"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option", "optgroup"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]), "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "head": frozenset(["body"]), "thead": frozenset(["tbody", "tfoot"]), "tbody": frozenset(["tbody", "tfoot"]),
}
CLOSES = {tag: frozenset(t for t, by in CLOSED_BY.items() if tag in by) for tag in frozenset().union(*CLOSED_BY.values())}
# Words in class, id and role, by what they name.
NAMES = {
    "navigation": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs pagination pager toc skip tabs topbar".split(),
    "head": "header masthead banner logo branding top".split(),
    "foot": "footer foot copyright colophon legal contentinfo bottom".split(),
    "side": "sidebar aside side rail widget widgets complementary related recommended recommendations more trending popular promo promoted teaser teasers links tags".split(),
    "advert": "ad ads advert adverts advertisement sponsor sponsored sponsors banner adbox adsense commercial".split(),
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall privacy disclaimer message toast dialog warning".split(),
    "form": "form search login signin signup contact input button buttons".split(),
    "share": "share sharing social follow like meta byline author date tools toolbar print".split(),
    "comment": "comment comments reply replies respond discussion disqus thread responses reader readers".split(),
    "content": "article content post entry story main body text prose page articlebody".split(),
}
KIND_OF_NAME = {w: k for k, words in NAMES.items() for w in words}
TAGS = (
    "html body head main article section div p h1 h2 h3 h4 ul ol li nav header footer aside form table tr td th tbody blockquote pre figure figcaption dl dt dd "
    "address fieldset details summary dialog button center hr".split()
)
FEATURES = (
    ["bias", "leaf"] + [f"tag:{t}" for t in TAGS] + ["tag:other"] + [f"name:{k}" for k in NAMES] + ["hidden", "in:p", "in:li", "in:heading", "in:cell"]
    + ["words:0", "words:3", "words:8", "words:20", "words:60", "links:all", "links:half", "links:none", "ends", "symbols"]
)
PLACE = {f: i for i, f in enumerate(FEATURES)}
EDGES = ["plain", "leaf", "section", "named"]  # of a child: how its label follows its parent's
ROUNDS = 600
STEP = 8.0
PENALTY = 0.00002
PAGES_PER_FOREST = 64


class Node:
    """A block element, or a run of text in one."""

    __slots__ = ("edge", "features", "kept", "link", "name", "names", "parent", "pieces", "tag")

    def __init__(self, tag: str, parent: int, names: frozenset[str] = frozenset(), kept: bool = False):
        self.tag, self.parent, self.names, self.kept = tag, parent, names, kept
        self.pieces: list[str] = []
        self.link = 0
        self.features: list[int] = []
        self.edge = 0


def _names(attributes: str) -> tuple[frozenset[str], bool | None]:
    """Kinds named by the attributes, and what a training mark says."""
    kinds, kept = set(), None
    for match in ATTRIBUTE.finditer(attributes):
        key, value = match[1].lower(), match[2] or match[3] or match[3] or ""
        if key in ("data-main", "data-not"):
            kept = key == "data-main"
        elif key in ("hidden", "aria-hidden"):
            if value.lower() != "false":
                kinds.add("hidden")
        elif key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                kinds.add("hidden")
        else:
            kinds.update(KIND_OF_NAME[w.lower()] for w in PART.findall(value) if w.lower() in KIND_OF_NAME)
    return frozenset(kinds), kept


class _Tags:
    """The tags of a page, one after the other. Every sign is looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.name_end = 0
        self.events: list[int] | None = None
        self.ends: list[int] = []

    def _unquoted(self, place: int) -> int:
        """The first ``>`` from a place on that no quotes hold, or -1."""
        if self.events is None:
            self.events = [m.start() for m in EVENT.finditer(self.page)]
            self.ends = [-1] * (len(self.events) + 2)
            following = {}
            for i in range(len(self.events) - 1, -1, -1):
                sign = self.page[self.events[i]]
                if sign == ">":
                    self.ends[i] = self.events[i]
                else:
                    self.ends[i] = self.ends[following[sign] + 1] if sign in following else -1
                    following[sign] = i
        return self.ends[bisect_left(self.events, place)]

    def _rest(self, start: int) -> tuple[int, int] | None:
        """Where the name that starts here ends, and its tag's ``>``."""
        if start > self.last:
            return None
        if start >= self.name_end:
            self.name_end = NAME_END.search(self.page, start).start()
        end = self._unquoted(self.name_end)
        return (self.name_end, end) if end >= 0 else None

    def next(self, place: int) -> tuple[int, int, bool, str | None, str] | None:
        """(start, end, whether an end tag, name, attributes) of the next tag; comments and the like have no name."""
        while match := OPENING.search(self.page, place):
            if match[2]:
                return match.start(), match.end(), bool(match[1]), match[2].lower(), match[3]
            if match[4] is None:
                return match.start(), match.end(), False, None, ""
            rest = self._rest(match.end())
            if rest:
                name_end, end = rest
                return match.start(), end + 1, bool(match[4]), self.page[match.end() : name_end].lower(), self.page[name_end:end]
            place = match.end()
        return None


class _Stack:
    """Open elements, each with the node of its nearest block, and where those of a name, blocks and barriers stand."""

    def __init__(self):
        self.elements: list[tuple[str, int]] = [("#root", 0)]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.barriers: list[int] = []  # blocks that end tags left out do not reach across

    def push(self, tag: str, node: int) -> None:
        place = len(self.elements)
        self.elements.append((tag, node))
        self.places.setdefault(tag, []).append(place)
        if tag not in INLINE:
            self.blocks.append(place)
            if tag not in CLOSED_BY:
                self.barriers.append(place)

    def cut(self, depth: int) -> int:
        """Closes all from a depth on; the number of links among them."""
        links = 0
        while len(self.elements) > depth:
            tag, _ = self.elements.pop()
            self.places[tag].pop()
            links += tag == "a"
        for held in (self.blocks, self.barriers):
            while held and held[-1] >= depth:
                held.pop()
        return links

    def last(self, tag: str) -> int:
        """Depth of the innermost open element of the name, or zero."""
        return self.places[tag][-1] if self.places.get(tag) else 0

    def block_between(self, depth: int, below: int) -> bool:
        """Whether a block stands from one depth to below another."""
        place = bisect_left(self.blocks, below)
        return place > 0 and self.blocks[place - 1] >= depth

    def ended_by(self, tag: str) -> int:
        """Depth of the outermost element that this start tag ends, or zero."""
        barrier, found = self.barriers[-1] if self.barriers else 0, []
        for name in CLOSES.get(tag, ()):
            held = self.places.get(name, [])
            place = bisect_right(held, barrier)
            if place < len(held):
                found.append(held[place])
        return min(found, default=0)


def parse(page: str) -> list[Node]:
    """Nodes of a page, parents before children, text runs in page order. The time is in proportion to the page."""
    nodes = [Node("#root", -1)]
    stack, tags = _Stack(), _Tags(page)
    run: Node | None = None
    links = 0
    place = 0
    skipped = 0  # depth of the outermost open element whose text is left out

    def text(piece: str) -> None:
        nonlocal run
        if not piece or skipped:
            return
        if run is None:
            if piece.isspace():
                return
            run = Node("#text", stack.elements[-1][1])
            nodes.append(run)
        run.pieces.append(piece)
        if links:
            run.link += len(piece)

    def close(depth: int) -> None:
        nonlocal links, skipped
        links -= stack.cut(depth)
        if depth <= skipped:
            skipped = 0

    while found := tags.next(place):
        start, end, closing, tag, attributes = found
        text(page[place:start])
        place = end
        if tag is None:
            continue
        in_svg = bool(skipped) and stack.elements[skipped][0] == "svg"
        if tag in RAW and not closing:
            # Inside of an svg, these may be closed by their own slash.
            if not (in_svg and attributes.endswith("/")):
                ended = RAW[tag].search(page, place)
                place = ended.end() if ended else len(page)
            if tag not in ("script", "style", "noscript") and not skipped:
                run = None
            continue
        block = tag not in INLINE
        if closing:
            depth = stack.last(tag)
            if block and (not skipped or 0 < depth < skipped):
                run = None
            # An inline end tag does not close the blocks around its element; what is left out is no such block.
            below = skipped if depth < skipped else len(stack.elements)
            if depth and (block or not stack.block_between(depth, below)):
                close(depth)
            continue
        if skipped:
            parent = stack.elements[skipped - 1][0]
            ends = in_svg and tag in BREAKOUT and not any(stack.last(t) >= skipped for t in FOREIGN)
            ends |= stack.elements[skipped][0] == "select" and tag != "hr" and tag in CLOSED_BY.get(parent, ())
            if not ends:
                if tag not in VOID and not attributes.endswith("/"):
                    links += tag == "a"
                    stack.push(tag, stack.elements[skipped][1])
                continue
            close(skipped)
        if tag in SKIPPED:
            if tag == "select":
                run = None
            if tag != "svg" or not attributes.endswith("/"):
                stack.push(tag, stack.elements[-1][1])
                skipped = len(stack.elements) - 1
            continue
        if block:
            run = None
        if tag in VOID or (tag == "br"):
            continue
        # Elements whose end tags may be left out.
        if block and (depth := stack.ended_by(tag)):
            close(depth)
        if attributes.endswith("/") and not block:
            continue
        node = stack.elements[-1][1]
        if block:
            names, kept = _names(attributes) if attributes.strip() else (frozenset(), None)
            nodes.append(Node(tag, node, names, nodes[node].kept if kept is None else kept))
            node = len(nodes) - 1
        elif tag == "a":
            links += 1
        stack.push(tag, node)
    text(page[place:])
    return nodes


def _describe(nodes: list[Node]) -> None:
    """Sets features and edge kinds."""
    for node in nodes:
        found = ["bias"]
        if node.tag == "#text":
            node.kept = nodes[node.parent].kept
            value = "".join(node.pieces)
            words = value.split()
            share = node.link / max(1, len(value))
            holder = nodes[node.parent].tag
            found += ["leaf", *(f"words:{n}" for n in (0, 3, 8, 20, 60) if len(words) > n)]
            found.append("links:all" if share > 0.8 else "links:half" if share > 0.3 else "links:none")
            if re.search(r"[.!?…。！？][\"'”’)\]]*\s*$", value):
                found.append("ends")
            if re.search(r"[©®|»›←→·•]|&copy;|&middot;", value):
                found.append("symbols")
            kind = {"p": "in:p", "li": "in:li", "td": "in:cell", "th": "in:cell"}.get(holder, "in:heading" if re.fullmatch("h[1-6]", holder) else None)
            found += [kind] if kind else []
            node.edge = EDGES.index("leaf")
        else:
            found.append(f"tag:{node.tag}" if f"tag:{node.tag}" in PLACE else "tag:other")
            found += ["hidden" if k == "hidden" else f"name:{k}" for k in node.names]
            section = node.tag in ("nav", "header", "footer", "aside", "form", "article", "main", "section", "dialog")
            node.edge = EDGES.index("named" if node.names else "section" if section else "plain")
        node.features = [PLACE[f] for f in found]


class Forest:
    """The nodes of some pages as one forest: parents, depths, edge kinds and features in arrays."""

    def __init__(self, pages: list[str]):
        self.nodes: list[Node] = []
        parents, self.starts = [], []
        for page in pages:
            first = len(self.nodes)
            nodes = parse(page)
            _describe(nodes)
            self.starts.append(first)
            parents += [-1 if n.parent < 0 else first + n.parent for n in nodes]
            self.nodes += nodes
        self.parents = np.array(parents, np.int64)
        self.edges = np.array([n.edge for n in self.nodes], np.int64)
        self.sizes = np.array([len(n.features) for n in self.nodes], np.int64)
        self.flat = np.array([f for n in self.nodes for f in n.features], np.int64)
        depths = [0] * len(parents)
        for i, p in enumerate(parents):
            depths[i] = depths[p] + 1 if p >= 0 else 0
        order = np.argsort(depths, kind="stable")
        cuts = np.searchsorted(np.array(depths)[order], np.arange(max(depths, default=0) + 2))
        self.levels = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def own(self, weights: np.ndarray) -> np.ndarray:
        """Log potential of label one of each node; label zero has none."""
        return np.add.reduceat(weights[self.flat], np.cumsum(self.sizes) - self.sizes)

    def marginals(self, weights: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(content) of every node, and P(parent, child) of every edge, by sum-product.

        ``pair`` has the log potentials by edge kind, parent label and child label.
        """
        n = len(self.nodes)
        up = np.stack([np.zeros(n), self.own(weights)], 1)  # log sums of a node's subtree, by its label
        send, table = np.zeros((n, 2)), pair[self.edges]
        for level in self.levels[:0:-1]:
            send[level] = np.logaddexp(*np.moveaxis(table[level] + up[level][:, None, :], 2, 0))
            np.add.at(up, self.parents[level], send[level])
        down, joint = np.zeros((n, 2)), np.zeros((n, 2, 2))
        for level in self.levels[1:]:
            over = self.parents[level]
            rest = (up[over] + down[over] - send[level])[:, :, None] + table[level]
            down[level] = np.logaddexp(rest[:, 0], rest[:, 1])
            cells = rest + up[level][:, None, :]
            cells = np.exp(cells - cells.max((1, 2), keepdims=True))
            joint[level] = cells / cells.sum((1, 2), keepdims=True)
        gap = up[:, 0] + down[:, 0] - up[:, 1] - down[:, 1]
        return 1 / (1 + np.exp(np.clip(gap, -500, 500))), joint


def train(pages: list[str], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights and edge potentials from pages in which ``data-main`` marks the elements of the main text.

    Gradient ascent on the likelihood: observed less expected counts under the marginals, with a penalty.
    A block is content if it, or a block below it, is marked.
    """
    forest = Forest(pages)
    label = np.array([n.kept for n in forest.nodes], np.int64)
    for level in forest.levels[:0:-1]:
        np.maximum.at(label, forest.parents[level], label[level])
    n = len(label)
    below = np.flatnonzero(forest.parents >= 0)
    seen = np.zeros((n, 2, 2))
    seen[below, label[forest.parents[below]], label[below]] = 1
    weights, pair = np.zeros(len(FEATURES)), np.zeros((len(EDGES), 2, 2))
    for step in range(rounds):
        belief, joint = forest.marginals(weights, pair)
        slope = np.bincount(forest.flat, weights=np.repeat(label - belief, forest.sizes), minlength=len(FEATURES))
        slope_pair = np.zeros_like(pair)
        np.add.at(slope_pair, forest.edges[below], seen[below] - joint[below])
        rate = STEP / (1 + step / 200)
        weights += rate * (slope / n - PENALTY * weights)
        pair += rate * (slope_pair / n - PENALTY * pair)
    return weights, pair


def main_texts(pages: list[str], weights: np.ndarray, pair: np.ndarray) -> list[str]:
    """Of each page the runs of text that are content, decoded, white space made one space, joined by one space."""
    if not pages:
        return []
    forest = Forest(pages)
    belief, _ = forest.marginals(weights, pair)
    out: list[list[str]] = [[] for _ in pages]
    ends = [*forest.starts[1:], len(forest.nodes)]
    for k, (start, end) in enumerate(zip(forest.starts, ends, strict=True)):
        for node, sure in zip(forest.nodes[start:end], belief[start:end].tolist(), strict=True):
            if node.tag == "#text" and sure > 0.5:
                piece = " ".join(html.unescape("".join(node.pieces)).split())
                if piece:
                    out[k].append(piece)
    return [" ".join(pieces) for pieces in out]


def _extract(weights: np.ndarray, pair: np.ndarray):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, texts = batch.column(0).to_pylist(), []
            for start in range(0, len(pages), PAGES_PER_FOREST):
                texts += main_texts([page or "" for page in pages[start : start + PAGES_PER_FOREST]], weights, pair)
            columns = [batch.column(i) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*batch.schema.names[1:], "text"])

    return extract


def extract_text(pages: DataFrame, weights: np.ndarray, pair: np.ndarray, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and the main text of every page.

    A null or empty page, and one without content, has an empty text. Repeated rows come back each. Unclosed
    and stray tags are taken as browsers take them; text outside of any element counts as a run of its own.
    """
    chosen = pages.select(F.col(html_column).alias("__html"), *(keep or ["page_id", "url"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[1:])
    return chosen.mapInArrow(_extract(weights, pair), f"{schema}, text string")
