"""A small DOM of a page and simple tree matching, for the HTML extraction tasks."""

from __future__ import annotations

import html
import pickle
import re
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(["script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"])
# An opening tag closes these open ones, up to the nearest of the second set.
_CLOSED_BY = {
    "li": (frozenset(["li", "p"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd", "p"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th", "p"]), frozenset(["table"])),
    "td": (frozenset(["td", "th", "p"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th", "p"]), frozenset(["table", "tr"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_PARAGRAPH = frozenset(["p"])
_LISTS, _CELLS = frozenset(["ul", "ol"]), frozenset(["td", "th", "table", "button", "li", "dd"])
_ENDS_PARAGRAPH = BLOCKS - {"br", "body", "html", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
# A quote opens a value only after an equals sign; anywhere else in a tag it is a letter like any
# other. A value whose quote never closes does not swallow the page. A tag that the page's
# end cuts off is no text.
_VALUE = r"=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+"
_PIECE = re.compile(
    rf"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|{_VALUE})*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")


class Node:
    """An element, or a text if ``tag`` is ''. ``shape`` stands for its whole structure."""

    __slots__ = ("tag", "names", "children", "text", "shape", "size")

    def __init__(self, tag: str, names: str = "", text: str = ""):
        self.tag, self.names, self.text = tag, names, text
        self.children: list[Node] = []
        self.shape, self.size = 0, 1


def _names(attributes: str) -> str:
    """class, id and role of a tag, and the word ``hidden``, lower-cased."""
    out = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role"):
            out.append(html.unescape(a or b or c).lower())
        elif name == "hidden" or (name == "aria-hidden" and (a or b or c) == "true"):
            out.append("hidden")
        elif name == "style" and re.search(r"display\s*:\s*none", a or b or c):
            out.append("hidden")
    return " ".join(out)


def parse(page: str) -> Node:
    """The tree of a page. Comments and raw elements (scripts, styles ...) leave no text."""
    root = Node("#root")
    stack, at, lowered = [root], 0, None
    for found in _PIECE.finditer(page):
        start = found.start()
        if start < at:  # inside a raw element
            continue
        if start > at:
            _add_text(stack[-1].children, page[at:start])
        at = found.end()
        closing, tag, attributes = found.groups()
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if stack[-1].tag == tag:
                if len(stack) > 1:
                    stack.pop()
                continue
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if len(stack) > 2:
            if tag in _ENDS_PARAGRAPH:
                _close(stack, _PARAGRAPH, _LISTS if tag == "li" else _CELLS)
            if tag in _CLOSED_BY:
                _close(stack, *_CLOSED_BY[tag])
        node = Node(tag, _names(attributes) if attributes and "=" in attributes or "hidden" in attributes else "")
        stack[-1].children.append(node)
        if tag in RAW:
            if lowered is None:
                lowered = page.lower()
            stop = lowered.find("</" + tag, at)
            close = page.find(">", stop) if stop >= 0 else -1
            at = close + 1 if close >= 0 else len(page)
        elif tag not in VOID and attributes[-1:] != "/":
            stack.append(node)
    if at < len(page):
        _add_text(stack[-1].children, page[at:])
    return root


def pack(root: Node) -> bytes:
    """A tree as bytes, from which ``unpack`` makes it again without reading the page."""
    tags, names, texts, counts, todo = [], [], [], [], [root]
    while todo:
        node = todo.pop()
        tags.append(node.tag)
        names.append(node.names)
        texts.append(node.text)
        counts.append(len(node.children))
        todo.extend(reversed(node.children))
    return zlib.compress(pickle.dumps((tags, names, texts, counts), pickle.HIGHEST_PROTOCOL), 1)


def unpack(packed: bytes) -> Node:
    tags, names, texts, counts = pickle.loads(zlib.decompress(packed))
    root, open_ = None, []  # nodes that wait for children, and how many
    for tag, name, text, n in zip(tags, names, texts, counts, strict=True):
        node = Node(tag, name, text)
        if root is None:
            root = node
        else:
            open_[-1][0].children.append(node)
            open_[-1][1] -= 1
        if n:
            open_.append([node, n])
        while open_ and not open_[-1][1]:
            open_.pop()
    return root


def _add_text(children: list[Node], text: str) -> None:
    """A text node; white space alone only separates what is before it."""
    if not text.isspace():
        children.append(Node("", "", html.unescape(text) if "&" in text else text))
    elif children:
        children.append(Node("", "", " "))


def _close(stack: list[Node], closed: frozenset, scope: frozenset) -> None:
    """Ends the open elements of ``closed`` above the nearest of ``scope``."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in closed:
            lowest = depth
            while lowest > 1 and stack[lowest - 1].tag in closed:
                lowest -= 1
            del stack[lowest:]
            return
        if stack[depth].tag in scope:
            return


TABLE_CELLS = 16_384  # up to here two child lists are aligned by one exact table
GAP_CELLS = 1 << 22  # the largest stretch between anchors that is aligned as a whole


class Shapes:
    """Numbers for tree structures, and cached matches between them.

    Pages of a host repeat the same few structures, so most matches are looked up.
    """

    def __init__(self, most: int = 200_000):
        self._numbers: dict[tuple, int] = {}
        self._matches: dict[tuple[int, int], int] = {}
        self._most = most

    def assign(self, root: Node) -> None:
        order, todo = [], [root]
        while todo:  # no recursion: trees may be very deep
            node = todo.pop()
            order.append(node)
            todo.extend(node.children)
        for node in reversed(order):
            key = (node.tag, node.names, *[c.shape for c in node.children])
            node.shape = self._numbers.setdefault(key, len(self._numbers) + 1)
            node.size = 1 + sum(c.size for c in node.children)

    def full(self) -> bool:
        return len(self._numbers) > self._most or len(self._matches) > self._most

    def _weight(self, a: Node, b: Node) -> int:
        """Nodes that a simple tree matching of a and b pairs.

        The pairs of nodes that it asks about wait on a list of their own: however deep
        two trees are, nothing is called by itself.
        """
        known = self._known(a, b)
        if known is not None:
            return known
        waiting = [(a, b)]
        while waiting:
            x, y = waiting[-1]
            missing = [] if self._known(x, y) is not None else self._asked(x, y)
            if missing:
                waiting += missing
                continue
            if self._known(x, y) is None:
                self._matches[x.shape, y.shape] = 1 + self._align(x.children, y.children)[0]
            waiting.pop()
        return self._matches[a.shape, b.shape]

    def _known(self, a: Node, b: Node) -> int | None:
        if a.tag != b.tag or a.names != b.names:
            return 0
        if a.shape == b.shape:
            return a.size
        return self._matches.get((a.shape, b.shape))

    def _asked(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """The pairs of children whose weights the alignment of a and b needs and nobody knows."""
        start, n, m, _ = _equal_ends(a.children, b.children)
        if (n - start) * (m - start) > TABLE_CELLS:
            return []
        xs = {x.shape: x for x in a.children[start:n]}
        ys = {y.shape: y for y in b.children[start:m]}
        return [(x, y) for x in xs.values() for y in ys.values() if self._known(x, y) is None]

    def _align(self, xs: list[Node], ys: list[Node]) -> tuple[int, list[tuple[int, int]]]:
        """Order-preserving pairing of two child lists: its weight and its pairs.

        Equal structures at either end pair up in some optimum, so only the middle is left. A
        middle of up to TABLE_CELLS pairs is solved exactly. A larger one is cut at anchors:
        structures that occur once on either side, in the longest order that both share.
        Stretches between anchors go on in the same way; one without anchors is aligned
        by its children's structures in linear space.
        """
        start, n, m, tail = _equal_ends(xs, ys)
        pairs = [(i, i) for i in range(start)]
        total = sum(x.size for x in xs[:start]) + sum(xs[i].size for i, _ in tail)
        todo, middle = [(start, n, start, m)], []
        while todo:
            i, n, j, m = todo.pop()
            if i >= n or j >= m:
                continue
            if (n - i) * (m - j) <= TABLE_CELLS:
                weight, found = self._table(xs[i:n], ys[j:m])
                total += weight
                middle += [(i + a, j + b) for a, b in found]
                continue
            anchors = [(i + a, j + b) for a, b in _anchors(xs[i:n], ys[j:m])]
            if anchors:
                total += sum(xs[a].size for a, _ in anchors)
                middle += anchors
                edges = [(i - 1, j - 1), *anchors, (n, m)]
                todo += [(a + 1, c, b + 1, d) for (a, b), (c, d) in zip(edges, edges[1:], strict=False)]
            elif (n - i) * (m - j) > GAP_CELLS:
                # Stretches of tens of thousands without a common structure: halves face halves.
                half = ((i + n) // 2, (j + m) // 2)
                todo += [(i, half[0], j, half[1]), (half[0], n, half[1], m)]
            else:
                for a, b in _linear_space(xs[i:n], ys[j:m]):
                    middle.append((i + a, j + b))
                    total += _likeness(xs[i + a], ys[j + b])
        return total, pairs + sorted(middle) + tail[::-1]

    def _table(self, xs: list[Node], ys: list[Node]) -> tuple[int, list[tuple[int, int]]]:
        rows, weights = [[0] * (len(ys) + 1)], []
        for x in xs:
            own, above = [0], rows[-1]
            weights.append([self._weight(x, y) for y in ys])
            for j, w in enumerate(weights[-1]):
                own.append(max(above[j + 1], own[j], above[j] + w if w else 0))
            rows.append(own)
        i, j, found = len(xs), len(ys), []
        while i and j:
            w = weights[i - 1][j - 1]
            if w and rows[i][j] == rows[i - 1][j - 1] + w:
                found.append((i - 1, j - 1))
                i, j = i - 1, j - 1
            elif rows[i][j] == rows[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return rows[-1][-1], found[::-1]

    def match(self, page: Node, reference: Node) -> dict[int, int]:
        """For each matched text of ``page``, by id(): its number in ``reference``."""
        numbers, todo = {}, [reference]
        while todo:
            node = todo.pop()
            numbers[id(node)] = len(numbers)
            todo.extend(reversed(node.children))
        out, todo = {}, [(page, reference)]
        while todo:
            a, b = todo.pop()
            if not a.tag and not b.tag:
                out[id(a)] = numbers[id(b)]
            elif a.tag == b.tag and a.names == b.names:
                pairs = self._align(a.children, b.children)[1]
                todo.extend((a.children[i], b.children[j]) for i, j in pairs)
        return out


def _equal_ends(xs: list[Node], ys: list[Node]) -> tuple[int, int, int, list[tuple[int, int]]]:
    """Length of the common beginning, the ends of what is left of both, pairs of the common end (backwards)."""
    start, n, m, tail = 0, len(xs), len(ys), []
    while start < min(n, m) and xs[start].shape == ys[start].shape:
        start += 1
    while n > start and m > start and xs[n - 1].shape == ys[m - 1].shape:
        n, m = n - 1, m - 1
        tail.append((n, m))
    return start, n, m, tail


def _anchors(xs: list[Node], ys: list[Node]) -> list[tuple[int, int]]:
    """Pairs of structures that occur once in either list: the longest run that ascends in both."""
    places = []
    for nodes in (xs, ys):
        seen: dict[int, int] = {}
        for i, node in enumerate(nodes):
            seen[node.shape] = -1 if node.shape in seen else i
        places.append(seen)
    shared = [(i, places[1].get(shape, -1)) for shape, i in places[0].items() if i >= 0]
    shared = sorted((i, j) for i, j in shared if j >= 0)
    tops, ends, before = [], [], []  # patience sorting: the smallest end of a run of each length
    for at, (_, j) in enumerate(shared):
        pile = bisect_left(tops, j)
        before.append(ends[pile - 1] if pile else -1)
        tops[pile : pile + 1], ends[pile : pile + 1] = [j], [at]
    found, at = [], ends[-1] if ends else -1
    while at >= 0:
        found.append(shared[at])
        at = before[at]
    return found[::-1]


def _likeness(a: Node, b: Node) -> int:
    """Nodes that a and b share at least if children pair up by equal structure, in any order."""
    if a.tag != b.tag or a.names != b.names:
        return 0
    if a.shape == b.shape:
        return a.size
    theirs = Counter(c.shape for c in b.children)
    out = 1
    for child in a.children:
        if theirs[child.shape] > 0:
            theirs[child.shape] -= 1
            out += child.size
    return out


class _Rows:
    """Likenesses of one node with all nodes of a list, as arrays."""

    def __init__(self, ys: list[Node]):
        kinds: dict[tuple, int] = {}
        self.kinds = np.array([kinds.setdefault((y.tag, y.names), len(kinds)) for y in ys])
        self.numbers = kinds
        self.shapes = np.array([y.shape for y in ys])
        found: dict[int, tuple[list[int], list[int]]] = {}
        for at, y in enumerate(ys):
            for shape, n in Counter(c.shape for c in y.children).items():
                places, counts = found.setdefault(shape, ([], []))
                places.append(at)
                counts.append(n)
        self.children = {shape: (np.array(p), np.array(c)) for shape, (p, c) in found.items()}

    def of(self, x: Node) -> np.ndarray:
        out = np.ones(len(self.shapes), np.int64)
        sizes = {c.shape: c.size for c in x.children}
        for shape, n in Counter(c.shape for c in x.children).items():
            if shape in self.children:
                places, counts = self.children[shape]
                out[places] += sizes[shape] * np.minimum(counts, n)
        out[self.shapes == x.shape] = x.size
        return np.where(self.kinds == self.numbers.get((x.tag, x.names), -1), out, 0)


def _last_row(xs: list[Node], ys: list[Node]) -> np.ndarray:
    """Best weight of all of ``xs`` with each beginning of ``ys``."""
    rows, best = _Rows(ys), np.zeros(len(ys) + 1, np.int64)
    for x in xs:
        best[1:] = np.maximum(best[1:], best[:-1] + rows.of(x))
        np.maximum.accumulate(best, out=best)
    return best


def _linear_space(xs: list[Node], ys: list[Node]) -> list[tuple[int, int]]:
    """Best pairing by likeness, by halving the first list: memory for two rows only."""
    out, todo = [], [(0, len(xs), 0, len(ys))]
    while todo:
        i, n, j, m = todo.pop()
        if i >= n or j >= m:
            continue
        if n - i == 1:
            weights = _Rows(ys[j:m]).of(xs[i])
            at = int(weights.argmax())
            if weights[at] > 0:
                out.append((i, j + at))
            continue
        half = (i + n) // 2
        ahead = _last_row(xs[i:half], ys[j:m])
        behind = _last_row(xs[half:n][::-1], ys[j:m][::-1])[::-1]
        cut = j + int((ahead + behind).argmax())
        todo += [(i, half, j, cut), (half, n, cut, m)]
    return sorted(out)
