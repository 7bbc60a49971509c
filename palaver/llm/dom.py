"""Pages of any quality as trees of elements, their folded shapes, and simple tree matching between shapes."""

from __future__ import annotations

import html
import re
from functools import lru_cache

#: A comment, declaration or tag; one that isn't closed reaches to the end. Quotes count only after an equals sign.
MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|</>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s\"'/]|\Z)", re.IGNORECASE)

# The elements of HTML by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: What a start tag closes, and what it doesn't look beyond.
CLOSES = {
    **dict.fromkeys(["li"], (("li",), ("ul", "ol", "menu"))),
    **dict.fromkeys(["dt", "dd"], (("dt", "dd"), ("dl",))),
    **dict.fromkeys(["td", "th"], (("td", "th"), ("tr", "table"))),
    "tr": (("tr",), ("table",)),
    **dict.fromkeys(["tbody", "thead", "tfoot"], (("tbody", "thead", "tfoot"), ("table",))),
    **dict.fromkeys(["option", "optgroup"], (("option",), ("select",))),
}
AROUND_P = ("table", "td", "th", "caption", "button", "object", "template")

#: Elements nested deeper share the node above; a node with more kinds of children in a row than this folds equal ones wherever they stand.
MAX_DEPTH, MAX_CHILDREN = 100, 200


class Shape:
    """An element with its children after folding; equal shapes are one object."""

    __slots__ = ("label", "kids", "size")
    known: dict = {}

    @classmethod
    def of(cls, label: str, kids: tuple[Shape, ...]) -> Shape:
        if len(cls.known) > 200_000:
            forget()
        key = (label, *map(id, kids))
        found = cls.known.get(key)
        if found is None:
            found = cls.known[key] = cls()
            found.label, found.kids, found.size = label, kids, 1 + sum(kid.size for kid in kids)
        return found


def forget() -> None:
    """Drop all shapes that a task has met, and what was computed on them."""
    Shape.known = {}
    for cached in (score, pairs, merged, read):
        cached.cache_clear()


@lru_cache(100_000)
def score(a: Shape, b: Shape) -> int:
    """Simple tree matching: the most nodes of two trees that match, root on root, with order and depth kept."""
    if a.label != b.label:
        return 0
    return a.size if a is b else 1 + _table(a, b)[-1][-1]


def _table(a: Shape, b: Shape) -> list[list[int]]:
    rows = [[0] * (len(b.kids) + 1)]
    for x in a.kids:
        row = [0]
        for j, y in enumerate(b.kids):
            row.append(max(row[j], rows[-1][j + 1], rows[-1][j] + score(x, y) if x.label == y.label else 0))
        rows.append(row)
    return rows


@lru_cache(100_000)
def pairs(a: Shape, b: Shape) -> tuple[tuple[int, int], ...]:
    """Positions of the children of two nodes that match each other."""
    if a is b:
        return tuple((k, k) for k in range(len(a.kids)))
    rows, found, i, j = _table(a, b), [], len(a.kids), len(b.kids)
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            found.append((i, j))
    return tuple(reversed(found))


@lru_cache(100_000)
def merged(a: Shape, b: Shape) -> Shape:
    """One shape that has the children of both, matching ones once."""
    if a is b:
        return a
    kids, i, j = [], 0, 0
    for x, y in (*pairs(a, b), (len(a.kids), len(b.kids))):
        kids += [*a.kids[i:x], *b.kids[j:y]]
        if x < len(a.kids):
            kids.append(merged(a.kids[x], b.kids[y]))
        i, j = x + 1, y + 1
    return Shape.of(a.label, folded(kids))


def folded(kids: list[Shape]) -> tuple[Shape, ...]:
    """Children with runs of the same label as one."""
    out: list[Shape] = []
    for kid in kids:
        if out and out[-1].label == kid.label:
            out[-1] = merged(out[-1], kid)
        else:
            out.append(kid)
    if len(out) > MAX_CHILDREN:
        by_label: dict[str, Shape] = {}
        for kid in out:
            by_label[kid.label] = merged(by_label[kid.label], kid) if kid.label in by_label else kid
        out = list(by_label.values())
    return tuple(out)


def wrote(shape: Shape) -> str:
    """A shape as text: label{children}."""
    parts: list[str] = []
    todo: list = [shape]
    while todo:
        one = todo.pop()
        if isinstance(one, str):
            parts.append(one)
        else:
            parts.append(f"{one.label}{{")
            todo += ["}", *reversed(one.kids)]
    return "".join(parts)


@lru_cache(20_000)
def read(text: str) -> Shape:
    stack: list[tuple[str, list[Shape]]] = [("", [])]
    for label, bracket in re.findall(r"([^{}]*)([{}])", text):
        if bracket == "{":
            stack.append((label, []))
        else:
            name, kids = stack.pop()
            stack[-1][1].append(Shape.of(name, tuple(kids)))
    return stack[0][1][0]


def _label(tag: str, attributes: str) -> str:
    """The tag with its classes, id and role, and a mark if it isn't shown; digits count as equal."""
    marks = []
    if attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
                marks.append(".hidden")
            elif name in ("class", "id", "role"):
                prefix = {"class": ".", "id": "#", "role": "@"}[name]
                marks += [prefix + re.sub(r"[^\w-]+", "_", re.sub(r"\d+", "0", word)) for word in sorted(value.split())]
    return re.sub(r"[{}]", "_", tag) + "".join(marks)


class Page:
    """The folded shape of a page, and its pieces of text: node of the shape (in preorder), block, text and whether it is a link's."""

    def __init__(self, source: str):
        self.labels, self.kids = ["#"], [[]]
        self.owners: list[int] = []
        self.blocks: list[int] = []
        self.texts: list[str] = []
        self.links: list[bool] = []
        self._block = 0
        self._open: list[tuple[str, int]] = [("#", 0)]
        self._count: dict[str, int] = {}
        self._parse(source)
        self.shape, self.nodes = self._fold()

    def _parse(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            found = MARKUP.search(source, at)
            start = found.start() if found else size
            if start > at:
                self._text(source[at:start])
            if found is None:
                return
            at = found.end()
            tag = found[2]
            if tag is None:
                continue
            tag = tag.lower()
            if not source.endswith(">", start, at):
                return  # the page ends inside a tag
            if found[1]:
                self._end(tag)
            else:
                self._start(tag, found[3])
                if tag in RAW:
                    closed = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(source, at)
                    at = closed.start() if closed else size

    def _text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        words = " ".join(text.split())
        fresh = not self.blocks or self.blocks[-1] != self._block
        if not words:
            if not fresh and text and not self.texts[-1].endswith(" "):
                self.texts[-1] += " "
            return
        self.owners.append(self._open[-1][1])
        self.blocks.append(self._block)
        self.texts.append(" " * text[0].isspace() + words + " " * text[-1].isspace())
        self.links.append(self._count.get("a", 0) > 0)

    def _start(self, tag: str, attributes: str) -> None:
        if tag in CLOSES:
            closing, barrier = CLOSES[tag]
            self._close(closing, barrier)
        if tag in BLOCKS:
            self._close(("p",), AROUND_P)
            self._block += 1
        if tag == "br":
            self._text(" ")
        if tag in VOID:
            return
        if len(self._open) <= MAX_DEPTH:
            node = len(self.labels)
            self.labels.append(_label(tag, attributes))
            self.kids.append([])
            self.kids[self._open[-1][1]].append(node)
        else:
            node = self._open[-1][1]
        self._open.append((tag, node))
        self._count[tag] = self._count.get(tag, 0) + 1

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._block += 1
        elif tag == "br":
            self._text(" ")
        self._close((tag,), ())

    def _close(self, tags: tuple[str, ...], barrier: tuple[str, ...]) -> None:
        """Close the innermost open element of these tags, with all inside it."""
        if not any(self._count.get(tag) for tag in tags):
            return
        for at in range(len(self._open) - 1, 0, -1):
            name = self._open[at][0]
            if name in tags:
                for gone, _ in self._open[at:]:
                    self._count[gone] -= 1
                del self._open[at:]
                return
            if name in barrier:
                return

    def _fold(self) -> tuple[Shape, list[int]]:
        # Children have larger numbers than their parents.
        shapes: list[Shape] = [None] * len(self.labels)
        for node in range(len(self.labels) - 1, -1, -1):
            shapes[node] = Shape.of(self.labels[node], folded([shapes[kid] for kid in self.kids[node]]))
        place = [0] * len(self.labels)
        todo = [(0, shapes[0])]
        while todo:
            node, shape = todo.pop()
            starts, start = [], place[node] + 1
            for kid in shape.kids:
                starts.append(start)
                start += kid.size
            k, n = 0, len(shape.kids)
            for child in self.kids[node]:
                label = self.labels[child]
                # A folded node's children hold those of each of its elements in order, unless they were too many.
                k = next((i % n for i in range(k, k + n) if shape.kids[i % n].label == label), 0)
                place[child] = starts[k]
                todo.append((child, shape.kids[k]))
        return shapes[0], [place[owner] for owner in self.owners]
