"""Layout-aware rendering of HTML pages to plain text.

A page is read tag by tag into a tree: tags that HTML implies (ends of head, p, li,
dt, dd, option, table cells, rows and sections; missing ends at the end of the page)
are supplied, ends that match nothing are dropped. Elements that are never shown
(scripts, styles, head, templates, ``hidden``, ``display:none``,
``visibility:hidden``, ...) are left out; all other text is kept.

Rendering: white space collapses as in a browser, except in ``pre`` and
``textarea``; blocks start on lines of their own; paragraphs and headings, lists
of the outer level, tables and quotes are parted by one blank line; list items
get their bullet or number, indented by depth; the cells of a table are padded to
the width of their column; ``br`` breaks a line and ``hr`` draws one.

The tree is walked with explicit stacks, so depth is not bounded by the
interpreter. Defined cases: NULL html renders as the empty text; text without
tags is one block; unclosed comments and tags end with the page; repeated pages
render alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from stratagate.llm.tables import slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))?)*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANKS = re.compile(r"[ \t\n\f\r]+")
_UNSEEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)

# Sets of HTML element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style title template noscript iframe noembed noframes datalist object"
    " audio video canvas meta link param".split()
)
#: Never shown inside svg and math.
FOREIGN_UNSEEN = frozenset(
    "desc metadata defs symbol clippath mask marker pattern annotation annotation-xml".split()
)
#: Start tags and elements that may stand in head; any other ends it.
IN_HEAD = frozenset(
    "html head base basefont bgsound link meta noframes noscript script style template title".split()
)
#: Start tags that end svg and math, unless an element there holds HTML.
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img"
    " li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul"
    " var".split()
)
_HOLDS_HTML = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li"
    " main menu nav ol p pre search section summary table ul caption option optgroup".split()
)
SPACED = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol menu dl table blockquote pre figure fieldset hr".split()
)
ENDS_P = BLOCK - {"option", "optgroup", "caption", "html", "body"}
#: An opening tag ends the named open elements, up to the scope that holds them.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
}
_P_SCOPE = frozenset({"td", "th", "table", "button", "caption", "object"})


#: Tables inside so many tables are shown as running text.
MOST_NESTED = 40


class Node:
    __slots__ = ("name", "attrs", "children")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.children = name, attrs, []


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), entities.unescape("".join(values)))
    return found


class _Builder:
    """Tree of a page; ``open`` is the path to the element being filled."""

    def __init__(self):
        self.root = Node("#page", {})
        self.open = [self.root]
        self.counts: dict[str, int] = {}

    def text(self, text: str) -> None:
        if text:
            if text.strip(" \t\n\f\r"):
                self._leave_head()
            self.open[-1].children.append(text)

    def _leave_head(self) -> None:
        """End a head that what follows may not stand in."""
        if self.open[-1].name == "head":
            self._pop()

    def foreign(self) -> bool:
        """Whether the element being filled belongs to svg or math."""
        if not (self.counts.get("svg") or self.counts.get("math")):
            return False
        for node in reversed(self.open):
            if node.name in ("svg", "math"):
                return True
            if node.name == "foreignobject":
                return False
        return False

    def _pop(self) -> None:
        node = self.open.pop()
        self.counts[node.name] -= 1

    def _close(self, names, scope) -> None:
        """End the named elements that are open inside the scope."""
        if not any(self.counts.get(n) for n in names):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.open[depth].name
            if name in scope:
                return
            if name in names:
                while len(self.open) > depth:
                    self._pop()
                if not any(self.counts.get(n) for n in names):
                    return

    def start(self, name: str, attrs: dict[str, str], closed: bool) -> None:
        if name not in IN_HEAD:
            self._leave_head()
        if name in ENDS_FOREIGN and self.foreign():
            self._close({"svg", "math"}, _HOLDS_HTML)
        foreign = self.foreign()
        if foreign and name in FOREIGN_UNSEEN:
            attrs = {**attrs, "hidden": ""}
        if name in ENDS_P:
            self._close({"p"}, _P_SCOPE)
        if name == "body":
            self._close({"head"}, ())
        if name in IMPLIED:
            self._close(*IMPLIED[name])
        node = Node(name, attrs)
        self.open[-1].children.append(node)
        if name not in VOID and not (closed and (foreign or name in ("svg", "path", "math"))):
            self.open.append(node)
            self.counts[name] = self.counts.get(name, 0) + 1

    def end(self, name: str) -> None:
        if name == "p" and not self.counts.get("p"):
            self.open[-1].children.append(Node("p", {}))  # as browsers do
            return
        if not self.counts.get(name):
            return
        fence = {"table"} if name not in ("table", "body", "html") else ()
        for depth in range(len(self.open) - 1, 0, -1):
            inside = self.open[depth].name
            if inside == name:
                while len(self.open) > depth:
                    self._pop()
                return
            if inside in fence:
                return


def parse(page: str) -> Node:
    builder, at = _Builder(), 0
    while True:
        found = _TOKEN.search(page, at)
        if not found:
            break
        builder.text(entities.unescape(page[at : found.start()]))
        at = found.end()
        name = found["name"]
        if not name:
            continue
        name = name.lower()
        if found["end"]:
            builder.end(name)
            continue
        attrs = found["attrs"]
        closed = attrs.endswith("/")
        empty = closed and name in RAW and builder.foreign()
        builder.start(name, _attributes(attrs) if attrs.strip() else {}, closed)
        if name in RAW and not empty:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?|\Z", re.I).search(page, at)
            raw = page[at : close.start()]
            builder.text(entities.unescape(raw) if name in ("textarea", "title") else raw)
            builder.end(name)
            at = close.end()
    builder.text(entities.unescape(page[at:]))
    return builder.root


def _unseen(node: Node) -> bool:
    if node.name in UNSEEN:
        return True
    attrs = node.attrs
    if not attrs:
        return False
    if "hidden" in attrs:
        return True
    if node.name == "dialog" and "open" not in attrs:
        return True
    return bool(_UNSEEN_STYLE.search(attrs.get("style", "")))


class _Page:
    """Lines of the rendered text; ``gap`` asks for a blank line before the next."""

    def __init__(self, depth: int = 0):
        self.depth = depth
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = self.gap = False
        self.indent, self.mark = "", ""

    def inline(self, text: str) -> None:
        words = _BLANKS.split(text)
        for i, word in enumerate(words):
            if i:
                self.space = bool(self.line)
            if word:
                if self.space:
                    self.line.append(" ")
                self.line.append(word)
                self.space = False

    def fresh(self) -> None:
        """End the line that is being filled."""
        if self.line:
            self._put("".join(self.line))
        self.line, self.space = [], False

    def _put(self, text: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        if self.mark:
            self.lines.append(f"{self.indent[: -len(self.mark)]}{self.mark}{text}".rstrip())
            self.mark = ""
        else:
            self.lines.append(f"{self.indent}{text}".rstrip())

    def parted(self) -> None:
        self.fresh()
        self.gap = True

    def verbatim(self, text: str) -> None:
        self.fresh()
        for line in text.expandtabs(8).split("\n"):
            self._put(line)

    def broken(self) -> None:
        """A line break, which may leave an empty line."""
        if self.line:
            self.fresh()
        elif self.lines and not self.gap and not self.mark:
            self._put("")

    def result(self) -> str:
        self.fresh()
        return "\n".join(self.lines).strip("\n")


def _number(node: Node) -> int:
    start = node.attrs.get("start", "1")
    return int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1


def _all_text(node: Node, out: list[str]) -> None:
    stack = [node]
    while stack:
        at = stack.pop()
        if isinstance(at, str):
            out.append(at)
        elif at.name == "br":
            out.append("\n")
        elif at is node or not _unseen(at):
            stack.extend(reversed(at.children))


def _rows(table: Node, depth: int) -> tuple[list[str], list[list[Node]]]:
    """Captions and visible rows of cells of one table, not of tables inside it."""
    captions, rows, stack = [], [], list(reversed(table.children))
    loose: list[Node] = []
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            if node.strip():
                captions.append(_BLANKS.sub(" ", node).strip())
        elif _unseen(node):
            continue
        elif node.name == "tr":
            rows.append([c for c in node.children if isinstance(c, str) and c.strip() or isinstance(c, Node) and not _unseen(c)])
        elif node.name in ("td", "th"):
            loose.append(node)
            rows.append([node])
        elif node.name in ("thead", "tbody", "tfoot", "colgroup"):
            stack.extend(reversed(node.children))
        else:
            captions.append(render_node(node, depth))
    return [c for c in captions if c], rows


def _table(node: Node, page: _Page) -> None:
    captions, rows = _rows(node, page.depth + 1)
    cells, widths = [], []
    for row in rows:
        line, at = [], 0
        for cell in row:
            shown = _BLANKS.sub(" ", cell).strip() if isinstance(cell, str) else render_node(cell, page.depth + 1)
            lines = shown.split("\n")
            while len(widths) <= at:
                widths.append(0)
            span = cell.attrs.get("colspan", "1") if isinstance(cell, Node) else "1"
            span = min(int(span), 1000) if re.fullmatch(r"[1-9]\d{0,3}", span) else 1
            if span == 1:
                widths[at] = max(widths[at], *map(len, lines))
            line.append((at, lines))
            at += span
        cells.append(line)
    places = [0]
    for width in widths:
        places.append(places[-1] + width + 2)
    page.parted()
    for caption in captions:
        for text in caption.split("\n"):
            page._put(text)
    for line in cells:
        for depth in range(max((len(lines) for _, lines in line), default=0)):
            text = ""
            for at, lines in line:
                place = places[at]
                shown = lines[depth] if depth < len(lines) else ""
                if shown:
                    text = text.ljust(place) + ("  " if len(text) > place else "") + shown
            page._put(text)
    page.parted()


def render_node(root: Node, depth: int = 0) -> str:
    """Visible text of an element; ``depth`` counts the tables around it."""
    page = _Page(depth)
    # (node, None) opens, (node, undo) closes; lists carry [kind, next number]
    stack: list[tuple] = [(child, None) for child in reversed(root.children)]
    lists: list[list] = []
    while stack:
        node, undo = stack.pop()
        if isinstance(node, str):
            page.inline(node)
            continue
        name = node.name
        if undo is not None:
            indent, listed = undo
            page.fresh()
            page.indent = indent
            if listed:
                lists.pop()
            if name == "li":
                page.mark = ""
            if name in SPACED and not (name in ("ul", "ol", "menu") and lists):
                page.parted()
            continue
        if _unseen(node):
            continue
        if name == "br":
            page.broken()
        elif name == "wbr":
            pass
        elif name == "hr":
            page.parted()
            page._put("-" * 20)
            page.parted()
        elif name == "img":
            page.inline(node.attrs.get("alt", ""))
        elif name == "input":
            if node.attrs.get("type", "text").lower() in ("submit", "button", "reset", "text"):
                page.inline(node.attrs.get("value", ""))
        elif name in ("pre", "textarea", "xmp"):
            out: list[str] = []
            _all_text(node, out)
            page.parted()
            page.verbatim("".join(out).replace("\r\n", "\n").strip("\n"))
            page.parted()
        elif name == "table" and depth < MOST_NESTED:
            _table(node, page)
        elif name in BLOCK:
            page.fresh()
            if name in SPACED and not (name in ("ul", "ol", "menu") and lists):
                page.parted()
            undo, listed = page.indent, False
            if name in ("ul", "ol", "menu"):
                lists.append([name, _number(node)])
                listed = True
            elif name == "li":
                mark = "- "
                if lists and lists[-1][0] == "ol":
                    mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                page.indent += " " * len(mark)
                page.mark = mark
            elif name in ("dd", "blockquote"):
                page.indent += "    "
            children = node.children
            if name == "details" and "open" not in node.attrs:
                children = [c for c in children if isinstance(c, Node) and c.name == "summary"]
            stack.append((node, (undo, listed)))
            stack.extend((child, None) for child in reversed(children))
        elif name in ("td", "th", "tr"):
            page.inline(" ")
            stack.append((" ", None))
            stack.extend((child, None) for child in reversed(node.children))
        else:
            stack.extend((child, None) for child in reversed(node.children))
    return page.result()


def render(page: str | None) -> str:
    return render_node(parse(page)) if page else ""


def rendered(pages: DataFrame) -> DataFrame:
    """page_id and the visible text of every row."""

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 64):
            texts = [render(h) for h in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(texts, pa.string())], ["page_id", "text"]
            )

    return pages.select("page_id", "html").mapInArrow(show, "page_id long, text string")
