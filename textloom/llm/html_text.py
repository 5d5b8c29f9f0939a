"""Layout-aware text of HTML pages: tokens, a tree with implied tags, and a renderer for what is visible.

The renderer keeps block spacing, list markers with indents, preformatted text, and tables as aligned columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of the HTML standard.
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre listing search section summary table ul dd dt xmp plaintext".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Where the search for an open element ends.
SCOPE = frozenset("html table td th caption template applet marquee object svg math".split())
LIST_SCOPE = SCOPE | {"ul", "ol", "menu", "dir"}
ROW_GROUPS = frozenset("thead tbody tfoot".split())
# Elements that show nothing, or only what stands in for them.
HIDDEN = frozenset(
    "head title script style template datalist area base link meta param source track noembed noframes iframe object applet audio video "
    "canvas rp metadata desc annotation annotation-xml".split()
)
# Blank lines around a block; 0 is a line break only.
MARGIN = dict.fromkeys("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl blockquote pre listing xmp plaintext figure fieldset hr table".split(), 1) | dict.fromkeys(
    "address article aside body caption center dd details dialog div dt figcaption footer form header hgroup html legend li main "
    "nav optgroup option search section summary textarea tr thead tbody tfoot".split(),
    0,
)
# What one start tag closes first, up to the given scope.
ENDS = {
    "li": (frozenset(["li"]), LIST_SCOPE),
    "dt": (frozenset(["dt", "dd"]), SCOPE | {"dl"}),
    "dd": (frozenset(["dt", "dd"]), SCOPE | {"dl"}),
    "option": (frozenset(["option"]), SCOPE | {"select"}),
    "optgroup": (frozenset(["option", "optgroup"]), SCOPE | {"select"}),
    "rt": (frozenset(["rt", "rp"]), SCOPE | {"ruby"}),
    "rp": (frozenset(["rt", "rp"]), SCOPE | {"ruby"}),
    "a": (frozenset(["a"]), SCOPE | CLOSES_P),
}
# Elements nested deeper become siblings, as in browsers; their text is kept.
DEEPEST = 512
# Columns are padded up to this width; longer cells stand on their own width.
WIDEST = 100

TAG = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^'\">]|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACES = re.compile(r"[ \t\n\r\f]+")
FOLDED = re.compile(r"[\t\n\r\f]|  ")
NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\b", re.I)
WHITE_SPACE = re.compile(r"(?:^|;)\s*white-space\s*:\s*(pre(?:-wrap|-line)?|normal|nowrap)\b", re.I)
TEXT_ALIGN = re.compile(r"(?:^|;)\s*text-align\s*:\s*(right|center|left)\b", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def parse(html: str) -> Node:
    """The tree of a page. Missing end tags, rows and row groups are implied; stray end tags are ignored."""
    root = Node("html")
    stack = [root]
    append = lambda item: stack[-1].children.append(item)

    def find(tags: frozenset[str], scope: frozenset[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in scope:
                return 0
        return 0

    def close(tags: frozenset[str], scope: frozenset[str]) -> bool:
        if at := find(tags, scope):
            del stack[at:]
        return bool(at)

    def open_node(tag: str, attrs: dict[str, str] | None = None) -> None:
        node = Node(tag, attrs)
        append(node)
        if len(stack) < DEEPEST:
            stack.append(node)

    def table_place(tag: str) -> bool:
        """Close and open what a table part needs around it; False if there is no table."""
        at = find(frozenset(["table"]), frozenset(["template"]))
        if not at:
            return False
        inner = {n.tag: i for i, n in enumerate(stack) if i > at}
        if tag in ("td", "th"):
            row = inner.get("tr")
            if row is not None:
                del stack[row + 1 :]
                return True
            del stack[(max((inner[g] for g in ROW_GROUPS if g in inner), default=at)) + 1 :]
            if stack[-1].tag == "table":
                open_node("tbody")
            open_node("tr")
        elif tag == "tr":
            del stack[(max((inner[g] for g in ROW_GROUPS if g in inner), default=at)) + 1 :]
            if stack[-1].tag == "table":
                open_node("tbody")
        elif tag != "col" or stack[-1].tag != "colgroup":
            del stack[at + 1 :]
        return True

    pos, size, last = 0, len(html), html.rfind(">")
    while pos < size:
        lt = html.find("<", pos)
        if lt < 0:
            append(html[pos:])
            break
        if lt > pos:
            append(html[pos:lt])
        if lt > last and html[lt + 1 : lt + 2].strip("/!?").isalpha():
            break  # a tag that never ends
        found = TAG.match(html, lt)
        if not found:
            append("<")
            pos = lt + 1
            continue
        pos = found.end()
        name = found[2] or found[5]
        if not name:
            continue
        tag, rest = name.lower(), found[3] if found[2] else found[6]
        if found[1] or found[4]:
            if tag == "br":
                append(Node("br"))
            elif tag == "p":
                if not close(frozenset(["p"]), SCOPE):
                    append(Node("p"))
            elif tag in HEADINGS:
                close(HEADINGS, SCOPE)
            elif tag in ("html", "body"):
                pass  # what follows still belongs to the page
            elif tag in ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "table"):
                close(frozenset([tag]), frozenset(["table", "template"]) - {tag})
            elif tag == "li":
                close(frozenset(["li"]), LIST_SCOPE)
            else:
                close(frozenset([tag]), SCOPE - {tag})
            continue
        attrs = attributes(rest) if rest and not rest.isspace() else {}
        if tag in ("html", "body"):
            close(frozenset(["head"]), frozenset(["body"]))
            stack[0].attrs = attrs | stack[0].attrs if tag == "body" else stack[0].attrs
            continue
        if tag not in ("head", "meta", "title", "link", "script", "style", "base", "template", "noscript") and len(stack) == 2 and stack[1].tag == "head":
            del stack[1:]
        if tag in CLOSES_P:
            close(frozenset(["p"]), SCOPE | {"button"})
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            stack.pop()
        if tag in ENDS:
            close(*ENDS[tag])
        if tag in ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup", "col") and not table_place(tag):
            continue
        if tag == "image":
            tag = "img"
        if tag in VOID:
            append(Node(tag, attrs))
        elif tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, pos) if tag != "plaintext" else None
            node = Node(tag, attrs)
            body = html[pos : end.start() if end else size]
            node.children.append(body if tag in ("textarea", "title") else body.replace("&", "&amp;"))
            append(node)
            pos = size if not end else (html.find(">", end.end()) + 1 or size)
        elif rest.rstrip().endswith("/") and any(n.tag in ("svg", "math") for n in stack[-8:]):
            append(Node(tag, attrs))
        else:
            open_node(tag, attrs)
    return root


class Flow:
    """Lines of a block of text: the page, or one table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.margin, self.indent, self.space, self.markers = 0, 0, False, ""

    def text(self, data: str, pre: bool) -> None:
        if pre:
            first, *more = data.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._put(first)
            for line in more:
                self.line_break()
                self._put(line)
            return
        words = SPACES.sub(" ", data) if FOLDED.search(data) else data
        if not words:
            return
        if words[0] == " ":
            self.space = True
            words = words[1:]
        if words:
            tail = words[-1] == " "
            self._put(words[:-1] if tail else words)
            self.space = tail

    def _put(self, data: str) -> None:
        if data:
            if self.space and self.parts:
                self.parts.append(" ")
            self.space = False
            self.parts.append(data)

    def end_line(self) -> None:
        """End the line if there is one."""
        if self.parts:
            self.line_break()
        self.space = False

    def line_break(self) -> None:
        line = "".join(self.parts).replace("\xa0", " ").rstrip()
        if self.lines and line:
            self.lines += [""] * self.margin
        if line:
            self.lines.append(" " * (self.indent - len(self.markers)) + self.markers + line)
            self.margin, self.markers = 0, ""
        elif self.lines and not self.margin:
            self.lines.append("")
        self.parts, self.space = [], False

    def block(self, margin: int) -> None:
        self.end_line()
        if self.lines:
            blank = 1 if not self.lines[-1] else 0
            self.margin = max(self.margin, margin - blank)

    def add_lines(self, lines: list[str]) -> None:
        for line in lines:
            if line:
                self.parts.append(line)
                self.line_break()
            elif self.lines:
                self.lines.append("")

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        while self.lines and not self.lines[0]:
            self.lines.pop(0)
        return self.lines


def _number(value: int, kind: str) -> str:
    if kind in ("a", "A") and value > 0:
        text = ""
        while value:
            value, digit = divmod(value - 1, 26)
            text = chr(97 + digit) + text
        return text if kind == "a" else text.upper()
    if kind in ("i", "I") and 0 < value < 4000:
        text = ""
        for n, sign in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), "m cm d cd c xc l xl x ix v iv i".split(), strict=True):
            text += sign * (value // n)
            value %= n
        return text if kind == "i" else text.upper()
    return str(value)


def _int(text: str | None, default: int, least: int, most: int) -> int:
    try:
        return min(max(int(text), least), most) if text else default
    except ValueError:
        return default


class Grid:
    """Cells of a table with spans, laid out as aligned text."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, int, list[str], str]]] = []
        self.taken: dict[int, int] = {}  # column -> rows it is still covered for
        self.caption: list[str] = []

    def row(self) -> None:
        self.rows.append([])
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.at = 0

    def cell(self, lines: list[str], colspan: int, rowspan: int, align: str) -> None:
        if not self.rows:
            self.row()
        while self.at in self.taken:
            self.at += 1
        self.rows[-1].append((self.at, colspan, lines, align))
        if rowspan > 1:
            self.taken |= {self.at + i: rowspan for i in range(colspan)}
        self.at += colspan

    def layout(self) -> list[str]:
        rows = [r for r in self.rows if any(c[2] for c in r)]
        width: dict[int, int] = {}
        for row in rows:
            for column, span, lines, _ in row:
                if span == 1 and lines:
                    width[column] = max(width.get(column, 0), min(max(map(len, lines)), WIDEST))
        for row in rows:
            for column, span, lines, _ in row:
                if span > 1 and lines:
                    # What a spanning cell needs beyond its columns goes to the last of them.
                    have = sum(width.get(c, 0) for c in range(column, column + span)) + 2 * (span - 1)
                    need = min(max(map(len, lines)), WIDEST)
                    if need > have:
                        width[column + span - 1] = width.get(column + span - 1, 0) + need - have
        columns = sorted(width)
        start, at = {}, 0
        for c in columns:
            start[c] = at
            at += width[c] + 2
        out = []
        for row in rows:
            for i in range(max(len(c[2]) for c in row)):
                line = ""
                for column, span, lines, align in row:
                    if i < len(lines) and lines[i]:
                        inner = [c for c in range(column, column + span) if c in width]
                        room = (start[inner[-1]] + width[inner[-1]] - start[inner[0]]) if inner else 0
                        text = lines[i]
                        text = text.rjust(room) if align == "right" else text.center(room).rstrip() if align == "center" else text
                        place = start[inner[0]] if inner else 0
                        line = line.ljust(place) if len(line) <= place and (not line or len(line) + 2 <= place) else line + "  "
                        line += text
                out.append(line.rstrip())
        return self.caption + out


def render(root: Node) -> tuple[str, str | None]:
    """(visible text, title). Walks the tree without recursion, so depth does not matter."""
    flow, title = Flow(), None
    flows, grids, lists = [flow], [], []
    # (node, visible, preformatted) to enter, or a call that leaves a node.
    todo: list = [(root, True, False)]
    while todo:
        item = todo.pop()
        if callable(item):
            item()
            continue
        node, visible, pre = item
        if isinstance(node, str):
            if visible and (node[0] not in " \n" or not node.isspace() or pre or flows[-1].parts):
                inside_grid = grids and grids[-1][1] is flows[-1]
                if not (inside_grid and node.isspace()):
                    flows[-1].text(unescape(node) if "&" in node else node, pre)
            continue
        tag, attrs = node.tag, node.attrs
        if tag == "title" and title is None:
            title = SPACES.sub(" ", unescape("".join(c for c in node.children if isinstance(c, str)))).strip() or None
        style = attrs.get("style", "")
        if tag in HIDDEN or "hidden" in attrs and attrs["hidden"].lower() != "until-found" or style and NOT_SHOWN.search(style):
            continue
        if tag == "dialog" and "open" not in attrs or tag == "input" and attrs.get("type", "").lower() == "hidden":
            continue
        if style:
            if shown := VISIBILITY.findall(style):
                visible = shown[-1].lower() == "visible"
            if space := WHITE_SPACE.findall(style):
                pre = space[-1].lower().startswith("pre")
        here = flows[-1]
        if tag == "br":
            if visible:
                here.line_break()
            continue
        if tag == "input":
            if visible and attrs.get("type", "").lower() in ("submit", "button", "reset") and attrs.get("value"):
                here.text(attrs["value"], False)
            continue
        leave = []
        if tag == "table":
            here.block(1)
            inner = Flow()
            grid = Grid()
            flows.append(inner)  # text outside of cells
            grids.append((grid, inner))
            leave.append(_table_end(flows, grids, grid, inner, here))
        elif tag == "tr" and grids:
            grids[-1][0].row()
        elif tag in ("td", "th", "caption") and grids:
            cell = Flow()
            flows.append(cell)
            leave.append(_cell_end(flows, grids[-1][0], cell, tag, attrs, style))
        elif tag in MARGIN:
            margin = MARGIN[tag]
            if tag in ("ul", "ol", "menu", "dir"):
                margin = 0 if lists else 1
                step = -1 if "reversed" in attrs else 1
                items = sum(1 for c in node.children if isinstance(c, Node) and c.tag == "li")
                lists.append([tag, _int(attrs.get("start"), items if step < 0 else 1, -(10**9), 10**9), step, attrs.get("type", "1")])
                leave.append(lists.pop)
            here.block(margin)
            shift = 4 if tag in ("dd", "blockquote") else 0
            if tag == "li":
                kind = lists[-1] if lists else ["ul", 1, 1, "1"]
                marker = "* "
                if kind[0] == "ol":
                    kind[1] = _int(attrs.get("value"), kind[1], -(10**9), 10**9)
                    marker = f"{_number(kind[1], kind[3])}. "
                    kind[1] += kind[2]
                shift = len(marker)
                here.markers += marker if visible else ""
                if not visible:
                    shift = 0
                leave.append(lambda here=here, marker=marker: setattr(here, "markers", here.markers.removesuffix(marker)))
            if shift:
                here.indent += shift
                leave.append(lambda here=here, shift=shift: setattr(here, "indent", here.indent - shift))
            # The last one is called first: the line ends before its marker and indent go.
            leave.append(lambda here=here, margin=margin: here.block(margin))
            if tag in ("pre", "listing", "xmp", "plaintext", "textarea"):
                pre = True
                if node.children and isinstance(node.children[0], str):
                    node.children[0] = re.sub(r"\A\r?\n", "", node.children[0])
        elif tag == "q" and visible:
            here.text("“", False)
            leave.append(lambda: flows[-1].text("”", False))
        todo += leave
        todo += [(child, visible, pre) for child in reversed(node.children) if child != ""]
    return "\n".join(flow.done()), title


def _table_end(flows: list, grids: list, grid: Grid, outside: Flow, here: Flow):
    def end() -> None:
        flows.pop()
        grids.pop()
        # Text between table parts is shown before the table.
        here.add_lines(outside.done())
        here.add_lines(grid.layout())
        here.block(1)

    return end


def _cell_end(flows: list, grid: Grid, cell: Flow, tag: str, attrs: dict[str, str], style: str):
    def end() -> None:
        flows.pop()
        lines = cell.done()
        if tag == "caption":
            grid.caption += lines
            return
        aligned = TEXT_ALIGN.findall(style) if style else []
        align = (aligned[-1] if aligned else attrs.get("align", "left")).lower()
        grid.cell(lines, _int(attrs.get("colspan"), 1, 1, 1000), _int(attrs.get("rowspan"), 1, 1, 65534), align)

    return end


def visible_text(html: str | None) -> tuple[str, str | None]:
    """(visible text, title) of a page; NULL and empty pages give an empty text."""
    return render(parse(html)) if html else ("", None)


def extract_text(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """(``page_id``, ``title``, ``text``) per row of ``pages``: the visible text of the whole page as it is laid out.

    NULL and empty pages give an empty text and a NULL title; repeated rows and NULL ids stay; other columns are not read. Nothing is shuffled.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [visible_text(h) for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([t for _, t in found], pa.string()), pa.array([x for x, _ in found], pa.string())],
                    ["page_id", "title", "text"],
                )

    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(html_column).cast("string").alias("html"))
    return rows.mapInArrow(extract, "page_id long, title string, text string")
