"""HTML extraction by layout: a tree with implied tags, rendered as visible text.

The scanner reads tags, comments and raw-text elements; the tree builder
closes what HTML closes by implication (p before blocks, li, dt/dd, table
parts, option); invisible elements are left out, while the text of svg, math and
the fallback of object are kept; the renderer keeps block
spacing, list markers and indents, preformatted text, and lays table cells
out in aligned columns, with colspan (to 1,000) and rowspan (in the first 200
columns of a table). Neither builder nor renderer recurses, so deep nesting
and very long texts are no problem.

Defined results: null and empty html give an empty text; broken markup is
kept as text; unclosed elements end with the document. Repeated rows are
rendered each on their own, null ids are kept, an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from martspark.llm.common import per_batch

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript title iframe noembed noframes datalist canvas audio video".split())
#: Parts of svg and math that are not shown.
UNSEEN = frozenset("title desc metadata defs symbol clippath mask marker pattern annotation annotation-xml".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table ul caption tr thead tbody tfoot".split())
#: Blocks set off by an empty line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl table pre blockquote article section figure hr form fieldset".split())
ENDS_P = BLOCKS - frozenset("html body tr thead tbody tfoot caption dd dt li".split())
#: An opening tag closes these open elements, up to one of the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}),
}
_TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|[!?][^>]*(?:>|\Z)|/(?P<close>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z))", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_INVISIBLE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
#: The end of attributes whose slash belongs to an unquoted value.
_SLASH_IN_VALUE = re.compile(r"=\s*[^\s\"'>]+/\Z")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("name", "attrs", "children")

    def __init__(self, name: str, attrs: dict[str, str] | None = None):
        self.name, self.attrs, self.children = name, attrs or {}, []


def scan(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, value, attributes): text, open, close."""
    at = 0
    while at < len(html):
        tag = _TAG.search(html, at)
        if tag is None:
            yield "text", html[at:], ""
            return
        if tag.start() > at:
            yield "text", html[at:tag.start()], ""
        at = tag.end()
        if name := tag["close"]:
            yield "close", name.lower(), ""
        elif name := tag["open"]:
            name = name.lower()
            yield "open", name, tag["attrs"]
            if name in RAW:
                end = re.compile(rf"</{name}\b", re.I).search(html, at)
                stop = end.start() if end else len(html)
                if name not in HIDDEN:
                    yield "text", html[at:stop], ""
                at = stop


def attributes(text: str) -> dict[str, str]:
    return {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTR.findall(text)} if text.strip(" /") else {}


def build(html: str) -> Node:
    """The tree of a document, with implied end tags."""
    root = Node("#root")
    stack = [root]
    open_now = {"#root": 1}

    def pop(to: int) -> None:
        while len(stack) > to:
            open_now[stack.pop().name] -= 1

    def close(names, stops) -> None:
        if any(open_now.get(n) for n in names):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in stops:
                    return
                if stack[i].name in names:
                    outer = i
                    while outer > 1 and stack[outer - 1].name in names:
                        outer -= 1
                    return pop(outer)

    for kind, value, attrs in scan(html):
        if kind == "text":
            stack[-1].children.append(value)
        elif kind == "open":
            if value in IMPLIED:
                close(*IMPLIED[value])
            if value in ENDS_P:
                close({"p"}, {"table", "td", "th", "li", "div", "article", "section", "blockquote"})
            node = Node(value, attributes(attrs))
            drawn = value in ("svg", "math") or open_now.get("svg") or open_now.get("math")
            if drawn and value in UNSEEN:
                node.attrs["hidden"] = ""
            if drawn and value == "text":
                stack[-1].children.append(" ")  # drawn apart from the text before
            stack[-1].children.append(node)
            if value not in VOID and not (drawn and attrs.endswith("/") and not _SLASH_IN_VALUE.search(attrs)):
                stack.append(node)
                open_now[value] = open_now.get(value, 0) + 1
        elif open_now.get(value):
            i = len(stack) - 1
            while stack[i].name != value and not (stack[i].name in ("table", "td", "th") and value not in ("table", "tr", "thead", "tbody", "tfoot", "body", "html")):
                i -= 1
            if stack[i].name == value:
                pop(i)
    return root


def hidden(node: Node) -> bool:
    a = node.attrs
    return node.name in HIDDEN or "hidden" in a or node.name == "input" and a.get("type", "").lower() == "hidden" or bool(_INVISIBLE.search(a.get("style", "")))


class _Lines:
    """Text laid out line by line, with pending blank lines."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap, self.marker = 0, ""

    def text(self, value: str, indent: int) -> None:
        value = _SPACE.sub(" ", value)
        if not self.parts:
            value = value.lstrip(" ")
        elif self.parts[-1].endswith(" "):
            value = value.lstrip(" ")
        if value:
            if not self.parts:
                self.parts.append(" " * max(0, indent - len(self.marker)) + self.marker if self.marker else " " * indent)
                self.marker = ""
            self.parts.append(value)

    def end(self, gap: int = 0) -> None:
        if self.parts:
            line = "".join(self.parts).rstrip(" ")
            self.parts = []
            self.put([line])
        self.gap = max(self.gap, gap)

    def put(self, lines: list[str]) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        self.lines += lines


#: Widest column that is padded, in characters; most that padding may lengthen a table; columns in which rowspan counts.
ALIGNED, LONGER, SPANNED = 120, 32, 200


def _number(text: str, otherwise: int) -> int:
    """A whole number of up to nine ASCII digits."""
    return int(text) if re.fullmatch(r"-?[0-9]{1,9}", text.strip()) else otherwise


class _Grid:
    """A table's cells by row and column."""

    def __init__(self):
        self.rows: list[dict[int, str]] = []
        self.ends: list[int] = []  # of each row, the column after its last cell
        self.covered: dict[int, int] = {}  # of a column, the first row that no cell from above reaches

    def row(self) -> int:
        self.rows.append({})
        self.ends.append(0)
        return len(self.rows) - 1

    def place(self, r: int, text: str, across: int, down: int) -> None:
        column = self.ends[r]
        while self.covered.get(column, 0) > r:
            column += 1
        self.rows[r][column] = text
        self.ends[r] = column + across
        if down > 1:
            self.covered.update(dict.fromkeys(range(column, min(column + across, SPANNED)), r + down))

    def lines(self) -> list[str]:
        """Every column as wide as its widest cell; a cell of several lines takes several lines.

        Columns in which no cell starts take no room. A column with a cell wider than ALIGNED characters is
        not padded. A table that padding would make more than LONGER times as long has two spaces between its cells instead.
        """
        split = [{c: cell.split("\n") for c, cell in row.items()} for row in self.rows]
        width: dict[int, int] = {}
        for row in split:
            for c, cell in row.items():
                width[c] = max(width.get(c, 0), *map(len, cell))
        columns = sorted(width)
        place, room, at = {}, [0], 0  # of a column, its number; width of the columns before each
        for at, c in enumerate(columns, 1):
            width[c] = width[c] if width[c] <= ALIGNED else 0
            place[c] = at
            room.append(room[-1] + width[c] + 2)
        padded = sum(room[place[max(row)]] * max(map(len, row.values())) for row in split if row)
        aligned = padded <= LONGER * sum(2 + len(cell) for row in self.rows for cell in row.values())
        out = []
        for row in split:
            used = columns[:place[max(row)]] if aligned and row else sorted(row)
            for k in range(max([1, *map(len, row.values())])):
                cells = ((row[c][k] if c in row and k < len(row[c]) else "").ljust(width[c] if aligned else 0) for c in used)
                out.append("  ".join(cells).rstrip())
        return out


def render(root: Node) -> str:
    """All visible text of a tree, block by block."""
    out = _Lines()
    # Each entry: a node or text to enter, or a function to call when its children are done.
    indent, pre, lists = 0, 0, []
    outs, tables = [out], []
    todo: list = [root]
    while todo:
        item = todo.pop()
        out = outs[-1]
        if callable(item):
            item()
            continue
        if isinstance(item, str):
            value = unescape(item)
            if pre:
                first, *rest = value.split("\n")
                out.parts.append(first)
                for line in rest:
                    out.put(["".join(out.parts)])
                    out.parts = [line]
            else:
                out.text(value, indent)
            continue
        if hidden(item):
            continue
        name = item.name
        gap = 1 if name in SPACED else 0
        if name in ("thead", "tbody", "tfoot") and tables:
            tables[-1].covered.clear()  # no cell reaches into another group of rows
        if name == "br":
            if out.parts:
                out.end()
            else:
                out.gap += 1
            continue
        if name == "hr":
            out.end(1)
            continue
        if name == "table":
            out.end(1)
            tables.append(_Grid())

            def done(out=out, pad=indent, held=(pre,)):
                nonlocal pre
                out.put([(" " * pad + line).rstrip() for line in tables.pop().lines()])
                out.gap = 1
                pre = held[0]
            pre = 0
            todo.append(done)
        elif name == "tr" and tables:
            tables[-1].row()
        elif name in ("td", "th") and tables:
            grid = tables[-1]
            row = len(grid.rows) - 1 if grid.rows else grid.row()
            inner, held = _Lines(), indent
            across, down = (_number(item.attrs.get(a, "1"), 1) for a in ("colspan", "rowspan"))
            across, down = min(max(across, 1), 1000), min(down or 65534, 65534)  # 0 rows: to the end of the group
            indent = 0
            outs.append(inner)

            def done(inner=inner, held=held, grid=grid, row=row, across=across, down=down):
                nonlocal indent
                inner.end()
                outs.pop()
                grid.place(row, "\n".join(inner.lines), across, down)
                indent = held
            todo.append(done)
        elif name in ("ul", "ol", "menu", "dir"):
            start = item.attrs.get("start", "1")
            out.end(0 if lists else 1)
            lists.append([name == "ol", _number(start, 1)])

            def done(out=out):
                lists.pop()
                out.end(0 if lists else 1)
            todo.append(done)
        elif name == "li":
            out.end()
            ordered, number = lists[-1] if lists else (False, 0)
            mark = f"{number}. " if ordered else "- "
            if lists:
                lists[-1][1] += 1
            out.marker, indent = mark, indent + len(mark)

            def done(out=out, n=len(mark)):
                nonlocal indent
                out.end()
                out.marker, indent = "", indent - n
            todo.append(done)
        elif name in ("blockquote", "dd"):
            out.end(gap)
            indent += 2

            def done(out=out, gap=gap):
                nonlocal indent
                out.end(gap)
                indent -= 2
            todo.append(done)
        elif name == "pre":
            out.end(1)
            pre += 1

            def done(out=out):
                nonlocal pre
                out.end(1)
                pre -= 1
            todo.append(done)
        elif name in BLOCKS:
            out.end(gap)
            todo.append(lambda out=out, gap=gap: out.end(gap))
        todo.extend(reversed(item.children))
    outs[0].end()
    return "\n".join(outs[0].lines)


def visible_text(html: str | None) -> str:
    return render(build(html)) if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text, n_chars, n_lines of every page. Input: page_id, html."""
    schema = pa.schema([("page_id", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_lines", pa.int64())])

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [visible_text(h) for h in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([
            batch.column(0).cast(pa.int64()), pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())], schema=schema)

    return pages.select("page_id", "html").mapInArrow(per_batch(of_batch, 64), "page_id long, text string, n_chars long, n_lines long")
