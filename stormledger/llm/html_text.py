"""Visible text of HTML pages, laid out: a small tree builder and a renderer.

The builder implies missing tags: a block closes an open paragraph, list items, table
parts, options and headings close their like, a cell opens its row, content closes the
head, and an end tag closes what is open inside its element. Unknown end tags do
nothing; what is open at the end of the page is closed there.

Not visible: head, scripts, styles, templates and fallback content, comments, closed
details and dialogs, and elements hidden by attribute, by their own style or by a style
rule of the page with a selector of one tag, class or id.

The renderer collapses white space outside preformatted text, puts blocks on lines of
their own with a blank line around paragraphs, headings, lists, quotes and tables,
marks list items with bullets or numbers, indents what is nested, and aligns the cells
of a table in columns. Padding of a column ends at ``WIDEST_PADDING`` characters;
longer cells keep their whole text.

Null page: null text. Empty page, or one without visible text: empty text. Neither
builder nor renderer recurses, so depth and length are not limited. Repeated rows give
repeated results, an empty table an empty one; only the key column is carried along.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WIDEST_PADDING = 60
MOST_SPAN = 1000  # as browsers have it
MOST_ROWS = 65534  # as browsers have it
ROW_GROUPS = frozenset(("thead", "tbody", "tfoot"))

# FIXED VALUES: element names by their role in the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
HEAD = frozenset("head title base link meta style script noscript template".split())
UNSEEN = frozenset(
    "head title base link meta style script noscript template iframe noembed noframes video audio canvas object "
    "datalist rp area param source track col colgroup map".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl table blockquote pre figure hr xmp plaintext".split())
LINED = frozenset(
    "html body address article aside center details dialog dd dir div dt fieldset figcaption footer form header hgroup "
    "legend li main nav optgroup option search section summary caption tr thead tbody tfoot td th textarea".split()
)
CLOSES_P = SPACED | frozenset(
    "address article aside center details dialog dd dir div dt fieldset figcaption footer form header hgroup li main nav "
    "search section summary".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
# an element on the left ends the open elements in the middle, up to the nearest one on the right
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir", "table", "td", "th")),
    "dt": (("dt", "dd"), ("dl", "table", "td", "th")),
    "dd": (("dt", "dd"), ("dl", "table", "td", "th")),
    "option": (("option",), ("select", "datalist", "optgroup")),
    "optgroup": (("option", "optgroup"), ("select", "datalist")),
    "td": (("td", "th", "caption", "colgroup"), ("tr", "table")),
    "th": (("td", "th", "caption", "colgroup"), ("tr", "table")),
    "tr": (("tr", "caption", "colgroup"), ("table",)),
    "thead": (("thead", "tbody", "tfoot", "caption", "colgroup", "tr"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "caption", "colgroup", "tr"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption", "colgroup", "tr"), ("table",)),
    "a": (("a",), ("table", "td", "th", "caption")),
    "button": (("button",), ("table", "td", "th", "caption")),
}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_GAP = re.compile(r"[ \t\n\f\r]+")
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def attribute(self, name: str) -> str | None:
        if name not in self.attributes.lower():
            return None
        for found in _ATTRIBUTE.finditer(self.attributes):
            if found[1].lower() == name:
                return unescape(found[2] or found[3] or found[4] or "")
        return None


def build(page: str) -> tuple[Node, list[str]]:
    """The tree of a page and the bodies of its style elements."""
    root = Node("html")
    stack, styles = [root], []
    opened: Counter = Counter()  # tags on the stack
    at, end = 0, len(page)

    def cut(k: int) -> None:
        opened.subtract(n.tag for n in stack[k:])
        del stack[k:]

    def close_until(names: tuple[str, ...], stops: tuple[str, ...]) -> None:
        """Close up to and with the outermost element of ``names`` above the nearest stop."""
        last = None
        if not any(opened[n] for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in stops:
                break
            if stack[k].tag in names:
                last = k
        if last is not None:
            cut(last)

    def open_node(tag: str, attributes: str = "") -> Node:
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        stack.append(node)
        opened[tag] += 1
        return node

    def leave_head() -> None:
        close_until(("head",), ())

    def text(piece: str) -> None:
        if piece:
            if opened["head"] and piece.strip(" \t\n\f\r"):
                leave_head()
            stack[-1].children.append(unescape(piece) if "&" in piece else piece)

    while at < end:
        found = _TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        if found[1]:
            tag = found[1].lower()
            if tag == "br":
                stack[-1].children.append(Node("br"))
                continue
            stops = ("table",) if tag != "table" and tag not in ("html", "body") else ()
            cell = ("td", "th", "caption") if tag not in ("td", "th", "caption", "tr", "table", "body", "html") and tag not in SECTIONS else ()
            for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[k].tag == tag:
                    cut(k)
                    break
                if stack[k].tag in stops or stack[k].tag in cell:
                    break
            continue
        if not found[2]:
            continue
        tag, attributes = found[2].lower(), found[3] or ""
        if tag in ("html", "body"):
            leave_head()
            if tag == "body" and attributes:
                root.attributes += " " + attributes
            continue
        if tag not in HEAD and opened["head"]:
            leave_head()
        if tag in CLOSES_P:
            close_until(("p",), ("table", "td", "th", "caption", "button"))
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            cut(len(stack) - 1)
        if tag in CLOSES:
            close_until(*CLOSES[tag])
        if tag in ("td", "th") and stack[-1].tag != "tr" and opened["table"]:
            open_node("tr")
        if tag in VOID:
            stack[-1].children.append(Node(tag, attributes))
            continue
        node = open_node(tag, attributes)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at) if tag != "plaintext" else None
            body = page[at : close.start() if close else end]
            at = close.end() if close else end
            if tag == "style":
                styles.append(body)
            if tag in ("textarea", "title"):
                body = unescape(body)
            node.children.append(body)
            cut(len(stack) - 1)
    return root, styles


def hidden_selectors(styles: list[str]) -> frozenset[str]:
    """Selectors of one tag, class or id whose rules hide their elements."""
    found = set()
    for sheet in styles:
        if "none" in sheet or "hidden" in sheet or "collapse" in sheet:
            for names, body in _RULE.findall(re.sub(r"/\*.*?\*/", "", sheet, flags=re.S)):
                if _HIDING.search(body):
                    found.update(n.strip() for n in names.split(",") if re.fullmatch(r"\s*[.#]?[\w-]+\s*", n))
    return frozenset(found)


def visible(node: Node, hidden: frozenset[str]) -> bool:
    if node.tag in UNSEEN or node.tag == "dialog" and node.attribute("open") is None:
        return False
    if node.tag in hidden:
        return False
    if not node.attributes:
        return True
    if node.attribute("hidden") is not None or (node.attribute("aria-hidden") or "").strip().lower() == "true":
        return False
    if hidden and (set(f".{c}" for c in (node.attribute("class") or "").split()) & hidden or f"#{node.attribute('id')}" in hidden):
        return False
    return not _HIDING.search(node.attribute("style") or "")


class Flow:
    """Lines of text under construction. Blank lines are due until text follows them."""

    __slots__ = ("lines", "line", "gap", "due")

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False  # white space waits for text on this line
        self.due = 0  # blank lines that the next text needs above it

    def text(self, piece: str) -> None:
        words = _GAP.split(piece)
        body = " ".join(w for w in words if w)
        if not body:
            self.gap = self.gap or len(words) > 1
            return
        if (self.gap or not words[0]) and self.line:
            self.line.append(" ")
        self.line.append(body)
        self.gap = not words[-1]

    def newline(self) -> None:
        if self.line:
            self._blank()
            self.lines.append("".join(self.line))
            self.line = []
        self.gap = False

    def _blank(self) -> None:
        if self.lines:
            self.lines.extend([""] * self.due)
        self.due = 0

    def space(self, blank: int) -> None:
        self.newline()
        self.due = max(self.due, blank)

    def add(self, lines: list[str], first: str = "", rest: str = "") -> None:
        """Lines of a finished flow, the first one behind a mark."""
        self.newline()
        if lines:
            self._blank()
            self.lines.append(first + lines[0])
            self.lines.extend(rest + line if line else "" for line in lines[1:])

    def finish(self) -> list[str]:
        self.newline()
        return self.lines


def _number(text: str | None, default: int) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return int(found[1]) if found else default


def _placed(rows: list[list[tuple[int, int, list[str]]] | None]) -> list[list[tuple[int, int, list[str]]]]:
    """Rows of (column, columns spanned, lines); columns that a cell of a row above takes are passed over."""
    out, taken = [], []  # (first column, column past the last, row past the last), in order
    for at, row in enumerate(rows):
        if row is None:  # no cell reaches beyond its row group
            taken = []
            continue
        taken = [t for t in taken if t[2] > at]
        cells, more, column, k = [], [], 0, 0
        for span, down, lines in row:
            while k < len(taken) and taken[k][0] <= column:
                column = max(column, taken[k][1])
                k += 1
            cells.append((column, span, lines))
            if down != 1:
                first, until = column, at + down if down else len(rows)
                if more and more[-1][1:] == (column, until):
                    first = more.pop()[0]
                more.append((first, column + span, until))
            column += span
        taken = sorted(taken + more) if more else taken
        out.append(cells)
    return out


def _table_lines(rows: list[list[tuple[int, int, list[str]]] | None]) -> list[str]:
    """Rows of (columns spanned, rows spanned or 0 for all of the group, lines) with the cells of a column one
    below the other; None parts row groups."""
    widths: list[int] = []
    placed = _placed(rows)
    for row in placed:
        for column, span, lines in row:
            while len(widths) < column + span:
                widths.append(0)
            if span == 1:
                widths[column] = max(widths[column], min(WIDEST_PADDING, max(map(len, lines), default=0)))
    out = []
    for row in placed:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            parts, reached = [], 0
            for column, span, lines in row:
                parts.append(" " * (sum(widths[reached:column]) + 2 * (column - reached)) if column > reached else "")
                piece = lines[k] if k < len(lines) else ""
                room = sum(widths[column : column + span]) + 2 * (span - 1)
                parts.append(piece.ljust(room) + "  ")
                reached = column + span
            out.append("".join(parts).rstrip())
    return [line for line in out if line]


def render(page: str) -> str:
    """The visible text of one page."""
    root, styles = build(page)
    hidden = hidden_selectors(styles)
    top = Flow()
    if not visible(root, hidden):
        return ""
    # a step is (node, flow, list depth, preformatted) to walk, or a function to call when its children are done
    steps: list = [(root, top, 0, False)]
    rows_of: list[list] = []  # open tables, innermost last
    while steps:
        step = steps.pop()
        if callable(step):
            step()
            continue
        node, flow, depth, keep = step
        if isinstance(node, str):
            if keep:
                lines = node.replace("\r\n", "\n").replace("\r", "\n").split("\n")
                for k, line in enumerate(lines):
                    if k:
                        flow._blank() if flow.lines and flow.due else None
                        flow.lines.append("".join(flow.line))
                        flow.line = []
                    if line:
                        flow.line.append(line)
            else:
                flow.text(node)
            continue
        tag = node.tag
        if not visible(node, hidden):
            continue
        if tag == "br":
            if flow.line:
                flow.newline()
            elif flow.lines:
                flow.due = max(flow.due, 1)
            continue
        if tag == "hr":
            flow.space(1)
            continue
        if tag == "input":
            if (node.attribute("type") or "text").lower() not in ("hidden", "password", "checkbox", "radio", "image", "file", "color", "range"):
                flow.text(" " + (node.attribute("value") or "") + " ")
            continue
        children = node.children
        inner = flow
        if tag == "details" and node.attribute("open") is None:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        if tag == "q":
            children = ["“", *children, "”"]
        if tag in SPACED or tag in LINED:
            blank = int(tag in SPACED and not (tag in ("ul", "ol", "menu", "dl") and depth))
            flow.space(blank)
            own = Flow() if tag in ("blockquote", "pre", "xmp", "plaintext", "li", "dd", "td", "th", "textarea", "table") else flow
            inner = own
            if tag == "table":
                rows_of.append([])

                def done(flow=flow, own=own):
                    rows = rows_of.pop()
                    flow.add(own.finish())
                    flow.add(_table_lines(rows))
                    flow.space(1)

            elif tag == "tr" and rows_of:
                rows_of[-1].append([])

                def done():
                    pass

            elif tag in ("td", "th") and rows_of:
                if not rows_of[-1] or rows_of[-1][-1] is None:
                    rows_of[-1].append([])
                down = _number(node.attribute("rowspan"), 1)
                down = 1 if down < 0 else min(MOST_ROWS, down)

                def done(own=own, row=rows_of[-1][-1], span=min(MOST_SPAN, max(1, _number(node.attribute("colspan"), 1))), down=down):
                    row.append((span, down, own.finish()))

            elif tag == "li":
                mark = node.attributes[1:] if node.attributes.startswith("\0") else "* "

                def done(flow=flow, own=own, mark=mark):
                    flow.add(own.finish(), mark, " " * len(mark))

            elif own is not flow:
                indent = "" if tag in ("td", "th", "textarea", "pre", "xmp", "plaintext") else "  "

                def done(flow=flow, own=own, indent=indent, blank=blank):
                    flow.add(own.finish(), indent, indent)
                    flow.space(blank)

            else:

                def done(flow=flow, blank=blank):
                    flow.space(blank)

            steps.append(done)
        if tag in ROW_GROUPS and rows_of:
            rows_of[-1].append(None)
            steps.append(lambda rows=rows_of[-1]: rows.append(None))
        if tag in ("ul", "menu", "dir", "ol"):
            depth += 1
            if tag == "ol":
                count = _number(node.attribute("start"), 1)
                for child in children:
                    if isinstance(child, Node) and child.tag == "li" and visible(child, hidden):
                        count = _number(child.attribute("value"), count)
                        child.attributes = f"\0{count}. "
                        count += 1
        keep = keep or tag in ("pre", "xmp", "plaintext", "textarea")
        steps.extend((child, inner, depth, keep) for child in reversed(children))
    return "\n".join(line.replace("\xa0", " ").rstrip() for line in top.finish())


def visible_text(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``key`` and ``text``, the laid-out visible text of each whole page."""
    slim = pages.select(F.col(key).alias("key"), F.col(html).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [None if page is None else render(page) for page in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["key", "text"])

    return slim.mapInArrow(run, f"key {slim.schema['key'].dataType.simpleString()}, text string").select(F.col("key").alias(key), "text")
