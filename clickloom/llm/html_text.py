"""Visible text of web pages, laid out: a tree builder with implied tags, then block rendering.

Tags open and close elements on a stack. End tags that HTML lets authors leave out are supplied
(a paragraph ends where a block begins, a list item where the next begins, and so on), an end
tag without its element is ignored, and one that skips open elements closes them. An element
lays its text into its block when it closes, so the work is linear and nothing recurses.

Hidden: the head, scripts, styles, templates, embedded media, ``hidden`` elements, and inline
styles with ``display:none`` or ``visibility:hidden``. Rules of style sheets are not applied. Of
drawings (svg) the text elements are shown, of formulas (math) all but annotations. Rows without a
table are laid out where they stand.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset(
    "head script style template noscript iframe object audio video canvas noembed noframes "
    "title meta link datalist".split()
)
BLOCKS = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p "
    "pre search section summary ul table caption thead tbody tfoot tr td th option select".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr".split())
# What a start tag closes if it is open, and what keeps it from looking further.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "tr": ({"tr", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    **{k: ({"thead", "tbody", "tfoot", "caption"}, {"table"}) for k in ("thead", "tbody", "tfoot")},
    "body": ({"head"}, {"body"}),
}
_CLOSES_P = BLOCKS - {"html", "body", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "option", "select", "legend"}
FOREIGN = frozenset(("svg", "math"))
# Not drawn where they stand.
_NOT_DRAWN = {
    "svg": frozenset("defs desc metadata symbol clippath mask pattern marker".split()),
    "math": frozenset(("annotation", "annotation-xml")),
}
_LABELS = frozenset(("text", "foreignobject"))
# HTML elements that end a drawing they turn up in.
_BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li menu meta nobr "
    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
_SCOPE = frozenset("td th table caption html button".split())
_IN_HEAD = HIDDEN | {"base", "html"}
_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)", re.S
)
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_SPACES = re.compile(r"[ \t\n\r\f]+")
_NO_SHOW = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)
_WHOLE_NUMBER = re.compile(r"\s*[+-]?\d{1,9}")
# Columns are padded to this width at most, and lists and quotes are indented to this depth: beyond
# it text follows on without more spaces, so what is written stays in proportion to the page.
WIDEST, DEEPEST = 100, 30
_COLUMNS = 10_000
_BREAK, _KEEP = "\x00", "\x01"


class _Element:
    __slots__ = (
        "tag", "shown", "visible", "keep", "lines", "inline", "gap", "count", "value", "rows", "span", "down", "block", "mute"
    )

    def __init__(self, tag: str, shown: bool, keep: bool) -> None:
        self.tag, self.shown, self.keep = tag, shown, keep
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = False
        self.visible, self.value = True, None
        self.count, self.span, self.down = 0, 1, 1
        self.rows: list[list[_Cell]] | list[_Cell] | None = [] if tag == "table" else None
        self.block = tag in BLOCKS
        self.mute = False

    def flush(self) -> None:
        """End the line of loose text."""
        if not self.inline:
            return
        text = "".join(self.inline)
        self.inline = []
        for line in text.split(_BREAK):
            if _KEEP in line:
                self.put([x.rstrip() for x in line.replace(_KEEP, "").expandtabs(8).split("\n")], False)
            else:
                line = _SPACES.sub(" ", line).strip(" ")
                if line:
                    self.put([line], False)

    def put(self, lines: list[str], spaced: bool) -> None:
        if not any(lines):
            return
        if (spaced or self.gap) and self.lines:
            self.lines.append("")
        self.lines += lines
        self.gap = spaced


# Lines of a cell, and the columns and rows it takes.
_Cell = tuple[list[str], int, int]


def _placed(rows: list[list[_Cell]]) -> list[list[tuple[int, list[str], int]]]:
    """Rows of (column, lines, columns taken); columns that a cell above reaches down to are passed over."""
    taken: dict[int, int] = {}
    out = []
    for row in rows:
        at, cells, reach = 0, [], {}
        for lines, span, down in row:
            while taken.get(at):
                at += 1
            # A page could ask for a thousand columns in every cell.
            span = min(span, max(1, _COLUMNS - at))
            cells.append((at, lines, span))
            if down > 1:
                reach.update(dict.fromkeys(range(at, at + span), down - 1))
            at += span
        taken = {k: n - 1 for k, n in taken.items() if n > 1} | reach
        out.append(cells)
    return out


def _table(rows: list[list[_Cell]]) -> list[str]:
    """Rows of cells as lines, columns padded to one width, :data:`WIDEST` at most."""
    placed = _placed(rows)
    if all(len(row) < 2 and not any(at for at, *_ in row) for row in placed):
        return [line.rstrip() for row in placed for _, lines, _ in row for line in lines]
    width: dict[int, int] = {}
    for row in placed:
        for at, lines, span in row:
            if span == 1:
                width[at] = max(width.get(at, 0), min(max(map(len, lines), default=0), WIDEST))
    # Where each column begins; those that no cell has for itself take no room.
    begin, total = {}, 0
    for k in sorted(width):
        begin[k], total = total, total + width[k] + 2
    columns = sorted(begin)
    out = []
    for row in placed:
        starts = [begin[columns[i]] if (i := bisect_left(columns, at)) < len(columns) else total for at, *_ in row]
        for n in range(max((len(lines) for _, lines, _ in row), default=0)):
            line = ""
            for start, (_, lines, _) in zip(starts, row):
                if n < len(lines) and lines[n]:
                    # Text that ran over its column moves what follows along.
                    line += " " * max(start - len(line), 2 if line else 0) + lines[n]
            out.append(line.rstrip())
    return out


class _Page:
    def __init__(self) -> None:
        self.root = _Element("", True, False)
        self.stack = [self.root]
        self.blocks = [self.root]
        self.open: dict[str, int] = {}

    def text(self, raw: str) -> None:
        top = self.stack[-1]
        if not top.shown or not top.visible or top.mute or not raw:
            return
        value = html.unescape(raw) if "&" in raw else raw
        value = value.replace(_BREAK, "").replace(_KEEP, "")
        self.blocks[-1].inline.append(_KEEP + value if top.keep else value)

    def has(self, tags: set[str] | frozenset[str], stop: set[str] | frozenset[str]) -> bool:
        """Whether one of the tags is open inside the nearest stopping element."""
        if not any(self.open.get(t) for t in tags):
            return False
        for element in reversed(self.stack):
            if element.tag in tags:
                return True
            if element.tag in stop:
                return False
        return False

    def start(self, tag: str, rest: str) -> None:
        top = self.stack[-1]
        if self.open.get("head") and tag not in _IN_HEAD and tag != "head":
            self.close_to({"head"})
        if top.mute and tag in _BREAKS_OUT:
            self.close_to({"svg"})
        if tag in _CLOSES_P and self.has({"p"}, _SCOPE):
            self.close_to({"p"})
        if tag in _ENDS:
            close, stop = _ENDS[tag]
            while self.has(close, stop):
                self.close_to(close)
        if tag in ("td", "th") and self.open.get("table") and not self.has({"tr"}, {"table"}):
            self.push("tr", "")
        top = self.stack[-1]
        if tag == "br":
            if top.shown:
                self.blocks[-1].inline.append(_BREAK)
        elif tag == "hr":
            self.blocks[-1].flush()
            self.blocks[-1].gap = bool(self.blocks[-1].lines)
        elif tag not in VOID and not (rest.endswith("/") and self.foreign(tag)):
            self.push(tag, rest)

    def foreign(self, tag: str) -> bool:
        """Whether an element of this tag is part of a drawing or a formula, where ``/>`` closes it."""
        return tag in FOREIGN or bool(self.open.get("svg") or self.open.get("math")) and not self.open.get("foreignobject")

    def push(self, tag: str, rest: str) -> None:
        top = self.stack[-1]
        shown = top.shown and tag not in HIDDEN
        visible, span, down, value_of = top.visible, 1, 1, None
        if rest and rest.strip("/ "):
            for name, value in _ATTRIBUTE.findall(rest):
                name = name.lower()
                value = value.strip("\"'")
                if name == "hidden":
                    shown = False
                elif name == "style":
                    style = html.unescape(value)
                    shown = shown and not _NO_SHOW.search(style)
                    if m := _VISIBILITY.search(style):
                        visible = m[1].lower() == "visible"
                elif name in ("colspan", "rowspan", "start", "value") and (m := _WHOLE_NUMBER.match(value)):
                    number = int(m[0])
                    if name == "colspan":
                        span = min(max(number, 1), 1000)
                    elif name == "rowspan":
                        # None taken means all rows to the end.
                        down = min(number, 65534) if number > 0 else 65534 if number == 0 else 1
                    elif (name, tag) in (("start", "ol"), ("value", "li")):
                        value_of = number
        element = _Element(tag, shown, top.keep or tag in ("pre", "textarea", "xmp"))
        element.span, element.down, element.visible = span, down, visible
        element.value = value_of
        if tag == "ol" and value_of is not None:
            element.count = value_of - 1
        element.mute = tag == "svg" or top.mute and tag not in _LABELS
        for kind, tags in _NOT_DRAWN.items():
            if tag in tags and self.open.get(kind):
                element.shown = False
        self.part(tag)
        self.stack.append(element)
        self.open[tag] = self.open.get(tag, 0) + 1
        if element.block:
            self.blocks[-1].flush()
            self.blocks.append(element)

    def part(self, tag: str) -> None:
        """Keep labels of a drawing and cells of a formula apart."""
        if tag == "text" and self.open.get("svg") or tag == "mtd" and self.open.get("math"):
            self.blocks[-1].inline.append(" ")

    def close_to(self, tags: set[str]) -> None:
        """Close elements up to and with the nearest of the given ones."""
        while len(self.stack) > 1:
            element = self.stack.pop()
            self.open[element.tag] -= 1
            if element.block:
                self.blocks.pop()
                self.lay(element)
            else:
                self.part(element.tag)
            if element.tag in tags:
                return

    def depth(self) -> int:
        """Elements around that indent."""
        return sum(self.open.get(t, 0) for t in ("li", "dd", "blockquote"))

    def lay(self, element: _Element) -> None:
        """Give the lines of a closed block to the block around it."""
        element.flush()
        into, tag = self.blocks[-1], element.tag
        if not element.shown:
            return
        lines = element.lines
        if tag in ("td", "th"):
            if into.tag == "tr":
                into.rows = into.rows or []
                into.rows.append((lines, element.span, element.down))
                return
        elif tag == "tr":
            around = next((b for b in reversed(self.blocks) if b.tag == "table"), None)
            if around is not None:
                if lines:
                    around.put(lines, False)
                around.rows.append(element.rows or [])
                return
            lines = lines + _table([element.rows or []])
        elif tag == "table":
            lines = lines + _table(element.rows)
        elif tag == "li":
            near = next((b for b in reversed(self.blocks) if b.tag in ("ul", "ol", "menu", "dir")), None)
            mark = "- "
            if near is not None and near.tag == "ol":
                near.count = near.count + 1 if element.value is None else element.value
                mark = f"{near.count}. "
            room = " " * len(mark) if self.depth() < DEEPEST else ""
            if room:
                lines = [(mark if i == 0 else room) + x if x else x for i, x in enumerate(lines)]
            elif lines:
                lines[0] = mark + lines[0]
        elif tag in ("dd", "blockquote"):
            if self.depth() < DEEPEST:
                lines = ["  " + x if x else x for x in lines]
        elif tag == "tbody" or tag == "thead" or tag == "tfoot":
            into.put(lines, False)
            return
        nested = tag in ("ul", "ol") and self.open.get("li", 0) > 0
        into.put(lines, tag in SPACED and not nested)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
            return
        if tag == "p" and not self.has({"p"}, _SCOPE):
            self.blocks[-1].flush()
            return
        if tag in ("body", "html") or not self.open.get(tag):
            return
        stop = {"table"} if tag in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else set()
        if tag not in ("table", "td", "th", "tr", "tbody", "thead", "tfoot"):
            stop = {"td", "th", "table"} - {tag}
        if self.has({tag}, stop):
            # An inline end tag does not close the blocks opened inside it.
            if tag not in BLOCKS and tag not in HIDDEN and tag not in FOREIGN:
                for i in range(len(self.stack) - 1, 0, -1):
                    if self.stack[i].tag == tag:
                        if any(e.block for e in self.stack[i + 1 :]):
                            return
                        break
            self.close_to({tag})


def visible_text(page: str) -> str:
    """The text a reader sees, in lines."""
    out = _Page()
    at, n = 0, len(page)
    while at < n:
        cut = page.find("<", at)
        if cut < 0:
            out.text(page[at:])
            break
        if cut > at:
            out.text(page[at:cut])
        found = _TAG.match(page, cut) or _LOOSE.match(page, cut)
        if not found:
            out.text("<")
            at = cut + 1
            continue
        at = found.end()
        if not found.lastindex:
            continue
        closing, name, rest = found[1], found[2].lower(), found[3]
        if closing:
            out.end(name)
            continue
        out.start(name, rest)
        if name in ("pre", "textarea", "listing"):
            at += 2 if page.startswith("\r\n", at) else page.startswith("\n", at)
        if name in RAW and out.stack[-1].tag == name:
            last = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            stop = last.start() if last else n
            if name in ("textarea", "xmp"):
                out.text(page[at:stop])
            out.close_to({name})
            at = last.end() if last else n
    while len(out.stack) > 1:
        out.close_to({out.stack[-1].tag})
    out.root.flush()
    return "\n".join(out.root.lines)


def extract(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """``page_id`` and ``text`` of every page; NULL and empty pages have the empty text."""
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    schema = rows.select("page_id").schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                made = pa.array([visible_text(x) for x in part.column(1).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), made], ["page_id", "text"])

    return rows.mapInArrow(run, schema)
