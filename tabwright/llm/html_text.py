"""Layout-aware rendering of HTML pages as text.

A builder turns the tags of a page into balanced open and close events: it adds the end tags that
HTML leaves out, ignores stray ones and closes what is open at the end. A renderer keeps a stack
of the open elements. It skips what a browser does not show, collapses white space, sets blocks
apart, marks list items, keeps preformatted text and aligns the cells of tables by column; a cell keeps its own lines, lists
and tables, and row and column spans keep their places.
Labels of SVG, the tokens of MathML, the content of text areas and the chosen option of a
drop-down list (all options of a list box) are visible text. SVG text that is only drawn by
reference (<use>) is not.

Both work through the page once and without recursion; Spark deals out the pages.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from tabwright.llm.words import fresh

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_BLANK = re.compile(r"[ \t\n\r\f]+")
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.IGNORECASE)

# Element classes of HTML, fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noframes iframe noembed xmp".split())
UNSEEN = frozenset(
    "head script style title template noscript noframes iframe noembed object audio video canvas datalist "
    "dialog param source track area base link meta rp progress meter".split())
#: Within SVG and within MathML: elements that are not drawn.
SVG_UNSEEN = frozenset("defs symbol clippath mask marker pattern lineargradient radialgradient filter desc title metadata".split())
MATH_UNSEEN = frozenset("annotation annotation-xml mphantom".split())
#: MathML elements whose parts stand apart.
APART = frozenset("mfrac msup msub msubsup munder mover munderover mroot mmultiscripts mtr mlabeledtr mtable".split())
#: HTML tags that end SVG and MathML, except within elements that hold HTML.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split())
HOLDS_HTML = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
ENDS_SELECT = frozenset("input textarea select caption table tbody tfoot thead tr td th".split())
#: Blocks with an empty line around them, and blocks on lines of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu pre blockquote figure table fieldset hr".split())
LINED = frozenset(
    "html body div section article aside header footer nav main address form li dt dd details summary figcaption center "
    "legend tr thead tbody tfoot caption td th optgroup option hgroup search".split())
BLOCKS = SPACED | LINED
#: An opening tag that ends an open paragraph.
ENDS_P = (SPACED | frozenset(
    "div section article aside header footer nav main address form details center figcaption dt dd li hgroup search".split()))
#: Opening tag -> open elements that it ends, up to the nearest of the third set.
IMPLIED = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th", "caption", "colgroup"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})), "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "thead": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}), frozenset({"table"})),
    "tbody": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}), frozenset({"table"})),
    "tfoot": (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}), frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "body": (frozenset({"head"}), frozenset()), "frameset": (frozenset({"head"}), frozenset()),
}
#: What a stray end tag does not reach beyond.
SCOPE = frozenset({"table", "td", "th", "caption", "template", "object", "button", "foreignobject"})
IN_HEAD = frozenset("title meta link base style script noscript template".split())


#: End tags that reach beyond SCOPE.
REACHING = frozenset("table tr tbody thead tfoot html body".split())


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """Balanced ("open", name, attributes), ("close", name, "") and ("text", text, "")."""
    stack: list[str] = []
    places: defaultdict[str, list[int]] = defaultdict(list)  # of each open name, so that no tag walks the stack

    def close(to: int) -> Iterator[tuple[str, str, str]]:
        while len(stack) > to:
            name = stack.pop()
            places[name].pop()
            yield "close", name, ""

    def nearest(names: Iterable[str], stop: Iterable[str]) -> int:
        """The outermost open element of ``names`` inside the nearest of ``stop``, or -1."""
        within = max((places[s][-1] for s in stop if places[s]), default=-1)
        found = [places[n][i] for n in names if places[n] for i in [bisect_right(places[n], within)] if i < len(places[n])]
        return min(found, default=-1)

    def foreign() -> int:
        """The outermost SVG or MathML element that is open and holds no HTML here, or -1."""
        return nearest(("svg", "math"), HOLDS_HTML)

    at, size, plain = 0, len(page), 0
    while at < size:
        m = _TAG.search(page, at)
        if not m:
            break
        if m.start() > plain:
            text = page[plain: m.start()]
            if stack and stack[-1] == "head" and text.strip():
                yield from close(places["head"][0])
            yield "text", unescape(text), ""
        at = plain = m.end()
        name = (m[2] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA[") and foreign() >= 0:
                stop = page.find("]]>", m.start())
                stop = size if stop < 0 else stop
                yield "text", page[m.start() + 9: stop], ""
                at = plain = min(size, stop + 3)
            continue
        if m[1]:
            if name == "br":
                yield "open", "br", ""
                yield "close", "br", ""
            else:
                i = places[name][-1] if name in places and places[name] else -1
                if i >= 0 and (name in REACHING or all(not places[s] or places[s][-1] <= i for s in SCOPE)):
                    yield from close(i)
            continue
        if places["head"] and name not in IN_HEAD:
            yield from close(places["head"][0])
        if name in BREAKOUT:
            i = foreign()
            if i >= 0:
                yield from close(i)
        if name in ENDS_SELECT and places["select"]:
            yield from close(places["select"][-1])
        if name in ENDS_P:
            i = nearest(("p",), SCOPE)
            if i >= 0:
                yield from close(i)
        if name in IMPLIED:
            i = nearest(*IMPLIED[name])
            if i >= 0:
                yield from close(i)
        yield "open", name, m[3]
        if name in VOID or m[3].endswith("/") and (
                name not in BLOCKS and name not in RAW and name not in ("a", "b", "i", "span", "select") or foreign() >= 0):
            yield "close", name, ""
            continue
        places[name].append(len(stack))
        stack.append(name)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            stop = end.start() if end else size
            if stop > at:
                text = page[at:stop]
                yield "text", unescape(re.sub(r"\A\r?\n", "", text)) if name == "textarea" else text, ""
            at = plain = stop
    if plain < size:
        yield "text", unescape(page[plain:]), ""
    yield from close(0)


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), unescape((m[2] or "").strip("\"'")))
    return out


def _number(text: str | None, default: int, most: int) -> int:
    return min(max(1, int(text)), most) if text and text.strip().isascii() and text.strip().isdigit() else default


@dataclass
class _Flow:
    """Lines of one flow of text: the page, or a table cell."""

    lines: list[str] = field(default_factory=list)
    line: list[str] = field(default_factory=list)
    blank: bool = False  # a blank is due before the next text
    gap: bool = False  # an empty line is due before the next line
    marker: str = ""

    def text(self, text: str, indent: str) -> None:
        words = _BLANK.sub(" ", text)
        if words.startswith(" "):
            self.blank, words = True, words[1:]
        if words:
            tail = words.endswith(" ")
            self._put(words.rstrip(" "), indent)
            self.blank = tail

    def _put(self, text: str, indent: str) -> None:
        if not self.line:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.line = [indent[: len(indent) - len(self.marker)] + self.marker if self.marker else indent]
            self.marker = ""
        elif self.blank:
            self.line.append(" ")
        self.line.append(text)
        self.blank = False

    def end_line(self, spaced: bool = False) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        self.blank = False
        self.gap = self.gap or spaced

    def kept(self, text: str, indent: str) -> None:
        """Preformatted text: blanks and line breaks stay."""
        for i, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if i:
                if self.line:
                    self.end_line()
                else:
                    self.lines.append("")
            if part:
                self._put(part.replace("\t", "    "), indent)

    def block(self, lines: list[str], indent: str) -> None:
        """Ready lines, as they are."""
        self.end_line()
        if lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines += [(indent + x).rstrip(" ") for x in lines]

    def result(self) -> list[str]:
        self.end_line()
        return self.lines


@dataclass
class _Select:
    boxed: bool  # a list box shows all options
    shown: str = ""
    rank: int = 0  # of the shown option: 1 disabled, 2 first, 3 selected


@dataclass
class _Table:
    rows: list[list[tuple[list[str], int, int]]] = field(default_factory=list)  # lines, columns and rows of each cell
    caption: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Layout:
    """``widest``: a cell's text beyond so many characters does not widen its column; None: all of it does. ``padding``: most blanks
    that a table is padded with; one that would need more is set with columns of at most 60; None: any number."""

    widest: int | None = 120
    padding: int | None = None


def aligned(rows: list[list[tuple[list[str], int, int]]], layout: Layout = Layout()) -> list[str]:
    """Cells (lines, columns, rows) in a grid, lines padded to the width of their column, two blanks apart, however many rows follow. A cell's lines stand
    below each other from the top of its first row; its width counts for its first column; the places that it
    covers besides are empty. Rows without text give no line."""
    grid: list[dict[int, list[str]]] = []
    covered: dict[int, int] = {}  # column -> rows still covered from above
    for row in rows:
        line: dict[int, list[str]] = {}
        taken = {c for c, n in covered.items() if n}
        covered = {c: n - 1 for c, n in covered.items() if n > 1}
        at = 0
        for lines, columns, down in row:
            while at in taken:
                at += 1
            line[at] = lines
            for c in range(at, at + columns):
                taken.add(c)
                if down > 1:
                    covered[c] = max(covered.get(c, 0), down - 1)
            at += columns
        grid.append(line)
    widths: dict[int, int] = {}
    for line in grid:
        for c, lines in line.items():
            widths[c] = max(widths.get(c, 0), *(min(len(x), layout.widest or len(x)) for x in lines), 0)
    columns = range(max(widths, default=-1) + 1)
    heights = [max((len(lines) for lines in line.values()), default=0) for line in grid]
    if layout.padding is not None and sum(widths.values()) * sum(heights) > layout.padding:
        widths = {c: min(w, 60) for c, w in widths.items()}
    out = []
    for line, height in zip(grid, heights):
        last = max((c for c, lines in line.items() if lines), default=-1)
        for i in range(height):
            parts = (line.get(c, ()) for c in columns[: last + 1])
            out.append("  ".join((lines[i] if i < len(lines) else "").ljust(widths.get(c, 0)) for c, lines in enumerate(parts)).rstrip(" "))
    return out


def render(page: str | None, layout: Layout = Layout()) -> str:
    """The visible text of a page; lines are separated by line breaks."""
    flows = [_Flow()]
    tables: list[_Table] = []
    lists: list[list] = []  # [kind, next number]
    hidden = 0  # depth inside what is not shown
    kept = 0
    selects: list[_Select] = []
    drawn = ""  # "silent": text here is not shown; "text" of SVG; "math"
    opened: list[tuple[bool, str, str, str, bool]] = []  # (hides, indent before, drawn before, role, has parts set apart)
    indent = ""
    for kind, name, attributes in events(page or ""):
        flow = flows[-1]
        folded = bool(opened) and opened[-1][3] == "folded"  # in a closed <details>: only its summary is shown
        if kind == "text":
            if not hidden and drawn != "silent" and not folded:
                flow.kept(name, indent) if kept else flow.text(name, indent)
            continue
        if kind == "open":
            attrs = _attributes(attributes) if attributes and attributes.strip() else {}
            hides = name in UNSEEN and not (name == "dialog" and "open" in attrs) or "hidden" in attrs \
                or bool(_HIDING.search(attrs.get("style", ""))) or name == "input" and attrs.get("type", "").lower() == "hidden" \
                or folded and name != "summary"
            if drawn == "math":
                hides = hides or name in MATH_UNSEEN
            elif drawn and not selects:
                hides = hides or name in SVG_UNSEEN or attrs.get("display") == "none" or attrs.get("visibility") in ("hidden", "collapse")
            if name in VOID:
                opened.append((False, indent, drawn, "", False))
                if not hidden and not hides and drawn != "silent":
                    if name == "br":
                        if flow.line:
                            flow.end_line()
                        elif flow.lines and not flow.gap:
                            flow.gap = True
                    elif name == "hr":
                        flow.end_line(True)
                    elif name == "img" and attrs.get("alt"):
                        flow.text(attrs["alt"], indent)
                    elif name == "wbr":
                        pass
                    elif name == "input" and attrs.get("type", "text").lower() in ("submit", "button", "reset"):
                        flow.text(attrs.get("value", ""), indent)
                continue
            apart = bool(opened) and opened[-1][4]
            opened.append((hides, indent, drawn, "", drawn == "math" and name in APART))
            if hides or hidden:
                hidden += 1
                continue
            if apart:
                flow.text(" ", indent)
            if name == "svg":
                drawn = "silent"
            elif name == "math":
                drawn = "math"
            elif name == "text" and drawn == "silent" and not selects:
                drawn = "text"
                flow.text(" ", indent)
            elif name == "tspan" and drawn == "text" and ("x" in attrs or "y" in attrs):
                flow.text(" ", indent)
            elif name == "foreignobject" and drawn:
                drawn = ""
                flow.text(" ", indent)
            elif name == "textarea":
                flow.end_line()
                kept += 1
            elif name == "select":
                size = attrs.get("size", "").strip()
                selects.append(_Select("multiple" in attrs or size.isascii() and size.isdigit() and int(size[:9]) > 1))
                opened[-1] = (*opened[-1][:3], "select", False)
                drawn = "silent"
                if selects[-1].boxed:
                    flow.end_line()
            elif name == "option" and selects and drawn == "silent":
                label = attrs.get("label", "")
                rank = 3 if "selected" in attrs else 1 if "disabled" in attrs else 2
                flows.append(_Flow())
                flows[-1].text(label, "")
                opened[-1] = (*opened[-1][:3], f"option{rank}", False)
                drawn, indent = "silent" if label else "", ""
            elif drawn == "silent":
                if name == "optgroup" and selects and selects[-1].boxed:
                    flow.text(attrs.get("label", ""), indent)
                    flow.end_line()
            elif name in ("td", "th"):
                if tables:
                    if not tables[-1].rows:
                        tables[-1].rows.append([])
                    flows.append(_Flow())
                    down = attrs.get("rowspan", "").strip()
                    spans = f"{_number(attrs.get('colspan'), 1, 1_000)}|{65_534 if down == '0' else _number(down, 1, 65_534)}"
                    opened[-1] = (False, f"{indent}|{spans}", drawn, "", False)
                    indent = ""
                else:
                    flow.end_line()
            elif name == "tr":
                if tables:
                    tables[-1].rows.append([])
                else:
                    flow.end_line()
            elif name == "table":
                flow.end_line(not tables)
                tables.append(_Table())
                flows.append(_Flow())  # what stands in a table but in no cell
            elif name == "caption" and tables:
                flows.append(_Flow())
            elif name in BLOCKS:
                nested = name in ("ul", "ol", "menu") and bool(lists)
                flow.end_line(name in SPACED and not nested)
                if name in ("ul", "ol", "menu"):
                    lists.append([name, _number(attrs.get("start"), 1, 10 ** 9)])
                elif name == "li":
                    marker = "- "
                    if lists and lists[-1][0] == "ol":
                        if re.fullmatch(r"\s*-?[0-9]{1,9}\s*", attrs.get("value", "")):
                            lists[-1][1] = int(attrs["value"])
                        marker = f"{lists[-1][1]}. "
                        lists[-1][1] += 1
                    indent += " " * len(marker)
                    flow.marker = marker
                elif name in ("blockquote", "dd"):
                    indent += "  "
                elif name == "pre":
                    kept += 1
                elif name == "details" and "open" not in attrs:
                    opened[-1] = (*opened[-1][:3], "folded", False)
            continue
        hides, before, outer, role, apart = opened.pop()
        if name in VOID:
            continue
        if hidden:
            hidden -= 1
            continue
        inner, drawn = drawn, outer
        if apart or name == "text" and inner == "text" and outer == "silent" or name == "foreignobject" and outer:
            flow.text(" ", before)
        if role == "select":
            select = selects.pop()
            if select.boxed:
                flow.end_line()
            elif select.shown:
                flow.text(f" {select.shown} ", before)
        elif role.startswith("option"):
            lines, select, rank = flows.pop().result(), selects[-1], int(role[-1])
            if select.boxed:
                flows[-1].block(lines, before)
            elif rank > select.rank or rank == select.rank == 3:
                select.shown, select.rank = " ".join(x.strip() for x in lines if x.strip()), rank
        elif name == "textarea":
            flow.end_line()
            kept -= 1
        elif outer == "silent":
            pass
        elif name in ("td", "th") and tables and "|" in before and len(flows) > 1:
            before, span, down = before.rsplit("|", 2)
            tables[-1].rows[-1].append((flows.pop().result(), int(span), int(down)))
        elif name == "caption" and tables and len(flows) > 1:
            tables[-1].caption = flows.pop().result()
        elif name == "table" and tables:
            loose, table = flows.pop().result(), tables.pop()
            flows[-1].block(loose + table.caption + aligned(table.rows, layout), before)
            flows[-1].end_line(not tables)
        elif name in BLOCKS and name != "tr":
            flow.end_line(name in SPACED and not (name in ("ul", "ol", "menu") and len(lists) > 1))
            if name in ("ul", "ol", "menu") and lists:
                lists.pop()
            elif name == "li":
                flow.marker = ""
            elif name == "pre":
                kept -= 1
        indent = before
    while len(flows) > 1:
        rest = flows.pop().result()
        flows[-1].block(rest, "")
    return "\n".join(flows[0].result())


def extract(pages: DataFrame, *, html: str = "html", layout: Layout = Layout()) -> tuple[DataFrame, str]:
    """The pages without their source, with the visible text in a column whose name is returned.
    Null and empty pages give an empty text; every page is rendered on its own and whole."""
    rest = [c for c in pages.columns if c != html]
    (name,) = fresh(pages, "text")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(page, layout) for page in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(texts, pa.string())], names=[*rest, name])

    schema = pages.select(*rest).selectExpr("*", f"CAST(NULL AS string) AS {name}").schema
    return pages.select(*rest, html).mapInArrow(work, schema), name


def html_report(pages: DataFrame) -> DataFrame:
    """Per page: page_id, text, n_lines."""
    found, name = extract(pages.select("page_id", "html"))
    return found.selectExpr("page_id", f"{name} AS text", f"CAST(if({name} = '', 0, size(split({name}, '\\n'))) AS BIGINT) AS n_lines")
