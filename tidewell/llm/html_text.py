"""Visible text of web pages, laid out: a tree with implied tags, visibility rules, block spacing, lists and aligned tables.

Layout: blocks start on a line of their own; paragraphs, headings, lists and tables stand between blank lines; white space is
collapsed except in ``pre``; list items get bullets or numbers and are indented by depth; the cells of a table's column start
at the same place, row spans and column spans counted. Everything visible is emitted; a browser's unrendered elements, closed dialogs and elements
hidden by attribute or inline style are not. ``visibility`` is inherited: a visible child of a hidden parent is shown.
Text areas stand on lines of their own, as written; the options of a select and the texts of a drawing are words apart. What stands
loose in a table or its sections comes before the rows; wrappers of rows (such as ``form``) are walked through.

Defined cases: null and empty pages give empty text; unclosed, misnested and stray tags follow the implied-tag rules below; elements nested deeper
than ``DEPTH`` go on as children of that depth, with their text; repeated rows get equal results; an empty table gives an empty result;
extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame

DEPTH, GAP = 120, "  "

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes noembed".split())
UNSEEN = frozenset("head script style template noscript noframes noembed title meta link iframe object audio video canvas datalist".split())
#: Inside svg only: definitions and descriptions, which are not drawn where they stand.
UNDRAWN = frozenset("defs desc metadata symbol clippath mask pattern marker".split())
#: Inline, but their text never joins the words beside it.
APART = frozenset("td th select optgroup option svg text button".split())
AS_WRITTEN = frozenset("pre textarea xmp listing plaintext".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre xmp listing plaintext blockquote figure".split())
BLOCKS = SPACED | frozenset("html body div section article aside nav header footer main address form fieldset legend details summary figcaption li dt dd caption tr hr center menu dir dialog".split())
#: Start tag -> open elements it ends, and the elements that stop the search for them.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "caption"}, {"tbody", "thead", "tfoot", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
SCOPE = frozenset("table td th caption html body button".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"']|[\"'])*?)(/?)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_GONE = re.compile(r"display\s*:\s*none|content-visibility\s*:\s*hidden", re.I)
_VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(visible|initial|hidden|collapse)", re.I)
_SPACES = re.compile(r"[ \t\n\r\f]+")


class Element:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []

    def gone(self) -> bool:
        """Whether the element takes no part in the layout, its children included."""
        a = self.attributes
        return self.tag in UNSEEN or "hidden" in a or self.tag == "input" or self.tag == "dialog" and "open" not in a or bool(_GONE.search(a.get("style", "")))

    def shown(self, parent: bool) -> bool:
        """Whether the element's own text is painted, where its parent's is or is not."""
        said = _VISIBILITY.findall(self.attributes.get("style", ""))
        return said[-1].lower() in ("visible", "initial") if said else parent

    def whole(self, name: str, default: int) -> int:
        value = self.attributes.get(name, "").strip()
        return int(value) if re.fullmatch(r"-?[0-9]{1,6}", value) else default


def build(page: str) -> Element:
    """The page's tree: start tags end what they imply, end tags without a start tag count for nothing."""
    root = Element("html", {})
    stack = [root]

    def close(tags: set[str] | frozenset[str], stops) -> bool:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return True
            if stack[i].tag in stops:
                return False
        return False

    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        text = page[at : found.start()] if found else page[at:]
        if text:
            stack[-1].children.append(unescape(text))
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "p" and not any(e.tag == "p" for e in stack):
                stack[-1].children.append(Element("p", {}))
            elif tag not in VOID:
                close({tag}, {"td", "th", "table"} - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html") else set())
            continue
        attributes = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(found[3])}
        if tag in ("html", "body") and any(e.tag == tag for e in stack):
            continue
        if tag in IMPLIED:
            # a row ends the cell that is open in it, a section ends the row
            for inner in {"tr": ("td",), "tbody": ("td", "tr"), "thead": ("td", "tr"), "tfoot": ("td", "tr")}.get(tag, ()):
                close(IMPLIED[inner][0], {"table"})
            close(*IMPLIED[tag])
        elif tag in BLOCKS or tag == "body":
            close({"head"}, set())
        if tag in BLOCKS and tag not in ("html", "body", "td", "th"):
            close({"p"}, SCOPE)
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            row = Element("tr", {})
            stack[-1].children.append(row)
            stack.append(row)
        drawn = (tag in UNDRAWN or tag in RAW) and any(e.tag == "svg" for e in stack)
        if drawn and tag in UNDRAWN:
            attributes["hidden"] = ""
        element = Element(tag, attributes)
        stack[-1].children.append(element)
        if tag == "plaintext":  # nothing ends it
            element.children.append(page[at:])
            at = len(page)
        elif tag in RAW and not (drawn and found[4]):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            raw = page[at : end.start()] if end else page[at:]
            element.children.append(unescape(raw).removeprefix("\n") if tag == "textarea" else raw)
            at = end.end() if end else len(page)
        elif tag not in VOID and not found[4] and len(stack) < DEPTH:
            stack.append(element)
    return root


class Writer:
    """Lines under construction: pending spaces and blank lines are written only when more text follows."""

    def __init__(self):
        self.lines: list[str] = []
        self.line, self.space, self.blank = "", False, 0
        self.indent, self.mark = 0, ""

    def text(self, s: str, pre: bool) -> None:
        if pre:
            for i, part in enumerate(s.split("\n")):
                if i:
                    self.end(True)
                if part:
                    self._put(part)
            return
        if s[:1] in " \t\n\r\f" and self.line:
            self.space = True
        for word in _SPACES.split(s):
            if word:
                self._put(" " + word if self.space and self.line else word)
                self.space = True
        self.space = s[-1:] in " \t\n\r\f" and bool(self.line)

    def _put(self, s: str) -> None:
        if not self.line:
            if self.lines and self.blank:
                self.lines.append("")
            self.blank = 0
            pad = " " * self.indent
            self.line = (pad[: max(0, len(pad) - len(self.mark))] + self.mark) if self.mark else pad
            self.mark = ""
        self.line += s

    def end(self, keep_empty: bool = False) -> None:
        if self.line or keep_empty:
            self.lines.append(self.line.rstrip())
        self.line, self.space = "", False

    def block(self, spaced: bool) -> None:
        self.end()
        self.blank = max(self.blank, int(spaced))

    def rows(self, rows: list[list[str]]) -> None:
        """Cells padded to their column's width."""
        widths = [max(len(r[i]) for r in rows if i < len(r)) for i in range(max(map(len, rows)))]
        for r in rows:
            line = GAP.join(c.ljust(w) for c, w in zip(r, widths)).rstrip()
            if line:
                self._put(line)
                self.end()


def _has_row(node: Element) -> bool:
    """Whether a row of the table lies in ``node``; rows of a table in it are that table's own."""
    todo = [node]
    while todo:
        at = todo.pop()
        if at.tag == "tr":
            return True
        todo.extend(c for c in at.children if isinstance(c, Element) and c.tag not in ("table", "td", "th") and not c.gone())
    return False


#: Something in a table, whether its parent is shown, and the section it lies in.
Part = tuple[Element | str, bool, Element]


def _parts(table: Element, shown: bool) -> tuple[list[Part], list[Part]]:
    """What stands loose in a table, its sections and wrappers around its rows (such as ``form``), and the rows, in order."""
    loose: list[Part] = []
    rows: list[Part] = []
    todo: list[Part] = [(c, shown, table) for c in reversed(table.children)]
    while todo:
        child, seen, section = todo.pop()
        if isinstance(child, str):
            loose.append((child, seen, section))
        elif child.tag == "col" or child.gone():
            continue
        elif child.tag == "tr":
            rows.append((child, seen, section))
        elif child.tag in ("tbody", "thead", "tfoot", "colgroup") or child.tag not in ("table", "td", "th", "caption") and _has_row(child):
            inner = child if child.tag in ("tbody", "thead", "tfoot") else section
            todo.extend((c, child.shown(seen), inner) for c in reversed(child.children))
        else:
            loose.append((child, seen, section))
    return loose, rows


def _cells(row: Element, shown: bool) -> Iterator[tuple[str, int, int]]:
    """The cells of a row: text, columns, rows (0: to the end of the section)."""
    for cell in row.children:
        if isinstance(cell, Element) and not cell.gone():
            inner = Writer()
            for child in cell.children if cell.tag in ("td", "th") else [cell]:
                render(child, inner, shown=cell.shown(shown))
            inner.end()
            yield " ".join(x.strip() for x in inner.lines if x.strip()), max(1, min(cell.whole("colspan", 1), 1000)), max(0, min(cell.whole("rowspan", 1), 65534))
        elif isinstance(cell, str) and cell.strip() and shown:
            yield " ".join(cell.split()), 1, 1


def _grid(rows: list[Part]) -> list[list[str]]:
    """Rows of cells by column; places that a cell from above or from the left fills are empty."""
    out: list[list[str]] = []
    taken: dict[int, int] = {}  # column -> rows that a cell from above still fills
    last = None
    for row, shown, section in rows:
        if section is not last:
            taken, last = {}, section
        line: list[str] = []
        begun: dict[int, int] = {}
        for text, across, down in _cells(row, row.shown(shown)):
            while len(line) in taken:
                line.append("")
            if down != 1:
                begun.update(dict.fromkeys(range(len(line), len(line) + across), down - 1 if down else 1 << 20))
            line += [text] + [""] * (across - 1)
        taken = {c: n - 1 for c, n in taken.items() if n > 1} | begun
        if line:
            out.append(line)
    return out


def render(node: Element | str, out: Writer, pre: bool = False, number: list[int] | None = None, shown: bool = True) -> None:
    """Write ``node``; ``shown``: whether its parent's text is painted."""
    if isinstance(node, str):
        if shown:
            out.text(node, pre)
        return
    if node.gone():
        return
    shown = node.shown(shown)
    tag = node.tag
    if tag == "br":
        out.end(not out.line and bool(out.lines) and not out.blank)
        return
    if tag == "hr":
        out.block(True)
        return
    block, spaced = tag in BLOCKS or tag == "textarea", tag in SPACED and not (tag in ("ul", "ol") and out.indent)
    if block:
        out.block(spaced)
    elif tag in APART and tag not in ("td", "th"):
        out.text(" ", False)
    before = out.indent
    counter: list[int] | None = None
    if tag in ("ul", "ol", "menu", "dir"):
        counter = [node.whole("start", 1)] if tag == "ol" else []
    elif tag == "li":
        if number:
            out.mark = f"{node.whole('value', number[0])}. "
            number[0] = node.whole("value", number[0]) + 1
        else:
            out.mark = "- "
        out.indent += max(2, len(out.mark))
        if not shown:
            out.mark = ""
    elif tag in ("dd", "blockquote"):
        out.indent += 2
    if tag == "table":
        loose, rows = _parts(node, shown)
        for child, seen, _ in loose:
            render(child, out, pre, shown=seen)
            if isinstance(child, Element):
                out.end()
        grid = _grid(rows)
        out.end()
        if grid:
            out.rows(grid)
    else:
        for child in node.children:
            render(child, out, pre or tag in AS_WRITTEN, counter if counter is not None else number if tag != "li" else None, shown)
    if tag in APART:
        out.text(" ", False)
    if block:
        out.block(spaced)
    if tag == "li":
        out.mark = ""
    out.indent = before


def page_text(page: str | None) -> str:
    out = Writer()
    render(build(page or ""), out)
    out.end()
    return "\n".join(out.lines).strip("\n")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Id and text of every page."""
    id_type = dict(pages.dtypes)[id_col]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"page_id": frame["id"], "text": [page_text(p if isinstance(p, str) else None) for p in frame["html"]]})

    return pages.select(pages[id_col].alias("id"), pages[html_col].alias("html")).mapInPandas(run, f"page_id {id_type}, text string")
