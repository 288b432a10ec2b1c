"""Layout-aware text of web pages.

Each page's tags build a tree with implied end tags; the tree is then rendered:
hidden elements give nothing, blocks stand on lines of their own (headings and
paragraphs with a blank line between), list items get their mark and depth, the
cells of a table are padded to its columns, preformatted text keeps its white
space. Of a drawing the text elements and embedded HTML are read (not what only
``use`` would show), of a formula its MathML, without annotations and with its
parts (numerator, exponent) set apart by a space. What has ``aria-hidden`` is on
the screen and is emitted, but for the rendered copy of a formula that stands
right behind its MathML: of the two the MathML is kept. All options of a
``select`` are emitted. Visibility is inherited as in CSS, from ``style``
attributes; rules of style sheets are not applied. Cells stand in the columns
that ``colspan`` and ``rowspan`` leave them. Both steps use explicit stacks and read the page once, so deep or broken
pages are no special case.

Defined results: null and empty pages give the empty text. An unclosed comment,
or a tag cut off by the end of the page, ends the text there, as in browsers.
Null and repeated ids are rows like others; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import text_of

TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?>[^>"'=]+|=\s*+(?:"[^"]*"|'[^']*'|(?!["']))|["'])*+)>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACES = re.compile(r"[ \t\n\r\f]+")
VISIBILITY = re.compile(r"(?:^|;)visibility:(visible|hidden|collapse)")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("""head script style template noscript iframe object datalist noembed noframes audio video canvas title
    annotation annotation-xml mphantom""".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul xmp caption thead tbody tfoot tr td th""".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul xmp".split())
PRE = frozenset(["pre", "xmp"])
CLOSES_P = BLOCK - frozenset("body html caption thead tbody tfoot tr td th legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose start tags may be their own end, what a drawing shows of text and what it only defines.
FOREIGN = frozenset(["svg", "math"])
UNQUOTED_END = re.compile(r"""=\s*[^\s"']+$""")
DRAWN = frozenset(["text", "foreignobject"])
UNDRAWN = frozenset("defs symbol metadata desc clippath mask marker pattern".split())
#: Parts of a formula that stand above, below or beside each other.
PARTS = frozenset("mfrac msub msup msubsup munder mover munderover mmultiscripts mroot mtr mtable".split())
CHOICES = frozenset(["select", "option", "optgroup"])
#: A start tag ends an open element of the set, looked for up to the scope.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir", "table"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "caption", "colgroup"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "thead": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
}
#: End tags of these do not reach out of a cell or table.
WALLS = frozenset(["table", "td", "th", "caption"])


class Node:
    __slots__ = ("tag", "attrs", "children", "math", "behind_math")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []
        self.math = self.behind_math = False  # holds a formula; stands right behind what does

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(self.attrs)}

    def shown(self) -> tuple[bool, bool | None]:
        """Whether the element is rendered, and its own visibility if it says so."""
        if self.tag in HIDDEN:
            return False, None
        low = self.attrs.lower()
        if "hidden" not in low and "style" not in low:
            return True, None
        a = self.attributes()
        style = SPACES.sub("", a.get("style", "").lower())
        if "hidden" in a or "display:none" in style or self.behind_math and a.get("aria-hidden", "").lower() == "true":
            return False, None
        own = VISIBILITY.findall(style)
        return True, own[-1] == "visible" if own else None


class Builder:
    def __init__(self) -> None:
        self.root = Node("html")
        self.open = [self.root]
        self.count = {"html": 1}  # open elements by tag: an end tag without a start is told at once

    def push(self, node: Node) -> None:
        near = next((c for c in reversed(self.open[-1].children) if not isinstance(c, str) or c.strip()), None)
        node.behind_math = isinstance(near, Node) and near.math
        self.open[-1].children.append(node)
        if node.tag == "math":
            node.math = True
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k].math:
                    break
                self.open[k].math = True
        if node.tag not in VOID:
            self.open.append(node)
            self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def cut(self, at: int) -> None:
        while len(self.open) > at:
            self.count[self.open.pop().tag] -= 1

    def close(self, tags: frozenset[str], scope: frozenset[str]) -> None:
        if not any(self.count.get(t) for t in tags):
            return
        for k in range(len(self.open) - 1, 0, -1):
            if (tag := self.open[k].tag) in tags:
                return self.cut(k)
            if tag in scope:
                return

    def start(self, tag: str, attrs: str) -> None:
        if tag in ("html", "body"):
            self.root.attrs += " " + attrs if tag == "html" else ""
            if tag == "body":
                self.close(frozenset(["head"]), WALLS)
            if tag == "html" or self.count.get("body"):
                return
        elif self.count.get("head") and tag in BLOCK:
            self.close(frozenset(["head"]), WALLS)
        if tag in CLOSES_P:
            self.close(frozenset(["p"]), WALLS)
            if tag in HEADINGS and self.open[-1].tag in HEADINGS:
                self.cut(len(self.open) - 1)
        if tag in IMPLIED:
            self.close(*IMPLIED[tag])
            if tag in ("td", "th") and self.count.get("table") and self.open[-1].tag in ("table", "thead", "tbody", "tfoot"):
                self.push(Node("tr"))
        self.push(Node(tag, attrs))

    def end(self, tag: str) -> None:
        if tag == "p" and not self.count.get("p"):
            self.push(Node("p"))
            self.cut(len(self.open) - 1)
        elif tag not in ("html", "body"):
            if tag not in BLOCK and not any(self.count.get(t) for t in FOREIGN) and self.end_inline(tag):
                return
            self.close(frozenset([tag]), WALLS - {tag} if tag not in ("table", "tr", "thead", "tbody", "tfoot") else frozenset(["table"]) - {tag})

    def end_inline(self, tag: str) -> bool:
        """An inline end tag leaves the blocks open that began within its
        element. False if there are none, so that the element may end as others do."""
        if not self.count.get(tag):
            return True
        blocks = False
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                if blocks:
                    del self.open[k]
                    self.count[tag] -= 1
                return blocks
            if self.open[k].tag in WALLS:
                break
            blocks |= self.open[k].tag in BLOCK
        return True

    def text(self, text: str) -> None:
        if text:
            self.open[-1].children.append(entities.unescape(text) if "&" in text else text)


def parse(page: str) -> Node:
    b, at, n = Builder(), 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            b.text(page[at:])
            break
        if lt > at:
            b.text(page[at:lt])
        after = page[lt + 1 : lt + 2]
        if after == "!" or after == "?" or (after == "/" and not page[lt + 2 : lt + 3].isalpha()):
            if page.startswith("<!--", lt):
                close = lt + 4 if page.startswith((">", "->"), lt + 4) else page.find("-->", lt + 4)
                at = n if close < 0 else page.index(">", close) + 1
            else:
                close = page.find(">", lt)
                at = n if close < 0 else close + 1
            continue
        if not after or not (after.isascii() and after.isalpha() or after == "/"):
            b.text("<")
            at = lt + 1
            continue
        m = TAG.match(page, lt)
        if not m:
            break  # the page ends within a tag
        tag, at = m[1].lower(), m.end()
        if after == "/":
            b.end(tag)
            continue
        b.start(tag, m[2])
        if m[2].endswith("/") and (tag in FOREIGN or any(b.count.get(t) for t in FOREIGN)) and not UNQUOTED_END.search(m[2]):
            if b.open[-1].tag == tag:
                b.cut(len(b.open) - 1)
            continue
        if tag in RAW:
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            if tag == "textarea":
                b.text(page[at : close.start() if close else n])
            elif tag == "xmp":
                b.open[-1].children.append(page[at : close.start() if close else n])
            at = close.start() if close else n
    return b.root


def width(text: str) -> int:
    """Columns of a line: wide characters take two, marks none."""
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Sink:
    """Lines of one flow: the page, a cell, or a list item's own depth."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.blank = False  # a blank line is due before the next text
        self.space = False  # white space is due before the next word
        self.indent: list[str] = []
        self.mark = ""

    def end_line(self, blank: bool = False) -> None:
        if self.line:
            self.lines.append(self.line)
            self.line = ""
        self.blank |= blank and bool(self.lines)
        self.space = False

    def begin(self) -> None:
        if not self.line:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            depth = "".join(self.indent)
            if self.mark:
                depth = depth[: max(0, len(depth) - len(self.mark))] + self.mark
                self.mark = ""
            self.line, self.space = depth, False

    def words(self, text: str) -> None:
        text = SPACES.sub(" ", text)
        body = text.strip(" ")
        if not body:
            self.space |= bool(self.line)
            return
        lead = text[0] == " " or self.space
        fresh = not self.line
        self.begin()
        self.line += (" " if lead and not fresh else "") + body
        self.space = text[-1] == " "

    def exact(self, text: str) -> None:
        for k, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if k:
                if not self.line:
                    self.lines.append("")
                self.end_line()
            if part:
                self.begin()
                self.line += part

    def text(self) -> str:
        self.end_line()
        return "\n".join(x.rstrip(" ") for x in self.lines).strip("\n")


#: A cell: its text, and the columns and rows that it takes (0 rows: all that are left).
Cell = tuple[str, int, int]


def table_lines(rows: list[list[Cell]]) -> list[str]:
    """Rows of cells, padded so that columns begin alike. A cell takes the first
    columns that no cell of a row above still holds."""
    grid: list[dict[int, list[str]]] = []
    held: dict[int, int] = {}  # column: rows that a cell above still takes
    for at, row in enumerate(rows):
        cells = {k: [""] for k in held}
        left = {k: n - 1 for k, n in held.items() if n > 1}
        column = 0
        for text, span, down in row:
            while column in cells:
                column += 1
            down = min(down or len(rows), len(rows) - at)
            for k in range(column, column + span):
                cells[k] = [""]
                if down > 1:
                    left[k] = down - 1
            cells[column] = text.split("\n")
            column += span
        grid.append(cells)
        held = left
    n = max((max(r, default=-1) + 1 for r in grid), default=0)
    wide = [0] * n
    for r in grid:
        for k, lines in r.items():
            wide[k] = max(wide[k], *map(width, lines))
    out = []
    for r in grid:
        cells = [r.get(k, [""]) for k in range(max(r, default=-1) + 1)]
        for i in range(max(map(len, cells), default=0)):
            parts = [c[i] if i < len(c) else "" for c in cells]
            out.append(" | ".join(p + " " * (wide[k] - width(p)) for k, p in enumerate(parts)).rstrip())
    return out


def _number(node: Node, name: str, most: int, least: int = 1) -> int:
    """A cell's span: 1 if it is not a number from ``least`` on."""
    value = node.attributes().get(name, "1") if node.attrs else "1"
    return min(int(value), most) if re.fullmatch("[0-9]{1,9}", value) and int(value) >= least else 1


def visible_text(page: str | None) -> str:
    sinks, tables, lists = [Sink()], [], []  # tables: rows of cells; lists: next number or None
    pre = 0
    drawn = [True]  # within a drawing: whether text shows here
    seen = [True]  # visibility of the element and those around it
    stack: list[tuple[object, bool]] = [(parse(page or ""), False)]
    while stack:
        node, leaving = stack.pop()
        out = sinks[-1]
        if isinstance(node, str):
            if not drawn[-1] or not seen[-1]:
                continue
            if pre:
                out.exact(node)
            else:
                out.words(node)
            continue
        tag = node.tag
        if not leaving:
            rendered, own = node.shown()
            if not rendered or len(drawn) > 1 and tag in UNDRAWN:
                continue
            if tag == "svg" or len(drawn) > 1 and tag in DRAWN:
                if tag != "svg":
                    (out.exact if pre else out.words)(" ")
                drawn.append(tag != "svg")
            if tag == "br":
                out.begin()
                out.lines.append(out.line)
                out.line, out.space = "", False
                continue
            seen.append(seen[-1] if own is None else own)
            if tag in CHOICES:
                out.words(" ")
            if tag == "table":
                out.end_line(True)
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append([])
                sinks.append(Sink())
            elif tag in BLOCK:
                out.end_line(tag in SPACED and not (tag in ("ul", "ol") and lists))
                if tag in ("ul", "ol", "menu", "dir"):
                    first = node.attributes().get("start", "1") if tag == "ol" else ""
                    lists.append(int(first) if tag == "ol" and re.fullmatch(r"-?[0-9]{1,9}", first) else 1 if tag == "ol" else None)
                elif tag == "li":
                    mark = "- "
                    if lists and lists[-1] is not None:
                        if re.fullmatch(r"-?[0-9]{1,9}", own_number := node.attributes().get("value", "") if node.attrs else ""):
                            lists[-1] = int(own_number)
                        mark, lists[-1] = f"{lists[-1]}. ", lists[-1] + 1
                    out.mark = mark
                    out.indent.append(" " * len(mark))
                elif tag == "dd":
                    out.indent.append("  ")
                elif tag == "blockquote":
                    out.indent.append("  ")
            pre += tag in PRE
            stack.append((node, True))
            if tag in PARTS:
                stack.extend((c, False) for child in reversed(node.children) for c in (" ", child, " "))
            else:
                stack.extend((c, False) for c in reversed(node.children))
            continue
        pre -= tag in PRE
        seen.pop()
        if tag in CHOICES:
            out.words(" ")
        if tag == "svg" or len(drawn) > 1 and tag in DRAWN:
            drawn.pop()
            if tag != "svg":
                (out.exact if pre else out.words)(" ")
        if tag == "table":
            rows = tables.pop()
            out.end_line(True)
            for line in table_lines(rows):
                out.begin()
                out.lines.append(out.line + line)
                out.line = ""
            out.end_line(True)
        elif tag in ("td", "th") and tables:
            cell = sinks.pop().text()
            tables[-1][-1].append((cell, _number(node, "colspan", 1000), _number(node, "rowspan", 65534, least=0)))
        elif tag in BLOCK and not (tag == "tr" and tables):
            out.end_line(tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1))
            if tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            elif tag in ("li", "dd", "blockquote"):
                out.indent.pop()
                out.mark = ""
    return sinks[0].text()


def extract(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, text) of every page."""

    @F.pandas_udf("string")
    def text(s: pd.Series) -> pd.Series:
        return s.map(visible_text)

    return pages.select(F.col(page_id).alias("page_id"), text(text_of(html)).alias("text"))
