"""HTML to text by layout: a tree with implied tags, visibility rules, block spacing, lists and aligned tables.

The tree builder closes what HTML lets authors leave open (the head before what can't stand in it, paragraphs before
blocks, list items, table rows and cells, options, definition terms), ignores end tags without a start, and adds missing rows. The renderer drops what
a browser doesn't show (head, scripts, styles, templates, the hidden attribute, ``display:none``, what inherits
``visibility:hidden`` up to the next ``visible``, closed details except their summary, input fields, fallback content) and emits all other text:
inline text with white space collapsed across tags, blocks on lines of their own with a blank line where browsers
leave a margin, ``pre`` as it is, list items with their marker and indent, and table cells padded to the width of
their column, beside cells that span rows and columns. Elements nest to any depth. Formulas, the text of drawings, text areas and the options that a select shows are inline text.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerweave.llm.words import slices

# fixed values: elements by how HTML treats them
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style template noscript iframe object audio video canvas datalist input meta link base area map".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre figure table menu fieldset".split())
BLOCKS = SPACED | frozenset("html body div section article aside header footer nav main address hgroup form li dt dd figcaption details summary legend center tr thead tbody tfoot caption option optgroup search dialog".split())
CLOSES_P = (BLOCKS - frozenset("html body li dt dd tr thead tbody tfoot caption option optgroup summary legend figcaption".split())) | {"hr"}
# SVG and MathML: what they never show, elements whose content is HTML, and HTML elements that end them
FOREIGN = frozenset(("svg", "math"))
FOREIGN_UNSEEN = frozenset("desc defs metadata symbol clippath mask marker pattern lineargradient radialgradient filter annotation annotation-xml mphantom".split())
HTML_INSIDE = frozenset("foreignobject desc title mi mo mn ms mtext".split())
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
EMBEDDED = FOREIGN | {"select", "textarea"}
IN_HEAD = frozenset("title meta link script style base template noscript noframes".split())
ROW_GROUPS = frozenset(("thead", "tbody", "tfoot"))
CELLS = frozenset(("td", "th"))
# an opening tag closes these open elements, unless one of the second kind lies between
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    **{g: ({"tr", "td", "th", "caption", *ROW_GROUPS}, {"table"}) for g in ROW_GROUPS},
}
# an end tag of an element further out doesn't reach across these
SCOPES = frozenset(("table", "td", "th", "caption", "html"))
INDENT = 2
_HIDDEN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*([a-z]+)", re.I)
#: Python calls that one level of nesting takes at most.
CALLS = 6
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("attrs", "children", "foreign", "holds_foreign", "tag", "veiled")

    def __init__(self, tag: str, attrs: dict[str, str | None]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []
        self.veiled = False  # takes its place, but its own text isn't seen
        self.foreign = self.holds_foreign = False  # is SVG or MathML; and so is what it holds


class TreeBuilder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.count: Counter = Counter()  # of open elements by tag
        self.depth = 1

    def _pop(self, to: int) -> None:
        """Close all open elements from this place on."""
        for node in self.open[to:]:
            self.count[node.tag] -= 1
        del self.open[to:]

    def _close(self, names: set[str] | frozenset[str], unless: set[str] | frozenset[str]) -> None:
        """Close the outermost open element of these names that lies within the nearest of the others."""
        if not any(self.count[name] for name in names):
            return
        found = None
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in names:
                found = k
            elif self.open[k].tag in unless:
                break
        if found is not None:
            self._pop(found)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._start(tag, attrs, False)

    def _start(self, tag: str, attrs: list[tuple[str, str | None]], closed: bool) -> None:
        if self.open[-1].tag == "textarea":  # holds text only
            self.handle_data(self.get_starttag_text() or "")
            return
        if tag == "html":
            return
        if self.open[-1].holds_foreign and (tag in BREAKS_OUT or tag == "font" and any(a in ("color", "face", "size") for a, _ in attrs)):
            while self.open[-1].holds_foreign:
                self._pop(len(self.open) - 1)
        if tag in FOREIGN or self.open[-1].holds_foreign:
            self._end_head()
            self._add(Node(tag, dict(attrs)), closed or tag in VOID)
            return
        if tag not in IN_HEAD:
            self._end_head()
        if tag == "body":  # a head ends here with all that is open in it
            self._close({"head"}, set())
        elif tag in CLOSES_P:
            self._close({"p"}, SCOPES)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        if tag in CELLS and self.open[-1].tag in ROW_GROUPS | {"table"}:
            self._add(Node("tr", {}))
        if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456" and self.open[-1].tag[:1] == "h" and self.open[-1].tag[1:] in "123456":
            self._pop(len(self.open) - 1)
        self._add(Node(tag, dict(attrs)), tag in VOID)

    def _add(self, node: Node, void: bool = False) -> None:
        self.open[-1].children.append(node)
        if node.tag in FOREIGN or self.open[-1].holds_foreign:
            node.foreign = True
            as_html = node.tag == "annotation-xml" and (node.attrs.get("encoding") or "").lower() in ("text/html", "application/xhtml+xml")
            node.holds_foreign = node.tag not in HTML_INSIDE and not as_html
        if not void:
            self.open.append(node)
            self.count[node.tag] += 1
            self.depth = max(self.depth, len(self.open))

    def _end_head(self) -> None:
        """What comes next can't stand in a head: one left open ends before it."""
        if self.open[-1].tag == "head":
            self._pop(len(self.open) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._start(tag, attrs, True)  # in HTML the slash means nothing, in SVG and MathML it ends the element

    def handle_endtag(self, tag: str) -> None:
        if self.open[-1].tag == "textarea" != tag:
            self.handle_data(f"</{tag}>")
            return
        if tag == "br":
            self._end_head()
            self._add(Node("br", {}), True)
            return
        for k in range(len(self.open) - 1 if self.count[tag] else 0, 0, -1):
            if self.open[k].tag == tag:
                self._pop(k)
                return
            if self.open[k].tag in SCOPES and tag not in ("table", "tr", "body", *ROW_GROUPS):
                break
        if tag == "p":
            self.open[-1].children.append(Node("p", {}))

    def handle_comment(self, data: str) -> None:
        if self.open[-1].tag == "textarea":
            self.handle_data(f"<!--{data}-->")

    def handle_data(self, data: str) -> None:
        if data.strip(" \t\n\r\f"):
            self._end_head()
        self.open[-1].children.append(data)


def tree(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    if re.match(r"<[a-zA-Z/!?]", builder.rawdata):  # a tag or comment that the page's end cuts off
        builder.rawdata = ""
    builder.close()
    _veil(builder.root)
    # calls of Python functions only need their limit raised, whatever the depth of a page
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + CALLS * builder.depth))
    return builder.root


def _visibility(node: Node) -> str:
    found = _VISIBILITY.findall(node.attrs.get("style") or "")
    return (found[-1] if found else (node.attrs.get("visibility") or "") if node.foreign else "").lower()


def _veil(root: Node) -> None:
    """Apply the visibility that elements inherit: hidden text goes, and elements that hold nothing else."""
    order, at = [root], 0
    while at < len(order):
        node = order[at]
        at += 1
        for x in node.children:
            if isinstance(x, Node):
                own = _visibility(x)
                x.veiled = own in ("hidden", "collapse") or node.veiled and own != "visible"
                order.append(x)
    seen: set[int] = set()
    for node in reversed(order):  # children come before their parents
        if any(isinstance(x, Node) and x.veiled for x in node.children) or node.veiled:
            node.children = [x for x in node.children if (not node.veiled if isinstance(x, str) else not x.veiled or id(x) in seen)]
        if node.veiled and any(isinstance(x, Node) and (not x.veiled or id(x) in seen) for x in node.children):
            seen.add(id(node))


def visible(node: Node) -> bool:
    attrs = node.attrs
    if node.foreign and (node.tag in FOREIGN_UNSEEN or attrs.get("display") == "none"):
        return False
    return node.tag not in UNSEEN and "hidden" not in attrs and not _HIDDEN.search(attrs.get("style") or "")


class Lines:
    """Text under layout: words flow, blocks begin lines, margins collapse."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now = ""
        self.margin = 0  # blank lines due before the next text
        self.space = False

    def text(self, data: str) -> None:
        for k, word in enumerate(_SPACE.split(data)):
            if k:
                self.space = True
            if word:
                self._due()
                self.now += (" " if self.space and self.now else "") + word
                self.space = False

    def _due(self) -> None:
        if not self.now:
            if self.lines:
                self.lines += [""] * self.margin
            self.margin = 0

    def end(self, margin: int = 0) -> None:
        """End the line, and ask for so many blank lines before what follows."""
        if self.now:
            self.lines.append(self.now)
            self.now = ""
        self.space = False
        self.margin = max(self.margin, margin)

    def break_line(self) -> None:
        if self.now:
            self.end()
        else:
            self._due()
            self.lines.append("")
        self.space = False

    def block(self, lines: list[str], margin: int = 0) -> None:
        """Finished lines, with margins around."""
        self.end(margin)
        if lines:
            self._due()
            self.lines += lines
            self.margin = margin

    def finished(self) -> list[str]:
        self.end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def width(text: str) -> int:
    """Columns on a terminal: wide characters take two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


def _groups(node: Node) -> list[list[Node]]:
    """Visible rows of a table by row group; rows of its own that follow each other are a group as well."""
    out: list[list[Node]] = []
    own = False
    for x in node.children:
        if isinstance(x, Node) and visible(x):
            if x.tag == "tr":
                if not own:
                    out.append([])
                out[-1].append(x)
                own = True
            elif x.tag in ROW_GROUPS:
                out.append([y for y in x.children if isinstance(y, Node) and y.tag == "tr" and visible(y)])
                own = False
    return out


def _span(x: Node, name: str, least: int) -> int:
    value = (x.attrs.get(name) or "").strip()
    return int(value) if value.isascii() and value.isdecimal() and int(value) >= least else 1


def _placed(group: list[Node]) -> list[dict[int, list[str]]]:
    """The lines of each row's cells by column, beside cells of earlier rows that reach down (to the group's end at most)."""
    out: list[dict[int, list[str]]] = []
    taken: list[tuple[int, int, int]] = []  # columns from, to, and the row after the last
    for r, row in enumerate(group):
        taken = sorted(t for t in taken if t[2] > r)
        cells: dict[int, list[str]] = {}
        column, new = 0, []
        for x in row.children:
            if isinstance(x, Node) and x.tag in CELLS and visible(x):
                for lo, hi, _ in taken:
                    if lo <= column < hi:
                        column = hi
                wide, high = _span(x, "colspan", 1), _span(x, "rowspan", 0)
                cells[column] = render(x)
                if high != 1:
                    new.append((column, column + wide, r + high if high else len(group)))
                column += wide
        taken += new
        out.append(cells)
    return out


def _table(node: Node) -> list[str]:
    out = [line for x in node.children if isinstance(x, Node) and x.tag == "caption" and visible(x) for line in render(x)]
    grid = [cells for group in _groups(node) for cells in _placed(group) if any(cells.values())]
    sizes: dict[int, int] = {}
    for cells in grid:
        for k, cell in cells.items():
            sizes[k] = max([sizes.get(k, 0), *map(width, cell)])
    columns = sorted(sizes)
    for cells in grid:
        for n in range(max(map(len, cells.values()))):
            line = "  ".join([t + " " * (sizes[k] - width(t)) for k in columns for t in [cells[k][n] if k in cells and n < len(cells[k]) else ""]])
            out.append(line.rstrip(" "))
    # text that stands in a table outside its cells is shown before it
    loose = Lines()
    _loose(node, loose)
    return loose.finished() + out


def _loose(node: Node, out: Lines) -> None:
    for x in node.children:
        if isinstance(x, str):
            out.text(x)
        elif x.tag in ROW_GROUPS or x.tag == "tr":
            if visible(x):
                _loose(x, out)
        elif x.tag not in CELLS and x.tag != "caption":
            _flow(x, out)


def _integer(text: str | None, default: int) -> int:
    return int(text) if re.fullmatch(r"\s*[-+]?[0-9]{1,9}\s*", text or "") else default


def _numeral(n: int, kind: str | None) -> str:
    """Decimal, or letters (a, b, ..., z, aa) or Roman numerals where the list asks for them and they exist."""
    if kind in ("a", "A") and n > 0:
        out = ""
        while n:
            n, k = divmod(n - 1, 26)
            out = chr(97 + k) + out
    elif kind in ("i", "I") and 0 < n < 4000:
        out = "".join(["", one, one * 2, one * 3, one + five, five, five + one, five + one * 2, five + one * 3, one + ten][n // unit % 10] for unit, one, five, ten in ((1000, "m", "", ""), (100, "c", "d", "m"), (10, "x", "l", "c"), (1, "i", "v", "x")))
    else:
        return str(n)
    return out.upper() if kind in ("A", "I") else out


def _list(node: Node, out: Lines, nested: bool) -> None:
    items = sum(isinstance(x, Node) and x.tag == "li" and visible(x) for x in node.children)
    step = -1 if "reversed" in node.attrs else 1
    number = _integer(node.attrs.get("start"), items if step < 0 else 1)
    lines: list[str] = []
    for x in node.children:
        if isinstance(x, str):
            if x.strip():
                lines += [" ".join(x.split())]
            continue
        if not visible(x):
            continue
        body = _alone(x) if x.tag in EMBEDDED else render(x)
        if x.tag == "li":
            number = _integer(x.attrs.get("value"), number) if node.tag == "ol" else number
            marker = "" if x.veiled else f"{_numeral(number, x.attrs.get('type') or node.attrs.get('type'))}. " if node.tag == "ol" else "- "
            number += step
        else:
            marker = ""
        pad = " " * len(marker)
        lines += [(marker if k == 0 else pad if line else "") + line for k, line in enumerate(body)]
    out.block(lines, 0 if nested else 1)


def _flow(x: Node, out: Lines, nested: bool = False) -> None:
    if not visible(x):
        return
    tag = x.tag
    if tag == "br":
        out.break_line()
    elif tag == "hr":
        out.end(1)
    elif tag == "img":
        if (alt := x.attrs.get("alt") or "").strip() and not x.veiled:
            out.text(alt)
    elif tag == "pre":
        text = _plain(x)
        out.block((text[1:] if text.startswith("\n") else text).rstrip("\n").split("\n") if text.strip() else [], 1)
    elif tag in ("ul", "ol", "menu"):
        _list(x, out, nested)
    elif tag == "table":
        out.block(_table(x), 1)
    elif tag == "blockquote" or tag == "dd":
        inner = render(x)
        out.block([" " * INDENT + line if line else "" for line in inner], 1 if tag == "blockquote" else 0)
    elif tag == "select":
        if x.veiled:
            return
        out.text(" " + " ".join(_shown_options(x)) + " ")
    elif tag == "textarea":
        out.text(" ")
        text = "".join(y for y in x.children if isinstance(y, str)).replace("\r\n", "\n").strip("\n")
        for k, line in enumerate(text.split("\n")):
            if k:
                out.break_line()
            out.text(line)
        out.text(" ")
    elif x.foreign and tag == "svg":
        _drawing(x, out)
    elif x.foreign and tag == "math" and x.attrs.get("display") == "block":
        out.end()
        _inside(x, out)
        out.end()
    elif x.foreign and tag == "mfrac":
        for y in x.children:
            out.text(" ")
            if isinstance(y, Node):
                _flow(y, out)
        out.text(" ")
    elif x.foreign and (tag in ("mtr", "mlabeledtr", "mtd") or tag == "tspan" and ("x" in x.attrs or "y" in x.attrs)):
        out.text(" ")
        _inside(x, out)
        out.text(" ")
    elif tag in CELLS:  # a cell outside any table
        out.text(" ")
        _inside(x, out)
        out.text(" ")
    elif tag == "details" and "open" not in x.attrs:
        out.end()
        for y in x.children:
            if isinstance(y, Node) and y.tag == "summary":
                _flow(y, out)
        out.end()
    elif tag in BLOCKS:
        margin = int(tag in SPACED)
        out.end(margin)
        _inside(x, out)
        out.end(margin)
    else:
        _inside(x, out)


def _drawing(node: Node, out: Lines) -> None:
    """Only text elements and embedded HTML show their text; each has its own place."""
    for x in node.children:
        if isinstance(x, str) or not visible(x):
            continue
        if x.tag in ("text", "foreignobject"):
            out.text(" ")
            _inside(x, out)
            out.text(" ")
        else:
            _drawing(x, out)


def _options(node: Node, disabled: bool, seen: bool) -> list[tuple[Node, bool, bool]]:
    """Options and groups of a select: node, is disabled, is visible in a list."""
    out = []
    for x in node.children:
        if isinstance(x, Node):
            own = disabled or x.tag in ("option", "optgroup") and "disabled" in x.attrs, seen and visible(x)
            if x.tag in ("option", "optgroup"):
                out.append((x, *own))
            if x.tag != "option":
                out += _options(x, *own)
    return out


def _shown_options(node: Node) -> list[str]:
    """All labels of a list box; of a drop-down the last selected option, or the first that is not disabled."""
    size = node.attrs.get("size") or ""
    found = _options(node, False, True)
    if "multiple" in node.attrs or size.isdecimal() and int(size) > 1:
        shown = [x for x, _, seen in found if seen]
    else:
        options = [(x, disabled) for x, disabled, _ in found if x.tag == "option"]
        shown = [x for x, _ in options if "selected" in x.attrs][-1:] or [x for x, disabled in options if not disabled][:1]
    return [" ".join(((x.attrs.get("label") or "") or (_plain(x) if x.tag == "option" else "")).split()) for x in shown]


def _alone(x: Node) -> list[str]:
    out = Lines()
    _flow(x, out)
    return out.finished()


def _plain(node: Node) -> str:
    out = []
    for x in node.children:
        if isinstance(x, str):
            out.append(x)
        elif x.tag == "br":
            out.append("\n")
        elif visible(x):
            out.append("\n".join(_alone(x)) if x.tag in EMBEDDED else _plain(x))
    return "".join(out)


def _inside(node: Node, out: Lines) -> None:
    for x in node.children:
        if isinstance(x, str):
            out.text(x)
        else:
            _flow(x, out, node.tag == "li")


def render(node: Node) -> list[str]:
    """The lines of what an element holds."""
    out = Lines()
    _inside(node, out)
    return out.finished()


def html_to_text(html: str | None) -> str:
    """All visible text of a page; '' for null, empty or blank pages."""
    return "\n".join(render(tree(html))) if html and html.strip() else ""


def title_of(node: Node) -> str:
    """The first title's text, from the tree; '' if there is none."""
    for x in node.children:
        if isinstance(x, Node) and (found := " ".join(_plain(x).split()) if x.tag == "title" else title_of(x)):
            return found
    return ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        titles, texts = [], []
        for html in batch.column(2).to_pylist():
            root = tree(html or "")
            titles.append(title_of(root))
            texts.append("\n".join(render(root)))
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(titles, pa.string()), pa.array(texts, pa.string()), pa.array([len(t.encode()) for t in texts], pa.int64())],
            ["page_id", "url", "title", "text", "n_bytes"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, title, text, n_bytes (of the text in UTF-8) for each row of ``pages`` (page_id, url, html).

    Null, empty and blank pages give empty texts; markup that is cut off gives what came before. Rows are
    independent, so repeated rows or ids don't matter; other columns, whatever their names, aren't read. Pages may be
    of any length and depth. An image is told by its ``alt``, which is what is seen in its place.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("text")
    )
    return rows.mapInArrow(_extract, "page_id long, url string, title string, text string, n_bytes long")
