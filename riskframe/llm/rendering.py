"""Visible text of HTML pages, laid out as a browser would: blocks, lists and aligned tables.

A small tree builder follows the parts of the HTML standard that decide where text ends up: void and raw
elements, implied end tags (p, li, dt, dd, tr, td, option ...), implied table rows, stray end tags and cut
markup. The renderer walks the tree, leaves out what is not displayed, collapses white space and margins,
marks list items, keeps preformatted text and pads table cells to columns.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import Batches, arrow_type, batch

# Element names of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = set(
    "head script style template noscript noembed noframes iframe object audio video canvas svg math datalist "
    "area base basefont link meta param source track title".split()
)
MARGIN = dict.fromkeys("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl pre figure table fieldset".split(), 1) | dict.fromkeys(
    "html body div article section nav header footer main aside address form figcaption details summary center "
    "li dt dd hr dialog menu search hgroup legend caption tr thead tbody tfoot optgroup option".split(),
    0,
)
CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dt dd".split()
)
# A start tag ends an open element of these names, unless a boundary lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
HEAD_ONLY = set("base basefont bgsound link meta title style script noscript template head".split())

# In a tag a quote opens a value only right after an equals sign; anywhere else it is part of a name or a bare value.
_NAME = r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+"
_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)|</(?:>|[^a-zA-Z>][^>]*(?:>|\Z))"
    r"|<(/?)([a-zA-Z][^ \t\n\r\f/>]*+)"
    r"((?:[ \t\n\r\f/]++|" + _NAME + r"(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^ \t\n\r\f>\"'][^ \t\n\r\f>]*+)?)?)*+)(>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile("(" + _NAME + r")(?:[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:\"([^\"]*)\"?|'([^']*)'?|([^ \t\n\r\f>\"'][^ \t\n\r\f>]*)?))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_STYLE = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.IGNORECASE)


class Node:
    __slots__ = ("attributes", "children", "name")

    def __init__(self, name: str, attributes: dict[str, str] | None = None) -> None:
        self.name, self.attributes, self.children = name, attributes or {}, []


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


class Builder:
    """Open elements from the root down; text and elements go to the innermost.

    ``places`` has the places of each name among the open elements, so no depth makes a tag slow.
    """

    def __init__(self) -> None:
        self.root = Node("html")
        self.open = [self.root]
        self.places: dict[str, list[int]] = defaultdict(list)

    def _last(self, names: set[str]) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def _cut(self, place: int) -> None:
        """Close the open elements from ``place`` on."""
        for node in self.open[place:]:
            self.places[node.name].pop()
        del self.open[place:]

    def _end(self, names: set[str], bounds: set[str]) -> bool:
        """Close the outermost open element of ``names`` below the nearest of ``bounds``."""
        if not any(self.places.get(n) for n in names):
            return False
        bound, found = self._last(bounds - names), []
        for n in names:
            at = self.places.get(n, [])
            found += at[(k := bisect_right(at, bound)) : k + 1]
        if found:
            self._cut(min(found))
        return bool(found)

    def start(self, name: str, found: dict[str, str], closed: bool = False) -> None:
        if name == "html":
            self.root.attributes = found | self.root.attributes
            return
        if name == "body" and self.places.get("body"):
            return
        if name not in HEAD_ONLY and self.places.get("head"):
            self._end({"head"}, set())
        if name in CLOSES_P:
            self._end({"p"}, {"button", "table", "td", "th", "caption", "object", "li", "blockquote"})
        if name in ENDS:
            self._end(*ENDS[name])
        if name in ("td", "th") and self.open[-1].name in ("table", "thead", "tbody", "tfoot"):
            self.start("tr", {})
        if name in ("h1", "h2", "h3", "h4", "h5", "h6") and self.open[-1].name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self._cut(len(self.open) - 1)
        node = Node(name, found)
        self.open[-1].children.append(node)
        if name not in VOID and not closed:
            self.places[name].append(len(self.open))
            self.open.append(node)

    def end(self, name: str) -> None:
        if name in ("html", "body"):
            return
        if name == "br":
            self.start("br", {})
            return
        bounds = {"table", "td", "th"} - {name} if name not in ("table", "tr", "tbody", "thead", "tfoot") else {"table"} - {name}
        place = self._last({name})
        if place > self._last(bounds):
            self._cut(place)

    def text(self, data: str) -> None:
        if data:
            if self.open[-1].name == "head" and not data.isspace():
                self._end({"head"}, set())
            self.open[-1].children.append(data)


def parse(source: str) -> Node:
    """The element tree of a page, whole or cut short."""
    builder, at = Builder(), 0
    source = source.replace("\r\n", "\n").replace("\x00", "")
    while True:
        m = _MARKUP.search(source, at)
        if not m:
            builder.text(html.unescape(source[at:]))
            return builder.root
        builder.text(html.unescape(source[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        if not m[4]:  # cut inside a tag
            return builder.root
        name = m[2].lower()
        if m[1]:
            builder.end(name)
            continue
        builder.start(name, attributes(m[3]) if m[3] else {}, m[3].endswith("/") and name in ("svg", "math"))
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(source, at)
            data = source[at : end.start() if end else len(source)]
            builder.text(html.unescape(data) if name in ("textarea", "title") else data)
            at = end.start() if end else len(source)


def _style(node: Node) -> dict[str, str]:
    """The last value of each property that decides whether something is seen."""
    found = node.attributes.get("style")
    return {k.lower(): v.lower() for k, v in _STYLE.findall(found)} if found else {}


def hidden(node: Node) -> bool:
    """Whether the element and all inside it are not rendered, whatever its children say."""
    found = node.attributes
    return (
        node.name in HIDDEN
        or "hidden" in found
        or (node.name == "input" and found.get("type", "").lower() == "hidden")
        or (node.name == "dialog" and "open" not in found)
        or _style(node).get("display") == "none"
    )


def seen(root: Node) -> Node:
    """The tree without what is not rendered, and without the text of invisible elements.

    Visibility is inherited and a child may be visible again; of closed ``details`` only the summary is left.
    """
    stack = [(root, _style(root).get("visibility") not in ("hidden", "collapse"))]
    while stack:
        node, visible = stack.pop()
        children: list[Node | str] = []
        for child in node.children:
            if isinstance(child, str):
                if visible:
                    children.append(child)
            elif not hidden(child):
                state = _style(child).get("visibility", "inherit")
                shown = visible if state in ("inherit", "unset") else state not in ("hidden", "collapse")
                if shown or child.name not in VOID:
                    children.append(child)
                    stack.append((child, shown))
        if node.name == "details" and "open" not in node.attributes:
            children = [c for c in children if isinstance(c, Node) and c.name == "summary"][:1]
        node.children = children
    return root


class Page:
    """Lines under construction: an inline run, pending blank lines, and the text before the next line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.run: list[str] = []
        self.blank = 0
        self.indent = ""
        self.bullet = ""

    def inline(self, data: str, kept: bool) -> None:
        if not kept:
            data = _SPACE.sub(" ", data)
            if data.startswith(" ") and (not self.run or self.run[-1].endswith((" ", "\n"))):
                data = data[1:]
            if data:
                self.run.append(data)
            return
        first, *rest = data.split("\n")
        self.run.append(first)
        for part in rest:
            self.line(kept=True)
            self.run.append(part)

    def line(self, kept: bool = False, force: bool = False) -> None:
        """End the inline run; ``force`` makes a line even of nothing."""
        text = "".join(self.run)
        self.run = []
        if not kept:
            text = text.strip(" ")
        if text or self.bullet and text or kept or force:
            if self.lines and self.blank:
                self.lines += [""] * self.blank
            self.blank = 0
            self.lines.append((self.indent + self.bullet + text).rstrip(" "))
            if self.bullet:
                self.indent, self.bullet = self.indent + " " * len(self.bullet), ""

    def block(self, margin: int) -> None:
        if self.run and "".join(self.run).strip(" "):
            self.line()
        self.run = []
        self.blank = max(self.blank, margin)


def _number(text: str | None, default: int, most: int = 10**6) -> int:
    try:
        return min(int(text or default), most)
    except ValueError:
        return default


#: A function of the walk yields the calls it would make and is sent their results, so depth costs no recursion.
Steps = Iterator


def _run(first: Steps) -> list[str] | None:
    stack, value = [first], None
    while stack:
        try:
            step = stack[-1].send(value)
        except StopIteration as end:
            stack.pop()
            value = end.value
        else:
            stack.append(step)
            value = None
    return value


def _walk(node: Node, page: Page, kept: bool, depth: int) -> Steps:
    for child in node.children:
        if isinstance(child, str):
            page.inline(child, kept)
        else:
            yield _element(child, page, kept, depth)


def _element(node: Node, page: Page, kept: bool, depth: int) -> Steps:
    name = node.name
    if name == "br":
        page.line(kept=kept, force=True)
    elif name == "table":
        page.block(MARGIN[name])
        for text in (yield _table(node, depth)):
            page.inline(text, True)
            page.line(kept=True)
        page.block(MARGIN[name])
    elif name in ("ul", "ol", "menu"):
        margin = 0 if depth else 1
        page.block(margin)
        number = _number(node.attributes.get("start"), 1)
        for child in node.children:
            if isinstance(child, str):
                page.inline(child, kept)
            elif child.name == "li":
                number = _number(child.attributes.get("value"), number)
                yield _item(child, page, f"{number}. " if name == "ol" else "* ", kept, depth + 1)
                number += 1
            else:
                yield _element(child, page, kept, depth + 1)
        page.block(margin)
    elif name == "li":
        yield _item(node, page, "* ", kept, depth)
    elif name in ("dd", "blockquote"):
        page.block(MARGIN[name])
        before, page.indent = page.indent, page.indent + "  "
        yield _walk(node, page, kept, depth)
        page.block(MARGIN[name])
        page.indent = before
    elif name == "pre":
        page.block(1)
        yield _walk(node, page, True, depth)
        if page.run:
            page.line(kept=True)
        page.block(1)
    elif name in ("td", "th"):
        page.inline(" ", False)
        yield _walk(node, page, kept, depth)
    elif name in MARGIN:
        page.block(MARGIN[name])
        yield _walk(node, page, kept, depth)
        page.block(MARGIN[name])
    else:
        yield _walk(node, page, kept, depth)


def _item(node: Node, page: Page, bullet: str, kept: bool, depth: int) -> Steps:
    page.block(0)
    before, page.bullet = page.indent, bullet
    yield _walk(node, page, kept, depth)
    page.block(0)
    page.indent, page.bullet = before, ""


def _rows(node: Node, rows: list[Node], captions: list[Node]) -> Steps:
    for child in node.children:
        if isinstance(child, str):
            continue
        if child.name in ("thead", "tbody", "tfoot"):
            yield _rows(child, rows, captions)
        elif child.name == "tr":
            rows.append(child)
        else:
            captions.append(child)


def _table(node: Node, depth: int) -> Steps:
    """Lines of a table: captions and stray content first, then rows with cells padded to columns."""
    rows, stray = [], []
    yield _rows(node, rows, stray)
    loose = Page()
    for text in node.children:
        if isinstance(text, str):
            loose.inline(text, False)
    for other in stray:
        yield _element(other, loose, False, depth)
    loose.block(0)
    widths: dict[int, int] = {}
    grid: list[list[tuple[int, int, list[str]]]] = []
    covered: dict[int, int] = {}  # columns that cells of earlier rows still reach into
    for row in rows:
        at, cells = 0, []
        covered = {c: n - 1 for c, n in covered.items() if n > 1}
        reaching = dict(covered)
        for cell in row.children:
            if isinstance(cell, str):
                cell = Node("td") if cell.strip() else None
            if cell is None:
                continue
            while at in reaching:
                at += 1
            inner = Page()
            yield _walk(cell, inner, False, 0)
            inner.block(0)
            span = max(1, _number(cell.attributes.get("colspan"), 1, 1000))
            deep = max(1, _number(cell.attributes.get("rowspan"), 1, 1000))
            cells.append((at, span, inner.lines))
            if deep > 1:
                covered |= {at + k: deep for k in range(span)}
            if span == 1:
                widths[at] = max([widths.get(at, 0), *map(len, inner.lines)])
            at += span
        grid.append(cells)
    for cells in grid:  # cells over several columns widen the last of them where they need room
        for at, span, text in cells:
            if span > 1:
                room = sum(widths.get(at + k, 0) for k in range(span)) + 2 * (span - 1)
                widths[at + span - 1] = widths.get(at + span - 1, 0) + max(0, max(map(len, text), default=0) - room)
    starts, place = {}, 0
    for c in range(max(widths, default=-1) + 1):
        starts[c] = place
        place += widths.get(c, 0) + 2
    out = list(loose.lines)
    for cells in grid:
        for k in range(max((len(text) for _, _, text in cells), default=0)):
            line = ""
            for at, _, text in cells:
                if k < len(text) and text[k]:
                    line = line.ljust(starts.get(at, 0)) + text[k]
            out.append(line.rstrip(" "))
    return out


def render(source: str | None) -> tuple[str | None, str]:
    """(title, visible text) of a page; None and the empty text for null."""
    if source is None:
        return None, ""
    root = parse(source)
    page, title = Page(), _title(root)
    _run(_walk(seen(root), page, False, 0))
    page.block(0)
    return title, "\n".join(page.lines).strip("\n")


def _title(root: Node) -> str | None:
    stack = [root]
    while stack:
        node = stack.pop()
        if node.name == "title":
            return _SPACE.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip(" ")
        stack += [c for c in reversed(node.children) if not isinstance(c, str) and c.name not in ("svg", "body")]
    return None


def language(source: str | None) -> str | None:
    """Primary subtag of the language that the page declares on its root element, in lower case."""
    m = re.search(r"<html\b([^>]*)>", source or "", re.IGNORECASE)
    declared = attributes(m[1]).get("lang") or attributes(m[1]).get("xml:lang") if m else None
    return re.split(r"[-_]", declared.strip().lower())[0] or None if declared else None


def extract(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, title, text), one row for each row of ``pages``.

    A null page has no title and the empty text; repeated rows stay repeated. Elements
    may be nested to any depth.
    """
    schema = "page_id long, title string, text string"

    def run(batches: Batches) -> Batches:
        out = arrow_type(schema)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                found = [render(h) for h in b.column(1)[at : at + 256].to_pylist()]
                yield batch(out, (b.column(0)[at : at + 256], [t for t, _ in found], [x for _, x in found]))

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, schema)
