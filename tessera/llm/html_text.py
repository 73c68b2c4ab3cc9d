"""Layout-aware text of HTML pages (operator 5).

A tokeniser feeds a tree builder that knows void and raw-text elements and the tags that end others by implication.
The tree is rendered without what is not displayed: blocks are set apart by blank lines, list items get markers by
depth, table cells are aligned in columns, preformatted text keeps its lines.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import columns, table

# Element names by their part in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
UNSEEN = frozenset("head script style template title noembed noframes iframe object datalist meta link base".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote ul ol dl table figure hr fieldset form address".split())
LINE = frozenset("html body div section article aside nav header footer main li dt dd tr caption figcaption details summary center "
                 "dir menu legend thead tbody tfoot td th option".split())
BLOCK = PARAGRAPH | LINE
#: What may stand in a head; what is not displayed inside svg and math.
HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
FOREIGN = ("svg", "math")
FOREIGN_UNSEEN = frozenset("title desc metadata defs annotation annotation-xml".split())
LISTS = frozenset(("ul", "ol", "menu", "dir"))
#: a column is filled up to its longest cell, at most to WIDE characters and FILL times its mean cell
WIDE, FILL = 24, 4
#: An opening tag ends these open elements, searched up to the tags of the second set.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
BARRIER = frozenset(("table", "td", "th", "caption", "button", "object", "template", "html"))
_ATTRIBUTE = re.compile(r"([^\s=>/\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_BLANK = re.compile(r"[ \t\n\r\f]+")
#: End tags of raw-text elements, looked for in the text itself: a text in small letters may differ in length (U+0130).
_RAW_END = {name: re.compile(f"</{name}(?=[ \\t\\n\\r\\f/>])", re.I | re.A) for name in RAW if name != "plaintext"}


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.kids = tag, attrs or {}, []


def _tag_end(text: str, at: int) -> int:
    """Place of the > that ends a tag, quoted values aside; the text's end if there is none."""
    while True:
        close = text.find(">", at)
        if close < 0:
            return len(text)
        quotes = [q for q in (text.find('="', at, close), text.find("='", at, close)) if q >= 0]
        if not quotes:
            return close
        q = min(quotes)
        end = text.find(text[q + 1], q + 2)
        if end < 0:
            return close
        at = end + 1


def tokens(text: str) -> Iterator[tuple[str, str, dict]]:
    """(kind, name or text, attributes): kinds are text, open, close, and single for a tag that ends itself in svg or math."""
    at, n, foreign = 0, len(text), 0
    while at < n:
        lt = text.find("<", at)
        if lt < 0:
            yield "text", html.unescape(text[at:]), {}
            return
        if lt > at:
            yield "text", html.unescape(text[at:lt]), {}
        if text.startswith("<!--", lt):
            end = text.find("-->", lt + 4)
            at = n if end < 0 else end + 3
        elif text[lt + 1:lt + 2] in ("!", "?"):
            end = text.find(">", lt)
            at = n if end < 0 else end + 1
        elif m := _NAME.match(text, lt + 2 if text.startswith("</", lt) else lt + 1):
            end = _tag_end(text, m.end())
            name = m.group().lower()
            at = end + 1
            if text.startswith("</", lt):
                foreign -= name in FOREIGN and foreign > 0
                yield "close", name, {}
                continue
            attrs, bare = {}, False
            if end > m.end():
                for a in _ATTRIBUTE.finditer(text[m.end():end]):
                    value = a.group(2) or ""
                    bare = value[:1] not in "\"'" and a.end() == end - m.end()      # a slash at the end is the value's
                    attrs.setdefault(a.group(1).lower(), html.unescape(value[1:-1] if value[:1] in "\"'" and value else value))
            if (foreign or name in FOREIGN) and not bare and text[end - 1] == "/":
                yield "single", name, attrs
                continue
            foreign += name in FOREIGN
            yield "open", name, attrs
            if name in RAW:
                found = None if name == "plaintext" else _RAW_END[name].search(text, at)
                stop = found.start() if found else n
                yield "text", html.unescape(text[at:stop]) if name in ("textarea", "title") else text[at:stop], {}
                at = stop
        else:
            yield "text", "<", {}
            at = lt + 1


def tree(text: str) -> Node:
    """The page's elements under one root, with implied ends filled in; stray end tags are ignored."""
    root = Node("#root")
    stack = [root]
    opened: Counter = Counter()                                                     # open elements by name: spares walks up deep trees

    def cut(k: int) -> None:
        for x in stack[k:]:
            opened[x.tag] -= 1
        del stack[k:]

    def close(names: set | frozenset, stops: set | frozenset) -> None:
        """Ends the outermost open element of ``names`` above the nearest of ``stops``."""
        found, left = 0, sum(opened[x] for x in names)
        for k in range(len(stack) - 1, 0, -1):
            if not left or stack[k].tag in stops:
                break
            if stack[k].tag in names:
                found, left = k, left - 1
        if found:
            cut(found)

    def in_head() -> bool:
        return opened["head"] > 0 and (stack[-1].tag == "head" or stack[-1].tag == "noscript" and stack[-2].tag == "head")

    for kind, name, attrs in tokens(text):
        if kind == "text":
            if in_head() and _BLANK.sub("", name):
                close({"head"}, set())
            if name:
                stack[-1].kids.append(name)
        elif kind in ("open", "single"):
            if name not in HEAD and in_head():
                close({"head"}, set())
            if name in IMPLIED:
                close(*IMPLIED[name])
            if name in BLOCK and name != "option":
                close({"p"}, BARRIER)
                if stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6") and re.fullmatch("h[1-6]", name):
                    cut(len(stack) - 1)
            if any(opened[x] for x in FOREIGN):
                if name in FOREIGN_UNSEEN:
                    attrs.setdefault("hidden", "")
                elif name == "text":                                                # a place of its own in the drawing
                    stack[-1].kids.append(" ")
            node = Node(name, attrs)
            stack[-1].kids.append(node)
            if name not in VOID and kind == "open":
                stack.append(node)
                opened[name] += 1
        elif name == "br":
            stack[-1].kids.append(Node("br"))
        elif opened[name]:
            stops = {"table"} if name in ("tr", "td", "th", "thead", "tbody", "tfoot") else BARRIER - {name} if name not in ("html", "body", "table") else set()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == name:
                    cut(k)
                    break
                if stack[k].tag in stops:
                    break
    return root


def visible(node: Node) -> bool:
    return not (node.tag in UNSEEN or "hidden" in node.attrs or _HIDDEN.search(node.attrs.get("style", ""))
                or node.tag == "dialog" and "open" not in node.attrs or node.tag == "input" and node.attrs.get("type", "").lower() == "hidden")


def flat(node: Node) -> str:
    """Everything visible in a node on one line."""
    out, todo = [], [iter(node.kids)]
    while todo:
        kid = next(todo[-1], None)
        if kid is None:
            todo.pop()
            out.append(" " if todo else "")
        elif isinstance(kid, str):
            out.append(kid)
        elif kid.tag == "img":
            out.append(kid.attrs.get("alt", ""))
        elif visible(kid):
            if kid.tag in BLOCK or kid.tag == "br":
                out.append(" ")
                todo.append(iter(kid.kids))
            else:                                                                   # inline: no space of its own
                todo.append(iter([*kid.kids]))
                out.append("\0")
    text = "".join(out)
    return _BLANK.sub(" ", text.replace("\0", "")).strip()


def table_lines(node: Node) -> list[str]:
    """Rows of a table with their cells padded to columns; a caption comes first."""
    head, rows, todo = [], [], [iter(node.kids)]
    while todo:
        kid = next(todo[-1], None)
        if kid is None:
            todo.pop()
        elif isinstance(kid, str):
            if kid.strip():
                head.append(_BLANK.sub(" ", kid).strip())                           # text astray in a table is shown before it
        elif visible(kid):
            if kid.tag == "caption":
                head.append(flat(kid))
            elif kid.tag == "tr":
                row = []
                for cell in kid.kids:
                    if isinstance(cell, Node) and visible(cell):
                        row.append(flat(cell))
                        span = cell.attrs.get("colspan", "1").strip()
                        row += [""] * (min(int(span), 1000) - 1 if span.isascii() and span.isdigit() and len(span) < 6 else 0)
                    elif isinstance(cell, str) and cell.strip():
                        row.append(_BLANK.sub(" ", cell).strip())
                rows.append(row)
            elif kid.tag in ("td", "th"):
                rows.append([flat(kid)])
            else:
                todo.append(iter(kid.kids))
    widths = column_widths(rows)
    body = ["  ".join(c.ljust(widths[k]) for k, c in enumerate(row)).rstrip() for row in rows]
    return [x for x in head if x] + [x for x in body if x]


def column_widths(rows: list[list[str]]) -> list[int]:
    """Widths to which a table's columns are filled up: their longest cell, but so that all filling together stays within
    WIDE characters a cell and FILL times the text.  Longer cells stand out."""
    columns_: list[list[int]] = []
    for row in rows:
        for k, cell in enumerate(row):
            if k == len(columns_):
                columns_.append([0, 0])
            longest, total = columns_[k]
            columns_[k] = [max(longest, len(cell)), total + len(cell)]
    return [min(longest, WIDE + FILL * total // len(rows)) for longest, total in columns_]


class Page:
    """Lines of a page; a gap of 1 starts a new line, one of 2 leaves a blank line."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.lead = ""

    def text(self, s: str) -> None:
        s = _BLANK.sub(" ", s)
        if not self.line or self.line[-1].endswith(" "):
            s = s.lstrip(" ")
        if s:
            self.line.append(s)

    def end(self, gap: int) -> None:
        text = "".join(self.line).strip(" ")
        self.line = []
        if text:
            self.put(self.lead + text)
            self.lead = " " * len(self.lead)
        self.gap = max(self.gap, gap)

    def put(self, line: str) -> None:
        if self.lines and self.gap == 2:
            self.lines.append("")
        self.gap = 1
        self.lines.append(line)


def render(text: str | None) -> str:
    """All visible text of a page; null and empty pages give an empty text."""
    if not text:
        return ""
    page = Page()
    depth: list[list] = []                                                          # open lists: [ordered, number]
    todo = [(iter(tree(text).kids), None)]
    while todo:
        kids, owner = todo[-1]
        kid = next(kids, None)
        if kid is None:
            todo.pop()
            if owner is None:
                continue
            if owner.tag in BLOCK:
                page.end(2 if owner.tag in PARAGRAPH and not (owner.tag in LISTS and len(depth) > 1) else 1)
            if owner.tag in LISTS:
                depth.pop()
            if owner.tag in ("li", "dd") or owner.tag in LISTS:
                page.lead = "  " * len(depth) if depth else ""
        elif isinstance(kid, str):
            page.text(kid)
        elif not visible(kid):
            continue
        elif kid.tag == "br":
            page.end(1)
        elif kid.tag == "img":
            page.text(kid.attrs.get("alt", ""))
        elif kid.tag == "hr":
            page.end(2)
        elif kid.tag == "table":
            page.end(2)
            for line in table_lines(kid):
                page.put(page.lead + line)
                page.lead = " " * len(page.lead)
            page.gap = 2
        elif kid.tag in ("pre", "textarea"):
            page.end(2)
            raw = []
            inner = [iter(kid.kids)]
            while inner:
                x = next(inner[-1], None)
                if x is None:
                    inner.pop()
                elif isinstance(x, str):
                    raw.append(x)
                elif x.tag == "br":
                    raw.append("\n")
                elif visible(x):
                    inner.append(iter(x.kids))
            for line in "".join(raw).strip("\n").replace("\r\n", "\n").split("\n"):
                page.put(line.rstrip())
            page.gap = 2
        else:
            if kid.tag in BLOCK:
                nested = kid.tag in LISTS and depth
                page.end(2 if kid.tag in PARAGRAPH and not nested else 1)
            if kid.tag in LISTS:
                start = kid.attrs.get("start", "1")
                depth.append([kid.tag == "ol", int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
            elif kid.tag == "li":
                indent = "  " * max(0, len(depth) - 1)
                if depth and depth[-1][0]:
                    page.lead = f"{indent}{depth[-1][1]}. "
                    depth[-1][1] += 1
                else:
                    page.lead = f"{indent}- "
            elif kid.tag == "dd":
                page.lead = "  " * (len(depth) + 1)
            todo.append((iter(kid.kids), kid))
    page.end(0)
    return "\n".join(page.lines)


def extract(pages: DataFrame) -> DataFrame:
    """(id, html) to (id, text): every page rendered whole; null pages give an empty text, null ids stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([render(x) for x in b.column(1).to_pylist()], pa.string())], ["id", "text"])

    return pages.select("id", "html").mapInArrow(run, "id bigint, text string")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page: page_id, n_chars, text.  Repeated pages come back each; an empty table gives no rows."""
    pages = columns(table(spark, sf_dir, "pages", "page_id", "html"), id="page_id", html="html")
    return extract(pages).select(F.col("id").alias("page_id"), F.length("text").cast("long").alias("n_chars"), "text")
