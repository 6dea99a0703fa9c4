"""Visible text of web pages, laid out: a tree with implied tags, then blocks, lists and tables.

Tags are read into a tree as browsers read them: paragraphs, list items, cells and options end
where the next one begins, an end tag closes what is open inside its element, and an end tag
without its element is passed over. What a page hides is left out. Blocks stand on lines of their own,
paragraphs and headings between empty lines, list items behind their marks, and the cells of a table
in columns as wide as their widest cell.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayframe.llm.tables import columns_ddl, read

#: Fixed values of HTML: elements by how they are read and shown.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = set("head script style template title noscript iframe noembed noframes object audio video canvas datalist "
             "source track".split())
#: Fixed values of SVG and MathML: what they hold without showing it where it stands.
UNSEEN_IN = {"svg": set("title desc metadata defs symbol clippath mask marker pattern lineargradient radialgradient "
                        "filter".split()),
             "math": {"annotation", "annotation-xml", "mphantom"}}
#: These and what holds HTML inside them; a piece of text in a drawing is a block of its own.
FOREIGN = {*UNSEEN_IN, "foreignobject"}
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure menu".split())
BLOCKS = SPACED | set("html body div section article aside header footer nav main address form fieldset legend details "
                      "summary dialog hgroup search figcaption li dt dd tr caption thead tbody tfoot td th option "
                      "optgroup select center hr".split())
#: Fixed values of HTML: what a start tag ends, up to the element that bounds the search.
CLOSES_P = SPACED | set("div section article aside header footer nav main address form fieldset details summary dialog "
                        "hgroup search figcaption li dt dd center hr".split())
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
        "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}),
        "optgroup": ({"option", "optgroup"}, {"select"})} | {
        x: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}) for x in ("thead", "tbody", "tfoot")} | {
        x: ({"h1", "h2", "h3", "h4", "h5", "h6"}, BLOCKS - {"h1", "h2", "h3", "h4", "h5", "h6"})
        for x in ("h1", "h2", "h3", "h4", "h5", "h6")}
#: An end tag does not reach out of these.
BOUNDS = {"table", "td", "th", "caption", "template"}
END_BOUNDS = {"table": {"template"}} | {x: {"table", "template"} for x in "td th caption tr thead tbody tfoot".split()}

_TOKEN = re.compile(r"""<!--(?:>|->)?.*?(?:--!?>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"""
                    r"""(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>|<[!?/][^>]*>""", re.S)
_ATTR = re.compile(r"""([^ \t\n\r\f/>=][^ \t\n\r\f/>=]*)(?:[ \t\n\r\f]*=[ \t\n\r\f]*(?:"([^"]*)"|'([^']*)'|([^ \t\n\r\f>]+)))?""")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_DECLARATION = re.compile(r"""(?:[^;"'(]++|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|\([^)]*+(?:\)|\Z))++""")
_SPAN = re.compile(r"\s*(\d{1,3})")
_START = re.compile(r"\s*(-?\d{1,9})")
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def attributes(written: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a name counts, one without value is empty."""
    out: dict[str, str] = {}
    for name, *values in _ATTR.findall(written):
        out.setdefault(name.lower(), html.unescape("".join(values)))
    return out


def hides(tag: str, attrs: dict[str, str]) -> bool:
    """Whether an element's own attributes hide it with all in it."""
    if "hidden" in attrs or (tag == "input" and attrs.get("type", "").strip().lower() == "hidden"):
        return True
    if "style" not in attrs:
        return False
    # The last declaration of a property counts, an important one before others.
    found: dict[str, tuple[bool, str]] = {}
    for declaration in _DECLARATION.findall(_COMMENT.sub(" ", attrs["style"])):
        name, _, value = declaration.partition(":")
        name, (value, mark, rest) = name.strip().lower(), value.strip().lower().partition("!")
        strong = bool(mark) and rest.strip() == "important"
        if value.strip() and (strong or not found.get(name, (False, ""))[0]):
            found[name] = strong, value.strip()
    return (found.get("display", (False, ""))[1] == "none"
            or found.get("visibility", (False, ""))[1] in ("hidden", "collapse"))


def tree(page: str) -> Node:
    """The element tree of a page; strings are text."""
    root = Node("html")
    whole: dict[str, dict[str, str]] = {"html": {}, "body": {}}
    stack, at = [root], 0
    n_open: Counter[str] = Counter()

    def cut(tags: set[str], bounds: set[str], every: bool = False) -> None:
        """Closes the innermost open element of ``tags`` inside ``bounds`` with all in it, or all such."""
        while any(n_open[tag] for tag in tags):
            i = len(stack) - 1
            while i and stack[i].tag not in tags and stack[i].tag not in bounds:
                i -= 1
            if not i or stack[i].tag not in tags:
                return
            n_open.subtract(node.tag for node in stack[i:])
            del stack[i:]
            if not every:
                return

    while at < len(page):
        m = _TOKEN.search(page, at)
        text = page[at : m.start() if m else len(page)]
        if text:
            stack[-1].children.append(html.unescape(text))
        if not m:
            break
        at, tag = m.end(), (m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            if tag == "br":
                stack[-1].children.append(Node("br"))
            cut({tag}, END_BOUNDS.get(tag, BOUNDS))
            continue
        if tag in ("html", "body"):
            cut({"head"}, set())
            whole[tag] = attributes(m["attrs"]) | whole[tag]
            continue
        if tag in CLOSES_P:
            cut({"p"}, BOUNDS | {"button", "object"})
        if tag in ENDS:
            cut(*ENDS[tag], every=True)
        if len(stack) > 1 and stack[-1].tag == "head" and tag not in RAW | VOID | {"noscript", "template", "head"}:
            cut({"head"}, set())
        node = Node(tag, attributes(m["attrs"]))
        stack[-1].children.append(node)
        if m["attrs"].endswith("/") and (tag in UNSEEN_IN or any(n_open[x] for x in UNSEEN_IN)):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            raw = page[at : end.start() if end else len(page)]
            node.children.append(html.unescape(raw) if tag in ("textarea", "title") else raw)
            at = end.end() if end else len(page)
        elif tag not in VOID:
            stack.append(node)
            n_open[tag] += 1
    root.attrs = next((attrs for attrs in whole.values() if hides("html", attrs)), {})
    return root


class Lines:
    """Text laid out in lines. Runs of blanks are one; ``gap`` empty lines come before the next text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.indent: list[str] = []
        self.mark = ""
        self.gap, self.blank = 0, False

    def text(self, text: str, keep: bool) -> None:
        if keep:
            first, *rest = text.split("\n")
            self.parts.append(first)
            for line in rest:
                self.end_line(True)
                self.parts.append(line)
            return
        text = _BLANK.sub(" ", text)
        body = text.strip(" ")
        if not body:
            self.blank |= bool(text)
            return
        if self.parts and (self.blank or text[0] == " "):
            self.parts.append(" ")
        self.parts.append(body)
        self.blank = text[-1] == " "

    def end_line(self, even_empty: bool = False) -> None:
        if self.parts or even_empty:
            if self.lines:
                self.lines += [""] * self.gap
            # A mark takes the place of the last step of its own indent.
            lead = "".join(self.indent)
            if self.mark:
                lead = lead[: len(lead) - len(self.mark)] + self.mark
            self.lines.append((lead + "".join(self.parts).replace("\xa0", " ")).rstrip())
            self.mark, self.gap = "", 0
        self.parts, self.blank = [], False

    def break_block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


def _table(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Rows of (lines of a cell, columns it spans) in aligned columns, two blanks apart."""
    n = max((sum(span for _, span in row) for row in rows), default=0)
    widths = [0] * n
    for row in rows:
        at = 0
        for lines, span in row:
            if span == 1:
                widths[at] = max(widths[at], *(len(x) for x in lines), 0)
            at += span
    out = []
    for row in rows:
        for k in range(max((len(lines) for lines, _ in row), default=0)):
            line, at = [], 0
            for lines, span in row:
                width = sum(widths[at : at + span]) + 2 * (span - 1)
                line.append((lines[k] if k < len(lines) else "").ljust(width))
                at += span
            out.append("  ".join(line).rstrip())
    return out


def render(page: str) -> str:
    """The visible text of a page."""
    out = Lines()
    outer: list[Lines] = []
    tables: list[list] = []
    lists: list[list] = []
    foreign: list[str] = []
    pre = 0
    todo: list[tuple[Node | str, bool]] = [(tree(page), False)]
    while todo:
        node, leaving = todo.pop()
        if isinstance(node, str):
            out.text(node, pre > 0)
            continue
        tag = node.tag
        cell = tag in ("td", "th") and bool(tables)
        if not leaving:
            if tag in UNSEEN or (node.attrs and hides(tag, node.attrs)) or (
                    tag == "dialog" and "open" not in node.attrs) or (foreign and tag in UNSEEN_IN.get(foreign[-1], ())):
                continue
            if tag in FOREIGN:
                foreign.append(tag)
            if tag == "br":
                out.end_line(True)
                continue
            if cell:
                if not tables[-1]:
                    tables[-1].append([])
                outer.append(out)
                out = Lines()
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in BLOCKS or (tag == "text" and foreign):
                nested = tag in ("ul", "ol", "menu") and bool(lists)
                out.break_block(1 if tag in SPACED and not nested else 0)
            if tag == "table":
                tables.append([])
            elif tag in ("ul", "ol", "menu"):
                start = _START.match(node.attrs.get("start", ""))
                lists.append([tag == "ol", int(start[1]) if start else 1])
            elif tag == "li":
                mark = "- "
                if lists and lists[-1][0]:
                    mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                out.indent.append(" " * len(mark))
                out.mark = mark
            elif tag in ("blockquote", "dd"):
                out.indent.append("  ")
            pre += tag in ("pre", "textarea")
            todo.append((node, True))
            todo += [(child, False) for child in reversed(node.children)]
            continue
        if tag in FOREIGN:
            foreign.pop()
        pre -= tag in ("pre", "textarea")
        if cell:
            lines, out = out.done(), outer.pop()
            span = _SPAN.match(node.attrs.get("colspan", ""))
            tables[-1][-1].append((lines, max(1, int(span[1])) if span else 1))
            continue
        if tag == "table":
            for line in _table(tables.pop()):
                out.end_line()
                out.parts = [line]
        if (tag in BLOCKS and not (tag == "tr" and tables)) or (tag == "text" and foreign):
            nested = tag in ("ul", "ol", "menu") and len(lists) > 1
            out.break_block(1 if tag in SPACED and not nested else 0)
        if tag in ("ul", "ol", "menu"):
            lists.pop()
        elif tag == "li":
            out.mark = ""
            out.indent.pop()
        elif tag in ("blockquote", "dd"):
            out.indent.pop()
    return "\n".join(out.done())


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [None if page is None else render(page) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "visible"])


def visible_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``visible``, the laid-out text of ``html``; a column of that name is replaced.

    Null html gives null, a page without visible text an empty string. Every page is read by
    itself, whole; no row moves.
    """
    rows = pages.drop("visible")
    return rows.mapInArrow(_render, f"{columns_ddl(rows)}, visible string")


def op6_layout_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The laid-out text of every page."""
    pages = visible_text(read(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", F.col("visible").alias("text"), F.length("visible").cast("long").alias("n_chars"))
