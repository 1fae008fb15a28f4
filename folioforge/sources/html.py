"""HTML leaflets to flat nodes.

A Python table function reads a page with the standard library's lenient parser and walks
its classed elements in document order once, for titles, bullet runs and table membership;
nodes leave it in small batches and nothing is shuffled. Tables come out as rows of cells.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html import escape
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions.text import normal_py, rewrite_images, sub_py, sup_py
from folioforge.sources.jsonl import rows_of

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: What a page's elements may come to, in times its own size.
MOST = 64
LEVEL1 = ("AmmAnnexeTitre1", "AmmNoticeTitre1")
LEVEL2 = "AmmAnnexeTitre2"
BULLETS = tuple(f"AmmListePuces{i}" for i in (1, 2, 3))
TABLE, BODY, BOLD = "AmmCorpsTexteTable", "AmmCorpsTexte", "AmmCorpsTexteGras"


class Element:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None) -> None:
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def walk(self) -> Iterator[Element]:
        """The elements below, in document order; pages may nest deeper than Python recurses."""
        todo = [iter(self.children)]
        while todo:
            for c in todo[-1]:
                if isinstance(c, Element):
                    yield c
                    todo.append(iter(c.children))
                    break
            else:
                todo.pop()

    def _fold(self, leaf: Callable[[str], str], close: Callable[[Element, str], str]) -> str:
        """Strings from the leaves up: close(element, what its children gave)."""
        todo: list[tuple[Element, Iterator, list[str]]] = [(self, iter(self.children), [])]
        while True:
            e, kids, parts = todo[-1]
            for c in kids:
                if isinstance(c, Element):
                    todo.append((c, iter(c.children), []))
                    break
                parts.append(leaf(c))
            else:
                todo.pop()
                done = close(e, "".join(parts))
                if not todo:
                    return done
                todo[-1][2].append(done)

    def text(self) -> str:
        """Text below, sup and sub as Unicode characters; comments, scripts and styles have none."""
        kinds = {"sup": sup_py, "sub": sub_py, "script": lambda _: "", "style": lambda _: ""}
        return self._fold(str, lambda e, inner: kinds[e.tag](inner) if e.tag in kinds else inner)

    def html(self) -> str:
        def close(e: Element, inner: str) -> str:
            attrs = "".join(f' {k}="{escape(v or "", quote=True)}"' for k, v in e.attrs.items())
            return f"<{e.tag}{attrs}/>" if e.tag in _VOID else f"<{e.tag}{attrs}>{inner}</{e.tag}>"

        return self._fold(lambda t: escape(t, quote=False), close)

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def inside(self, tag: str) -> bool:
        p = self.parent
        while p is not None:
            if p.tag == tag:
                return True
            p = p.parent
        return False

    def styles(self) -> list[str]:
        found = set()
        for e in self.walk():
            if e.tag in ("span", "b", "strong", "u", "em"):
                found |= {{"gras": "bold", "souligne": "underline"}[c] for c in e.classes() if c in ("gras", "souligne")}
                found |= {{"b": "bold", "strong": "bold", "u": "underline", "em": "italic"}[e.tag]} if e.tag != "span" else set()
        return sorted(found)

    def anchor(self) -> str | None:
        first = next((e for e in self.walk() if e.tag == "a"), None)
        return (first.attrs.get("name") or None) if first else None


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(e)
        if tag not in _VOID:
            self.at = e

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        p = self.at
        while p.parent is not None and p.tag != tag:
            p = p.parent
        if p.parent is not None:
            self.at = p.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def _cells(table: Element) -> list[dict]:
    """Cells of the first thead, the first tbody (or loose rows) and the first tfoot, in that order."""
    parts = {k: next((e for e in table.walk() if e.tag == k), None) for k in ("thead", "tbody", "tfoot")}
    groups = [(k, parts[k]) for k in ("thead", "tbody", "tfoot") if parts[k]]
    if not parts["tbody"]:
        groups.insert(1 if parts["thead"] else 0, ("", table))
    out = []
    for part, group in groups:
        trs = [c for c in group.children if isinstance(c, Element) and c.tag == "tr"]
        for r, tr in enumerate(trs):
            for c, cell in enumerate(e for e in tr.walk() if e.tag in ("td", "th")):
                text = cell.text()
                kids = []
                for k in cell.children:
                    if isinstance(k, Element) and k.tag in ("p", "div", "span") and ((own := k.text()) != text or k.styles()):
                        kids.append({"tag": k.tag, "text": own, "styles": k.styles(), "html": k.html()})
                out.append({"part": part, "row": r, "col": c, "tag": cell.tag, "attributes": list(cell.attrs.items()), "text": text, "html": cell.html(), "children": kids})
    return out


_KID = "struct<tag:string,text:string,styles:array<string>,html:string>"
_CELL = f"struct<part:string,`row`:int,col:int,tag:string,attributes:map<string,string>,text:string,html:string,children:array<{_KID}>>"
ELEMENTS = f"array<struct<pos:int,class:string,tag:string,text:string,html:string,anchor:string,styles:array<string>,in_table:boolean,cells:array<{_CELL}>>>"


def elements(html: str | None, most: int = MOST) -> list[tuple]:
    """Classed elements in document order; those inside a structured table are part of the table's cells.

    Each element holds all text below it, so nested ones repeat it: a page whose elements
    come to more than `most` times its own size, and 64 MB, is refused.
    """
    out, taken = [], set()
    left = max(most * len(html or ""), 1 << 26)
    for e in parse(html).walk():
        names = e.classes()
        if not names or id(e) in taken:
            continue
        structured = names[0] == TABLE and e.tag == "table"
        if structured:
            taken |= {id(x) for x in e.walk()}
        out.append((len(out), names[0], e.tag, e.text(), e.html(), e.anchor(), e.styles(), e.inside("table"), _cells(e) if structured else []))
        left -= len(out[-1][4])
        if left < 0:
            raise ValueError("elements are nested too deeply")
    return out


_FIELDS = ("pos", "class", "tag", "text", "html", "anchor", "styles", "in_table", "cells")


def _tried(page: str | None) -> tuple[list[tuple] | None, str | None]:
    """The elements of a page, or why it is refused."""
    try:
        return elements(page), None
    except (ValueError, AssertionError, MemoryError) as e:
        return None, f"{type(e).__name__}: {e}"


def _keyed(pages: DataFrame, key: str, what: str, run: Callable, schema: str) -> DataFrame:
    return rows_of(pages.select(key, what), run, f"`{key}` {pages.schema[key].dataType.simpleString()}, {schema}")


def parsed_pages(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key, elements (null: refused) and error: a page that can't be parsed doesn't stop the others."""

    def run(k, page: str | None) -> list[tuple]:
        found, error = _tried(page)
        return [(k, found and [dict(zip(_FIELDS, e)) for e in found], error)]

    return _keyed(pages, key, html, run, f"elements {ELEMENTS}, error string")


def html_rejects(parsed: DataFrame) -> DataFrame:
    """The key and error of the pages that were refused."""
    return parsed.filter("error is not null").drop("elements")


_NODE = f"node_pos int, t1_pos int, t2_pos int, type string, content array<string>, html string, anchor string, styles array<string>, cells array<{_CELL}>"


def _nodes(found: list[tuple]) -> Iterator[tuple]:
    """The nodes of a page's elements, which are in document order."""
    t1 = t2 = before = run = None  # run: a bullets' position, titles and texts

    def listed() -> Iterator[tuple]:
        if run and run[3]:
            yield (*run[:3], "listePuce", run[3], None, None, [], [])

    for pos, kind, _, text, html, anchor, styles, in_table, cells in found:
        is1, is2, bullet = kind in LEVEL1, kind == LEVEL2, kind in BULLETS
        if is1:
            t1, t2 = pos, None
        if is2:
            if t1 is None:
                continue
            t2 = pos
        text = normal_py(text)
        if not (bullet and kind == before):
            yield from listed()
            run = (pos, t1, t2, []) if bullet else None
        before = kind
        if bullet:
            run[3].extend([] if in_table or not text else [text])
        elif not in_table or is1 or is2 or kind == TABLE:
            yield pos, t1, t2, "table" if cells else kind, [text], html, anchor, sorted({*styles, "bold"}) if kind == BOLD else styles, cells
    yield from listed()


def html_nodes(pages: DataFrame, key: str, html: str = "html", cdn: str | None = None) -> DataFrame:
    """Flat nodes: key, node_pos, t1_pos, t2_pos, type, content (array), html, anchor, styles, cells.

    t1_pos, t2_pos: the level-1 and level-2 title that a node lies under (null: none); a
    title's own row has its own position there. A level-2 title before any level-1 one is
    dropped. Consecutive bullets of a class are one listePuce node. Pages that are refused
    have no nodes; pages may be what parsed_pages() returned.
    """
    if "elements" in pages.columns:
        nodes = _keyed(pages, key, "elements", lambda k, found: ((k, *n) for n in _nodes([tuple(e[f] for f in _FIELDS) for e in found or []])), _NODE)
    else:
        nodes = _keyed(pages, key, html, lambda k, page: ((k, *n) for n in _nodes(_tried(page)[0] or [])), _NODE)
    return nodes.withColumn("html", rewrite_images(F.col("html"), cdn) if cdn else rewrite_images(F.col("html")))


def nodes_schema(key: str = "doc") -> T.StructType:
    return T._parse_datatype_string(f"{key} string, node_pos int, t1_pos int, t2_pos int, type string, content array<string>, html string, anchor string, styles array<string>, cells array<{_CELL}>")


def paragraphs(html: Column) -> Column:
    return F.size(F.regexp_extract_all(html, F.lit(r"<p[\s>]"), F.lit(0)))
