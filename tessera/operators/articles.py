"""Articles from HTML or XML pages: title, abstract, sections, tables, figures.

A page becomes a tree in one pass of the standard library's parser, which mends less than browsers do: an open <p>, <li>,
<tr>, <td> or <th> is closed by the next one, and what is still open at the end is closed there. Rules are then walks in
document order. Pages are independent rows, so the operator is one mapInPandas without a shuffle.
"""

from __future__ import annotations

import html.parser
import re
from collections.abc import Callable, Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import SECTIONS, strip

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_MUTE = {"script", "style", "template"}
_CLOSED_BY = {"p": {"p", "div", "section", "article", "h1", "h2", "h3", "h4", "table", "ul", "ol", "figure", "header", "footer"}, "li": {"li"}, "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr", "tbody"}, "th": {"td", "th", "tr", "tbody"}, "thead": {"tbody"}}

# fixed values: where publishers put titles, abstracts and bodies: tag, attribute, value, in order
TITLES = [
    ("h1", "class", "wi-article-title"),
    ("h1", "class", "article-title-main"),
    ("h1", "class", "at-articleTitle"),
    ("span", "class", "title-text"),
    ("h1", "class", "c-article-title"),
    ("h1", "class", "citation__title"),
    ("span", "class", "article-header__title"),
    ("h1", "class", "title"),
    ("h1", None, None),
]
TITLE_METAS = ["citation_title", "og:title", "DC.title"]
ABSTRACTS = [
    ("section", "class", "abstract"),
    ("div", "class", "abstract"),
    ("div", "id", "abstracts"),
    ("div", "class", "art-abstract"),
    ("div", "class", "article-section__abstract"),
    ("section", "class", "article-section--abstract"),
    ("section", "id", "abstract"),
    ("div", "id", "abstract"),
    ("p", "class", "abstract"),
    ("p", "class", "chapter-para"),
]
BODIES = [("div", "class", "article-body"), ("div", "id", "body"), ("article", None, None), ("div", "class", "c-article-body"), ("main", None, None)]
TABLE_CAPTIONS = ["table-caption", "c-article-table-caption", "article-table-caption"]
NO_FIGURES = ("abstract", "graphical-abstract", "toc")


def clean(text: str) -> str:
    return re.sub(r"\[\d+\]", "", re.sub(r"\s+", " ", text).strip())


class Node:
    __slots__ = ("attrs", "kids", "order", "tag", "up")

    def __init__(self, tag: str, attrs: dict, up: Node | None, order: int):
        self.tag, self.attrs, self.up, self.order, self.kids = tag, attrs, up, order, []

    def walk(self) -> Iterator[Node]:
        """The nodes below, in document order."""
        todo = [k for k in reversed(self.kids) if isinstance(k, Node)]
        while todo:
            node = todo.pop()
            yield node
            todo += [k for k in reversed(node.kids) if isinstance(k, Node)]

    def text(self) -> str:
        out, todo = [], [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                out.append(node)
            elif node.tag not in _MUTE or node is self:
                todo += reversed(node.kids)
        return "".join(out)

    def all(self, *tags: str, where: Callable[[Node], bool] = lambda n: True) -> list[Node]:
        return [n for n in self.walk() if (not tags or n.tag in tags) and where(n)]

    def first(self, *tags: str, where: Callable[[Node], bool] = lambda n: True) -> Node | None:
        return next((n for n in self.walk() if (not tags or n.tag in tags) and where(n)), None)

    def above(self) -> Iterator[Node]:
        node = self.up
        while node:
            yield node
            node = node.up

    def has(self, attr: str | None, value: str | None) -> bool:
        if attr is None:
            return True
        own = self.attrs.get(attr) or ""
        return value == own or attr == "class" and value in own.split()


class _Tree(html.parser.HTMLParser):
    """xml: no tag is void or closed by another, and marked sections are text."""

    def __init__(self, xml: bool = False):
        super().__init__(convert_charrefs=True)
        self.void, self.closed_by = (set(), {}) if xml else (_VOID, _CLOSED_BY)
        if xml:
            self.CDATA_CONTENT_ELEMENTS = self.RCDATA_CONTENT_ELEMENTS = ()
        self.root = self.at = Node("", {}, None, 0)
        self.nodes = [self.root]

    def handle_starttag(self, tag, attrs):
        while tag in self.closed_by.get(self.at.tag, ()):
            self.at = self.at.up
        node = Node(tag, {k: v if v is not None else "" for k, v in attrs}, self.at, len(self.nodes))
        self.at.kids.append(node)
        self.nodes.append(node)
        if tag not in self.void:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in self.void:
            self.at = self.at.up

    def handle_endtag(self, tag):
        for node in (self.at, *self.at.above()):
            if node.tag == tag and node.up:
                self.at = node.up
                return

    def handle_data(self, data):
        self.at.kids.append(data)

    def unknown_decl(self, data):
        if self.closed_by is not _CLOSED_BY and data.startswith("CDATA["):
            self.at.kids.append(data[len("CDATA[") :])


class Page:
    """A parsed page, and what comes before a node in it."""

    def __init__(self, text: str, xml: bool = False):
        tree = _Tree(xml)
        tree.feed(text)
        tree.close()
        self.root, self.nodes = tree.root, tree.nodes

    def before(self, node: Node, tags: tuple[str, ...], where: Callable[[Node], bool] = lambda n: True) -> Node | None:
        return next((n for n in reversed(self.nodes[1 : node.order]) if n.tag in tags and where(n)), None)


def _cascade(root: Node, rules) -> str:
    for tag, attr, value in rules:
        node = root.first(tag, where=lambda n: n.has(attr, value))
        if node and (text := clean(node.text())):
            return text
    return ""


def page_title(page: Page) -> str:
    if found := _cascade(page.root, TITLES):
        return found
    for name in TITLE_METAS:
        meta = page.root.first("meta", where=lambda n: n.attrs.get("name") == name) or page.root.first("meta", where=lambda n: n.attrs.get("property") == name)
        if meta and meta.attrs.get("content"):
            return meta.attrs["content"].strip()
    return ""


def page_abstract(page: Page) -> str:
    if found := _cascade(page.root, ABSTRACTS):
        return found
    node = page.root.first("div", where=lambda n: "abstract" in (n.attrs.get("id") or "").lower())
    return clean(node.text()) if node else ""


def section_key(name: str) -> str:
    bare = re.sub(r"^\d+\.?\s*", "", name.lower().strip())
    return next((k for k, words in SECTIONS.items() if any(w in bare for w in words)), name)


def _joined(parts: list[tuple[str, str]], join: bool) -> dict[str, str]:
    """Sections by key in the order of first mention; repeated ones are joined, or the last stays."""
    out: dict[str, str] = {}
    for key, text in parts:
        out[key] = f"{out[key]} {text}" if join and key in out else text
    return out


def _without(node: Node, heading: Node) -> str:
    return clean(node.text().replace(heading.text(), "", 1))


def page_sections(page: Page) -> dict[str, str]:
    """Containers with headings; else publishers' containers; else what follows each h2. The first that finds any."""
    heads = ("h2", "h3", "h4")
    name = lambda h: section_key(clean(h.text()).lower())
    found = []
    for box in page.root.all("section") or page.root.all("div", where=lambda n: n.has("class", "section")):
        if head := box.first(*heads):
            paras = box.all("p")
            text = " ".join(clean(p.text()) for p in paras) if paras else _without(box, head)
            if len(text) > 20:
                found.append((name(head), text))
    if found:
        return _joined(found, True)
    for tag, cls, join in (("div", "section-paragraph", True), ("section", "article-section__content", False)):
        for box in page.root.all(tag, where=lambda n: n.has("class", cls)):
            head = page.before(box, ("h2", "h3"))
            if head and (text := clean(box.text())):
                found.append((name(head), text))
        if found:
            return _joined(found, join)
    body = page.root.first("div", where=lambda n: n.has("class", "article-body"))
    for box in [k for k in body.kids if isinstance(k, Node) and k.tag in ("section", "div")] if body else []:
        head = box.first(*heads)
        if head and len(text := _without(box, head)) > 20:
            found.append((name(head), text))
    if found:
        return _joined(found, False)
    for head in page.root.all("h2"):
        texts = []
        for kid in head.up.kids[head.up.kids.index(head) + 1 :]:
            if isinstance(kid, Node):
                if kid.tag in ("h1", "h2"):
                    break
                texts.append(clean(kid.text()))
        if any(texts):
            found.append((name(head), " ".join(t for t in texts if t)))
    return _joined(found, False)


def xml_sections(page: Page) -> dict[str, str]:
    for box, head, para in (("ce:section", "ce:section-title", "ce:para"), ("sec", "title", "p")):
        parts = [(clean(h.text()).lower(), " ".join(clean(p.text()) for p in s.all(para))) for s in page.root.all(box) if (h := s.first(head))]
        if found := _joined([x for x in parts if x[1]], False):
            return found
    return {}


#: HTML's own bounds of spans.
SPANS = {"colspan": 1000, "rowspan": 65534}


def _span(cell: Node, name: str) -> int:
    try:
        return min(int(cell.attrs.get(name) or 1), SPANS[name])
    except ValueError:
        return 1


def table_grid(table: Node) -> tuple[list[str], list[list[str]]]:
    """Header cells and data rows, with spans filled in; the header is the last of the rows that head the table, or the first row.

    A span that is no whole number counts as 1, a larger one than HTML allows as the largest.
    """
    grid, heads, held = [], 0, {}  # held: column -> (value, last row it reaches)
    for y, tr in enumerate(table.all("tr")):
        cells, row = tr.all("td", "th"), []

        def fill(row=row, y=y):
            while held.get(len(row), ("", -1))[1] >= y:
                row.append(held[len(row)][0])

        for cell in cells:
            fill()
            value, down = clean(cell.text()), _span(cell, "rowspan")
            for _ in range(_span(cell, "colspan")):
                fill()
                held[len(row)] = (value, y + down - 1) if down > 1 else ("", -1)
                row.append(value)
        fill()
        grid.append(row)
        if any(n.tag == "thead" for n in tr.above()) or cells and heads == y and all(c.tag == "th" for c in cells):
            heads = y + 1
    if not grid:
        return [], []
    return grid[max(heads - 1, 0)], grid[max(heads, 1) :]


def as_maps(headers: list[str], rows: list[list[str]]) -> list[dict[str, str]]:
    """Rows by header; of equal headers the last counts, and cells beyond the headers are col_<number>."""
    return [{headers[i] if i < len(headers) else f"col_{i}": v for i, v in enumerate(row)} for row in rows]


def _table_caption(page: Page, table: Node, number: int) -> str:
    if cap := table.first("caption"):
        return clean(cap.text())
    box = next((n for n in table.above() if n.tag in ("div", "figure") and "table" in (n.attrs.get("class") or "")), None)
    cap = box.first(where=lambda n: "caption" in (n.attrs.get("class") or "")) if box else None
    for cls in [] if cap else TABLE_CAPTIONS:
        cap = page.before(table, ("div",), lambda n: n.has("class", cls)) or page.before(table, ("header",), lambda n: n.has("class", cls))
        if cap:
            break
    if cap:
        return clean(cap.text())
    for node in reversed(page.nodes[: table.order]):
        for kid in reversed(node.kids):
            if isinstance(kid, str) and f"table {number}" in kid.lower() and node.tag not in _MUTE and (text := clean(kid)):
                return text
    return f"Table {number}"


def page_tables(page: Page, xml: bool = False) -> list[tuple]:
    """(table_id, caption, headers, rows) of the tables with headers, the first of those that agree in their first rows."""
    if xml:
        boxes = page.root.all("ce:table") or page.root.all("table-wrap")
        out = []
        for i, box in enumerate(boxes, 1):
            cap, inner = box.first("ce:caption") or box.first("caption") or box.first("label"), box.first("table")
            headers, rows = table_grid(inner) if inner else ([], [])
            if headers:
                out.append((f"table_{i}", clean(cap.text()) if cap else f"Table {i}", headers, as_maps(headers, rows)))
        return out
    root = next((n for tag, attr, value in BODIES if (n := page.root.first(tag, where=lambda n, a=attr, v=value: n.has(a, v)))), page.root)
    out, seen = [], set()
    for table in root.all("table"):
        headers, rows = table_grid(table)
        maps = as_maps(headers, rows)
        mark = (tuple(headers), tuple(tuple(r.get(h, "") for h in headers) for r in maps[:3]))
        if headers and mark not in seen:
            seen.add(mark)
            out.append((f"table_{len(out) + 1}", _table_caption(page, table, len(out) + 1), headers, maps))
    return out


def figure_key(url: str) -> str:
    name = url.rsplit("/", 1)[-1]
    name = re.sub(r"[-_]\d{3,4}$", "", name.rsplit(".", 1)[0])
    return re.sub(r"(?i)[-_](small|large|thumb|preview|hi-res|hires)$", "", name).lower()


def page_figures(page: Page, base: str = "") -> list[tuple]:
    """(figure_id, caption, url, text before) of the pictures in figures; of one picture in several sizes the large one."""
    absolute = lambda u: urljoin(base, u) if base and not u.startswith("http") else u
    source = lambda img: img.attrs.get("src") or img.attrs.get("data-src") or ""
    boxes = page.root.all("figure")
    for div in page.root.all("div", where=lambda n: "fig" in (n.attrs.get("class") or "").lower()):
        cls = div.attrs["class"].lower()
        if not any(x in cls for x in NO_FIGURES) and not any(n in boxes for n in div.above()):
            boxes.append(div)
    out, urls, keys = [], set(), {}
    for box in boxes:
        img = box.first("img")
        url = source(img) if img else ""
        if not url or url in urls:
            continue
        key = figure_key(url)
        if key in keys:
            old = out[keys[key]]
            if "-550" not in url and "-550" in old[2]:
                out[keys[key]] = (old[0], old[1], absolute(url), old[3])
                urls.add(url)
            continue
        urls.add(url)
        cap = box.first("figcaption") or box.first(where=lambda n: any(x in (n.attrs.get("class") or "").lower() for x in ("caption", "description")))
        caption = (clean(cap.text()) if cap else "") or img.attrs.get("alt") or f"Figure {len(out) + 1}"
        para = page.before(box, ("p",))
        if key:
            keys[key] = len(out)
        out.append((f"figure_{len(out) + 1}", caption, absolute(url), clean(para.text())[:500] if para else ""))
    if not out:
        for img in page.root.all("img"):
            url, width = source(img), img.attrs.get("width") or "999"
            if url and url not in urls and not (re.fullmatch(r"\s*[+-]?\d+\s*", width) and int(width) < 100):
                urls.add(url)
                out.append((f"figure_{len(out) + 1}", img.attrs.get("alt", f"Figure {len(out) + 1}"), absolute(url), ""))
    return out


def xml_figures(page: Page) -> list[tuple]:
    """(figure_id, caption, url, "") of the figures of an XML article, those without a picture too."""
    out = []
    for i, box in enumerate(page.root.all("ce:figure") or page.root.all("fig"), 1):
        cap = box.first("ce:caption") or box.first("caption") or box.first("label")
        picture = box.first("ce:e-component") or box.first("graphic") or box.first("img")
        url = next((u for a in ("xlink:href", "src", "id") if (u := picture.attrs.get(a))), "") if picture else ""
        out.append((f"figure_{i}", clean(cap.text()) if cap else f"Figure {i}", url, ""))
    return out


def is_xml(text: str) -> bool:
    return text.strip().startswith("<?xml") or "<ce:" in text or "<article" in text[:500] and "dtd-version" in text[:2000]


ARTICLE = T.StructType(
    [
        T.StructField("source_type", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("sections", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("text", T.StringType())]))),
        T.StructField("tables", T.ArrayType(T.StructType([T.StructField("table_id", T.StringType()), T.StructField("caption", T.StringType()), T.StructField("headers", T.ArrayType(T.StringType())), T.StructField("rows", T.ArrayType(T.MapType(T.StringType(), T.StringType())))]))),
        T.StructField("figures", T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("figure_id", "caption", "image_url", "surrounding_text")]))),
        T.StructField("full_text", T.StringType()),
        T.StructField("parse_confidence", T.DoubleType()),
        T.StructField("parse_warnings", T.ArrayType(T.StringType())),
    ]
)


def read_article(text: str | None, base: str = "") -> tuple:
    text = text or ""
    xml = is_xml(text)
    page = Page(text, xml)
    if xml:
        first = lambda *tags: next((clean(n.text()) for t in tags if (n := page.root.first(t))), "")
        title, abstract, sections = first("ce:title", "dc:title", "article-title", "title"), first("ce:abstract", "dc:description", "abstract"), xml_sections(page)
    else:
        title, abstract, sections = page_title(page), page_abstract(page), page_sections(page)
    full = "\n\n".join([f"# {title}", abstract, *[f"## {k}\n{v}" for k, v in sections.items()]])
    tables = page_tables(page, xml)
    warnings = ([] if sections else ["No sections found in XML" if xml else "No sections found"]) + ([] if tables or xml else ["No tables found"])
    return ("xml" if xml else "html", title, abstract, list(sections.items()), tables, xml_figures(page) if xml else page_figures(page, base), full, (0.8 if xml else 0.85) * (1 if sections else 0.5), warnings)


def heading_source(html: str | Column, tag: str = "h1") -> Column:
    """What stands in the first element of the tag that has no attributes and ends in its line, as written but for &lt;, &gt; and
    &amp;: no other entity is read, none without its semicolon, and tags in it stay. White space of ASCII is made one space each,
    spaces of Unicode are cut at the ends. Empty without such an element, NULL for NULL. articles() has titles as readers see them."""
    found = F.regexp_extract(html, f"<{tag}>([^\\n]*?)</{tag}>", 1)
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        found = F.replace(found, F.lit(entity), F.lit(sign))
    return F.regexp_replace(F.regexp_replace(found, r"[ \t\n\f\r]+", " "), r"^\p{Zs}+|\p{Zs}+\z", "")


def articles(df: DataFrame, html_col: str, base_col: str | None = None) -> DataFrame:
    """df without its page, with the article's columns; a null page is an empty one."""
    keep = [c for c in df.columns if c not in ARTICLE.names and c != html_col]

    def run(parts):
        for pdf in parts:
            rows = [read_article(t, b) for t, b in zip(pdf[html_col], pdf[base_col] if base_col else [""] * len(pdf), strict=True)]
            got = pd.DataFrame(rows, columns=ARTICLE.names, index=pdf.index)
            for c, names in (("sections", ("name", "text")), ("tables", ("table_id", "caption", "headers", "rows")), ("figures", ("figure_id", "caption", "image_url", "surrounding_text"))):
                got[c] = [[dict(zip(names, x, strict=True)) for x in v] for v in got[c]]
            yield pd.concat([pdf[keep], got], axis=1)

    return df.mapInPandas(run, T.StructType([df.schema[c] for c in keep] + list(ARTICLE)))


CELL = [T.StructField(c, T.IntegerType() if c in ("row", "col") else T.StringType()) for c in ("table_id", "caption", "row", "col", "header", "value")]


def table_cells(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """One row a data cell of every table: id, table_id, caption, row, col, header, value."""

    def run(parts):
        for pdf in parts:
            out = []
            for key, text in zip(pdf[id_col], pdf[html_col], strict=True):
                page = Page(text or "")
                for n, table in enumerate(page.root.all("table"), 1):
                    headers, rows = table_grid(table)
                    out += [(key, f"table_{n}", _table_caption(page, table, n), y, x, headers[x] if x < len(headers) else f"col_{x}", v) for y, row in enumerate(rows) for x, v in enumerate(row)]
            yield pd.DataFrame(out, columns=[id_col, "table_id", "caption", "row", "col", "header", "value"])

    schema = T.StructType([df.schema[id_col], *CELL])
    return df.select(id_col, html_col).mapInPandas(run, schema)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def next_same(headers: Column) -> Column:
    """For each header the place of the next one that is equal, or of the cell beyond the headers that has its name, or a place
    that no row reaches. Worked out once a table, it tells for rows of any length which of equal headers is their last."""
    none, count = F.lit(2**31 - 1), F.size(headers)
    beyond = lambda h: F.regexp_extract(h, r"^col_(0|[1-9]\d{0,8})$", 1).try_cast("int")
    later = lambda h, i: F.array_position(F.slice(headers, i + 2, count), h).cast("int")
    return F.transform(headers, lambda h, i: _once(later(h, i), lambda at: F.when(at > 0, i + at).when(beyond(h) >= count, beyond(h)).otherwise(none)))


def by_header(headers: Column, row: Column, nexts: Column | None = None) -> Column:
    """A row's values by header, of equal headers the last; cells beyond the headers have names of their own."""
    if nexts is None:
        return _once(next_same(headers), lambda n: by_header(headers, row, n))
    return F.filter(row, lambda _, i: F.coalesce(F.get(nexts, i) >= F.size(row), F.lit(True)))


def _blank(row: Column) -> Column:
    return F.forall(row, lambda c: strip(c) == "")


def raw_tables(df: DataFrame, cells: str = "cells", table_id: str | None = None, page: str = "page") -> DataFrame:
    """Tables as arrays of rows of cells: headers and data (rows without any text dropped). A first row without text is no
    header; then the next one is. Tables left without headers or data are dropped.

    With table_id, a column with a table's number in its document, table_id and caption are added; the caption names the
    page, if there is such a column. Each cell is stripped once, and a table's equal headers are looked for once."""
    tidy = F.transform(F.filter(cells, lambda r: r.isNotNull()), lambda r: F.transform(r, lambda c: F.coalesce(strip(c), F.lit(""))))
    # a generator of one row keeps filters from working out its value again
    out = df.select("*", F.explode(F.array(tidy)).alias("_c")).where(F.size("_c") > 0)
    out = out.withColumn("_h", F.when(F.forall(F.get("_c", F.lit(0)), lambda c: c == ""), 1).otherwise(0)).where(F.size("_c") > F.col("_h"))
    if table_id:
        number = F.col(table_id).cast("string")
        where = F.concat(F.lit(" (page "), F.col(page).cast("string"), F.lit(")")) if page in df.columns else F.lit("")
        out = out.withColumns({"caption": F.concat(F.lit("Table "), number, where), "table_id": F.concat(F.lit("table_"), number)})
    headers = F.get("_c", F.col("_h"))
    data = _once(next_same(headers), lambda n: F.filter(F.slice("_c", F.col("_h") + 2, F.size("_c")), lambda r: F.exists(by_header(headers, r, n), lambda c: c != "")))
    out = out.select("*", F.explode(F.array(F.struct(headers.alias("headers"), data.alias("data")))).alias("_t")).drop("headers", "data").select("*", "_t.headers", "_t.data")
    return out.where((F.size("headers") > 0) & (F.size("data") > 0)).drop("_c", "_h", "_t")


def table_confidence(headers: str = "headers", data: str = "data") -> Column:
    """How sane a table looks, 0 to 1: filled and distinct headers, rows with a value for each header, filled cells; three
    places. Of equal headers a row has one value, so a table with such headers has no even row."""
    full = F.filter(headers, lambda h: strip(h) != "")
    quality = 0.5 * F.size(full) / F.size(headers) + 0.5 * F.size(F.array_distinct(full)) / F.size(full)
    # of each row: how many values it has, and how many of them are filled
    facts = lambda r, n: _once(by_header(F.col(headers), r, n), lambda v: F.struct(F.size(v).alias("n"), F.size(F.filter(v, lambda c: strip(c) != "")).alias("full")))
    total = lambda rows, field: F.aggregate(rows, F.lit(0), lambda s, r: s + r[field])

    def rate(rows: Column) -> Column:
        even = F.when(F.size(data) > 0, F.size(F.filter(rows, lambda r: r["n"] == F.size(headers))) / F.size(data)).otherwise(1.0)
        fill = F.when(total(rows, "n") > 0, total(rows, "full") / total(rows, "n")).otherwise(0.0)
        return F.round(quality * even * F.when(F.size(data) > 0, 0.5 + 0.5 * fill).otherwise(1.0), 3)

    score = _once(next_same(F.col(headers)), lambda n: _once(F.transform(data, lambda r: facts(r, n)), rate))
    return F.when(F.size(full) == 0, 0.0).otherwise(score)


def route_tables(df: DataFrame, least: float = 0.4, enabled: bool = True) -> DataFrame:
    """df with `to_model`: tables of low confidence, if there is a model to ask."""
    return df.withColumn("to_model", F.lit(enabled) & (table_confidence() < least))


def markdown_sections(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, ord, name, text of the parts between lines that begin with "## "; what comes first is the preamble. Headings
    with no line below are left out; of parts of one name the last stays."""
    parts = F.split(F.concat(F.lit("## preamble\n"), F.coalesce(text_col, F.lit(""))), r"(?m)^## ")
    rows = df.select(id_col, parts.alias("_all")).select(id_col, F.size("_all").alias("_n"), F.posexplode("_all").alias("ord", "_p")).where("ord > 0")
    rest = F.regexp_replace("_p", r"^[^\n]*\n?", "")
    has_lines = F.when(F.col("ord") == F.col("_n") - 1, F.col("_p").contains("\n")).otherwise(rest != "")
    named = rows.where(has_lines).select(id_col, "ord", F.lower(strip(F.substring_index("_p", "\n", 1))).alias("name"), strip(rest).alias("text"))
    return named.groupBy(id_col, "name").agg(F.max_by(F.struct("ord", "text"), "ord").alias("_l")).select(id_col, "_l.ord", "name", "_l.text")


def pdf_articles(df: DataFrame, id_col: str, text_col: str, marked_col: str, tables_col: str | None = None) -> DataFrame:
    """id, sections, full_text, parse_confidence of text taken from PDF files by other means.

    Text with headings marked (marked_col true) is split at them and trusted more than plain text; tables (an array
    column) lift the trust."""
    some = F.coalesce(F.size(tables_col), F.lit(0)) > 0 if tables_col else F.lit(False)
    trust = F.when(F.col(marked_col), 0.6).otherwise(0.3)
    base = df.select(id_col, F.col(text_col).alias("full_text"), F.when(some, F.greatest(trust, F.lit(0.7))).otherwise(trust).alias("parse_confidence"))
    parts = markdown_sections(df.where(F.col(marked_col)), id_col, text_col).groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("ord", "name", "text"))).alias("_s"))
    sections = F.coalesce(F.transform("_s", lambda x: F.struct(x["name"].alias("name"), x["text"].alias("text"))), F.array().cast("array<struct<name:string,text:string>>"))
    return base.join(parts, id_col, "left").select(id_col, sections.alias("sections"), "full_text", "parse_confidence")


def table_markdown(headers: str = "headers", data: str = "data"):
    """A table as lines between bars."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    rule = F.transform(headers, lambda h: F.lit("---"))
    return F.array_join(F.concat(F.array(line(F.col(headers)), line(rule)), F.transform(data, line)), "\n")


def document_text(title: str = "title", abstract: str = "abstract", sections: str = "sections"):
    """Title, abstract and sections as marked-down text."""
    return F.concat_ws("\n\n", F.concat(F.lit("# "), title), F.coalesce(abstract, F.lit("")), F.transform(sections, lambda s: F.concat(F.lit("## "), s["name"], F.lit("\n"), s["text"])))


def section_text(name: str, sections: str = "sections") -> Column:
    """The text of the first section with `name` anywhere in its name, in any case; empty if there is none."""
    hits = F.filter(sections, lambda s: F.lower(s["name"]).contains(name.lower()))
    return F.coalesce(F.get(hits, F.lit(0))["text"], F.lit(""))


# fixed values: names under which methods and results are looked up, in order
METHODS = ("methods", "materials", "materials and methods", "experimental", "experimental section")
RESULTS = ("results", "results and discussion", "findings")


def joined_sections(names: tuple[str, ...] = METHODS, sections: str = "sections") -> Column:
    """What section_text gives for each name, blank ones left out; a section that several names find comes as often."""
    return F.concat_ws("\n\n", *[F.nullif(section_text(n, sections), F.lit("")) for n in names])


def prompt_text(title: str = "title", abstract: str = "abstract", sections: str = "sections") -> Column:
    """The article as a model is given it: title, abstract and sections under names in capitals, blank parts left out."""
    some = lambda head, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(head), c))
    parts = F.transform(sections, lambda s: F.concat(F.lit("\n"), F.upper(s["name"]), F.lit(":\n"), F.coalesce(s["text"], F.lit(""))))
    return F.concat_ws("\n", some("TITLE: ", title), some("\nABSTRACT:\n", abstract), parts)


def tables_text(tables: str = "tables", none: str = "") -> Column:
    """All tables that have headers as lines between bars, each under its caption, or `none` if there are none."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    def one(t: Column) -> Column:
        head = F.when(F.coalesce(t["caption"], F.lit("")) != "", F.concat(F.lit("**"), t["caption"], F.lit("**\n")))
        rows = F.transform(t["rows"], lambda r: line(F.transform(t["headers"], lambda h: F.coalesce(F.try_element_at(r, h), F.lit("")))))
        return F.concat_ws("\n", head, line(t["headers"]), line(F.transform(t["headers"], lambda _: F.lit("---"))), rows)

    texts = F.transform(F.filter(tables, lambda t: F.size(t["headers"]) > 0), one)
    return F.when(F.size(texts) > 0, F.array_join(texts, "\n\n")).otherwise(none)
