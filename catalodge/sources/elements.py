"""Elements of a page as intervals, and the cell grids of its tables.

One pass from left to right over the tags of a page gives every element the place where
it opens and the place where it closes. "Inside" is then a test of intervals, at any depth
of nesting, in columns or in joins. Missing end tags are read as browsers read them: an
item ends where the next one begins, a cell at the next cell or row, a paragraph at the
next block, and what is still open at the end tag of an outer element ends there.

The pass runs on Arrow batches in Python workers, as a running stack is beyond column
expressions; all that follows from intervals stays in columns.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalodge.operators import ordered
from catalodge.sources import html

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|template)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|"
    r"<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.DOTALL | re.IGNORECASE,
)
SPAN = re.compile(r"\b(colspan|rowspan)\s*=\s*[\"']?\s*(\d+)", re.IGNORECASE)
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")

# Fixed values of the markup language: elements without content, elements that end an open
# paragraph, what an opening tag closes up to which enclosing element, and the widest spans.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "optgroup"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
CELL_BORDERS = frozenset(("table", "td", "th", "caption"))
TABLE_PARTS = frozenset(("td", "th", "tr", "thead", "tbody", "tfoot", "caption"))
MOST_COLUMNS, MOST_ROWS = 1000, 65_534


class Element(NamedTuple):
    """An element of a page: offsets of its opening tag, its content and its end, depth and number of its parent."""

    tag: str
    open: int
    start: int
    end: int
    close: int
    depth: int
    parent: int


def tag_pass(page: str) -> list[Element]:
    """All elements in the order in which they open."""
    found: list[list] = []
    stack: list[int] = []

    def close_to(level: int, end: int, close: int) -> None:
        """End what is open from a level of the stack on; only the element of that level owns the end tag."""
        for place, at in enumerate(reversed(stack[level:])):
            found[at][3] = end
            found[at][4] = close if place == len(stack) - level - 1 else end
        del stack[level:]

    def lowest(wanted: set | frozenset, borders: set | frozenset) -> int | None:
        """The lowest level of an open element in `wanted` above the nearest border."""
        level = None
        for at in range(len(stack) - 1, -1, -1):
            tag = found[stack[at]][0]
            if tag in wanted:
                level = at
            if tag in borders:
                break
        return level

    for token in TOKEN.finditer(page):
        end_tag, tag, rest = token.group("end", "tag", "rest")
        if tag is None:
            continue
        tag, (at, after) = tag.lower(), token.span()
        if end_tag:
            # Most end tags are that of the innermost element.
            if stack and found[stack[-1]][0] == tag:
                element = found[stack.pop()]
                element[3], element[4] = at, after
                continue
            borders = frozenset() if tag == "table" else {"table"} if tag in TABLE_PARTS else CELL_BORDERS
            for level in range(len(stack) - 1, -1, -1):
                name = found[stack[level]][0]
                if name == tag:
                    close_to(level, at, after)
                    break
                if name in borders:
                    break
            continue
        if tag in CLOSES:
            level = lowest(*CLOSES[tag])
            if level is not None:
                close_to(level, at, at)
        if tag in BLOCKS:
            level = lowest({"p"}, CELL_BORDERS | {"button"})
            if level is not None:
                close_to(level, at, at)
        found.append([tag, at, after, after, after, len(stack), stack[-1] if stack else -1])
        if tag not in VOID and not rest.endswith("/"):
            stack.append(len(found) - 1)
    close_to(0, len(page), len(page))
    return [Element(*row) for row in found]


class Cell(NamedTuple):
    element: int
    column: int


class Row(NamedTuple):
    element: int
    cells: list[Cell]
    grid: list[tuple[int, int]]  # for each column the (row, cell) that covers it, (-1, -1) where none does


class Table(NamedTuple):
    element: int
    outer: int  # number of the table around it, else -1
    caption: int  # element, else -1
    rows: list[Row]


def table_pass(page: str, found: list[Element]) -> list[Table]:
    """Tables with their own rows and cells; cells that span columns or rows cover several places of the grid."""
    tables: list[Table] = []
    owner: dict[int, int] = {}  # element -> its nearest table
    row_of: dict[int, tuple[int, int]] = {}
    for at, element in enumerate(found):
        outer = owner.get(element.parent, -1)
        owner[at] = outer
        if element.tag == "table":
            owner[at] = len(tables)
            tables.append(Table(at, outer, -1, []))
        elif outer >= 0 and element.tag == "caption" and tables[outer].caption < 0:
            tables[outer] = tables[outer]._replace(caption=at)
        elif outer >= 0 and element.tag == "tr":
            row_of[at] = outer, len(tables[outer].rows)
            tables[outer].rows.append(Row(at, [], []))
        elif element.tag in ("td", "th") and element.parent in row_of:
            table, row = row_of[element.parent]
            tables[table].rows[row].cells.append(Cell(at, -1))
    for table in tables:
        fill_grid(page, found, table)
    return tables


def fill_grid(page: str, found: list[Element], table: Table) -> None:
    """Give each cell its first column, and each row the cells that cover its columns."""
    below: dict[int, tuple[int, tuple[int, int]]] = {}  # column -> (rows still covered, cell)
    for number, row in enumerate(table.rows):
        covered: dict[int, tuple[int, int]] = {}
        for column, (left, cell) in list(below.items()):
            covered[column] = cell
            below[column] = left - 1, cell
            if left == 1:
                del below[column]
        if not covered and all(found[cell.element].start - found[cell.element].open <= 4 for cell in row.cells):
            # Cells without attributes below none that span rows: each has a column of its own.
            row.cells[:] = [Cell(cell.element, column) for column, cell in enumerate(row.cells)]
            row.grid.extend((number, place) for place in range(len(row.cells)))
            continue
        column = 0
        for place, cell in enumerate(row.cells):
            element = found[cell.element]
            # An opening tag of "<td>" alone has no attributes.
            spans = {k.lower(): int(v[:6]) for k, v in SPAN.findall(page, element.open, element.start)} if element.start - element.open > 4 else {}
            while column in covered:
                column += 1
            wide = min(max(1, spans.get("colspan", 1)), MOST_COLUMNS)
            high = min(spans.get("rowspan", 1) or MOST_ROWS, MOST_ROWS, len(table.rows) - number)
            row.cells[place] = Cell(cell.element, column)
            for c in range(column, column + wide):
                # Where spans overlap, the cell that came first keeps the column.
                if covered.setdefault(c, (number, place)) == (number, place) and high > 1:
                    below[c] = high - 1, (number, place)
            column += wide
        row.grid.extend(covered.get(c, (-1, -1)) for c in range(max(covered, default=-1) + 1))


# ---- the passes as columns -----------------------------------------------------------------

ELEMENT = "struct<pos: int, tag: string, open: int, start: int, end: int, close: int, depth: int, parent: int, head: string, body: string>"
_INTS = ("pos", "open", "start", "end", "close", "depth", "parent")


def _lists(sizes: list[int | None], values: pa.Array) -> pa.ListArray:
    """Lists of the given sizes, one behind the other; None is a null."""
    ends = [0, *itertools.accumulate(size or 0 for size in sizes)]
    offsets = [None if size is None else start for size, start in zip(sizes, ends, strict=False)]
    return pa.ListArray.from_arrays(pa.array([*offsets, ends[-1]], pa.int32()), values)


def _structs(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.StructArray:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.StructArray.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, fields, strict=True)], [n for n, _ in fields])


ELEMENT_FIELDS = [("pos", pa.int32()), ("tag", pa.string())] + [(n, pa.int32()) for n in _INTS[1:]] + [("head", pa.string()), ("body", pa.string())]


def elements(page: Column, *tags: str) -> Column:
    """array<struct<pos, tag, open, start, end, close, depth, parent, head, body>> of the elements with these tags.

    ``pos`` numbers all elements of the page in opening order; ``parent`` is the pos of the
    nearest element around it, whether listed or not, or -1. An element x is inside y when
    y.start <= x.open and x.open < y.end. ``head`` is the opening tag, ``body`` the markup inside.
    """
    wanted = frozenset(tags)

    def cut(pages: pa.Array) -> pa.Array:
        sizes, rows = [], []
        for value in pages:
            text = value.as_py() or ""
            before = len(rows)
            for pos, e in enumerate(tag_pass(text)):
                if e.tag in wanted:
                    rows.append((pos, e.tag, e.open, e.start, e.end, e.close, e.depth, e.parent, text[e.open : e.start], text[e.start : e.end]))
            sizes.append(len(rows) - before)
        return _lists(sizes, _structs(rows, ELEMENT_FIELDS))

    return F.arrow_udf(cut, f"array<{ELEMENT}>")(page)


NAMED = "struct<name: string, column: int>"
ROW = "struct<row_no: int, html: string, is_header: boolean, cells: array<string>, cell_html: array<string>, places: array<struct<row: int, cell: int>>>"
TABLE = f"struct<table_no: int, outer: int, caption: string, heading: string, columns: array<{NAMED}>, rows: array<{ROW}>>"

NOISE, TAG = re.compile(html.NOISE_RE), re.compile(html.TAG_RE)


def plain_text(fragment: str) -> str:
    """Text of a fragment on one line, as ``html.inner_text`` makes it."""
    if "<" in fragment:
        fragment = TAG.sub(" ", NOISE.sub("<br>", fragment))
    return " ".join(unescape(fragment).split())


def header_cells(table: Table, found: list[Element], texts: list[list[str]]) -> list[tuple[str, int]]:
    """(text, first column) of the header cells above the first row with a data cell; of all rows where there are none above."""
    heads = [[found[cell.element].tag == "th" for cell in row.cells] for row in table.rows]
    top = list(itertools.takewhile(lambda y: all(heads[y]), range(len(heads)))) or range(len(heads))
    return [(texts[y][x], cell.column) for y in top for x, cell in enumerate(table.rows[y].cells) if heads[y][x]]


def _cut_tables(pages: pa.Array) -> pa.Array:
    """Tables of each page: the nearest heading above, the caption, header columns, and rows with texts, markup and grid."""
    per_page, per_table, per_header, per_row, per_grid = [], [], [], [], []
    tables, headers, rows, cells, bodies, grids = [], [], [], [], [], []
    for value in pages:
        text = value.as_py() or ""
        found = tag_pass(text)
        heads = [at for at, e in enumerate(found) if e.tag in HEADINGS]
        above = -1
        cut = table_pass(text, found)
        per_page.append(len(cut))

        def inside(at: int) -> str:
            return text[found[at].start : found[at].end]  # noqa: B023

        for number, table in enumerate(cut):
            while above + 1 < len(heads) and heads[above + 1] < table.element:
                above += 1
            caption = plain_text(inside(table.caption)) if table.caption >= 0 else ""
            tables.append((number, table.outer, caption, plain_text(inside(heads[above])) if above >= 0 else ""))
            markup = [[inside(cell.element) for cell in row.cells] for row in table.rows]
            texts = [[plain_text(cell) for cell in row] for row in markup]
            named = header_cells(table, found, texts)
            headers += named
            per_header.append(len(named))
            per_table.append(len(table.rows))
            for place, row in enumerate(table.rows):
                e = found[row.element]
                rows.append((place, text[e.open : e.close], all(found[c.element].tag == "th" for c in row.cells)))
                per_row.append(len(row.cells))
                per_grid.append(len(row.grid))
                cells += texts[place]
                bodies += markup[place]
                grids += row.grid
    flat = _structs(rows, [("row_no", pa.int32()), ("html", pa.string()), ("is_header", pa.bool_())])
    row_structs = pa.StructArray.from_arrays(
        [
            *flat.flatten(), _lists(per_row, pa.array(cells, pa.string())), _lists(per_row, pa.array(bodies, pa.string())),
            _lists(per_grid, _structs(grids, [("row", pa.int32()), ("cell", pa.int32())])),
        ],
        ["row_no", "html", "is_header", "cells", "cell_html", "places"],
    )
    named = [("table_no", pa.int32()), ("outer", pa.int32()), ("caption", pa.string()), ("heading", pa.string())]
    header_lists = _lists(per_header, _structs(headers, [("name", pa.string()), ("column", pa.int32())]))
    table_structs = pa.StructArray.from_arrays(
        [*_structs(tables, named).flatten(), header_lists, _lists(per_table, row_structs)], [n for n, _ in named] + ["columns", "rows"]
    )
    return _lists(per_page, table_structs)


def tables(page: Column) -> Column:
    """array<struct<table_no, outer, caption, heading, columns, rows: array<struct<row_no, html, is_header, cells, cell_html, places>>>>.

    A row's ``cells`` are the texts of its own cells; a table inside a cell is a table of its
    own, with ``outer`` as the number of the one around it, and its text is part of the
    cell's. ``places`` names for every column the (row, cell) that covers it, (-1, -1) where
    none does: cells that span columns or rows cover several places. ``columns`` are
    (name, column) of the header cells, rows from the top until the first one with a data
    cell; without such rows all header cells. ``heading`` is the nearest one above.
    """
    return F.arrow_udf(_cut_tables, f"array<{TABLE}>")(page)


def column_of(columns: Column, name: Column | str) -> Column:
    """Number of the first column under a header with this text, case ignored; NULL when there is none."""
    wanted = F.lower(F.lit(name) if isinstance(name, str) else name)
    return F.get(F.filter(columns, lambda c: F.lower(c["name"]) == wanted), F.lit(0))["column"]


def page_cells(pages: DataFrame, *keep: str, page: str = "html") -> DataFrame:
    """One row per table row: kept columns, table_no, outer, heading, caption, columns, row_no, is_header, cells, cell_html, row_html, grid, starts.

    ``grid`` has the text that covers each column, and ``starts`` whether its cell begins in the row.
    """
    cut = pages.select(*keep, F.explode(tables(html.page_string(F.col(page)))).alias("t"))
    rows = cut.select(*keep, "t.table_no", "t.outer", "t.heading", "t.caption", "t.columns", "t.rows", F.explode("t.rows").alias("r"))
    text_at = lambda p: F.get(F.get("rows", p["row"])["cells"], p["cell"])
    return rows.select(
        *keep, "table_no", "outer", "heading", "caption", "columns", "r.row_no", "r.is_header", "r.cells", "r.cell_html",
        F.col("r.html").alias("row_html"), F.transform("r.places", lambda p: F.when(p["row"] >= 0, text_at(p))).alias("grid"),
        F.transform("r.places", lambda p: p["row"] == F.col("r.row_no")).alias("starts"),
    )


def page_elements(pages: DataFrame, *keep: str, tags: tuple[str, ...], page: str = "html") -> DataFrame:
    """One row per element with one of the tags: kept columns and the fields of ``elements``."""
    return pages.select(*keep, F.explode(elements(html.page_string(F.col(page)), *tags)).alias("e")).select(*keep, "e.*")


def under_marks(
    pages: DataFrame, *keep: str, tags: tuple[str, ...], marks: tuple[str, ...], values: dict[str, Callable[[Column], Column]],
    key: str = "page_id", page: str = "html",
) -> DataFrame:
    """Elements with one of ``tags``, each with the text ``above``: that of the nearest mark opened before it.

    An as-of merge of two position lists inside each page. Columns: kept ones, pos, tag,
    above (NULL before the first mark) and ``values``, made of the element before anything
    is shuffled, so that only they and the texts of marks move.
    """
    found = pages.select(*keep, F.explode(elements(html.page_string(F.col(page)), *dict.fromkeys((*tags, *marks)))).alias("e"))
    own, mark = F.col("e.tag").isin(*tags), F.col("e.tag").isin(*marks)
    rows = found.select(
        *keep, F.col("e.pos").alias("pos"), F.col("e.tag").alias("tag"), F.when(mark, html.inner_text(F.col("e.body"))).alias("__mark"),
        *[F.when(own, make(F.col("e"))).alias(name) for name, make in values.items()],
    )
    filled = ordered.last_known(rows, [key], ["pos"], {"__mark": "above"}, include_current=False)
    return filled.filter(F.col("tag").isin(*tags)).drop("__mark")


def inside(inner: Column, outer: Column) -> Column:
    """Whether one element lies in another one of the same page, at any depth."""
    return (outer["start"] <= inner["open"]) & (inner["open"] < outer["end"])


def _cut_scopes(pages: pa.Array, patterns: pa.Array) -> pa.Array:
    sizes, bodies = [], []
    for value, wanted in zip(pages, patterns, strict=True):
        text, pattern = value.as_py() or "", wanted.as_py()
        if pattern is None:
            sizes.append(None)
            continue
        head = re.compile(pattern)
        found = [text[e.start : e.end] for e in tag_pass(text) if head.match(text, e.open, e.start)]
        sizes.append(len(found))
        bodies += found
    return _lists(sizes, pa.array(bodies, pa.string()))


def scopes(page: Column, head_re: Column) -> Column:
    """Markup inside each element whose opening tag matches the pattern from its start; the whole page where that is NULL.

    An element ends at its own end tag, however deep others of its kind are nested in it.
    Only pages with a pattern are sent to the workers.
    """
    return F.coalesce(F.arrow_udf(_cut_scopes, "array<string>")(F.when(head_re.isNotNull(), page), head_re), F.array(page))
