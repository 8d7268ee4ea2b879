"""Element intervals and table grids against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from catalodge.operators import closure
from catalodge.plans import extraction, site_rules
from catalodge.sources import elements, html


def shown(page):
    return [(e.tag, page[e.start : e.end], page[e.open : e.close], e.depth, e.parent) for e in elements.tag_pass(page)]


def grown(draw, depth=0):
    """A random well-formed tree as markup, with its elements in opening order as (tag, inside, whole, depth)."""
    tag = draw.choice(("div", "section", "article", "b", "ul", "i", "custom-x"))
    head = f"<{tag} class=\"a>b{draw.randrange(9)}\" data='<i>'>"
    inside, found = draw.choice(("", "text & <", "x<!-- <div> -->", "<script>if (a<b) '</div>'</script>")), []
    for _ in range(draw.randrange(4) if depth < 5 else 0):
        markup, below = grown(draw, depth + 1)
        inside += markup + draw.choice(("", "t", "<br>", "<img src=x />"))
        found += below
    whole = f"{head}{inside}</{tag}>"
    return whole, [(tag, inside, whole, depth), *found]


def test_intervals_of_random_trees():
    for seed in range(200):
        page, want = grown(random.Random(seed))
        got = [row[:4] for row in shown(page) if row[0] not in elements.VOID]
        assert got == want
        found = elements.tag_pass(page)
        for at, e in enumerate(found):
            # Inside is a test of intervals: it agrees with the chain of parents.
            above, parent = set(), e.parent
            while parent >= 0:
                above.add(parent)
                parent = found[parent].parent
            assert above == {i for i, o in enumerate(found) if i != at and o.start <= e.open < o.end}


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b<ul><li>c</ul>", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<p>a<p>b<div>c</div>", ["a", "b"]),
        ("<dl><dt>a<dd>b<dt>c<dd>d</dl>", ["a", "b", "c", "d"]),
        ("<div><li>a</div><li>b", ["a", "b"]),
        ("<td>a</div>b</td>", ["a</div>b"]),
        ("<table><tr><td>a<table><tr><td>x</table></td><td>b</table>", ["a<table><tr><td>x</table>", "x", "b"]),
        ("<li>open at the end <b>x", ["open at the end <b>x"]),
        ("<LI>a</Li><li\nclass=x>b</LI >", ["a", "b"]),
        ("<p>a<!-- <p>b --><p>c", ["a<!-- <p>b -->", "c"]),
        ("", []),
        ("< p>no <3 tags</ p>", []),
    ],
)
def test_missing_end_tags(page, want):
    assert [inside for tag, inside, *_ in shown(page) if tag in ("li", "td", "p", "dt", "dd")] == want


def painted(table):
    """Grid of [(text, columns, rows), ...] rows by painting a field of places."""
    field = {}
    for y, row in enumerate(table):
        x = 0
        for text, wide, high in row:
            while (y, x) in field:
                x += 1
            for dx in range(wide):
                free = (y, x + dx) not in field
                for dy in range(min(high, len(table) - y) if free else 0):
                    field[y + dy, x + dx] = text
            x += wide
    return [[field.get((y, x)) for x in range(1 + max((c for r, c in field if r == y), default=-1))] for y in range(len(table))]


def test_grids_with_spans(spark):
    drawn = []
    for seed in range(60):
        draw = random.Random(seed)
        names = iter(range(1000))
        drawn.append([[(f"c{next(names)}", draw.choice((1, 1, 2, 3)), draw.choice((1, 1, 2, 4))) for _ in range(draw.randrange(5))] for _ in range(draw.randrange(1, 6))])
    markup = [
        (n, "<table>" + "".join("<tr>" + "".join(f'<td colspan="{w}" ROWSPAN={h}>{t}</td>' for t, w, h in row) + "</tr>" for row in table) + "</table>")
        for n, table in enumerate(drawn)
    ]
    rows = elements.page_cells(spark.createDataFrame(markup, "page_id int, html string"), "page_id").collect()
    got = {(r["page_id"], r["row_no"]): r["grid"] for r in rows}
    assert got == {(n, y): line for n, table in enumerate(drawn) for y, line in enumerate(painted(table))}


def test_plain_text_is_that_of_columns(spark):
    draw = random.Random(3)
    pieces = ["a ", "<b>", "</b>", "&pound;", "&amp;lt;", "&nbsp;", "&#163;", "&#x80;", "<!-- x -->", "<script>1<2</script>", "\n\t", "<br/>", "<i title='>'>", " < ", "é", "&", "\u3000"]
    rows = [(n, "".join(draw.choice(pieces) for _ in range(draw.randrange(12)))) for n in range(400)]
    got = dict(map(tuple, spark.createDataFrame(rows, "n int, part string").select("n", html.inner_text(F.col("part"))).collect()))
    assert got == {n: elements.plain_text(part) for n, part in rows}


def test_nested_tables_keep_all_cells(spark):
    page = "<h2>A</h2><table><caption>cap</caption><tr><td>a<table><tr><td>x</td><td>y</td></tr></table></td><td>b</td></tr><tr><td>c</td><td>d</td></tr></table><h3>B</h3><table><tr><th>h</th></tr><tr></tr></table>"
    rows = elements.page_cells(spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id int, html string"), "page_id")
    got = [(r["table_no"], r["outer"], r["heading"], r["caption"], r["cells"], r["is_header"]) for r in rows.orderBy("table_no", "row_no").collect()]
    assert got == [
        (0, -1, "A", "cap", ["a x y", "b"], False),
        (0, -1, "A", "cap", ["c", "d"], False),
        (1, 0, "A", "", ["x", "y"], False),
        (2, -1, "B", "", ["h"], True),
        (2, -1, "B", "", [], True),
    ]


def test_columns_by_header(spark):
    page = "<table><tr><th colspan=2>When</th><th>Who</th></tr><tr><th>From</th><th>To</th><th></th></tr><tr><th>row</th><td>b</td><td>c</td></tr></table><table><tr><td>1</td><th>late</th></tr></table>"
    rows = elements.page_cells(spark.createDataFrame([(1, page)], "page_id int, html string"), "page_id")
    at = lambda name: F.get("grid", elements.column_of(F.col("columns"), name))
    got = rows.filter("table_no = 1 OR row_no = 2").select("table_no", *[at(n).alias(n) for n in ("WHEN", "to", "who", "none", "late")])
    assert [tuple(r) for r in got.orderBy("table_no").collect()] == [(0, "row", "b", "c", None, None), (1, None, None, None, None, "late")]


def test_nearest_mark_above_equals_a_loop(spark):
    draw = random.Random(9)
    pages = []
    for n in range(40):
        pieces = [draw.choice(("<h3>{}</h3>", "<li>{}", "<strong>{}</strong>", "<p>{}", "<div><li>{}</div>")).format(f"t{i}") for i in range(draw.randrange(12))]
        pages.append((n, "".join(pieces)))
    got = elements.under_marks(
        spark.createDataFrame(pages, "page_id int, html string"), "page_id", tags=("li",), marks=("h3", "strong"), values={"text": lambda e: e["pos"]}
    )
    want = []
    for n, page in pages:
        above = None
        for pos, e in enumerate(elements.tag_pass(page)):
            if e.tag in ("h3", "strong"):
                above = page[e.start : e.end]
            elif e.tag == "li":
                want.append((n, pos, "li", pos, above))
    assert sorted(map(tuple, got.select("page_id", "pos", "tag", "text", "above").collect())) == want


def test_scopes_end_at_their_own_end_tag(spark):
    page = "<ul class='x'><li>a<ul><li>b</ul><li>c</ul><ul>d</ul>"
    frame = spark.createDataFrame([(1, page, "(?i)<ul[^>]*x"), (2, page, None), (3, page, "<nothing"), (4, "", "<ul")], "page_id int, html string, re string")
    got = {r[0]: r[1] for r in frame.select("page_id", elements.scopes(F.col("html"), F.col("re"))).collect()}
    assert got == {1: ["<li>a<ul><li>b</ul><li>c"], 2: [page], 3: [], 4: []}


def loop(seeds, edges):
    rounds, frontier, number = dict.fromkeys(seeds, 0), set(seeds), 0
    while frontier:
        number += 1
        frontier = {b for a, b in edges if a in frontier and b is not None} - rounds.keys()
        rounds |= dict.fromkeys(frontier, number)
    return rounds


def test_closure_equals_a_loop(spark, monkeypatch):
    monkeypatch.setattr(closure, "COMPACT", 3)
    draw = random.Random(2)
    for seeds, edges in (
        (["a"], [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y"), ("d", None)]),
        (["s"], [(f"n{i}" if i else "s", f"n{i + 1}") for i in range(11)]),
        ([f"n{i}" for i in range(3)], [(f"n{draw.randrange(60)}", f"n{draw.randrange(60)}") for _ in range(90)]),
        ([], [("a", "b")]),
        (["a", "a"], []),
    ):
        got = closure.reachable(
            spark.createDataFrame([(s,) for s in seeds], "node string"), spark.createDataFrame(edges, "src string, dst string"), "src", "dst"
        )
        assert sorted(map(tuple, got.collect())) == sorted(loop(seeds, edges).items())


def test_stored_pages_from_index_to_detail_end_once(spark):
    list_url = "https://catalogue.example/modules?departments=CS"
    links = lambda first, n: "".join(f'<a href="/modules/2025/CS{i:03d}-15">x</a>' for i in range(first, first + n))
    pages = [
        (1, "warwick", "module_catalog", f"{list_url}&page=0", links(0, 50)),
        (2, "warwick", "module_catalog", f"{list_url}&page=1", links(50, 50)),
        (3, "warwick", "module_catalog", f"{list_url}&page=2", links(100, 20)),
        (4, "warwick", "module_catalog", f"{list_url}&page=9", links(0, 50)),
    ]
    frame = spark.createDataFrame(pages, "page_id long, school string, category string, url string, html string")
    found = extraction.page_closure(frame, extraction.discovery_rules(spark), frame.filter("page_id = 1").select("url"))
    got = sorted(map(tuple, found.collect()), key=lambda r: r[1])
    assert got == [(f"{list_url}&page=0", 0, 1), (f"{list_url}&page=1", 1, 2), (f"{list_url}&page=2", 2, 3)]


def test_rounds_stay_apart_in_the_deadline_table(spark):
    page = "<table><tr><th>Round</th><th>Application deadline</th></tr><tr><td>1</td><td>1 May 2026</td></tr><tr><td>2</td><td>1 June 2026</td></tr></table>"
    url = "https://study.ed.ac.uk/programmes/postgraduate-taught/1-x"
    frame = spark.createDataFrame([(1, "edi", site_rules.DETAIL, url, page)], "page_id long, school string, category string, url string, html string")
    rows = extraction.deadline_rounds(frame).orderBy("round_no").collect()
    assert [(r["round_no"], r["deadline_at"], r["note"]) for r in rows] == [
        (1, "2026-05-01 23:59:00", "第 1 轮申请截止"), (2, "2026-06-01 23:59:00", "第 2 轮申请截止"),
    ]


def test_cells_without_attributes_fill_the_grid_as_others_do():
    plain = "<table><tr><th>a<th>b</tr><tr><td rowspan=2>1<td>2</tr><tr><td>3</tr><tr><td>4<td>5<td>6</tr><tr></tr></table>"
    spaced = plain.replace("<td>", "<td >").replace("<th>", "<th >")
    shape = lambda page: [(row.grid, [c.column for c in row.cells]) for t in elements.table_pass(page, elements.tag_pass(page)) for row in t.rows]
    assert shape(plain) == shape(spaced) and shape(plain)[2][0] == [(1, 0), (2, 0)]


def test_plain_cells_ask_for_no_spans(monkeypatch):
    class Counted:
        asked = 0

        def findall(self, *where):
            Counted.asked += 1
            return []

    monkeypatch.setattr(elements, "SPAN", Counted())
    page = "<table><tr><td>1</td><td>2</td></tr><tr><td class='x'>3</td><td>4</td></tr></table>"
    elements.table_pass(page, elements.tag_pass(page))
    assert Counted.asked == 1
