"""Expressions on single values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalodge.functions import dates, fees, labels, rules, text, translate, urls
from catalodge.sources import elements, feeds, html


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def labels_of(*names):
    return F.array(*[F.lit(n) for n in names])


@pytest.mark.parametrize(
    "raw,expected",
    [("Full-time fee: £34,470", 34470.0), ("about £9,535.50 per year", 9535.5), ("no fee here", None)],
)
def test_money(spark, raw, expected):
    assert value(spark, dates.money(F.lit(raw))) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("20 Oct 2025", dt.date(2025, 10, 20)), ("20 October 2025", dt.date(2025, 10, 20)), ("October 5, 2025", dt.date(2025, 10, 5)),
        ("05/10/2025", dt.date(2025, 10, 5)), ("2025-10-05", dt.date(2025, 10, 5)), ("31 February 2025", None), ("nonsense", None),
    ],
)
def test_parse_date(spark, raw, expected):
    assert value(spark, dates.parse_date(F.lit(raw))) == expected


@pytest.mark.parametrize(
    "raw,start,end",
    [
        ("Monday 30 November - Friday 11 December 2026", dt.date(2026, 11, 30), dt.date(2026, 12, 11)),
        ("7th May to 9th May 2026", dt.date(2026, 5, 7), dt.date(2026, 5, 9)),
        ("on 3 May 2026 (tbc)", dt.date(2026, 5, 3), dt.date(2026, 5, 3)),
        ("soon", None, None),
    ],
)
def test_date_range(spark, raw, start, end):
    found = value(spark, dates.date_range(F.lit(raw)))
    assert (found["start"], found["end"]) == (start, end)


def test_ielts_ignores_years(spark):
    found = value(spark, rules.ielts(F.lit("IELTS 6.5 overall with 6.0 in each. Course lasts 4 years.")))
    assert (found["overall"], found["minimum"]) == (6.5, 6.0)
    found = value(spark, rules.ielts(F.lit("no english requirements mentioned")))
    assert (found["overall"], found["minimum"]) == (None, None)


def test_fee_near(spark):
    scholarship = "International students\n£3,000 scholarships for international students"
    assert value(spark, fees.fee_near(F.lit(scholarship), labels_of("International"))) is None
    fee = "International & EU\nFull-time fee:\n£34,470"
    assert value(spark, fees.fee_near(F.lit(fee), labels_of("International & EU"))) == 34470.0
    before = "The fee is £12,000\nOverseas"
    assert value(spark, fees.fee_near(F.lit(before), labels_of("Overseas"))) == 12000.0


def test_band_and_white_space(spark):
    assert value(spark, rules.band(F.lit("requires Band C for this course"))) == "band-C"
    assert value(spark, rules.band(F.lit("no banding here"))) is None
    assert value(spark, text.norm_ws(F.lit("  a \n b\t c "))) == "a b c"


@pytest.mark.parametrize(
    "old,new,expected",
    [("46700.00", "46700.0", False), ("a ", "a", False), ("1", "2", True), (None, None, False), (None, "x", True), ("1d", "1", True)],
)
def test_differs(spark, old, new, expected):
    out = value(spark, text.differs(F.lit(old).cast("string"), F.lit(new).cast("string")))
    assert out is expected


def test_first_rule_wins(spark):
    name = F.lit("academic year / Orientation")
    assert value(spark, rules.event_type(name)) == "welcome_week"
    july = F.lit("2026-07-27").cast("date")
    assert value(spark, rules.event_type(F.lit("examination period"), july)) == "resit_period"


@pytest.mark.parametrize(
    "href,expected",
    [
        ("/x", "https://h.org/x"), ("y?z=1", "https://h.org/a/b/y?z=1"), ("../y", "https://h.org/a/y"), ("//o.net/p", "https://o.net/p"),
        ("#top", "https://h.org/a/b/c"), ("?q=2", "https://h.org/a/b/c?q=2"), ("http://o.org/k#f", "http://o.org/k"),
    ],
)
def test_resolve(spark, href, expected):
    assert value(spark, urls.resolve(F.lit("https://h.org/a/b/c"), F.lit(href))) == expected


def test_url_shapes(spark):
    assert value(spark, urls.clean_url(F.lit("https://H.org/a/?q=1#f"))) == "https://H.org/a/"
    assert value(spark, urls.same_page_key(F.lit("http://www.H.org/a/"))) == value(spark, urls.same_page_key(F.lit("https://h.org/a")))
    assert value(spark, urls.canonical_course(F.lit("https://courses.x.uk/202627/b123/law"), "courses.x.uk")) == "https://courses.x.uk/202627/b123/law"
    assert value(spark, urls.canonical_course(F.lit("https://courses.x.uk/2026/b123/law"), "courses.x.uk")) == "https://courses.x.uk/b123/law"


def test_page_text_keeps_inner_padding(spark):
    page = "<title>T</title><script>var a='<p>';</script><h2>\n Term:\n   Term 2 &nbsp;&nbsp;\n  UG\n</h2><!-- x --><p>&amp;lt; &pound;5</p>"
    lines = value(spark, html.page_text(F.lit(page))).split("\n")
    assert lines == ["T", "Term:", "   Term 2   ", "  UG", "&lt; £5"]


def test_table_rows_carry_their_heading(spark):
    page = "<h2>A</h2><table><tr><td>1<td>&nbsp;</tr></table><p>x</p><table><tr><th>h</th></tr><tr><td>2</td></tr></table>"
    tables = value(spark, elements.tables(F.lit(page)))
    assert [(t["heading"], [r["cells"] for r in t["rows"]]) for t in tables] == [("A", [["1", ""]]), ("A", [["h"], ["2"]])]


def test_paging(spark):
    url = F.lit("https://s/rest?firstResult=0&numberOfResults=200")
    assert value(spark, feeds.next_offset_urls(url, F.lit(450))) == [
        "https://s/rest?firstResult=200&numberOfResults=200", "https://s/rest?firstResult=400&numberOfResults=200",
    ]
    assert value(spark, feeds.next_offset_urls(F.lit("https://s/rest?firstResult=200"), F.lit(450))) == []
    assert value(spark, feeds.numbered_page_urls(labels_of("/s?page=2&t=1", "/s?page=3&t=1"))) == ["/s?page=2&t=1", "/s?page=3&t=1"]
    assert value(spark, feeds.next_index_url(F.lit("u?PageIndex=0"), F.lit(2000), 2000)) == "u?PageIndex=1"
    assert value(spark, feeds.next_index_url(F.lit("u?PageIndex=1"), F.lit(13), 2000)) is None


def test_translations(spark):
    assert value(spark, translate.calendar_zh(F.lit("Semester 1 begins"))) == "第1学期 开始"
    assert value(spark, translate.calendar_zh(F.lit("Grand opening of something"))) is None
    assert value(spark, translate.plan_label_zh(F.lit("COMP1511 or COMP1911"))) == "COMP1511 或 COMP1911"
    url = "https://x/3707 - Bachelor Engineering (Honours) - Aerospace Engineering - AEROAH - T1 2026 Start.pdf"
    label = value(spark, translate.plan_variant_label(F.lit(url)))
    assert label == "Aerospace Engineering · T1 2026 入学"
    assert value(spark, translate.plan_variant_zh(F.lit(label))) == "航空航天工程 · T1 2026 入学"


def test_formatting(spark):
    assert value(spark, labels.money_text(F.lit(34470.0), F.lit("GBP"))) == "£34,470"
    assert value(spark, labels.money_text(F.lit(1234.5), F.lit("AUD"))) == "A$1,234.5"
    now = F.lit("2026-01-01 12:00:00").cast("timestamp_ntz")
    assert value(spark, labels.days_left(F.lit("2026-01-03 00:00:00").cast("timestamp_ntz"), now)) == 2


def test_snapshot_files(spark, tmp_path):
    import gzip

    folder = tmp_path / "gla" / "term_dates"
    folder.mkdir(parents=True)
    with gzip.open(folder / "a.html.gz", "wb") as out:
        out.write(b"<p>x\n\xff y</p>")
    (folder / "b.html").write_bytes(b"<p>plain</p>")
    rows = {r["content_path"].rsplit("/", 1)[1]: r for r in feeds.read_snapshot_files(spark, f"{tmp_path}/*/*/*").collect()}
    assert rows["a.html.gz"]["school"] == "gla" and rows["a.html.gz"]["category"] == "term_dates"
    assert rows["a.html.gz"]["html"] == "<p>x\n� y</p>" and rows["b.html"]["html"] == "<p>plain</p>"


def test_character_references_as_browsers_read_them(spark):
    import html as language

    texts = [
        "&lbrack;a&rbrack;", "&pound 5 &pound5", "&#146;s &#x80;", "&#038;lt; &lt;", "&amp;amp; &nbsp;x", "&foo; &", "a&b",
        "&#0; &#xD800;", "&notin; &not", "&copy2024", "&NotEqualTilde;",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(html.unescape(F.col("t"))).collect()] == [language.unescape(t) for t in texts]


def test_section_text_ends_at_headings_of_level_two_to_four(spark):
    page = "<h2>Entry requirements</h2><h5>UK</h5><p>AAB in three subjects</p><h2>Fees</h2><p>No</p>"
    staged = "<h2>Entry requirements</h2><h3>Home</h3><p>AAB in three subjects</p><h3>Fees</h3><p>No</p>"
    frame = spark.createDataFrame([(page, None), (staged, None), (staged, "Fees")], "h string, stop string")
    found = [r[0] for r in frame.select(html.section_text(F.col("h"), F.lit("Entry requirements"), F.col("stop"))).collect()]
    # Without text under the heading and without a stop pattern, the lines behind it count.
    assert found == ["AAB in three subjects", "Home AAB in three subjects", "AAB in three subjects"]
