"""Term-date pages to calendar events.

Input pages are (page_id, school, category, url, html, text) from
``extraction.prepared``. Output rows: page_id, school, academic_year,
calendar_track, event_type, name, start_date, end_date. Windows run inside one
page, so a group is never larger than the page it came from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalodge.functions import dates, rules
from catalodge.functions.text import blank_to_null, let, norm_ws
from catalodge.operators import ordered
from catalodge.operators.lines import label_value_pairs
from catalodge.plans import site_rules
from catalodge.sources import elements, html

TABLE_SCHEMA = (
    "school string, page_re string, year_from string, year_re string, name_cell int, date_cell int, end_cell int, min_cells int"
)
LINE_SCHEMA = "school string, page_re string, year_re string, label_mode string, section_re string, skip_re string"

# Whole sentences of one site -> short names.
SENTENCE_NAMES = {
    "For undergraduates, the summer student vacation begins on": "Summer vacation begins (UG)",
    "For taught postgraduates, the summer research period begins on": "Summer research period begins (PGT)",
}


def table_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(site_rules.TERM_TABLES, TABLE_SCHEMA)


def line_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(site_rules.TERM_LINES, LINE_SCHEMA)


def _term_pages(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("category") == site_rules.TERMS)


def _ruled(pages: DataFrame, rules_table: DataFrame) -> DataFrame:
    fits = F.col("page_re").isNull() | F.regexp_like(F.col("url"), F.col("page_re"))
    return _term_pages(pages).join(rules_table, "school").filter(fits)


def _year_label(text: Column, pattern: Column) -> Column:
    """'2025/26' from two captured groups, '2026' from one."""
    first = F.call_function("regexp_extract", text, pattern, F.lit(1))
    return F.when(
        F.regexp_like(text, pattern),
        F.when(F.regexp_like(pattern, F.lit(r"\)[^()]*\([^?]")), F.concat_ws("/", first, F.call_function("regexp_extract", text, pattern, F.lit(2)))).otherwise(first),
    )


def _event(name: Column, start: Column) -> Column:
    return rules.event_type(name, start)


# ``pos`` is the place of an event on its page: of several with one key the last one holds.
OUTPUT = ["page_id", "school", "academic_year", "calendar_track", "event_type", "name", "start_date", "end_date", "pos"]
ROW_PLACE = "CAST(table_no AS BIGINT) * 1000000 + row_no"


# ---- tables -----------------------------------------------------------------------------


def from_tables(pages: DataFrame, rules_table: DataFrame) -> DataFrame:
    """Events from tables with one event per row; the year comes from headings, caption or text.

    A table under a heading without a year keeps the last year seen on its page.
    Names that occur twice on a page under 'Semester n' headings get the semester in front.
    """
    kept = ["page_id", "school", "text", "year_from", "year_re", "name_cell", "date_cell", "end_cell", "min_cells"]
    rows = elements.page_cells(_ruled(pages, rules_table), *kept).filter(~F.col("is_header"))
    source = (
        F.when(F.col("year_from") == "heading", F.col("heading")).when(F.col("year_from") == "caption", F.col("caption")).otherwise(F.col("text"))
    )
    track = rules.ordered(
        [((F.col("school") == s) & F.col("heading").contains(word), F.lit(t)) for s, word, t in site_rules.TRACKS], "standard"
    )
    rows = rows.withColumn("own_year", _year_label(source, F.col("year_re"))).withColumn("calendar_track", track)
    rows = ordered.last_known(rows, ["page_id"], ["table_no", "row_no"], {"own_year": "academic_year"})
    # A caption names the year of its own table only.
    year = F.when(F.col("year_from") == "caption", F.col("own_year")).otherwise(F.col("academic_year"))
    n = F.size("cells")

    def cell(index: Column) -> Column:
        return F.get(F.col("cells"), F.when(index < 0, n + index).otherwise(index))

    day = cell(F.col("date_cell"))
    span = F.when(
        F.col("end_cell").isNull(), dates.date_range(day)
    ).otherwise(F.struct(dates.loose_date(day).alias("start"), dates.loose_date(cell(F.col("end_cell"))).alias("end")))
    shaped = rows.filter((n >= F.col("min_cells")) & year.isNotNull()).select(
        "page_id", "school", "heading", year.alias("academic_year"), "calendar_track", "year_from",
        cell(F.col("name_cell")).alias("name"), span.alias("span"), F.expr(ROW_PLACE).alias("pos"),
    )
    twice = F.count(F.lit(1)).over(Window.partitionBy("page_id", "name")) > 1
    semester = F.col("heading").rlike(r"^Semester \d$") & ~F.contains(F.col("name"), F.col("heading"))
    named = F.when(twice & semester, F.concat_ws(" ", "heading", "name")).otherwise(F.col("name"))
    start = F.col("span.start")
    plain = _event(F.col("name"), start)
    exam = F.when(F.lower("name").contains("resit"), "resit_period").otherwise("exam_period")
    is_exam_page = F.col("year_from") == "caption"
    exam_name = F.concat(norm_ws(F.regexp_replace("name", r"\s*\[\d\]", "")), F.lit(" 考试期"))
    return shaped.withColumn("shown", named).filter(start.isNotNull() & (F.col("name") != "")).select(
        "page_id", "school", "academic_year", "calendar_track", F.when(is_exam_page, exam).otherwise(plain).alias("event_type"),
        F.when(is_exam_page, exam_name).otherwise(F.col("shown")).alias("name"), start.alias("start_date"), F.col("span.end").alias("end_date"),
        "pos",
    )


def from_matrix(pages: DataFrame) -> DataFrame:
    """Events from tables whose header row names one academic year per column."""
    tables = _term_pages(pages).select("page_id", "school", F.explode(elements.tables(F.col("html"))).alias("t"))
    years = F.transform(F.get("t.rows", F.lit(0))["cells"], lambda c: _year_label(c, F.lit(r"(20\d{2})/(\d{2})")))
    rows = tables.select("page_id", "school", "t.table_no", years.alias("years"), F.explode("t.rows").alias("r")).filter("r.row_no > 0")
    cells = rows.select(
        "page_id", "school", "table_no", "r.row_no", "years", F.get("r.cells", F.lit(0)).alias("name"), F.posexplode("r.cells").alias("at", "cell")
    )
    spans = cells.filter("at > 0").select(
        "page_id", "school", F.get("years", F.col("at")).alias("academic_year"), "name", dates.date_range(F.col("cell")).alias("span"),
        (F.expr(ROW_PLACE) * 1000 + F.col("at")).alias("pos"),
    )
    start = F.col("span.start")
    return spans.filter(F.col("academic_year").isNotNull() & start.isNotNull()).select(
        "page_id", "school", "academic_year", F.lit("standard").alias("calendar_track"), _event(F.col("name"), start).alias("event_type"),
        "name", start.alias("start_date"), F.col("span.end").alias("end_date"), "pos",
    )


def from_blocks(pages: DataFrame) -> DataFrame:
    """Teaching blocks with the breaks between them: '[welcome,] start, end, break name, ...' rows.

    Blocks are numbered per table; a break lasts from the end of its block to the start of the next.
    """
    rows = elements.page_cells(_term_pages(pages), "page_id", "school").filter(~F.col("is_header"))
    welcome = F.size("cells") >= 5
    at = lambda i: F.get("cells", F.lit(i))
    shaped = rows.select(
        "page_id", "school", "table_no", "row_no", F.coalesce(blank_to_null(F.col("heading")), F.lit("Semester")).alias("season"),
        dates.loose_date(F.when(welcome, at(1)).otherwise(at(0))).alias("start_date"),
        dates.loose_date(F.when(welcome, at(2)).otherwise(at(1))).alias("end_date"),
        blank_to_null(F.when(welcome, at(3)).otherwise(at(2))).alias("break_name"),
        F.when(welcome, dates.date_range(at(0))).alias("welcome"),
    ).filter(F.col("start_date").isNotNull()).withColumn("academic_year", dates.academic_year(F.col("start_date")))
    keys, order = ["page_id", "table_no"], ["row_no"]
    numbered = ordered.number_rows(shaped, keys, order, "block")
    numbered = ordered.neighbour(numbered, keys, order, {"start_date": "next_start"}, following=True)

    def event(kind: str, name: Column, start: Column, end: Column) -> Column:
        return F.struct(F.lit(kind).alias("event_type"), name.alias("name"), start.alias("start_date"), end.alias("end_date"))

    items = F.array(
        F.when(
            F.col("welcome.start").isNotNull(), event("welcome_week", F.lit("Welcome week"), F.col("welcome.start"), F.col("welcome.end"))
        ),
        event("teaching_period", F.concat(F.col("season"), F.lit(" 教学段"), F.col("block").cast("string")), F.col("start_date"), F.col("end_date")),
        F.when(
            F.col("break_name").isNotNull() & F.col("next_start").isNotNull(),
            event("closure", F.col("break_name"), F.col("end_date"), F.col("next_start")),
        ),
    )
    return numbered.select(
        "page_id", "school", "academic_year", F.lit("standard").alias("calendar_track"), F.expr(ROW_PLACE).alias("place"),
        F.posexplode(F.filter(items, lambda e: e.isNotNull())).alias("at", "e"),
    ).select("*", "e.*", (F.col("place") * 10 + F.col("at")).alias("pos")).select(*OUTPUT)


def from_yearless_rows(pages: DataFrame, year: Column) -> DataFrame:
    """Rows 'date without year | label' under semester headings; the year is the entry year of the site."""
    rows = elements.page_cells(_term_pages(pages).withColumn("year", year), "page_id", "school", "year")
    rows = rows.filter((F.size("cells") >= 2) & F.get("cells", F.lit(0)).rlike(r"\d{1,2} \w{3}"))
    found = F.regexp_extract_all(F.get("cells", F.lit(0)), F.lit(r"\d{1,2} \w{3,9}"), F.lit(0))
    semester = F.regexp_extract("heading", r"(Semester [12]|Summer|Winter|Trimester \d|Study Period \d+)", 1)
    label = F.get("cells", F.lit(1))
    shaped = rows.select(
        "page_id", "school", F.col("year").alias("academic_year"), label.alias("label"), semester.alias("semester"),
        dates.loose_date(F.concat_ws(" ", F.get(found, F.lit(0)), "year")).alias("start_date"),
        dates.loose_date(F.concat_ws(" ", F.element_at(found, -1), "year")).alias("end_date"), F.expr(ROW_PLACE).alias("pos"),
    )
    name = F.when(F.col("semester") == "", F.col("label")).otherwise(F.concat(F.col("label"), F.lit("（"), F.col("semester"), F.lit("）")))
    return shaped.filter(F.col("start_date").isNotNull() & (F.col("label") != "")).select(
        "page_id", "school", "academic_year", F.lit("standard").alias("calendar_track"),
        _event(F.col("label"), F.col("start_date")).alias("event_type"), name.alias("name"), "start_date",
        F.coalesce("end_date", "start_date").alias("end_date"), "pos",
    )


def from_begin_end_rows(pages: DataFrame) -> DataFrame:
    """Rows 'DD Mon event | year': rows that end something close the interval of the same event."""
    rows = elements.page_cells(_term_pages(pages), "page_id", "school")
    year = F.element_at("cells", -1)
    pattern = r"^(\d{1,2} \w{3,9})\s+(.{3,90})$"
    rows = rows.filter((F.size("cells") >= 2)).filter(year.rlike(r"^20\d{2}$") & F.get("cells", F.lit(0)).rlike(pattern))
    first = F.get("cells", F.lit(0))
    label = norm_ws(F.regexp_extract(first, pattern, 2))
    points = rows.select(
        "page_id", "school", year.alias("academic_year"), label.alias("label"),
        F.regexp_replace(label, r"\s*(ends|period ends)$", "").alias("name"),
        dates.loose_date(F.concat_ws(" ", F.regexp_extract(first, pattern, 1), year)).alias("day"),
        (F.col("table_no") * 1000000 + F.col("row_no")).alias("pos"),
    ).filter(F.col("day").isNotNull())
    merged = ordered.merge_begin_end(
        points, ["page_id", "school", "academic_year", "name"], "pos", "day", F.col("label") != F.col("name")
    )
    return merged.select(
        "page_id", "school", "academic_year", F.lit("standard").alias("calendar_track"),
        _event(F.col("name"), F.col("start_date")).alias("event_type"), "name", "start_date", "end_date", F.lit(0).cast("long").alias("pos"),
    )


# ---- points that open and close intervals --------------------------------------------------

POINTS = "array<struct<day:date,text:string>>"
EVENTS = "array<struct<name:string,start_date:date,end_date:date>>"
OPENS = "array<struct<name:string,day:date>>"


def _table_points(rows: Column) -> Column:
    """struct<points, ranges> of a date table: 'year | month | weekday | day | event | event' or 'date | event' rows."""
    text = F.lit(None).cast("string")
    start = F.struct(
        text.alias("year"), text.alias("month"), F.array().cast(POINTS).alias("points"), F.array().cast(EVENTS).alias("ranges")
    )
    span_re = r"^\w+ (\d{1,2})(?: (\w+))?(?: (\d{4}))? ?- ?\w+ (\d{1,2}) (\w+) (\d{4})$"
    single_re = r"^\w+ (\d{1,2} \w+ \d{4})$"

    def step(acc: Column, row: Column) -> Column:
        cells = row["cells"]
        cell = lambda i: F.get(cells, F.lit(i))
        long_row, short_row = F.size(cells) >= 5, F.size(cells) == 2
        year = F.when(long_row, F.coalesce(blank_to_null(cell(0)), acc["year"])).otherwise(acc["year"])
        month = F.when(long_row, F.coalesce(blank_to_null(cell(1)), acc["month"])).otherwise(acc["month"])
        day = F.when(long_row & cell(3).rlike("^[0-9]+$"), dates.parse_date(F.concat_ws(" ", cell(3), month, year))).when(
            short_row, dates.parse_date(F.regexp_extract(cell(0), single_re, 1))
        )
        texts = F.when(long_row, F.slice(cells, 5, 2)).when(short_row, F.slice(cells, 2, 1)).otherwise(F.array().cast("array<string>"))
        added = let(
            day,
            lambda d: F.transform(
                F.filter(texts, lambda t: (t != "") & d.isNotNull()), lambda t: F.struct(d.alias("day"), t.alias("text"))
            ),
        )
        part = lambda g: F.regexp_extract(cell(0), span_re, g)
        spanned = F.struct(
            cell(1).alias("name"),
            dates.parse_date(F.concat_ws(" ", part(1), F.coalesce(blank_to_null(part(2)), part(5)), F.coalesce(blank_to_null(part(3)), part(6)))).alias("start_date"),
            dates.parse_date(F.concat_ws(" ", part(4), part(5), part(6))).alias("end_date"),
        )
        ranges = F.filter(
            F.when(short_row & cell(0).rlike(span_re), F.array(spanned)).otherwise(F.array().cast(EVENTS)),
            lambda e: e["start_date"].isNotNull() & e["end_date"].isNotNull(),
        )
        return F.struct(
            year.alias("year"), month.alias("month"), F.concat(acc["points"], added.cast(POINTS)).alias("points"),
            F.concat(acc["ranges"], ranges).alias("ranges"),
        )

    return F.aggregate(rows, start, step)


def _paired(points: Column) -> Column:
    """Close each 'End of X' with the first open start whose name begins with X or begins X; leftovers stay."""
    opened = F.array().cast(OPENS)
    start = F.struct(opened.alias("opens"), F.array().cast(EVENTS).alias("events"))
    begin_re, begins_re = r"^Start of (.+)$", r"^(.+?) starts$"
    end_re, ends_re = r"^End of (.+?)(?: / .*)?$", r"^(.+?) ends$"

    def name_by(text: Column, *patterns: str) -> Column:
        return F.coalesce(*[blank_to_null(F.trim(F.regexp_extract(text, p, 1))) for p in patterns])

    def event(name: Column, first: Column, last: Column) -> Column:
        return F.array(F.struct(name.alias("name"), first.alias("start_date"), last.alias("end_date"))).cast(EVENTS)

    def step(acc: Column, point: Column) -> Column:
        opens, events = acc["opens"], acc["events"]
        nothing = F.lit(None).cast("date")

        def placed(keys: Column) -> Column:
            opening, closing = keys["opening"], F.lower(keys["closing"])
            fits = F.transform(opens, lambda o: F.startswith(F.lower(o["name"]), closing) | F.startswith(closing, F.lower(o["name"])))
            at = F.when(closing.isNotNull(), F.array_position(fits, F.lit(True))).otherwise(F.lit(0)).cast("int")
            hit = F.get(opens, at - 1)
            remaining = F.filter(opens, lambda _o, i: i != at - 1)
            return (
                F.when(
                    opening.isNotNull(),
                    F.struct(
                        F.concat(opens, F.array(F.struct(opening.alias("name"), point["day"].alias("day"))).cast(OPENS)).alias("opens"),
                        events.alias("events"),
                    ),
                )
                .when(
                    at > 0,
                    F.struct(remaining.alias("opens"), F.concat(events, event(hit["name"], hit["day"], point["day"])).alias("events")),
                )
                .otherwise(
                    F.struct(opens.alias("opens"), F.concat(events, event(point["text"], point["day"], nothing)).alias("events"))
                )
            )

        keys = F.struct(
            name_by(point["text"], begin_re, begins_re).alias("opening"), name_by(point["text"], end_re, ends_re).alias("closing")
        )
        return let(keys, placed)

    def finish(acc: Column) -> Column:
        left = F.transform(
            acc["opens"],
            lambda o: F.struct(
                F.concat(F.lit("Start of "), o["name"]).alias("name"), o["day"].alias("start_date"), F.lit(None).cast("date").alias("end_date")
            ),
        )
        return F.concat(acc["events"], left.cast(EVENTS))

    return F.aggregate(points, start, step, finish)


def _told_apart(events: Column) -> Column:
    """In order of start: a name that was used before gets its month."""
    by_start = F.array_sort(
        events, lambda a, b: F.datediff(a["start_date"], b["start_date"])
    )

    def renamed(sorted_events: Column) -> Column:
        names = F.transform(sorted_events, lambda e: e["name"])
        return F.transform(
            sorted_events,
            lambda e, i: F.struct(
                F.when(F.array_position(names, e["name"]) == i + 1, e["name"])
                .otherwise(F.concat(e["name"], F.lit(" ("), F.date_format(e["start_date"], "MMM"), F.lit(")")))
                .alias("name"),
                e["start_date"].alias("start_date"),
                e["end_date"].alias("end_date"),
            ),
        )

    return let(by_start, renamed)


def from_points(pages: DataFrame) -> DataFrame:
    """Session pages whose first table lists points in time; the year is named in the URL.

    Everything happens inside the row of a page: one fold collects the points and
    carries year and month down, a second one pairs starts with ends.
    """
    session_re = r"session(\d{4})-(\d{2})/?$"
    found = _term_pages(pages).filter(F.col("url").rlike(session_re))
    year = F.concat_ws("/", F.regexp_extract("url", session_re, 1), F.regexp_extract("url", session_re, 2))
    first_table = F.get(elements.tables(F.col("html")), F.lit(0))["rows"]
    events = let(
        _table_points(first_table), lambda p: _told_apart(F.concat(_paired(p["points"]), p["ranges"]))
    )
    rows = found.select("page_id", "school", year.alias("academic_year"), F.posexplode(events).alias("at", "e")).select("*", "e.*")
    return rows.select(
        "page_id", "school", "academic_year", F.lit("standard").alias("calendar_track"),
        _event(F.col("name"), F.col("start_date")).alias("event_type"), "name", "start_date", "end_date", F.col("at").cast("long").alias("pos"),
    )


# ---- lines ------------------------------------------------------------------------------------


def from_lines(pages: DataFrame, rules_table: DataFrame) -> DataFrame:
    """Events from loose lines: a year line opens a year, a dated line is an event.

    Its name stands before a colon, in the line itself, or in the last plain line
    since the previous event. A year line also ends the section and the pending label.
    """
    ruled = _ruled(pages, rules_table)
    lines = ruled.select(
        "page_id", "school", "year_re", "label_mode", "section_re", "skip_re", F.posexplode(F.split("text", "\n")).alias("line_no", "raw")
    ).withColumn("line", norm_ws(F.col("raw"))).filter(F.col("line") != "")
    year = _year_label(F.col("line"), F.col("year_re"))
    lines = lines.withColumn("own_year", year)
    by_page = Window.partitionBy("page_id").orderBy("line_no")
    lines = lines.withColumn("academic_year", F.last("own_year", True).over(by_page)).withColumn(
        "run", F.count("own_year").over(by_page)
    )
    is_year = F.col("own_year").isNotNull() & (F.col("label_mode") != "own")
    is_section = F.coalesce(F.regexp_like(F.col("line"), F.col("section_re")), F.lit(False))
    # A site whose year is a plain number leaves it out of its date ranges.
    dated = F.when(
        F.col("academic_year").rlike("^[0-9]{4}$") & ~F.col("line").rlike("20[0-9]{2}"),
        F.regexp_replace(
            "line", F.lit(r"(\d{1,2} \w+)\s*(-|–|to)\s*(\d{1,2} \w+)"),
            F.concat(F.lit("$1 "), F.col("academic_year"), F.lit(" $2 $3 "), F.col("academic_year")),
        ),
    ).otherwise(F.col("line"))
    after_colon = F.regexp_extract(dated, r"^[^:]*:(.*)$", 1)
    read = F.when(F.col("label_mode") == "colon", after_colon).otherwise(dated)
    lines = lines.withColumn("is_section", is_section).withColumn("is_year", is_year).withColumn("span", dates.date_range(read))
    is_event = F.col("span.start").isNotNull() & ~F.col("is_year") & ~F.col("is_section")
    lines = lines.withColumn("is_event", is_event)
    by_run = Window.partitionBy("page_id", "run").orderBy("line_no")
    lines = lines.withColumn("section", F.last(F.when(F.col("is_section"), F.col("line")), True).over(by_run))
    before = by_run.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("segment", F.coalesce(F.sum(F.col("is_event").cast("int")).over(before), F.lit(0)))
    plain = ~F.col("is_event") & ~F.col("is_section") & ~F.col("is_year")
    usable = plain & F.char_length("line").between(3, 60) & ~F.col("line").rlike(r"\d{4}")
    by_segment = Window.partitionBy("page_id", "run", "segment").orderBy("line_no")
    lines = lines.withColumn("pending", F.last(F.when(usable, F.rtrim("line", F.lit(":"))), True).over(by_segment))

    own = blank_to_null(F.regexp_replace(F.regexp_replace("line", r"\d{1,2}.*$", ""), r"^[ :-]+|[ :-]+$", ""))
    own = F.coalesce(own, F.lit("Term date"))
    for sentence, short in SENTENCE_NAMES.items():
        own = F.when(own == sentence, short).otherwise(own)
    label = norm_ws(F.regexp_extract("line", r"^([^:]*):", 1))
    with_section = F.concat_ws(" ", "section", label)
    seasonal = F.col("section").rlike("(?i)exam|resit") & F.col("pending").rlike("(?i)^(Autumn|Spring|Summer|Winter)")
    name = (
        F.when(F.col("label_mode") == "colon", F.when(label != "", with_section))
        .when(F.col("label_mode") == "own", own)
        .otherwise(F.when(seasonal, F.concat_ws(" ", "pending", "section")).otherwise(F.col("pending")))
    )
    skipped = F.coalesce(F.regexp_like(label, F.col("skip_re")), F.lit(False))
    start = F.col("span.start")
    events = lines.withColumn("name", name).filter(
        F.col("is_event") & F.col("academic_year").isNotNull() & F.col("name").isNotNull() & ~skipped
    )
    return events.select(
        "page_id", "school", "academic_year", F.lit("standard").alias("calendar_track"), _event(F.col("name"), start).alias("event_type"),
        "name", start.alias("start_date"), F.col("span.end").alias("end_date"), F.col("line_no").cast("long").alias("pos"),
    )


def from_date_then_label(pages: DataFrame, default_year: Column) -> DataFrame:
    """Pairs of a date line ('23 February') and the label line behind it; the year stands in the label."""
    date_re = r"^\d{1,2} \w{3,9}( – \d{1,2} \w{3,9})?$"
    clean = F.filter(F.transform(F.split("text", "\n"), lambda x: norm_ws(x)), lambda x: x != "")
    pairs = let(clean, lambda lines: label_value_pairs(lines, lambda line: line.rlike(date_re)))
    rows = _term_pages(pages).withColumn("default_year", default_year).select("page_id", "school", "default_year", F.inline(pairs))
    rows = rows.filter((F.char_length("value") <= 120) & ~F.col("value").rlike(date_re))
    year = F.coalesce(blank_to_null(F.regexp_extract("value", r"\b(20\d{2})\b", 1)), F.col("default_year"))
    parts = F.split("label", r"\s*–\s*")
    shaped = rows.select(
        "page_id", "school", year.alias("academic_year"), F.col("value").alias("name"),
        dates.loose_date(F.concat_ws(" ", F.get(parts, F.lit(0)), year)).alias("start_date"),
        dates.loose_date(F.concat_ws(" ", F.element_at(parts, -1), year)).alias("end_date"), F.col("line_no").cast("long").alias("pos"),
    )
    return shaped.filter(F.col("start_date").isNotNull()).select(
        "page_id", "school", "academic_year", F.lit("standard").alias("calendar_track"),
        _event(F.col("name"), F.col("start_date")).alias("event_type"), "name", "start_date",
        F.coalesce("end_date", "start_date").alias("end_date"), "pos",
    )


# Which layout a school uses; the remaining schools have rules for tables or lines.
MATRIX_SCHOOLS, BLOCK_SCHOOLS, POINT_SCHOOLS = ("bristol",), ("shef",), ("gla",)
YEARLESS_SCHOOLS, BEGIN_END_SCHOOLS, DATE_LABEL_SCHOOLS = ("adel",), ("anu",), ("uwa",)


def calendar_events(pages: DataFrame, spark: SparkSession, year: str = "2026") -> DataFrame:
    """All events of all layouts."""
    of = lambda schools: pages.filter(F.col("school").isin(*schools))
    parts = [
        from_tables(pages, table_rules(spark)), from_lines(pages.filter(~F.col("url").contains("examination_dates")), line_rules(spark)),
        from_matrix(of(MATRIX_SCHOOLS)), from_blocks(of(BLOCK_SCHOOLS)), from_points(of(POINT_SCHOOLS)),
        from_yearless_rows(of(YEARLESS_SCHOOLS), F.lit(year)), from_begin_end_rows(of(BEGIN_END_SCHOOLS)),
        from_date_then_label(of(DATE_LABEL_SCHOOLS), F.lit(year)),
    ]
    out = parts[0].select(*OUTPUT)
    for part in parts[1:]:
        out = out.unionByName(part.select(*OUTPUT))
    return out
