"""Data-quality measures: coverage, duplicates, thresholds and the scorecard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalodge.functions.rules import is_junk_name, is_runaway

GREEN, YELLOW, RED = "✓", "△", "✗"

# ---- Fixed values: default thresholds --------------------------------------------
DEFAULTS = {
    "modules_min": 1,
    "module_url_pct": 90,
    "module_zh_pct": 90,
    "module_faculty_pct": 60,
    "programs_min": 100,
    "program_faculty_pct": 90,
    "calendar_future": 1,
    "exam_periods": 1,
    "dead_src_pct": 25,
}
# -----------------------------------------------------------------------------------


def percent(part: Column, whole: Column) -> Column:
    """Whole percent, halves rounded away from zero; NULL of nothing."""
    return F.round(100.0 * part / F.nullif(whole, F.lit(0))).cast("int")


def coverage(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per group: row count and the percent of non-NULL values of each column."""
    total = F.count(F.lit(1))
    return df.groupBy(*keys).agg(
        total.alias("n_rows"), *[percent(F.count(c), total).alias(f"{c}_pct") for c in columns]
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def thresholds(schools: DataFrame, overrides: DataFrame, school: str, defaults: dict[str, int] | None = None) -> DataFrame:
    """(school, rule_key, threshold): the school's own value, else the default."""
    items = (defaults or DEFAULTS).items()
    rules = F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k, _ in items]), F.array(*[F.lit(v) for _, v in items])))
    grid = schools.select(school, rules.alias("rule_key", "default_value"))
    return grid.join(overrides, [school, "rule_key"], "left").select(
        school, "rule_key", F.coalesce("value", "default_value").alias("threshold")
    )


def measures(
    schools: DataFrame, modules: DataFrame, programs: DataFrame, events: DataFrame, pages: DataFrame, as_of: Column
) -> DataFrame:
    """One wide row of measures per school, one aggregate per table."""
    total = F.count(F.lit(1))
    active_modules = modules.filter("is_active")
    m = active_modules.groupBy("university_id").agg(
        total.alias("n_modules"),
        percent(F.count("url"), total).alias("module_url_pct"),
        percent(F.count("name_zh"), total).alias("module_zh_pct"),
        percent(F.count("faculty_id"), total).alias("module_faculty_pct"),
        F.count_if(is_junk_name(F.col("name_en"))).alias("junk_names"),
        F.count_if(is_runaway(F.col("name_zh"), F.col("name_en"))).alias("runaway"),
    )
    dup = duplicate_keys(
        active_modules.filter("code is not null"), ["university_id", "code", "entry_year"]
    ).groupBy("university_id").agg(total.alias("duplicate_codes"))
    p = programs.filter("is_active").groupBy("university_id").agg(
        total.alias("n_programs"), percent(F.count("faculty_id"), total).alias("program_faculty_pct")
    )
    future = F.col("start_date") >= as_of
    e = events.groupBy("university_id").agg(
        F.count_if(future).alias("future_events"),
        F.count_if(future & F.col("event_type").isin("exam_period", "resit_period")).alias("future_exams"),
    )
    s = pages.groupBy("university_id").agg(
        F.count_if(
            (F.col("status") == "active") & (F.col("crawl_freq") != "manual") & F.col("last_fetched_at").isNull()
        ).alias("never_fetched"),
        percent(F.count_if(F.col("status") == "dead"), total).alias("dead_pct"),
    )
    out = schools
    for part in (m, dup, p, e, s):
        out = out.join(part, "university_id", "left")
    zero = ["n_modules", "junk_names", "runaway", "duplicate_codes", "n_programs", "future_events", "future_exams",
            "never_fetched", "dead_pct"]
    return out.fillna(0, subset=zero)


def scorecard(wide: DataFrame, limits: DataFrame) -> DataFrame:
    """(school, rule_no, rule, actual, light) from measures and thresholds.

    ``limits`` is (university_id, rule_key, threshold); ``wide`` may carry
    ``modules_skip`` (reason text: the whole module block becomes one yellow row)
    and ``exam_skip`` (a red exam rule becomes yellow). Rules that depend on rows
    are left out where there are none.
    """
    skip = F.col("modules_skip") if "modules_skip" in wide.columns else F.lit(None).cast("string")
    exam_skip = F.col("exam_skip") if "exam_skip" in wide.columns else F.lit(False)
    have_modules = skip.isNull() & (F.col("n_modules") > 0)
    have_programs = F.col("n_programs") > 0
    always = F.lit(True)

    def rule(no: int, name: str, key: str | None, sense: str, actual: str, applies: Column) -> Column:
        return F.struct(
            F.lit(no).alias("rule_no"),
            F.lit(name).alias("rule"),
            F.lit(key).cast("string").alias("rule_key"),
            F.lit(sense).alias("sense"),
            F.col(actual).cast("long").alias("actual"),
            F.coalesce(applies, F.lit(False)).alias("applies"),
        )

    rules = F.array(
        rule(1, "modules", "modules_min", "min", "n_modules", skip.isNull()),
        rule(2, "module url %", "module_url_pct", "min", "module_url_pct", have_modules),
        rule(3, "module zh %", "module_zh_pct", "min", "module_zh_pct", have_modules),
        rule(4, "module faculty %", "module_faculty_pct", "min", "module_faculty_pct", have_modules),
        rule(5, "junk names", None, "zero", "junk_names", have_modules),
        rule(6, "duplicate codes", None, "zero", "duplicate_codes", have_modules),
        rule(7, "runaway translations", None, "zero", "runaway", have_modules),
        rule(8, "programs", "programs_min", "min", "n_programs", always),
        rule(9, "program faculty %", "program_faculty_pct", "min", "program_faculty_pct", have_programs),
        rule(10, "future events", "calendar_future", "min", "future_events", always),
        rule(11, "future exams", "exam_periods", "min", "future_exams", always),
        rule(12, "never fetched", None, "zero", "never_fetched", always),
        rule(13, "dead pages %", "dead_src_pct", "max", "dead_pct", always),
    )
    rows = wide.select("university_id", exam_skip.alias("exam_skip"), F.explode(rules).alias("r")).select(
        "university_id", "exam_skip", "r.*"
    ).filter("applies")
    judged = rows.join(limits, ["university_id", "rule_key"], "left")
    ok = (
        F.when(F.col("sense") == "min", F.col("actual") >= F.col("threshold"))
        .when(F.col("sense") == "max", F.col("actual") <= F.col("threshold"))
        .otherwise(F.col("actual") == 0)
    )
    light = F.when(ok, GREEN).when((F.col("rule_no") == 11) & F.col("exam_skip"), YELLOW).otherwise(RED)
    out = judged.select("university_id", "rule_no", "rule", F.col("actual").cast("string").alias("actual"), light.alias("light"))
    if "modules_skip" in wide.columns:
        skipped = wide.filter(skip.isNotNull()).select(
            "university_id", F.lit(1).alias("rule_no"), F.lit("modules (skipped)").alias("rule"),
            skip.alias("actual"), F.lit(YELLOW).alias("light"),
        )
        out = out.unionByName(skipped)
    return out


def red_total(card: DataFrame) -> DataFrame:
    """The gate: how many red lights there are."""
    return card.agg(F.count_if(F.col("light") == RED).alias("reds"))
