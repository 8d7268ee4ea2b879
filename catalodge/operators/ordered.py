"""Ordered operators over key groups that may be far larger than one task can hold.

A plain window sends a whole key to one task. Every operator here takes a
``bucket`` column instead: an expression of the order columns that never
decreases along the order (a day, a month, a range of numbers). Rows are then
windowed inside (key, bucket), and only one summary row per bucket crosses
bucket borders. The results equal those of the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalodge.session import materialize

BUCKET = "__bucket"
Names = Sequence[str]


def _bucketed(df: DataFrame, bucket: Column | None) -> DataFrame:
    return df.withColumn(BUCKET, F.lit(0) if bucket is None else bucket)


def _within(keys: Names, order: Names, descending: bool = False):
    by = [F.desc(c) if descending else F.asc(c) for c in order]
    return Window.partitionBy(*keys, BUCKET).orderBy(*by)


def _across(keys: Names, descending: bool = False):
    by = F.desc(BUCKET) if descending else F.asc(BUCKET)
    return Window.partitionBy(*keys).orderBy(by)


def neighbour(
    df: DataFrame,
    keys: Names,
    order: Names,
    columns: dict[str, str],
    bucket: Column | None = None,
    following: bool = False,
) -> DataFrame:
    """Add columns with the value of the row before (or after) in the order of its key.

    ``columns`` maps a source column to the name of the new column.
    """
    rows = _bucketed(df, bucket)
    step = F.lead if following else F.lag
    at_edge = step(F.lit(True), 1, False).over(_within(keys, order)) == F.lit(False)
    out = rows
    for source, name in columns.items():
        out = out.withColumn(name, step(source, 1).over(_within(keys, order)))
    if bucket is None:
        return out.drop(BUCKET)
    out = out.withColumn("__edge", at_edge)

    pick = F.min_by if following else F.max_by
    edge = rows.groupBy(*keys, BUCKET).agg(
        pick(F.struct(*columns), F.struct(*order)).alias("__row")
    )
    carried = edge.withColumn(
        "__carry", F.lag("__row", 1).over(_across(keys, descending=following))
    ).drop("__row")
    out = out.join(carried, [*keys, BUCKET], "left")
    for source, name in columns.items():
        out = out.withColumn(
            name, F.when(F.col("__edge"), F.col(f"__carry.`{source}`")).otherwise(F.col(name))
        )
    return out.drop(BUCKET, "__edge", "__carry")


def last_known(
    df: DataFrame,
    keys: Names,
    order: Names,
    columns: dict[str, str],
    bucket: Column | None = None,
    include_current: bool = True,
) -> DataFrame:
    """Forward fill: the latest non-NULL value of each column up to (or before) a row."""
    rows = _bucketed(df, bucket)
    frame = _within(keys, order).rowsBetween(
        Window.unboundedPreceding, 0 if include_current else -1
    )
    out = rows
    for source, name in columns.items():
        out = out.withColumn(f"__{name}", F.last(source, ignorenulls=True).over(frame))
    if bucket is None:
        for name in columns.values():
            out = out.withColumn(name, F.col(f"__{name}"))
        return out.drop(BUCKET, *[f"__{name}" for name in columns.values()])

    # max_by skips rows whose ordering value is NULL, so NULL values never count.
    tails = rows.groupBy(*keys, BUCKET).agg(
        *[
            F.max_by(source, F.when(F.col(source).isNotNull(), F.struct(*order))).alias(f"__tail_{name}")
            for source, name in columns.items()
        ]
    )
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(
        *keys,
        BUCKET,
        *[F.last(f"__tail_{name}", ignorenulls=True).over(before).alias(f"__carry_{name}") for name in columns.values()],
    )
    out = out.join(carried, [*keys, BUCKET], "left")
    for name in columns.values():
        out = out.withColumn(name, F.coalesce(f"__{name}", f"__carry_{name}"))
    extra = [f"{p}{name}" for name in columns.values() for p in ("__", "__carry_")]
    return out.drop(BUCKET, *extra)


def running_sum(
    df: DataFrame, keys: Names, order: Names, columns: dict[str, str], bucket: Column | None = None
) -> DataFrame:
    """Running totals up to and including each row."""
    rows = _bucketed(df, bucket)
    frame = _within(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows
    for source, name in columns.items():
        out = out.withColumn(name, F.sum(source).over(frame))
    if bucket is None:
        return out.drop(BUCKET)
    totals = rows.groupBy(*keys, BUCKET).agg(
        *[F.sum(source).alias(f"__total_{name}") for source, name in columns.items()]
    )
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, BUCKET,
        *[F.sum(f"__total_{name}").over(before).alias(f"__carry_{name}") for name in columns.values()],
    )
    out = out.join(carried, [*keys, BUCKET], "left")
    for name in columns.values():
        out = out.withColumn(name, F.col(name) + F.coalesce(f"__carry_{name}", F.lit(0)))
    return out.drop(BUCKET, *[f"__carry_{name}" for name in columns.values()])


def number_rows(
    df: DataFrame, keys: Names, order: Names, name: str, bucket: Column | None = None
) -> DataFrame:
    """1, 2, 3, ... in the order of each key."""
    rows = _bucketed(df, bucket)
    out = rows.withColumn(name, F.row_number().over(_within(keys, order)).cast("long"))
    if bucket is None:
        return out.drop(BUCKET)
    counts = rows.groupBy(*keys, BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select(*keys, BUCKET, F.sum("__n").over(before).alias("__offset"))
    out = out.join(carried, [*keys, BUCKET], "left")
    return out.withColumn(name, F.col(name) + F.coalesce("__offset", F.lit(0))).drop(BUCKET, "__offset")


def number_all(df: DataFrame, order: Names, name: str) -> DataFrame:
    """1, 2, 3, ... in an order of the whole table, with no task that sees all rows.

    Rows are dealt into ranges of the order and written sorted; a row's number in its
    range is moved by the sizes of the ranges before. Only one count for each range meets
    in one task.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    # The generated id holds the number of the range, then the row's place in it.
    rows = materialize(ranged.withColumn("__id", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumns({"__range": F.shiftright("__id", 33), "__place": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = rows.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    return rows.join(offsets, "__range").withColumn(name, F.col("__place") + F.col("__offset") + 1).select(*df.columns, name)


def number_in_keys(df: DataFrame, keys: Names, order: Names, name: str, total: str | None = None) -> DataFrame:
    """1, 2, 3, ... in the order of each key, however many rows a key has, and no bucket is needed.

    Rows are dealt into ranges of (key, order) and written sorted, so a large key spans
    several ranges. A row's number is its place among the rows of its key in its range,
    moved by their counts in the ranges before. With ``total``, that column has the number
    of rows of the key. NULL is a key like any other.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in (*keys, *order)]).sortWithinPartitions(*keys, *order)
    rows = materialize(ranged.withColumn("__id", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("__range", F.shiftright("__id", 33))
    counts = rows.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__n"), F.min("__id").alias("__first"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__range").alias("__r"), "__first",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"), F.sum("__n").over(whole).alias("__total"),
    )
    same = rows["__range"] == offsets["__r"]
    for k in keys:
        same = same & rows[k].eqNullSafe(offsets[f"__k_{k}"])
    numbered = rows.join(offsets, same).withColumn(name, F.col("__id") - F.col("__first") + F.col("__offset") + 1)
    numbered = numbered if total is None else numbered.withColumn(total, F.col("__total"))
    return numbered.select(*df.columns, name, *([] if total is None else [total]))


def first_per_key(df: DataFrame, keys: Names, order: Names) -> DataFrame:
    """One row per key: the first in the given order. Partial results are combined before the shuffle."""
    return _one_per_key(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: Names, order: Names) -> DataFrame:
    """One row per key: the last in the given order."""
    return _one_per_key(df, keys, order, F.max_by)


def _one_per_key(df: DataFrame, keys: Names, order: Names, pick) -> DataFrame:
    payload = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        pick(F.struct(*[F.col(f"`{c}`") for c in payload]), F.struct(*order)).alias("__row")
    )
    return best.select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in payload])


def gaps(
    df: DataFrame, keys: Names, start: str, end: str, order: Names, bucket: Column | None = None
) -> DataFrame:
    """Breaks between blocks: from the end of a block to the start of the next one."""
    out = neighbour(df, keys, order, {start: "gap_end"}, bucket, following=True)
    return out.withColumn("gap_start", F.col(end)).filter(F.col("gap_end").isNotNull())


def pair_points(
    df: DataFrame,
    keys: Names,
    order: Names,
    is_start: Column,
    is_end: Column,
    value: str,
    bucket: Column | None = None,
) -> DataFrame:
    """Pair start and end points of each key first-in-first-out.

    Output: keys, kind ('pair', 'open', 'point'), start, end. An end with no start
    open before it stays a single 'point', a start without an end stays 'open'.

    With s and e the running counts of starts and ends, the ends that found no
    start so far number max(0, max over the past of e - s). An end is matched when
    that number did not grow, and its rank among matched ends names its start.
    """
    flagged = df.select(
        *keys, *[c for c in order if c not in keys], F.col(value).alias("__value"),
        is_start.cast("int").alias("__s"), is_end.cast("int").alias("__e"), *([bucket.alias("__b")] if bucket is not None else []),
    ).filter((F.col("__s") + F.col("__e")) > 0)
    bucket_column = F.col("__b") if bucket is not None else None
    rows = _bucketed(flagged, bucket_column).withColumn("__d", F.col("__e") - F.col("__s"))
    frame = _within(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        rows.withColumn("__starts", F.sum("__s").over(frame))
        .withColumn("__ends", F.sum("__e").over(frame))
        .withColumn("__depth", F.sum("__d").over(frame))
    )
    earlier = _within(keys, order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__past", F.max("__depth").over(earlier))
    if bucket is not None:
        summary = rows.groupBy(*keys, BUCKET).agg(
            F.sum("__s").alias("__ts"), F.sum("__e").alias("__te"), F.max("__depth").alias("__tp")
        )
        before = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
        summary = (
            summary.withColumn("__cs", F.coalesce(F.sum("__ts").over(before), F.lit(0)))
            .withColumn("__ce", F.coalesce(F.sum("__te").over(before), F.lit(0)))
            .withColumn("__reach", F.col("__ce") - F.col("__cs") + F.col("__tp"))
            .withColumn("__cp", F.max("__reach").over(before))
            .select(*keys, BUCKET, "__cs", "__ce", "__cp")
        )
        rows = (
            rows.join(summary, [*keys, BUCKET], "left")
            .withColumn("__starts", F.col("__starts") + F.col("__cs"))
            .withColumn("__ends", F.col("__ends") + F.col("__ce"))
            .withColumn("__depth", F.col("__depth") + F.col("__ce") - F.col("__cs"))
            .withColumn(
                "__past", F.greatest(F.col("__past") + F.col("__ce") - F.col("__cs"), F.col("__cp"))
            )
        )
    # An end is lost exactly when its depth lies above zero and above every depth before it.
    floor = F.greatest(F.coalesce("__past", F.lit(0)), F.lit(0))
    rows = rows.withColumn("__is_lost", (F.col("__e") == 1) & (F.col("__depth") > floor))
    rows = rows.withColumn("__lost", F.greatest(floor, F.col("__depth")))
    starts = rows.filter("__s = 1").select(
        *keys, F.col("__starts").alias("__rank"), F.col("__value").alias("start")
    )
    ends = rows.filter((F.col("__e") == 1) & ~F.col("__is_lost")).select(
        *keys, (F.col("__ends") - F.col("__lost")).alias("__rank"), F.col("__value").alias("end")
    )
    paired = starts.join(ends, [*keys, "__rank"], "left").select(
        *keys,
        F.when(F.col("end").isNull(), "open").otherwise("pair").alias("kind"),
        "start",
        "end",
    )
    points = rows.filter("__is_lost").select(
        *keys, F.lit("point").alias("kind"), F.col("__value").alias("start"), F.lit(None).cast(df.schema[value].dataType).alias("end")
    )
    return paired.unionByName(points)


def merge_begin_end(
    df: DataFrame, keys: Names, position: str, day: str, is_end: Column
) -> DataFrame:
    """One interval per key from begin and end rows.

    The last begin row opens it, the last end row behind that closes it; an end
    before any begin does not count, and the end is never before the start.
    """
    spot = F.struct(F.col(position), F.col(day))
    folded = df.groupBy(*keys).agg(
        F.max(F.when(~is_end, spot)).alias("__begin"), F.max(F.when(is_end, spot)).alias("__end")
    )
    begin, end = F.col(f"__begin.{day}"), F.col(f"__end.{day}")
    closes = F.col(f"__end.{position}") > F.col(f"__begin.{position}")
    return folded.filter(F.col("__begin").isNotNull()).select(
        *keys, begin.alias("start_date"), F.when(closes, F.greatest(begin, end)).otherwise(begin).alias("end_date")
    )


def disambiguate(
    df: DataFrame, keys: Names, name: str, order: Names, suffix: Column, bucket: Column | None = None
) -> DataFrame:
    """Every row of a repeated name but the first (in order) gets ' (suffix)'."""
    numbered = number_rows(df, [*keys, name], order, "__nth", bucket)
    renamed = F.when(F.col("__nth") > 1, F.concat(F.col(name), F.lit(" ("), suffix, F.lit(")"))).otherwise(F.col(name))
    return numbered.withColumn(name, renamed).drop("__nth")
