"""Upserts and change capture.

A batch may hold many records for one entity. Applying them one after another
is folded into set operations:

* a record changes a field when it brings a value and that value differs from
  the latest value before it (in the batch, else in the stored table);
* the final value is the one of the last such change;
* a NULL never overwrites, so a field can not be cleared.

All rows of the batch are compared inside (key, bucket); one summary row per
key then meets the stored table, so a key that holds a large share of the
batch never lands in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalodge.functions.text import differs
from catalodge.operators import ordered
from catalodge.operators.ordered import BUCKET


@dataclass(frozen=True)
class Unit:
    """Columns that change together. ``compare`` decides; NULL there means 'no news'.

    ``columns`` are taken over from the record that made the last change. A plain
    field is a unit of itself; a deadline carries its note, a calendar entry both dates.
    """

    name: str
    columns: tuple[str, ...]
    compare: str | None = None  # SQL expression, default: the single column itself
    tracked: bool = False

    def value(self, prefix: str = "") -> Column:
        return F.expr(self.compare) if self.compare else F.col(f"{prefix}{self.columns[0]}")


@dataclass(frozen=True)
class MergeSpec:
    entity: str
    keys: tuple[str, ...]
    units: tuple[Unit, ...]
    insert_only: tuple[str, ...] = ()  # columns set on insert and never updated
    log_insert: bool = False
    null_safe: bool = False  # NULL key parts match each other
    insert_missing: bool = True  # False: unmatched records are dropped (backfill)
    label: str | None = None  # column logged as new value of an insert

    @classmethod
    def simple(
        cls, entity: str, keys: Sequence[str], fields: Sequence[str], tracked: Sequence[str] = (), **more
    ) -> "MergeSpec":
        """Every field changes on its own, as most tables want it."""
        units = tuple(Unit(f, (f,), tracked=f in tracked) for f in fields)
        return cls(entity, tuple(keys), units, **more)


@dataclass(frozen=True)
class MergeResult:
    table: DataFrame
    log: DataFrame
    spec: MergeSpec = field(repr=False)


def _payload(unit: Unit) -> Column:
    return F.struct(*[F.col(c) for c in unit.columns])


HASH = "__hash"  # of a row's keys
OLD = "__o_"  # prefix of stored columns while both sides are joined


def _old(column: str) -> Column:
    return F.col(f"{OLD}{column}")


def _condition(keys: Sequence[str], null_safe: bool) -> Column:
    """Stored (prefixed) keys equal the plain ones of the other side."""
    parts = [_old(k).eqNullSafe(F.col(k)) if null_safe else _old(k) == F.col(k) for k in keys]
    out = parts[0]
    for part in parts[1:]:
        out = out & part
    return out


def _changed(old: Column, new: Column) -> Column:
    """Both are known and differ; equal texts need no closer look."""
    return old.isNotNull() & new.isNotNull() & (old != new) & differs(old, new)


def fold_batch(
    batch: DataFrame, spec: MergeSpec, order: Sequence[str], bucket: Column | None
) -> tuple[DataFrame, DataFrame]:
    """(rows with per-unit change flags, one summary row per key) of a batch."""
    valued = batch
    for unit in spec.units:
        valued = valued.withColumn(f"__v_{unit.name}", unit.value().cast("string"))
    rows = ordered.last_known(
        valued,
        spec.keys,
        order,
        {f"__v_{u.name}": f"__p_{u.name}" for u in spec.units},
        bucket,
        include_current=False,
    )
    for unit in spec.units:
        rows = rows.withColumn(f"__c_{unit.name}", _changed(F.col(f"__p_{unit.name}"), F.col(f"__v_{unit.name}")))
    return rows, _across_buckets(_inside_buckets(valued, spec, order, bucket), spec)


def _inside_buckets(rows: DataFrame, spec: MergeSpec, order: Sequence[str], bucket: Column | None) -> DataFrame:
    """One row per (key, bucket): of each unit the first and last value, the last change after the first and the number of these.

    Rows are shuffled once, and their number inside the bucket stands for their order. The
    hash in front of the keys makes the sort compare numbers; keys with one hash stay apart.
    """
    inside = Window.partitionBy(HASH, *spec.keys, BUCKET).orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({HASH: F.xxhash64(*spec.keys), BUCKET: F.lit(0) if bucket is None else bucket}).select(
        "*",
        F.row_number().over(inside).alias("__nth"),
        *[F.last(f"__v_{u.name}", ignorenulls=True).over(before).alias(f"__p_{u.name}") for u in spec.units],
    )
    at, nth = F.struct(*order), F.col("__nth")
    parts = [F.min_by(at, nth).alias("__seq")]
    for unit in spec.units:
        new, old = F.col(f"__v_{unit.name}"), F.col(f"__p_{unit.name}")
        given, changed = F.when(new.isNotNull(), nth), _changed(old, new)
        value = F.struct(at.alias("at"), new.alias("value"), _payload(unit).alias("row"))
        parts += [
            F.min_by(value, given).alias(f"__f_{unit.name}"),
            F.max_by(new, given).alias(f"__t_{unit.name}"),
            F.max_by(_payload(unit), F.when(changed, nth)).alias(f"__l_{unit.name}"),
            F.count_if(changed).alias(f"__n_{unit.name}"),
        ]
    if spec.insert_only:
        parts.append(F.min_by(F.struct(*spec.insert_only), nth).alias("__insert"))
    if spec.label:
        parts.append(F.min_by(F.col(spec.label), nth).alias("__label"))
    return rows.groupBy(HASH, *spec.keys, BUCKET).agg(*parts)


def _across_buckets(parts: DataFrame, spec: MergeSpec) -> DataFrame:
    """One summary row per key; the first value of a bucket meets the last one of the buckets before."""
    before = Window.partitionBy(*spec.keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    # As in ``last_known``, nothing is carried over where a part of the key is NULL.
    whole = F.lit(True)
    for key in spec.keys:
        whole = whole & F.col(key).isNotNull()
    parts = parts.select(
        "*", *[F.when(whole, F.last(f"__t_{u.name}", ignorenulls=True).over(before)).alias(f"__p_{u.name}") for u in spec.units]
    )
    at = F.struct(BUCKET)  # a struct, as max_by leaves out a NULL
    summary = [F.min_by("__seq", at).alias("__seq")]
    for unit in spec.units:
        head, last, old = F.col(f"__f_{unit.name}"), F.col(f"__l_{unit.name}"), F.col(f"__p_{unit.name}")
        first, changed = head.isNotNull() & old.isNull(), _changed(old, head["value"])
        moved = last.isNotNull() | first | changed
        count = F.sum(F.col(f"__n_{unit.name}") + F.when(changed, 1).otherwise(0))
        summary += [
            F.max_by(head, F.when(first, at)).alias(f"__f_{unit.name}"),
            F.max_by(F.coalesce(last, head["row"]), F.when(moved, at)).alias(f"__l_{unit.name}"),
            F.coalesce(count, F.lit(0)).alias(f"__n_{unit.name}"),
        ]
    if spec.insert_only:
        summary.append(F.min_by("__insert", at).alias("__insert"))
    if spec.label:
        summary.append(F.min_by("__label", at).alias("__label"))
    return parts.groupBy(*spec.keys).agg(*summary)


def merge_records(
    stored: DataFrame,
    batch: DataFrame,
    spec: MergeSpec,
    order: Sequence[str],
    bucket: Column | None = None,
) -> MergeResult:
    """Apply a batch to a stored table; returns the new table and the change log.

    ``stored`` has one row per key. Log columns: entity_type, the key columns,
    change_type, field_name, old_value, new_value, then the order columns of the
    record that caused the entry.
    """
    rows, summary = fold_batch(batch, spec, order, bucket)
    old = stored.select(
        F.lit(True).alias("__stored"),
        *[unit.value().cast("string").alias(f"__s_{unit.name}") for unit in spec.units],
        *[F.col(c).alias(f"{OLD}{c}") for c in stored.columns],
    )
    how = "full_outer" if spec.insert_missing else "left_outer"
    joined = old.join(summary, _condition(spec.keys, spec.null_safe), how)
    known = F.col("__stored").isNotNull()
    keys = [F.coalesce(_old(k), F.col(k)).alias(k) for k in spec.keys]

    values: list[Column] = []
    updated: set[str] = set()
    for unit in spec.units:
        first, last = F.col(f"__f_{unit.name}"), F.col(f"__l_{unit.name}")
        before = F.col(f"__s_{unit.name}")
        takes_first = before.isNull() | differs(before, first["value"])
        for column in unit.columns:
            merged = (
                F.when(first.isNull(), _old(column))
                .when(F.col(f"__n_{unit.name}") > 0, last[column])
                .when(takes_first, first["row"][column])
                .otherwise(_old(column))
            )
            values.append(merged.alias(column))
            updated.add(column)
    for column in spec.insert_only:
        values.append(F.when(known, _old(column)).otherwise(F.col("__insert")[column]).alias(column))
        updated.add(column)
    untouched = [_old(c).alias(c) for c in stored.columns if c not in updated and c not in spec.keys]
    table = joined.select(*keys, *untouched, *values).select(*stored.columns)

    log = _log_inside(rows, spec, order)
    log = log.unionByName(_log_against_stored(joined, spec, order, known))
    if not spec.insert_missing:
        log = log.join(
            stored.select(*[F.col(k).alias(f"{OLD}{k}") for k in spec.keys]),
            _condition(spec.keys, spec.null_safe),
            "left_semi",
        )
    return MergeResult(table, log, spec)


def _entry(spec: MergeSpec, change: str, name: Column, old: Column, new: Column) -> list[Column]:
    return [
        F.lit(spec.entity).alias("entity_type"),
        F.lit(change).alias("change_type"),
        name.cast("string").alias("field_name"),
        old.cast("string").alias("old_value"),
        new.cast("string").alias("new_value"),
    ]


def _entries(items: list[Column]) -> Column:
    """Explode the entries whose condition held."""
    return F.explode(F.filter(F.array(*items), lambda e: e.isNotNull()))


def _log_inside(rows: DataFrame, spec: MergeSpec, order: Sequence[str]) -> DataFrame:
    items = [
        F.when(
            F.col(f"__c_{u.name}"),
            F.struct(*_entry(spec, "update", F.lit(u.name), F.col(f"__p_{u.name}"), F.col(f"__v_{u.name}"))),
        )
        for u in spec.units
        if u.tracked
    ] or [F.when(F.lit(False), F.struct(*_entry(spec, "update", F.lit(""), F.lit(""), F.lit(""))))]
    exploded = rows.select(*spec.keys, *order, _entries(items).alias("e"))
    return exploded.select(
        *spec.keys, "e.entity_type", "e.change_type", "e.field_name", "e.old_value", "e.new_value", *order
    )


def _log_against_stored(
    joined: DataFrame, spec: MergeSpec, order: Sequence[str], known: Column
) -> DataFrame:
    items = []
    for unit in spec.units:
        if not unit.tracked:
            continue
        first, before = F.col(f"__f_{unit.name}"), F.col(f"__s_{unit.name}")
        items.append(
            F.when(
                known & before.isNotNull() & first.isNotNull() & differs(before, first["value"]),
                F.struct(
                    *_entry(spec, "update", F.lit(unit.name), before, first["value"]), first["at"].alias("at")
                ),
            )
        )
    if spec.log_insert:
        text = F.col("__label") if spec.label else F.lit(None)
        items.append(
            F.when(
                ~known, F.struct(*_entry(spec, "insert", F.lit(None), F.lit(None), text), F.col("__seq").alias("at"))
            )
        )
    if not items:
        items = [
            F.when(
                F.lit(False),
                F.struct(*_entry(spec, "update", F.lit(""), F.lit(""), F.lit("")), F.col("__seq").alias("at")),
            )
        ]
    exploded = joined.select(
        *[F.coalesce(_old(k), F.col(k)).alias(k) for k in spec.keys], _entries(items).alias("e")
    )
    return exploded.select(
        *spec.keys,
        "e.entity_type",
        "e.change_type",
        "e.field_name",
        "e.old_value",
        "e.new_value",
        *[F.col(f"e.at.{c}").alias(c) for c in order],
    )


def insert_if_absent(
    stored: DataFrame, candidates: DataFrame, keys: Sequence[str], order: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Candidates whose key is not stored yet, the first one per key."""
    known = stored.select(*[F.col(k).alias(f"{OLD}{k}") for k in keys])
    fresh = candidates.join(known, _condition(keys, null_safe), "left_anti")
    return ordered.first_per_key(fresh, keys, order)


def replace_sets(
    stored: DataFrame, incoming: DataFrame, owner: Sequence[str], member: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Replace the member list of every owner that brings a non-empty one; members are distinct, first wins."""
    kept = stored.join(incoming.select(*owner), list(owner), "left_anti")
    fresh = ordered.first_per_key(incoming, [*owner, *member], order)
    return kept.unionByName(fresh.select(*stored.columns))


def fill_missing(table: DataFrame, found: DataFrame, keys: Sequence[str], column: str, active: str | None = None) -> DataFrame:
    """Fill a NULL column of active rows from ``found`` (one row per key); set values stay."""
    source = found.select(*keys, F.col(column).alias("__found"))
    out = table.join(source, list(keys), "left")
    wanted = F.col(active) if active else F.lit(True)
    return out.withColumn(
        column, F.when(wanted, F.coalesce(F.col(column), F.col("__found"))).otherwise(F.col(column))
    ).select(*table.columns)
