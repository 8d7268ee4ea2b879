"""Identity of the records of a batch, equal to applying them one after another."""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalodge.functions.text import ci_key
from catalodge.operators.graph import component_roots
from catalodge.session import materialize

SEP = "\u0001"

# The fold runs in Python workers; it travels with the tasks, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def text_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """One text for several key columns, text compared without case, accents and trailing blanks; NULL if a part is."""
    kinds = dict(df.dtypes)
    parts = [ci_key(F.col(c)) if kinds[c] == "string" else F.col(c).cast("string") for c in columns]
    return F.concat(*[p for part in parts for p in (part, F.lit(SEP))])


class _Group:
    """What is known of one linked group so far: ids by name, and by the URL each id has now."""

    def __init__(self) -> None:
        self.by_name: dict[str, tuple] = {}
        self.by_url: dict[str, set[tuple]] = {}
        self.url_of: dict[tuple, str] = {}

    def move(self, entity: tuple, url: str | None) -> None:
        if url is not None and self.url_of.get(entity) != url:
            self.by_url.get(self.url_of.get(entity), set()).discard(entity)
            self.by_url.setdefault(url, set()).add(entity)
            self.url_of[entity] = url

    def find(self, name: str, url: str | None) -> tuple | None:
        return self.by_name.get(name) or min(self.by_url.get(url, ()), default=None)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, stored ones first: one group's state is in memory at a time."""
    current, group, made = None, _Group(), 0
    for batch in batches:
        rows = {c: batch.column(c).to_pylist() for c in ("group", "sid", "name_key", "url_key", "new_key", "backfill")}
        keys, fresh, kept = [], [], []
        for g, sid, name, url, new_key, backfill in zip(*rows.values(), strict=True):
            if g != current:
                current, group, made = g, _Group(), 0
            if sid is not None:
                entity = (0, sid, sid)
                group.by_name.setdefault(name, entity)
                group.move(entity, url)
            else:
                entity = group.find(name, url)
                if entity is None and not backfill:
                    made += 1
                    entity = (1, made, new_key)
                    group.by_name[name] = entity
                if entity is not None:
                    group.move(entity, url)
            kept.append(sid is None and entity is not None)
            keys.append(entity[2] if entity else None)
            fresh.append(bool(entity and entity[0]))
        out = [batch.column("rec"), pa.array(keys, pa.string()), pa.array(fresh, pa.bool_())]
        yield pa.RecordBatch.from_arrays(out, ["rec", "entity_key", "is_new"]).filter(pa.array(kept))


def resolve_in_order(
    records: DataFrame,
    stored: DataFrame,
    id_column: str,
    name: Sequence[str],
    url: Sequence[str],
    order: Sequence[str],
    backfill: Column | None = None,
) -> DataFrame:
    """Add ``entity_key`` and ``is_new`` to the records of a batch.

    Each record in turn belongs to the entity with its name key, else to the one that has
    its URL key at that moment (the stored ones first, then by id), else it founds an
    entity under its name; an entity takes the URL of each record that joins it and keeps
    its name. Records with ``backfill`` found nothing and are dropped if nothing matches.
    Records with a NULL in the name key are dropped: see ``incomplete``.

    Records and stored rows that share a key are linked into groups, and each group is
    folded in order, so groups run side by side. A group is as long as its records, but
    its state holds its distinct keys alone, never its rows.
    """
    out = f"rec struct<{','.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in records.schema)}>, entity_key string, is_new boolean"
    place = F.struct(*order)
    left = records.select(
        F.struct(*records.columns).alias("rec"),
        place.alias("at"),
        F.lit(None).cast("string").alias("sid"),
        text_key(records, name).alias("name_key"),
        text_key(records, url).alias("url_key"),
        F.concat_ws(SEP, *[F.col(c).cast("string") for c in name]).alias("new_key"),
        (F.lit(False) if backfill is None else F.coalesce(backfill, F.lit(False))).alias("backfill"),
    ).where("name_key IS NOT NULL")
    old = stored.select(
        F.lit(None).cast(left.schema["rec"].dataType).alias("rec"),
        F.lit(None).cast(left.schema["at"].dataType).alias("at"),
        F.col(id_column).cast("string").alias("sid"),
        text_key(stored, name).alias("name_key"),
        text_key(stored, url).alias("url_key"),
        F.lit(None).cast("string").alias("new_key"),
        F.lit(False).alias("backfill"),
    ).where("name_key IS NOT NULL")
    # Only stored rows that share a key with the batch can matter.
    names, addresses = left.select("name_key").distinct(), left.select("url_key").where("url_key IS NOT NULL").distinct()
    near = old.join(names, "name_key", "left_semi").unionByName(
        old.join(addresses, "url_key", "left_semi").join(names, "name_key", "left_anti")
    )
    rows = left.unionByName(near.select(left.columns)).withColumn("node", F.xxhash64(F.lit("name"), "name_key"))
    links = rows.where("url_key IS NOT NULL").select(F.col("node").alias("u"), F.xxhash64(F.lit("url"), "url_key").alias("v"))
    roots = component_roots(links)
    grouped = rows.join(roots, "node", "left").withColumn("group", F.coalesce("root", "node")).drop("root", "node")
    placed = grouped.repartition("group").sortWithinPartitions("group", F.col("sid").isNull(), "sid", "at").drop("at")
    return placed.mapInArrow(_fold, out).select("rec.*", "entity_key", "is_new")


def incomplete(records: DataFrame, name: Sequence[str]) -> DataFrame:
    """Records that no entity can be named after, because a part of the name key is NULL."""
    return records.where(text_key(records, name).isNull())


def resolve_by_code(
    records: DataFrame, stored: DataFrame, id_column: str, scope: Sequence[str], code: str, name: str, order: Sequence[str]
) -> DataFrame:
    """Add ``entity_key`` to records that have a code, or else a name, as one after another would find them.

    A record with a code belongs to the entity with that code. One without belongs to an
    entity with its name: a stored one with a code, else the first of the batch with a code
    that came before it, else a stored one without a code, else all such records of a name
    are one new entity. Names and codes are set when an entity is made and never change.
    """
    at = F.struct(*order)
    coded = F.col(code).isNotNull() & (F.col(code) != "")
    spelling = ["__hash", *scope, code, name]

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "__code": F.when(coded, text_key(df, [*scope, code])),
                "__name": text_key(df, [*scope, name]),
            }
        )

    # Records are made once; what founds and finds entities are their spellings, each with the place of its first record.
    # The hash in front makes sorts compare numbers; where it is equal, the columns themselves decide.
    rows = materialize(records.withColumn("__hash", F.xxhash64(*spelling[1:])), "records")
    spelled = F.concat_ws(SEP, *[F.col(c).cast("string") for c in scope], F.when(coded, F.col(code)).otherwise(F.col(name)))
    spellings = rows.groupBy(*spelling).agg(F.min(at).alias("__at"))
    old, new = keyed(stored), materialize(keyed(spellings).withColumn("__spelled", spelled), "spellings")
    sid = F.col(id_column)
    by_code = old.where("__code IS NOT NULL").groupBy("__code").agg(F.min(sid).alias("__by_code"))
    by_name = old.groupBy("__name").agg(
        F.min(F.when(F.col("__code").isNotNull(), sid)).alias("__old_coded"),
        F.min(F.when(F.col("__code").isNull(), sid)).alias("__old_plain"),
    )
    # The first record of each code that is not stored founds an entity under its own name.
    founders = (
        new.where("__code IS NOT NULL")
        .groupBy("__code")
        .agg(F.min("__at").alias("__since"), F.min_by("__spelled", "__at").alias("__founded"), F.min_by("__name", "__at").alias("__name"))
        .join(by_code, "__code", "left_anti")
    )
    first_coded = founders.groupBy("__name").agg(
        F.min("__since").alias("__since"), F.min_by("__founded", "__since").alias("__new_coded")
    )
    first_plain = new.where("__code IS NULL").groupBy("__name").agg(F.min_by("__spelled", "__at").alias("__new_plain"))
    with_code = new.where("__code IS NOT NULL").join(by_code, "__code", "left").join(
        founders.select("__code", "__founded"), "__code", "left"
    )
    without = (
        new.where("__code IS NULL").join(by_name, "__name", "left").join(first_coded, "__name", "left").join(first_plain, "__name", "left")
    )
    sure = with_code.select(*spelling, F.coalesce("__by_code", "__founded").alias("__sure"))
    found = sure.unionByName(
        without.select(
            *spelling, F.col("__old_coded").alias("__sure"), "__since", "__new_coded", F.coalesce("__old_plain", "__new_plain").alias("__else")
        ),
        allowMissingColumns=True,
    )
    found = found.withColumnsRenamed({c: f"__s_{c}" for c in spelling})
    same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in spelling])
    earlier = F.when(F.col("__since") < at, F.col("__new_coded"))
    return rows.join(found, same, "left").select(*records.columns, F.coalesce("__sure", earlier, "__else").alias("entity_key"))
