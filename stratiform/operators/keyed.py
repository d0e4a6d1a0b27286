"""Keyed tables: upsert, predicate update, overlay."""

from __future__ import annotations

from functools import reduce
from typing import Any, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions.checks import all_not_null
from stratiform.session import materialize


def _nullable(t: T.DataType) -> T.DataType:
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_nullable(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, _nullable(t.valueType), True)
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in t])
    return t


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns shared with the target, in target order and type."""
    return df.select(*[F.col(f.name).cast(_nullable(f.dataType)).alias(f.name) for f in schema if f.name in df.columns])


def widened(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows with the columns they lack as typed NULLs."""
    return df.withColumns(
        {f.name: F.lit(None).cast(_nullable(f.dataType)) for f in schema if f.name not in df.columns}
    )


def require_unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, but the job fails on a NULL or repeated key.

    The check shuffles and sorts by the key, which a following join on the key reuses.
    """
    window = Window.partitionBy(*keys).orderBy(*keys)
    fine = (
        F.when(~all_not_null(keys), F.raise_error(F.lit("upsert source has a NULL key")).cast("boolean"))
        .when(F.col("_nth") > 1, F.raise_error(F.lit("upsert source repeats a key")).cast("boolean"))
        .otherwise(F.lit(True))
    )
    return df.withColumn("_nth", F.row_number().over(window)).filter(fine).drop("_nth")


def without_match(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks.

    The target is first reduced to the source's keys, so with a small source only a broadcast
    join touches the target and it is never shuffled.
    """
    known = target.select(*keys).join(source.select(*keys), list(keys), "left_semi")
    return source.join(known, list(keys), "left_anti")


def not_older(source: DataFrame, target: DataFrame, keys: Sequence[str], by: str | Sequence[str]) -> DataFrame:
    """Source rows the target has no newer row for; equal times count as newer, NULL as oldest.

    Several columns ``by`` are compared one after the other.
    A reprocessed window holds old rows of keys that have changed since; they must not undo that.
    """
    keys, by = list(keys), [by] if isinstance(by, str) else list(by)
    ahead = (
        target.select(*keys, F.struct(*by).alias("_held"))
        .join(source.select(*keys, F.struct(*by).alias("_sent")), keys)
        .filter(F.col("_held") > F.col("_sent"))
    )
    return source.join(ahead.select(*keys), keys, "left_anti")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    unique: bool = False,
    stage: bool = False,
    widen: bool = False,
) -> DataFrame:
    """Target after a keyed merge: matched rows take the source's columns, new rows are added.

    Columns the source lacks keep their value on a match and are NULL on an insert; columns the
    target lacks are ignored. The same source applied twice changes nothing more.

    ``widen`` adds the source's new columns to the target instead, NULL in older rows.
    ``unique`` skips the key check for a source that is unique and non-NULL by construction.
    ``stage`` writes the source first: it is then computed once and broadcast by its true size.
    """
    keys = list(keys)
    absent = [k for k in keys if k not in source.columns]
    if absent:
        raise ValueError(f"key columns missing from upsert source: {absent}")
    if widen:
        target = widened(target, source.schema)
    incoming = align(source, target.schema)
    checked = incoming if unique else require_unique_keys(incoming, keys)
    if stage:
        incoming = checked = materialize(checked, "upsert-source")
    if set(incoming.columns) == set(target.columns):
        kept = target.join(incoming.select(*keys), keys, "left_anti")
        return kept.unionByName(checked)

    carried = [c for c in incoming.columns if c not in keys]
    renamed = checked.select(*keys, F.lit(True).alias("_matched"), *[F.col(c).alias(f"_new_{c}") for c in carried])
    updated = target.join(renamed, keys, "left").select(
        *[
            F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in carried else F.col(c)
            for c in target.columns
        ]
    )
    inserted = without_match(checked, target, keys)
    return updated.unionByName(inserted, allowMissingColumns=True)


def update_where(df: DataFrame, condition: Column, sets: Mapping[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE as one projection; an UNKNOWN condition leaves the row alone."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns(
        {name: F.when(hit, new.cast(df.schema[name].dataType)).otherwise(F.col(name)) for name, new in sets.items()}
    )


def append(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Add rows; columns they lack are NULL."""
    return table.unionByName(align(rows, table.schema), allowMissingColumns=True)


def _overlaid(dtype: T.DataType, base: Column, over: Column) -> Column:
    """Overlay wins; structs and maps merge field by field, arrays are replaced."""
    if isinstance(dtype, T.StructType):
        merged = F.struct(*[_overlaid(f.dataType, base[f.name], over[f.name]).alias(f.name) for f in dtype])
        return F.when(base.isNull(), over).when(over.isNull(), base).otherwise(merged)
    if isinstance(dtype, T.MapType):
        merged = F.map_zip_with(base, over, lambda _, b, o: _overlaid(dtype.valueType, b, o))
        return F.when(base.isNull(), over).when(over.isNull(), base).otherwise(merged)
    return F.coalesce(over, base)


def overlay(
    base: DataFrame, over: DataFrame, keys: Sequence[str], defaults: Mapping[str, Any] | None = None
) -> DataFrame:
    """Layer ``over`` on ``base`` by key; rows of either side stay, ``defaults`` fill what is still NULL.

    Overlay rows without a key are ignored.
    """
    keys, defaults = list(keys), dict(defaults or {})
    named = over.filter(all_not_null(keys))
    left = base.select(*keys, F.struct(*[c for c in base.columns if c not in keys]).alias("_base"))
    right = named.select(*keys, F.struct(*[c for c in named.columns if c not in keys]).alias("_over"))
    base_fields = {f.name: f for f in base.schema if f.name not in keys}
    over_fields = {f.name: f for f in named.schema if f.name not in keys}

    values = []
    for name in [*base_fields, *[n for n in over_fields if n not in base_fields]]:
        if name in base_fields and name in over_fields:
            value = _overlaid(base_fields[name].dataType, F.col("_base")[name], F.col("_over")[name])
        else:
            value = F.col("_base" if name in base_fields else "_over")[name]
        if name in defaults:
            fallback = defaults[name] if isinstance(defaults[name], Column) else F.lit(defaults[name])
            dtype = (base_fields.get(name) or over_fields[name]).dataType
            value = _overlaid(dtype, fallback.cast(dtype), value)
        values.append(value.alias(name))
    return left.join(right, keys, "full").select(*keys, *values)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
