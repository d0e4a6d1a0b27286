"""Which rows a run reads: incremental, reprocess window, keys, late arrivals, restricted scope."""

from __future__ import annotations

from typing import Any, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions.values import Typed, watermark
from stratiform.spec import Request

_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _typed(df: DataFrame, column: str, value: Any) -> Column:
    dtype = df.schema[column].dataType
    if isinstance(dtype, _TIMES):
        return watermark(value, dtype.simpleString())
    value = value.column if isinstance(value, Typed) else value
    return (value if isinstance(value, Column) else F.lit(value)).cast(dtype)


def arrivals(df: DataFrame, column: str, last: Any) -> dict[str, Column]:
    """Counts of rows by how their time stands to the last watermark: ``n_late`` before it, ``n_tied`` at it, ``n_untimed`` without one."""
    if column not in df.columns:
        return {"n_late": F.lit(0).cast("bigint"), "n_tied": F.lit(0).cast("bigint"), "n_untimed": F.count("*")}
    untimed = F.count_if(F.col(column).isNull())
    if last is None:
        return {"n_late": F.lit(0).cast("bigint"), "n_tied": F.lit(0).cast("bigint"), "n_untimed": untimed}
    bound = _typed(df, column, last)
    return {"n_late": F.count_if(F.col(column) < bound), "n_tied": F.count_if(F.col(column) == bound), "n_untimed": untimed}


def incremental(df: DataFrame, column: str, last: Any, inclusive: bool = False) -> DataFrame:
    """Rows after the watermark; all rows without a watermark or without the column.

    Strict by default. ``inclusive`` reads rows equal to the watermark again, which a keyed
    upsert absorbs and which cannot lose ties. The literal reaches the scan as a pushed filter.
    """
    if last is None or column not in df.columns:
        return df
    bound = _typed(df, column, last)
    return df.filter(F.col(column) >= bound if inclusive else F.col(column) > bound)


def window(df: DataFrame, column: str, start: Any, end: Any) -> DataFrame:
    """Rows in ``(start, end]``; an absent bound is open."""
    out = df if start is None else df.filter(F.col(column) > _typed(df, column, start))
    return out if end is None else out.filter(F.col(column) <= _typed(df, column, end))


def by_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in the key set."""
    return df.join(keys.select(*on), list(on), "left_semi")


def for_run(
    df: DataFrame,
    column: str,
    last: Any = None,
    request: Request | None = None,
    keys: DataFrame | None = None,
    on: Sequence[str] = (),
    inclusive: bool = False,
) -> DataFrame:
    """The slice of one run: a reprocess request decides, otherwise the watermark does."""
    if request is None:
        return incremental(df, column, last, inclusive)
    if request.mode == "window":
        return window(df, column, request.from_watermark, request.to_watermark)
    if request.mode == "keys":
        if keys is None:
            raise ValueError("a reprocess by keys needs the key set")
        return by_keys(df, keys, on)
    return df


def late_and_on_time(
    df: DataFrame, silver: DataFrame, column: str, last: Any, on: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Split into rows after the watermark and rows at or before it that silver has not seen."""
    bound = _typed(df, column, last)
    on_time = df.filter(F.col(column) > bound)
    identity = [*on, column]
    late = df.filter(F.col(column) <= bound).join(silver.select(*identity), identity, "left_anti")
    return late, on_time


def in_scope(df: DataFrame, flag: str, restricted: bool, key: str | None = None, keys: Iterable[str] = ()) -> DataFrame:
    """Rows of one scope, optionally only some keys; an unset flag is not restricted."""
    wanted = list(keys)
    scoped = df.filter(F.coalesce(F.col(flag), F.lit(False)) == F.lit(restricted))
    return scoped.filter(F.col(key).isin(wanted)) if key and wanted else scoped


def route(df: DataFrame, flag: str, layer: str = "silver", out: str = "layer_schema") -> DataFrame:
    """Name the one schema each row belongs to; partition a writer by it."""
    restricted = F.coalesce(F.col(flag), F.lit(False))
    return df.withColumn(out, F.when(restricted, f"{layer}_restricted").otherwise(layer))
