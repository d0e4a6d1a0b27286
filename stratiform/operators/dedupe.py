"""Key dedupe."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.functions.values import col


def first_per_key(df: DataFrame, keys: Sequence[str], order: Iterable[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark turns ``row_number() = 1`` into a group limit that already runs before the shuffle,
    so each map task sends at most one row per key and a hot key does not pile up in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], by: Sequence[str | Column], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Newest row per key; NULL times lose, and all other columns break ties by default."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns missing from input: {missing}")
    named = {c for c in by if isinstance(c, str)}
    rest = tiebreak if tiebreak is not None else [c for c in df.columns if c not in named and c not in keys]
    order = [F.desc_nulls_last(c) if isinstance(c, str) else c.desc_nulls_last() for c in [*by, *rest]]
    return first_per_key(df, keys, order)


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, no matter which."""
    return df.dropDuplicates(list(keys))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def common_keys(wanted: DataFrame, available: DataFrame, key: str) -> DataFrame:
    """Wanted rows whose key is available."""
    return wanted.join(available.select(key).distinct(), key, "left_semi")


def preferred_row(df: DataFrame, keys: Sequence[str], preference: Column, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Row with the lowest preference rank per key, such as the exact environment before 'all'."""
    return first_per_key(df, keys, [preference.asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak]])


def environment_rank(column: str, environment: str, fallback: str = "all") -> Column:
    """0 for the wanted environment, 1 for the fallback, 2 for anything else."""
    c = col(column)
    return F.when(c == environment, 0).when(c == fallback, 1).otherwise(2)


def latest_version(df: DataFrame, keys: Sequence[str], version: str = "version") -> DataFrame:
    return latest_per_key(df, keys, [version])
