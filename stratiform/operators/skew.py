"""Window operators that stay spread out when one key holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.session import materialize

# A key with more rows than this is cut into time slices of about this many rows.
HOT_ROWS = 1_000_000

_DAY = 86_400_000_000


def micros(time: str, dtype: T.DataType) -> Column:
    """Position in time in microseconds, in the order of the column whatever the session zone."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(time)
    days = F.datediff(F.col(time), F.lit("1970-01-01").cast("date")).cast("bigint") * _DAY
    if isinstance(dtype, T.DateType):
        return days
    minutes = (F.hour(time) * 60 + F.minute(time)).cast("bigint")
    seconds = F.expr(f"extract(SECOND FROM `{time}`)")
    return days + minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys above ``hot_rows``, NULL among them, with their rows. At most total rows / hot_rows keys are hot."""
    return df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)


def with_slices(df: DataFrame, hot: DataFrame, key: str, time: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with ``_slice``: for hot keys a number that grows with time, else NULL.

    The slices lie between quantiles of the key's own times, so a burst is cut as finely as its
    rows ask for. Rows of one time stay together; rows without a time are slice -1.
    """
    slices = -(-hot.agg(F.max("_n")).first()[0] // hot_rows)
    at = micros(time, df.schema[time].dataType)
    named = hot.select(F.col(key).alias("_hot"))
    timed = df.select(key, at.alias("_at")).join(named, F.col(key).eqNullSafe(F.col("_hot")))
    shares = [n / slices for n in range(1, slices)]
    cuts = F.percentile_approx("_at", shares, 20 * slices) if shares else F.array().cast("array<bigint>")
    bounds = materialize(timed.groupBy("_hot").agg(F.array_sort(F.array_distinct(F.coalesce(cuts, F.array().cast("array<bigint>")))).alias("_bounds")), "hot-slices")

    def halved(state: Column, _: Column) -> Column:
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        up = F.struct((middle + 1).alias("lo"), state["hi"].alias("hi"))
        down = F.struct(state["lo"].alias("lo"), middle.alias("hi"))
        return F.when(state["lo"] >= state["hi"], state).when(F.get("_bounds", middle) <= at, up).otherwise(down)

    start = F.struct(F.lit(0).alias("lo"), F.size("_bounds").alias("hi"))
    steps = F.sequence(F.lit(0), F.lit(slices.bit_length()))
    number = F.when(at.isNull(), -1).otherwise(F.aggregate(steps, start, halved, lambda state: state["lo"]))
    joined = df.join(bounds.withColumn("_is_hot", F.lit(True)), F.col(key).eqNullSafe(F.col("_hot")), "left")
    return joined.withColumn("_slice", F.when(F.col("_is_hot"), number)).drop("_hot", "_bounds", "_is_hot")


def next_in_key(df: DataFrame, key: str, time: str, tiebreak: str, out: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``lead(time)`` per key ordered by (time, tiebreak), as column ``out``.

    The keys are counted first, which reads one column. Without a hot key this is one plain
    window. A hot key is cut into slices of time, as many as its rows ask for; the last row of a
    slice takes the head of the key's next slice, found on one row per slice. The result equals
    the plain window.
    """
    hot_rows = max(1, hot_rows)
    found = materialize(hot_keys(df, key, hot_rows), "hot-keys")
    if found.isEmpty():
        return df.withColumn(out, F.lead(time).over(Window.partitionBy(key).orderBy(F.col(time), F.col(tiebreak))))

    sliced = with_slices(df, found, key, time, hot_rows)
    inner = Window.partitionBy(key, "_slice").orderBy(F.col(time), F.col(tiebreak))
    rows = sliced.withColumns({"_inner": F.lead(time).over(inner), "_follows": F.lead(F.lit(True)).over(inner)})

    heads = (
        sliced.filter("_slice IS NOT NULL")
        .groupBy(F.col(key).alias("_head_key"), F.col("_slice").alias("_head_slice"))
        .agg(F.min(time).alias("_head"))
        .withColumn("_next_head", F.lead("_head").over(Window.partitionBy("_head_key").orderBy("_head_slice")))
        .drop("_head")
    )
    same = F.col(key).eqNullSafe(F.col("_head_key")) & (F.col("_slice") == F.col("_head_slice"))
    return (
        rows.join(heads, same, "left")
        .withColumn(out, F.when(F.col("_follows"), F.col("_inner")).otherwise(F.col("_next_head")))
        .drop("_slice", "_inner", "_follows", "_head_key", "_head_slice", "_next_head")
    )
