"""Facts: line items, orders, monthly snapshots, lifecycles."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratiform.operators.skew import HOT_ROWS, next_in_key
from stratiform.session import materialize


def project(df: DataFrame, columns: dict[str, str], day: dict[str, str] | None = None) -> DataFrame:
    """Fact columns under their names (source -> fact), plus columns truncated to the day."""
    days = [F.date_trunc("day", c).cast(df.schema[c].dataType).alias(n) for c, n in (day or {}).items()]
    return df.select(*[F.col(c).alias(n) for c, n in columns.items()], *days)


def with_junk_key(facts: DataFrame, dim: DataFrame, flags: Sequence[str], key: str = "junk_key") -> DataFrame:
    """Look up the junk key by flags, NULL flags included.

    Pass the dimension as a written table: Catalyst then knows its size and broadcasts it only
    if it is small, while the facts stay where they are.
    """
    named = dim.select(key, *[F.col(f).alias(f"_j_{f}") for f in flags])
    same = [F.col(f).eqNullSafe(F.col(f"_j_{f}")) for f in flags]
    return facts.join(named, same, "left").drop(*[f"_j_{f}" for f in flags])


def daily_counts(df: DataFrame, time: str, by: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Rows per day and group."""
    return df.groupBy(F.to_date(time).alias("day"), *by).agg(F.count("*").alias(out))


def monthly_snapshot(activity: DataFrame, group: str, member: str, time: str, amount: str, amount_type: str | None = None) -> DataFrame:
    """One row per group and month from its first to its last active month.

    A member joins in the month of its first activity and leaves after the month of its last.
    ``headcount`` is the members present in the month, ``active_headcount`` those with activity,
    ``avg_amount`` the mean amount of the month, summed in the column's own type or in ``amount_type``
    (a decimal makes sums of floats independent of their order), and ``turnover_rate`` the share of the headcount
    that leaves. The activity is read once into a table of members by month; the running totals
    go over one row per group and month.
    """
    month, summed = "snapshot_month", F.col(amount).cast(amount_type) if amount_type else F.col(amount)
    monthly = materialize(
        activity.select(group, member, F.trunc(time, "month").alias(month), summed.alias("_a"))
        .groupBy(group, member, month)
        .agg(F.sum("_a").alias("_sum"), F.count("_a").alias("_n")),
        "member-months",
    )
    acting = monthly.select(
        group, month, "_sum", "_n", F.lit(1).alias("_active"), F.lit(0).alias("_in"), F.lit(0).alias("_out")
    )
    none = F.lit(None)
    joined_in = F.struct(F.col("_first").alias(month), F.lit(1).alias("_in"), F.lit(0).alias("_out"))
    left_in = F.struct(F.col("_last").alias(month), F.lit(0).alias("_in"), F.lit(1).alias("_out"))
    moving = (
        monthly.groupBy(group, member)
        .agg(F.min(month).alias("_first"), F.max(month).alias("_last"))
        .select(group, F.inline(F.array(joined_in, left_in)))
        .select(group, month, none.alias("_sum"), F.lit(0).alias("_n"), F.lit(0).alias("_active"), "_in", "_out")
    )
    counts = acting.unionByName(moving).groupBy(group, month).agg(
        *[F.sum(c).alias(c) for c in ("_sum", "_n", "_active", "_in", "_out")]
    )
    spine = (
        monthly.groupBy(group)
        .agg(F.min(month).alias("_a"), F.max(month).alias("_b"))
        .select(group, F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 MONTH"))).alias(month))
    )
    zero = F.lit(0).cast("bigint")
    filled = spine.join(counts, [group, month], "left").select(
        group, month, "_sum", "_n", *[F.coalesce(c, zero).alias(c) for c in ("_active", "_in", "_out")]
    )
    running = Window.partitionBy(group).orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    present = F.sum(F.col("_in") - F.col("_out")).over(running) + F.col("_out")
    return filled.withColumn("headcount", present).select(
        group,
        month,
        "headcount",
        F.col("_active").alias("active_headcount"),
        (F.col("_sum").cast("double") / F.col("_n")).alias("avg_amount"),
        (F.col("_out") / F.col("headcount")).alias("turnover_rate"),
    )


def lifecycle(
    events: DataFrame, key: str, stage: str, time: str, tiebreak: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per stage a key enters, with the time it left it for the next one and whole days between."""
    entered = events.select(tiebreak, key, stage, F.col(time).alias("entered_ts"))
    following = next_in_key(entered, key, "entered_ts", tiebreak, "exited_ts", hot_rows)
    return following.withColumns(
        {
            "duration_days": F.datediff("exited_ts", "entered_ts"),
            "is_current_stage": F.col("exited_ts").isNull(),
        }
    )


def stage_metrics(life: DataFrame, stage: str) -> DataFrame:
    """How many entries a stage has, how many moved on, the share, and the mean days spent."""
    moved = F.count("exited_ts")
    return life.groupBy(stage).agg(
        F.count("*").alias("n_entered"),
        moved.alias("n_exited"),
        (moved / F.count("*")).alias("conversion_rate"),
        (F.sum("duration_days") / F.count("duration_days")).alias("avg_duration_days"),
    )
