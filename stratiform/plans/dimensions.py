"""Dimensions: type 1, type 2, calendar, junk, and the checks on them."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratiform.functions.values import change_hash
from stratiform.operators.dedupe import latest_per_key
from stratiform.operators.keyed import require_unique_keys, without_match
from stratiform.session import materialize

SCD2_COLUMNS = ("effective_from", "effective_to", "is_current", "version", "change_hash")


def scd1(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Distinct current rows under dimension names (source column -> dimension column).

    Stamp a processing time after this, not before, or equal rows would differ.
    """
    return df.select(*[F.col(c).alias(n) for c, n in columns.items()]).distinct()


def scd2_build(
    history: DataFrame, key: str, tracked: Sequence[str], time: str, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Versions of each key from its full history, in whole days closed on both ends.

    The last row of a day stands for the day. This also bounds each window group by the number
    of days, whatever the number of rows a key has.
    """
    dated = history.select(
        key, *tracked, *[c for c in tiebreak or () if c not in tracked], F.col(time).alias("_time"),
        F.to_date(time).alias("effective_from"),
    )
    rest = list(tiebreak) if tiebreak is not None else list(tracked)
    days = latest_per_key(dated, [key, "effective_from"], ["_time"], tiebreak=rest).select(
        key, *tracked, "effective_from"
    )
    by_day = Window.partitionBy(key).orderBy("effective_from")
    hashed = days.withColumn("change_hash", change_hash(tracked))
    changed = (
        hashed.withColumn("_before", F.lag("change_hash").over(by_day))
        .filter(~F.col("change_hash").eqNullSafe(F.col("_before")))
        .drop("_before")
    )
    following = F.lead("effective_from").over(by_day)
    return changed.select(
        key,
        *tracked,
        "effective_from",
        F.date_sub(following, 1).alias("effective_to"),
        following.isNull().alias("is_current"),
        F.row_number().over(by_day).alias("version"),
        "change_hash",
    )


def scd2_late(dim: DataFrame, incoming: DataFrame, key: str, effective: str) -> DataFrame:
    """Incoming rows older than the current version of their key; ``scd2_apply`` leaves them out."""
    starts = dim.filter("is_current").select(key, F.col("effective_from").alias("_from"))
    return incoming.join(starts, key).filter(F.col(effective) < F.col("_from")).drop("_from").withColumn(
        "reason", F.lit("older than current version")
    )


def scd2_apply(
    dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], effective: str, stage: bool = False
) -> DataFrame:
    """Dimension after one batch with at most one row per key.

    Unchanged keys stay, changed keys close the day before and open the next version, a second
    change on the day a version began replaces it, new keys start at version 1, rows older than
    the current version are left out, and keys absent from the batch stay open. Closed versions
    pass through without a shuffle; so do current ones while the batch is small enough to broadcast.
    ``stage`` writes the batch first, so that it is computed once and its size is known.
    """
    batch = require_unique_keys(
        incoming.select(key, *tracked, F.col(effective).cast("date").alias("effective_from")), [key]
    ).withColumn("change_hash", change_hash(tracked))
    if stage:
        batch = materialize(batch, "scd2-batch")
    names = [key, *tracked, *SCD2_COLUMNS]
    closed = dim.filter(~F.col("is_current")).select(*names)
    live = dim.filter("is_current").select(*names)
    arrived = batch.select(
        key, F.struct(*tracked, "effective_from", "change_hash").alias("_in")
    )
    both = live.join(arrived, key, "left")

    old = F.struct(*[F.col(n) for n in names if n != key])
    change = F.col("_in.change_hash") != F.col("change_hash")
    later = change & (F.col("_in.effective_from") > F.col("effective_from"))
    same_day = change & (F.col("_in.effective_from") == F.col("effective_from"))

    def version(source: str, effective_to: Column, is_current: Column, number: Column) -> Column:
        at = f"{source}." if source else ""
        return F.struct(
            *[F.col(f"{at}{c}").alias(c) for c in tracked],
            F.col(f"{at}effective_from").alias("effective_from"),
            effective_to.cast("date").alias("effective_to"),
            is_current.alias("is_current"),
            number.cast("int").alias("version"),
            F.col(f"{at}change_hash").alias("change_hash"),
        )

    closing = version("", F.date_sub("_in.effective_from", 1), F.lit(False), F.col("version"))
    opening = version("_in", F.lit(None), F.lit(True), F.col("version") + 1)
    replaced = version("_in", F.lit(None), F.lit(True), F.col("version"))
    outcome = F.when(later, F.array(closing, opening)).when(same_day, F.array(replaced)).otherwise(F.array(old))
    kept = both.select(key, F.inline(outcome)).select(*names)

    fresh = without_match(batch, dim.filter("is_current"), [key]).select(
        key,
        *tracked,
        "effective_from",
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version"),
        "change_hash",
    )
    return closed.unionByName(kept).unionByName(fresh)


SEEN = "seen"


def scd2_splice(dim: DataFrame | None, incoming: DataFrame, key: str, tracked: Sequence[str], time: str, stage: bool = False) -> DataFrame:
    """Dimension after rows of any age, any number of them per key: what ``scd2_build`` makes of all rows ever sent, in whatever batches they came.

    Each version carries in ``seen`` the days on which its values were sent and the time of the last row
    of each, since a late change may fall between two days of one version and cut it. Only keys that the rows name are taken apart:
    days are merged, the last row of a day stands for it, equal neighbours become one version, and versions are
    numbered anew. All other keys pass through; they are not shuffled while the named keys are few enough to broadcast. A key's group is
    bounded by its days. ``None`` is a dimension without rows; ``stage`` writes the rows first, so that they are computed once.
    """
    sent = incoming.select(key, *tracked, F.col(time).alias("_at"), F.to_date(time).alias("_day"))
    sent = latest_per_key(sent, [key, "_day"], ["_at"], tiebreak=list(tracked))
    if stage:
        sent = materialize(sent, "scd2-rows")
    if dim is None:
        return _versions(sent, key, tracked)
    named = sent.select(F.col(key).alias("_named")).distinct()
    same = F.col(key).eqNullSafe(F.col("_named"))
    held = dim.join(named, same, "left_semi").select(key, *tracked, F.explode(SEEN).alias("_seen")).select(key, *tracked, "_seen.at", "_seen.day")
    days = latest_per_key(held.toDF(key, *tracked, "_at", "_day").unionByName(sent), [key, "_day"], ["_at"], tiebreak=list(tracked))
    spliced = _versions(days, key, tracked)
    return dim.join(named, same, "left_anti").select(*spliced.columns).unionByName(spliced)


def _versions(days: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Versions with the days they were seen on, from one row for each key and day."""
    by_day = Window.partitionBy(key).orderBy("_day")
    hashed = days.withColumn("change_hash", change_hash(tracked))
    opens = ~F.col("change_hash").eqNullSafe(F.lag("change_hash").over(by_day))
    numbered = hashed.withColumn("_opens", opens).withColumn("version", F.sum(F.col("_opens").cast("int")).over(by_day).cast("int"))
    seen = F.array_sort(F.collect_list(F.struct(F.col("_day").alias("day"), F.col("_at").alias("at")))).alias(SEEN)
    groups = numbered.groupBy(key, "version").agg(*[F.first(c).alias(c) for c in tracked], F.first("change_hash").alias("change_hash"), F.min("_day").alias("effective_from"), seen)
    following = F.lead("effective_from").over(Window.partitionBy(key).orderBy("version"))
    return groups.select(
        key, *tracked, "effective_from", F.date_sub(following, 1).alias("effective_to"), following.isNull().alias("is_current"), "version", "change_hash", SEEN
    )


def scd2_issues(dim: DataFrame, key: str) -> DataFrame:
    """Gaps and overlaps between neighbouring versions, and keys with several current versions."""
    by_start = Window.partitionBy(key).orderBy("effective_from", F.col("effective_to").asc_nulls_last())
    before = F.lag("effective_to").over(by_start)
    expected = F.date_add(before, 1)
    follows = F.row_number().over(by_start) > 1
    issue = (
        F.when(follows & (before.isNull() | (F.col("effective_from") < expected)), "overlap")
        .when(follows & (F.col("effective_from") > expected), "gap")
    )
    neighbours = dim.select(key, "effective_from", issue.alias("issue")).filter("issue IS NOT NULL")
    several = (
        dim.filter("is_current")
        .groupBy(key)
        .agg(F.count("*").alias("_n"), F.max("effective_from").alias("effective_from"))
        .filter("_n > 1")
        .select(key, "effective_from", F.lit("several_current").alias("issue"))
    )
    return neighbours.unionByName(several)


def point_in_time(
    facts: DataFrame, dim: DataFrame, fact_key: str, fact_time: str, dim_key: str, carry: Sequence[str]
) -> DataFrame:
    """Each fact row with the version valid on its day; NULLs when there was none.

    Versions are repeated for each calendar year they cover and the year joins the equi key. A
    fact row then meets at most a year of versions of its key, and a hot key spreads over years.
    """
    day = F.to_date(F.col(f"f.{fact_time}"))
    last_year = facts.select(F.year(F.max(fact_time))).scalar()
    covered = F.sequence(F.year("effective_from"), F.greatest(F.year("effective_from"), F.coalesce(F.year("effective_to"), last_year)))
    versions = dim.select(
        F.col(dim_key).alias("_key"), "effective_from", "effective_to", *[F.col(c).alias(f"_v_{c}") for c in carry],
        F.explode(covered).alias("_year"),
    )
    matches = (
        (F.col(f"f.{fact_key}") == F.col("d._key"))
        & (F.year(day) == F.col("d._year"))
        & (day >= F.col("d.effective_from"))
        & (F.col("d.effective_to").isNull() | (day <= F.col("d.effective_to")))
    )
    joined = facts.alias("f").join(versions.alias("d"), matches, "left")
    return joined.select("f.*", *[F.col(f"d._v_{c}").alias(c) for c in carry])


def calendar(span: DataFrame) -> DataFrame:
    """One row per day from a one-row frame (first_day, last_day); both ends included.

    Weeks are ISO, Monday is day 1, and the fiscal year starts on 1 October and bears the year
    it started in.
    """
    days = span.select(F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    d = F.col("full_date")
    month_start = F.day(d) == 1
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.day(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.when(F.month(d) >= 10, F.year(d)).otherwise(F.year(d) - 1).alias("fiscal_year"),
        F.weekofyear(d).alias("week_of_year"),
        month_start.alias("is_month_start"),
        (month_start & F.month(d).isin(1, 4, 7, 10)).alias("is_quarter_start"),
    )


def year_span(df: DataFrame, time: str) -> DataFrame:
    """Whole years that cover a column, as input for ``calendar``."""
    return df.agg(
        F.trunc(F.min(time), "year").alias("first_day"),
        F.date_sub(F.add_months(F.trunc(F.max(time), "year"), 12), 1).alias("last_day"),
    )


def calendar_gaps(df: DataFrame, day: str = "full_date", by: Sequence[str] = ()) -> DataFrame:
    """Missing days between neighbouring dates, per group if given.

    Rows are reduced to distinct days first. Neighbours are found within a month, and one edge
    row per month finds the neighbour across months, so no window group grows with the data.
    """
    by = list(by)
    days = df.select(*by, F.to_date(day).alias("full_date")).distinct()
    monthly = days.withColumn("_month", F.trunc("full_date", "month"))
    inside = monthly.withColumn(
        "previous_date", F.lag("full_date").over(Window.partitionBy(*by, "_month").orderBy("full_date"))
    ).filter("previous_date IS NOT NULL")
    edges = monthly.groupBy(*by, "_month").agg(F.min("full_date").alias("full_date"), F.max("full_date").alias("_last"))
    across = edges.withColumn(
        "previous_date", F.lag("_last").over(Window.partitionBy(*by).orderBy("_month"))
    ).filter("previous_date IS NOT NULL")
    columns = [*by, "previous_date", "full_date"]
    pairs = inside.select(*columns).unionByName(across.select(*columns))
    return pairs.withColumn("missing_days", F.datediff("full_date", "previous_date") - 1).filter("missing_days > 0")


def junk(df: DataFrame, flags: Sequence[str], existing: DataFrame | None = None, key: str = "junk_key") -> DataFrame:
    """Every combination of low-cardinality flags that occurs, numbered from 1.

    Keys already given out stay; new combinations are numbered after them. The numbering sorts
    distinct combinations only, whose number the flags' domains bound.
    """
    found = df.select(*flags).distinct()
    if existing is None:
        ordered = Window.orderBy(*[F.col(f).asc_nulls_first() for f in flags])
        return found.select(F.row_number().over(ordered).alias(key), *flags)
    same = [found[f].eqNullSafe(existing[f]) for f in flags]
    new = found.join(existing, same, "left_anti")
    top = existing.select(F.coalesce(F.max(key), F.lit(0))).scalar()
    ordered = Window.orderBy(*[F.col(f).asc_nulls_first() for f in flags])
    numbered = new.select((F.row_number().over(ordered) + top).alias(key), *flags)
    return existing.select(key, *flags).unionByName(numbered)
