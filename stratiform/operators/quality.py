"""Quality rules over a DataFrame: split, gate, metrics, and table-level helper columns."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from functools import reduce
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from stratiform.functions import checks
from stratiform.spec import Rule

FAILED = "failed_rules"
DROPPED = "_dropped"


@dataclass(frozen=True)
class Outcome:
    """``clean`` and ``quarantine`` partition the input, less the dropped rows."""

    clean: DataFrame
    quarantine: DataFrame
    metrics: DataFrame


def _failing(rules: Sequence[Rule], keys: Sequence[str], as_of: Column | None) -> Column:
    names = [F.when(~checks.predicate(r, keys, as_of), F.lit(r.name)) for r in rules]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def with_results(
    df: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = (), as_of: Column | None = None
) -> DataFrame:
    """Evaluate every rule once per row.

    ``failed_rules`` lists the failing drop and quarantine rules in rule order and ``_dropped``
    tells whether a drop rule is among them. A dropped row is never quarantined.
    """
    blocking = [r for r in rules if r.effect in ("drop", "quarantine")]
    dropping = [r for r in rules if r.effect == "drop"]
    dropped = reduce(lambda a, b: a | b, [~checks.predicate(r, keys, as_of) for r in dropping], F.lit(False))
    return df.withColumns({FAILED: _failing(blocking, keys, as_of), DROPPED: dropped})


def clean_rows(results: DataFrame) -> DataFrame:
    return results.filter(F.size(FAILED) == 0).drop(FAILED, DROPPED)


def quarantined_rows(results: DataFrame) -> DataFrame:
    return results.filter((F.size(FAILED) > 0) & ~F.col(DROPPED)).drop(DROPPED)


def gate(df: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = (), as_of: Column | None = None) -> DataFrame:
    """The same rows; reading them fails at the first violation of a ``fail`` rule."""
    out = df
    for rule in rules:
        if rule.effect != "fail":
            continue
        abort = F.raise_error(F.lit(f"quality rule {rule.name} failed")).cast("boolean")
        out = out.filter(F.when(checks.predicate(rule, keys, as_of), F.lit(True)).otherwise(abort))
    return out


def _counters(rules: Sequence[Rule], keys: Sequence[str], as_of: Column | None) -> list[Column]:
    failed = [
        F.count_if(~checks.predicate(r, keys, as_of)).alias(f"failed_{i}") for i, r in enumerate(rules)
    ]
    return [F.count(F.lit(1)).alias("n_rows"), *failed]


def metrics(
    df: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = (), as_of: Column | None = None
) -> DataFrame:
    """One row per rule with the rows seen and the rows that failed, from a single pass."""
    per_rule = [
        F.struct(
            F.lit(r.name).alias("rule_name"),
            F.lit(r.effect).alias("action"),
            F.col("n_rows"),
            F.col(f"failed_{i}").alias("n_failed"),
        )
        for i, r in enumerate(rules)
    ]
    none = F.array().cast("array<struct<rule_name:string,action:string,n_rows:bigint,n_failed:bigint>>")
    listed = F.array(*per_rule) if per_rule else none
    return df.agg(*_counters(rules, keys, as_of)).select(F.inline(listed))


def observe(
    df: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = (), as_of: Column | None = None
) -> tuple[DataFrame, Observation]:
    """Count violations while another action, such as a write, reads the rows."""
    observation = Observation()
    return df.observe(observation, *_counters(rules, keys, as_of)), observation


def observed_failures(rules: Sequence[Rule], observation: Observation) -> dict[str, int]:
    counts = observation.get
    return {r.name: int(counts[f"failed_{i}"]) for i, r in enumerate(rules)}


def apply_rules(
    df: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = (), as_of: Column | None = None
) -> Outcome:
    """Fail, warn, drop, quarantine and log-only actions in one evaluation of the rules."""
    names = [r.name for r in rules]
    if len(set(names)) != len(names):
        raise ValueError("rule names must be unique")
    rows, rules, helpers = with_helpers(df, rules, keys)
    results = with_results(gate(rows, rules, keys, as_of), rules, keys, as_of).drop(*helpers)
    return Outcome(clean_rows(results), quarantined_rows(results), metrics(rows, rules, keys, as_of))


def looks_at_other_rows(rule: Rule) -> bool:
    """Whether a row's result depends on the rows beside it."""
    return rule.check == "unique" or (rule.expression is not None and has_window(rule.expression))


def with_helpers(
    df: DataFrame, rules: Sequence[Rule], keys: Sequence[str] = (), only: Callable[[Rule], bool] = lambda rule: True
) -> tuple[DataFrame, list[Rule], list[str]]:
    """Add the columns that table-level rules need; returns rows, rules that use them, and their names.

    A ``unique`` rule looks at ``columns``, by default the primary key. An ``exists`` rule names
    its ``column``, the ``reference`` DataFrame and the ``reference_column``. An expression may
    hold window functions (see ``with_windows``). ``only`` picks rules; others stay as they are.
    """
    prepared, helpers = [], []
    for number, rule in enumerate(rules):
        helper = f"_rule_{number}"
        if not only(rule):
            prepared.append(rule)
            continue
        if rule.expression is not None and has_window(rule.expression):
            df, text, made = with_windows(df, checks.expanded(rule.expression, keys), helper)
            prepared.append(replace(rule, expression=text))
            helpers += made
            continue
        if rule.check == "unique" and "helper" not in rule.params:
            df = with_key_count(df, list(rule.params.get("columns") or keys), helper)
            rule = replace(rule, params={"helper": helper})
        elif rule.check == "exists" and "reference" in rule.params:
            p = rule.params
            df = with_reference(df, p["column"], p["reference"], p["reference_column"], helper)
            rule = replace(rule, params={"column": p["column"], "helper": helper})
        else:
            prepared.append(rule)
            continue
        prepared.append(rule)
        helpers.append(helper)
    return df, prepared, helpers


_QUOTED = r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\""
# An aggregate over whole groups: no order, no frame, nothing nested.
_OVER_GROUP = re.compile(
    rf"{_QUOTED}|\b(?P<call>(?:count|sum|min|max|avg)\s*\([^()']*\))\s*over\s*\(\s*partition\s+by\s+"
    r"(?P<by>(?:(?!\b(?:order\s+by|rows|range)\b)[^()'])+)\)",
    re.IGNORECASE,
)
_OVER = re.compile(rf"{_QUOTED}|(?P<over>\bover\s*\()", re.IGNORECASE)


def has_window(sql: str) -> bool:
    """Whether an expression holds window functions, outside of quoted text."""
    return any(m["over"] for m in _OVER.finditer(sql))


def with_windows(df: DataFrame, sql: str, out: str) -> tuple[DataFrame, str, list[str]]:
    """Rows with helper columns for the window functions of an expression, what is left of it, and their names.

    Filters and aggregates cannot hold window functions. An aggregate over whole groups becomes a partial
    aggregation that is joined back, so a hot group is neither sorted nor gathered in one task; a count of
    rows joins back repeated groups only. Windows with an order are left to Spark: the whole
    expression becomes a column.
    """
    helpers: list[str] = []

    def taken(m: re.Match) -> str:
        nonlocal df
        if not m["call"]:
            return m[0]
        by, name = [b.strip() for b in m["by"].split(",")], f"{out}_{len(helpers)}"
        whole_rows = re.fullmatch(r"count\s*\(\s*[*1]\s*\)", m["call"], re.IGNORECASE)
        df = with_key_count(df, by, name) if whole_rows and all(_column(df, b) for b in by) else with_group_value(df, by, m["call"], name)
        helpers.append(name)
        return f"`{name}`"

    left = _OVER_GROUP.sub(taken, sql)
    if has_window(left):
        df, left = df.withColumn(out, F.expr(left)), f"`{out}`"
        helpers.append(out)
    return df, left, helpers


def _column(df: DataFrame, text: str) -> bool:
    return text.strip("`") in df.columns


def with_group_value(df: DataFrame, by: Sequence[str], aggregate: str, out: str) -> DataFrame:
    """An aggregate (SQL text) over the group that ``by`` (SQL texts) put a row in; NULL is a group."""
    keys = [f"{out}_by_{n}" for n in range(len(by))]
    groups = df.groupBy(*[F.expr(b).alias(k) for b, k in zip(by, keys)]).agg(F.expr(aggregate).alias(out))
    same = reduce(lambda a, b: a & b, [F.expr(b).eqNullSafe(F.col(k)) for b, k in zip(by, keys)])
    return df.join(groups, same, "left").drop(*keys)


def with_key_count(df: DataFrame, keys: Sequence[str], out: str = "_key_count") -> DataFrame:
    """How often the row's key occurs.

    Counted by a partial aggregation and joined back for repeated keys only: a clean table joins
    with nothing, and a hot key is split by AQE because the counted side has one row per key.
    """
    keys = [k.strip("`") for k in keys]
    repeated = df.groupBy(*keys).agg(F.count("*").alias(out)).filter(F.col(out) > 1)
    marked = repeated.select(*[F.col(k).alias(f"_k_{k}") for k in keys], out)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    joined = df.join(marked, same, "left")
    return joined.withColumn(out, F.coalesce(out, F.lit(1).cast("bigint"))).drop(*[f"_k_{k}" for k in keys])


def with_reference(
    df: DataFrame, column: str, reference: DataFrame, reference_column: str, out: str = "_reference_found"
) -> DataFrame:
    """Whether the row's value occurs in the reference column."""
    known = reference.select(F.col(reference_column).alias("_ref")).distinct().withColumn(out, F.lit(True))
    return df.join(known, F.col(column) == F.col("_ref"), "left").withColumn(
        out, F.coalesce(out, F.lit(False))
    ).drop("_ref")


def orphans(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Rows whose non-NULL value is missing from the reference."""
    known = reference.select(F.col(reference_column).alias("_ref"))
    return df.filter(F.col(column).isNotNull()).join(known, F.col(column) == F.col("_ref"), "left_anti")


def volume_anomaly(
    df: DataFrame, time: str, threshold_pct: float = 0.3, trailing: int = 7, by: Iterable[str] = ()
) -> DataFrame:
    """Rows per day against the mean of the ``trailing`` days before; the first day is never flagged.

    The window runs over one pre-aggregated row per day and group.
    """
    by = list(by)
    daily = df.groupBy(*by, F.to_date(time).alias("day")).agg(F.count("*").alias("n_rows"))
    before = Window.partitionBy(*by).orderBy("day").rowsBetween(-trailing, -1)
    return daily.withColumn("trailing_avg", F.avg("n_rows").over(before)).withColumn(
        "is_anomaly",
        F.coalesce(F.abs(F.col("n_rows") / F.col("trailing_avg") - 1) > threshold_pct, F.lit(False)),
    )


def volume_floors(tables: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """Row count of each table against its floor, as one job."""
    counted = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(floor).cast("bigint").alias("min_rows"),
            (F.col("n_rows") >= floor).alias("is_ok"),
        )
        for name, (df, floor) in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)
