"""Row-level quality checks. Each one is a boolean column: true means the row is fine."""

from __future__ import annotations

from functools import reduce
from typing import Any, Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratiform.functions.values import col
from stratiform.spec import Contract, Rule


def not_null(column: str) -> Column:
    return F.col(column).isNotNull()


def all_not_null(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [not_null(c) for c in columns])


def freshness(column: str = "_source_extract_ts", as_of: Column | None = None, max_age_hours: int = 24) -> Column:
    """At most ``max_age_hours`` old; a row without a time is stale."""
    now = F.current_timestamp() if as_of is None else as_of
    return F.coalesce(F.col(column) >= now - F.expr(f"INTERVAL {int(max_age_hours)} HOURS"), F.lit(False))


def no_future(column: str = "date", as_of: Column | None = None) -> Column:
    """Not after the day of ``as_of``; NULL passes, the contract decides about NULLs."""
    today = F.current_date() if as_of is None else F.to_date(as_of)
    return F.col(column).isNull() | (F.to_date(F.col(column)) <= today)


def allowed_values(column: str, values: Iterable[Any]) -> Column:
    """In the list, or NULL."""
    return F.col(column).isNull() | F.col(column).isin(list(values))


def expanded(sql: str, keys: Iterable[str] = ()) -> str:
    """The text with the key columns for ``{primary_key_columns}``."""
    return sql.replace("{primary_key_columns}", ", ".join(f"`{k}`" for k in keys))


def expression(sql: str, keys: Iterable[str] = ()) -> Column:
    """A SQL predicate; ``{primary_key_columns}`` expands to the key columns."""
    return F.expr(expanded(sql, keys))


def key_present(keys: Iterable[str]) -> Column:
    return all_not_null(keys)


def unique(helper: str = "_key_count") -> Column:
    """Needs the helper column of ``quality.with_key_count``."""
    return F.col(helper) == 1


def exists(column: str, helper: str = "_reference_found") -> Column:
    """Needs the helper column of ``quality.with_reference``; NULL references pass."""
    return F.col(column).isNull() | F.col(helper)


LIBRARY: dict[str, Callable[..., Column]] = {
    "not_null": not_null,
    "key_present": key_present,
    "freshness": freshness,
    "no_future": no_future,
    "allowed_values": allowed_values,
    "unique": unique,
    "exists": exists,
}


def predicate(rule: Rule, keys: Iterable[str] = (), as_of: Column | None = None) -> Column:
    """Compile a rule. UNKNOWN counts as a violation."""
    if rule.expression is not None:
        test = expression(rule.expression, keys)
    else:
        if rule.check not in LIBRARY:
            raise ValueError(f"rule {rule.name!r} names an unknown check {rule.check!r}")
        params: Mapping[str, Any] = dict(rule.params)
        if as_of is not None and rule.check in ("freshness", "no_future"):
            params = {"as_of": as_of, **params}
        test = LIBRARY[rule.check](**params)
    return F.coalesce(col(test), F.lit(False))


def contract_rules(contract: Contract, action: str = "quarantine") -> list[Rule]:
    """Row-level rules a contract implies."""
    rules = []
    for c in contract.columns:
        if not c.nullable or c.primary_key:
            rules.append(Rule(f"{c.name}_not_null", check="not_null", action=action, params={"column": c.name}))
        if c.allowed_values:
            rules.append(
                Rule(
                    f"{c.name}_allowed",
                    check="allowed_values",
                    action=action,
                    params={"column": c.name, "values": list(c.allowed_values)},
                )
            )
    return rules
