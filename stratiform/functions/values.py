"""Small column expressions: cleansing, templates, JSON text, time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators that do not occur in ordinary text, so that ('a', NULL) and ('a', '') hash apart.
_NULL_MARK = "\u0000"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_code(c: str | Column) -> Column:
    """Trimmed upper-case code."""
    return F.upper(F.trim(col(c)))


def as_date(c: str | Column) -> Column:
    return F.to_date(col(c))


def key_list(c: str | Column) -> Column:
    """``'a, b ,,c'`` as an array of trimmed, non-empty keys."""
    trimmed = F.transform(F.split(col(c), ","), lambda x: F.trim(x))
    return F.filter(trimmed, lambda x: x != "")


def expand_template(c: str | Column, values: Mapping[str, str | Column]) -> Column:
    """Replace ``{name}`` placeholders in a text column."""
    out = col(c)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value if isinstance(value, Column) else F.lit(value))
    return out


def json_field(c: str | Column, path: str) -> Column:
    return F.get_json_object(col(c), path)


def json_or_text(c: str | Column) -> Column:
    """Blank text is NULL, valid JSON objects and arrays are kept in compact form, the rest passes as is."""
    text = F.trim(col(c))
    compact = F.to_json(F.try_parse_json(text))
    looks_json = text.startswith("{") | text.startswith("[")
    return F.when(text == "", F.lit(None)).when(looks_json, F.coalesce(compact, col(c))).otherwise(col(c))


def change_hash(columns: Iterable[str | Column]) -> Column:
    """SHA-256 over tracked columns; NULL and empty text differ.

    Several columns are told apart by the length before each, so no value can pass for two.
    """
    texts = [col(c).cast("string") for c in columns]
    if len(texts) == 1:
        return F.sha2(F.coalesce(texts[0], F.lit(_NULL_MARK)), 256)
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit(_NULL_MARK)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def watermark(value: object, dtype: str = "timestamp") -> Column:
    """A watermark given as a Column, datetime or ISO text (``Z`` allowed) as a typed column.

    A zone-less target takes the instant in the session zone, so ISO text with ``Z`` and
    ``timestamp_ntz`` data agree when the session runs in UTC. A zone-less datetime, as read
    from such data, stays what it is.
    """
    if isinstance(value, datetime) and value.tzinfo is None and dtype == "timestamp_ntz":
        return F.lit(value.isoformat()).cast(dtype)
    if isinstance(value, Typed):
        return value.column.cast(dtype)
    c = value if isinstance(value, Column) else F.lit(value)
    return c.cast("timestamp").cast(dtype)


@dataclass(frozen=True)
class Typed:
    """A value that already has the type of the column it is compared with, or its zoned or zone-less twin."""

    column: Column
