"""Widen-only schema evolution."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Number types in the order one widens into the next.
_NUMBERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


_NUMBERS_OR_EXACT = (*_NUMBERS, T.DecimalType)

# JSON and CSV carry these as text.
_AS_TEXT = (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def _widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether values of ``new`` fit a column declared as ``old``."""
    if old == new or isinstance(new, T.NullType) or isinstance(old, T.StringType):
        return True
    if isinstance(new, T.StringType):
        return isinstance(old, _AS_TEXT)
    kinds = [type(t) for t in (old, new)]
    return all(k in _NUMBERS for k in kinds) and _NUMBERS.index(kinds[1]) <= _NUMBERS.index(kinds[0])


def widen(stored: T.StructType, incoming: T.StructType) -> tuple[T.StructType, list[str]]:
    """Stored schema plus new columns, and the columns whose incoming type no longer fits.

    Stored columns keep their type and position, so rows already written stay readable. A
    conflicting column is read with its stored type; values that do not parse go to rescue.
    """
    known = {f.name.lower(): f for f in stored}
    added = [T.StructField(f.name, f.dataType, True) for f in incoming if f.name.lower() not in known]
    conflicts = [
        f.name for f in incoming if f.name.lower() in known and not _widens(known[f.name.lower()].dataType, f.dataType)
    ]
    kept = [T.StructField(f.name, f.dataType, True, f.metadata) for f in stored]
    return T.StructType([*kept, *added]), conflicts


# Types of VARIANT schemas that are written otherwise as column types. A fraction has the width of its batch
# only, so it becomes a double; what was of several types is text.
_AS_COLUMN = {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "VOID"}
_TYPE_WORDS = re.compile(r"`(?:[^`]|``)*`|DECIMAL\(\d+,\s*\d+\)|\b(?:OBJECT(?=<)|VARIANT|VOID)\b")


def of_variants(text: str | None) -> T.StructType:
    """The column types of ``schema_of_variant_agg`` over JSON objects."""
    if not text or not text.startswith("OBJECT<"):
        return T.StructType()
    names = re.compile(r"(?<=[<,\s])(\w+)(?=:)")
    quoted = names.sub(r"`\1`", text)  # a field may be called like a type

    def written(m: re.Match) -> str:
        return m[0] if m[0][0] == "`" else "DOUBLE" if m[0].startswith("DECIMAL") else _AS_COLUMN[m[0]]

    return _without_nulls(T.DataType.fromDDL(_TYPE_WORDS.sub(written, quoted)))


def _without_nulls(dtype: T.DataType) -> T.DataType:
    """The type without fields that have had no value yet; an array of nothing is one of texts."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _without_nulls(f.dataType)) for f in dtype if not isinstance(f.dataType, T.NullType)])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(T.StringType() if isinstance(dtype.elementType, T.NullType) else _without_nulls(dtype.elementType))
    return dtype


def evolved(stored: T.StructType, found: T.StructType, path: str = "") -> tuple[T.StructType, list[str]]:
    """``widen`` that goes into structs and arrays of structs; conflicts are named by their path."""
    known, fields, conflicts = {f.name: f for f in stored}, [], []
    incoming = {f.name: f.dataType for f in found}
    for f in stored:
        dtype, own = _merged(f.dataType, incoming[f.name], path + f.name) if f.name in incoming else (f.dataType, [])
        fields.append(T.StructField(f.name, dtype, True, f.metadata))
        conflicts += own
    added = [T.StructField(f.name, f.dataType, True) for f in found if f.name not in known]
    return T.StructType([*fields, *added]), conflicts


def _merged(old: T.DataType, new: T.DataType, path: str) -> tuple[T.DataType, list[str]]:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return evolved(old, new, path + ".")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        element, conflicts = _merged(old.elementType, new.elementType, path + "[]")
        return T.ArrayType(element), conflicts
    if isinstance(old, T.MapType) and isinstance(new, T.StructType):
        return old, [c for f in new for c in _merged(old.valueType, f.dataType, f"{path}.{f.name}")[1]]
    if isinstance(old, _NUMBERS_OR_EXACT) and isinstance(new, tuple(_NUMBERS)):
        whole = isinstance(old, (T.FloatType, T.DoubleType, T.DecimalType)) or isinstance(new, T.LongType)
        return old, [] if whole else [path]
    return old, [] if _widens(old, new) else [path]

