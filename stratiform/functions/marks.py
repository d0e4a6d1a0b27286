"""Watermarks of any ordered type as text that sorts like the values.

A mark is a letter for the kind of value, a sign and digits of fixed width, those of negative
numbers complemented to nine, so that comparing two marks as text compares their values, and the
newest of many is their ``max``. Marks are written and read back by Spark, as columns: a value
never becomes a Python object on the way, so neither the driver's time zone nor Python's range of
dates touches it. Text watermarks are marked as they are, by their bytes.

Zoned times count microseconds of the instant and zone-less ones those of their own fields; a mark
of one kind read for the other goes through the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The letter of each kind, and the digits of each number.
WHOLE, EXACT, REAL, DAY, INSTANT, LOCAL, TEXT = "i", "n", "r", "d", "t", "z", "s"
_WIDTH = {WHOLE: 19, EXACT: 38, REAL: 19, DAY: 19, INSTANT: 19, LOCAL: 19}
_NINES = ("0123456789", "9876543210")

_DAY = 86_400_000_000
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def kind(dtype: T.DataType) -> str:
    """The letter for values of a type."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return WHOLE
    if isinstance(dtype, T.DecimalType):
        return f"{EXACT}{dtype.scale:02d}"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return REAL
    if isinstance(dtype, T.DateType):
        return DAY
    if isinstance(dtype, T.TimestampType):
        return INSTANT
    if isinstance(dtype, T.TimestampNTZType):
        return LOCAL
    if isinstance(dtype, T.StringType):
        return TEXT
    raise ValueError(f"no watermark can be of type {dtype.simpleString()}")


def _digits(number: Column, width: int) -> Column:
    """Sign and digits of a whole number."""
    text = number.cast("string")
    return F.when(text.startswith("-"), F.concat(F.lit("0"), F.translate(F.lpad(F.substring(text, 2, 40), width, "0"), *_NINES))).otherwise(
        F.concat(F.lit("1"), F.lpad(text, width, "0"))
    )


def local_micros(value: Column) -> Column:
    """Microseconds of a zone-less time since 1970, whatever the session zone."""
    days = F.datediff(value.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * _DAY
    seconds = F.date_part(F.lit("SECOND"), value)
    return days + (F.hour(value) * 60 + F.minute(value)).cast("bigint") * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def mark(value: Column, dtype: T.DataType) -> Column:
    """The mark of a value; NULL has none."""
    letter = kind(dtype)
    if letter == TEXT:
        return F.concat(F.lit(TEXT), value)
    if letter[0] == EXACT:
        number, width = (value.cast(f"decimal(38,{dtype.scale})").cast("string")), _WIDTH[EXACT]
        number = F.replace(number, F.lit("."), F.lit(""))
        signed = F.regexp_replace(number, r"^(-?)0+(?=\d)", "$1")
        return F.concat(F.lit(letter), _digits(signed, width))
    if letter == REAL:  # the bits of a double sort as a number if those of negatives are turned
        bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0)).cast("bigint")
        turned = F.when(bits < 0, F.bitwise_not(bits.bitwiseAND(0x7FFFFFFFFFFFFFFF))).otherwise(bits)
        return F.when(value.isNotNull(), F.concat(F.lit(letter), _digits(turned, _WIDTH[letter])))
    number = {
        WHOLE: value.cast("bigint"),
        DAY: F.datediff(value, F.lit("1970-01-01").cast("date")),
        INSTANT: F.unix_micros(value) if letter == INSTANT else value,
        LOCAL: local_micros(value) if letter == LOCAL else value,
    }[letter]
    return F.concat(F.lit(letter), _digits(number, _WIDTH[letter]))


def value(text: str, dtype: T.DataType) -> Column:
    """The value of a mark as a constant column of a type, which reaches a scan as a pushed filter.

    A mark of another kind is an error, but for the two kinds of times.
    """
    wanted, held = kind(dtype), text[:3] if text[:1] == EXACT else text[:1]
    if held != wanted and {held, wanted} != {INSTANT, LOCAL}:
        raise ValueError(f"mark {text!r} is no {dtype.simpleString()}")
    if held == TEXT:
        return F.lit(text[1:])
    sign, digits = text[len(held)], text[len(held) + 1 :]
    number = int(digits) if sign == "1" else -int(digits.translate(str.maketrans(*_NINES)))
    if held == WHOLE:
        return F.lit(number).cast(dtype)
    if held[0] == EXACT:
        unscaled, scale = str(abs(number)).zfill(dtype.scale + 1), dtype.scale
        whole, part = (unscaled[:-scale], unscaled[-scale:]) if scale else (unscaled, "0")
        return F.lit(f"{'-' * (number < 0)}{whole}.{part}").cast(dtype)
    if held == REAL:
        bits = number if number >= 0 else ~number - (1 << 63)
        return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), F.lit(bits).cast("bigint")).cast("double").cast(dtype)
    if held == DAY:
        return F.date_add(F.lit("1970-01-01").cast("date"), F.lit(number))
    if held == INSTANT:
        return F.timestamp_micros(F.lit(number).cast("bigint")).cast(dtype)
    days, rest = divmod(number, _DAY)
    return F.expr(f"{_EPOCH} + make_dt_interval({days}, 0, 0, CAST('{rest // 1_000_000}.{rest % 1_000_000:06d}' AS DECIMAL(18, 6)))").cast(dtype)
