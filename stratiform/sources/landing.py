"""Reading landed files and staged snapshots."""

from __future__ import annotations

from typing import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Reader options per landing format.
FORMAT_OPTIONS: dict[str, dict[str, str]] = {
    "json": {},
    "csv": {"header": "true"},
    "parquet": {},
    "text": {},
}
CORRUPT = "_corrupt_record"


def options(fmt: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    return {**FORMAT_OPTIONS[fmt], **(extra or {})}


def infer_schema(
    spark: SparkSession, path: str, fmt: str = "json", sample: float = 1.0, extra: Mapping[str, str] | None = None
) -> T.StructType:
    """Infer column types once, to be pinned for the reads that follow."""
    reader = spark.read.format(fmt).options(**options(fmt, extra))
    if fmt in ("json", "csv"):
        reader = reader.option("samplingRatio", str(sample))
    if fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.load(path).schema


def scan(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    schema: T.StructType | None = None,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """Batch scan of landed files; without a schema the types are inferred first."""
    pinned = schema or infer_schema(spark, path, fmt, extra=extra)
    return spark.read.format(fmt).options(**options(fmt, extra)).schema(pinned).load(path)


def staged(spark: SparkSession, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A connector-written snapshot by table name or path.

    With a schema, a snapshot that does not exist yet reads as an empty table of that schema,
    so that one missing source does not stop a run. Other errors are raised.
    """
    try:
        return spark.read.parquet(name) if "/" in name else spark.read.table(name)
    except AnalysisException as e:
        missing = e.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")
        if schema is None or not missing:
            raise
        return spark.createDataFrame([], schema)


def file_rows(df: DataFrame) -> DataFrame:
    """Rows per source file."""
    return df.groupBy(F.col("_metadata.file_name").alias("file_name")).agg(F.count("*").alias("n_rows"))


def with_rescued(df: DataFrame, text: str, schema: T.StructType, out: str = "_rescued_data") -> DataFrame:
    """Parse a JSON column into the columns of ``schema`` and keep what did not fit as JSON text.

    Rescued are unknown fields and known fields whose value does not have the declared type.
    Text that is not a JSON object is rescued whole under ``_corrupt_record``.
    """
    typed = F.from_json(F.col(text), schema)
    raw = F.from_json(F.col(text), "map<string,string>", {"mode": "PERMISSIVE"})
    parsed = df.withColumns({"_typed": typed, "_raw": raw})
    known = [f.name for f in schema]

    def misfit(key, value):
        lost = F.lit(False)
        for name in known:
            lost = lost | ((key == name) & F.col("_typed")[name].isNull())
        return value.isNotNull() & (~key.isin(known) | lost)

    rest = F.map_filter(F.col("_raw"), misfit)
    whole = F.create_map(F.lit(CORRUPT), F.col(text))
    rescued = F.when(F.col(text).isNull(), F.lit(None)).when(F.col("_raw").isNull(), F.to_json(whole)).when(
        F.size(rest) > 0, F.to_json(rest)
    )
    return parsed.select(*df.columns, *[F.col("_typed")[n].alias(n) for n in known], rescued.alias(out))


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEXTUAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _as(raw: Column, ddl: str) -> Column:
    return F.try_variant_get(raw, F.lit("$"), ddl)


def _member(raw: Column, name: str) -> Column:
    """A field of a JSON object, whatever its name."""
    if '"' not in name and "\\" not in name:
        return F.try_variant_get(raw, F.lit(f'$["{name}"]'), "variant")
    return F.try_element_at(_as(raw, "map<string,variant>"), F.lit(name))


def _there(raw: Column) -> Column:
    return raw.isNotNull() & ~F.is_variant_null(raw)


def _scalar(raw: Column, dtype: T.DataType) -> Column:
    """A JSON value that has the declared type, else NULL: whole numbers are not cut off, text is not read as a number."""
    held, ddl = F.schema_of_variant(raw), dtype.simpleString()
    number = held.startswith("BIGINT") | held.startswith("DECIMAL") | held.startswith("DOUBLE") | held.startswith("FLOAT")
    if isinstance(dtype, T.StringType):
        return F.when(held == "STRING", _as(raw, "string")).when(_there(raw), F.to_json(raw))
    if isinstance(dtype, _WHOLE):
        return F.when(held == "BIGINT", _as(raw, ddl))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(number, _as(raw, ddl))
    if isinstance(dtype, T.DecimalType):
        return F.when(number & (_as(raw, ddl) == _as(raw, "decimal(38,18)")), _as(raw, ddl))
    if isinstance(dtype, T.BooleanType):
        return F.when(held == "BOOLEAN", _as(raw, ddl))
    if isinstance(dtype, _TEXTUAL):
        return F.when(held == "STRING", _as(raw, ddl))
    return F.when(_there(raw), raw) if isinstance(dtype, T.VariantType) else _as(raw, ddl)


def typed(raw: Column, dtype: T.DataType) -> Column:
    """A VARIANT as a declared type, taken apart along it: only what does not fit is NULL, not all around it."""
    if isinstance(dtype, T.StructType):
        fields = [typed(_member(raw, f.name), f.dataType).alias(f.name) for f in dtype]
        return F.when(_as(raw, "map<string,variant>").isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        return F.transform(_as(raw, "array<variant>"), lambda x: typed(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(_as(raw, "map<string,variant>"), lambda _, x: typed(x, dtype.valueType))
    return _scalar(raw, dtype)


def _entry(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def _object(entries: Column) -> Column:
    """Entries that hold something as a JSON object; NULL if none does."""
    held = F.filter(entries, lambda e: _there(e["value"]))
    return F.when(F.size(held) > 0, F.to_variant_object(F.map_from_entries(held)))


def rest(raw: Column, dtype: T.DataType) -> Column:
    """What ``typed`` leaves out, as a VARIANT of the same shape, with elements of arrays by their position; NULL if nothing.

    JSON null is a missing value and never rescued.
    """
    if isinstance(dtype, T.StructType):
        names, members = [f.name for f in dtype], _as(raw, "map<string,variant>")
        unknown = F.map_entries(F.map_filter(members, lambda k, _: ~k.isin(names))) if names else F.map_entries(members)
        known = [_entry(F.lit(f.name), rest(_member(raw, f.name), f.dataType)) for f in dtype]
        return F.when(members.isNotNull(), _object(F.concat(F.array(*known), unknown) if known else unknown)).when(_there(raw), raw)
    if isinstance(dtype, T.ArrayType):
        listed = _as(raw, "array<variant>")
        lost = F.transform(listed, lambda x, i: _entry(i.cast("string"), rest(x, dtype.elementType)))
        return F.when(listed.isNotNull(), _object(lost)).when(_there(raw), raw)
    if isinstance(dtype, T.MapType):
        members = _as(raw, "map<string,variant>")
        lost = F.transform(F.map_entries(members), lambda e: _entry(e["key"], rest(e["value"], dtype.valueType)))
        return F.when(members.isNotNull(), _object(lost)).when(_there(raw), raw)
    return F.when(_there(raw) & _scalar(raw, dtype).isNull(), raw)


def with_rescued_nested(df: DataFrame, text: str, schema: T.StructType, out: str = "_rescued_data") -> DataFrame:
    """``with_rescued`` through structs, arrays and maps: typed and rescued parts together are all of the input.

    A misfit is NULL by itself, and ``out`` holds it where it was, such as ``{"lines":{"1":{"qty":"two"}}}`` for the second line.
    Text that is no JSON object, or has a key twice, is rescued whole under ``_corrupt_record``.
    """
    parsed = df.withColumn("_raw", F.try_parse_json(F.col(text)))
    raw = F.col("_raw")
    whole = F.to_json(F.create_map(F.lit(CORRUPT), F.col(text)))
    fine = _as(raw, "map<string,variant>").isNotNull()
    rescued = F.when(F.col(text).isNull(), F.lit(None)).when(fine, F.to_json(rest(raw, schema))).otherwise(whole)
    kept = [F.when(fine, typed(_member(raw, f.name), f.dataType)).alias(f.name) for f in schema]
    return parsed.select(*[F.col(f"`{c}`") for c in df.columns], *kept, rescued.alias(out))

