"""Registration of queries."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.session import scratch_dir, size_shuffles, stored_bytes, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# One processing time for all queries, so that results repeat.
AS_OF = "2024-02-01 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that checks it."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            size_shuffles(spark, stored_bytes(spark, sf_dir))
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with -0.0 discounts read as 0.0."""
    return table(spark, sf_dir, "lineitem").withColumn("l_discount", F.col("l_discount") + F.lit(0.0))


def land(df: DataFrame, label: str, fmt: str = "json", path: str | None = None) -> str:
    """Write a table as landed files under the shared scratch folder."""
    target = path or scratch_dir(df.sparkSession, f"landing-{label}")
    writer = df.write.mode("append").format(fmt)
    if fmt in ("json", "csv"):
        writer = writer.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    (writer.option("header", "true") if fmt == "csv" else writer).save(target)
    return target
