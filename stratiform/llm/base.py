"""What the training-data operators share: text columns, sizes, distinct texts, registration."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.session import scratch_dir, size_shuffles, stored_bytes, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Rows of an Arrow batch: texts may be long, and a batch is held in memory as a whole.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators.

    Workers look for this package where the driver has it, beside their own path; on a cluster it is installed.
    """
    tune(spark)
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def query(name: str, *tables: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query over ``tables``, with the SQL that checks it."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            size_shuffles(spark, sum(stored_bytes(spark, f"{sf_dir}/{t}.parquet") for t in tables))
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filled(text: str | Column) -> Column:
    """The text, empty instead of NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, packed tightly."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: str) -> Column:
    """128 bits that stand for a text, NULL as the empty one."""
    return F.unhex(F.md5(filled(text)))


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``key``, ``text`` and the number of rows ``copies`` of each different text.

    Copies meet in the tasks that read them first, so a hot group sends one row per task. The
    result is written once; rows are found again by the content, not by where they lie.
    """
    rows = docs.select(text_key(text).alias("key"), filled(text).alias("text"))
    grouped = rows.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    return stored(grouped, "texts")
