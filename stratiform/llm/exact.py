"""Exact dedup by a persistent index of digests, bucketed and sorted by digest.

New rows are reduced to one row per digest, anti-joined with the index by sort-merge (the index
side is neither shuffled nor moved), and what is left is appended. All of it is DataFrame
functions. Defined results:

* texts are equal when identical after each run of white space (space, tab to carriage return)
  became one space; NULL counts as the empty text;
* of the equal rows of a batch the one with the smallest key stays, a NULL key comes last, and of
  rows with one key exactly one stays;
* a digest that an earlier batch brought belongs to that batch's row, whatever its key;
* an empty table gives an empty result and leaves the index as it was;
* input columns ride along in ``row``, so their names cannot clash with those made here.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.base import filled, partitions, stored
from stratiform.session import scratch_dir

_COLUMNS = "digest binary, batch string, keep_place bigint"


def normalised(text: str) -> Column:
    """The text with each run of white space as one space."""
    return F.regexp_replace(filled(text), r"[\x20\x09-\x0D]+", " ")


def digest(text: str) -> Column:
    """SHA-256 of the normalised text."""
    return F.unhex(F.sha2(normalised(text), 256))


@dataclass(frozen=True)
class DigestIndex:
    """A table of digests with the row that each belongs to."""

    spark: SparkSession
    name: str

    @classmethod
    def create(cls, spark: SparkSession, name: str, key_type: str, path: str | None = None, buckets: int | None = None) -> DigestIndex:
        """An empty index in ``buckets`` files per append (default: the shuffle partitions)."""
        index = cls(spark, name)
        empty = spark.createDataFrame([], f"{_COLUMNS}, keep_key {key_type}")
        writer = empty.write.bucketBy(buckets or partitions(spark), "digest").sortBy("digest")
        (writer.option("path", path) if path else writer).saveAsTable(name)
        return index

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def buckets(self) -> int:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.name}").where("col_name = 'Num Buckets'").collect()
        return int(rows[0].data_type)

    def append(self, staged: DataFrame) -> None:
        """Add the digests of ``staged`` rows that the index lacks, each with its first row.

        The anti-join drops what is known, so appending a batch again changes nothing.
        """
        order = F.struct(F.col("key").isNull().alias("last"), "key", "place", "batch")
        # written, since Catalyst would otherwise move the anti-join below the grouping, to all copies
        first = stored(staged.groupBy("digest").agg(F.min(order).alias("first")), "digest-firsts")
        fresh = first.join(self.read().hint("merge"), "digest", "left_anti")
        (
            fresh.select("digest", "first.batch", F.col("first.place").alias("keep_place"), F.col("first.key").alias("keep_key"))
            .write.bucketBy(self.buckets(), "digest").sortBy("digest").mode("append").saveAsTable(self.name)
        )


def stage(docs: DataFrame, key: str = "doc_id", text: str = "text", columns: bool = True) -> DataFrame:
    """Rows with their digest, key and a place that tells rows with one key apart, written once.

    ``columns`` keeps all input columns as the struct ``row``; without it only the key stays.
    """
    made = [F.col(key).alias("key"), digest(text).alias("digest"), F.monotonically_increasing_id().alias("place")]
    rows = docs.select(*([F.struct("*").alias("row")] if columns else []), *made, F.lit(uuid.uuid4().hex).alias("batch"))
    return stored(rows, "digests")


def decide(index: DigestIndex, staged: DataFrame) -> DataFrame:
    """``staged`` rows with ``keep_key``, ``group_size`` (their copies in ``staged``) and ``kept``.

    Groups are counted before they meet the index, and the join back to rows is a shuffle on both
    sides, which AQE splits where one group of copies is hot.
    """
    sizes = staged.groupBy("digest").agg(F.count("*").alias("group_size"))
    kept = index.read().withColumnsRenamed({"batch": "keep_batch"})
    groups = stored(sizes.join(kept.hint("merge"), "digest"), "digest-groups")
    is_kept = (F.col("place") == F.col("keep_place")) & (F.col("batch") == F.col("keep_batch"))
    return staged.join(groups, "digest").withColumn("kept", is_kept)


def new_index(spark: SparkSession, key_type: str = "bigint") -> DigestIndex:
    """An index of its own under the shared scratch folder."""
    return DigestIndex.create(spark, f"digest_index_{uuid.uuid4().hex}", key_type, scratch_dir(spark, "digest-index"))


def unique(docs: DataFrame, index: DigestIndex | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are first with their text, all columns as they were."""
    index = index or new_index(docs.sparkSession, docs.schema[key].dataType.simpleString())
    staged = stage(docs, key, text)
    index.append(staged.drop("row"))
    return decide(index, staged).where("kept").select("row.*")
