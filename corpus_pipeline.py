"""Documents to packed training sequences: the stages and the run over all of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm import exact, minhash, mixing, packing, toxicity
from stratiform.llm.base import prepare, table
from stratiform.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

REJECTED_FROM = 0.3  # the score from which a document goes


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the bound stay; the model is fitted to all labels and to the characters of all texts.

    NULL text is scored as the empty text. Repeated rows and rows of one id are scored each for
    itself, so copies stay or go together; very long texts are scored whole. Nothing is ordered, so ties do not matter; extra columns
    stay whatever their names; an empty table, or one without labels, loses nothing it should keep.
    """
    prepare(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).where(F.col("score") < REJECTED_FROM).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays.

    NULL and empty texts are equal; a NULL id comes after all others; of repeated rows, which tie, one stays.
    Texts of any length are compared by digest; extra columns stay whatever their names; an empty table gives an empty one.
    """
    prepare(spark)
    return exact.unique(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates, linked by 0.8 of their shingles of five words, the row with the smallest id stays.

    NULL and empty texts are linked with nothing and all stay; of rows that tie by id and text one stays, rows of one id with
    different texts are told apart. Very long texts are compared whole; extra columns stay whatever their names; an empty table gives an empty one.
    """
    prepare(spark)
    return minhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mixture of their sources: that of the files by their numbers, and of the rows in them.

    A NULL source is the source named by the empty text, NULL text counts as empty; rows of a source follow
    the hash of id and text, and those that tie keep an order of their own; a very long text takes the time of all its blocks; repeated rows
    and extra columns stay; an empty table gives an empty one.
    """
    prepare(spark)
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence; sequences follow the order in which the rows were written.

    NULL text is an empty document, its end token alone; longer documents are cut into sequences; repeated rows are documents of their own,
    told apart by where they lie, so nothing ties; extra columns are left behind; an empty table gives no pieces.
    """
    prepare(spark)
    return packing.packed_in_order(packing.in_file_order(docs))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned scores and the plan of bins have no SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
