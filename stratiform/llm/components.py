"""Connected components of a link table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.base import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node that it reaches, for each node of ``links`` (``a``, ``b``).

    Each round gives a node the smallest label among its neighbours and then the label of that
    label, so distances shrink by more than half; rounds end when nothing changes. Each round is a
    written table. A node with very many links is reduced before the shuffle.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        nearer = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        after = stored(nearer.join(jump, "mid").select("node", "old", F.least("mid", "far").alias("label")), "labels")
        labels = after.drop("old")
        if after.where("label <> old").isEmpty():
            return labels
