"""Plans of all queries as they would be at scale: no joins without an equi key, no Python in the rows."""

import pytest
from pyspark.sql import functions as F

from stratiform.plans.catalogue import QUERIES
from stratiform.operators import quality

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups")
# Windows without a partition run over rows whose number is bounded: months, days, flag combinations.
BOUNDED_WINDOWS = {"calendar_gap_check_whole", "rule_volume_anomaly", "dim_junk", "dim_junk_extend", "fact_with_junk_key"}


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield {
            name: run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            for name, run in QUERIES.items()
            if not name.startswith(("bronze_", "stream_", "schema_", "silver_job", "reprocess_job"))
        }
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_cross_joins_and_no_python_rows(plans):
    assert {n: [f for f in FORBIDDEN if f in p] for n, p in plans.items() if any(f in p for f in FORBIDDEN)} == {}


def test_windows_without_partition_are_the_bounded_ones(plans):
    lines = {n: [line for line in p.splitlines() if "Window [" in line] for n, p in plans.items()}
    # After its expressions a window prints its partition keys and its order, or the order alone.
    loose = {n for n, ws in lines.items() if any(w.split(" AS ")[-1].count("], [") == 1 for w in ws)}
    assert "dim_junk" in loose and loose <= BOUNDED_WINDOWS


def test_filters_and_columns_reach_the_scan(plans):
    pushed = "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-20T00:00)]"
    assert pushed in plans["incremental_filter"]
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plans["agg_daily_counts"]
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plans["duplicate_key_check"]


def test_hot_join_keys_are_split(spark):
    """A third of the rows on one key: AQE cuts that partition of the join instead of one task taking it."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        ids = spark.range(0, 600_000, 1, 8)
        facts = ids.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        checked = quality.with_reference(facts, "k", ids.select("id"), "id")
        assert checked.filter("_reference_found").count() == 600_000
        counted = checked.agg(F.count("v"), F.count_if("_reference_found"))
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
