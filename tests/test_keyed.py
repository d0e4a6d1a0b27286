from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratiform.operators import keyed
from stratiform.sources import tables

SCHEMA = "k int, g string, v int, w string"
TARGET = [(1, "a", 10, "x"), (2, "a", 20, "y"), (3, "b", None, None)]


@pytest.fixture()
def target(spark):
    return spark.createDataFrame(TARGET, SCHEMA)


def test_matched_rows_are_replaced_and_new_rows_added(spark, target, rows_of):
    source = spark.createDataFrame([(2, "c", None, "z"), (4, "d", 40, None)], SCHEMA)
    assert rows_of(keyed.upsert(target, source, ["k"])) == [
        (1, "a", 10, "x"), (2, "c", None, "z"), (3, "b", None, None), (4, "d", 40, None)
    ]


@pytest.mark.parametrize("stage", [False, True])
def test_columns_the_source_lacks_keep_their_value(spark, target, rows_of, stage):
    source = spark.createDataFrame([(9, 2), (8, 5)], "v int, k int").withColumn("ignored", F.lit(1))
    assert rows_of(keyed.upsert(target, source, ["k"], stage=stage)) == [
        (1, "a", 10, "x"), (2, "a", 9, "y"), (3, "b", None, None), (5, None, 8, None)
    ]


def test_source_of_keys_only_leaves_matches_alone(spark, target, rows_of):
    source = spark.createDataFrame([(2,), (7,)], "k int")
    assert rows_of(keyed.upsert(target, source, ["k"])) == sorted([*TARGET, (7, None, None, None)], key=repr)


def test_two_column_key(spark, target, rows_of):
    source = spark.createDataFrame([(2, "b", 1, "n"), (3, "b", 2, "n")], SCHEMA)
    assert rows_of(keyed.upsert(target, source, ["k", "g"])) == [
        (1, "a", 10, "x"), (2, "a", 20, "y"), (2, "b", 1, "n"), (3, "b", 2, "n")
    ]


def test_empty_sides(spark, target, rows_of):
    none = spark.createDataFrame([], SCHEMA)
    assert rows_of(keyed.upsert(target, none, ["k"])) == sorted(TARGET, key=repr)
    assert rows_of(keyed.upsert(none, target, ["k"])) == sorted(TARGET, key=repr)


@pytest.mark.parametrize("bad", [[(2, "c", 1, "z"), (2, "d", 2, "z")], [(None, "c", 1, "z")]])
def test_repeated_or_null_source_keys_fail(spark, target, bad):
    with pytest.raises(Exception, match="upsert source"):
        keyed.upsert(target, spark.createDataFrame(bad, SCHEMA), ["k"]).collect()


def test_missing_key_column_fails(spark, target):
    with pytest.raises(ValueError, match="key columns missing"):
        keyed.upsert(target, spark.createDataFrame([(1,)], "v int"), ["k"])


def test_array_columns_survive(spark, rows_of):
    target = spark.createDataFrame([(1, ["a"])], "k int, tags array<string>")
    source = spark.createDataFrame([(2,)], "k int").withColumn("tags", F.array(F.lit("b")))
    assert rows_of(keyed.upsert(target, source, ["k"]), "k", F.array_join("tags", ",")) == [(1, "a"), (2, "b")]


ROW = st.tuples(st.integers(0, 6), st.sampled_from("ab"), st.none() | st.integers(0, 3), st.none() | st.sampled_from("xy"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, unique_by=lambda r: r[0]), st.lists(ROW, unique_by=lambda r: r[0]))
def test_upsert_is_what_a_dictionary_does_and_idempotent(spark, rows_of, old, new):
    target, source = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)
    once = keyed.upsert(target, source, ["k"])
    assert rows_of(once) == sorted({**{r[0]: r for r in old}, **{r[0]: r for r in new}}.values(), key=repr)
    assert rows_of(keyed.upsert(once, source, ["k"])) == rows_of(once)


def test_small_source_does_not_shuffle_the_target(spark, folder):
    spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v")).write.parquet(f"{folder}/t")
    target = spark.read.parquet(f"{folder}/t")
    source = spark.range(3).select(F.col("id").alias("k"), F.lit("b").alias("v"))
    plan = keyed.upsert(target, source, ["k"], unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_update_where_ignores_unknown(spark, rows_of, target):
    out = keyed.update_where(target, F.col("v") > 10, {"w": F.lit("big"), "v": F.lit("7")})
    assert rows_of(out) == [(1, "a", 10, "x"), (2, "a", 7, "big"), (3, "b", None, None)]


def test_append_fills_missing_columns(spark, target, rows_of):
    out = keyed.append(target, spark.createDataFrame([(9, 1)], "k int, other int"))
    assert (9, None, None, None) in rows_of(out)


def test_overlay_merges_nested_fields_and_fills_defaults(spark, rows_of):
    base = spark.createDataFrame(
        [("a", "x", ("p", 1), {"m": "1", "n": "2"}), ("b", None, None, None)],
        "key string, owner string, conf struct<path:string,n:int>, opts map<string,string>",
    )
    over = spark.createDataFrame(
        [("a", None, ("q", None), {"n": "9", "o": "3"}), ("c", "z", ("r", 5), None), (None, "lost", None, None)],
        "key string, owner string, conf struct<path:string,n:int>, opts map<string,string>",
    )
    got = {r["key"]: r for r in keyed.overlay(base, over, ["key"], {"owner": "nobody"}).collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["a"]["owner"] == "x" and tuple(got["a"]["conf"]) == ("q", 1)
    assert got["a"]["opts"] == {"m": "1", "n": "9", "o": "3"}
    assert got["b"]["owner"] == "nobody" and got["b"]["conf"] is None
    assert got["c"]["owner"] == "z" and tuple(got["c"]["conf"]) == ("r", 5)


def test_default_struct_fills_only_gaps(spark):
    base = spark.createDataFrame([("a", (None, 1)), ("b", None)], "key string, conf struct<path:string,n:int>")
    over = spark.createDataFrame([], base.schema)
    default = F.struct(F.lit("root").alias("path"), F.lit(7).alias("n"))
    got = {r["key"]: tuple(r["conf"]) for r in keyed.overlay(base, over, ["key"], {"conf": default}).collect()}
    assert got == {"a": ("root", 1), "b": ("root", 7)}


def test_versions_are_seen_only_once_complete(spark, folder, rows_of):
    base = f"{folder}/t"
    assert tables.current(spark, base) is None
    assert tables.publish(spark.range(2).toDF("k"), base) == 0
    assert tables.publish(spark.range(3).toDF("k"), base) == 1
    (__import__("pathlib").Path(base) / "version=2").mkdir()
    assert tables.versions(spark, base) == [0, 1]
    assert rows_of(tables.current(spark, base)) == [(0,), (1,), (2,)]
    assert rows_of(tables.current(spark, base, below=1)) == [(0,), (1,)]
    assert tables.publish(spark.range(1).toDF("k"), base, 1) == 1
    assert rows_of(tables.current(spark, base)) == [(0,)]


def test_only_touched_partitions_are_rewritten(spark, folder, rows_of):
    path = f"{folder}/t"
    rows = [(1, "a", 0), (2, "b", 1), (3, "c", 1)]
    spark.createDataFrame(rows, "k int, v string, p int").write.partitionBy("p").parquet(path)
    untouched = {f: f.stat().st_mtime_ns for f in (__import__("pathlib").Path(path) / "p=0").iterdir()}
    source = spark.createDataFrame([(3, "z", 1), (4, "n", 2)], "k int, v string, p int")
    tables.upsert_partitions(spark, path, source, ["k"], "p")
    assert rows_of(spark.read.parquet(path), "k", "v", "p") == [(1, "a", 0), (2, "b", 1), (3, "z", 1), (4, "n", 2)]
    assert untouched == {f: f.stat().st_mtime_ns for f in (__import__("pathlib").Path(path) / "p=0").iterdir()}


def test_null_and_text_partitions_are_neither_lost_nor_doubled(spark, folder, rows_of):
    for name, a, b in (("null", None, None), ("text", "007", "007")):
        path = f"{folder}/{name}"
        tables.upsert_partitions(spark, path, spark.createDataFrame([(1, "a", a), (2, "b", "9")], "k int, v string, p string"), ["k"], "p")
        tables.upsert_partitions(spark, path, spark.createDataFrame([(1, "z", b), (3, "c", b)], "k int, v string, p string"), ["k"], "p")
        assert rows_of(tables.read_partitioned(spark, path), "k", "v", "p") == sorted([(1, "z", a), (2, "b", "9"), (3, "c", b)], key=repr)


def test_rows_older_in_several_columns_stay_out(spark, folder, rows_of):
    held = spark.createDataFrame([(1, 5, 1), (2, 5, None), (3, None, 9)], "k int, t int, u int")
    sent = spark.createDataFrame([(1, 5, 0), (2, 5, 0), (3, 1, 0), (4, None, None)], "k int, t int, u int")
    assert rows_of(keyed.not_older(sent, held, ["k"], ["t", "u"]), "k") == [(2,), (3,), (4,)]
    path = f"{folder}/t"
    for rows in (held, sent):
        tables.upsert_partitions(spark, path, rows.withColumn("p", F.lit(0)), ["k"], "p", by=["t", "u"])
    assert rows_of(tables.read_partitioned(spark, path), "k", "t", "u") == sorted([(1, 5, 1), (2, 5, 0), (3, 1, 0), (4, None, None)], key=repr)


def test_key_bucket_depends_on_the_key_alone(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 3).alias("x"))
    pairs = df.withColumn("b", tables.key_bucket(["k"], 8))
    assert pairs.filter("b < 0 OR b > 7").count() == 0
    assert pairs.select("k", "b").distinct().count() == 100


def test_clustered_bucketed_routed_and_tagged_writes(spark, folder, rows_of):
    df = spark.createDataFrame([(3, "silver"), (1, "silver_restricted"), (2, "silver")], "k int, layer_schema string")
    tables.write_clustered(df, f"{folder}/c", ["k"], 2)
    assert rows_of(spark.read.parquet(f"{folder}/c"), "k") == [(1,), (2,), (3,)]
    tables.write_routed(df, f"{folder}/r")
    assert rows_of(spark.read.parquet(f"{folder}/r/layer_schema=silver_restricted")) == [(1,)]
    tagged = tables.tagged(df, {"k": {"layer": "silver", "entity": "orders"}})
    assert tagged.schema["k"].metadata == {"layer": "silver", "entity": "orders"}
    tables.write_bucketed(df, "bucketed_rows", ["k"], 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.table("bucketed_rows")
        plan = left.join(spark.table("bucketed_rows"), "k")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_rows")


def test_timestamps_keep_their_type(spark):
    target = spark.createDataFrame([(1, datetime(2024, 1, 1))], "k int, t timestamp_ntz")
    source = spark.createDataFrame([(2, "2024-02-02 10:00:00")], "k int, t string")
    out = keyed.upsert(target, source, ["k"])
    assert dict(out.dtypes)["t"] == "timestamp_ntz" and out.filter("k = 2").first()["t"] == datetime(2024, 2, 2, 10)


def test_widen_adds_new_columns(spark, target, rows_of):
    source = spark.createDataFrame([(1, "a", 5, "w", 1.5)], SCHEMA + ", z double")
    out = keyed.upsert(target, source, ["k"], widen=True)
    assert rows_of(out, "k", "v", "z") == [(1, 5, 1.5), (2, 20, None), (3, None, None)]


def test_expire_keeps_the_newest_versions(spark, folder):
    for _ in range(4):
        tables.publish(spark.range(1), f"{folder}/t")
    assert tables.expire(spark, f"{folder}/t", 2) == [0, 1]
    assert tables.versions(spark, f"{folder}/t") == [2, 3]
    assert tables.expire(spark, f"{folder}/t", 0) == [2]
