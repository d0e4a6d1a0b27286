"""Rules whose expressions hold window functions."""

import pytest
from pyspark.sql import functions as F

from stratiform.operators import quality
from stratiform.plans.silver import QualityFailure, run_silver, silver_refresh
from stratiform.sources import tables
from stratiform.spec import Entity, Rule

DEFAULT = "COUNT(*) OVER (PARTITION BY {primary_key_columns}) = 1"
ROWS = [(1, "a", 1, 10), (1, "a", 2, 20), (2, "b", 1, 30), (3, None, 1, 40), (3, None, 5, 50), (4, "over (", 7, 60)]


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(ROWS, "id int, g string, v int, w int")


@pytest.mark.parametrize(
    ("sql", "bad", "helpers"),
    [
        (DEFAULT, {10, 20, 40, 50}, 1),
        ("count(1) over(partition by g) < 2", {10, 20, 40, 50}, 1),
        ("v = max(v) OVER (PARTITION BY id, g)", {10, 40}, 1),
        ("v * 2 > sum(v) over (partition by v % 2)", {10, 30, 40, 50, 60}, 1),
        ("count(*) over (partition by id) = 1 OR sum(v) over (partition by g) > 3", {10, 20}, 2),
        ("row_number() over (partition by id order by v) = 1", {20, 50}, 1),
        ("count(*) over (partition by id) = 1 or row_number() over (partition by id order by v desc) = 1", {10, 40}, 2),
        ("coalesce(g, '') <> 'over ('", {60}, 0),
        ("count(g) over (partition by id) >= 1", {40, 50}, 1),
    ],
)
def test_windows_become_columns(spark, rows, sql, bad, helpers):
    outcome = quality.apply_rules(rows, [Rule("r", sql, action="quarantine")], ["id"])
    assert {r["w"] for r in outcome.quarantine.collect()} == bad and {r["w"] for r in outcome.clean.collect()} == {r[3] for r in ROWS} - bad
    assert outcome.clean.columns == ["id", "g", "v", "w"]
    assert outcome.metrics.first()["n_failed"] == len(bad)
    assert len(quality.with_helpers(rows, [Rule("r", sql)], ["id"])[2]) == helpers


def test_whole_groups_are_aggregated_and_not_windowed(spark, rows):
    df, left, _ = quality.with_windows(rows, "count(*) over (partition by id) = 1 and sum(v) over (partition by g) > 0", "h")
    plan = df.filter(left)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Aggregate" in plan and left == "`h_0` = 1 and `h_1` > 0"


def test_a_hot_group_is_counted_before_it_is_shuffled(spark):
    hot = spark.range(0, 30_000, 1, 6).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id")
    df, left, _ = quality.with_windows(hot, "sum(id) over (partition by k) > 0", "h")
    assert df.filter(left).count() == 30_000
    assert "partial_sum" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("action", "clean", "held"), [("warn", [1, 2], 0), ("drop", [2], 0), ("quarantine", [2], 1)])
@pytest.mark.parametrize("rule", [{"check": "unique"}, {"expression": DEFAULT}])
def test_silver_counts_keys_before_it_dedupes(spark, folder, rule, action, clean, held):
    entity = Entity("things", ("id",), "t", rules=(Rule("one", action=action, **rule),))
    bronze = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 1, "d")], "id int, t int, v string")
    report = run_silver(spark, bronze, entity, f"{folder}/s", f"{folder}/q")
    assert report["violations"] == {"one": 1} and report["counts"]["n_duplicates"] == 1
    silver = tables.current(spark, f"{folder}/s")
    assert sorted(r["id"] for r in silver.collect()) == clean and "_rule_0" not in "".join(silver.columns)
    assert tables.current(spark, f"{folder}/q").count() == held
    assert sorted(r["id"] for r in silver_refresh(bronze, entity).silver.collect()) == clean


def test_the_default_rule_stops_a_run_with_repeated_keys(spark, folder):
    entity = Entity("things", ("id",), "t", rules=(Rule("one", DEFAULT),))
    twice = spark.createDataFrame([(1, 1), (1, 2)], "id int, t int")
    with pytest.raises(QualityFailure, match="one"):
        run_silver(spark, twice, entity, f"{folder}/s", f"{folder}/q")
    assert run_silver(spark, twice.limit(1), entity, f"{folder}/s", f"{folder}/q")["counts"]["n_clean"] == 1
