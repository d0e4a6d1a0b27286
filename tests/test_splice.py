"""Type 2 versions from batches in any order."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratiform.plans import dimensions

T0 = datetime(2024, 1, 1)
SCHEMA = "k int, a string, b int, t timestamp_ntz"


def frame(spark, rows):
    return spark.createDataFrame([(k, a, b, T0 + timedelta(hours=h)) for k, a, b, h in rows], SCHEMA)


def spliced(spark, batches):
    dim = None
    for rows in batches:
        dim = dimensions.scd2_splice(dim, frame(spark, rows), "k", ["a", "b"], "t").cache()
    return dim


def versions(dim):
    names = ["k", "a", "b", "effective_from", "effective_to", "is_current", "version"]
    return sorted((tuple(r[n] for n in names) for r in dim.select(names).collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_batches_in_any_order_give_the_whole_history(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 2, 3, None]), rng.choice(["x", "y", None]), rng.choice([1, 2]), rng.randrange(240)) for _ in range(60)]
    cuts = sorted(rng.sample(range(1, 60), 3))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 60])]
    dim = spliced(spark, batches)
    assert versions(dim) == versions(dimensions.scd2_build(frame(spark, rows), "k", ["a", "b"], "t"))
    assert dimensions.scd2_issues(dim, "k").count() == 0
    assert versions(dimensions.scd2_splice(dim, frame(spark, batches[1]), "k", ["a", "b"], "t")) == versions(dim)  # sent again


def test_a_late_change_cuts_a_version_between_two_days_it_was_seen(spark):
    dim = spliced(spark, [[(1, "x", 1, 0), (1, "x", 1, 96), (2, "z", 1, 5)], [(1, "y", 1, 48)]])
    assert [(r[1], r[6]) for r in versions(dim) if r[0] == 1] == [("x", 1), ("x", 3), ("y", 2)]
    seen = dim.filter("k = 1 AND version = 3").first()["seen"]
    assert [s["day"].day for s in seen] == [5]


def test_a_same_day_revert_closes_no_version(spark):
    dim = spliced(spark, [[(1, "x", 1, 0)], [(1, "y", 1, 30)], [(1, "x", 1, 40)]])
    assert [(r[1], r[5], r[6]) for r in versions(dim)] == [("x", True, 1)]


def test_an_older_row_of_a_day_changes_nothing(spark):
    first = spliced(spark, [[(1, "x", 1, 10)]])
    assert versions(dimensions.scd2_splice(first, frame(spark, [(1, "w", 9, 3)]), "k", ["a", "b"], "t")) == versions(first)


def test_keys_that_are_not_named_are_not_shuffled(spark, folder):
    spliced(spark, [[(n, "x", 1, 0) for n in range(50)]]).write.parquet(f"{folder}/dim")
    dim = spark.read.parquet(f"{folder}/dim")
    out = dimensions.scd2_splice(dim, frame(spark, [(1, "y", 1, 48)]), "k", ["a", "b"], "t", stage=True)
    assert out.filter(F.col("k") != 1).count() == 49 and out.filter("k = 1").count() == 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
