"""Refreshes with state."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratiform.operators import keyed
from stratiform.plans.refresh import REQUEST_SCHEMA, Lake, in_scope, refresh_all, refresh_entity
from stratiform.plans.silver import QualityFailure, read_silver, run_silver, silver_refresh
from stratiform.sources import tables
from stratiform.spec import Entity, Request, Rule

T0 = datetime(2024, 1, 1)
ENTITY = Entity("things", ("id",), "t", rules=(Rule("small", "v < 100", action="fail"),))


def bronze(spark, *rows):
    return spark.createDataFrame([(i, T0 + timedelta(hours=h), v) for i, h, v in rows], "id int, t timestamp_ntz, v int")


def ask(spark, lake, mode, start=None, end=None):
    row = spark.createDataFrame(
        [("q", ["things"], mode, start, end, "approved", T0)],
        "request_id string, requested_entities array<string>, reprocess_mode string, from_watermark timestamp_ntz, "
        "to_watermark timestamp_ntz, status string, created_ts timestamp_ntz",
    )
    tables.publish(keyed.append(spark.createDataFrame([], REQUEST_SCHEMA), row), lake.requests)


def silver(spark, lake):
    return sorted((r["id"], r["v"]) for r in tables.current(spark, lake.table(ENTITY, "silver")).collect())


def state(spark, lake):
    return tables.current(spark, lake.state).first()


def test_incremental_runs_move_the_watermark(spark, folder):
    lake = Lake(folder)
    assert refresh_entity(spark, lake, ENTITY, bronze(spark, (1, 0, 1), (2, 1, 2)), "r1")["counts"]["n_clean"] == 2
    report = refresh_entity(spark, lake, ENTITY, bronze(spark, (1, 0, 9), (2, 1, 9), (3, 2, 3)), "r2")
    assert report["counts"]["n_read"] == 1
    assert silver(spark, lake) == [(1, 1), (2, 2), (3, 3)]
    assert state(spark, lake)["current_watermark"] == T0 + timedelta(hours=2)
    assert state(spark, lake)["last_successful_run_id"] == "r2"


def test_window_request_is_executed_and_completed(spark, folder):
    lake = Lake(folder)
    rows = bronze(spark, (1, 0, 1), (2, 1, 2), (3, 2, 3))
    refresh_entity(spark, lake, ENTITY, rows, "r1")
    ask(spark, lake, "window", T0, T0 + timedelta(hours=1))
    refresh_entity(spark, lake, ENTITY, rows.withColumn("v", F.col("v") + 10), "r2")
    assert silver(spark, lake) == [(1, 1), (2, 12), (3, 3)]
    done = tables.current(spark, lake.requests).first()
    assert done["status"] == "completed" and done["execution_run_id"] == "r2" and done["executed_at"] is not None
    assert state(spark, lake)["is_reprocessing"] is False


def test_full_request_rereads_and_keys_request_selects(spark, folder):
    lake = Lake(folder)
    rows = bronze(spark, (1, 0, 1), (2, 1, 2))
    refresh_entity(spark, lake, ENTITY, rows, "r1")
    ask(spark, lake, "full")
    refresh_entity(spark, lake, ENTITY, rows.withColumn("v", F.col("v") + 10), "r2")
    assert silver(spark, lake) == [(1, 11), (2, 12)]
    ask(spark, lake, "keys")
    key_set = spark.createDataFrame([(2,)], "id int")
    refresh_entity(spark, lake, ENTITY, rows, "r3", key_set)
    assert silver(spark, lake) == [(1, 11), (2, 2)]


def test_failed_reprocess_is_marked_and_can_run_again(spark, folder):
    lake = Lake(folder)
    rows = bronze(spark, (1, 0, 1))
    refresh_entity(spark, lake, ENTITY, rows, "r1")
    ask(spark, lake, "full")
    with pytest.raises(QualityFailure):
        refresh_entity(spark, lake, ENTITY, rows.withColumn("v", F.lit(500)), "r2")
    assert tables.current(spark, lake.requests).first()["status"] == "failed"
    assert state(spark, lake)["is_reprocessing"] is False and silver(spark, lake) == [(1, 1)]
    assert refresh_entity(spark, lake, ENTITY, rows, "r3")["counts"]["n_clean"] == 1


def test_scope_and_unique_declaration(spark, folder):
    secret = Entity("pay", ("id",), "t", restricted=True)
    assert [e.key for e in in_scope([ENTITY, secret], False)] == ["things"]
    assert [e.key for e in in_scope([ENTITY, secret], True, ["pay", "things"])] == ["pay"]
    with pytest.raises(ValueError, match="more than once"):
        in_scope([ENTITY, ENTITY], False)
    lake = Lake(folder)
    reports = refresh_all(spark, lake, [ENTITY, secret], lambda e: bronze(spark, (1, 0, 1)), "r1", restricted=True)
    assert set(reports) == {"pay"} and tables.current(spark, f"{folder}/silver_restricted/pay").count() == 1


def test_entity_without_rules_or_watermark_column(spark, rows_of):
    plain = Entity("plain", ("id",))
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "id int, v string")
    out = silver_refresh(df, plain)
    assert rows_of(out.silver, "id", "v") == [(1, "b"), (2, "c")]
    assert tuple(out.watermark.first()) == (None, 4) and out.quarantine.count() == 0


@pytest.mark.parametrize("cut", [{}, {"buckets": 4}, {"partition": "p"}])
def test_silver_layouts_agree_and_follow_the_columns(spark, folder, rows_of, cut):
    entity = Entity("things", ("id", "p"), "t", **cut)
    base, held = f"{folder}/s", f"{folder}/q"
    one = bronze(spark, (1, 0, 1), (2, 1, 2)).withColumn("p", F.col("id") % 2)
    assert read_silver(spark, entity, base) is None
    run_silver(spark, one, entity, base, held)
    two = bronze(spark, (2, 2, 9), (3, 2, 3)).withColumn("p", F.col("id") % 2).drop("v").withColumn("extra", F.lit("x"))
    run_silver(spark, two, entity, base, held, last=T0 + timedelta(hours=1))
    out = read_silver(spark, entity, base)
    assert rows_of(out, "id", "p", "v", "extra") == [(1, 1, 1, None), (2, 0, 2, "x"), (3, 1, None, "x")]
    assert "_bucket" not in out.columns


@pytest.mark.parametrize("cut", [{}, {"buckets": 4}])
def test_reprocessed_window_does_not_undo_newer_rows(spark, folder, rows_of, cut):
    entity = Entity("things", ("id",), "t", **cut)
    base, held = f"{folder}/s", f"{folder}/q"
    rows = bronze(spark, (1, 0, 1), (1, 5, 2), (2, 1, 3), (3, 1, 4))
    run_silver(spark, rows, entity, base, held)
    fixed = rows.withColumn("v", F.col("v") + 10)
    run_silver(spark, fixed, entity, base, held, request=Request("q", "window", None, T0 + timedelta(hours=1)))
    assert rows_of(read_silver(spark, entity, base), "id", "v") == [(1, 2), (2, 13), (3, 14)]
    lazily = silver_refresh(fixed, entity, read_silver(spark, entity, base), request=Request("q", "window", None, T0 + timedelta(hours=5)))
    assert rows_of(lazily.silver, "id", "v") == [(1, 12), (2, 13), (3, 14)]
