"""Control tables in bulk."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratiform.operators import control

T0, NOW = datetime(2024, 1, 1), datetime(2024, 3, 1)
STATE = (
    "entity_key string, current_watermark timestamp_ntz, last_row_count bigint, last_successful_run_id string, "
    "last_successful_ts timestamp_ntz, is_reprocessing boolean, reprocess_request_id string, updated_ts timestamp_ntz"
)
REQUESTS = (
    "request_id string, requested_entities array<string>, status string, created_ts timestamp_ntz, updated_ts timestamp_ntz, "
    "executed_at timestamp_ntz, execution_run_id string, result_summary string"
)


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def on(day):
    return datetime(2024, 1, day)


@pytest.fixture()
def state(spark):
    rows = [("a", on(10), 5, "r0", T0, False, None, T0), ("b", on(20), 7, "r0", T0, True, "q1", T0)]
    return spark.createDataFrame(rows, STATE)


def by_key(df, key="entity_key"):
    return {r[key]: r for r in df.collect()}


def test_watermark_of_an_unknown_entity_is_empty(spark, state):
    got = by_key(control.watermarks(state, spark.createDataFrame([("a",), ("z",)], "entity_key string")))
    assert got["a"]["current_watermark"] == on(10) and got["z"]["current_watermark"] is None
    assert got["z"]["is_reprocessing"] is False


def test_advance_never_goes_back_unless_reprocessing(spark, state):
    results = spark.createDataFrame([("a", on(5), 1), ("b", on(5), 2), ("c", on(7), 3)], "entity_key string, current_watermark timestamp_ntz, last_row_count bigint")
    got = by_key(control.advance(state, results, "r1", now()))
    assert [got[k]["current_watermark"] for k in "abc"] == [on(10), on(5), on(7)]
    assert got["b"]["is_reprocessing"] is False and got["b"]["reprocess_request_id"] is None
    assert got["c"]["last_successful_run_id"] == "r1" and got["c"]["updated_ts"] == NOW


def test_advance_keeps_the_watermark_of_an_empty_load(spark, state):
    results = spark.createDataFrame([("a", None, 0), ("b", None, 0)], "entity_key string, current_watermark timestamp_ntz, last_row_count bigint")
    got = by_key(control.advance(state, results, "r1", now()))
    assert [got[k]["current_watermark"] for k in "ab"] == [on(10), on(20)]


def test_rewind_to_start_or_beginning(spark, state):
    requests = spark.createDataFrame([("a", "q2", "2024-01-03T00:00:00"), ("n", "q2", None)], "entity_key string, request_id string, from_watermark string")
    got = by_key(control.rewind(state, requests, now()))
    assert got["a"]["current_watermark"] == on(3) and got["a"]["is_reprocessing"] and got["a"]["last_row_count"] == 5
    assert got["n"]["current_watermark"] == datetime(1900, 1, 1)
    assert got["b"]["reprocess_request_id"] == "q1"


def test_clear_flags(state):
    got = by_key(control.clear_flags(state, ["b", "nobody"], now()))
    assert got["b"]["is_reprocessing"] is False and got["b"]["reprocess_request_id"] is None
    assert got["a"]["updated_ts"] == T0


@pytest.fixture()
def requests(spark):
    rows = [
        ("q1", ["a", "b"], "approved", on(2)), ("q2", ["a"], "executing", on(3)), ("q3", ["a"], "submitted", on(9)),
        ("q4", ["c"], "approved", on(1)), ("q5", ["b"], "approved", on(2)),
    ]
    return spark.createDataFrame([(*r, T0, None, None, None) for r in rows], REQUESTS)


def test_newest_live_request_per_entity(requests):
    got = by_key(control.active_requests(requests))
    assert {k: r["request_id"] for k, r in got.items()} == {"a": "q2", "b": "q5", "c": "q4"}
    assert sorted(r["request_id"] for r in control.requests_naming(requests, "a").collect()) == ["q1", "q2"]


def test_queue_is_oldest_first_and_capped(requests):
    assert [r["request_id"] for r in control.queue_pick(requests, 2).collect()] == ["q4", "q1"]


def test_transition_stamps_completion_only(spark, requests):
    changes = spark.createDataFrame([("q1", "executing", "run", None), ("q2", "completed", "run", '{"n":1}')], "request_id string, to_status string, run_id string, summary string")
    got = by_key(control.transition(requests, changes, now()), "request_id")
    assert (got["q1"]["status"], got["q1"]["executed_at"], got["q1"]["updated_ts"]) == ("executing", None, NOW)
    assert (got["q2"]["status"], got["q2"]["executed_at"], got["q2"]["result_summary"]) == ("completed", NOW, '{"n":1}')
    assert got["q3"]["updated_ts"] == T0


def test_illegal_transition_fails(spark, requests):
    changes = spark.createDataFrame([("q3", "completed", "run", None)], "request_id string, to_status string, run_id string, summary string")
    with pytest.raises(Exception, match="illegal move submitted to completed"):
        control.transition(requests, changes, now()).collect()


def rules(spark):
    rows = [
        (1, "a", "silver", False, True), (2, "a", "gold", False, True), (3, None, "silver", True, True), (4, "", "silver", True, True),
        (5, None, "silver", False, True), (6, "a", "silver", False, False), (7, "b", "silver", False, True),
    ]
    return spark.createDataFrame(rows, "rule_id int, entity_key string, layer string, is_default boolean, is_active boolean")


def test_rules_with_and_without_defaults(spark):
    def found(df):
        return sorted(r["rule_id"] for r in df.collect())

    assert found(control.rules_for(rules(spark), "a", "silver")) == [1, 3, 4]
    assert found(control.rules_for(rules(spark), "a", "silver", include_defaults=False)) == [1]
    entities = spark.createDataFrame([("a",), ("c",)], "entity_key string")
    every = control.rules_for_all(rules(spark), entities, "silver")
    assert sorted((r["entity_key"], r["rule_id"]) for r in every.collect()) == [("a", 1), ("a", 3), ("a", 4), ("c", 3), ("c", 4)]


def test_entities_take_their_effective_config(spark, rows_of):
    entities = spark.createDataFrame([("a",), ("b",), ("c",)], "entity_key string")
    configs = spark.createDataFrame([("a", "dev", 1), ("a", "all", 2), ("b", "all", 3), ("c", "prod", 4)], "entity_key string, environment string, id int")
    assert rows_of(control.entities_with_config(entities, configs, "dev"), "entity_key", "id") == [("a", 1), ("b", 3), ("c", None)]


def test_policies_are_sparse_and_active(spark):
    df = spark.createDataFrame([("a", "x", True), ("a", "y", False), ("b", "z", True)], "entity_key string, column_name string, is_active boolean")
    assert [r["column_name"] for r in control.policies_for(df, "a").collect()] == ["x"]


def test_flattened_rule_defaults(spark):
    docs = spark.createDataFrame(
        [("a", "gold", [("r1", None, "x > 0", None), ("r2", "silver", None, "fail")]), (None, None, [("g", None, None, None)])],
        "entity_key string, layer string, rules array<struct<rule_name:string,layer:string,expression:string,action_on_failure:string>>",
    )
    got = by_key(control.flatten_rules(docs), "rule_id")
    assert set(got) == {"a_gold_r1", "a_silver_r2", "global_silver_g"}
    assert got["a_gold_r1"]["action_on_failure"] == "warn" and got["a_silver_r2"]["action_on_failure"] == "fail"
    assert got["global_silver_g"]["severity"] == "medium" and got["global_silver_g"]["is_active"] is True


def test_audit_opens_and_closes(spark):
    audit = spark.createDataFrame([], "deployment_id string, status string, started_ts timestamp_ntz, completed_ts timestamp_ntz, tables_applied array<string>, error_details string")
    running = control.open_audit(audit, spark.createDataFrame([("d1",), ("d2",)], "deployment_id string"), now())
    assert {r["status"] for r in running.collect()} == {"running"}
    done = control.close_audit(running, "d1", ["t1", "t2"], as_of=now())
    failed = by_key(control.close_audit(done, "d2", [], "it's \\ broken", now()), "deployment_id")
    assert failed["d1"]["status"] == "success" and failed["d1"]["tables_applied"] == ["t1", "t2"] and failed["d1"]["error_details"] is None
    assert failed["d2"]["status"] == "failed" and failed["d2"]["error_details"] == "it's \\ broken"
