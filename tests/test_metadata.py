"""Entities compiled from control tables, and runs of them."""

import pytest
from pyspark.sql import functions as F

from stratiform.operators import quality
from stratiform.plans import metadata
from stratiform.plans.metadata import ControlTables, declared, entities
from stratiform.plans.refresh import Lake, refresh_all
from stratiform.plans.silver import QualityFailure
from stratiform.sources import tables
from stratiform.spec import Policy, Rule

RULE = "rule_name string, entity_key string, layer string, enforcement_method string, expression string, library_reference string, parameters string, action_on_failure string, is_default boolean, is_active boolean"


def rule(name, entity, method, expression=None, library=None, parameters=None, action=None, default=False, active=True, layer="silver"):
    return (name, entity, layer, method, expression, library, parameters, action, default, active)


@pytest.fixture()
def listed(spark):
    rows = [("a", "hr", "erp", '["id"]', "t", False, True), ("b", "hr", None, "x, y", None, True, True), ("c", "fin", "erp", '["id"]', "t", None, True), ("d", "hr", "erp", '["id"]', "t", False, False)]
    return spark.createDataFrame(rows, "entity_key string, subject_area_key string, source_key string, primary_key_columns string, watermark_column string, restricted boolean, is_active boolean")


def test_entities_alone_are_enough(listed):
    found = {e.key: e for e in entities(ControlTables(listed))}
    assert sorted(found) == ["a", "b", "c"]
    assert found["b"].primary_key == ("x", "y") and found["b"].watermark_column == "_source_extract_ts" and found["b"].restricted and found["b"].source_system == "unknown"
    assert [d.entity.key for d in declared(ControlTables(listed), subject="hr")] == ["a", "b"]
    assert [e.key for e in entities(ControlTables(listed), keys=["c"])] == ["c"]
    with pytest.raises(ValueError, match="no active entities"):
        entities(ControlTables(listed), keys=["c", "d", "nope"])
    with pytest.raises(ValueError, match="primary key"):
        entities(ControlTables(listed.withColumn("primary_key_columns", F.lit(" "))))


def test_keys_come_as_arrays_or_from_the_contract(spark, listed):
    assert entities(ControlTables(listed.withColumn("primary_key_columns", F.array(F.lit("p"), F.lit("q")))))[0].primary_key == ("p", "q")
    document = '{"schema": {"columns": [{"name": "k", "type": "int", "primary_key": true}]}, "version": 3}'
    contracts = spark.createDataFrame([("a", 2, '{"columns": []}'), ("a", 3, document)], "entity_key string, version int, contract_json string")
    one = entities(ControlTables(listed.withColumn("primary_key_columns", F.lit(None).cast("string")), contracts=contracts), keys=["a"])[0]
    assert one.primary_key == ("k",) and one.contract.version == 3


def test_rules_by_method(spark, listed):
    rows = [
        rule("native", "a", "native_lakeflow", "v > 0", "best_practices.not_null"), rule("library", "a", "external_library", "v > 0", "best_practices.not_null", '{"column": "v"}', "drop"),
        rule("two", "a", "both", "v < 9", "best_practices.freshness_24h", '{"timestamp_col": "seen", "max_age_hours": 12}', "warn"), rule("dates", "a", "external_library", None, "best_practices.no_future_dates"),
        rule("once", "a", "external_library", None, "best_practices.unique_business_key", '{"key_columns": ["v", "w"]}'), rule("empty", "a", "native_lakeflow"),
        rule("off", "a", "native_lakeflow", "false", active=False), rule("gold", "a", "native_lakeflow", "false", layer="gold"),
        rule("present", None, "both", "col IS NOT NULL", "best_practices.not_null", action="fail", default=True), rule("native", "", "native_lakeflow", "v > 100", default=True),
        rule("stray", None, "native_lakeflow", "false"),
    ]
    one, *_ = entities(ControlTables(listed, rules=spark.createDataFrame(rows, RULE)), keys=["a"])
    by_name = {r.name: r for r in one.rules}
    assert list(by_name) == ["dates", "library", "native", "once", "two", "two.library", "present", "present.library"]
    assert by_name["native"] == Rule("native", "v > 0", action="fail") and by_name["dates"].params == {"column": "date"} and by_name["dates"].effect == "warn"
    assert by_name["library"].check == "not_null" and by_name["library"].effect == "drop" and by_name["library"].params == {"column": "v"}
    assert by_name["two"].effect == "warn" and by_name["two.library"].params == {"column": "seen", "max_age_hours": 12}
    assert by_name["present"].expression == "`id` IS NOT NULL" and by_name["present.library"].params == {"keys": ["id"]}
    assert by_name["once"].params == {"columns": ("v", "w")}


def test_unknown_library_rules_are_an_error_or_left_out(spark, listed):
    tables_ = ControlTables(listed, rules=spark.createDataFrame([rule("odd", "a", "external_library", None, "domain.special")], RULE))
    with pytest.raises(ValueError, match="unknown library"):
        entities(tables_)
    assert entities(tables_, strict=False)[0].rules == ()


def test_configs_and_policies(spark, listed):
    configs = spark.createDataFrame([("a", "all", '{"x": 1}'), ("a", "dev", '{"x": 2}'), ("b", "prod", "{}"), ("c", "all", "not {json")], "entity_key string, environment string, auto_loader_options string")
    policies = spark.createDataFrame([("a", "mail", "hash", None, True), ("a", "card", "encrypt", "pii", True), ("a", "old", "mask", None, False), ("b", "z", None, None, True)], "entity_key string, column_name string, policy_type string, encryption_key_vault_ref string, is_active boolean")
    found = {d.entity.key: d for d in declared(ControlTables(listed, configs=configs, policies=policies), "dev")}
    assert found["a"].config == {"environment": "dev", "auto_loader_options": {"x": 2}} and found["b"].config == {}
    assert found["c"].config["auto_loader_options"] == "not {json"
    assert found["a"].entity.policies == (Policy("card", "encrypt", "pii"), Policy("mail", "hash")) and found["b"].entity.policies == (Policy("z"),)


def test_control_tables_are_read_in_bulk(spark, listed, folder):
    listed.write.parquet(f"{folder}/entities")
    policies = spark.createDataFrame([("a", "mail", "hash", True)], "entity_key string, column_name string, policy_type string, is_active boolean")
    policies.write.parquet(f"{folder}/policies")
    plan = metadata.described(ControlTables(spark.read.parquet(f"{folder}/entities"), policies=spark.read.parquet(f"{folder}/policies")))._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "column_name" in line for line in plan.splitlines()) == 1
    assert not any(w in plan for w in ("CartesianProduct", "BroadcastNestedLoopJoin"))


def test_declared_entities_run(spark, folder, listed):
    rows = [rule("small", "a", "both", "v < 100", "best_practices.not_null", '{"column": "v"}', "quarantine"), rule("unique", None, "native_lakeflow", "COUNT(*) OVER (PARTITION BY {primary_key_columns}) = 1", action="fail", default=True)]
    policies = spark.createDataFrame([("a", "mail", "hash", True)], "entity_key string, column_name string, policy_type string, is_active boolean")
    found = entities(ControlTables(listed, rules=spark.createDataFrame(rows, RULE), policies=policies), keys=["a", "c"])
    bronze = spark.createDataFrame([(1, 1, 5, "m@x"), (2, 1, 500, "n@x"), (3, 2, None, "o@x")], "id int, t int, v int, mail string")
    reports = refresh_all(spark, Lake(folder), found, lambda e: bronze, "r1")
    assert reports["a"]["violations"] == {"small": 2, "small.library": 1, "unique": 0}
    silver = tables.current(spark, f"{folder}/silver/a").collect()
    assert [r["id"] for r in silver] == [1] and len(silver[0]["mail"]) == 64
    with pytest.raises(QualityFailure, match="unique"):
        refresh_all(spark, Lake(f"{folder}/other"), found, lambda e: bronze.unionAll(bronze), "r2", keys=["c"])


def test_key_present_check(spark):
    df = spark.createDataFrame([(1, 1), (None, 2)], "id int, v int")
    assert [r["v"] for r in quality.apply_rules(df, [Rule("k", check="key_present", action="drop", params={"keys": ["id"]})]).clean.collect()] == [1]
