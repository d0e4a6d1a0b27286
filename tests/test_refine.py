"""Dedupe, slices, rules, contracts, protection, silver."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions import checks, lineage, protect, values
from stratiform.operators import contract, dedupe, quality, slices
from stratiform.plans.silver import QualityFailure, run_silver, silver_refresh
from stratiform.sources import tables
from stratiform.spec import Contract, Entity, Policy, Request, Rule

NOON = datetime(2024, 1, 1, 12)


def at(hours):
    return NOON + timedelta(hours=hours)


# Dedupe


def test_latest_wins_and_null_times_lose(spark, rows_of):
    rows = [(1, at(0), "old"), (1, at(1), "new"), (1, None, "undated"), (2, None, "only"), (3, at(0), "b"), (3, at(0), "a")]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, v string")
    assert rows_of(dedupe.latest_per_key(df, ["k"], ["t"]), "k", "v") == [(1, "new"), (2, "only"), (3, "b")]


def test_identical_rows_become_one(spark):
    df = spark.createDataFrame([(1, at(0))] * 5, "k int, t timestamp_ntz")
    assert dedupe.latest_per_key(df, ["k"], ["t"]).count() == 1
    assert dedupe.any_per_key(df, ["k"]).count() == 1


def test_dedupe_limits_rows_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") > 3).alias("k"), F.col("id").alias("t"))
    plan = dedupe.latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_missing_key_column_is_an_error(spark):
    with pytest.raises(ValueError, match="key columns missing"):
        dedupe.latest_per_key(spark.range(1), ["k"], ["id"])


def test_preferred_row_takes_environment_then_all_then_any(spark, rows_of):
    rows = [("a", "dev"), ("a", "all"), ("b", "all"), ("b", "test"), ("c", "test")]
    df = spark.createDataFrame(rows, "k string, environment string")
    out = dedupe.preferred_row(df, ["k"], dedupe.environment_rank("environment", "dev"), ["environment"])
    assert rows_of(out) == [("a", "dev"), ("b", "all"), ("c", "test")]


# Slices


@pytest.fixture()
def events(spark):
    return spark.createDataFrame([(i, at(i)) for i in range(5)], "id int, t timestamp_ntz")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_incremental_is_strict_unless_inclusive(events):
    mark = "2024-01-01T14:00:00Z"
    assert ids(slices.incremental(events, "t", mark)) == [3, 4]
    assert ids(slices.incremental(events, "t", mark, inclusive=True)) == [2, 3, 4]
    assert ids(slices.incremental(events, "t", at(2))) == [3, 4]
    assert ids(slices.incremental(events, "t", None)) == [0, 1, 2, 3, 4]
    assert ids(slices.incremental(events, "absent", mark)) == [0, 1, 2, 3, 4]
    assert ids(slices.incremental(events, "t", at(9))) == []


def test_incremental_filter_reaches_the_scan(spark, events, folder):
    events.write.parquet(f"{folder}/e")
    df = slices.incremental(spark.read.parquet(f"{folder}/e"), "t", "2024-01-01T14:00:00Z")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t), GreaterThan(t," in plan


def test_reprocess_modes(spark, events):
    assert ids(slices.for_run(events, "t", at(3), Request("r", "full"))) == [0, 1, 2, 3, 4]
    assert ids(slices.for_run(events, "t", at(3), Request("r", "window", at(0), at(2)))) == [1, 2]
    assert ids(slices.for_run(events, "t", at(3), Request("r", "window", None, at(1)))) == [0, 1]
    keys = spark.createDataFrame([(0,), (4,), (4,), (9,)], "id int")
    assert ids(slices.for_run(events, "t", at(3), Request("r", "keys"), keys, ["id"])) == [0, 4]
    with pytest.raises(ValueError):
        slices.for_run(events, "t", None, Request("r", "keys"))
    with pytest.raises(ValueError):
        Request("r", "sometimes")


def test_late_rows_are_those_silver_has_not_seen(spark, events):
    silver = events.filter("id IN (0, 2)")
    late, on_time = slices.late_and_on_time(events, silver, "t", at(2), ["id"])
    assert (ids(late), ids(on_time)) == ([1], [3, 4])


def test_scope_treats_an_unset_flag_as_open(spark, rows_of):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, r boolean")
    assert ids(slices.in_scope(df, "r", False)) == [2, 3]
    assert ids(slices.in_scope(df, "r", False, "id", [3, 1])) == [3]
    assert rows_of(slices.route(df, "r"), "id", "layer_schema") == [(1, "silver_restricted"), (2, "silver"), (3, "silver")]


# Rules


def test_unknown_is_a_violation(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    out = quality.apply_rules(df, [Rule("positive", "v > 0", action="drop")])
    assert ids(out.clean) == [1] and ids(out.quarantine) == []
    lenient = quality.apply_rules(df, [Rule("positive", "v > 0 OR v IS NULL", action="drop")])
    assert ids(lenient.clean) == [1, 2]


def test_two_failing_rules_are_listed_in_rule_order(spark):
    df = spark.createDataFrame([(1, -5)], "id int, v int")
    rules = [Rule("z_first", "v > 0", action="quarantine"), Rule("a_second", "v > -2", action="quarantine")]
    assert quality.apply_rules(df, rules).quarantine.first()["failed_rules"] == ["z_first", "a_second"]


def test_fail_aborts_and_empty_input_passes(spark):
    rule = Rule("positive", "v > 0")
    assert rule.effect == "fail"
    df = spark.createDataFrame([(1, -5)], "id int, v int")
    with pytest.raises(Exception, match="quality rule positive failed"):
        quality.apply_rules(df, [rule]).clean.collect()
    assert quality.apply_rules(df.limit(0), [rule]).clean.count() == 0


def test_defaults_and_unknown_actions():
    assert Rule("r", check="not_null").effect == "warn"
    assert Rule("r", "true", action="explode").effect == "warn"
    with pytest.raises(ValueError):
        Rule("r")
    with pytest.raises(ValueError, match="unknown check"):
        checks.predicate(Rule("r", check="no_such_check"))


def test_rule_on_missing_column_fails(spark):
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        quality.apply_rules(spark.range(1), [Rule("r", "absent > 0", action="drop")])


def test_rule_names_must_be_unique(spark):
    with pytest.raises(ValueError, match="unique"):
        quality.apply_rules(spark.range(1), [Rule("r", "id > 0"), Rule("r", "id > 1")])


def test_key_rule_template(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "a int, b int")
    rule = Rule("keys", "coalesce({primary_key_columns}) IS NOT NULL AND least({primary_key_columns}) = 1", action="drop")
    assert quality.apply_rules(df, [rule], ["a", "b"]).clean.count() == 2


def test_metrics_count_every_rule(spark, rows_of):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id int, v int")
    rules = [Rule("warned", "v > 0", action="warn"), Rule("logged", check="not_null", action="log_only", params={"column": "v"})]
    assert rows_of(quality.metrics(df, rules)) == [("logged", "log_only", 3, 1), ("warned", "warn", 3, 2)]
    assert rows_of(quality.apply_rules(df, rules).clean, "id") == [(1,), (2,), (3,)]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.none() | st.integers(-3, 3), st.none() | st.integers(-3, 3)), max_size=12))
def test_clean_and_quarantine_partition_what_is_not_dropped(spark, values_):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values_)], "id int, a int, b int")
    rules = [Rule("a", "a > 0", action="quarantine"), Rule("b", "b > 0", action="drop"), Rule("c", "a <> b", action="quarantine")]
    out = quality.apply_rules(df, rules)
    kept = [i for i, (a, b) in enumerate(values_) if b is not None and b > 0]
    assert sorted(ids(out.clean) + ids(out.quarantine)) == kept


def test_checks_on_edges(spark):
    df = spark.createDataFrame(
        [(1, at(-24), None), (2, at(-25), None), (3, None, None), (4, at(11), None), (5, at(12), None)], "id int, t timestamp_ntz, x int"
    )
    now = F.lit(NOON).cast("timestamp_ntz")
    assert ids(df.filter(checks.freshness("t", now, 24))) == [1, 4, 5]
    assert ids(df.filter(checks.no_future("t", now))) == [1, 2, 3, 4]
    assert ids(df.filter(checks.all_not_null(["id", "t"]))) == [1, 2, 4, 5]
    assert ids(df.filter(checks.allowed_values("id", [1, 2]))) == [1, 2]


def test_unique_and_reference_helpers(spark, rows_of):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 9), (None, 1), (None, None)], "k int, ref int")
    counted = quality.with_key_count(df, ["k"])
    assert rows_of(counted, "k", "_key_count") == [(1, 2), (1, 2), (2, 1), (None, 2), (None, 2)]
    reference = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    found = quality.with_reference(df, "ref", reference, "id")
    assert rows_of(found.filter(~checks.exists("ref")), "ref") == [(9,)]
    assert found.count() == 5
    assert rows_of(quality.orphans(df, "ref", reference, "id"), "ref") == [(9,)]


def test_manager_exists_self_reference(spark, rows_of):
    staff = spark.createDataFrame([(1, None), (2, 1), (3, 8)], "id int, manager int")
    assert rows_of(quality.orphans(staff, "manager", staff, "id"), "id") == [(3,)]


# Contracts

CONTRACT = Contract.from_json(
    """{"entity_key": "staff", "version": 3, "schema": {"columns": [
    {"name": "id", "type": "integer", "nullable": false, "primary_key": true},
    {"name": "status", "type": "string", "allowed_values": ["A", "B"]},
    {"name": "pay", "type": "decimal"}, {"name": "since", "type": "date"}]}}"""
)


def test_contract_document_in_both_shapes():
    flat = Contract.from_json('{"columns": [{"name": "id", "type": "bigint"}]}')
    assert flat.schema == T.StructType([T.StructField("id", T.LongType())]) and flat.version == 1
    assert CONTRACT.names == ["id", "status", "pay", "since"] and CONTRACT.keys == ["id"]
    assert CONTRACT.columns[2].type == T.DecimalType(18, 2)


def test_conform_prune_and_preserve(spark, folder, rows_of):
    df = spark.createDataFrame([("1", "A", 1, "x")], "id string, extra string, _run int, status string")
    full = contract.conform(df, CONTRACT, cast=True)
    assert dict(full.dtypes) == {
        "id": "int", "extra": "string", "_run": "int", "status": "string", "pay": "decimal(18,2)", "since": "date"
    }
    full.write.parquet(f"{folder}/typed")
    assert contract.prune(full, CONTRACT).columns == ["id", "_run", "status", "pay", "since"]
    later = contract.preserve_dropped(full, full.drop("extra"))
    assert rows_of(later, "extra") == [("A",), (None,)]


def test_contract_check_reports_each_kind(spark, rows_of):
    df = spark.createDataFrame([(None, "Z", "5"), (1, None, "6")], "id int, status string, pay string")
    df = df.withColumns({"_run": F.lit(1), "more": F.lit(2)})
    assert rows_of(contract.check(df, CONTRACT)) == [
        ("id", "unexpected_null", 1), ("more", "not_in_contract", 2), ("pay", "wrong_type", 2),
        ("since", "missing_column", 2), ("status", "value_not_allowed", 1),
    ]
    good = spark.createDataFrame([(1, "A", None, None)], CONTRACT.schema)
    assert contract.check(good, CONTRACT).count() == 0
    assert rows_of(contract.check(good.drop("since").limit(0), CONTRACT), "issue") == [("missing_column",)]


def test_contract_rules_quarantine_what_the_check_counts(spark):
    df = spark.createDataFrame([(None, "A"), (1, "Z"), (2, None)], "id int, status string")
    out = quality.apply_rules(df, checks.contract_rules(CONTRACT))
    assert [r["failed_rules"] for r in out.quarantine.orderBy("id").collect()] == [["id_not_null"], ["status_allowed"]]
    assert ids(out.clean) == [2]


# Protection

KEY = "MDEyMzQ1Njc4OWFiY2RlZg=="


def test_mask_covers_newlines_and_multibyte_text(spark, rows_of):
    df = spark.createDataFrame([("ab\nc",), ("日本",), ("",), (None,)], "c string")
    assert rows_of(protect.protect(df, [Policy("c", "mask")])) == [("",), ("**",), ("****",), (None,)]


def test_hash_redact_and_tag(spark):
    df = spark.createDataFrame([(1, "x", None, 2.5)], "id int, a string, b string, c double")
    out = protect.protect(df, [Policy("a", "hash"), Policy("b", "redact"), Policy("id", classification="key"), Policy("c", "hash")])
    row = out.first()
    assert len(row["a"]) == 64 and row["b"] == "[REDACTED]" and row["id"] == 1 and len(row["c"]) == 64
    assert out.schema["id"].metadata == {"policy": "tag_only", "classification": "key"}


def test_encrypt_round_trips_any_type_and_hides_the_key(spark, rows_of):
    df = spark.createDataFrame([(1, "é\n", 2.5), (2, "", None), (3, None, 0.1)], "id int, a string, b double")
    policies = [Policy("a", "encrypt", "k"), Policy("b", "encrypt", "k")]
    hidden = protect.protect(df, policies, keys={"k": KEY})
    assert dict(hidden.dtypes)["a"] == "binary"
    key = protect.key_column(df, KEY)
    back = hidden.select("id", protect.decrypted("a", key).alias("a"), protect.decrypted("b", key, "double").alias("b"))
    assert rows_of(back) == rows_of(df)
    text = hidden._jdf.queryExecution().toString()
    assert "0123456789abcdef" not in text and KEY not in text and "30313233" not in text
    same = spark.createDataFrame([("t",)] * 2, "a string")
    assert protect.protect(same, policies[:1], keys={"k": KEY}).distinct().count() == 2


@pytest.mark.parametrize("key", [None, "", "c2hvcnQ=", "not base64!"])
def test_missing_or_unusable_key_fails(spark, key):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError, match="encryption key"):
        protect.protect(df, [Policy("a", "encrypt", "k")], keys={"k": key})


def test_unknown_policy_or_column_fails(spark):
    with pytest.raises(ValueError, match="unknown policy"):
        Policy("a", "scramble")
    with pytest.raises(ValueError, match="missing column"):
        protect.protect(spark.range(1), [Policy("absent", "hash")])


def test_policies_start_at_their_layer_and_run_in_order(spark):
    df = spark.createDataFrame([("abc",)], "a string")
    late = [Policy("a", "mask", start_layer="gold")]
    assert protect.protect(df, late, "silver").first()["a"] == "abc"
    assert protect.protect(df, late, "gold").first()["a"] == "***"
    assert protect.protect(df, [Policy("a", "hash"), Policy("a", "mask")]).first()["a"] == "*" * 64


# Values


def test_value_helpers(spark):
    df = spark.createDataFrame([(" a, b ,,c ", '{"k": 1}', "x_{env}")], "l string, j string, t string")
    row = df.select(
        values.key_list("l"), values.json_or_text("j"), values.expand_template("t", {"env": "dev"}), values.clean_code(F.lit(" ok "))
    ).first()
    assert tuple(row) == (["a", "b", "c"], '{"k":1}', "x_dev", "OK")


def test_change_hash_tells_null_from_empty_and_keeps_fields_apart(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a"), ("", "a"), ("ab", "c"), ("a", "bc"), ("a\u0001b", "c"), ("a", "b\u0001c"), ("1:a", ""), ("", "1:a")], "x string, y string")
    assert df.select(values.change_hash(["x", "y"])).distinct().count() == df.count()


def test_lineage_keeps_an_extract_time(spark):
    df = spark.createDataFrame([(1, at(0))], "id int, _source_extract_ts timestamp_ntz")
    now = F.lit(at(5)).cast("timestamp_ntz")
    row = lineage.from_staged(df, "s", "e", "e__src", as_of=now).first()
    assert row["_source_extract_ts"] == at(0) and row["_bronze_ingest_ts"] == at(5)
    assert lineage.from_staged(df.drop("_source_extract_ts"), "s", "e", "t", as_of=now).first()["_source_extract_ts"] == at(5)


# Silver

ENTITY = Entity(
    "staff",
    ("id",),
    watermark_column="t",
    rules=(
        Rule("paid", "pay > 0", action="quarantine"),
        Rule("known", "status <> 'X'", action="drop"),
        Rule("named", "name IS NOT NULL", action="fail"),
    ),
    policies=(Policy("name", "hash"), Policy("pay", "encrypt", "k")),
)
BRONZE = "id int, t timestamp_ntz, pay int, status string, name string"


def bronze(spark, *rows):
    return spark.createDataFrame(list(rows), BRONZE)


def test_rules_see_clear_values_and_both_outputs_are_protected(spark):
    rows = bronze(spark, (1, at(0), 5, "A", "ann"), (2, at(0), -5, "A", "bob"), (None, at(0), 1, "A", "nokey"), (3, at(9), 1, "X", "eve"))
    out = silver_refresh(rows, ENTITY, encryption_keys={"k": KEY})
    clean, held = out.silver.collect(), out.quarantine.collect()
    assert [r["id"] for r in clean] == [1] and [r["id"] for r in held] == [2]
    assert all(len(r["name"]) == 64 and isinstance(r["pay"], (bytes, bytearray)) for r in clean + held)
    assert tuple(out.watermark.first()) == (at(9), 4)


def test_job_publishes_upserts_and_accounts_for_every_row(spark, folder):
    base, held = f"{folder}/silver", f"{folder}/held"
    first = bronze(
        spark, (1, at(0), 5, "A", "ann"), (1, at(1), 6, "A", "ann2"), (2, at(0), -5, "A", "bob"), (None, at(0), 1, "A", "nokey"),
        (3, at(2), 1, "X", "eve"), (4, at(0), 7, "A", "dan"),
    )
    run = run_silver(spark, first, ENTITY, base, held, encryption_keys={"k": KEY})
    counts = run["counts"]
    assert counts == {"n_read": 6, "n_key_missing": 1, "n_clean": 2, "n_dropped": 1, "n_quarantined": 1, "n_duplicates": 1}
    assert run["watermark"] == at(2) and run["violations"] == {"paid": 1, "known": 1, "named": 0}
    again = bronze(spark, (4, at(1), 9, "A", "late"), (4, at(3), 8, "A", "dan"), (5, at(4), 1, "A", "flo"))
    second = run_silver(spark, again, ENTITY, base, held, last=run["watermark"], encryption_keys={"k": KEY})
    assert second["watermark"] == at(4)
    key = protect.key_column(first, KEY)
    silver = tables.current(spark, base).select("id", protect.decrypted("pay", key, "int"))
    assert sorted(map(tuple, silver.collect())) == [(1, 6), (4, 8), (5, 1)]


def test_failed_gate_publishes_nothing(spark, folder):
    rows = bronze(spark, (1, at(0), 5, "A", None))
    with pytest.raises(QualityFailure, match="named"):
        run_silver(spark, rows, ENTITY, f"{folder}/s", f"{folder}/q", encryption_keys={"k": KEY})
    assert tables.current(spark, f"{folder}/s") is None


def test_missing_key_fails_the_job(spark, folder):
    with pytest.raises(ValueError, match="encryption key"):
        run_silver(spark, bronze(spark, (1, at(0), 5, "A", "x")), ENTITY, f"{folder}/s", f"{folder}/q")


def test_empty_slice_keeps_silver(spark, folder):
    base, held = f"{folder}/silver", f"{folder}/held"
    rows = bronze(spark, (1, at(0), 5, "A", "ann"))
    run_silver(spark, rows, ENTITY, base, held, encryption_keys={"k": KEY})
    run = run_silver(spark, rows, ENTITY, base, held, last=at(0), encryption_keys={"k": KEY})
    assert run["counts"]["n_read"] == 0 and run["watermark"] is None
    assert tables.current(spark, base).count() == 1


def test_table_level_rules_in_one_evaluation(spark, rows_of):
    df = spark.createDataFrame([(1, 10), (1, 99), (2, 10), (3, None)], "id int, ref int")
    reference = spark.createDataFrame([(10,), (10,)], "key int")
    rules = [
        Rule("one", check="unique", action="quarantine"),
        Rule("known", check="exists", action="warn", params={"column": "ref", "reference": reference, "reference_column": "key"}),
        Rule("pair", check="unique", action="drop", params={"columns": ["id", "ref"]}),
    ]
    out = quality.apply_rules(df, rules, ["id"])
    assert rows_of(out.clean) == [(2, 10), (3, None)] and out.clean.columns == ["id", "ref"]
    assert rows_of(out.quarantine, "id", "ref") == [(1, 10), (1, 99)]
    assert rows_of(out.metrics, "rule_name", "n_failed") == [("known", 1), ("one", 2), ("pair", 0)]


def test_reference_rule_in_the_silver_job(spark, folder):
    reference = spark.createDataFrame([("A",)], "code string")
    known = Rule("known", check="exists", action="quarantine", params={"column": "status", "reference": reference, "reference_column": "code"})
    entity = Entity("staff", ("id",), "t", rules=(known,), policies=(Policy("status", "mask"),))
    rows = bronze(spark, (1, at(0), 5, "A", "ann"), (2, at(0), 5, "B", "bob"))
    counts = run_silver(spark, rows, entity, f"{folder}/s", f"{folder}/q")["counts"]
    assert (counts["n_clean"], counts["n_quarantined"]) == (1, 1)
    assert tables.current(spark, f"{folder}/q").first()["failed_rules"] == ["known"]
    assert not [c for c in tables.current(spark, f"{folder}/s").columns if c.startswith("_rule")]
