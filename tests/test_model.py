"""Dimensions and facts."""

from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.operators import skew
from stratiform.plans import dimensions, facts

HISTORY = "k int, a string, b int, t timestamp_ntz, n int"
D0 = datetime(2024, 2, 27)


def day(i):
    return (D0 + timedelta(days=i)).date()


def at(i, hour=0):
    return D0 + timedelta(days=i, hours=hour)


def build(spark, rows):
    return dimensions.scd2_build(spark.createDataFrame(rows, HISTORY), "k", ["a", "b"], "t", ["n"])


def versions(df):
    return [tuple(r) for r in df.select("k", "a", "b", "effective_from", "effective_to", "is_current", "version").orderBy("k", "version").collect()]


def test_scd2_collapses_resends_and_returns_to_old_values(spark):
    rows = [(1, "x", 1, at(0), 1), (1, "x", 1, at(1), 2), (1, "y", 1, at(3), 3), (1, "x", 1, at(5), 4), (2, None, None, at(0), 5)]
    assert versions(build(spark, rows)) == [
        (1, "x", 1, day(0), day(2), False, 1), (1, "y", 1, day(3), day(4), False, 2), (1, "x", 1, day(5), None, True, 3),
        (2, None, None, day(0), None, True, 1),
    ]


def test_scd2_last_change_of_a_day_counts(spark):
    rows = [(1, "x", 1, at(0, 1), 1), (1, "y", 1, at(0, 9), 2), (1, "z", 1, at(0, 9), 3), (1, "w", 1, at(0, 2), 4)]
    assert versions(build(spark, rows)) == [(1, "z", 1, day(0), None, True, 1)]


def test_scd2_null_differs_from_empty(spark):
    rows = [(1, None, 1, at(0), 1), (1, "", 1, at(1), 2), (1, "", None, at(2), 3)]
    assert [v[6] for v in versions(build(spark, rows))] == [1, 2, 3]


def empty_dim(spark):
    return build(spark, []).limit(0)


def test_scd2_apply_cases(spark):
    dim = build(spark, [(1, "x", 1, at(0), 1), (2, "x", 1, at(0), 2), (3, "x", 1, at(5), 3), (4, "x", 1, at(4), 4), (5, "q", 1, at(0), 5)])
    batch = [(1, "x", 1, day(4)), (2, "y", 1, day(4)), (3, "y", 1, day(4)), (4, "y", 1, day(4)), (6, "n", 1, day(4))]
    incoming = spark.createDataFrame(batch, "k int, a string, b int, d date")
    got = versions(dimensions.scd2_apply(dim, incoming, "k", ["a", "b"], "d"))
    assert got == [
        (1, "x", 1, day(0), None, True, 1),  # unchanged
        (2, "x", 1, day(0), day(3), False, 1), (2, "y", 1, day(4), None, True, 2),  # changed
        (3, "x", 1, day(5), None, True, 1),  # older than the current version
        (4, "y", 1, day(4), None, True, 1),  # second change on its first day
        (5, "q", 1, day(0), None, True, 1),  # absent
        (6, "n", 1, day(4), None, True, 1),  # new
    ]
    late = dimensions.scd2_late(dim, incoming, "k", "d").collect()
    assert [(r["k"], r["reason"]) for r in late] == [(3, "older than current version")]


@pytest.mark.parametrize("stage", [False, True])
def test_scd2_apply_needs_one_row_per_key(spark, stage):
    incoming = spark.createDataFrame([(1, "x", 1, day(0))] * 2, "k int, a string, b int, d date")
    with pytest.raises(Exception, match="repeats a key"):
        dimensions.scd2_apply(empty_dim(spark), incoming, "k", ["a", "b"], "d", stage=stage).collect()


CHANGE = st.tuples(st.integers(1, 3), st.none() | st.sampled_from("xy"), st.none() | st.integers(0, 1), st.integers(0, 4))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(CHANGE, min_size=1, max_size=12, unique_by=lambda c: (c[0], c[3])))
def test_daily_apply_equals_build_and_leaves_no_gap(spark, folder_factory, changes):
    whole = build(spark, [(k, a, b, at(d), i) for i, (k, a, b, d) in enumerate(changes)])
    dim = empty_dim(spark)
    for d in sorted({c[3] for c in changes}):
        batch = [(k, a, b, day(x)) for k, a, b, x in changes if x == d]
        incoming = spark.createDataFrame(batch, "k int, a string, b int, d date")
        dim = folder_factory(dimensions.scd2_apply(dim, incoming, "k", ["a", "b"], "d"))
    assert versions(dim) == versions(whole)
    assert dimensions.scd2_issues(dim, "k").count() == 0


@pytest.fixture(scope="module")
def folder_factory(spark):
    """Cut the growing plan of a fold with a written table."""
    from stratiform.session import materialize

    return lambda df: materialize(df, "fold")


def test_scd2_issues_finds_gap_overlap_and_two_current(spark, rows_of):
    rows = [
        (1, day(0), day(1), False), (1, day(3), None, True),
        (2, day(0), day(5), False), (2, day(3), None, True),
        (3, day(0), None, True), (3, day(9), None, True),
        (4, day(0), day(0), False), (4, day(1), None, True),
    ]
    dim = spark.createDataFrame(rows, "k int, effective_from date, effective_to date, is_current boolean")
    assert rows_of(dimensions.scd2_issues(dim, "k")) == sorted(
        [(1, day(3), "gap"), (2, day(3), "overlap"), (3, day(9), "overlap"), (3, day(9), "several_current")], key=repr
    )


def test_point_in_time_over_years(spark, rows_of):
    dim = spark.createDataFrame(
        [(1, date(2018, 5, 1), date(2021, 3, 3), "old"), (1, date(2021, 3, 4), None, "new")],
        "k int, effective_from date, effective_to date, v string",
    )
    when = [datetime(2018, 4, 30), datetime(2018, 5, 1), datetime(2020, 1, 1), datetime(2021, 3, 3, 23), datetime(2021, 3, 4), datetime(2024, 1, 1)]
    fact = spark.createDataFrame([(i, 1, t) for i, t in enumerate(when)] + [(9, 2, when[0]), (10, None, when[0])], "id int, fk int, t timestamp_ntz")
    got = dimensions.point_in_time(fact, dim, "fk", "t", "k", ["v"])
    assert rows_of(got, "id", "v") == [(0, None), (1, "old"), (10, None), (2, "old"), (3, "old"), (4, "new"), (5, "new"), (9, None)]


def test_calendar_matches_python(spark):
    span = spark.createDataFrame([(date(2019, 1, 1), date(2025, 12, 31))], "first_day date, last_day date")
    rows = {r["full_date"]: r for r in dimensions.calendar(span).collect()}
    assert len(rows) == 2557 and date(2024, 2, 29) in rows
    d = date(2019, 1, 1)
    while d <= date(2025, 12, 31):
        r = rows[d]
        assert (r["date_key"], r["year"], r["month"], r["day"]) == (int(d.strftime("%Y%m%d")), d.year, d.month, d.day)
        assert (r["month_name"], r["day_name"]) == (d.strftime("%B"), d.strftime("%A"))
        assert (r["week_of_year"], r["day_of_week"]) == d.isocalendar()[1:]
        assert r["is_weekend"] == (d.isoweekday() > 5) and r["quarter"] == -(-d.month // 3)
        assert r["fiscal_year"] == (d.year if d.month > 9 else d.year - 1)
        assert r["is_month_start"] == (d.day == 1) and r["is_quarter_start"] == (d.day == 1 and d.month % 3 == 1)
        d += timedelta(days=1)


def test_year_span(spark):
    df = spark.createDataFrame([(datetime(2020, 2, 29, 5),), (datetime(2023, 12, 31),)], "t timestamp_ntz")
    assert tuple(dimensions.year_span(df, "t").first()) == (date(2020, 1, 1), date(2023, 12, 31))


def test_calendar_gaps_within_and_across_months(spark, rows_of):
    days = [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 5), date(2024, 5, 1), date(2024, 5, 1)]
    df = spark.createDataFrame([(d,) for d in days], "full_date date")
    assert rows_of(dimensions.calendar_gaps(df)) == [
        (date(2024, 2, 1), date(2024, 2, 5), 3), (date(2024, 2, 5), date(2024, 5, 1), 85)
    ]


def test_junk_keys_are_stable_when_extended(spark, rows_of):
    first = dimensions.junk(spark.createDataFrame([("b", True), ("a", None), ("b", True)], "s string, p boolean"), ["s", "p"])
    assert rows_of(first) == [(1, "a", None), (2, "b", True)]
    more = spark.createDataFrame([("a", None), ("A", False)], "s string, p boolean")
    grown = dimensions.junk(more, ["s", "p"], first)
    assert rows_of(grown) == [(1, "a", None), (2, "b", True), (3, "A", False)]
    keyed = facts.with_junk_key(more, grown, ["s", "p"])
    assert rows_of(keyed, "s", "junk_key") == [("A", 3), ("a", 1)]


def test_scd1_is_distinct(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "id int, v string")
    assert dimensions.scd1(df, {"id": "key", "v": "value"}).count() == 2


EVENT = st.tuples(st.sampled_from(["hot", "hot", "cold", None]), st.none() | st.integers(0, 200))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(EVENT, max_size=25), st.sampled_from([0, 2, 100]))
def test_sliced_lead_equals_the_plain_window(spark, rows_of, events, hot_rows):
    rows = [(i, k, None if m is None else datetime(2024, 1, 1) + timedelta(minutes=17 * m)) for i, (k, m) in enumerate(events)]
    df = spark.createDataFrame(rows, "id int, k string, t timestamp_ntz")
    got = skew.next_in_key(df, "k", "t", "id", "nxt", hot_rows)
    expected = []
    for key in {r[1] for r in rows}:
        group = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is not None, r[2] or datetime.min, r[0]))
        expected += [(*r, n[2]) for r, n in zip(group, [*group[1:], (None, None, None)])]
    assert rows_of(got, "id", "k", "t", "nxt") == sorted(expected, key=repr)


def test_lifecycle_and_stage_metrics(spark, rows_of):
    rows = [(1, "u", "lead", at(0, 5)), (2, "u", "won", at(2, 1)), (3, "v", "lead", at(0))]
    df = spark.createDataFrame(rows, "id int, u string, stage string, t timestamp_ntz")
    life = facts.lifecycle(df, "u", "stage", "t", "id")
    assert rows_of(life, "id", "exited_ts", "duration_days", "is_current_stage") == [
        (1, at(2, 1), 2, False), (2, None, None, True), (3, None, None, True)
    ]
    assert rows_of(facts.stage_metrics(life, "stage")) == [("lead", 2, 1, 0.5, 2.0), ("won", 1, 0, 0.0, None)]


def test_a_burst_and_rows_without_a_key_are_cut_to_size(spark, rows_of):
    """One early row, then a burst; NULL keys as many: no slice holds twice the rows of a hot key's share."""
    ids = spark.range(8000).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.lit(7)).alias("k"))
    seconds = F.when(F.col("id") < 2, F.lit(0)).otherwise(F.lit(10**9) + F.col("id"))
    df = ids.withColumn("t", F.timestamp_seconds(seconds)).unionByName(spark.createDataFrame([(9000, 7, None), (9001, None, None)], "id bigint, k int, t timestamp"))
    sliced = skew.with_slices(df, skew.hot_keys(df, "k", 100), "k", "t", 100)
    assert sliced.groupBy("k", "_slice").count().agg(F.max("count")).first()[0] <= 200
    plain = df.withColumn("nxt", F.lead("t").over(Window.partitionBy("k").orderBy("t", "id")))
    assert rows_of(skew.next_in_key(df, "k", "t", "id", "nxt", 100), "id", "nxt") == rows_of(plain, "id", "nxt")


def test_monthly_snapshot_counts_joiners_and_leavers(spark):
    def t(m, d=1):
        return datetime(2024, m, d)

    rows = [("g", 1, t(1), 10.0), ("g", 1, t(1, 9), 20.0), ("g", 1, t(4), 5.0), ("g", 2, t(1), 30.0), ("h", 3, t(2), 1.0)]
    df = spark.createDataFrame(rows, "g string, m int, t timestamp_ntz, a double")
    got = [tuple(r) for r in facts.monthly_snapshot(df, "g", "m", "t", "a").orderBy("g", "snapshot_month").collect()]
    assert got == [
        ("g", date(2024, 1, 1), 2, 2, 20.0, 0.5), ("g", date(2024, 2, 1), 1, 0, None, 0.0), ("g", date(2024, 3, 1), 1, 0, None, 0.0),
        ("g", date(2024, 4, 1), 1, 1, 5.0, 1.0), ("h", date(2024, 2, 1), 1, 1, 1.0, 1.0),
    ]


def test_project_truncates_to_the_day(spark):
    df = spark.createDataFrame([(1, at(0, 7))], "id int, t timestamp_ntz")
    out = facts.project(df, {"id": "key", "t": "ts"}, {"t": "the_day"})
    assert tuple(out.first()) == (1, at(0, 7), at(0)) and isinstance(out.schema["the_day"].dataType, T.TimestampNTZType)
    assert facts.daily_counts(df, "t", ["id"]).first()["n_rows"] == 1
