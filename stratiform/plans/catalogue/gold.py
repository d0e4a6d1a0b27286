"""Gold: dimensions, facts, checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.functions import lineage, protect
from stratiform.operators import dedupe, quality
from stratiform.plans import dimensions, facts
from stratiform.plans.catalogue.registry import AS_OF, as_of, query, table
from stratiform.session import materialize
from stratiform.spec import Policy, Rule


@query(
    "agg_daily_counts",
    "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n_events FROM events GROUP BY 1, 2",
)
def agg_daily_counts(spark, d):
    return facts.daily_counts(table(spark, d, "events"), "ts", ["event_type"], "n_events")


@query(
    "dim_scd1",
    f"""SELECT DISTINCT c_custkey AS customer_key, c_name AS customer_name, c_mktsegment AS segment, c_nationkey AS nation_key,
               TIMESTAMP '{AS_OF}' AS gold_processed_ts FROM customer""",
)
def dim_scd1(spark, d):
    """Customers sent twice are one dimension row each."""
    customer = table(spark, d, "customer")
    names = {"c_custkey": "customer_key", "c_name": "customer_name", "c_mktsegment": "segment", "c_nationkey": "nation_key"}
    dim = dimensions.scd1(customer.unionByName(customer), names)
    return lineage.stamp(dim, lineage.GOLD_TS, as_of())


@query(
    "dim_calendar",
    """WITH span AS (SELECT date_trunc('year', min(l_shipdate)) AS a, date_trunc('year', max(l_shipdate)) + INTERVAL 1 YEAR AS b
                     FROM lineitem),
            days AS (SELECT CAST(unnest(range(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
       SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
              CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
              CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
              isodow(d) >= 6 AS is_weekend,
              CAST(CASE WHEN month(d) >= 10 THEN year(d) ELSE year(d) - 1 END AS INTEGER) AS fiscal_year,
              CAST(week(d) AS INTEGER) AS week_of_year, day(d) = 1 AS is_month_start,
              day(d) = 1 AND month(d) IN (1, 4, 7, 10) AS is_quarter_start FROM days""",
)
def dim_calendar(spark, d):
    """Whole years that cover the ship dates."""
    return dimensions.calendar(dimensions.year_span(table(spark, d, "lineitem"), "l_shipdate"))


@query(
    "calendar_gap_check",
    """WITH days AS (SELECT DISTINCT o_orderpriority, o_orderstatus, CAST(o_orderdate AS DATE) AS full_date FROM orders),
            l AS (SELECT *, lag(full_date) OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY full_date)
                  AS previous_date FROM days)
       SELECT o_orderpriority, o_orderstatus, previous_date, full_date,
              CAST(full_date - previous_date - 1 AS INTEGER) AS missing_days
       FROM l WHERE full_date - previous_date > 1""",
)
def calendar_gap_check(spark, d):
    """Days without an order, per priority and status."""
    return dimensions.calendar_gaps(table(spark, d, "orders"), "o_orderdate", ["o_orderpriority", "o_orderstatus"])


@query(
    "calendar_gap_check_whole",
    """WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS full_date FROM events
                     UNION SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders),
            l AS (SELECT *, lag(full_date) OVER (ORDER BY full_date) AS previous_date FROM days)
       SELECT previous_date, full_date, CAST(full_date - previous_date - 1 AS INTEGER) AS missing_days
       FROM l WHERE full_date - previous_date > 1""",
)
def calendar_gap_check_whole(spark, d):
    """One calendar from the days of orders and events; the years between them are missing."""
    days = table(spark, d, "events").select(F.to_date("ts").alias("full_date"))
    ordered = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("full_date"))
    return dimensions.calendar_gaps(days.unionByName(ordered))


_FLAGS = ["o_orderstatus", "o_orderpriority", "is_large"]
_FLAGGED = "SELECT *, o_totalprice > 250000 AS is_large FROM orders"
_JUNK = f"""SELECT CAST(row_number() OVER (ORDER BY o_orderstatus, o_orderpriority, is_large) AS INTEGER) AS junk_key,
    o_orderstatus, o_orderpriority, is_large FROM (SELECT DISTINCT o_orderstatus, o_orderpriority, is_large FROM ({_FLAGGED}))"""


def _flagged(spark, d):
    return table(spark, d, "orders").withColumn("is_large", F.col("o_totalprice") > 250000)


@query("dim_junk", _JUNK)
def dim_junk(spark, d):
    return dimensions.junk(_flagged(spark, d), _FLAGS)


@query(
    "dim_junk_extend",
    f"""WITH old AS (SELECT CAST(row_number() OVER (ORDER BY o_orderstatus, o_orderpriority, is_large) AS INTEGER) AS junk_key, *
              FROM (SELECT DISTINCT o_orderstatus, o_orderpriority, is_large FROM ({_FLAGGED}) WHERE o_orderstatus <> 'F')),
            new AS (SELECT DISTINCT o_orderstatus, o_orderpriority, is_large FROM ({_FLAGGED}) WHERE o_orderstatus = 'F')
       SELECT * FROM old UNION ALL
       SELECT CAST((SELECT count(*) FROM old) + row_number() OVER (ORDER BY o_orderstatus, o_orderpriority, is_large) AS INTEGER), *
       FROM new""",
)
def dim_junk_extend(spark, d):
    """New flag combinations are numbered after the ones known before."""
    flagged = _flagged(spark, d)
    known = materialize(dimensions.junk(flagged.filter("o_orderstatus <> 'F'"), _FLAGS), "junk")
    return dimensions.junk(flagged, _FLAGS, known)


@query(
    "fact_with_junk_key",
    f"""SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, j.junk_key FROM ({_FLAGGED}) o
        JOIN ({_JUNK}) j USING (o_orderstatus, o_orderpriority, is_large)""",
)
def fact_with_junk_key(spark, d):
    flagged = _flagged(spark, d)
    dim = materialize(dimensions.junk(flagged, _FLAGS), "junk")
    return facts.with_junk_key(flagged, dim, _FLAGS).select("o_orderkey", "o_custkey", "o_totalprice", "junk_key")


def _scd2_sql(where: str = "true", key: str = "o_custkey", source: str = "orders", tracked: str = "o_orderpriority") -> str:
    names = tracked.split(", ")
    text = names[0] if len(names) == 1 else " || ".join(f"length({c}) || ':' || {c}" for c in names)
    return f"""SELECT {key}, {tracked}, effective_from,
        CAST(lead(effective_from) OVER w - 1 AS DATE) AS effective_to, lead(effective_from) OVER w IS NULL AS is_current,
        CAST(row_number() OVER w AS INTEGER) AS version, change_hash
      FROM (SELECT *, lag(change_hash) OVER (PARTITION BY {key} ORDER BY effective_from) AS before FROM (
        SELECT {key}, {tracked}, CAST(o_orderdate AS DATE) AS effective_from, sha256({text}) AS change_hash
        FROM (SELECT *, row_number() OVER (PARTITION BY {key}, CAST(o_orderdate AS DATE)
              ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM {source} WHERE {where}) WHERE rn = 1))
      WHERE before IS DISTINCT FROM change_hash
      WINDOW w AS (PARTITION BY {key} ORDER BY effective_from)"""


def _priorities(orders):
    return dimensions.scd2_build(orders, "o_custkey", ["o_orderpriority"], "o_orderdate", ["o_orderkey"])


@query("scd2_build", _scd2_sql())
def scd2_build(spark, d):
    """Priority history of each customer."""
    return _priorities(table(spark, d, "orders"))


@query("scd2_build_two_columns", _scd2_sql(tracked="o_orderstatus, o_orderpriority"))
def scd2_build_two_columns(spark, d):
    """A version opens when either tracked column changes."""
    tracked = ["o_orderstatus", "o_orderpriority"]
    return dimensions.scd2_build(table(spark, d, "orders"), "o_custkey", tracked, "o_orderdate", ["o_orderkey"])


@query(
    "dim_scd2",
    f"""SELECT o_custkey AS customer_key, o_orderpriority AS priority, effective_from, effective_to, is_current, version,
               change_hash, TIMESTAMP '{AS_OF}' AS gold_processed_ts FROM ({_scd2_sql()})""",
)
def dim_scd2(spark, d):
    """The type 2 dimension under its gold names, stamped."""
    kept = [c for c in dimensions.SCD2_COLUMNS]
    names = {"o_custkey": "customer_key", "o_orderpriority": "priority", **{c: c for c in kept}}
    return lineage.stamp(facts.project(_priorities(table(spark, d, "orders")), names), lineage.GOLD_TS, as_of())


@query(
    "scd2_gap_check",
    f"""WITH dim AS (SELECT o_custkey, CASE WHEN version = 3 THEN effective_from + 2 ELSE effective_from END AS effective_from,
                     CASE WHEN version = 4 AND NOT is_current THEN effective_to + 1 ELSE effective_to END AS effective_to,
                     is_current OR version = 1 AS is_current FROM ({_scd2_sql()})),
            l AS (SELECT *, lag(effective_to) OVER w AS before, row_number() OVER w > 1 AS follows FROM dim
                  WINDOW w AS (PARTITION BY o_custkey ORDER BY effective_from, effective_to NULLS LAST))
       SELECT o_custkey, CAST(effective_from AS DATE) AS effective_from,
              CASE WHEN before IS NULL OR effective_from < before + 1 THEN 'overlap' ELSE 'gap' END AS issue
       FROM l WHERE follows AND (before IS NULL OR effective_from <> before + 1)
       UNION ALL SELECT o_custkey, CAST(max(effective_from) AS DATE), 'several_current' FROM dim WHERE is_current
       GROUP BY o_custkey HAVING count(*) > 1""",
)
def scd2_gap_check(spark, d):
    """Gaps, overlaps and extra current rows put into a sound dimension."""
    broken = _priorities(table(spark, d, "orders")).selectExpr(
        "o_custkey",
        "if(version = 3, date_add(effective_from, 2), effective_from) AS effective_from",
        "if(version = 4 AND NOT is_current, date_add(effective_to, 1), effective_to) AS effective_to",
        "is_current OR version = 1 AS is_current",
    )
    return dimensions.scd2_issues(broken, "o_custkey")


_BATCH = "1999-07-01"


@query(
    "scd2_apply",
    f"""WITH dim AS ({_scd2_sql(f"o_orderdate < TIMESTAMP '{_BATCH} 00:00:00'")}),
            inc AS (SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day, sha256(o_orderpriority) AS h FROM (
              SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
              WHERE o_orderdate >= TIMESTAMP '{_BATCH} 00:00:00') WHERE rn = 1),
            hit AS (SELECT dim.*, inc.o_orderpriority AS p, day, h FROM dim LEFT JOIN inc ON dim.o_custkey = inc.o_custkey
                    AND is_current AND h <> change_hash)
       SELECT o_custkey, o_orderpriority, effective_from,
              CASE WHEN day IS NULL THEN effective_to ELSE CAST(day - 1 AS DATE) END AS effective_to,
              is_current AND day IS NULL AS is_current, version, change_hash FROM hit
       UNION ALL SELECT o_custkey, p, day, NULL, true, version + 1, h FROM hit WHERE day IS NOT NULL
       UNION ALL SELECT o_custkey, o_orderpriority, day, NULL, true, 1, h FROM inc WHERE o_custkey NOT IN (SELECT o_custkey FROM dim)""",
)
def scd2_apply(spark, d):
    """Latest priorities since a day applied to the dimension as it was before."""
    orders = table(spark, d, "orders")
    before = materialize(_priorities(orders.filter(F.col("o_orderdate") < f"{_BATCH} 00:00:00")), "dim")
    recent = orders.filter(F.col("o_orderdate") >= f"{_BATCH} 00:00:00")
    batch = dedupe.latest_per_key(recent, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return dimensions.scd2_apply(before, batch, "o_custkey", ["o_orderpriority"], "o_orderdate", stage=True)


# rows of one moment are told apart by their values, as a version does not keep other columns
@query("scd2_apply_history", _scd2_sql().replace("o_orderkey DESC", "o_orderpriority DESC"))
def scd2_apply_history(spark, d):
    """Batches of whole days in no order, and one whose rows come back to days that are already there, give what the whole history gives."""
    orders = table(spark, d, "orders")
    month, early = F.month("o_orderdate"), F.col("o_orderkey") % 2 == 0
    batches = [orders.filter(month % 3 == 1), orders.filter((month % 3 == 0) & early), orders.filter((month % 3 == 0) & ~early), orders.filter(month % 3 == 2), orders.filter((month == 6) & early)]
    dim = None
    for rows in batches:
        dim = materialize(dimensions.scd2_splice(dim, rows, "o_custkey", ["o_orderpriority"], "o_orderdate", stage=True), "dim")
    return dim.drop("seen")


@query(
    "scd2_late",
    f"""WITH dim AS ({_scd2_sql()}),
            inc AS (SELECT o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM (
              SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
              WHERE o_orderstatus = 'F') WHERE rn = 1)
       SELECT inc.o_custkey, inc.o_orderpriority, day, 'older than current version' AS reason
       FROM inc JOIN dim ON inc.o_custkey = dim.o_custkey AND is_current AND day < effective_from""",
)
def scd2_late(spark, d):
    """Changes that come after a newer version is known are reported, not applied."""
    orders = table(spark, d, "orders")
    finished = dedupe.latest_per_key(orders.filter("o_orderstatus = 'F'"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    batch = finished.select("o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    return dimensions.scd2_late(_priorities(orders), batch, "o_custkey", "day")


@query(
    "scd2_point_in_time_join",
    f"""SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, v.version, v.o_orderpriority AS valid_priority FROM orders o
        LEFT JOIN (SELECT * FROM ({_scd2_sql()}) WHERE version > 1) v ON o.o_custkey = v.o_custkey
        AND CAST(o.o_orderdate AS DATE) >= v.effective_from
        AND (v.effective_to IS NULL OR CAST(o.o_orderdate AS DATE) <= v.effective_to)""",
)
def scd2_point_in_time_join(spark, d):
    """Each order with the priority version valid on its day; first versions are left out, so some find none."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    dim = _priorities(table(spark, d, "orders")).filter("version > 1").withColumnRenamed("o_orderpriority", "valid_priority")
    return dimensions.point_in_time(orders, dim, "o_custkey", "o_orderdate", "o_custkey", ["version", "valid_priority"])


@query(
    "fact_line_item",
    f"""SELECT l_orderkey AS order_key, l_linenumber AS line_number, o_custkey AS customer_key, l_partkey AS product_key,
               l_extendedprice AS amount, l_quantity AS quantity, l_returnflag AS channel, l_shipdate AS transaction_ts,
               date_trunc('day', l_shipdate)::TIMESTAMP AS transaction_day, TIMESTAMP '{AS_OF}' AS gold_processed_ts
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""",
)
def fact_line_item(spark, d):
    """Row grain: line numbers repeat within an order."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    names = {
        "l_orderkey": "order_key", "l_linenumber": "line_number", "o_custkey": "customer_key", "l_partkey": "product_key",
        "l_extendedprice": "amount", "l_quantity": "quantity", "l_returnflag": "channel", "l_shipdate": "transaction_ts",
    }
    return lineage.stamp(facts.project(items, names, {"l_shipdate": "transaction_day"}), lineage.GOLD_TS, as_of())


@query(
    "fact_order",
    """SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_totalprice AS amount, o_orderstatus AS stage,
              o_orderdate AS close_date, date_trunc('day', o_orderdate)::TIMESTAMP AS close_day FROM orders""",
)
def fact_order(spark, d):
    names = {
        "o_orderkey": "order_key", "o_custkey": "customer_key", "o_totalprice": "amount", "o_orderstatus": "stage",
        "o_orderdate": "close_date",
    }
    return facts.project(table(spark, d, "orders"), names, {"o_orderdate": "close_day"})


_SNAPSHOT = """
    WITH act AS (SELECT c_nationkey, o_custkey, date_trunc('month', o_orderdate)::DATE AS m, CAST(o_totalprice AS DECIMAL(18,2)) AS a
                 FROM orders JOIN customer ON o_custkey = c_custkey),
      lives AS (SELECT c_nationkey, o_custkey, min(m) AS f, max(m) AS l FROM act GROUP BY 1, 2),
      spine AS (SELECT c_nationkey, CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS DATE) AS m
                FROM act GROUP BY 1),
      heads AS (SELECT s.c_nationkey, s.m, count(*) AS headcount, count(*) FILTER (l.l = s.m) AS leavers
                FROM spine s JOIN lives l ON l.c_nationkey = s.c_nationkey AND l.f <= s.m AND l.l >= s.m GROUP BY 1, 2),
      acts AS (SELECT c_nationkey, m, count(DISTINCT o_custkey) AS active, CAST(sum(a) AS DOUBLE) / count(*) AS avg_a FROM act GROUP BY 1, 2)
    SELECT s.c_nationkey, s.m AS snapshot_month, coalesce(headcount, 0) AS headcount,
           coalesce(active, 0) AS active_headcount, avg_a AS avg_amount,
           leavers / headcount AS turnover_rate
    FROM spine s LEFT JOIN heads h ON h.c_nationkey = s.c_nationkey AND h.m = s.m
    LEFT JOIN acts a ON a.c_nationkey = s.c_nationkey AND a.m = s.m"""


def _snapshot(spark, d):
    members = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    activity = table(spark, d, "orders").join(members, F.col("o_custkey") == F.col("c_custkey"))
    return facts.monthly_snapshot(activity, "c_nationkey", "o_custkey", "o_orderdate", "o_totalprice", "decimal(18,2)")


@query("fact_periodic_snapshot", _SNAPSHOT)
def fact_periodic_snapshot(spark, d):
    """Customers of each nation by month: present, ordering, mean order, and share that orders no more."""
    return _snapshot(spark, d)


@query(
    "fact_periodic_snapshot_dim",
    f"""SELECT f.*, n_name AS nation_name, r_name AS region_name FROM ({_SNAPSHOT}) f
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def fact_periodic_snapshot_dim(spark, d):
    """The snapshot with its dimension by a left join."""
    region = table(spark, d, "region")
    nation = table(spark, d, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation_name"), F.col("r_name").alias("region_name")
    )
    return _snapshot(spark, d).join(nation, "c_nationkey", "left")


_BY_NATION = "(SELECT * FROM orders JOIN customer ON o_custkey = c_custkey)"


@query(
    "fact_periodic_snapshot_scd2",
    f"""SELECT f.*, v.version, v.o_orderpriority AS last_priority FROM ({_SNAPSHOT}) f
        LEFT JOIN ({_scd2_sql(key="c_nationkey", source=_BY_NATION)}) v ON f.c_nationkey = v.c_nationkey
        AND f.snapshot_month >= v.effective_from AND (v.effective_to IS NULL OR f.snapshot_month <= v.effective_to)""",
)
def fact_periodic_snapshot_scd2(spark, d):
    """The snapshot with the version of its nation valid on the first of the month."""
    members = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    history = table(spark, d, "orders").join(members, F.col("o_custkey") == F.col("c_custkey"))
    dim = dimensions.scd2_build(history, "c_nationkey", ["o_orderpriority"], "o_orderdate", ["o_orderkey"])
    named = dim.withColumnRenamed("o_orderpriority", "last_priority")
    carried = ["version", "last_priority"]
    return dimensions.point_in_time(_snapshot(spark, d), named, "c_nationkey", "snapshot_month", "c_nationkey", carried)


_LIFE = """SELECT event_id, user_id, event_type, ts AS entered_ts,
      lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS exited_ts FROM events"""
_LIFECYCLE = f"""SELECT *, CAST(date_diff('day', entered_ts, exited_ts) AS INTEGER) AS duration_days,
      exited_ts IS NULL AS is_current_stage FROM ({_LIFE})"""


@query("fact_accumulating_lifecycle", _LIFECYCLE)
def fact_accumulating_lifecycle(spark, d):
    """Stages a user goes through, one row each."""
    return facts.lifecycle(table(spark, d, "events"), "user_id", "event_type", "ts", "event_id")


@query("fact_accumulating_lifecycle_hot", _LIFECYCLE)
def fact_accumulating_lifecycle_hot(spark, d):
    """The same with nearly every user treated as a hot key."""
    return facts.lifecycle(table(spark, d, "events"), "user_id", "event_type", "ts", "event_id", hot_rows=6)


@query(
    "lifecycle_stage_metrics",
    f"""SELECT event_type, count(*) AS n_entered, count(exited_ts) AS n_exited,
               count(exited_ts) / count(*) AS conversion_rate,
               CAST(sum(duration_days) AS DOUBLE) / count(duration_days) AS avg_duration_days FROM ({_LIFECYCLE}) GROUP BY 1""",
)
def lifecycle_stage_metrics(spark, d):
    life = facts.lifecycle(table(spark, d, "events"), "user_id", "event_type", "ts", "event_id")
    return facts.stage_metrics(life, "event_type")


def flagship(spark, d):
    """Raw orders to a daily count per segment, through every layer."""
    raw = lineage.from_files(table(spark, d, "orders"), "erp", "orders", as_of=as_of())
    latest = dedupe.latest_per_key(raw, ["o_orderkey"], ["o_orderdate"])
    valid = quality.apply_rules(latest, [Rule("price_positive", "o_totalprice > 0", action="drop")]).clean
    customer = protect.protect(table(spark, d, "customer"), [Policy("c_name", "hash")])
    dim = dimensions.scd1(customer, {"c_custkey": "customer_key", "c_name": "customer_name", "c_mktsegment": "segment"})
    names = {"o_orderkey": "order_key", "o_custkey": "customer_key", "o_totalprice": "amount", "o_orderdate": "close_date"}
    fact = facts.project(valid, names, {"o_orderdate": "close_day"})
    joined = fact.join(dim, "customer_key", "left")
    return joined.groupBy(F.to_date("close_day").alias("day"), "segment").agg(
        F.count("*").alias("n_orders"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount")
    )


@query(
    "flagship",
    """SELECT CAST(o_orderdate AS DATE) AS day, c_mktsegment AS segment, count(*) AS n_orders,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 0 GROUP BY 1, 2""",
)
def flagship_query(spark, d):
    return flagship(spark, d)
