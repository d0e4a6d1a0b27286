"""Quality rules and actions."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.functions import checks
from stratiform.operators import quality
from stratiform.plans.catalogue.registry import lineitem, query, table
from stratiform.spec import Rule

_NOW = "2024-01-25 12:00:00"


def _now():
    return F.lit(_NOW).cast("timestamp_ntz")


@query(
    "rule_not_null",
    "SELECT event_id, user_id AS u FROM events WHERE event_type <> 'error' AND user_id IS NOT NULL",
)
def rule_not_null(spark, d):
    """NULLs are put in, the tables have none."""
    return table(spark, d, "events").selectExpr("event_id", "if(event_type = 'error', NULL, user_id) AS u").filter(checks.not_null("u"))


@query(
    "rule_freshness",
    f"""SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE ts END AS seen_ts,
               coalesce(event_type <> 'view' AND ts >= TIMESTAMP '{_NOW}' - INTERVAL 48 HOURS, false) AS is_fresh
        FROM events""",
)
def rule_freshness(spark, d):
    """A row without a time is stale."""
    events = table(spark, d, "events").selectExpr("event_id", "if(event_type = 'view', NULL, ts) AS seen_ts")
    return events.withColumn("is_fresh", checks.freshness("seen_ts", _now(), 48))


@query(
    "rule_no_future_dates",
    f"""SELECT event_id, event_type = 'view' OR CAST(ts AS DATE) <= DATE '2024-01-25' AS is_past FROM events""",
)
def rule_no_future_dates(spark, d):
    """Later on the same day is not the future, and NULL passes."""
    events = table(spark, d, "events").selectExpr("event_id", "if(event_type = 'view', NULL, ts) AS seen_ts")
    return events.select("event_id", checks.no_future("seen_ts", _now()).alias("is_past"))


@query(
    "rule_allowed_values",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')",
)
def rule_allowed_values(spark, d):
    ok = checks.allowed_values("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])
    return table(spark, d, "orders").select("o_orderkey", "o_orderpriority").filter(ok)


@query(
    "rule_unique_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1 AS is_unique
       FROM lineitem""",
)
def rule_unique_key(spark, d):
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    counted = quality.with_key_count(items, ["l_orderkey", "l_linenumber"])
    return counted.withColumn("is_unique", checks.unique()).drop("_key_count")


@query(
    "rule_referential",
    """SELECT o_orderkey, o_custkey + 100 AS ref_custkey FROM orders
       WHERE o_custkey + 100 NOT IN (SELECT c_custkey FROM customer)""",
)
def rule_referential(spark, d):
    """Orders with shifted customer keys, some of which do not exist."""
    orders = table(spark, d, "orders").selectExpr("o_orderkey", "o_custkey + 100 AS ref_custkey")
    return quality.orphans(orders, "ref_custkey", table(spark, d, "customer"), "c_custkey")


@query(
    "rule_referential_flag",
    """SELECT p.p_partkey, p.p_partkey * 2 AS parent_key, q.p_partkey IS NOT NULL AS parent_exists
       FROM part p LEFT JOIN part q ON q.p_partkey = p.p_partkey * 2""",
)
def rule_referential_flag(spark, d):
    """Self-reference as a rule: every part names a parent part, which half of the time does not exist."""
    part = table(spark, d, "part").selectExpr("p_partkey", "p_partkey * 2 AS parent_key")
    found = quality.with_reference(part, "parent_key", table(spark, d, "part"), "p_partkey")
    return found.withColumn("parent_exists", checks.exists("parent_key")).drop("_reference_found")


@query(
    "rule_volume_anomaly",
    """WITH daily AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows FROM events GROUP BY 1),
            base AS (SELECT *, avg(n_rows) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS a FROM daily)
       SELECT day, n_rows, a AS trailing_avg, coalesce(abs(n_rows / a - 1) > 0.1, false) AS is_anomaly FROM base""",
)
def rule_volume_anomaly(spark, d):
    return quality.volume_anomaly(table(spark, d, "events"), "ts", 0.1)


@query(
    "rule_volume_anomaly_by_type",
    """WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n_rows FROM events GROUP BY 1, 2),
            base AS (SELECT *, avg(n_rows) OVER (PARTITION BY event_type ORDER BY day
                     ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS a FROM daily)
       SELECT event_type, day, n_rows, coalesce(abs(n_rows / a - 1) > 0.3, false) AS is_anomaly FROM base""",
)
def rule_volume_anomaly_by_type(spark, d):
    return quality.volume_anomaly(table(spark, d, "events"), "ts", 0.3, by=["event_type"]).drop("trailing_avg")


_RULES = (
    Rule("quantity_positive", "l_quantity > 0", action="fail"),
    Rule("returned", "l_returnflag <> 'R'", action="drop"),
    Rule("bulk_item", "l_quantity <= 45", action="quarantine"),
    Rule("steep_discount", "l_discount < 0.09", action="quarantine"),
    Rule("untaxed", "nullif(l_tax, 0) > 0", action="warn"),
    Rule("status_known", check="allowed_values", action="log_only", params={"column": "l_linestatus", "values": ["O"]}),
)
_TEXT = "SELECT *, l_discount + 0.0 AS disc FROM lineitem"


@query(
    "dq_drop",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_returnflag <> 'R'",
)
def dq_drop(spark, d):
    outcome = quality.apply_rules(lineitem(spark, d), _RULES[:2])
    return outcome.clean.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "dq_warn_metrics",
    f"""WITH t AS ({_TEXT}), n AS (SELECT count(*) AS n_rows FROM t)
        SELECT rule_name, action, n_rows, n_failed FROM n, (
        SELECT 'quantity_positive' AS rule_name, 'fail' AS action, count(*) FILTER (l_quantity <= 0) AS n_failed FROM t
        UNION ALL SELECT 'returned', 'drop', count(*) FILTER (l_returnflag = 'R') FROM t
        UNION ALL SELECT 'bulk_item', 'quarantine', count(*) FILTER (l_quantity > 45) FROM t
        UNION ALL SELECT 'steep_discount', 'quarantine', count(*) FILTER (disc >= 0.09) FROM t
        UNION ALL SELECT 'untaxed', 'warn', count(*) FILTER (l_tax = 0) FROM t
        UNION ALL SELECT 'status_known', 'log_only', count(*) FILTER (l_linestatus <> 'O') FROM t)""",
)
def dq_warn_metrics(spark, d):
    """Every rule counts its violations, an UNKNOWN result included; nothing is removed."""
    return quality.metrics(lineitem(spark, d), _RULES)


@query(
    "dq_fail_gate",
    """SELECT l_returnflag, count(*) AS n_rows, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
       FROM lineitem GROUP BY 1""",
)
def dq_fail_gate(spark, d):
    """The gate lets a table without violations through unchanged."""
    passed = quality.gate(lineitem(spark, d), _RULES)
    return passed.groupBy("l_returnflag").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"),
    )


@query(
    "dq_quarantine",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, disc AS l_discount,
               concat_ws(',', CASE WHEN l_quantity > 45 THEN 'bulk_item' END,
                              CASE WHEN disc >= 0.09 THEN 'steep_discount' END) AS failed_rules
        FROM ({_TEXT}) WHERE l_returnflag <> 'R' AND (l_quantity > 45 OR disc >= 0.09)""",
)
def dq_quarantine(spark, d):
    outcome = quality.apply_rules(lineitem(spark, d), _RULES)
    return outcome.quarantine.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


@query(
    "dq_apply_rules",
    f"""SELECT CASE WHEN l_returnflag = 'R' THEN 'dropped'
                    WHEN l_quantity > 45 OR disc >= 0.09 THEN 'quarantine' ELSE 'clean' END AS outcome,
               l_returnflag, count(*) AS n_rows FROM ({_TEXT}) WHERE l_returnflag <> 'R' GROUP BY 1, 2""",
)
def dq_apply_rules(spark, d):
    """All actions together; the clean and the quarantined part cover what is not dropped."""
    outcome = quality.apply_rules(lineitem(spark, d), _RULES)
    parts = {"clean": outcome.clean, "quarantine": outcome.quarantine}
    labelled = [df.select("l_returnflag", F.lit(n).alias("outcome")) for n, df in parts.items()]
    return labelled[0].unionByName(labelled[1]).groupBy("outcome", "l_returnflag").agg(F.count("*").alias("n_rows"))


@query(
    "dq_table_rules",
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey + 3 AS ref, l_quantity,
                  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, ref, l_quantity,
              concat_ws(',', CASE WHEN n > 1 THEN 'one_per_key' END, CASE WHEN s_suppkey IS NULL THEN 'supplier_known' END,
                             CASE WHEN l_quantity > 45 THEN 'bulk_item' END) AS failed_rules
       FROM t LEFT JOIN supplier ON ref = s_suppkey WHERE n > 1 OR s_suppkey IS NULL OR l_quantity > 45""",
)
def dq_table_rules(spark, d):
    """Uniqueness and reference rules beside a row rule."""
    items = table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey + 3 AS ref", "l_quantity")
    known = {"column": "ref", "reference": table(spark, d, "supplier"), "reference_column": "s_suppkey"}
    rules = [
        Rule("one_per_key", check="unique", action="quarantine"),
        Rule("supplier_known", check="exists", action="quarantine", params=known),
        Rule("bulk_item", "l_quantity <= 45", action="quarantine"),
    ]
    outcome = quality.apply_rules(items, rules, ["l_orderkey", "l_linenumber"])
    return outcome.quarantine.withColumn("failed_rules", F.array_join("failed_rules", ","))


_WINDOWED = [
    Rule("silver_unique_business_key", "COUNT(*) OVER (PARTITION BY {primary_key_columns}) = 1", action="quarantine"),
    Rule("no_whale", "l_extendedprice < 0.95 * SUM(l_extendedprice) OVER (PARTITION BY l_orderkey) OR count(1) over (partition by l_orderkey) = 1", action="drop"),
    Rule("order_bounded", "max(l_quantity) OVER (PARTITION BY l_orderkey, l_returnflag) <= 50", action="fail"),
    Rule("not_a_jump", "l_quantity <= 40 + coalesce(lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey), 50)", action="quarantine"),
    Rule("note", "l_returnflag <> 'over (partition by)'", action="drop"),
]


@query(
    "dq_window_expression",
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_returnflag FROM lineitem WHERE l_linenumber <= 6
                  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey + 1, l_extendedprice, l_quantity, l_returnflag FROM lineitem WHERE l_linenumber = 2 AND l_orderkey % 7 = 0),
            w AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1 AS single,
                         l_extendedprice < 0.95 * sum(l_extendedprice) OVER (PARTITION BY l_orderkey) OR count(*) OVER (PARTITION BY l_orderkey) = 1 AS no_whale,
                         l_quantity <= 40 + coalesce(lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey), 50) AS no_jump FROM t)
       SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
              concat_ws(',', CASE WHEN NOT single THEN 'silver_unique_business_key' END, CASE WHEN NOT no_jump THEN 'not_a_jump' END) AS failed_rules
       FROM w WHERE no_whale""",
)
def dq_window_expression(spark, d):
    """Rules with window functions that fail, drop and quarantine, the default rule of a unique key among them."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_returnflag"]
    items = table(spark, d, "lineitem").select(columns)
    again = items.filter("l_linenumber = 2 AND l_orderkey % 7 = 0").withColumn("l_partkey", F.col("l_partkey") + 1)
    outcome = quality.apply_rules(items.filter("l_linenumber <= 6").unionByName(again), _WINDOWED, ["l_orderkey", "l_linenumber"])
    rows = outcome.quarantine.unionByName(outcome.clean.withColumn("failed_rules", F.array().cast("array<string>")))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.array_join("failed_rules", ",").alias("failed_rules"))


@query(
    "volume_floor_checks",
    """SELECT * FROM (SELECT 'customer' AS table_name, count(*) AS n_rows, CAST(100 AS BIGINT) AS min_rows, count(*) >= 100 AS is_ok FROM customer
       UNION ALL SELECT 'supplier', count(*), 5000, count(*) >= 5000 FROM supplier
       UNION ALL SELECT 'part', count(*), 50, count(*) >= 50 FROM part
       UNION ALL SELECT 'orders', count(*), 5000, count(*) >= 5000 FROM orders
       UNION ALL SELECT 'lineitem', count(*), 5000, count(*) >= 5000 FROM lineitem)""",
)
def volume_floor_checks(spark, d):
    floors = {"customer": 100, "supplier": 5000, "part": 50, "orders": 5000, "lineitem": 5000}
    return quality.volume_floors({name: (table(spark, d, name), floor) for name, floor in floors.items()})
