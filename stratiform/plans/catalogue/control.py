"""Keyed tables and control state. The given tables stand in for control tables of any size."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.functions import lineage, values
from stratiform.operators import control, dedupe, keyed
from stratiform.plans import metadata
from stratiform.plans.catalogue.registry import AS_OF, as_of, query, table
from stratiform.session import scratch_dir
from stratiform.sources import tables

_NOW = f"TIMESTAMP '{AS_OF}'"


@query(
    "control_active_filter",
    """SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 10 AND p_type = 'ECONOMY'
       ORDER BY p_name, p_partkey""",
)
def control_active_filter(spark, d):
    """Active rows of one subject, listed in order."""
    part = table(spark, d, "part").withColumn("is_active", F.col("p_size") > 10)
    return control.active(part, F.col("p_type") == "ECONOMY").select("p_partkey", "p_name", "p_size").orderBy(
        "p_name", "p_partkey"
    )


@query(
    "control_counts",
    """SELECT count(*) AS n_requests, count(*) FILTER (o_orderstatus = 'O') AS n_open,
              count(*) FILTER (o_orderstatus = 'F' AND o_totalprice > 250000) AS n_large_finished FROM orders""",
)
def control_counts(spark, d):
    return table(spark, d, "orders").agg(
        F.count("*").alias("n_requests"),
        F.count_if(F.col("o_orderstatus") == "O").alias("n_open"),
        F.count_if((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 250000)).alias("n_large_finished"),
    )


@query(
    "control_left_join_view",
    """SELECT s_suppkey, s_name, n_name FROM supplier
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON s_nationkey = n_nationkey""",
)
def control_left_join_view(spark, d):
    """Entities with their configuration where there is one, as a view."""
    configs = table(spark, d, "nation").filter("n_regionkey <> 2")
    joined = table(spark, d, "supplier").join(configs, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    joined.select("s_suppkey", "s_name", "n_name").createOrReplaceTempView("entities_with_configs")
    return spark.table("entities_with_configs")


@query(
    "control_effective_config",
    """WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
                       CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END, o_orderkey) AS rn
                       FROM orders WHERE o_orderstatus IN ('F', 'O'))
       SELECT c_custkey, o_orderkey AS config_id,
              CASE o_orderstatus WHEN 'F' THEN 'prod' WHEN 'O' THEN 'all' END AS environment
       FROM customer LEFT JOIN ranked ON c_custkey = o_custkey AND rn = 1""",
)
def control_effective_config(spark, d):
    """Every entity with its one effective configuration, in bulk."""
    configs = table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("config_id"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'prod' WHEN 'O' THEN 'all' ELSE 'test' END").alias("environment"),
    )
    known = configs.filter(F.col("environment").isin("prod", "all"))
    rank = dedupe.environment_rank("environment", "prod")
    effective = dedupe.preferred_row(known, ["c_custkey"], rank, ["config_id"])
    return table(spark, d, "customer").select("c_custkey").join(effective, "c_custkey", "left")


@query(
    "preferred_row_per_key",
    """SELECT o_custkey, o_orderkey, environment FROM (
         SELECT *, CASE o_orderstatus WHEN 'F' THEN 'prod' WHEN 'O' THEN 'all' ELSE 'test' END AS environment,
                row_number() OVER (PARTITION BY o_custkey ORDER BY
                  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderkey) AS rn FROM orders)
       WHERE rn = 1""",
)
def preferred_row_per_key(spark, d):
    configs = table(spark, d, "orders").select(
        "o_custkey", "o_orderkey",
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'prod' WHEN 'O' THEN 'all' ELSE 'test' END").alias("environment"),
    )
    rank = dedupe.environment_rank("environment", "prod")
    return dedupe.preferred_row(configs, ["o_custkey"], rank, ["o_orderkey"])


@query(
    "latest_version_per_key",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
         PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_version_per_key(spark, d):
    return dedupe.latest_version(table(spark, d, "orders"), ["o_custkey"], "o_orderkey")


_CUT, _FROM = "1999-01-01 00:00:00", "1998-01-01 00:00:00"


@query(
    "keyed_upsert",
    f"""WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}'),
            s AS (SELECT * REPLACE (o_totalprice * CAST(1.1 AS DOUBLE) AS o_totalprice) FROM orders
                  WHERE o_orderdate >= TIMESTAMP '{_FROM}')
       SELECT t.*, 'a' AS applied_by, TIMESTAMP '2024-01-01 00:00:00' AS last_applied_ts
       FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)
       UNION ALL SELECT s.*, 'b', {_NOW} FROM s""",
)
def keyed_upsert(spark, d):
    """Old orders updated and newer ones inserted, with provenance columns."""
    orders = table(spark, d, "orders")
    earlier = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    target = lineage.with_provenance(orders.filter(F.col("o_orderdate") < _CUT), {"applied_by": "a"}, as_of=earlier)
    changed = orders.filter(F.col("o_orderdate") >= _FROM).withColumn("o_totalprice", F.col("o_totalprice") * 1.1)
    source = lineage.with_provenance(changed, {"applied_by": "b"}, as_of=as_of())
    return keyed.upsert(target, source, ["o_orderkey"], stage=True)


@query(
    "keyed_upsert_partial",
    f"""WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}'),
            s AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus FROM orders
                  WHERE o_orderdate >= TIMESTAMP '{_FROM}')
       SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
              coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus, t.o_totalprice, t.o_orderdate,
              t.o_orderpriority
       FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey AND t.o_custkey = s.o_custkey""",
)
def keyed_upsert_partial(spark, d):
    """A source with some of the columns and a key of two; the rest keeps its value or is NULL."""
    orders = table(spark, d, "orders")
    source = orders.filter(F.col("o_orderdate") >= _FROM).select(
        "o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), F.lit(1).alias("not_in_target")
    )
    return keyed.upsert(orders.filter(F.col("o_orderdate") < _CUT), source, ["o_orderkey", "o_custkey"], stage=True)


@query(
    "keyed_upsert_partitions",
    f"""WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{_CUT}'),
            s AS (SELECT * REPLACE (0.5::DOUBLE AS o_totalprice) FROM orders
                  WHERE o_orderdate >= TIMESTAMP '{_FROM}' AND o_orderstatus = 'F')
       SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s""",
)
def keyed_upsert_partitions(spark, d):
    """A table partitioned by order year; only the years the source touches are rewritten."""
    orders = table(spark, d, "orders").withColumn("o_year", F.year("o_orderdate"))
    path = scratch_dir(spark, "silver-orders")
    orders.filter(F.col("o_orderdate") < _CUT).write.partitionBy("o_year").parquet(path)
    changed = orders.filter((F.col("o_orderdate") >= _FROM) & (F.col("o_orderstatus") == "F"))
    source = changed.withColumn("o_totalprice", F.lit(0.5))
    tables.upsert_partitions(spark, path, source, ["o_orderkey"], "o_year")
    return spark.read.parquet(path).drop("o_year")


def _upsert_by(spark, d, partition):
    orders = table(spark, d, "orders").withColumn("o_part", partition)
    path = scratch_dir(spark, "silver-orders")
    tables.upsert_partitions(spark, path, orders.filter(F.col("o_orderdate") < _CUT), ["o_orderkey"], "o_part")
    changed = orders.filter((F.col("o_orderdate") >= _FROM) & (F.col("o_orderstatus") == "F"))
    tables.upsert_partitions(spark, path, changed.withColumn("o_totalprice", F.lit(0.5)), ["o_orderkey"], "o_part")
    return tables.read_partitioned(spark, path)


def _upsert_by_sql(partition):
    return f"""WITH o AS (SELECT *, {partition} AS o_part FROM orders), t AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '{_CUT}'),
            s AS (SELECT * REPLACE (0.5::DOUBLE AS o_totalprice) FROM o
                  WHERE o_orderdate >= TIMESTAMP '{_FROM}' AND o_orderstatus = 'F')
       SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT * FROM s"""


@query("keyed_upsert_null_partition", _upsert_by_sql("CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 3 END"))
def keyed_upsert_null_partition(spark, d):
    """A third of the orders lies in the partition of NULL."""
    return _upsert_by(spark, d, F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey") % 3))


@query("keyed_upsert_text_partition", _upsert_by_sql("'00' || CAST(o_orderkey % 3 AS varchar)"))
def keyed_upsert_text_partition(spark, d):
    """Partitions named by digits stay text."""
    return _upsert_by(spark, d, F.concat(F.lit("00"), (F.col("o_orderkey") % 3).cast("string")))


@query(
    "predicate_update",
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice > 300000 THEN 'F' ELSE o_orderstatus END
              AS o_orderstatus,
              CASE WHEN o_orderstatus = 'P' AND o_totalprice > 300000 THEN 0 ELSE o_totalprice END AS o_totalprice
       FROM orders""",
)
def predicate_update(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    hit = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 300000)
    return keyed.update_where(orders, hit, {"o_orderstatus": F.lit("F"), "o_totalprice": F.lit(0)})


@query(
    "audit_insert",
    f"""SELECT 'orders-' || strftime(o_orderdate, '%Y-%m') AS deployment_id, 'success' AS status,
              max(o_orderdate) AS started_ts, 1 AS n_tables FROM orders GROUP BY 1
       UNION ALL SELECT DISTINCT 'events-' || strftime(ts, '%Y-%m-%d'), 'running', {_NOW}, 0 FROM events""",
)
def audit_insert(spark, d):
    """Running entries for each day of events beside finished entries for each month of orders."""
    done = (
        table(spark, d, "orders")
        .groupBy(F.concat(F.lit("orders-"), F.date_format("o_orderdate", "yyyy-MM")).alias("deployment_id"))
        .agg(F.max("o_orderdate").alias("started_ts"))
        .withColumns({"status": F.lit("success"), "tables_applied": F.array(F.lit("orders"))})
    )
    starts = (
        table(spark, d, "events")
        .select(F.concat(F.lit("events-"), F.date_format("ts", "yyyy-MM-dd")).alias("deployment_id"))
        .distinct()
    )
    audit = control.open_audit(done, starts, as_of())
    return audit.select("deployment_id", "status", "started_ts", F.size("tables_applied").alias("n_tables"))


def _requests(spark, d):
    """Orders as reprocess requests: each names its customer and its priority."""
    names = F.concat(F.lit("c"), F.col("o_custkey"), F.lit(" , "), F.lower("o_orderpriority"), F.lit(","))
    status = F.expr("CASE o_orderstatus WHEN 'O' THEN 'approved' WHEN 'P' THEN 'executing' ELSE 'completed' END")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        values.key_list(names).alias("requested_entities"),
        status.alias("status"),
        F.col("o_orderdate").alias("created_ts"),
        F.col("o_orderdate").alias("updated_ts"),
        F.lit(None).cast("timestamp_ntz").alias("executed_at"),
        F.lit(None).cast("string").alias("execution_run_id"),
        F.lit(None).cast("string").alias("result_summary"),
        F.col("o_totalprice"),
    )


_REQUESTS = """SELECT o_orderkey AS request_id, o_custkey, o_orderpriority, o_totalprice, o_orderdate AS created_ts,
    CASE o_orderstatus WHEN 'O' THEN 'approved' WHEN 'P' THEN 'executing' ELSE 'completed' END AS status FROM orders"""


@query(
    "reprocess_request_lookup",
    f"""WITH r AS ({_REQUESTS}), e AS (
          SELECT 'c' || o_custkey AS entity_key, * FROM r WHERE status IN ('approved', 'executing')
          UNION ALL SELECT lower(o_orderpriority), * FROM r WHERE status IN ('approved', 'executing'))
        SELECT entity_key, request_id, status, created_ts FROM (SELECT *, row_number() OVER (
          PARTITION BY entity_key ORDER BY created_ts DESC, request_id DESC) AS rn FROM e) WHERE rn = 1""",
)
def reprocess_request_lookup(spark, d):
    """Newest live request of every entity; the priorities are entities that a fifth of all requests name."""
    return control.active_requests(_requests(spark, d)).select("entity_key", "request_id", "status", "created_ts")


@query(
    "reprocess_requests_naming",
    f"SELECT request_id, status FROM ({_REQUESTS}) WHERE o_orderpriority = '5-LOW' AND status <> 'completed'",
)
def reprocess_requests_naming(spark, d):
    return control.requests_naming(_requests(spark, d), "5-low").select("request_id", "status")


@query(
    "reprocess_queue_pick",
    f"SELECT request_id, created_ts FROM ({_REQUESTS}) WHERE status = 'approved' ORDER BY created_ts, request_id LIMIT 10",
)
def reprocess_queue_pick(spark, d):
    return control.queue_pick(_requests(spark, d), 10).select("request_id", "created_ts")


@query(
    "reprocess_status_transition",
    f"""SELECT request_id,
          CASE WHEN o_totalprice <= 200000 THEN status WHEN status = 'approved' THEN 'executing'
               WHEN status = 'executing' AND o_totalprice > 400000 THEN 'failed'
               WHEN status = 'executing' THEN 'completed' ELSE status END AS status,
          CASE WHEN o_totalprice > 200000 AND status <> 'completed' THEN {_NOW} ELSE created_ts END AS updated_ts,
          CASE WHEN status = 'executing' AND o_totalprice > 200000 AND o_totalprice <= 400000 THEN {_NOW} END AS executed_at,
          CASE WHEN o_totalprice > 200000 AND status <> 'completed' THEN 'run-7' END AS execution_run_id
        FROM ({_REQUESTS})""",
)
def reprocess_status_transition(spark, d):
    """Larger requests move one step; running ones complete or fail."""
    requests = _requests(spark, d)
    step = F.expr(
        """CASE WHEN status = 'approved' THEN 'executing' WHEN o_totalprice > 400000 THEN 'failed'
           ELSE 'completed' END"""
    )
    changes = requests.filter("o_totalprice > 200000 AND status <> 'completed'").select(
        "request_id", step.alias("to_status"), F.lit("run-7").alias("run_id"), F.lit(None).cast("string").alias("summary")
    )
    moved = control.transition(requests, changes, as_of())
    return moved.select("request_id", "status", "updated_ts", "executed_at", "execution_run_id")


def _entities(spark, d):
    return table(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id")).alias("entity_key")).distinct()


def _state(spark, d):
    """State after the events up to 10 January for users that had errors by then; some are reprocessing."""
    seen = (
        table(spark, d, "events")
        .filter("ts <= '2024-01-10 00:00:00' AND event_type = 'error'")
        .withColumn("entity_key", F.concat(F.lit("u"), F.col("user_id")))
    )
    busy = F.col("last_row_count") > 4
    return control.load_result(seen, "ts", ["entity_key"]).select(
        "entity_key",
        "current_watermark",
        "last_row_count",
        F.lit("run-0").alias("last_successful_run_id"),
        F.lit("2024-01-10 00:00:00").cast("timestamp_ntz").alias("last_successful_ts"),
        busy.alias("is_reprocessing"),
        F.when(busy, "r-0").alias("reprocess_request_id"),
        F.lit("2024-01-10 00:00:00").cast("timestamp_ntz").alias("updated_ts"),
    )


_STATE = """SELECT 'u' || user_id AS entity_key, max(ts) AS current_watermark, count(*) AS last_row_count,
    count(*) > 4 AS is_reprocessing, CASE WHEN count(*) > 4 THEN 'r-0' END AS reprocess_request_id
    FROM events WHERE ts <= TIMESTAMP '2024-01-10 00:00:00' AND event_type = 'error' GROUP BY 1"""


@query(
    "watermark_lookup",
    f"""WITH s AS ({_STATE}) SELECT e.entity_key, s.current_watermark,
          coalesce(s.is_reprocessing, false) AS is_reprocessing
        FROM (SELECT DISTINCT 'u' || user_id AS entity_key FROM events) e LEFT JOIN s USING (entity_key)""",
)
def watermark_lookup(spark, d):
    found = control.watermarks(_state(spark, d), _entities(spark, d))
    return found.select("entity_key", "current_watermark", "is_reprocessing")


@query(
    "watermark_advance",
    f"""WITH s AS ({_STATE}),
          n AS (SELECT 'u' || user_id AS entity_key, max(ts) AS wm, count(*) AS n FROM events
                WHERE event_type = 'click' GROUP BY 1)
        SELECT coalesce(n.entity_key, s.entity_key) AS entity_key,
          CASE WHEN n.entity_key IS NULL THEN s.current_watermark WHEN s.is_reprocessing THEN n.wm
               ELSE greatest(n.wm, s.current_watermark) END AS current_watermark,
          coalesce(n.n, s.last_row_count) AS last_row_count,
          CASE WHEN n.entity_key IS NULL THEN s.is_reprocessing ELSE false END AS is_reprocessing,
          CASE WHEN n.entity_key IS NULL THEN 'run-0' ELSE 'run-1' END AS last_successful_run_id
        FROM n FULL JOIN s USING (entity_key)""",
)
def watermark_advance(spark, d):
    """Loads of click events advance the state, never backwards unless a reprocess ends."""
    clicks = (
        table(spark, d, "events").filter("event_type = 'click'")
        .withColumn("entity_key", F.concat(F.lit("u"), F.col("user_id")))
    )
    results = control.load_result(clicks, "ts", ["entity_key"])
    moved = control.advance(_state(spark, d), results, "run-1", as_of())
    return moved.select("entity_key", "current_watermark", "last_row_count", "is_reprocessing", "last_successful_run_id")


@query(
    "watermark_rewind",
    f"""WITH s AS ({_STATE}), q AS (
          SELECT 'u' || user_id AS entity_key, CASE WHEN count(*) >= 15 THEN min(ts) END AS from_ts FROM events
          WHERE event_type = 'purchase' GROUP BY 1 HAVING count(*) >= 12)
        SELECT coalesce(q.entity_key, s.entity_key) AS entity_key,
          CASE WHEN q.entity_key IS NULL THEN s.current_watermark
               ELSE coalesce(q.from_ts, TIMESTAMP '1900-01-01 00:00:00') END AS current_watermark,
          s.last_row_count, CASE WHEN q.entity_key IS NULL THEN s.is_reprocessing ELSE true END AS is_reprocessing,
          CASE WHEN q.entity_key IS NULL THEN s.reprocess_request_id ELSE 'r-1' END AS reprocess_request_id
        FROM q FULL JOIN s USING (entity_key)""",
)
def watermark_rewind(spark, d):
    """Requested users go back to their first purchase, or to the beginning when the request names no start."""
    requests = (
        table(spark, d, "events").filter("event_type = 'purchase'")
        .groupBy(F.concat(F.lit("u"), F.col("user_id")).alias("entity_key"))
        .agg(F.count("*").alias("n"), F.min("ts").alias("first"))
        .filter("n >= 12")
        .select("entity_key", F.when(F.col("n") >= 15, F.col("first")).alias("from_watermark"), F.lit("r-1").alias("request_id"))
    )
    back = control.rewind(_state(spark, d), requests, as_of())
    return back.select("entity_key", "current_watermark", "last_row_count", "is_reprocessing", "reprocess_request_id")


@query(
    "watermark_clear_flags",
    f"""SELECT entity_key, is_reprocessing AND entity_key NOT IN ('u1', 'u2', 'u3', 'u4', 'u5') AS is_reprocessing,
          CASE WHEN entity_key NOT IN ('u1', 'u2', 'u3', 'u4', 'u5') THEN reprocess_request_id END AS reprocess_request_id
        FROM ({_STATE})""",
)
def watermark_clear_flags(spark, d):
    cleared = control.clear_flags(_state(spark, d), ["u1", "u2", "u3", "u4", "u5"], as_of())
    return cleared.select("entity_key", "is_reprocessing", "reprocess_request_id")


@query(
    "top_n_recent",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END, o_orderdate)
       AS touched_ts FROM orders ORDER BY touched_ts DESC, o_orderkey LIMIT 20""",
)
def top_n_recent(spark, d):
    orders = table(spark, d, "orders").selectExpr(
        "o_orderkey", "o_orderdate AS created_ts", "if(o_orderstatus = 'F', o_orderdate + INTERVAL 30 DAYS, NULL) AS updated_ts"
    )
    top = control.top_recent(orders, ["updated_ts", "created_ts"], "o_orderkey", 20)
    return top.select("o_orderkey", F.coalesce("updated_ts", "created_ts").alias("touched_ts"))


@query(
    "top_n_nulls_last",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 499500 THEN o_orderdate END AS executed_at FROM orders
       ORDER BY executed_at DESC NULLS LAST, o_orderkey LIMIT 50""",
)
def top_n_nulls_last(spark, d):
    orders = table(spark, d, "orders").selectExpr("o_orderkey", "if(o_totalprice > 499500, o_orderdate, NULL) AS executed_at")
    return orders.orderBy(F.desc_nulls_last("executed_at"), "o_orderkey").limit(50)


@query(
    "rules_with_defaults",
    """WITH r AS (SELECT p_partkey AS rule_id, CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN '' ELSE p_brand END
                  AS entity_key, CASE WHEN p_type = 'ECONOMY' THEN 'silver' ELSE 'bronze' END AS layer,
                  p_size = 1 OR p_retailprice > 950 AS is_default, p_size <> 3 AS is_active FROM part)
       SELECT rule_id, entity_key FROM r WHERE is_active AND layer = 'silver' AND entity_key = 'Brand#7'
       UNION ALL SELECT rule_id, entity_key FROM r
       WHERE is_active AND layer = 'silver' AND coalesce(entity_key, '') = '' AND is_default""",
)
def rules_with_defaults(spark, d):
    """Rules of one entity with the global defaults; global rules have a NULL or an empty key."""
    rules = table(spark, d, "part").select(
        F.col("p_partkey").alias("rule_id"),
        F.expr("CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN '' ELSE p_brand END").alias("entity_key"),
        F.expr("if(p_type = 'ECONOMY', 'silver', 'bronze')").alias("layer"),
        F.expr("p_size = 1 OR p_retailprice > 950").alias("is_default"),
        F.expr("p_size <> 3").alias("is_active"),
    )
    return control.rules_for(rules, "Brand#7", "silver").select("rule_id", "entity_key")


@query(
    "overlay_merge",
    """WITH b AS (SELECT c_custkey AS k, nullif(c_mktsegment, 'BUILDING') AS segment, c_nationkey AS nation,
                         c_acctbal AS balance FROM customer),
            o AS (SELECT s_suppkey * 7 AS k, CASE WHEN s_acctbal > 5000 THEN 'OVERLAY' END AS segment, s_acctbal AS balance
                  FROM supplier)
       SELECT coalesce(b.k, o.k) AS entity_key, coalesce(o.segment, b.segment, 'NONE') AS segment, b.nation,
              coalesce(o.balance, b.balance) AS balance, coalesce(o.k, b.k) = o.k AS has_overlay
       FROM b FULL JOIN o ON b.k = o.k""",
)
def overlay_merge(spark, d):
    """Overlay fields win, nested ones included; a default fills what both leave open."""
    base = table(spark, d, "customer").select(
        F.col("c_custkey").alias("entity_key"),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"),
        F.struct(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")).alias("params"),
    )
    over = table(spark, d, "supplier").select(
        (F.col("s_suppkey") * 7).alias("entity_key"),
        F.when(F.col("s_acctbal") > 5000, "OVERLAY").alias("segment"),
        F.struct(F.lit(None).cast("int").alias("nation"), F.col("s_acctbal").alias("balance")).alias("params"),
        F.lit(True).alias("has_overlay"),
    )
    merged = keyed.overlay(base, over, ["entity_key"], {"segment": "NONE"})
    return merged.select("entity_key", "segment", "params.nation", "params.balance", "has_overlay")


@query(
    "flatten_rules",
    """WITH d AS (SELECT CASE WHEN p_size = 1 THEN NULL ELSE 'part-' || p_partkey END AS entity_key,
                         CASE WHEN p_size > 25 THEN 'gold' END AS layer FROM part),
            r AS (SELECT entity_key, layer, 'size_positive' AS rule_name, 'size > 0' AS expression, 'drop' AS action, NULL AS own_layer FROM d
                  UNION ALL SELECT entity_key, layer, 'named', NULL, NULL, 'bronze' FROM d)
       SELECT coalesce(entity_key, 'global') || '_' || coalesce(own_layer, layer, 'silver') || '_' || rule_name AS rule_id,
              entity_key, rule_name, expression, NULL::VARCHAR AS library_reference,
              coalesce(own_layer, layer, 'silver') AS layer, 'expectation' AS rule_type,
              'external_library' AS enforcement_method, coalesce(action, 'warn') AS action_on_failure,
              'medium' AS severity, false AS is_default, true AS is_active FROM r""",
)
def flatten_rules(spark, d):
    """A rule document per part, with two rules each."""
    part = table(spark, d, "part")
    rules = F.array(
        F.struct(
            F.lit("size_positive").alias("rule_name"), F.lit("size > 0").alias("expression"),
            F.lit("drop").alias("action_on_failure"), F.lit(None).cast("string").alias("layer"),
        ),
        F.struct(
            F.lit("named").alias("rule_name"), F.lit(None).cast("string").alias("expression"),
            F.lit(None).cast("string").alias("action_on_failure"), F.lit("bronze").alias("layer"),
        ),
    )
    documents = part.select(
        F.when(F.col("p_size") != 1, F.concat(F.lit("part-"), F.col("p_partkey"))).alias("entity_key"),
        F.when(F.col("p_size") > 25, "gold").alias("layer"),
        rules.alias("rules"),
    )
    return control.flatten_rules(documents)


@query(
    "contract_rows",
    """SELECT 'part-' || p_partkey || '_v' || CASE WHEN p_size > 25 THEN p_size ELSE 1 END AS contract_id,
              'part-' || p_partkey AS entity_key, CASE WHEN p_size > 25 THEN p_size ELSE 1 END AS version FROM part""",
)
def contract_rows(spark, d):
    document = F.when(F.col("p_size") > 25, F.concat(F.lit('{"version": '), F.col("p_size"), F.lit("}"))).otherwise("{}")
    part = table(spark, d, "part").select(
        F.concat(F.lit("part-"), F.col("p_partkey")).alias("entity_key"), document.alias("contract_json")
    )
    return control.contract_rows(part).drop("contract_json")


_DECLARED = """
WITH e AS (
    SELECT s_suppkey AS k, 'e' || s_suppkey AS entity_key, 's' || s_nationkey % 3 AS subject, CASE WHEN s_suppkey % 3 = 0 THEN 'id' ELSE 'id,line' END AS key_columns,
           CASE WHEN s_suppkey % 4 = 0 THEN '_source_extract_ts' ELSE 'ts' END AS watermark_column, s_nationkey % 5 = 0 AS restricted
    FROM supplier WHERE s_suppkey % 10 <> 0),
own AS (
    SELECT k, CASE k % 3 WHEN 0 THEN 'positive:quarantine:v > 0;' WHEN 1 THEN 'positive:quarantine:v > 0;positive.library:quarantine:no_future;'
                         ELSE 'positive:warn:no_future;' END AS rules FROM e WHERE k % 2 = 0)
SELECT entity_key, subject, key_columns, watermark_column, restricted,
       CASE WHEN k % 7 = 0 THEN 'dev' ELSE 'all' END AS environment, CASE WHEN k % 7 = 0 THEN 7 ELSE 1 END AS batch_files,
       coalesce(rules, '') || 'silver_not_null_business_keys:fail:' || CASE WHEN k % 3 = 0 THEN '`id` IS NOT NULL' ELSE '`id` IS NOT NULL AND `line` IS NOT NULL' END
       || ';silver_not_null_business_keys.library:fail:key_present;silver_unique_business_key:fail:COUNT(*) OVER (PARTITION BY {primary_key_columns}) = 1' AS rules,
       CASE WHEN k % 4 = 1 THEN 'card:encrypt,mail:hash' ELSE '' END AS policies, CASE WHEN k % 5 = 1 THEN 2 END AS contract_version
FROM e LEFT JOIN own USING (k)"""


@query("entity_from_control", _DECLARED)
def entity_from_control(spark, d):
    """Entities with their rules, policies and contracts as control rows declare them, written down again."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.concat(F.lit("e"), "s_suppkey").alias("entity_key"), "s_nationkey")
    key_columns = F.when(F.col("k") % 3 == 0, '["id"]').when(F.col("k") % 3 == 1, '["id", "line"]').otherwise(" id , line ")
    listed = s.select(
        "entity_key", F.concat(F.lit("s"), F.col("s_nationkey") % 3).alias("subject_area_key"), key_columns.alias("primary_key_columns"),
        F.when(F.col("k") % 4 != 0, "ts").alias("watermark_column"), (F.col("s_nationkey") % 5 == 0).alias("restricted"), (F.col("k") % 10 != 0).alias("is_active"),
    )
    configs = s.select("entity_key", F.lit("all").alias("environment"), F.lit('{"files": 1}').alias("auto_loader_options"))
    configs = configs.unionByName(s.filter("k % 7 = 0").select("entity_key", F.lit("dev").alias("environment"), F.lit('{"files": 7}').alias("auto_loader_options")))
    configs = configs.unionByName(s.select("entity_key", F.lit("prod").alias("environment"), F.lit('{"files": 9}').alias("auto_loader_options")))
    method = F.when(F.col("k") % 3 == 0, "native_lakeflow").when(F.col("k") % 3 == 1, "both").otherwise("external_library")
    own = s.filter("k % 2 = 0").select(
        F.concat("entity_key", F.lit("_r")).alias("rule_id"), "entity_key", F.lit("silver").alias("layer"), F.lit("positive").alias("rule_name"), method.alias("enforcement_method"),
        F.lit("v > 0").alias("expression"), F.lit("best_practices.no_future_dates").alias("library_reference"), F.lit('{"date_col": "d"}').alias("parameters"),
        F.when(F.col("k") % 3 != 2, "quarantine").alias("action_on_failure"), F.lit(False).alias("is_default"), F.lit(True).alias("is_active"),
    )
    shared = [
        ("g_1", None, "silver", "silver_not_null_business_keys", "both", "col IS NOT NULL", "best_practices.not_null", "fail", True, True),
        ("g_2", "", "silver", "silver_unique_business_key", "native_lakeflow", "COUNT(*) OVER (PARTITION BY {primary_key_columns}) = 1", None, "fail", True, True),
        ("g_3", None, "silver", "retired", "native_lakeflow", "v < 5", None, "fail", True, False), ("g_4", None, "gold", "elsewhere", "native_lakeflow", "v < 5", None, "fail", True, True),
    ]
    names = "rule_id string, entity_key string, layer string, rule_name string, enforcement_method string, expression string, library_reference string, action_on_failure string, is_default boolean, is_active boolean"
    rules = own.unionByName(spark.createDataFrame(shared, names), allowMissingColumns=True)
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(p).alias("policy_type"), F.lit(a).alias("is_active")) for c, p, a in (("mail", "hash", True), ("card", "encrypt", True), ("old", "mask", False))]))
    policies = s.filter("k % 4 = 1").select("entity_key", kinds.alias("p")).select("entity_key", "p.*")
    documents = s.filter("k % 5 = 1").select("entity_key", F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    documents = documents.withColumn("contract_json", F.concat(F.lit('{"version": '), "version", F.lit(', "columns": [{"name": "id", "type": "bigint", "primary_key": true}]}')))
    found = metadata.declared(metadata.ControlTables(listed, configs, rules, policies, documents), "dev")
    rows = [
        (e.key, x.subject, ",".join(e.primary_key), e.watermark_column, e.restricted, x.config.get("environment"), x.config["auto_loader_options"]["files"],
         ";".join(f"{r.name}:{r.effect}:{r.expression or r.check}" for r in e.rules), ",".join(f"{p.column}:{p.kind}" for p in e.policies), e.contract and e.contract.version)
        for x in found for e in [x.entity]
    ]
    return spark.createDataFrame(rows, "entity_key string, subject string, key_columns string, watermark_column string, restricted boolean, environment string, batch_files int, rules string, policies string, contract_version int")
