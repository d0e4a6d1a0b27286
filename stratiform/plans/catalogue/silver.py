"""Silver: slices, dedupe, contracts, refresh."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions import values
from stratiform.operators import contract, dedupe, keyed, slices
from stratiform.plans.catalogue.registry import AS_OF, as_of, lineitem, query, table
from stratiform.plans.refresh import REQUEST_SCHEMA, Lake, refresh_entity
from stratiform.plans.silver import read_silver, run_silver, silver_refresh
from stratiform.session import scratch_dir
from stratiform.sources import commits, tables
from stratiform.spec import Column_, Contract, Entity, Policy, Request, Rule

_MARK = "2024-01-20T00:00:00Z"
_MARK_SQL = "TIMESTAMP '2024-01-20 00:00:00'"


@query(
    "silver_cleanse",
    """SELECT o_orderkey, upper(trim(' ' || lower(o_orderpriority) || ' ')) AS priority,
              CAST(o_orderdate AS DATE) AS order_date FROM orders""",
)
def silver_cleanse(spark, d):
    raw = F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" "))
    return table(spark, d, "orders").select(
        "o_orderkey", values.clean_code(raw).alias("priority"), values.as_date("o_orderdate").alias("order_date")
    )


@query("incremental_filter", f"SELECT * FROM events WHERE ts > {_MARK_SQL}")
def incremental_filter(spark, d):
    return slices.incremental(table(spark, d, "events"), "ts", _MARK)


@query("reprocess_full", "SELECT * FROM events")
def reprocess_full(spark, d):
    """A full reprocess reads all history whatever the watermark."""
    return slices.for_run(table(spark, d, "events"), "ts", _MARK, Request("r1", "full"))


@query("reprocess_window", f"SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-05 12:00:00' AND ts <= {_MARK_SQL}")
def reprocess_window(spark, d):
    request = Request("r2", "window", "2024-01-05T12:00:00Z", _MARK)
    return slices.for_run(table(spark, d, "events"), "ts", None, request)


@query(
    "reprocess_keys",
    "SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')",
)
def reprocess_keys(spark, d):
    """Reprocess by keys: line items of the urgent orders."""
    urgent = table(spark, d, "orders").filter("o_orderpriority = '1-URGENT'")
    keys = urgent.select(F.col("o_orderkey").alias("l_orderkey"))
    items = table(spark, d, "lineitem")
    return slices.for_run(items, "l_shipdate", None, Request("r3", "keys"), keys, ["l_orderkey"])


@query(
    "late_arrival_split",
    f"""SELECT event_id, ts, 'on_time' AS arrival FROM events WHERE ts > {_MARK_SQL}
        UNION ALL
        SELECT event_id, ts, 'late' AS arrival FROM events
        WHERE ts <= {_MARK_SQL} AND (event_type = 'error' OR ts IS NULL)""",
)
def late_arrival_split(spark, d):
    """Silver has seen all but the error events up to the watermark; those come late."""
    events = table(spark, d, "events")
    silver = slices.window(events, "ts", None, _MARK).filter("event_type <> 'error'")
    late, on_time = slices.late_and_on_time(events, silver, "ts", _MARK, ["event_id"])
    return on_time.select("event_id", "ts", F.lit("on_time").alias("arrival")).unionByName(
        late.select("event_id", "ts", F.lit("late").alias("arrival"))
    )


@query(
    "restricted_routing",
    """SELECT c_custkey, c_mktsegment, CASE WHEN c_mktsegment = 'BUILDING' THEN 'silver_restricted' ELSE 'silver' END
       AS layer_schema FROM customer""",
)
def restricted_routing(spark, d):
    customer = table(spark, d, "customer").withColumn("restricted", F.col("c_mktsegment") == "BUILDING")
    return slices.route(customer, "restricted").select("c_custkey", "c_mktsegment", "layer_schema")


@query(
    "restricted_scope",
    """SELECT c_custkey, c_mktsegment FROM customer
       WHERE c_mktsegment = 'BUILDING' OR (c_mktsegment = 'MACHINERY' AND c_acctbal < 0)""",
)
def restricted_scope(spark, d):
    """One scope only; the flag is unset for most machinery customers and counts as not restricted."""
    flag = F.when(F.col("c_mktsegment") == "BUILDING", True).when(
        (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") < 0), True
    )
    customer = table(spark, d, "customer").withColumn("restricted", flag)
    wanted = ["BUILDING", "MACHINERY", "FURNITURE"]
    return slices.in_scope(customer, "restricted", True, "c_mktsegment", wanted).select("c_custkey", "c_mktsegment")


@query("dedupe_any", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedupe_any(spark, d):
    """Any survivor per key, so only the keys are comparable."""
    keys = ["l_orderkey", "l_linenumber"]
    return dedupe.any_per_key(table(spark, d, "lineitem"), keys).select(*keys)


_ORDER = """l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
            l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"""
_ITEMS = "SELECT * REPLACE (l_discount + 0.0 AS l_discount) FROM lineitem"


def _latest(source: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY {_ORDER}) AS rn FROM ({source})) WHERE rn = 1"""


@query("dedupe_latest", _latest(_ITEMS))
def dedupe_latest(spark, d):
    return dedupe.latest_per_key(lineitem(spark, d), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "duplicate_key_check",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_key_check(spark, d):
    return dedupe.duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "key_intersection",
    "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)",
)
def key_intersection(spark, d):
    available = table(spark, d, "lineitem").filter("l_quantity >= 45").select(F.col("l_partkey").alias("p_partkey"))
    return dedupe.common_keys(table(spark, d, "part").select("p_partkey", "p_name"), available, "p_partkey")


_PART_CONTRACT = Contract(
    "part",
    (
        Column_("p_partkey", T.LongType(), False, True),
        Column_("p_name", T.StringType(), False),
        Column_("p_type", T.StringType(), True, False, ("ECONOMY", "SMALL", "STANDARD")),
        Column_("p_size", T.LongType()),
        Column_("p_weight", T.DoubleType()),
    ),
)


@query("contract_conform", "SELECT *, CAST(NULL AS DOUBLE) AS p_weight FROM part")
def contract_conform(spark, d):
    return contract.conform(table(spark, d, "part"), _PART_CONTRACT)


@query(
    "contract_prune",
    f"SELECT p_partkey, p_name, p_type, p_size, TIMESTAMP '{AS_OF}' AS _loaded FROM part",
)
def contract_prune(spark, d):
    return contract.prune(table(spark, d, "part").withColumn("_loaded", as_of()), _PART_CONTRACT)


@query(
    "contract_check",
    """WITH t AS (SELECT nullif(p_name, 'small ring') AS p_name, p_type FROM part)
       SELECT 'p_weight' AS column_name, 'missing_column' AS issue, count(*) AS n_rows FROM t
       UNION ALL SELECT 'p_size', 'wrong_type', count(*) FROM t
       UNION ALL SELECT 'p_brand', 'not_in_contract', count(*) FROM t
       UNION ALL SELECT 'p_retailprice', 'not_in_contract', count(*) FROM t
       UNION ALL SELECT 'p_name', 'unexpected_null', count(*) FROM t WHERE p_name IS NULL
       UNION ALL SELECT 'p_type', 'value_not_allowed', count(*) FROM t
                 WHERE p_type NOT IN ('ECONOMY', 'SMALL', 'STANDARD')""",
)
def contract_check(spark, d):
    part = table(spark, d, "part").withColumn("p_name", F.expr("nullif(p_name, 'small ring')"))
    return contract.check(part, _PART_CONTRACT)


@query(
    "contract_columns_from_json",
    """SELECT 'part-' || p_partkey AS entity_key, 2 AS version, position, column_name, column_type
       FROM part, (VALUES (0, 'a_key', 'bigint'), (1, 'a_name', 'string')) AS c(position, column_name, column_type)""",
)
def contract_columns_from_json(spark, d):
    """Two contract versions per part; the newest names two columns, in either document shape."""
    key = F.concat(F.lit("part-"), F.col("p_partkey"))
    listed = '"columns":[{"name":"a_key","type":"bigint","primary_key":true},{"name":"a_name","type":"string"}]'
    top, nested = "{" + listed + "}", '{"schema":{' + listed + "}}"
    newest = F.when(F.col("p_size") > 25, nested).otherwise(top)
    part = table(spark, d, "part")
    old = part.select(key.alias("entity_key"), F.lit(1).alias("version"), F.lit('{"columns":[]}').alias("contract_json"))
    new = part.select(key.alias("entity_key"), F.lit(2).alias("version"), newest.alias("contract_json"))
    return contract.columns_from_json(old.unionByName(new))


@query(
    "json_extract",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_extract(spark, d):
    return table(spark, d, "events").select("event_id", values.json_field("props", "$.k").cast("int").alias("k"))


@query(
    "json_passthrough",
    """SELECT event_id, CASE event_type WHEN 'click' THEN NULL WHEN 'error' THEN '{broken' WHEN 'view' THEN 'plain'
              ELSE replace(props, ' ', '') END AS doc FROM events""",
)
def json_passthrough(spark, d):
    """JSON text is normalised, blank text is NULL, broken and plain text pass as they are."""
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", "  ").when(kind == "error", "{broken").when(kind == "view", "plain")
        .otherwise(F.col("props"))
    )
    return table(spark, d, "events").select("event_id", values.json_or_text(text).alias("doc"))


@query(
    "string_template_expand",
    "SELECT c_custkey, 'lake_' || lower(c_mktsegment) || '_dev/raw/' || c_name AS path FROM customer",
)
def string_template_expand(spark, d):
    template = F.concat(F.lit("{catalog}/raw/"), F.col("c_name"))
    catalog = F.concat(F.lit("lake_"), F.lower("c_mktsegment"), F.lit("_{env}"))
    customer = table(spark, d, "customer").withColumn("t", template)
    return customer.select("c_custkey", values.expand_template("t", {"catalog": catalog, "env": "dev"}).alias("path"))


_ITEM = Entity(
    key="lineitem",
    primary_key=("l_orderkey", "l_linenumber"),
    watermark_column="l_shipdate",
    source_system="erp",
    rules=(
        Rule("quantity_positive", "l_quantity > 0", action="fail"),
        Rule("discount_bounded", "l_discount <= 0.08", action="drop"),
        Rule("bulk_item", "l_quantity <= 45", action="quarantine"),
        Rule("taxed", "l_tax > 0", action="warn"),
    ),
    policies=(Policy("l_returnflag", "hash"), Policy("l_linestatus", "mask"), Policy("l_tax", classification="fiscal")),
)
_OLD_MARK = "1998-01-01T00:00:00Z"


_REFRESHED = f"""WITH items AS ({_ITEMS}),
        cut AS (SELECT TIMESTAMP '1998-01-01 00:00:00' AS mark),
        old_rows AS ({_latest("SELECT * FROM items WHERE l_shipdate <= (SELECT mark FROM cut)")}),
        new_rows AS ({_latest("SELECT * FROM items WHERE l_shipdate > (SELECT mark FROM cut)")}),
        clean_old AS (SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS _silver_processed_ts FROM old_rows
                      WHERE l_discount <= 0.08 AND l_quantity <= 45),
        clean_new AS (SELECT *, TIMESTAMP '{AS_OF}' AS _silver_processed_ts FROM new_rows
                      WHERE l_discount <= 0.08 AND l_quantity <= 45),
        merged AS (SELECT * FROM clean_new UNION ALL
                   SELECT o.* FROM clean_old o ANTI JOIN clean_new n
                   ON o.l_orderkey = n.l_orderkey AND o.l_linenumber = n.l_linenumber)
        SELECT * REPLACE (sha256(l_returnflag) AS l_returnflag,
                          repeat('*', length(l_linestatus)) AS l_linestatus) FROM merged"""


@query("silver_refresh", _REFRESHED)
def silver_refresh_query(spark, d):
    """An incremental refresh merged into the silver table of an earlier run."""
    bronze = lineitem(spark, d)
    first = silver_refresh(
        slices.window(bronze, "l_shipdate", None, _OLD_MARK), _ITEM,
        as_of=F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
    )
    return silver_refresh(bronze, _ITEM, first.silver, _OLD_MARK, as_of=as_of(), stage=True).silver


@query("silver_job", _REFRESHED)
def silver_job(spark, d):
    """The same refresh as two runs of the job, read back from the published table."""
    bronze = lineitem(spark, d)
    base, rejected = scratch_dir(spark, "silver-lineitem"), scratch_dir(spark, "quarantine-lineitem")
    old = slices.window(bronze, "l_shipdate", None, _OLD_MARK)
    run_silver(spark, old, _ITEM, base, rejected, as_of=F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    run_silver(spark, bronze, _ITEM, base, rejected, _OLD_MARK, as_of=as_of())
    return tables.current(spark, base)


@query("silver_job_bucketed", _REFRESHED)
def silver_job_bucketed(spark, d):
    """The same two runs into a table cut into key buckets, of which a run rewrites the touched ones."""
    bronze = lineitem(spark, d)
    entity = replace(_ITEM, buckets=8)
    base, rejected = scratch_dir(spark, "silver-lineitem"), scratch_dir(spark, "quarantine-lineitem")
    old = slices.window(bronze, "l_shipdate", None, _OLD_MARK)
    run_silver(spark, old, entity, base, rejected, as_of=F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    run_silver(spark, bronze, entity, base, rejected, _OLD_MARK, as_of=as_of())
    return read_silver(spark, entity, base)


@query(
    "reprocess_job",
    """SELECT event_id, ts, user_id, event_type, value + CASE WHEN ts > TIMESTAMP '2024-01-05 12:00:00'
              AND ts <= TIMESTAMP '2024-01-20 00:00:00' THEN 1 ELSE 0 END AS value, props FROM events""",
)
def reprocess_job(spark, d):
    """Silver after a first load, a correction of all bronze rows, and an approved request for a window of them."""
    events = table(spark, d, "events")
    entity = Entity("events", ("event_id",), "ts")
    lake = Lake(scratch_dir(spark, "lake"))
    refresh_entity(spark, lake, entity, events, "run-1", as_of=as_of())
    corrected = events.withColumn("value", F.col("value") + 1)
    refresh_entity(spark, lake, entity, corrected, "run-2", as_of=as_of())
    asked = [("r-1", ["events"], "window", datetime(2024, 1, 5, 12), datetime(2024, 1, 20), "approved")]
    columns = "request_id string, requested_entities array<string>, reprocess_mode string, from_watermark timestamp_ntz, to_watermark timestamp_ntz, status string"
    known = spark.createDataFrame([], REQUEST_SCHEMA)
    tables.publish(keyed.append(known, spark.createDataFrame(asked, columns)), lake.requests)
    refresh_entity(spark, lake, entity, corrected, "run-3", as_of=as_of())
    return tables.current(spark, lake.table(entity, "silver")).drop("_silver_processed_ts")


_DAY = "date_trunc('day', ts)"
_ARRIVED = f"""
    first_commit AS (SELECT * REPLACE (CAST({_DAY} AS TIMESTAMP) AS ts), 0 AS c FROM events WHERE ts <= {_MARK_SQL} AND event_id % 5 <> 0),
    later AS (
        SELECT * REPLACE (CAST({_DAY} AS TIMESTAMP) AS ts), CASE WHEN ts > {_MARK_SQL} AND event_id % 3 <> 0 THEN 2 ELSE 1 END AS c
        FROM events WHERE ts > {_MARK_SQL} OR event_id % 5 = 0
        UNION ALL SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS ts, value + 1000 AS value), 1 FROM events WHERE event_id % 7 = 0
        UNION ALL SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS ts, user_id + 100000000 AS user_id), 2 FROM events WHERE event_id % 11 = 0)"""


def _arrivals(spark, d):
    """A lake with a first commit of events by day, refreshed, and then two commits with late rows, ties and rows without a time, refreshed at once."""
    events, day, late = table(spark, d, "events"), F.date_trunc("day", "ts").cast("timestamp_ntz"), F.lit(_MARK[:-1]).cast("timestamp_ntz")
    new, held = F.col("t") > late, F.col("event_id") % 5 == 0
    timed = events.withColumns({"t": F.col("ts"), "ts": day})
    untimed = events.withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    lake, entity = Lake(scratch_dir(spark, "lake")), Entity("users", ("user_id",), "ts")
    base = f"{lake.root}/bronze/users"
    commits.append_commit(timed.filter(~new & ~held).select(events.columns), base)
    refresh_entity(spark, lake, entity, commits.Commits(base), "run-1", as_of=as_of())
    one = timed.filter((~new & held) | (new & (F.col("event_id") % 3 == 0))).select(events.columns)
    strays = untimed.filter("event_id % 7 = 0").withColumn("value", F.col("value") + 1000)
    two = timed.filter(new & (F.col("event_id") % 3 != 0)).select(events.columns)
    strangers = untimed.filter("event_id % 11 = 0").withColumn("user_id", F.col("user_id") + 100_000_000)
    commits.append_commit(one.unionByName(strays), base)
    commits.append_commit(two.unionByName(strangers), base)
    report = refresh_entity(spark, lake, entity, commits.Commits(base), "run-2", as_of=as_of())
    return tables.current(spark, lake.table(entity, "silver")).drop("_silver_processed_ts"), report


@query(
    "silver_job_late",
    f"""WITH {_ARRIVED}, everything AS (SELECT * FROM first_commit UNION ALL SELECT * FROM later)
        SELECT event_id, ts, user_id, event_type, value, props FROM everything
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, c DESC, event_id DESC) = 1""",
)
def silver_job_late(spark, d):
    """The newest row of each user over all commits, of equal times the one that came last, although two runs saw them apart."""
    return _arrivals(spark, d)[0]


@query(
    "silver_job_late_counts",
    f"""WITH {_ARRIVED}, mark AS (SELECT max(ts) AS m FROM first_commit)
        SELECT count(*) AS n_read, count(*) FILTER (ts < m) AS n_late, count(*) FILTER (ts = m) AS n_tied, count(*) FILTER (ts IS NULL) AS n_untimed,
               count(DISTINCT user_id) AS n_clean, count(*) - count(DISTINCT user_id) AS n_duplicates FROM later, mark""",
)
def silver_job_late_counts(spark, d):
    """What the second run says about the rows that a watermark would have passed over."""
    counts = _arrivals(spark, d)[1]["counts"]
    names = ["n_read", "n_late", "n_tied", "n_untimed", "n_clean", "n_duplicates"]
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


@query(
    "refresh_int_watermark",
    """SELECT event_id, ts, user_id, event_type, value + CASE WHEN event_id > (SELECT max(event_id) // 2 FROM events) THEN 1 ELSE 0 END AS value,
              props FROM events""",
)
def refresh_int_watermark(spark, d):
    """An entity whose watermark is a whole number: the second run reads only what lies above the first one's."""
    events = table(spark, d, "events")
    half = events.agg(F.floor(F.max("event_id") / 2)).scalar()
    lake, entity = Lake(scratch_dir(spark, "lake")), Entity("events", ("event_id",), "event_id")
    refresh_entity(spark, lake, entity, events.filter(F.col("event_id") <= half), "run-1", as_of=as_of())
    refresh_entity(spark, lake, entity, events.withColumn("value", F.col("value") + 1), "run-2", as_of=as_of())
    return tables.current(spark, lake.table(entity, "silver")).drop("_silver_processed_ts")


@query(
    "silver_refresh_quarantine",
    f"""SELECT * REPLACE (sha256(l_returnflag) AS l_returnflag, repeat('*', length(l_linestatus)) AS l_linestatus),
               'bulk_item' AS failed_rules, TIMESTAMP '{AS_OF}' AS _silver_processed_ts
        FROM ({_latest(_ITEMS)}) WHERE l_discount <= 0.08 AND l_quantity > 45""",
)
def silver_refresh_quarantine(spark, d):
    refresh = silver_refresh(lineitem(spark, d), _ITEM, as_of=as_of())
    return refresh.quarantine.withColumn("failed_rules", F.array_join("failed_rules", ","))


@query(
    "silver_refresh_state",
    "SELECT max(l_shipdate) AS current_watermark, count(*) AS last_row_count FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-01-01 00:00:00'",
)
def silver_refresh_state(spark, d):
    """The watermark to store after the run is that of the slice."""
    return silver_refresh(lineitem(spark, d), _ITEM, last=_OLD_MARK, as_of=as_of()).watermark
