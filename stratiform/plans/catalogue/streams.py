"""Streams: archive, full refresh, merged micro-batches, bounded dedupe."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratiform.plans.catalogue.registry import land, query, table
from stratiform.session import scratch_dir
from stratiform.sources import tables
from stratiform.streaming import ingest, once
from stratiform.streaming.upsert import upsert_available


@query("bronze_stream_archive", "SELECT count(*) AS n_rows, true AS has_archive FROM customer")
def bronze_stream_archive(spark, d):
    """Files of the first run are archived during the second."""
    customer = table(spark, d, "customer")
    base = scratch_dir(spark, "bronze-archive")
    target, checkpoint = ingest.full_refresh_paths(base, 0)
    archive = f"{base}/archive"
    landed = land(customer.filter("c_acctbal >= 0"), "customer")
    for extra in (customer.filter("c_acctbal < 0"), None):
        ingest.ingest(spark, landed, target, checkpoint, customer.schema, "crm", "customer", archive=archive)
        if extra is not None:
            land(extra, "customer", path=landed)
    archived = spark.read.schema(customer.schema).option("recursiveFileLookup", "true").json(archive)
    has_archive = (archived.agg(F.count("*")).scalar() > 0).alias("has_archive")
    return ingest.read_bronze(spark, target).agg(F.count("*").alias("n_rows")).select("n_rows", has_archive)


@query("stream_full_refresh", "SELECT c_custkey, c_name, 2 AS n_generations FROM customer")
def stream_full_refresh(spark, d):
    """A triggered run without new files adds nothing; a full refresh reads every file anew."""
    customer = table(spark, d, "customer")
    base, landed = scratch_dir(spark, "bronze-refresh"), land(customer, "customer")
    runs = []
    for generation in (0, 0, 1):
        target, checkpoint = ingest.full_refresh_paths(base, generation)
        ingest.ingest(spark, landed, target, checkpoint, customer.schema, "crm", "customer")
        runs.append(target)
    both = ingest.read_bronze(spark, runs[1]).unionByName(ingest.read_bronze(spark, runs[2]))
    return both.groupBy("c_custkey", "c_name").agg(F.count("*").cast("int").alias("n_generations"))


@query(
    "stream_foreach_batch_upsert",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
              CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate
       FROM orders""",
)
def stream_foreach_batch_upsert(spark, d):
    """Orders land, then corrected copies of the pending ones; each run merges into the keyed table."""
    orders = table(spark, d, "orders")
    corrected = orders.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    base = scratch_dir(spark, "silver-stream")
    landed = land(orders, "orders", "parquet")
    for extra in (corrected, None):
        stream = ingest.file_stream(spark, landed, orders.schema, "parquet")
        upsert_available(stream, f"{base}/table", f"{base}/checkpoint", ["o_orderkey"], ["o_orderdate", "o_totalprice"])
        if extra is not None:
            land(extra, "orders", "parquet", landed)
    return tables.current(spark, f"{base}/table")


@query(
    "stream_upsert_out_of_order",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
)
def stream_upsert_out_of_order(spark, d):
    """Orders land first and older copies of them second, file by file: the newer rows stay."""
    orders = table(spark, d, "orders")
    older = orders.withColumn("o_orderdate", F.col("o_orderdate") - F.expr("INTERVAL 1 DAY")).withColumn("o_totalprice", F.lit(0.0))
    base = scratch_dir(spark, "silver-late")
    landed = land(orders, "orders", "parquet")
    for late in (older, None):
        stream = ingest.file_stream(spark, landed, orders.schema, "parquet", max_files=1)
        upsert_available(stream, f"{base}/table", f"{base}/checkpoint", ["o_orderkey"], ["o_orderdate"])
        if late is not None:
            land(late, "orders", "parquet", landed)
    return tables.current(spark, f"{base}/table")


@query("stream_dedupe", "SELECT * FROM events")
def stream_dedupe(spark, d):
    """Events sent twice are stored once."""
    events = table(spark, d, "events")
    landed = land(events.unionByName(events), "events", "parquet")
    base = scratch_dir(spark, "bronze-dedupe")
    stream = ingest.file_stream(spark, landed, events.schema, "parquet")
    once = ingest.dedupe_within(stream, ["event_id"], "ts", "30 days")
    ingest.append_available(once, f"{base}/table", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/table")


_SENT = """
    SELECT event_id, user_id, ts, CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS run FROM events
    UNION ALL SELECT event_id, user_id, ts, 1 FROM events WHERE event_id % 5 = 0
    UNION ALL SELECT event_id, user_id, CAST(NULL AS TIMESTAMP), 1 FROM events WHERE event_id % 51 = 0"""


@query(
    "stream_dedupe_late",
    f"""WITH sent AS ({_SENT}), newest AS (SELECT max(ts) AS m FROM sent WHERE run = 0),
            nth AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY run, ts NULLS LAST, user_id) AS n FROM sent)
       SELECT event_id, user_id, ts, CASE WHEN n > 1 THEN 'repeated' WHEN run = 1 AND (ts IS NULL OR ts < m - INTERVAL 10 DAY) THEN 'late' ELSE 'stored' END AS fate
       FROM nth, newest""",
)
def stream_dedupe_late(spark, d):
    """Two runs of a stream: repeats within and across them, and unique rows that come long after their time. No row goes missing."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    second = (F.col("event_id") % 3 == 0) | (F.col("event_id") % 17 == 0)
    base = scratch_dir(spark, "once")
    out = once.Once(f"{base}/tables")
    again = events.filter("event_id % 5 = 0").unionByName(events.filter("event_id % 51 = 0").withColumn("ts", F.lit(None).cast("timestamp_ntz")))
    landed = land(events.filter(~second), "once", "parquet")
    for more in (None, events.filter(second).unionByName(again)):
        if more is not None:
            land(more, "once", "parquet", landed)
        once.once_available(ingest.file_stream(spark, landed, events.schema, "parquet"), out, f"{base}/checkpoint", ["event_id"], "ts", "10 DAYS")
    parts = [out.read(spark, fate).withColumn("fate", F.lit(fate)) for fate in once.FATES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])

