"""Bronze: scans, lineage, file ingest, evolution."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform.functions import lineage
from stratiform.operators import contract
from stratiform.plans.catalogue.registry import AS_OF, as_of, land, query, table
from stratiform.session import scratch_dir
from stratiform.sources import commits, landing
from stratiform.spec import Column_, Contract
from stratiform.streaming import ingest

_LINEAGE_SQL = f"""
  TIMESTAMP '{AS_OF}' AS _bronze_ingest_ts, TIMESTAMP '{AS_OF}' AS _source_extract_ts,
  'erp' AS _source_system, 'orders' AS _entity, 'file' AS _ingest_method, 'run-1' AS _run_id"""


@query(
    "bronze_enrich_file",
    f"""SELECT orders.*, {_LINEAGE_SQL}, 'orders.parquet' AS _file_path, true AS _file_modification_time
        FROM orders""",
)
def bronze_enrich_file(spark, d):
    """Lineage of a file scan; the path is shown as the file name and the time as its presence."""
    rows = lineage.from_files(table(spark, d, "orders"), "erp", "orders", run_id="run-1", as_of=as_of())
    return rows.withColumns(
        {
            lineage.FILE_PATH: F.regexp_extract(lineage.FILE_PATH, "[^/]+$", 0),
            lineage.FILE_MODIFIED: F.col(lineage.FILE_MODIFIED).isNotNull(),
        }
    )


@query(
    "bronze_enrich_staged",
    f"""SELECT customer.*, TIMESTAMP '{AS_OF}' AS _bronze_ingest_ts, TIMESTAMP '{AS_OF}' AS _source_extract_ts,
        'crm' AS _source_system, 'customer' AS _entity, 'connector' AS _ingest_method,
        'customer__src' AS _connect_source_table, 'run-1' AS _run_id FROM customer""",
)
def bronze_enrich_staged(spark, d):
    staged = landing.staged(spark, f"{d}/customer.parquet")
    return lineage.from_staged(staged, "crm", "customer", "customer__src", run_id="run-1", as_of=as_of())


@query(
    "bronze_enrich_staged_keeps_extract_ts",
    f"""SELECT event_id, ts AS _source_extract_ts, TIMESTAMP '{AS_OF}' AS _bronze_ingest_ts,
        'app' AS _source_system, 'events' AS _entity, 'connector' AS _ingest_method,
        'events__src' AS _connect_source_table, 'run-1' AS _run_id FROM events""",
)
def bronze_enrich_staged_keeps_extract_ts(spark, d):
    staged = table(spark, d, "events").select("event_id", F.col("ts").alias(lineage.EXTRACT_TS))
    return lineage.from_staged(staged, "app", "events", "events__src", run_id="run-1", as_of=as_of())


def _ingested(spark, d, name, fmt):
    source = table(spark, d, name)
    landed = land(source, name, fmt)
    base = scratch_dir(spark, f"bronze-{name}")
    target, checkpoint = ingest.full_refresh_paths(base, 0)
    ingest.ingest(spark, landed, target, checkpoint, source.schema, "erp", name, fmt, "run-1", as_of())
    return ingest.read_bronze(spark, target)


@query("bronze_file_stream", f"SELECT orders.*, {_LINEAGE_SQL} FROM orders")
def bronze_file_stream(spark, d):
    return _ingested(spark, d, "orders", "json").drop(lineage.FILE_PATH, lineage.FILE_MODIFIED)


@query("bronze_parquet_stream", f"SELECT orders.*, {_LINEAGE_SQL} FROM orders")
def bronze_parquet_stream(spark, d):
    return _ingested(spark, d, "orders", "parquet").drop(lineage.FILE_PATH, lineage.FILE_MODIFIED)


def _contract(df, **changes) -> Contract:
    return Contract("t", tuple(Column_(f.name, changes.get(f.name, f.dataType)) for f in df.schema))


@query("bronze_csv_ingest", "SELECT * FROM orders")
def bronze_csv_ingest(spark, d):
    """CSV with a header and inferred types, then brought to the contract's types."""
    orders = table(spark, d, "orders")
    read = landing.scan(spark, land(orders, "orders", "csv"), "csv")
    return contract.conform(read, _contract(orders), cast=True)


@query("bronze_json_scan", "SELECT * FROM events")
def bronze_json_scan(spark, d):
    """JSON with inferred types, then brought to the contract's types and order."""
    events = table(spark, d, "events")
    read = landing.scan(spark, land(events, "events", "json"), "json")
    return contract.conform(read, _contract(events), cast=True).select(*events.columns)


@query("bronze_file_metadata", "SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows FROM lineitem")
def bronze_file_metadata(spark, d):
    return landing.file_rows(table(spark, d, "lineitem"))


@query("bronze_staged_scan", "SELECT * FROM customer")
def bronze_staged_scan(spark, d):
    return landing.staged(spark, f"{d}/customer.parquet")


@query("missing_source_empty_shell", "SELECT * FROM supplier")
def missing_source_empty_shell(spark, d):
    """A source that has not arrived adds no rows and does not stop the run."""
    present = table(spark, d, "supplier")
    absent = landing.staged(spark, f"{d}/supplier__src_not_there.parquet", present.schema)
    return present.unionByName(absent)


@query(
    "bronze_rescue_stream",
    """SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
              CASE WHEN event_type = 'error' THEN '{"value":"n/a","unplanned":"' || user_id || '"}' END AS _rescued_data
       FROM events""",
)
def bronze_rescue_stream(spark, d):
    """A stream of JSON lines; errors carry an unplanned field and text where a number should be."""
    events = table(spark, d, "events").select("event_id", "user_id", "value", "event_type")
    planned = events.drop("event_type")
    landed = land(events.filter("event_type <> 'error'").drop("event_type"), "events")
    odd = events.filter("event_type = 'error'").drop("event_type").withColumns(
        {"value": F.lit("n/a"), "unplanned": F.col("user_id").cast("string")}
    )
    land(odd, "events", path=landed)
    target, checkpoint = ingest.full_refresh_paths(scratch_dir(spark, "bronze-rescue"), 0)
    ingest.ingest(spark, landed, target, checkpoint, planned.schema, "app", "events", rescue=True)
    return ingest.read_bronze(spark, target).select("event_id", "user_id", "value", "_rescued_data")


@query(
    "bronze_rescued_data",
    """SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL
                             ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
              CASE WHEN event_type = 'error' THEN '{"extra":"x' || user_id || '"}'
                   WHEN event_type = 'click' THEN '{"_corrupt_record":"not json ' || event_id || '"}'
                   WHEN event_type = 'signup' THEN '{"k":"many"}' END AS _rescued_data
       FROM (SELECT * REPLACE (CASE WHEN event_type = 'click' THEN '{}' ELSE props END AS props) FROM events)""",
)
def bronze_rescued_data(spark, d):
    """Unknown fields, misfit values and broken text, put into the props of some event types."""
    kind = F.col("event_type")
    opened = F.expr("substr(props, 1, length(props) - 1)")
    sent = (
        F.when(kind == "error", F.concat(opened, F.lit(', "extra": "x'), F.col("user_id"), F.lit('"}')))
        .when(kind == "click", F.concat(F.lit("not json "), F.col("event_id")))
        .when(kind == "signup", F.lit('{"k": "many"}'))
        .otherwise(F.col("props"))
    )
    events = table(spark, d, "events").select("event_id", sent.alias("sent"))
    declared = T.StructType([T.StructField("k", T.LongType())])
    return landing.with_rescued(events, "sent", declared).drop("sent")


_SPLIT = "2024-01-16 00:00:00"


@query(
    "schema_evolution_add_columns",
    f"""SELECT event_id, ts, user_id, event_type,
               CASE WHEN ts < TIMESTAMP '{_SPLIT}' THEN NULL ELSE value END AS value FROM events""",
)
def schema_evolution_add_columns(spark, d):
    """Two runs on one checkpoint; files of the second bring a new column."""
    events = table(spark, d, "events").drop("props")
    early, late = events.filter(F.col("ts") < F.lit(_SPLIT)), events.filter(F.col("ts") >= F.lit(_SPLIT))
    base = scratch_dir(spark, "bronze-evolving")
    target, checkpoint = ingest.full_refresh_paths(base, 0)
    stored = early.drop("value").schema
    landed = land(early.drop("value"), "events")
    stored, _ = ingest.ingest_evolving(spark, landed, target, checkpoint, stored, "app", "events")
    land(late, "events", path=landed)
    ingest.ingest_evolving(spark, landed, target, checkpoint, stored, "app", "events")
    return ingest.read_bronze(spark, target).select(*events.columns)


_NESTED = "event_id bigint, buyer struct<name: string, age: int>, lines array<struct<qty: int>>, tags map<string, bigint>"


@query(
    "bronze_rescue_nested",
    """SELECT event_id, 'u' || user_id AS name, CASE WHEN event_type <> 'click' THEN CAST(user_id % 90 AS INTEGER) END AS age, 1 AS first_qty,
              CASE WHEN event_type <> 'error' THEN 2 END AS second_qty, user_id AS tag_a, CASE WHEN event_type <> 'view' THEN event_id END AS tag_b,
              CASE event_type WHEN 'click' THEN '{"buyer":{"age":"old"}}' WHEN 'error' THEN '{"lines":{"1":{"qty":"two"}}}'
                              WHEN 'view' THEN '{"tags":{"b":[' || event_id || ',1.5]}}' WHEN 'signup' THEN '{"buyer":{"x":{"y":"z"}},"more":true}' END AS _rescued_data
       FROM events""",
)
def bronze_rescue_nested(spark, d):
    """Misfits and unknown fields inside structs, arrays and maps, each rescued where it was; the rest is typed."""
    kind, user, event = F.col("event_type"), F.col("user_id").cast("string"), F.col("event_id").cast("string")
    sent = F.concat(
        F.lit('{"event_id": '), event, F.lit(', "buyer": {"name": "u'), user, F.lit('", "age": '), F.when(kind == "click", '"old"').otherwise((F.col("user_id") % 90).cast("string")),
        F.when(kind == "signup", ', "x": {"y": "z"}').otherwise(""), F.lit('}, "lines": [{"qty": 1}, {"qty": '), F.when(kind == "error", '"two"').otherwise("2"), F.lit('}], "tags": {"a": '), user,
        F.lit(', "b": '), F.when(kind == "view", F.concat(F.lit("["), event, F.lit(", 1.5]"))).otherwise(event), F.lit("}"), F.when(kind == "signup", ', "more": true').otherwise(""), F.lit("}"),
    )
    read = landing.with_rescued_nested(table(spark, d, "events").select(sent.alias("sent")), "sent", T.StructType.fromDDL(_NESTED))
    return read.select("event_id", "buyer.name", "buyer.age", F.col("lines")[0]["qty"].alias("first_qty"), F.col("lines")[1]["qty"].alias("second_qty"), F.col("tags")["a"].alias("tag_a"), F.col("tags")["b"].alias("tag_b"), "_rescued_data")


@query(
    "schema_evolution_conflict",
    f"""SELECT event_id, CASE WHEN late AND event_type = 'error' THEN NULL ELSE user_id END AS user_id, CASE WHEN late THEN value END AS value,
               CASE WHEN late THEN CASE WHEN event_type = 'click' THEN 'true' ELSE CAST(user_id AS VARCHAR) END END AS flag,
               CASE WHEN late AND event_type = 'error' THEN '{{"user_id":"u' || user_id || '"}}' END AS _rescued_data
        FROM (SELECT *, ts >= TIMESTAMP '{_SPLIT}' AS late FROM events)""",
)
def schema_evolution_conflict(spark, d):
    """Two runs: files of the second bring new fields, one of them of two types, and text where a stored number is."""
    events = table(spark, d, "events")
    early, late = events.filter(F.col("ts") < F.lit(_SPLIT)), events.filter(F.col("ts") >= F.lit(_SPLIT))
    base, landed = scratch_dir(spark, "bronze-evolving"), land(early.select("event_id", "user_id"), "events")
    ingest.ingest_commits(spark, landed, f"{base}/table", f"{base}/checkpoint", "app", "events")
    odd = F.col("event_type") == "error"
    clicks = late.filter("event_type = 'click'").select("event_id", "user_id", "value", F.lit(True).alias("flag"))
    land(clicks, "events", path=landed)
    land(late.filter("event_type = 'error'").select("event_id", F.concat(F.lit("u"), "user_id").alias("user_id"), "value", F.col("user_id").alias("flag")), "events", path=landed)
    land(late.filter(~odd & (F.col("event_type") != "click")).select("event_id", "user_id", "value", F.col("user_id").alias("flag")), "events", path=landed)
    found = ingest.ingest_commits(spark, landed, f"{base}/table", f"{base}/checkpoint", "app", "events")
    if found.conflicts != ["user_id"]:
        raise ValueError(f"conflicts {found.conflicts}")
    return commits.read_after(spark, f"{base}/table").select("event_id", "user_id", "value", "flag", "_rescued_data")


@query(
    "schema_preserve_dropped",
    f"""SELECT event_id, ts, user_id, event_type, value,
               CASE WHEN ts < TIMESTAMP '{_SPLIT}' THEN props END AS props FROM events""",
)
def schema_preserve_dropped(spark, d):
    """A column that vanishes upstream stays and is NULL for later rows."""
    events = table(spark, d, "events")
    stored = events.filter(F.col("ts") < F.lit(_SPLIT))
    incoming = events.filter(F.col("ts") >= F.lit(_SPLIT)).drop("props")
    return contract.preserve_dropped(stored, incoming)
