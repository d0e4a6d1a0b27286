"""Landed files, evolution, streams."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratiform import session
from stratiform.sources import landing
from stratiform.sources.evolve import widen
from stratiform.sources import tables
from stratiform.streaming import ingest
from stratiform.streaming.upsert import upsert_available

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])


def drop_file(folder, name, *rows):
    Path(folder).mkdir(parents=True, exist_ok=True)
    text = [r if isinstance(r, str) else json.dumps(r) for r in rows]
    (Path(folder) / name).write_text("\n".join(text) + "\n")


def run(spark, folder, schema=SCHEMA, **kwargs):
    ingest.ingest(spark, f"{folder}/in", f"{folder}/bronze", f"{folder}/cp", schema, "s", "e", **kwargs)
    return ingest.read_bronze(spark, f"{folder}/bronze")


def test_each_file_is_read_once(spark, folder, rows_of):
    drop_file(f"{folder}/in", "1.json", {"id": 1, "v": "a"})
    assert run(spark, folder).count() == 1
    assert run(spark, folder).count() == 1
    drop_file(f"{folder}/in", "2.json", {"id": 2, "v": "b"}, {"id": 3})
    df = run(spark, folder, run_id="r2")
    assert rows_of(df, "id", "v", "_run_id") == [(1, "a", "unknown"), (2, "b", "r2"), (3, None, "r2")]
    assert {Path(r[0]).name for r in df.select("_file_path").collect()} == {"1.json", "2.json"}
    assert df.filter("_file_modification_time IS NULL OR _bronze_ingest_ts IS NULL").count() == 0


def test_capped_batches_read_everything(spark, folder):
    for i in range(4):
        drop_file(f"{folder}/in", f"{i}.json", {"id": i})
    assert run(spark, folder, max_files=1).count() == 4
    for i in range(4, 7):
        drop_file(f"{folder}/in", f"{i}.json", {"id": i})
    assert run(spark, folder, max_bytes=10).count() == 7
    with pytest.raises(ValueError, match="not both"):
        run(spark, folder, max_files=1, max_bytes=10)


def test_malformed_line_becomes_nulls_and_does_not_stop_the_stream(spark, folder, rows_of):
    drop_file(f"{folder}/in", "1.json", {"id": 1, "v": "a"}, "{broken", {"id": "x", "v": "b"})
    assert rows_of(run(spark, folder), "id", "v") == [(1, "a"), (None, "b"), (None, None)]


def test_schema_widens_on_the_same_checkpoint(spark, folder, rows_of):
    args = (spark, f"{folder}/in", f"{folder}/bronze", f"{folder}/cp")
    drop_file(f"{folder}/in", "1.json", {"id": 1, "v": "a"})
    schema, conflicts = ingest.ingest_evolving(*args, SCHEMA, "s", "e")
    assert schema == SCHEMA and conflicts == []
    drop_file(f"{folder}/in", "2.json", {"id": 2, "extra": 1.5}, {"id": "text", "v": "c"})
    schema, conflicts = ingest.ingest_evolving(*args, schema, "s", "e")
    assert schema.names == ["id", "v", "extra"] and conflicts == ["id"]
    df = ingest.read_bronze(spark, f"{folder}/bronze")
    assert rows_of(df, "id", "v", "extra") == [(1, "a", None), (2, None, 1.5), (None, "c", None)]


def test_widen_keeps_stored_types():
    def schema(**cols):
        return T.StructType([T.StructField(n, t) for n, t in cols.items()])

    stored = schema(a=T.LongType(), b=T.DateType(), c=T.StringType())
    incoming = schema(A=T.IntegerType(), b=T.StringType(), c=T.LongType(), d=T.DoubleType())
    merged, conflicts = widen(stored, incoming)
    assert merged == schema(a=T.LongType(), b=T.DateType(), c=T.StringType(), d=T.DoubleType()) and conflicts == []
    assert widen(stored, schema(a=T.DoubleType()))[1] == ["a"]


def test_archive_moves_files_of_earlier_runs(spark, folder):
    for i in range(3):
        drop_file(f"{folder}/in", f"{i}.json", {"id": i})
        run(spark, folder, archive=f"{folder}/archive")
    moved = {p.name for p in Path(f"{folder}/archive").rglob("*.json")}
    assert moved and moved < {"0.json", "1.json", "2.json"}
    assert ingest.read_bronze(spark, f"{folder}/bronze").count() == 3


def test_csv_with_header_and_comments(spark, folder, rows_of):
    drop_file(folder, "d.csv", "id,name,since", "1,ann,2024-01-02", "2,bob,", "# note")
    df = landing.scan(spark, folder, "csv", extra={"comment": "#"})
    assert dict(df.dtypes) == {"id": "int", "name": "string", "since": "date"}
    assert rows_of(df, "id", "name") == [(1, "ann"), (2, "bob")]


def test_rescued_data(spark):
    texts = ['{"k":1}', '{"k":"many"}', '{"k":2,"x":{"y":[1]}}', "oops", None, "{}", '{"k":null}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    out = landing.with_rescued(df, "j", T.StructType([T.StructField("k", T.LongType())]))
    got = [(r["k"], r["_rescued_data"]) for r in out.orderBy("i").collect()]
    assert got == [
        (1, None), (None, '{"k":"many"}'), (2, '{"x":"{\\"y\\":[1]}"}'), (None, '{"_corrupt_record":"oops"}'),
        (None, None), (None, None), (None, None),
    ]


def test_missing_source_is_a_typed_empty_table(spark, folder):
    empty = landing.staged(spark, f"{folder}/nothing", SCHEMA)
    assert empty.schema == SCHEMA and empty.count() == 0
    empty.write.parquet(f"{folder}/shell")
    assert landing.staged(spark, "no_such_table", SCHEMA).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landing.staged(spark, f"{folder}/nothing")


def test_full_refresh_reads_all_files_again(spark, folder):
    drop_file(f"{folder}/in", "1.json", {"id": 1})
    for generation in (0, 0, 1):
        target, checkpoint = ingest.full_refresh_paths(folder, generation)
        ingest.ingest(spark, f"{folder}/in", target, checkpoint, SCHEMA, "s", "e")
    assert [ingest.read_bronze(spark, ingest.full_refresh_paths(folder, g)[0]).count() for g in (0, 1)] == [1, 1]


def test_micro_batches_merge_into_the_keyed_table(spark, folder, rows_of):
    def go():
        stream = ingest.file_stream(spark, f"{folder}/in", SCHEMA, max_files=1)
        upsert_available(stream, f"{folder}/t", f"{folder}/cp", ["id"], ["v"])
        return tables.current(spark, f"{folder}/t")

    drop_file(f"{folder}/in", "1.json", {"id": 1, "v": "a"}, {"id": 1, "v": "b"}, {"id": 2, "v": "x"}, {"v": "nokey"})
    assert rows_of(go()) == [(1, "b"), (2, "x")]
    drop_file(f"{folder}/in", "2.json", {"id": 2, "v": "y"}, {"id": 3, "v": "z"})
    assert rows_of(go()) == [(1, "b"), (2, "y"), (3, "z")]
    assert rows_of(go()) == [(1, "b"), (2, "y"), (3, "z")]


def test_stream_dedupe_keeps_one_row_per_key(spark, folder):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.TimestampNTZType())])
    drop_file(f"{folder}/in", "1.json", {"id": 1, "t": "2024-01-01T00:00:00"}, {"id": 1, "t": "2024-01-01T00:05:00"}, {"id": 2, "t": "2024-01-01T00:00:01"})
    stream = ingest.dedupe_within(ingest.file_stream(spark, f"{folder}/in", schema), ["id"], "t", "1 hour")
    ingest.append_available(stream, f"{folder}/t", f"{folder}/cp")
    df = spark.read.parquet(f"{folder}/t")
    assert df.count() == 2 and dict(df.dtypes)["t"] == "timestamp_ntz"
    assert df.filter("id = 2").first()["t"] == datetime(2024, 1, 1, 0, 0, 1)


class FakeSession:
    """Just the settings ``scratch_root`` looks at."""

    def __init__(self, master, shared=None):
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_scratch_follows_the_session_setting():
    assert session.scratch_root(FakeSession("yarn", "hdfs://shared/scratch/")) == "hdfs://shared/scratch"
    assert session.scratch_dir(FakeSession("local[2]", "/shared"), "x").startswith("/shared/x-")


def test_scratch_on_a_cluster_needs_the_setting():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(FakeSession("yarn"))


def test_materialize_keeps_schema_and_rows(spark, rows_of):
    df = spark.range(3).withColumn("v", F.col("id") + 1)
    again = session.materialize(df, "m")
    assert rows_of(again) == [(0, 1), (1, 2), (2, 3)] and again.dtypes == df.dtypes


def test_rescue_stream_keeps_what_does_not_fit(spark, folder, rows_of):
    drop_file(f"{folder}/in", "1.json", {"id": 1, "v": "a"}, {"id": "x", "v": "b", "w": 1}, "{broken", "")
    df = run(spark, folder, rescue=True)
    assert rows_of(df, "id", "v", "_rescued_data") == [
        (1, "a", None), (None, "b", '{"id":"x","w":"1"}'), (None, None, '{"_corrupt_record":"{broken"}')
    ]
    assert "_file_path" in df.columns and "value" not in df.columns


def test_bronze_can_be_partitioned(spark, folder):
    drop_file(f"{folder}/in", "1.json", {"id": 1, "v": "a"}, {"id": 2, "v": "b"})
    assert run(spark, folder, partition_by=("v",)).count() == 2
    assert {p.name for p in Path(f"{folder}/bronze").glob("v=*")} == {"v=a", "v=b"}


def test_shuffles_grow_with_the_input_and_never_shrink(spark, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, 10) == int(before)
        assert session.size_shuffles(spark, 100 * session.BYTES_PER_SHUFFLE_PARTITION + 1) == 101
        assert session.size_shuffles(spark, 10) == 101
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    (Path(folder) / "f").write_text("12345")
    assert session.stored_bytes(spark, folder) == 5


def test_only_scratch_is_discarded(spark, folder):
    path = session.scratch_dir(spark, "gone")
    spark.range(1).write.parquet(path)
    session.discard(spark, path)
    assert not Path(path).exists()
    with pytest.raises(ValueError, match="not a scratch path"):
        session.discard(spark, folder)


def test_rebalanced_output_is_one_small_file(spark, folder):
    tables.rebalanced(spark.range(100).repartition(4)).write.parquet(f"{folder}/r")
    assert len(list(Path(f"{folder}/r").glob("*.parquet"))) == 1


def test_micro_batches_merge_into_a_partitioned_table(spark, folder, rows_of):
    def go():
        stream = ingest.file_stream(spark, f"{folder}/in", SCHEMA, max_files=1)
        cut = stream.withColumn("b", tables.key_bucket(["id"], 3))
        upsert_available(cut, f"{folder}/t", f"{folder}/cp", ["id"], ["v"], partition="b")
        return tables.read_partitioned(spark, f"{folder}/t").select("id", "v")

    drop_file(f"{folder}/in", "1.json", {"id": 1, "v": "a"}, {"id": 2, "v": "x"})
    drop_file(f"{folder}/in", "2.json", {"id": 3, "v": "c"})
    assert rows_of(go()) == [(1, "a"), (2, "x"), (3, "c")]
    drop_file(f"{folder}/in", "3.json", {"id": 2, "v": "y"})
    assert rows_of(go()) == [(1, "a"), (2, "y"), (3, "c")]


def test_scanned_bytes_are_those_of_the_files(spark, folder):
    spark.range(1000).write.parquet(f"{folder}/a")
    read = spark.read.parquet(f"{folder}/a")
    size = session.scanned_bytes(read.filter("id > 5"))
    assert 0 < size <= session.stored_bytes(spark, f"{folder}/a")
    assert session.scanned_bytes(read.join(read, "id")) == 2 * session.scanned_bytes(read)
    assert session.scanned_bytes(spark.createDataFrame([(1,)], "id int")) < 1000
