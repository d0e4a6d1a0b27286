"""Micro-batches merged into a keyed table: what they cost, and runs that break off."""

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratiform.sources import tables
from stratiform.streaming import ingest, upsert

SCHEMA = "id long, t int, v string"
MODES = [None, "b"]


def put(folder, n, content):
    """The nth file to arrive."""
    Path(f"{folder}/in").mkdir(exist_ok=True)
    path = Path(f"{folder}/in/{n:03d}.parquet")
    path.write_bytes(content)
    os.utime(path, (1_700_000_000 + n,) * 2)


def land(spark, folder, *files):
    """One parquet file for each list of rows, in this order of arrival."""
    for rows in files:
        n = len(list(Path(f"{folder}/in").glob("*.parquet")))
        out = f"{folder}/made-{n}"
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(out)
        put(folder, n, next(Path(out).glob("*.parquet")).read_bytes())


def go(spark, folder, partition=None, columns=("*",)):
    schema = spark.createDataFrame([], SCHEMA).schema
    stream = ingest.file_stream(spark, f"{folder}/in", schema, "parquet", max_files=1).select(*columns)
    if partition:
        stream = stream.withColumn(partition, tables.key_bucket(["id"], 3))
    upsert.upsert_available(stream, f"{folder}/t", f"{folder}/cp", ["id"], ["t"], partition)


def table(spark, folder, partition=None):
    held = tables.read_partitioned(spark, f"{folder}/t") if partition else tables.current(spark, f"{folder}/t")
    return sorted(tuple(r) for r in held.select("id", "t", "v").collect())


def newest(files):
    """Newest row of each key; of equal times the later file's."""
    best = {}
    for rows in files:
        for i, t, v in rows:
            if i not in best or t >= best[i][1]:
                best[i] = (i, t, v)
    return sorted(best.values())


@pytest.mark.parametrize("partition", MODES)
def test_the_table_is_not_rewritten_for_every_micro_batch(spark, folder, monkeypatch, partition):
    """Rows written into the table, over 2 runs of 12 files, stay a few times those that came."""
    written = []

    def published(df, base, version=None, partition_by=()):
        at = publish(df, base, version, partition_by)
        if not base.endswith("_waiting"):
            written.append(spark.read.parquet(tables.version_path(base, at)).count())
        return at

    def merged(spark, path, *args, **kwargs):
        merge(spark, path, *args, **kwargs)
        written.append(tables.read_partitioned(spark, path).count())

    publish, merge = tables.publish, tables.upsert_partitions
    monkeypatch.setattr(tables, "publish", published)
    monkeypatch.setattr(tables, "upsert_partitions", merged)
    draw = random.Random(7)
    text = [f"{draw.getrandbits(256):x}" for _ in range(4800)]
    first = [[(i, 5, text[i]) for i in range(n, 2400, 12)] for n in range(12)]
    second = [[(i, 5 + draw.choice((-1, 0, 1)), text[2400 + i]) for i in range(n, 2400, 12)] for n in range(12)]
    land(spark, folder, *first)
    go(spark, folder, partition)
    assert table(spark, folder, partition) == newest(first)
    land(spark, folder, *second)
    go(spark, folder, partition)
    assert table(spark, folder, partition) == newest(first + second)
    assert sum(written) <= 2 * 4800, written


@pytest.mark.parametrize("partition", MODES)
def test_equal_times_go_to_the_later_batch_merged_together_or_not(spark, folder, monkeypatch, partition):
    files = [[(1, 1, "z"), (2, 3, "a")], [(1, 1, "b"), (2, 2, "z")], [(1, 1, "a"), (3, 1, "n")], [(3, 1, "m"), (3, 0, "x")], [(1, 0, "old")]]
    for outweigh in (0, 10**9):
        monkeypatch.setattr(upsert, "OUTWEIGH", outweigh)
        at = f"{folder}/{outweigh}"
        Path(at).mkdir()
        land(spark, at, *files)
        go(spark, at, partition)
        assert table(spark, at, partition) == newest(files) == [(1, 1, "a"), (2, 3, "a"), (3, 1, "m")]


@pytest.mark.parametrize("partition", MODES)
def test_waiting_batches_of_a_run_that_broke_off_are_merged_once(spark, folder, monkeypatch, partition):
    """The stream has committed them, so it does not bring them again."""
    first, second, third = [[(1, 1, "a"), (2, 1, "a")]], [[(1, 2, "b")], [(1, 2, "c"), (3, 1, "n")], [(2, 0, "old")]], [[(2, 1, "d")]]
    land(spark, folder, *first)
    go(spark, folder, partition)
    land(spark, folder, *second)

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(upsert, "OUTWEIGH", 10**9)
        m.setattr(upsert, "latest_per_key", lost)
        with pytest.raises(RuntimeError, match="lost"):
            go(spark, folder, partition)
    assert table(spark, folder, partition) == newest(first)
    go(spark, folder, partition)
    assert table(spark, folder, partition) == newest(first + second)
    land(spark, folder, *third)
    go(spark, folder, partition)
    assert table(spark, folder, partition) == newest(first + second + third)
    assert tables.versions(spark, f"{folder}/t/_waiting") == []


@pytest.mark.parametrize("partition", MODES)
def test_a_replayed_batch_changes_nothing(spark, folder, partition):
    files = [[(1, 1, "a")], [(1, 2, "b"), (2, 1, "x")], [(1, 2, "c")]]
    land(spark, folder, *files)
    go(spark, folder, partition)
    for f in Path(f"{folder}/cp/commits").glob("*2*"):
        f.unlink()
    go(spark, folder, partition)
    assert table(spark, folder, partition) == newest(files)


@pytest.mark.parametrize("partition", MODES)
def test_batches_before_a_broken_file_are_in_the_table(spark, folder, partition):
    files = [[(1, 1, "a")], [(1, 2, "b")], [(2, 1, "c")]]
    land(spark, folder, *files)
    put(folder, 3, b"PAR1 broken PAR1")
    with pytest.raises(Exception):
        go(spark, folder, partition)
    assert table(spark, folder, partition) == newest(files)


def test_columns_a_later_run_lacks_keep_their_value(spark, folder):
    land(spark, folder, [(1, 1, "a"), (2, 1, "b")])
    go(spark, folder)
    land(spark, folder, [(1, 2, "x")], [(1, 3, "y"), (3, 1, "z")], [(2, 0, "old")])
    go(spark, folder, columns=[F.col("id"), F.col("t")])
    held = tables.current(spark, f"{folder}/t")
    assert sorted(held.select("id", "t", F.coalesce("v", F.lit("-"))).collect()) == [(1, 3, "a"), (2, 1, "b"), (3, 1, "-")]
