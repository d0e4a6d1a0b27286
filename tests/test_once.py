"""Streamed rows once per key: stored, late or repeated, and nothing else."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from stratiform.sources import commits
from stratiform.streaming import ingest
from stratiform.streaming.once import FATES, Once, once_available

T0 = datetime(2024, 1, 1)
SCHEMA = "k int, g string, t timestamp_ntz, v int"


def send(spark, folder, rows):
    listed = [(k, g, None if h is None else T0 + timedelta(hours=h), v) for k, g, h, v in rows]
    spark.createDataFrame(listed, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def run(spark, folder, **caps):
    stream = ingest.file_stream(spark, f"{folder}/in", SCHEMA, "parquet", **caps)
    once_available(stream, Once(f"{folder}/out"), f"{folder}/cp", ["k", "g"], "t", "2 HOURS", buckets=4)


def found(spark, folder):
    tables = {fate: Once(f"{folder}/out").read(spark, fate) for fate in FATES}
    return {fate: sorted(((r["k"], r["g"], r["v"]) for r in df.collect()), key=repr) if df is not None else [] for fate, df in tables.items()}


def fates(batches):
    """The same by hand."""
    out, seen, newest = {fate: [] for fate in FATES}, set(), None
    for rows in batches:
        bound = None if newest is None else newest - 2
        for k, g, h, v in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[3])):
            late = bound is not None and (h is None or h < bound)
            fate = "repeated" if (k, g) in seen else "late" if late else "stored"
            seen.add((k, g))
            out[fate].append((k, g, v))
        newest = max([r[2] for r in rows if r[2] is not None] + ([newest] if newest is not None else []), default=None)
    return {fate: sorted(rows, key=repr) for fate, rows in out.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_every_row_has_one_fate(spark, folder, seed):
    rng, batches = random.Random(seed), []
    for n in range(3):
        batches.append([(rng.choice([*range(12), None]), rng.choice(["a", None]), rng.choice([None, *range(n * 3, n * 3 + 5), 0]), 100 * n + i) for i in range(25)])
        send(spark, folder, batches[-1])
        run(spark, folder)
    got = found(spark, folder)
    assert got == fates(batches)
    assert Counter(r for rows in got.values() for r in rows) == Counter((k, g, v) for rows in batches for k, g, _, v in rows)


def test_no_state_is_lost_between_runs_or_held_in_memory(spark, folder):
    send(spark, folder, [(1, "a", 100, 1)])
    run(spark, folder)
    send(spark, folder, [(1, "a", 100, 2), (2, "a", 1, 3), (3, "a", 99, 4)])
    run(spark, folder)
    send(spark, folder, [(2, "a", 500, 5), (4, "a", 97, 6), (5, "a", 98, 7)])
    run(spark, folder)
    assert found(spark, folder) == {"stored": [(1, "a", 1), (3, "a", 4), (5, "a", 7)], "late": [(2, "a", 3), (4, "a", 6)], "repeated": [(1, "a", 2), (2, "a", 5)]}
    assert run(spark, folder) is None and len(commits.positions(spark, f"{folder}/out/stored")) == 3


def test_a_replayed_batch_leaves_what_it_left_before(spark, folder, monkeypatch):
    """The driver is lost before the last commit of a batch; the batch runs again."""
    real, calls = commits.append_commit, []

    def breaks(df, base, *args, **kwargs):
        calls.append(base)
        if len(calls) == 9:  # the times of the second batch
            raise RuntimeError("lost")
        return real(df, base, *args, **kwargs)

    send(spark, folder, [(1, "a", 5, 1), (1, "a", 6, 2)])
    run(spark, folder)
    send(spark, folder, [(1, "a", 5, 3), (2, "a", 0, 4), (3, "a", 9, 5)])
    monkeypatch.setattr(commits, "append_commit", breaks)
    calls[:] = [None] * 5
    with pytest.raises(Exception, match="lost"):
        run(spark, folder)
    monkeypatch.setattr(commits, "append_commit", real)
    run(spark, folder)
    assert found(spark, folder) == {"stored": [(1, "a", 1), (3, "a", 5)], "late": [(2, "a", 4)], "repeated": [(1, "a", 2), (1, "a", 3)]}
