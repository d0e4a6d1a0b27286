"""Session settings the operators count on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# All of these can be changed at run time, so they work on a session someone else built.
# The skew settings let AQE split a hot join partition even when that costs a shuffle later,
# and streaming state lives in RocksDB, off the executors' heap.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build(master: str = "local[*]", app: str = "stratiform", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; jobs on a cluster bring their own."""
    builder = SparkSession.builder.master(master).appName(app).config("spark.ui.enabled", "false")
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session built elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# Stored bytes behind one shuffle partition; AQE joins partitions that turn out small.
BYTES_PER_SHUFFLE_PARTITION = 512 * 1024 * 1024


# Catalyst gives inputs of unknown size the largest number it has.
_UNKNOWN_SIZE = 1 << 60


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files under a path."""
    fs, root = file_system(spark, path)
    return int(fs.getContentSummary(root).getLength())


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the files a DataFrame scans, as far as Catalyst knows them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(s for s in sizes if s < _UNKNOWN_SIZE)


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise ``spark.sql.shuffle.partitions`` so that partitions of a large input fit in memory.

    The setting is never lowered: AQE coalesces small partitions but does not split the
    partitions of an ordinary aggregation.
    """
    wanted = -(-input_bytes // BYTES_PER_SHUFFLE_PARTITION)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


@lru_cache(maxsize=None)
def _local_scratch(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="stratiform-")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may do without it; on a cluster a machine-local folder would
    be lost with its executor, so a missing setting is an error there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_scratch(spark.sparkContext.applicationId)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table nobody reads any more."""
    if not path.startswith(scratch_root(spark) + "/"):
        raise ValueError(f"not a scratch path: {path}")
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back.

    Cuts the lineage with a table that outlives any executor, keeps several consumers from
    recomputing it, and gives Catalyst the true size, so that it broadcasts the result only
    when it really is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
