"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on. AQE re-plans joins at run time: it turns a
# side into a broadcast only after measuring it, and splits skewed partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # no Python call-site capture per column function (error context only);
    # it costs several driver round trips for every expression built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "tallyspark",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Bytes that Spark sends a Python worker at a time. Its default is 64 MB, and a
# batch lies in the JVM twice and in the worker once for every running task.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def bound_batches(spark: SparkSession) -> bool:
    """Small Arrow batches from here on in this session, for queries that send
    whole texts to Python; a bound that is already set stays. Says whether
    it was set here."""
    new = BATCH_BYTES[0] not in spark.conf.getAll
    if new:
        spark.conf.set(*BATCH_BYTES)
    return new


@contextlib.contextmanager
def many_small_files(spark: SparkSession):
    """Settings for reading folders of many small files: Spark would list every
    folder by a task of its own (up to 10,000), and count a file as 4 MB more
    than it has, so that tasks with larger files got most of the text."""
    wanted = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(max(32, 4 * spark.sparkContext.defaultParallelism)),
              "spark.sql.files.openCostInBytes": str(8 << 10)}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this must be set by the deployment; it is read, never
    replaced. Only a local session without one (tests, the bench) gets a fresh
    folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    path = tempfile.mkdtemp(prefix="tallyspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")


def stage(df: DataFrame, name: str = "stage", by: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts the lineage (later stages read the files, not the plan that made
    them), survives the loss of any executor, and is columnar, so later
    passes prune columns. Used where a derived frame is read more than once.
    With ``by`` the rows lie in one folder for each value of that column, and
    a filter on it reads no other. ``unstage`` deletes the table once nothing
    reads it any more.
    """
    return stage_all([df], name, by)


def stage_all(frames: Iterable[DataFrame], name: str = "stage", by: str | None = None) -> DataFrame:
    """``stage`` of frames of one schema, written one after the other into one
    table. An iterator makes each only when the one before it is written."""
    path = None
    for df in frames:
        spark = df.sparkSession
        path = path or f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        df.write.mode("append").parquet(path, partitionBy=by)
        schema = df.schema
    out = spark.read.schema(schema).parquet(path)
    out._stage_path = path
    return out


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def unstage(*frames: DataFrame) -> None:
    """Delete the tables behind staged frames that no later job reads."""
    for df in frames:
        path = getattr(df, "_stage_path", None)
        if path:
            delete_path(df.sparkSession, path)
            df._stage_path = None
