"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime-settable options the jobs rely on; cluster sizing stays with spark-submit.
SQL_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sessions of a busy key combine before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Lets a join on (customer, slice, device) use rows partitioned by (customer, slice).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Keyed state of the stream processors.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Counting the keys held costs a read before every write and removal of one.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

_SPARK_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "false",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "false",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "true",
}


def get_session(app_name: str = "riskframe", **options: str) -> SparkSession:
    """The active session or a new one; master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SQL_OPTIONS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the options to a session that somebody else has made; settings made there stay."""
    given = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, value in SQL_OPTIONS.items():
        # Whatever differs from Spark's own default was set by somebody.
        if key not in given and spark.conf.get(key, None) in (None, _SPARK_DEFAULTS.get(key)):
            spark.conf.set(key, value)
    return spark


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="riskframe-")
    return _LOCAL_FOLDERS[context.applicationId]


_SCRATCH: ContextVar[str] = ContextVar("scratch", default="")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for staged tables and stream checkpoints."""
    return f"{_SCRATCH.get() or shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """One folder for all work paths asked for inside; the caller removes it when nothing reads them any more."""
    folder = work_path(spark, label)
    token = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of work paths, through the file system it lies in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts lineage and survives executor loss."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
