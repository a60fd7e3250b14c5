"""Session and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: str | None = None


# What a cluster's defaults leave to the job. Stream state is kept on executors' disks and not in
# their heaps, and what changed is checkpointed, not all of it. Recording the Python line of every
# column expression costs more than building the plan.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(
    app_name: str = "clickstar",
    master: str | None = None,
    conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session for these jobs. Partitions and memory stay with the cluster, and with AQE."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only where the setting is unset *and* the session
    itself runs on one machine, as tests do.
    """
    global _LOCAL_ROOT
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="clickstar-")
    return _LOCAL_ROOT


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """`df` written once to a path that all executors share, and read from there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
