"""Session helpers: one place for the settings every job relies on.

Library functions never create a session; they take DataFrames.  Jobs,
tests and the bench call :func:`get_spark` (or :func:`configure` on a
session they already own).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings the library depends on for identical answers in batch, stream
# and the SQL oracle (UTC wall clock) and for runtime re-planning at scale.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's runtime settings to an existing session."""
    for key, value in DEFAULT_CONF.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf on a running session: keep the cluster's
            pass
    return spark


def get_spark(master: str | None = None, app: str = "eventlens",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is set only when the caller names one, so the master given to
    ``spark-submit`` stands; so does its driver memory, unless
    ``SPARK_DRIVER_MEMORY`` is set.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if "SPARK_DRIVER_MEMORY" in os.environ:
        builder = builder.config("spark.driver.memory", os.environ["SPARK_DRIVER_MEMORY"])
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared file system path and is used as
    is; without it there is no folder that all executors see, which is an
    error.  Only a ``local`` master (one machine, as in tests) gets a scratch
    folder of its own.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="eventlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current


#: the folder of the running block, below the shared checkpoint folder
_RUN: ContextVar[str] = ContextVar("run", default="")


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir (for streaming checkpoints
    and lineage-cutting table writes), within :func:`scratch_run` of its folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{_RUN.get()}{name}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete ``path`` in whatever store it is in; no folder is no error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch_run(spark: SparkSession, name: str = "run"):
    """A block whose intermediate tables lie in one folder, which is dropped at
    its end, also after an error.  Results are computed lazily from these tables:
    write them, to a folder of their own, before the block ends.  Blocks may be
    nested.  Tables that another thread writes (``foreachBatch``) are not in it."""
    folder = f"{_RUN.get()}{name}-{uuid.uuid4().hex}/"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{folder}"
    token = _RUN.set(folder)
    try:
        yield path
    finally:
        _RUN.reset(token)
        drop_folder(spark, path)
