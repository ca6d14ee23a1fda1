"""Tables that are merged while others write to them.

``compact_parts`` merges the mergeable parts of closed micro-batches into one
generation (A02/K14); ``upsert``, ``latest`` and ``compact_versions`` keep a
last-write-wins table (A04/W02)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators.common import latest_per_key
from eventlens.sinks.writers import _drop, _hadoop, _staged, overwrite_partitions


def _folders(spark: SparkSession, path: str, name: str) -> list[str]:
    """The values of the ``name=value`` folders directly below ``path``."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return [n.partition("=")[2] for n in names if n.startswith(f"{name}=")]


def _generations(spark: SparkSession, merged: str) -> list[int]:
    """The complete generations: Spark writes ``_SUCCESS`` last."""
    out = []
    for v in _folders(spark, merged, "up_to"):
        fs, p = _hadoop(spark, f"{merged}/up_to={v}/_SUCCESS")
        if fs.exists(p):
            out.append(int(v))
    return sorted(out)


def read_parts(spark: SparkSession, parts: str, merged: str) -> DataFrame:
    """The newest complete generation and the parts of later micro-batches."""
    done = _generations(spark, merged)
    if not done:
        return spark.read.parquet(parts).drop("batch_id")
    old = spark.read.parquet(f"{merged}/up_to={done[-1]}")
    later = [v for v in _folders(spark, parts, "batch_id") if int(v) > done[-1]]
    if not later:
        return old
    return old.unionByName(spark.read.parquet(*[f"{parts}/batch_id={v}" for v in later]).select(*old.columns))


def compact_parts(spark: SparkSession, parts: str, merged: str, merge) -> int | None:
    """K14 under a live stream: ``merge`` (parts -> parts) the last generation
    and the parts of all closed micro-batches into a generation named by the last
    of them; returns its batch, None if there is none.  A batch is closed when a
    later one is there, so one that is replayed after a failure is left alone.  A
    reader sees the old generation and its later parts until ``_SUCCESS`` of the
    new one is there.  What an older generation held is dropped one compaction
    later, so readers that have begun end well.  A second run, or one after a
    crash, gives the same table."""
    batches = sorted(int(v) for v in _folders(spark, parts, "batch_id"))
    done = _generations(spark, merged)
    closed = [b for b in batches[:-1] if not done or b > done[-1]]
    if not closed:
        return done[-1] if done else None
    rows = spark.read.parquet(*[f"{parts}/batch_id={b}" for b in closed])
    if done:
        old = spark.read.parquet(f"{merged}/up_to={done[-1]}")
        rows = old.unionByName(rows.select(*old.columns))
    merge(rows).write.mode("overwrite").parquet(f"{merged}/up_to={closed[-1]}")
    for b in batches:
        if done and b <= done[-1]:
            _drop(spark, f"{parts}/batch_id={b}")
    for g in done[:-1]:
        _drop(spark, f"{merged}/up_to={g}")
    return closed[-1]


def upsert(batch: DataFrame, path: str, keys, version_col: str, load_id: str, buckets: int = 64) -> None:
    """One load of a last-write-wins table: the newest row of each key goes to
    ``bucket=/load_id=`` folders.  Loads may come in any order and again: a load
    replaces itself.  Rows of one key and version must be equal, or the greatest
    by all other columns wins."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    new = latest_per_key(batch, keys, version_col, _ties(batch, keys, version_col))
    new = new.withColumns({"bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"), "load_id": F.lit(str(load_id))})
    overwrite_partitions(new.repartition("bucket"), path, ["bucket", "load_id"])


def _ties(df: DataFrame, keys, version_col: str):
    return [c for c in df.columns if c not in (*keys, version_col, "bucket", "load_id")]


def latest(spark: SparkSession, path: str, keys, version_col: str) -> DataFrame:
    """The newest row of each key over all loads."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = spark.read.parquet(path).drop("bucket", "load_id")
    return latest_per_key(rows, keys, version_col, _ties(rows, keys, version_col))


def compact_versions(spark: SparkSession, path: str, keys, version_col: str) -> list[int]:
    """Rewrite the buckets with more than one load to the newest row of each key,
    and return them; the others stay as they are.  The new folder is written
    before the old ones go: a reader that sees both still gets the newest rows,
    and so does a run that starts anew after a crash."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    loads = {int(b): _folders(spark, f"{path}/bucket={b}", "load_id") for b in _folders(spark, path, "bucket")}
    touched = sorted(b for b, old in loads.items() if len(old) > 1)
    if not touched:
        return []
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/bucket={b}" for b in touched]).drop("load_id")
    new = latest_per_key(rows, ["bucket", *keys], version_col, _ties(rows, keys, version_col))
    rows, stage = _staged(new.withColumn("load_id", F.lit(f"compact-{uuid.uuid4().hex}")), "versions")
    overwrite_partitions(rows.repartition("bucket"), path, ["bucket", "load_id"])
    _drop(spark, stage)
    for b in touched:
        for v in loads[b]:
            _drop(spark, f"{path}/bucket={b}/load_id={v}")
    return touched
