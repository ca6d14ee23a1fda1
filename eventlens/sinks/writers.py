"""Sinks and table maintenance.

File tables are Parquet with Hive-style partition folders, so writers of
different sources never touch the same files, filters on partition columns
prune folders, and a micro-batch can be rewritten idempotently by
overwriting only its own partition (dynamic partition overwrite).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.session import checkpoint_path, drop_folder as _drop


def _hadoop(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as Hadoop objects."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder with data files or partitions.  Only the
    listing decides: a table that cannot be read raises where it is read."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))


def _staged(df: DataFrame, name: str):
    """``df`` written to a folder of its own below the shared checkpoint
    folder, and that folder's path; the caller drops it after use."""
    spark = df.sparkSession
    path = checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: cuts
    the lineage, and later reads do not compute it again."""
    return _staged(df, name)[0]


def append_stream(df: DataFrame, path: str, checkpoint: str, partition_by=(), fmt: str = "parquet"):
    """A streaming append to a file table, to be started by the caller;
    exactly-once through the file sink's commit log plus the checkpoint."""
    w = df.writeStream.outputMode("append").format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return w.partitionBy(*partition_by) if partition_by else w


def topic_sink(df: DataFrame, topic: str, checkpoint: str, bootstrap: str | None = None, path: str | None = None):
    """A streaming write of (key, value) rows to a topic, to be started by
    the caller: the Kafka sink with ``bootstrap``, else JSON files in the
    topic's folder below ``path``."""
    if bootstrap:
        return (df.writeStream.outputMode("append").format("kafka").option("kafka.bootstrap.servers", bootstrap)
                .option("topic", topic).option("checkpointLocation", checkpoint))
    return append_stream(df, f"{path.rstrip('/')}/{topic}", checkpoint, fmt="json")


def write_jdbc(df: DataFrame, url: str, table: str, connections: int = 8, batch_rows: int = 10_000, **options) -> None:
    """Append rows to a warehouse table over at most ``connections``
    connections, ``batch_rows`` a round trip."""
    (df.coalesce(connections).write.format("jdbc").option("url", url).option("dbtable", table)
     .option("batchsize", batch_rows).options(**options).mode("append").save())


def replace_table(df: DataFrame, target: str, partition_by=()) -> None:
    """Full replace of a catalog table, or of a path (with a slash)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target) if "/" in target else w.saveAsTable(target)


def append(df: DataFrame, path: str, partition_by=()) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by) -> None:
    """Replace exactly the partitions present in ``df`` (idempotent re-runs,
    K10/K14).  The mode is an option of this write, not of the session."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def merge_insert_only_table(spark: SparkSession, source: DataFrame, path: str, on: str = "trade_id",
                            partition_by=("source",)) -> int:
    """K02 + K03 on a file table: append the rows the insert-only merge adds
    (all of them when the table is absent; re-running adds nothing).  Nothing
    is ever overwritten.  Returns the number of rows appended."""
    from eventlens.operators.prices import merge_insert_only
    target = spark.read.parquet(path) if table_exists(spark, path) else spark.createDataFrame([], source.schema)
    # the result is staged before it is appended to the table being read
    staged, stage = _staged(merge_insert_only(target, source, on=on), "stage")
    n = staged.count()
    if n:
        append(staged.select(*target.columns), path, partition_by)
    _drop(spark, stage)
    return n


def insert_ignore_table(spark: SparkSession, batch: DataFrame, path: str, key, order_col: str) -> int:
    """K07 on a file table: create or append the rows ``ON CONFLICT DO
    NOTHING`` would insert."""
    from eventlens.operators.incidents import insert_ignore
    there = table_exists(spark, path)
    target = spark.read.parquet(path) if there else spark.createDataFrame([], batch.schema)
    staged, stage = _staged(insert_ignore(target, batch, key, order_col), "stage")
    n = staged.count()
    if n or not there:
        append(staged, path)
    _drop(spark, stage)
    return n


def write_csv(df: DataFrame, uri: str) -> None:
    """CSV with header (object store or local URI)."""
    df.write.mode("overwrite").option("header", True).csv(uri)


def write_daily(df: DataFrame, path: str, ts_col: str, load_id, monthly: bool = False) -> None:
    """Date-suffixed indices as ``dt=2024-10-15`` (or ``month=2024-10``)
    folders, each with one ``load_id`` folder per load: another load of a day
    adds to it, the same load written again replaces itself."""
    part = "month" if monthly else "dt"
    val = F.date_format(ts_col, "yyyy-MM") if monthly else F.to_date(ts_col)
    overwrite_partitions(df.withColumn(part, val).withColumn("load_id", F.lit(str(load_id))), path, [part, "load_id"])


def route(batch: DataFrame, batch_id: int, base: str, high_col: str = "severity") -> None:
    """One micro-batch to the store and the topic folders, HIGH rows
    also to the alerts folder.  The batch is persisted once for the three
    writes, and each write overwrites its own ``batch_id`` partition, so a
    replayed batch replaces rather than duplicates (exactly-once).  The batch id
    is a literal of each write: as a persisted column it would be sorted by, all
    rows of a task at once."""
    b = batch.persist()
    try:
        for rows, name in ((b, "store"), (b.select(F.to_json(F.struct(*batch.columns)).alias("value")), "topic"),
                           (b.where(F.col(high_col) == "HIGH"), "alerts")):
            overwrite_partitions(rows.withColumn("batch_id", F.lit(batch_id)), f"{base}/{name}", ["batch_id"])
    finally:
        b.unpersist()


def write_report(df: DataFrame, path: str) -> None:
    """A one-row report as JSON (an error if there are more rows)."""
    rows = df.limit(2).collect()
    if len(rows) > 1:
        raise ValueError("a report is one row")
    df.sparkSession.createDataFrame(rows, df.schema).coalesce(1).write.mode("overwrite").json(path)


def drop_older_than(spark: SparkSession, path: str, part_col: str, cutoff) -> list[str]:
    """Retention - delete partition folders with ``part_col < cutoff``
    (ruling C7).  Values are ISO dates or months, compared as such; a folder
    whose value is neither is left alone."""
    fs, p = _hadoop(spark, path)
    limit = dt.date.fromisoformat(str(cutoff)[:10])
    dropped = []
    if not fs.exists(p):
        return dropped
    for st in fs.listStatus(p):
        name, _, value = st.getPath().getName().partition("=")
        if not st.isDirectory() or name != part_col:
            continue
        try:
            day = dt.date.fromisoformat(value if len(value) > 7 else f"{value}-01")
        except ValueError:
            continue
        if day < (limit if len(value) > 7 else limit.replace(day=1)):
            fs.delete(st.getPath(), True)
            dropped.append(value)
    return dropped


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The partition columns of a table, by its folders."""
    fs, p = _hadoop(spark, path)
    columns = []
    while True:
        folders = [st.getPath() for st in fs.listStatus(p) if st.isDirectory() and "=" in st.getPath().getName()]
        if not folders:
            return columns
        p = folders[0]
        columns.append(p.getName().partition("=")[0])


def compact(spark: SparkSession, path: str, part_col: str, value, files: int | None = None, sort_cols=()) -> None:
    """Rewrite one partition into ``files`` sorted files (default: as
    many as the advisory partition size gives), through a staged copy and a
    dynamic overwrite of that partition alone; folders below it stay."""
    part = spark.read.parquet(path).where(F.col(part_col) == F.lit(value))
    out = part.repartition(files) if files else part.hint("rebalance")
    if sort_cols:
        out = out.sortWithinPartitions(*sort_cols)
    staged, stage = _staged(out, "compact")
    overwrite_partitions(staged, path, partition_columns(spark, path))
    _drop(spark, stage)


def layout(df: DataFrame, path: str, partition_by=(), sort_cols=(), bloom_cols=(), files_per_partition: int = 0) -> None:
    """Partitioned, sorted Parquet with optional bloom filters (skip
    indexes); min/max statistics come with every Parquet row group.  The rows
    of a partition are dealt to ``files_per_partition`` tasks, so a large one
    is not written by one."""
    out = df
    if partition_by and files_per_partition:
        file = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        out = out.repartition(*partition_by, file)
    if sort_cols:
        out = out.sortWithinPartitions(*partition_by, *sort_cols)
    w = out.write.mode("overwrite")
    for c in bloom_cols:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def create_views(spark: SparkSession, models: dict[str, DataFrame]) -> None:
    """Register models as temp views (``staging``/``marts`` names)."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
