"""S08 while the files grow: lines arrive in micro-batches that cut events, and
the fold goes on where it stopped.

Each micro-batch is folded as a batch is, in chunks of a file, so a file with
most of the lines is not one task's.  What the next batch needs of a file is one
row, written per batch: the number and first line of its open event, and the
open event's last part.  Later lines join it; a line that starts an event, or
``timeout_seconds`` without a line of the file, puts it out.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlens.sinks.writers import _drop, _hadoop, overwrite_partitions, table_exists
from eventlens.sources.streams import IPV4_START, running

EVENT = ("event_no", "part", "first_line", "n_lines", "text")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Batches whose open events were written whole."""
    if not table_exists(spark, path):
        return []
    fs, p = _hadoop(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith("batch=") and table_exists(spark, f"{path}/{n}"))


def fold_batch(lines: DataFrame, open_events: DataFrame | None, start_pattern: str, file_col: str, line_col: str, text_col: str,
               max_lines: int) -> DataFrame:
    """Lines of one micro-batch, and the open event of each file -> event parts
    with ``from_line`` (the event's first line) and ``is_open`` (the file's last)."""
    start = F.coalesce(F.col(text_col).rlike(start_pattern), F.lit(False))
    g = running(lines, [file_col], line_col, {"_starts": (F.sum, start.cast("long")), "_from": (F.max, F.when(start, F.col(line_col)))})
    g = g.select(file_col, line_col, text_col, "_starts", "_from")
    if open_events is None:
        base, begun = F.lit(0).cast("long"), F.lit(None).cast("long")
    else:
        known = open_events.select(F.col(file_col), F.col("event_no").alias("_base"), F.col("from_line").alias("_begun"))
        g = g.join(known, file_col, "left")
        base, begun = F.coalesce("_base", F.lit(0)), F.col("_begun")
    g = g.withColumns({"event_no": base + F.col("_starts"), "from_line": F.coalesce("_from", begun)})
    part = F.floor((F.col(line_col) - F.coalesce("from_line", F.lit(1))) / max_lines).cast("long")
    rows = g.select(file_col, "event_no", part.alias("part"), "from_line", F.col(line_col).alias("first_line"), F.lit(1).cast("long").alias("n_lines"),
                    F.col(text_col).alias("text"))
    if open_events is not None:
        rows = rows.unionByName(open_events.where("text is not null").select(rows.columns))
    parts = rows.groupBy(file_col, "event_no", "part").agg(
        F.max("from_line").alias("from_line"), F.min("first_line").alias("first_line"), F.sum("n_lines").alias("n_lines"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first_line", "text"))), lambda x: x["text"]), "\n").alias("text"))
    # one small row a file and not a window over its events
    last = parts.groupBy(file_col).agg(F.max(F.struct("event_no", "part")).alias("_last"))
    parts = parts.join(last, file_col)
    return parts.withColumn("is_open", F.struct("event_no", "part") == F.col("_last")).drop("_last")


def fold_stream(lines: DataFrame, out_path: str, state_path: str, checkpoint: str, start_pattern: str = IPV4_START,
                file_col: str = "file_id", line_col: str = "line_no", text_col: str = "line", max_lines: int = 10_000,
                timeout_seconds: float | None = None, available_now: bool = False, clock=time.time):
    """S08 in a stream: ``lines`` of growing files -> event parts, appended to
    ``out_path`` by batch (a replayed batch replaces itself) as soon as the next
    event of the file starts.  Lines of a file must come in their order from one
    batch to the next.  The open events lie below ``state_path``, one row a file
    and version; the last two versions are kept, for a replay.

    With ``timeout_seconds`` an open event whose file got no line for so long is
    put out; lines that still come for it are then a row of their own, of the
    same event."""
    from eventlens.streaming.jobs import _trigger
    spark = lines.sparkSession

    def handle(batch: DataFrame, batch_id: int):
        before = [v for v in _versions(spark, state_path) if v < batch_id]
        known = spark.read.parquet(f"{state_path}/batch={before[-1]}") if before else None
        files = batch.select(file_col).distinct()
        active = known.join(files, file_col, "left_semi") if known is not None else None
        folded = fold_batch(batch, active, start_pattern, file_col, line_col, text_col, max_lines).withColumn("seen", F.lit(clock())).persist()
        try:
            done, state = folded.where("not is_open"), folded.where("is_open").drop("is_open")
            if known is not None:
                idle = known.join(files, file_col, "left_anti")
                if timeout_seconds is not None:
                    late = (F.lit(clock()) - F.col("seen") >= timeout_seconds) & F.col("text").isNotNull()
                    done = done.unionByName(idle.where(late).withColumn("is_open", F.lit(False)))
                    idle = idle.withColumn("text", F.when(~late, F.col("text")))
                state = state.unionByName(idle)
            overwrite_partitions(done.select(file_col, *EVENT).withColumn("batch_id", F.lit(batch_id)), out_path, ["batch_id"])
            state.write.mode("overwrite").parquet(f"{state_path}/batch={batch_id}")
        finally:
            folded.unpersist()
        for old in before[:-1]:
            _drop(spark, f"{state_path}/batch={old}")

    w = lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(w, None, available_now).start()


def folded_events(spark: SparkSession, out_path: str, state_path: str, file_col: str = "file_id") -> DataFrame:
    """All event parts so far: those put out, and the open ones as they are."""
    version = _versions(spark, state_path)[-1]
    rows = spark.read.parquet(f"{state_path}/batch={version}").where("text is not null").select(file_col, *EVENT)
    if table_exists(spark, out_path):
        rows = rows.unionByName(spark.read.parquet(out_path).select(file_col, *EVENT))
    return rows


