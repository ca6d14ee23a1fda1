"""Structured Streaming jobs (ST01-ST10).

Each job is a function that wires a source, the same column logic the batch
reports use, and a sink, and returns the started ``StreamingQuery``.  Every
query has its own checkpoint under the shared checkpoint folder; triggers
default to the reference's intervals, ``available_now=True`` drains what is
there and stops (tests, backfills).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators.alerts import build_alerts
from eventlens.operators.prices import PRICE_TICK_SCHEMA, parse_json_value, unpivot_prices
from eventlens.operators.security_rules import enrich_logs
from eventlens.operators.sentiment import hourly_partials, normalise_tweets
from eventlens.sinks.writers import append_stream, overwrite_partitions, route, table_exists, topic_sink, write_jdbc
from eventlens.streaming.suppression import SuppressKeys

STORE_TRIGGER = "30 seconds"
TOPIC_TRIGGER = "10 seconds"
WATERMARK = "10 minutes"


def _event_time(df: DataFrame, col: str) -> DataFrame:
    """Watermarks need a zoned timestamp; wall-clock (NTZ) columns are read
    as UTC (the session time zone)."""
    if df.schema[col].dataType.simpleString() == "timestamp_ntz":
        return df.withColumn(col, F.col(col).cast("timestamp"))
    return df


def _trigger(w, interval: str | None, available_now: bool):
    if available_now:
        return w.trigger(availableNow=True)
    if interval:
        return w.trigger(processingTime=interval)
    return w


def price_stream(spark: SparkSession, ticks: DataFrame, table_path: str, checkpoint: str,
                 available_now: bool = False):
    """ST01/ST10: price topic -> parsed ticks -> one row per coin -> the lake
    table's ``source=streaming`` folder.  The batch loader owns
    ``source=batch``, so the two writers never share files, and the stream's
    commit log stays inside its own folder: reading the table root lists both
    folders (a sink log at the root would hide the batch files)."""
    parsed = parse_json_value(ticks, PRICE_TICK_SCHEMA, keep_broker_time=False)
    rows = unpivot_prices(parsed, source="streaming").drop("source")
    w = append_stream(rows, f"{table_path.rstrip('/')}/source=streaming", checkpoint)
    return _trigger(w, None, available_now).start()


def tweet_stream(spark: SparkSession, tweets: DataFrame, schema, table_path: str, topic_path: str,
                 checkpoint_base: str, available_now: bool = False, topic: str = "processed_tweets",
                 bootstrap: str | None = None, jdbc: dict | None = None):
    """ST02: raw tweets -> scored rows -> (a) the analysis table, appended per
    micro-batch with the batch id as partition so a replay overwrites itself
    (K04, ruling C10: errors propagate; with ``jdbc`` options to a warehouse
    table as well), (b) the processed topic as keyed JSON (K05; Kafka with
    ``bootstrap``).  Two queries with their own checkpoints, as the reference."""
    raw = tweets.select(F.from_json(F.col("value").cast("string"), schema).alias("t")).select("t.*")
    scored = normalise_tweets(raw)

    def to_table(batch: DataFrame, batch_id: int):
        overwrite_partitions(batch.withColumn("batch_id", F.lit(batch_id)), table_path, ["batch_id"])
        # the ledger names the batches that the warehouse has; a replayed one is not appended again
        done = f"{checkpoint_base}/warehouse/batch={batch_id}"
        if jdbc and not table_exists(spark, done):
            write_jdbc(spark.read.parquet(table_path).where(F.col("batch_id") == batch_id).drop("batch_id"), **jdbc)
            spark.range(1).write.mode("overwrite").parquet(done)

    q1 = _trigger(scored.writeStream.foreachBatch(to_table)
                  .option("checkpointLocation", f"{checkpoint_base}/store"), STORE_TRIGGER, available_now).start()
    keyed = scored.select(F.col("tweet_id").alias("key"), F.to_json(F.struct(*scored.columns)).alias("value"))
    q2 = _trigger(topic_sink(keyed, topic, f"{checkpoint_base}/topic", bootstrap, topic_path), TOPIC_TRIGGER, available_now).start()
    return q1, q2


def hourly_stream(scored: DataFrame, out_path: str, checkpoint: str, available_now: bool = False):
    """ST03/A02: the hourly view kept up to date.  Every micro-batch writes its
    mergeable hourly parts (sums, counts, author sketch) into its own
    ``batch_id`` partition, and readers merge the parts with ``hourly_merge``:
    late posts count, the running hour is there, a replayed batch replaces
    itself, and there is no state to keep."""
    def write_parts(batch: DataFrame, batch_id: int):
        overwrite_partitions(hourly_partials(batch).withColumn("batch_id", F.lit(batch_id)), out_path, ["batch_id"])

    w = scored.writeStream.foreachBatch(write_parts).option("checkpointLocation", checkpoint)
    return _trigger(w, None, available_now).start()


def log_stream(logs: DataFrame, base_path: str, checkpoint: str, available_now: bool = False):
    """ST04/K10: raw events -> rules (R07) -> routed writes per micro-batch."""
    enriched = enrich_logs(logs)
    w = enriched.writeStream.foreachBatch(lambda b, i: route(b, i, base_path)) \
        .option("checkpointLocation", checkpoint)
    return _trigger(w, None, available_now).start()


def brute_force_stream(logs: DataFrame, out_path: str, checkpoint: str, threshold: int = 10,
                       window: str = "5 minutes", slide: str = "1 minute", ts_col: str = "event_time",
                       ip_col: str = "src_ip", available_now: bool = False, watermark: str = WATERMARK):
    """ST07/R18: sliding-window failure counts with a watermark; windows are
    emitted once final.  Rows are dealt out before they are counted, so the
    windows that a task counts do not grow with the file it reads."""
    from eventlens.operators.alerts import brute_force
    f = _event_time(logs, ts_col).withWatermark(ts_col, watermark)
    # by address and minute: rows that share windows meet, however many rows a file has
    f = f.repartition(F.col(ip_col), F.date_trunc("minute", ts_col))
    out = brute_force(f, ip_col, ts_col, threshold, window, slide)
    w = append_stream(out, out_path, checkpoint)
    return _trigger(w, None, available_now).start()


#: a key's state stays so long after the key's last batch, in milliseconds of the wall clock
SUPPRESS_IDLE_MS = 24 * 3600 * 1000
#: alert keys are judged in so many groups; a checkpoint is bound to the number
SUPPRESS_GROUPS = 1024
SUPPRESS_OUT = "alert_key string, ts timestamp, alert string, kept boolean"
#: rows of a micro-batch for which a partition of a query's state is laid out
ROWS_A_STATE = 50_000


def state_partitions(spark: SparkSession, batch_rows: int) -> int:
    """Partitions of the state of a query whose micro-batches have some
    ``batch_rows`` rows.  A partition costs a load and a commit in every batch,
    whatever it holds, so their number follows the rows (in whole waves of the
    cores) and not the setting for batch shuffles; a setting below one wave holds
    while the rows need no more."""
    need, cores = max(1, -(-batch_rows // ROWS_A_STATE)), spark.sparkContext.defaultParallelism
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), cores)
    return least if need <= least else -(-need // cores) * cores


def suppress_stream(alerts: DataFrame, out_path: str, checkpoint: str, minutes: int = 15,
                    key_col: str = "alert_key", ts_col: str = "timestamp", available_now: bool = False,
                    watermark: str = WATERMARK, partitions: int | None = None):
    """ST06/R10 in a stream: per key, the time of the last kept alert is typed
    state (RocksDB store); each micro-batch's alerts of a key are judged in time
    order against it, chunk by chunk, the keys of a hash group together
    (``SuppressKeys``).  No alert is dropped,
    however late: the timers are of processing time, as with event-time timers
    Spark leaves out rows behind the watermark.  The watermark only says when a
    key's state may go: it is a window past the last kept alert, and the key
    was idle for ``SUPPRESS_IDLE_MS``.  An alert that comes later still starts
    anew and is kept.  Of alerts of one key and time the least is kept; an alert
    without a time is always kept.  The whole alert is carried as JSON
    (``alert``), so the enrichment and the outbox can follow.  ``partitions`` are
    those of a new checkpoint's state (default: the session's shuffle partitions)."""
    if minutes <= 0:
        raise ValueError("a suppression window has at least one minute")
    src = alerts.select(F.col(key_col).alias("alert_key"), F.col(ts_col).alias("ts"),
                        F.to_json(F.struct(*alerts.columns)).alias("alert"))
    src = _event_time(src, "ts").withWatermark("ts", watermark)
    src = src.withColumn("key_group", F.pmod(F.xxhash64("alert_key"), F.lit(SUPPRESS_GROUPS)).cast("int"))
    out = src.groupBy("key_group").transformWithStateInPandas(
        SuppressKeys(minutes * 60 * 1_000_000, SUPPRESS_IDLE_MS), SUPPRESS_OUT, "append", "ProcessingTime")
    w = _trigger(append_stream(out, out_path, checkpoint), None, available_now)
    # with processing-time timers there is always one more batch without rows, and a drain would not end
    drain = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"} if available_now else {}
    return start_with(alerts.sparkSession, w, drain | state_conf(partitions))


def state_conf(partitions: int | None) -> dict[str, str]:
    return {"spark.sql.shuffle.partitions": str(partitions)} if partitions else {}


def start_with(spark: SparkSession, w, conf: dict[str, str]):
    """Start a query under settings of its own: it takes them from the session
    when it starts."""
    before = {name: spark.conf.get(name) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        return w.start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def score_stream(logs: DataFrame, models: dict, out_path: str, checkpoint: str, available_now: bool = False):
    """ST05/M11: score each micro-batch with the fitted models and append the
    alert records they raise (R16: the log, its score, severity and
    description; batch-id partitions, so replays overwrite).  Logs without a
    model of their type raise none."""
    from eventlens.ml.forest import score_all

    def handle(batch: DataFrame, batch_id: int):
        batch = batch.persist()  # each model and the join read it
        try:
            scored = score_all(batch, models, keep=("event_id",)).where(F.col("is_anomaly_pred"))
            flagged = batch.join(scored.drop("log_type"), "event_id")
            records = build_alerts(flagged, batch.columns)
            overwrite_partitions(records.withColumn("batch_id", F.lit(batch_id)), out_path, ["batch_id"])
        finally:
            batch.unpersist()

    w = logs.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _trigger(w, None, available_now).start()
