"""Registered queries that run a streaming job over data derived from the
given tables (the stand-in rows are written to the shared checkpoint folder,
replayed as a file stream with ``availableNow``, and the sink read back), and
the multi-line folding of the documents."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventlens import fixtures as fx
from eventlens.operators import alerts as AL
from eventlens.operators import sentiment as S
from eventlens.operators.security_rules import enrich_logs
from eventlens.plans.registry import query
from eventlens.plans.security_queries import LOG_FIELDS, _ENRICHED_ALERTS_SQL, _logs
from eventlens.plans.sentiment_queries import MERGED_HOURLY_DOUBLES, MERGED_HOURLY_SQL, with_author_bound
from eventlens.session import checkpoint_path
from eventlens.sinks.writers import staged
from eventlens.sources.streams import fold_multiline
from eventlens.streaming.alerting import await_all, enrich_stream, kept_alerts, outbox_stream
from eventlens.streaming.folding import fold_stream, folded_events
from eventlens.streaming.jobs import SUPPRESS_OUT, hourly_stream, state_partitions, suppress_stream


def _scratch(spark, name):
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("stream_hourly", MERGED_HOURLY_SQL, fixtures=["sentiment"], doubles=MERGED_HOURLY_DOUBLES)
def q_stream_hourly(spark, sf):
    """ST03 the hourly view kept by a stream of mergeable parts over the whole
    tweet stand-in (three micro-batches at least, dealt by post, so hours meet
    in the merge).  The author estimate is compared with the exact count."""
    base = _scratch(spark, "stream-hourly")
    cols = ["created_at", "date_partition", "predicted_sentiment", "sentiment_positive", "sentiment_neutral",
            "sentiment_negative", "confidence", "like_count", "retweet_count", "author_id"]
    posts = fx.sentiment_table(spark, sf).select(*cols)
    posts.repartition(3, "author_id").write.mode("overwrite").parquet(f"{base}/in")
    src = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    hourly_stream(src, f"{base}/out", f"{base}/ckpt", available_now=True).awaitTermination()
    return with_author_bound(S.hourly_merge(spark.read.parquet(f"{base}/out")),
                             spark.read.schema(posts.schema).parquet(f"{base}/in"))


@query("stream_suppress", """
WITH RECURSIVE a AS (
  SELECT event_id, CONCAT('rule:', log_type, ':', src_ip) AS alert_key, event_time,
         ROW_NUMBER() OVER (PARTITION BY log_type, src_ip ORDER BY event_time, event_id) AS rn
  FROM sec_logs WHERE result = 'FAILED'),
f(alert_key, rn, event_id, event_time, last_kept, kept) AS (
  SELECT alert_key, rn, event_id, event_time, event_time, TRUE FROM a WHERE rn = 1
  UNION ALL
  SELECT a.alert_key, a.rn, a.event_id, a.event_time,
         CASE WHEN a.event_time >= f.last_kept + INTERVAL 15 MINUTE THEN a.event_time ELSE f.last_kept END,
         a.event_time >= f.last_kept + INTERVAL 15 MINUTE
  FROM f JOIN a ON a.alert_key = f.alert_key AND a.rn = f.rn + 1)
SELECT event_id, alert_key, kept FROM f
""", fixtures=["sec_logs"])
def q_stream_suppress(spark, sf):
    """ST06 stateful suppression (15 minutes) of the failed-login alerts,
    keyed by log type and address, as a stream that reads a third of the time
    span at a time, started anew on its checkpoint; the alert itself is read
    back from what the stream carries."""
    base = _scratch(spark, "stream-suppress")
    alerts = (fx.sec_logs(spark, sf).where(F.col("result") == "FAILED")
              .select("event_id", F.concat_ws(":", F.lit("rule"), "log_type", "src_ip").alias("alert_key"),
                      F.col("event_time").alias("timestamp")))
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    low, high, n = alerts.agg(F.min(at), F.max(at), F.count("*")).first()
    states = state_partitions(spark, -(-n // 3))
    third = ((high or 0) - (low or 0)) // 3 + 1
    part = F.when(at >= (low or 0) + 2 * third, 2).when(at >= (low or 0) + third, 1).otherwise(0)
    for k in range(3):
        alerts.where(part == k).write.mode("append").parquet(f"{base}/in")
        src = spark.readStream.schema(alerts.schema).parquet(f"{base}/in")
        suppress_stream(src, f"{base}/out", f"{base}/ckpt", available_now=True, partitions=states).awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select(F.get_json_object("alert", "$.event_id").cast("long").alias("event_id"), "alert_key", "kept")


@query("stream_alerts", f"""
WITH e AS (SELECT * FROM ({_ENRICHED_ALERTS_SQL}) x)
SELECT alert_id, alert_key, timestamp, severity, related_alerts_count, is_part_of_campaign, recommendations, channels,
       CASE WHEN channels = '' THEN 0 ELSE len(string_split(channels, ',')) END AS payloads FROM e
""", fixtures=["sec_enriched"])
def q_stream_alerts(spark, sf):
    """ST06, R17, J03, K16 the live path: rule alerts suppressed, enriched by an
    interval join of streams and put in the outbox, a third of the time span at a
    time, every 40th alert of a third a batch late; a heartbeat moves the
    watermark past the last alert."""
    base = _scratch(spark, "stream-alerts")
    alerts = AL.alerts_from_rules(enrich_logs(_logs(spark, sf)), LOG_FIELDS + ("event_id",))
    alerts = staged(alerts.withColumn("alert_key", AL.alert_key(alerts)), "alerts")
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    low, high, n = alerts.agg(F.min(at), F.max(at), F.count("*")).first()
    states = state_partitions(spark, -(-n // 3))
    third = ((high or 0) - (low or 0)) // 3 + 1
    part = F.floor((at - F.lit(low or 0)) / third).cast("int")
    # a late alert is of the last hour of its third, so that the watermark has not passed it
    late = (F.col("original_log.event_id") % 40 == 0) & (part < 2) & ((at - F.lit(low or 0)) % third > third - 3_600_000_000)
    part = F.when(late, part + 1).otherwise(part)
    beat = alerts.where(at == high).limit(1).withColumns({
        "timestamp": F.col("timestamp") + F.expr("INTERVAL 3 DAYS"), "alert_key": F.lit("heartbeat"),
        "original_log": F.col("original_log").withField("src_ip", F.lit("heartbeat"))})
    stream = lambda folder, schema: spark.readStream.schema(schema).parquet(f"{base}/{folder}")
    for k in range(3):
        alerts.where(part == k).unionByName(beat if k == 2 else beat.limit(0)).write.mode("append").parquet(f"{base}/in")
        suppress_stream(stream("in", alerts.schema), f"{base}/suppressed", f"{base}/ckpt-1", available_now=True,
                        partitions=states).awaitTermination()
        kept = kept_alerts(stream("suppressed", SUPPRESS_OUT), alerts)
        enrich_stream(kept, stream("in", alerts.schema), f"{base}/enriched", f"{base}/ckpt-2", watermark="2 hours",
                      available_now=True, partitions=states).awaitTermination()
        enriched = spark.read.parquet(f"{base}/enriched")
        await_all(spark, [outbox_stream(stream("enriched", enriched.schema), f"{base}/outbox", f"{base}/ckpt-3", available_now=True)])
    sent = spark.read.parquet(f"{base}/outbox").groupBy("alert_id").agg(F.count("*").alias("payloads"))
    return enriched.join(sent, "alert_id", "left").select(
        "alert_id", "alert_key", "timestamp", "severity", "related_alerts_count", "is_part_of_campaign",
        F.array_join("response_recommendations", " | ").alias("recommendations"), F.array_join("notification_channels", ",").alias("channels"),
        F.coalesce("payloads", F.lit(0)).alias("payloads"))


_FOLD_SQL = """
WITH s AS (SELECT *, CASE WHEN regexp_matches(line, '^[A-Z]') THEN 1 ELSE 0 END AS st
           FROM log_lines),
g AS (SELECT *, SUM(st) OVER (PARTITION BY file_id ORDER BY line_no) AS event_no FROM s)
SELECT file_id, CAST(event_no AS BIGINT) AS event_no, MIN(line_no) AS first_line, COUNT(*) AS n_lines,
       string_agg(line, chr(10) ORDER BY line_no) AS text, 0::BIGINT AS part
FROM g GROUP BY file_id, event_no
"""


@query("stream_fold", _FOLD_SQL, fixtures=["log_lines"])
def q_stream_fold(spark, sf):
    """S08 the document lines folded while they arrive, a third of the lines of
    every file at a time, started anew on its checkpoint: the cuts fall inside
    events."""
    base = _scratch(spark, "stream-fold")
    lines = fx.log_lines(spark, sf)
    third = F.floor((F.col("line_no") - 1) * 3 / F.max("line_no").over(Window.partitionBy("file_id")))
    lines = lines.withColumn("arrives", third)
    for k in range(3):
        lines.where(F.col("arrives") == k).drop("arrives").write.mode("append").parquet(f"{base}/in")
        src = spark.readStream.schema(lines.drop("arrives").schema).parquet(f"{base}/in")
        fold_stream(src, f"{base}/out", f"{base}/open", f"{base}/ckpt", "^[A-Z]", available_now=True).awaitTermination()
    return folded_events(spark, f"{base}/out", f"{base}/open")


@query("fold_multiline", _FOLD_SQL, fixtures=["log_lines"])
def q_fold_multiline(spark, sf):
    """S08 document lines folded into events: a line starting with an
    upper-case letter starts an event, others join the previous one."""
    return fold_multiline(fx.log_lines(spark, sf), start_pattern="^[A-Z]")
