"""The live path from an alert to its payloads: suppression (ST06/R10), then
enrichment (R17) with the alerts of the last two hours from the same address
(J03), then the outbox (K16).  Each is a query with a checkpoint of its own, so
each can be started anew alone.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.functions.security import alert_id
from eventlens.operators.alerts import (CAMPAIGN_MIN, RELATED_HOURS, _orig, alert_ip, channels_for, notification_outbox,
                                        recommendations)
from eventlens.sinks.writers import append_stream
from eventlens.streaming.jobs import WATERMARK, _trigger, start_with, state_conf

#: alerts without an address are dealt over this many join keys
SPREAD = 256


def kept_alerts(suppressed: DataFrame, alerts: DataFrame) -> DataFrame:
    """Rows of ``suppress_stream`` -> the kept alerts, with the columns of
    ``alerts`` and their ``alert_key``."""
    rows = suppressed.where("kept").select("alert_key", "ts", F.from_json("alert", alerts.schema).alias("a"))
    return rows.select(*[F.col("ts").cast(f.dataType).alias(f.name) if f.name == "timestamp" else F.col("alert_key") if f.name == "alert_key"
                         else F.col(f"a.{f.name}").alias(f.name) for f in alerts.schema.fields])


def with_related(kept: DataFrame, alerts: DataFrame, hours: int = RELATED_HOURS, watermark: str = WATERMARK) -> DataFrame:
    """J03 on streams: ``kept`` alerts with the number of HIGH ``alerts`` of the
    same address in the ``hours`` before, a left outer interval join under a
    watermark on both sides, and a count.  An alert comes out when the watermark
    has passed it, so alerts that are late by less than ``watermark`` are counted;
    the state holds ``hours`` and the watermark's delay of alerts."""
    schema = kept.schema
    rows = kept.select(F.to_json(F.struct(*kept.columns)).alias("_alert"), F.col("timestamp").cast("timestamp").alias("_at"), alert_ip(kept).alias("_ip"))
    none = F.concat(F.lit("no address "), F.pmod(F.xxhash64("_alert"), F.lit(SPREAD)).cast("string"))
    rows = rows.withColumn("_ip", F.coalesce("_ip", none)).withWatermark("_at", watermark)
    high = alerts.where(F.col("severity") == "HIGH").select(alert_ip(alerts).alias("_by"), F.col("timestamp").cast("timestamp").alias("_when"))
    high = high.where("_by is not null").withWatermark("_when", watermark)
    before = (F.col("_ip") == F.col("_by")) & (F.col("_when") < F.col("_at")) & (F.col("_when") >= F.col("_at") - F.expr(f"INTERVAL {hours} HOURS"))
    counted = rows.join(high, before, "left_outer").groupBy("_at", "_alert").agg(F.count("_when").alias("_n"))
    n = F.col("_n")
    parsed = counted.select("_at", "_n", F.from_json("_alert", schema).alias("a"))
    return parsed.select(*[F.col("_at").cast(f.dataType).alias(f.name) if f.name == "timestamp" else F.col(f"a.{f.name}").alias(f.name) for f in schema.fields],
                         F.when(n > 0, n).alias("related_alerts_count"), F.when(n > 0, n > CAMPAIGN_MIN).alias("is_part_of_campaign"))


def enrich_stream(kept: DataFrame, alerts: DataFrame, out_path: str, checkpoint: str, hours: int = RELATED_HOURS,
                  watermark: str = WATERMARK, available_now: bool = False, partitions: int | None = None):
    """R17 in a stream: the columns that ``enrich_alerts`` gives.  ``partitions``
    are those of a new checkpoint's state (default: the session's shuffle
    partitions)."""
    a = with_related(kept, alerts, hours, watermark)
    a = a.withColumns({"alert_id": alert_id(F.col("timestamp"), F.col("alert_key")), "processed_at": F.col("timestamp")})
    a = a.withColumns({"response_recommendations": recommendations(_orig(a, "threat_type")), "notification_channels": channels_for("severity")})
    return start_with(kept.sparkSession, _trigger(append_stream(a, out_path, checkpoint), None, available_now), state_conf(partitions))


def outbox_stream(enriched: DataFrame, out_path: str, checkpoint: str, available_now: bool = False):
    """K16 in a stream: one payload for each alert and channel."""
    return _trigger(append_stream(notification_outbox(enriched), out_path, checkpoint), None, available_now).start()


def await_all(spark: SparkSession, queries, poll_seconds: float = 1.0) -> None:
    """ST08: wait until all ``queries`` have ended; when one fails, the others
    are stopped and its error is raised."""
    left = list(queries)
    while left:
        for q in list(left):
            if q.isActive:
                continue
            left.remove(q)
            if q.exception() is not None:
                for other in left:
                    other.stop()
                raise q.exception()
        if left:
            time.sleep(poll_seconds)
