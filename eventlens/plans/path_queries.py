"""Registered queries over whole paths: files and topics made of the given
tables are written, read by the library's sources, run through its streams and
table writers, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from eventlens import fixtures as fx
from eventlens.functions.text import label_name
from eventlens.ml.forest import fit_forest, load_model, save_model, score_all
from eventlens.ml.text_model import score_text
from eventlens.operators import prices as P
from eventlens.operators import videos as V
from eventlens.operators.security_rules import dedupe_events, enrich_logs
from eventlens.plans.lake_queries import _PRICE_COLS, _STG_COLS
from eventlens.plans.registry import query
from eventlens.plans.security_queries import BF_SLIDE_MIN, BF_THRESHOLD, BF_WINDOW_MIN, _logs
from eventlens.plans.sentiment_queries import _N0, _P0
from eventlens.session import checkpoint_path
from eventlens.sinks.writers import (append_stream, compact, create_views, drop_older_than, merge_insert_only_table, replace_table,
                                     write_csv, write_daily, write_report)
from eventlens.sources.streams import batch_files, read_incidents_json, read_prices_csv, read_topic, read_videos_csv
from eventlens.sources.tables import read_daily, read_parquet_table
from eventlens.streaming.jobs import brute_force_stream, log_stream, price_stream, score_stream, tweet_stream


def _scratch(spark, name):
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _topic(df, path, key, at="timestamp'2024-01-15 10:00:00'"):
    """Rows as a topic's JSON files (key, value, broker time)."""
    value = F.to_json(F.struct(*[c for c in df.columns if c != key]), {"ignoreNullFields": "false"})
    df.select(F.col(key).cast("string").alias("key"), value.alias("value"), F.expr(at).alias("timestamp")).write.json(path)


@query("price_lake", f"""
SELECT {_PRICE_COLS} FROM price_stream UNION ALL SELECT {_PRICE_COLS} FROM price_batch_norm
""", fixtures=["price_stream", "price_batch_norm"], doubles=["price", "event_epoch"])
def q_price_lake(spark, sf):
    """S01, P01, ST01, ST10, K01: ticks from a topic to the lake's stream folder;
    K08, S04, K02, K03: trades to CSV and back, merged into the lake twice."""
    base = _scratch(spark, "price-lake")
    _topic(fx.price_wide(spark, sf), f"{base}/topics/crypto_prices", "tick_id")
    ticks = read_topic(spark, "crypto_prices", path=f"{base}/topics")
    price_stream(spark, ticks, f"{base}/lake", f"{base}/ckpt", available_now=True).awaitTermination()
    write_csv(fx.price_batch(spark, sf), f"{base}/csv")
    batch = P.normalise_batch_prices(read_prices_csv(spark, f"{base}/csv"))
    for _ in range(2):
        merge_insert_only_table(spark, batch, f"{base}/lake")
    return spark.read.parquet(f"{base}/lake").select(*P.UNIFIED_COLUMNS)


@query("tweet_store", f"""
WITH s AS (SELECT doc_id, text, lang, {_P0} AS p0, {_N0} AS n0 FROM documents WHERE text IS NOT NULL),
n AS (SELECT *, CASE WHEN text = '' THEN 0.33 ELSE p0 / (p0 + n0 + (1.0 - p0 - n0)) END AS sp,
             CASE WHEN text = '' THEN 0.34 ELSE (1.0 - p0 - n0) / (p0 + n0 + (1.0 - p0 - n0)) END AS su,
             CASE WHEN text = '' THEN 0.33 ELSE n0 / (p0 + n0 + (1.0 - p0 - n0)) END AS sn FROM s)
SELECT CAST(doc_id AS VARCHAR) AS tweet_id, TIMESTAMP '2024-01-15 10:00:00' + to_seconds(doc_id) AS created_at, lang,
       CAST(doc_id % 50 AS INTEGER) AS like_count, sp AS sentiment_positive, su AS sentiment_neutral, sn AS sentiment_negative,
       CASE WHEN sp >= su AND sp >= sn THEN 'positive' WHEN su >= sn THEN 'neutral' ELSE 'negative' END AS predicted_sentiment,
       CASE WHEN sp >= su AND sp >= sn THEN 'positive' WHEN su >= sn THEN 'neutral' ELSE 'negative' END AS in_topic
FROM n
""", doubles=["sentiment_positive", "sentiment_neutral", "sentiment_negative"])
def q_tweet_store(spark, sf):
    """S01, P08, ST02, K04 (files), K05: every document as a tweet, from a topic
    through the scoring stream to the table and the processed topic."""
    base = _scratch(spark, "tweet-store")
    d = read_parquet_table(spark, sf, "documents")
    at = F.timestamp_seconds(F.lit(1705312800) + F.col("doc_id"))
    raw = d.select("doc_id", F.col("doc_id").cast("string").alias("id"), "text", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("created_at"),
                   F.lit("a").alias("author_id"), "lang", F.create_map(F.lit("like_count"), (F.col("doc_id") % 50).cast("int")).alias("public_metrics"))
    _topic(raw, f"{base}/topics/tweets", "doc_id")
    schema = "id string, text string, created_at string, author_id string, lang string, public_metrics map<string,int>"
    for q in tweet_stream(spark, read_topic(spark, "tweets", path=f"{base}/topics"), schema, f"{base}/table", f"{base}/out", f"{base}/ckpt",
                          available_now=True):
        q.awaitTermination()
    topic = spark.read.schema("key string, value string").json(f"{base}/out/processed_tweets").select(
        F.col("key").alias("tweet_id"), F.get_json_object("value", "$.predicted_sentiment").alias("in_topic"))
    return spark.read.parquet(f"{base}/table").join(topic, "tweet_id", "left").select(
        "tweet_id", F.col("created_at").cast("timestamp_ntz").alias("created_at"), "lang", "like_count", "sentiment_positive", "sentiment_neutral",
        "sentiment_negative", "predicted_sentiment", "in_topic")


def _log_files(spark, sf, base, columns=None):
    logs = fx.sec_logs(spark, sf)
    logs = logs.select(*columns) if columns else logs
    files = batch_files(logs, f"{base}/in", logs.count())
    return spark.readStream.schema(logs.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/in")


@query("log_store", """
SELECT event_id, log_type, severity, severity = 'HIGH' AS in_alerts, TRUE AS in_topic FROM sec_enriched
""", fixtures=["sec_enriched"])
def q_log_store(spark, sf):
    """ST04, K10: raw events through the rules to store, topic and alerts, three
    micro-batches, each written by its batch id."""
    base = _scratch(spark, "log-store")
    log_stream(_log_files(spark, sf, base), f"{base}/out", f"{base}/ckpt", available_now=True).awaitTermination()
    out = lambda name: spark.read.parquet(f"{base}/out/{name}")
    alerts = out("alerts").select("event_id", F.lit(True).alias("_a"))
    topic = out("topic").select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"), F.lit(True).alias("_t"))
    return out("store").join(alerts, "event_id", "left").join(topic, "event_id", "left").select(
        "event_id", "log_type", "severity", F.coalesce("_a", F.lit(False)).alias("in_alerts"), F.coalesce("_t", F.lit(False)).alias("in_topic"))


@query("stream_brute_force", f"""
SELECT ip, window_start, window_start + INTERVAL {BF_WINDOW_MIN} MINUTE AS window_end, COUNT(*) AS failures
FROM (SELECT src_ip AS ip, event_time,
             time_bucket(INTERVAL {BF_SLIDE_MIN} MINUTE, event_time) - k * INTERVAL {BF_SLIDE_MIN} MINUTE AS window_start
      FROM sec_logs, (SELECT unnest(range(0, {BF_WINDOW_MIN // BF_SLIDE_MIN})) AS k) ks WHERE result = 'FAILED') w
WHERE window_start + INTERVAL {BF_WINDOW_MIN} MINUTE <= (SELECT MAX(event_time) FROM sec_logs WHERE result = 'FAILED') - INTERVAL 10 MINUTE
GROUP BY ip, window_start HAVING COUNT(*) >= {BF_THRESHOLD}
""", fixtures=["sec_logs"])
def q_stream_brute_force(spark, sf):
    """ST07: failed logins in sliding windows under a watermark of ten minutes;
    windows that it has passed are put out."""
    base = _scratch(spark, "stream-brute-force")
    logs = fx.sec_logs(spark, sf).select("src_ip", "event_time", "result")
    batch_files(logs, f"{base}/in", logs.count(), by="event_time")
    src = spark.readStream.schema(logs.schema).parquet(f"{base}/in")
    brute_force_stream(src, f"{base}/out", f"{base}/ckpt", BF_THRESHOLD, f"{BF_WINDOW_MIN} minutes", f"{BF_SLIDE_MIN} minutes",
                       available_now=True).awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    return out.select("ip", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "failures")


@query("stream_dedupe", "SELECT DISTINCT event_hash FROM sec_enriched", fixtures=["sec_enriched"])
def q_stream_dedupe(spark, sf):
    """R08 in a stream: every event twice, one for each fingerprint stays."""
    base = _scratch(spark, "stream-dedupe")
    logs = _logs(spark, sf).withColumn("event_time", F.col("event_time").cast("timestamp"))
    for _ in range(2):
        logs.write.mode("append").parquet(f"{base}/in")
    src = spark.readStream.schema(logs.schema).parquet(f"{base}/in")
    once = dedupe_events(enrich_logs(src), watermark="40 days", ts_col="event_time").select("event_hash")
    append_stream(once, f"{base}/out", f"{base}/ckpt").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


_DAYS = "ts >= TIMESTAMP '2024-01-12' AND ts < TIMESTAMP '2024-01-21'"


@query("daily_tables", f"""
SELECT 'day' AS kind, strftime(ts, '%Y-%m-%d') AS period, CAST(COUNT(*) + COUNT(*) FILTER (WHERE event_id % 10 = 0) AS BIGINT) AS n_rows
FROM events WHERE {_DAYS} GROUP BY 2
UNION ALL SELECT 'month', strftime(ts, '%Y-%m'), COUNT(*) FROM events WHERE ts < TIMESTAMP '2024-02-01' AND ts >= TIMESTAMP '2024-01-01' GROUP BY 2
""")
def q_daily_tables(spark, sf):
    """K09 loads by day (one twice), K13 retention, K14 compaction of a day, S11
    a range of days, the same by month, and K06 the result replaced twice."""
    base = _scratch(spark, "daily")
    e = read_parquet_table(spark, sf, "events").select("event_id", "ts")
    write_daily(e, f"{base}/day", "ts", "a")
    for _ in range(2):
        write_daily(e.where("event_id % 10 = 0"), f"{base}/day", "ts", "b")
    drop_older_than(spark, f"{base}/day", "dt", "2024-01-10")
    compact(spark, f"{base}/day", "dt", "2024-01-15", files=1, sort_cols=["ts"])
    days = read_daily(spark, f"{base}/day", "2024-01-12", "2024-01-20")
    write_daily(e, f"{base}/month", "ts", "a", monthly=True)
    months = read_daily(spark, f"{base}/month", "2024-01", "2024-01", "month")
    count = lambda df, kind, c: df.groupBy(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("period")).agg(F.count("*").alias("n_rows"))
    out = count(days, "day", "dt").unionByName(count(months, "month", "month"))
    for rows in (out.limit(1), out):
        replace_table(rows, f"{base}/result")
    return spark.read.parquet(f"{base}/result")


@query("video_files", f"SELECT {_STG_COLS} FROM (SELECT * REPLACE (NULLIF(description, '') AS description) FROM videos_stg) v", fixtures=["videos_stg"])
def q_video_files(spark, sf):
    """The trending videos as CSV files, read and staged (in CSV an
    empty text is a missing one)."""
    base = _scratch(spark, "videos")
    write_csv(fx.videos_raw(spark, sf), f"{base}/csv")
    return V.stg_videos(read_videos_csv(spark, f"{base}/csv"))


@query("incident_files", """
SELECT incident_seq, fecha, hora, gravedad, clase_incidente, comuna, latitud, longitud FROM incidents_raw ORDER BY incident_seq DESC LIMIT 1000
""", fixtures=["incidents_raw"])
def q_incident_files(spark, sf):
    """A page of the latest records of JSON files."""
    base = _scratch(spark, "incidents")
    fx.incidents_raw(spark, sf).write.json(f"{base}/json")
    page = read_incidents_json(spark, f"{base}/json", newest=1000, order_col="incident_seq")
    return page.select("incident_seq", "fecha", "hora", "gravedad", "clase_incidente", "comuna", "latitud", "longitud")


@query("report_file", """
SELECT COUNT(*) AS incidents, COUNT(DISTINCT comuna) AS comunas, CAST(MAX(fecha_accidente) AS VARCHAR) AS last_day FROM incidents
""", fixtures=["incidents"])
def q_report_file(spark, sf):
    """A report computed from a registered view, as a JSON file."""
    base = _scratch(spark, "report")
    create_views(spark, {"stg_incidents": fx.incidents(spark, sf)})
    write_report(spark.sql("SELECT COUNT(*) AS incidents, COUNT(DISTINCT comuna) AS comunas, CAST(MAX(fecha_accidente) AS STRING) AS last_day "
                           "FROM stg_incidents"), f"{base}/report")
    return spark.read.json(f"{base}/report").select("incidents", "comunas", "last_day")


def _length_model():
    """A stand-in for a model: the label follows the text's length."""
    def model(texts):
        order = [0.8, 0.15, 0.05]
        return [[{"label": f"LABEL_{(len(t) + k) % 3}", "score": s} for k, s in enumerate(order)] for t in texts]
    return model


@query("model_sentiment", """
WITH t AS (SELECT doc_id, CAST(length(text) % 3 AS INTEGER) AS k, coalesce(text, '') = '' AS bare FROM documents)
SELECT doc_id, CASE WHEN bare THEN 'neutral' ELSE ['negative', 'neutral', 'positive'][k + 1] END AS predicted_sentiment,
       CASE WHEN bare THEN 0.33 ELSE [0.05, 0.15, 0.8][k + 1] END AS sentiment_positive, CASE WHEN bare THEN 0.34 ELSE 0.8 END AS confidence,
       CASE WHEN bare THEN NULL ELSE 'LABEL_' || k END AS label, CAST(NULL AS VARCHAR) AS score_error FROM t
""", doubles=["sentiment_positive", "confidence"])
def q_model_sentiment(spark, sf):
    """Every document scored by a plugged-in model."""
    out = score_text(read_parquet_table(spark, sf, "documents").select("doc_id", "text"), scorer_factory=_length_model)
    bare = F.coalesce("text", F.lit("")) == ""
    label = F.when(~bare, F.concat(F.lit("LABEL_"), (F.char_length("text") % 3).cast("string")))
    named = F.when(label_name(label) == F.col("predicted_sentiment"), label)
    return out.select("doc_id", "predicted_sentiment", "sentiment_positive", F.when(bare, F.lit(0.34)).otherwise(F.col("confidence")).alias("confidence"),
                      named.alias("label"), "score_error")


@query("model_round_trip", """
SELECT log_type, COUNT(*) AS events, TRUE AS same_scores, TRUE AS same_stream FROM sec_logs WHERE log_type = 'firewall' GROUP BY log_type
""", fixtures=["sec_logs"])
def q_model_round_trip(spark, sf):
    """M08 to M11, ST05: a forest is fitted, saved and loaded; it gives the same
    scores, and its stream flags what the batch flags."""
    base = _scratch(spark, "model")
    logs = fx.sec_logs(spark, sf)
    save_model(fit_forest(logs, "firewall"), f"{base}/models")
    fitted, again = (load_model(spark, f"{base}/models", "firewall") for _ in range(2))
    a = score_all(logs, {"firewall": fitted}).select("log_type", "event_id", "anomaly_score", "is_anomaly_pred")
    b = score_all(logs, {"firewall": again}).select("event_id", F.col("anomaly_score").alias("other"))
    score_stream(_log_files(spark, sf, base), {"firewall": again, "web": None}, f"{base}/out", f"{base}/ckpt", available_now=True).awaitTermination()
    flagged = spark.read.parquet(f"{base}/out").select(F.col("original_log.event_id").alias("event_id"), F.lit(True).alias("streamed"))
    both = a.join(b, "event_id", "left").join(flagged, "event_id", "left")
    return both.groupBy("log_type").agg(
        F.count("*").alias("events"), F.bool_and(F.col("anomaly_score") == F.col("other")).alias("same_scores"),
        F.bool_and(F.coalesce("streamed", F.lit(False)) == F.col("is_anomaly_pred")).alias("same_stream"))
