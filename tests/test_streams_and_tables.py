"""Streams equal batch answers; loads are idempotent on re-run."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from eventlens import fixtures as fx
from eventlens.operators import sentiment as S
from eventlens.sinks.writers import insert_ignore_table, merge_insert_only_table
from eventlens.sources.streams import read_prices_csv, read_topic
from eventlens.streaming.jobs import hourly_stream, log_stream, price_stream
from eventlens.operators.prices import normalise_batch_prices

SF = "/root/testdata/sf0.001"


def test_hourly_stream_equals_batch(spark, tmpdir_path):
    posts = fx.posts(spark, SF).withColumns({"sentiment_positive": F.lit(0.0), "sentiment_neutral": F.lit(0.0),
                                             "sentiment_negative": F.lit(0.0), "date_partition": F.to_date("created_at")})
    # several micro-batches, each with posts of all hours: late posts count
    posts.repartition(3, "author_id").write.parquet(f"{tmpdir_path}/in")
    src = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_path}/in")
    hourly_stream(src, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True).awaitTermination()
    parts = spark.read.parquet(f"{tmpdir_path}/out")
    assert parts.select("batch_id").distinct().count() > 1
    rows = lambda df: {(r.hour_timestamp, r.total_tweets, r.negative_tweets, r.total_likes) for r in df.collect()}
    assert rows(S.hourly_merge(parts)) == rows(S.sentiment_hourly(posts))


def test_posts_reach_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert fx.posts(spark, SF, lambda d: d, ("doc_id",)).select("doc_id").distinct().count() == docs


def test_daily_table_loads_read_retention_and_compaction(spark, tmpdir_path):
    from eventlens.sinks.writers import compact, drop_older_than, table_exists, write_daily
    from eventlens.sources.tables import read_daily
    path = f"{tmpdir_path}/daily"
    rows = lambda *days: spark.createDataFrame([(f"{d}-{k}", dt.datetime(2024, 10, d, 3)) for d in days for k in range(3)],
                                               "id string, ts timestamp_ntz")
    assert not table_exists(spark, path)
    write_daily(rows(14, 15), path, "ts", "a")
    write_daily(rows(15), path, "ts", "b")          # another load of the same day adds
    write_daily(rows(15), path, "ts", "b")          # the same load again replaces itself
    assert table_exists(spark, path)
    day = read_daily(spark, path, "2024-10-15", "2024-10-15")
    assert day.count() == 6 and "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().toString()
    assert drop_older_than(spark, path, "dt", "2024-10-15") == ["2024-10-14"]
    compact(spark, path, "dt", dt.date(2024, 10, 15), files=1, sort_cols=["id"])
    assert spark.read.parquet(path).count() == 6
    month = f"{tmpdir_path}/monthly"
    write_daily(rows(14, 15), month, "ts", "a", monthly=True)
    assert read_daily(spark, month, "2024-10", "2024-10", "month").count() == 6
    assert drop_older_than(spark, month, "month", "2024-11-02") == ["2024-10"]


def test_merge_does_not_overwrite_what_it_cannot_read(spark, tmpdir_path):
    import pytest
    table = f"{tmpdir_path}/broken"
    os.makedirs(f"{table}/source=batch")
    with open(f"{table}/source=batch/part-0.parquet", "w") as f:
        f.write("not parquet")
    batch = spark.createDataFrame([(1, "batch")], "trade_id int, source string")
    with pytest.raises(Exception):
        merge_insert_only_table(spark, batch, table)
    assert os.path.exists(f"{table}/source=batch/part-0.parquet")


def test_session_keeps_a_submitted_master(monkeypatch):
    from pyspark.sql import SparkSession
    from eventlens import session
    set_to = {}

    class Builder:
        def appName(self, name):
            return self

        def master(self, value):
            set_to["master"] = value
            return self

        def config(self, key, value):
            set_to[key] = value
            return self

        def getOrCreate(self):
            return SparkSession.getActiveSession()

    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    monkeypatch.delenv("SPARK_DRIVER_MEMORY", raising=False)
    session.get_spark()
    assert "master" not in set_to and "spark.driver.memory" not in set_to


def test_json_errors_keep_their_text(spark):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    from eventlens.sources.streams import decode_json
    schema = StructType([StructField("n", IntegerType()), StructField("s", StringType())])
    lines = ['{"n":1,"s":"a"}', '{"n":"x"}', "[1]", "broken", "{}", None]
    got = decode_json(spark.createDataFrame([(x,) for x in lines], "message string"), schema).collect()
    assert [(r.n, r._json_error) for r in got] == [(1, None), (None, '{"n":"x"}'), (None, "[1]"), (None, "broken"), (None, None), (None, None)]


def test_checks_with_quotes_addresses_and_bare_events(spark):
    from eventlens.functions.security import event_hash, ip_to_long
    from eventlens.operators.quality import Check, run_checks
    from eventlens.operators.security_rules import dedupe_events
    df = spark.createDataFrame([("it's", 1), ("b", 2)], "a string, n int")
    report = run_checks({"m's": df}, [Check("m's", "expression", "a", "a <> 'it''s'")]).collect()
    assert [(r.model, r.failures) for r in report] == [("m's", 1)]
    ips = spark.createDataFrame([("10.0.0.1",), ("10.0.0.300",), ("1.2.3",), ("a.b.c.d",), (None,)], "ip string")
    assert [r[0] for r in ips.select(ip_to_long("ip")).collect()] == [167772161, None, None, None, None]
    ev = spark.createDataFrame([(1, "a", "t"), (2, "a", "t"), (3, "b", "t"), (4, None, None), (5, None, None)], "event_id int, message string, ts string")
    ev = ev.withColumn("event_hash", event_hash("ts", "message"))
    assert sorted(r.event_id for r in dedupe_events(ev).collect()) == [1, 3, 4, 5]


def test_layout_report_and_models(spark, tmpdir_path):
    import pytest
    from eventlens.ml.forest import load_model, score_all
    from eventlens.sinks.writers import create_views, layout, replace_table, write_csv, write_report
    df = spark.range(100).selectExpr("id", "id % 2 AS part")
    layout(df, f"{tmpdir_path}/l", ["part"], ["id"], ["id"], files_per_partition=3)
    assert spark.read.parquet(f"{tmpdir_path}/l").count() == 100
    assert len([f for f in os.listdir(f"{tmpdir_path}/l/part=0") if f.endswith(".parquet")]) <= 3
    write_report(df.limit(1), f"{tmpdir_path}/r")
    assert spark.read.json(f"{tmpdir_path}/r").count() == 1
    with pytest.raises(ValueError):
        write_report(df, f"{tmpdir_path}/r2")
    replace_table(df, f"{tmpdir_path}/t")
    replace_table(df.limit(3), f"{tmpdir_path}/t")
    assert spark.read.parquet(f"{tmpdir_path}/t").count() == 3
    write_csv(df, f"{tmpdir_path}/c")
    assert spark.read.csv(f"{tmpdir_path}/c", header=True).count() == 100
    create_views(spark, {"stg_numbers": df})
    assert spark.table("stg_numbers").count() == 100
    assert load_model(spark, f"{tmpdir_path}/none", "web") is None
    with pytest.raises(ValueError):
        score_all(df, {"web": None})


def test_price_stream_and_batch_merge_twice(spark, tmpdir_path):
    topic = f"{tmpdir_path}/topics/crypto_prices"
    os.makedirs(topic)
    with open(f"{topic}/part-0.json", "w") as f:
        for i, ts in enumerate([1704067200.0, 1704067205.0]):
            payload = {"bitcoin": {"usd": 100.0 + i}, "ethereum": None, "dogecoin": {"usd": 0.1}, "timestamp": ts}
            f.write(json.dumps({"key": None, "value": json.dumps(payload), "timestamp": "2024-01-01T00:00:00Z"}) + "\n")
    table = f"{tmpdir_path}/price_events"
    ticks = read_topic(spark, "crypto_prices", path=f"{tmpdir_path}/topics")
    price_stream(spark, ticks, table, f"{tmpdir_path}/ckpt", available_now=True).awaitTermination()
    csv_dir = f"{tmpdir_path}/csv"
    os.makedirs(csv_dir)
    with open(f"{csv_dir}/h.csv", "w") as f:
        f.write("\ntrade_id,coin_name,price_usd,trade_timestamp\n")
        for i in range(5):
            f.write(f"{i + 1},bitcoin,{40000 + i},{1704067200 + 60 * i}\n")
    batch = normalise_batch_prices(read_prices_csv(spark, f"{csv_dir}/*.csv"))
    first = merge_insert_only_table(spark, batch, table)
    second = merge_insert_only_table(spark, batch, table)
    t = spark.read.parquet(table)
    assert (first, second) == (5, 0)
    assert t.where("source = 'batch'").count() == 5
    assert t.where("source = 'streaming'").count() == 4     # 2 ticks x 2 non-null coins


def test_insert_ignore_second_load_adds_nothing(spark, tmpdir_path):
    inc = fx.incidents(spark, SF)
    path = f"{tmpdir_path}/incidents"
    n1 = insert_ignore_table(spark, inc, path, ("fecha_accidente", "hora_accidente", "latitud", "longitud"),
                             "incident_seq")
    n2 = insert_ignore_table(spark, inc, path, ("fecha_accidente", "hora_accidente", "latitud", "longitud"),
                             "incident_seq")
    keys = inc.select("fecha_accidente", "hora_accidente", "latitud", "longitud").distinct().count()
    assert n1 == keys and n2 == 0 and spark.read.parquet(path).count() == keys


def test_log_stream_routes_and_replays(spark, tmpdir_path):
    logs = fx.sec_logs(spark, SF)
    logs.write.parquet(f"{tmpdir_path}/in")
    src = spark.readStream.schema(logs.schema).parquet(f"{tmpdir_path}/in")
    log_stream(src, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True).awaitTermination()
    store = spark.read.parquet(f"{tmpdir_path}/out/store")
    alerts = spark.read.parquet(f"{tmpdir_path}/out/alerts")
    assert store.count() == logs.count()
    assert alerts.count() == store.where("severity = 'HIGH'").count() > 0
    # a replay of the same batch id overwrites its partition instead of adding rows
    from eventlens.sinks.writers import route
    from eventlens.operators.security_rules import enrich_logs
    route(enrich_logs(logs), 0, f"{tmpdir_path}/out")
    assert spark.read.parquet(f"{tmpdir_path}/out/store").count() == logs.count()


def _json_topic(spark, path, topic, rows):
    os.makedirs(f"{path}/{topic}")
    with open(f"{path}/{topic}/part-0.json", "w") as f:
        for r in rows:
            f.write(json.dumps({"key": None, "value": json.dumps(r), "timestamp": "2024-01-01T00:00:00Z"}) + "\n")
    return read_topic(spark, topic, path=path)


def test_tweet_stream_writes_table_and_topic(spark, tmpdir_path):
    from eventlens.streaming.jobs import tweet_stream
    rows = [{"id": "1", "text": "love this, great", "created_at": "2024-01-15T10:00:00+00:00", "author_id": "a", "lang": "en",
             "public_metrics": {"like_count": 3}}, {"id": "2", "text": None, "created_at": None, "author_id": "b", "lang": "en", "public_metrics": {}}]
    tweets = _json_topic(spark, f"{tmpdir_path}/topics", "tweets", rows)
    schema = "id string, text string, created_at string, author_id string, lang string, public_metrics map<string,int>"
    for q in tweet_stream(spark, tweets, schema, f"{tmpdir_path}/table", f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True):
        q.awaitTermination()
    table = spark.read.parquet(f"{tmpdir_path}/table").collect()
    assert [(r.tweet_id, r.predicted_sentiment, r.like_count, r.retweet_count) for r in table] == [("1", "neutral", 3, 0)]
    topic = spark.read.json(f"{tmpdir_path}/out/processed_tweets").collect()
    assert [(r.key, json.loads(r.value)["author_id"]) for r in topic] == [("1", "a")]


def test_brute_force_stream_equals_batch(spark, tmpdir_path):
    from eventlens.operators.alerts import brute_force
    from eventlens.streaming.jobs import brute_force_stream
    t = dt.datetime(2024, 1, 15, 10)
    rows = [("1.1.1.1", t + dt.timedelta(seconds=10 * k), "FAILED") for k in range(12)]
    rows += [("2.2.2.2", t, "FAILED"), ("9.9.9.9", t + dt.timedelta(hours=2), "SUCCESS"), ("9.9.9.9", t + dt.timedelta(hours=3), "FAILED")]
    logs = spark.createDataFrame(rows, "src_ip string, event_time timestamp, result string")
    logs.coalesce(1).write.parquet(f"{tmpdir_path}/in")
    src = spark.readStream.schema(logs.schema).parquet(f"{tmpdir_path}/in")
    brute_force_stream(src, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True).awaitTermination()
    rows = lambda df: sorted((r.ip, r.window_start, r.failures) for r in df.collect())
    assert rows(spark.read.parquet(f"{tmpdir_path}/out")) == rows(brute_force(logs)) != []


def test_score_stream_writes_alert_records(spark, tmpdir_path):
    from test_ml import _firewall
    from eventlens.ml.forest import fit_forest
    from eventlens.streaming.jobs import score_stream
    logs = _firewall(spark, 600, 20)
    model = fit_forest(logs, "firewall", n_trees=30)
    logs.write.parquet(f"{tmpdir_path}/in")
    src = spark.readStream.schema(logs.schema).parquet(f"{tmpdir_path}/in")
    score_stream(src, {"firewall": model, "web": None}, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True).awaitTermination()
    out = spark.read.parquet(f"{tmpdir_path}/out").collect()
    assert set(range(20)) <= {r.original_log.event_id for r in out}
    assert {r.alert_type for r in out} == {"anomaly_detected"}
    assert all(r.description.startswith("Tráfico de red sospechoso: 10.0.0.1") for r in out)


def test_suppression_state_outlives_a_batch_and_expires(spark, tmpdir_path):
    from eventlens.streaming.jobs import suppress_stream
    t = dt.datetime(2024, 1, 15, 10)
    for k, minutes in enumerate(([0, 5], [10, 16], [600])):
        rows = [("k", t + dt.timedelta(minutes=m), f"log {m}") for m in minutes]
        spark.createDataFrame(rows, "alert_key string, timestamp timestamp, note string").coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/in")
    schema = "alert_key string, timestamp timestamp, note string"
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_path}/in")
    suppress_stream(src, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True, watermark="1 hour").awaitTermination()
    kept = [json.loads(r.alert)["note"] for r in spark.read.parquet(f"{tmpdir_path}/out").where("kept").orderBy("ts").collect()]
    assert kept == ["log 0", "log 16", "log 600"]


def test_late_alerts_are_kept_or_suppressed_but_never_lost(spark, tmpdir_path):
    from eventlens.streaming.jobs import suppress_stream
    t, schema = dt.datetime(2024, 1, 15, 10), "alert_key string, timestamp timestamp, note string"
    # 600 moves the watermark far ahead of the alerts in the two batches after it
    for batch in ([("a", 0)], [("b", 600)], [("c", 100), ("a", 5), ("a", 20)], [("a", 30), ("c", 99), ("d", 1)]):
        rows = [(k, t + dt.timedelta(minutes=m), f"{k} {m}") for k, m in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/in")
        src = spark.readStream.schema(schema).parquet(f"{tmpdir_path}/in")
        suppress_stream(src, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True).awaitTermination()
    got = {json.loads(r.alert)["note"]: r.kept for r in spark.read.parquet(f"{tmpdir_path}/out").collect()}
    assert got == {"a 0": True, "b 600": True, "c 100": True, "a 5": False, "a 20": True, "a 30": False, "c 99": False, "d 1": True}


def test_idle_suppression_state_goes_behind_the_watermark(spark, tmpdir_path, monkeypatch):
    from eventlens.streaming import jobs
    monkeypatch.setattr(jobs, "SUPPRESS_IDLE_MS", 1)
    t, schema = dt.datetime(2024, 1, 15, 10), "alert_key string, timestamp timestamp, note string"
    for batch in ([("a", 0)], [("b", 5)], [("a", 6), ("b", 600)], [("c", 600)], [("c", 601)], [("a", 7), ("b", 601)]):
        rows = [(k, t + dt.timedelta(minutes=m), f"{k} {m}") for k, m in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/in")
        src = spark.readStream.schema(schema).parquet(f"{tmpdir_path}/in")
        jobs.suppress_stream(src, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True).awaitTermination()
    got = {json.loads(r.alert)["note"]: r.kept for r in spark.read.parquet(f"{tmpdir_path}/out").collect()}
    # a 6 meets its state, which is idle but not behind the watermark; a 7 comes when it is both
    assert got == {"a 0": True, "b 5": True, "a 6": False, "b 600": True, "c 600": True, "c 601": False, "a 7": True, "b 601": False}


def test_video_and_incident_sources(spark, tmpdir_path):
    from eventlens.sources.streams import read_incidents_json, read_videos_csv
    with open(f"{tmpdir_path}/v.csv", "w") as f:
        f.write("video_id,trending_date,title,channel_title,category_id,publish_time,tags,views,likes,dislikes,comment_count,"
                "thumbnail_link,comments_disabled,ratings_disabled,video_error_or_removed,description\n"
                'v1,17.14.11,"a ""quoted"", title",ch,22,2017-11-13T17:13:01.000Z,x|y,100,5,1,2,http://t,False,False,False,"two\nlines"\n')
    v = read_videos_csv(spark, f"{tmpdir_path}/v.csv").collect()
    assert [(r.video_id, r.title, r.views, r.description) for r in v] == [("v1", 'a "quoted", title', 100, "two\nlines")]
    with open(f"{tmpdir_path}/i.json", "w") as f:
        for k in range(5):
            f.write(json.dumps({"fecha": f"2024-01-0{k % 3 + 1}", "id": k}) + "\n")
    assert read_incidents_json(spark, f"{tmpdir_path}/i.json").count() == 5
    newest = [(r.fecha, r.id) for r in read_incidents_json(spark, f"{tmpdir_path}/i.json", newest=2).collect()]
    assert newest == [("2024-01-03", 2), ("2024-01-02", 1)]


def test_model_scores_labels_and_fallback(spark):
    from eventlens.functions.text import label_name
    from eventlens.ml.text_model import score_text
    df = spark.createDataFrame([("good",), ("",), (None,), ("boom",)], "text string")

    def factory():
        def model(texts):
            if "boom" in texts:
                raise RuntimeError("model failed")
            return [[{"label": "LABEL_2", "score": 0.9}, {"label": "LABEL_1", "score": 0.06}, {"label": "LABEL_0", "score": 0.04}] for _ in texts]
        return model

    got = {r.text: r for r in score_text(df.where("text is null or text <> 'boom'"), scorer_factory=factory).collect()}
    assert got["good"].predicted_sentiment == "positive" and got[""].predicted_sentiment == "neutral"
    failed = score_text(df.where("text = 'boom'"), scorer_factory=factory).first()
    assert failed.predicted_sentiment == "neutral"
    assert [r[0] for r in spark.createDataFrame([("LABEL_0",), ("Other",)], "l string").select(label_name("l")).collect()] == ["negative", "other"]


def test_recent_prunes_folders(spark, tmpdir_path):
    from eventlens.operators.common import recent
    rows = [(dt.datetime(2024, 1, d, 12), d) for d in range(1, 29)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, n int").withColumn("day", F.to_date("ts"))
    df.write.partitionBy("day").parquet(f"{tmpdir_path}/days")
    out = recent(spark.read.parquet(f"{tmpdir_path}/days"), "ts", hours=24, as_of="2024-01-28 13:00:00", part_col="day")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert [r.n for r in out.collect()] == [28] and "PartitionFilters: [isnotnull(day" in plan


def test_long_events_come_in_parts(spark):
    from eventlens.sources.streams import fold_multiline, running
    lines = spark.range(1, 41).selectExpr("1 AS file_id", "id AS line_no", "CASE WHEN id IN (5, 30) THEN '1.1.1.1 x' ELSE concat('l', id) END AS line")
    got = sorted((r.event_no, r.part, r.first_line, r.n_lines) for r in fold_multiline(lines, max_lines=10).collect())
    assert got == [(0, 0, 1, 4), (1, 0, 5, 10), (1, 1, 15, 10), (1, 2, 25, 5), (2, 0, 30, 10), (2, 1, 40, 1)]
    # chunks of three rows give the same running sums as one window
    run = running(lines, ["file_id"], "line_no", {"s": (F.sum, F.col("line_no")), "m": (F.max, F.when(F.col("line_no") % 7 == 0, F.col("line_no")))}, 3)
    rows = {r.line_no: (r.s, r.m) for r in run.collect()}
    assert all(rows[n] == (n * (n + 1) // 2, n // 7 * 7 or None) for n in range(1, 41))


def test_suppression_of_a_hot_key_goes_by_chunks(spark, tmpdir_path):
    """A key with most alerts of a batch comes in chunks of 50 rows in no order
    of time; the kept rows are those of a plain loop, also over the next batch."""
    from eventlens.streaming.jobs import suppress_stream
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    t, schema = dt.datetime(2024, 1, 15), "alert_key string, timestamp timestamp, note string"
    batches = [[("hot", (i * 7919) % 3000, f"{b} {i}") for i in range(1200)] + [(f"k{i % 9}", i * 3, f"{b} k {i}") for i in range(300)] for b in (0, 1)]
    batches[1].append(("hot", None, "no time"))
    last, want = {}, set()
    for b, rows in enumerate(batches):
        for key, m, note in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[2])):
            if key not in last or m + 2000 * b - last[key] >= 15:
                last[key] = m + 2000 * b
                want.add((key, note))
    want.add(("hot", "no time"))
    try:
        spark.conf.set(name, "50")
        for b, rows in enumerate(batches):
            rows = [(k, None if m is None else t + dt.timedelta(minutes=m + 2000 * b), n) for k, m, n in rows]
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/in")
            src = spark.readStream.schema(schema).parquet(f"{tmpdir_path}/in")
            suppress_stream(src, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True).awaitTermination()
    finally:
        spark.conf.set(name, before)
    out = spark.read.parquet(f"{tmpdir_path}/out").collect()
    assert len(out) == sum(map(len, batches))
    assert {(r.alert_key, json.loads(r.alert)["note"]) for r in out if r.kept} == want


def test_routed_rows_are_not_sorted(spark, tmpdir_path):
    """The batch id is a literal of each write: a persisted one is sorted by."""
    from eventlens.sinks.writers import route
    logs = spark.range(50).select(F.col("id").alias("event_id"), F.when(F.col("id") % 5 == 0, "HIGH").otherwise("LOW").alias("severity"))
    seen, real = [], route.__globals__["overwrite_partitions"]
    route.__globals__["overwrite_partitions"] = lambda df, path, by: (seen.append(df.sort(*by)._jdf.queryExecution().optimizedPlan().toString()), real(df, path, by))
    try:
        route(logs, 3, f"{tmpdir_path}/out")
    finally:
        route.__globals__["overwrite_partitions"] = real
    assert len(seen) == 3 and not any("Sort" in p for p in seen)
    assert {(r.batch_id, r.n) for r in spark.read.parquet(f"{tmpdir_path}/out/store").groupBy("batch_id").agg(F.count("*").alias("n")).collect()} == {(3, 50)}
    assert spark.read.parquet(f"{tmpdir_path}/out/alerts").count() == 10 and spark.read.parquet(f"{tmpdir_path}/out/topic").count() == 50


def test_brute_force_stream_deals_rows_before_windows(spark, tmpdir_path):
    from eventlens.streaming.jobs import brute_force_stream
    t = dt.datetime(2024, 1, 15, 10)
    rows = [(f"10.0.0.{i % 3}", t + dt.timedelta(seconds=7 * i), "FAILED") for i in range(300)]
    spark.createDataFrame(rows, "src_ip string, event_time timestamp, result string").coalesce(1).write.parquet(f"{tmpdir_path}/in")
    src = spark.readStream.schema("src_ip string, event_time timestamp, result string").parquet(f"{tmpdir_path}/in")
    q = brute_force_stream(src, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True)
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    # the rows are exchanged by address and minute below the windows' expansion
    assert plan.index("Expand") < plan.rindex("Exchange") and "REPARTITION_BY_COL" in plan


def test_hourly_topics_of_a_hot_hour_in_chunks(spark, monkeypatch):
    """Chunks of an hour, hours and dates without a time, copies, and texts without keywords."""
    t = dt.datetime(2024, 1, 15, 10)
    rows = [(t + dt.timedelta(minutes=i % 90), dt.date(2024, 1, 15), ("positive", "neutral", "negative")[i % 3], i / 8, 0.25, f"Alpha beta ALPHA the w{'abc'[i % 3] * 3} {i}")
            for i in range(120)] + [(None, None, "neutral", 0.5, None, "alpha"), (t, dt.date(2024, 1, 15), "neutral", 0.5, 0.5, "1 a the"), (t, dt.date(2024, 1, 15), "x", 0.5, 0.5, None)]
    df = spark.createDataFrame(rows, "created_at timestamp_ntz, date_partition date, predicted_sentiment string, sentiment_positive double, "
                                     "sentiment_negative double, text string")
    whole = {tuple(r)[:7]: r.avg_sentiment_score for r in S.trending_topics_hourly(df).collect()}
    monkeypatch.setattr(S, "HOUR_CHUNK", 7)
    out = S.trending_topics_hourly(df)
    got = {tuple(r)[:7]: r.avg_sentiment_score for r in out.collect()}
    assert got.keys() == whole.keys() and all(got[k] is whole[k] or abs(got[k] - whole[k]) < 1e-9 for k in got)
    want = {}
    for at, day, mood, pos, neg, text in rows:
        for word in (text or "").lower().split():
            if len(word) >= 3 and word.isalpha() and word != "the":
                n = want.setdefault((day, at and at.replace(minute=0), word), [0, 0, 0, 0])
                n[0] += 1
                for k, m in enumerate(("positive", "neutral", "negative")):
                    n[k + 1] += mood == m
    assert {k[:3]: list(k[3:]) for k in got} == want
    # no text is sorted or met by a join on a text: the posts are dealt by hour once
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan and "REPARTITION_BY_NUM" in plan


def test_partitions_of_alert_state_follow_the_rows(spark, tmpdir_path, monkeypatch):
    """The states of the alert path are laid out for the rows of a batch, not for
    the session's shuffle partitions, and the session keeps its setting."""
    from eventlens.operators import alerts as AL
    from eventlens.streaming import jobs
    from eventlens.streaming.alerting import enrich_stream, kept_alerts
    monkeypatch.setattr(jobs, "ROWS_A_STATE", 10)
    t = dt.datetime(2024, 1, 15)
    schema = "timestamp timestamp, alert_type string, log_type string, severity string, original_log struct<src_ip:string,threat_type:string>"
    rows = [(t + dt.timedelta(minutes=5 * i), "rule", "web", "HIGH", (f"10.0.0.{i % 3}", "web_attack")) for i in range(48)]
    rows.append((t + dt.timedelta(days=3), "rule", "web", "HIGH", ("heartbeat", None)))
    alerts = spark.createDataFrame(rows, schema)
    alerts = alerts.withColumn("alert_key", AL.alert_key(alerts))
    alerts.write.parquet(f"{tmpdir_path}/in")
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "40")
        n, cores = jobs.state_partitions(spark, len(rows)), spark.sparkContext.defaultParallelism
        assert n % cores == 0 and 5 <= n < 5 + cores and jobs.state_partitions(spark, 1) == cores
        read = lambda folder, schema: spark.readStream.schema(schema).parquet(f"{tmpdir_path}/{folder}")
        jobs.suppress_stream(read("in", alerts.schema), f"{tmpdir_path}/kept", f"{tmpdir_path}/c1", available_now=True,
                             partitions=n).awaitTermination()
        kept = kept_alerts(read("kept", jobs.SUPPRESS_OUT), alerts)
        enrich_stream(kept, read("in", alerts.schema), f"{tmpdir_path}/out", f"{tmpdir_path}/c2", available_now=True,
                      partitions=n).awaitTermination()
        assert spark.conf.get(name) == "40"
    finally:
        spark.conf.set(name, before)
    for state in ("c1/state/0", "c2/state/0", "c2/state/1"):
        assert sorted(int(p) for p in os.listdir(f"{tmpdir_path}/{state}") if p.isdigit()) == list(range(n))
    # every alert is 15 minutes after the one of its address before, so all are kept; 8 lie in two hours
    got = {r.timestamp: r.related_alerts_count for r in spark.read.parquet(f"{tmpdir_path}/out").collect()}
    assert got == {r[0]: min(i // 3, 8) or None for i, r in enumerate(rows[:-1])}
