"""Hand-written rows with known answers (FIXTURES.md section 2)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventlens.functions.text import with_lexicon_sentiment
from eventlens.operators import alerts as AL
from eventlens.operators import incidents as I
from eventlens.operators import prices as P
from eventlens.operators import sentiment as S
from eventlens.operators import videos as V


def test_unpivot_drops_null_prices(spark):
    ticks = spark.createDataFrame(
        [((1.0,), None, (3.0,), 1704067200.0)],
        "bitcoin struct<usd:double>, ethereum struct<usd:double>, dogecoin struct<usd:double>, timestamp double")
    rows = P.unpivot_prices(ticks).collect()
    assert sorted((r.coin, r.price) for r in rows) == [("bitcoin", 1.0), ("dogecoin", 3.0)]
    assert all(r.source == "streaming" and r.trade_id is None for r in rows)
    assert rows[0].event_timestamp == dt.datetime(2024, 1, 1, 0, 0)


def test_video_date_pivot_and_weekday(spark):
    raw = spark.createDataFrame([("17.14.09",), ("95.14.09",), ("xx.99.99",)], "trending_date string")
    d = [r[0] for r in raw.select(V.parse_yy_dd_mm("trending_date")).collect()]
    assert d == [dt.date(2017, 9, 14), dt.date(1995, 9, 14), None]
    day = raw.select(F.date_format(V.parse_yy_dd_mm("trending_date"), "EEEE")).first()[0]
    assert day == "Thursday"


def test_engagement_rate(spark):
    cols = ", ".join(f"{c} string" for c in V.STG_COLUMNS)
    row = {c: None for c in V.STG_COLUMNS}
    row.update(video_id="v1", trending_date="17.14.09", views=100, likes=10, dislikes=1, comment_count=5)
    schema = cols.replace("views string", "views long").replace("likes string", "likes long") \
        .replace("dislikes string", "dislikes long").replace("comment_count string", "comment_count long")
    raw = spark.createDataFrame([tuple(row[c] for c in V.STG_COLUMNS)], schema)
    out = V.fct_video_trends(V.stg_videos(raw)).first()
    assert out.engagement_rate == pytest.approx(0.16)
    assert out.trending_day_of_week == "Thursday"


def test_lexicon_empty_and_tie(spark):
    df = spark.createDataFrame([("",), ("good great excellent amazing love",), ("bad day",)], "text string")
    rows = with_lexicon_sentiment(df, "text").collect()
    e, tie, neg = rows
    assert (e.sentiment_positive, e.sentiment_neutral, e.sentiment_negative) == (0.33, 0.34, 0.33)
    assert (e.predicted_sentiment, e.confidence) == ("neutral", 0.34)
    assert (tie.sentiment_positive, tie.sentiment_neutral, tie.sentiment_negative) == (0.5, 0.5, 0.0)
    assert tie.predicted_sentiment == "positive" and tie.confidence == 0.5
    assert neg.predicted_sentiment == "neutral" and neg.sentiment_negative == pytest.approx(0.1)


def test_lexicon_plan_has_no_python(spark):
    df = spark.createDataFrame([("good",)], "text string")
    plan = with_lexicon_sentiment(df, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def _alerts(spark, minutes, key="k"):
    base = dt.datetime(2024, 1, 15, 10, 0)
    return spark.createDataFrame([(key, base + dt.timedelta(minutes=m), i) for i, m in enumerate(minutes)],
                                 "alert_key string, timestamp timestamp_ntz, seq int")


def test_suppression_batch_keeps_0_20_35(spark):
    a = _alerts(spark, [0, 10, 20, 29, 35]).unionByName(_alerts(spark, [0, 16], key="other"))
    out = AL.suppress_alerts(a, ["alert_key"], "timestamp", 15, order_cols=["seq"])
    kept = sorted((r.alert_key, r.seq) for r in out.where("kept").collect())
    assert kept == [("k", 0), ("k", 2), ("k", 4), ("other", 0), ("other", 1)]


def test_suppression_across_day_buckets(spark):
    # gaps shorter than the window that cross a day boundary stay one segment
    base = dt.datetime(2024, 1, 15, 23, 50)
    rows = [("k", base + dt.timedelta(minutes=m), i) for i, m in enumerate([0, 10, 16, 20, 31, 40])]
    a = spark.createDataFrame(rows, "alert_key string, timestamp timestamp_ntz, seq int")
    out = AL.suppress_alerts(a, ["alert_key"], "timestamp", 15, order_cols=["seq"])
    assert sorted(r.seq for r in out.where("kept").collect()) == [0, 2, 4]


def test_suppression_stream_matches_batch(spark, tmpdir_path):
    from eventlens.streaming.jobs import suppress_stream
    a = _alerts(spark, [0, 10, 20, 29, 35])
    a.write.parquet(f"{tmpdir_path}/in")
    src = spark.readStream.schema(a.schema).parquet(f"{tmpdir_path}/in")
    q = suppress_stream(src, f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", available_now=True)
    q.awaitTermination()
    kept = [r.ts.minute for r in spark.read.parquet(f"{tmpdir_path}/out").where("kept").orderBy("ts").collect()]
    assert kept == [0, 20, 35]


def test_weekday_forms(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 15, 12),)], "ts timestamp_ntz")
    r = df.select(S.iso_weekday(F.col("ts")).alias("iso"), F.weekday("ts").alias("zero"),
                  S.spanish_day_name(S.iso_weekday(F.col("ts"))).alias("name")).first()
    assert (r.iso, r.zero, r.name) == (1, 0, "Lunes")


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "v string")
    assert I.mode_of(df, "v").first()[0] == "a"


def test_insert_ignore_null_keys_never_conflict(spark):
    schema = ("incident_seq long, fecha_accidente date, hora_accidente string, latitud decimal(10,6), "
              "longitud decimal(10,6), comuna string")
    d = dt.date(2024, 1, 1)
    la, lo = Decimal("6.2"), Decimal("-75.6")
    batch = spark.createDataFrame([(1, d, None, la, lo, "a"), (2, d, None, la, lo, "b"),
                                   (3, d, "01:00", la, lo, "c"), (4, d, "01:00", la, lo, "d")], schema)
    empty = spark.createDataFrame([], schema)
    out = I.insert_ignore(empty, batch)
    assert sorted(r.incident_seq for r in out.collect()) == [1, 2, 3]
    again = I.insert_ignore(batch, batch)
    assert sorted(r.incident_seq for r in again.collect()) == [1, 2]


def test_score_severity_bands(spark):
    df = spark.createDataFrame([(0.95,), (0.85,), (0.7,), (0.5,)], "s double")
    assert [r[0] for r in df.select(AL.score_severity("s")).collect()] == ["CRITICAL", "HIGH", "MEDIUM", "LOW"]


def test_channels_and_recommendations(spark):
    df = spark.createDataFrame([("CRITICAL", "brute_force"), ("LOW", None), ("MEDIUM", "x_port_scan")],
                               "severity string, threat string")
    rows = df.select(AL.channels_for("severity").alias("c"), AL.recommendations("threat").alias("r")).collect()
    assert rows[0].c == ["slack", "email", "pagerduty"] and rows[1].c == [] and rows[2].c == ["slack"]
    assert rows[0].r[0] == AL.RECOMMENDATIONS[0][1][0]
    assert rows[1].r == AL.DEFAULT_RECOMMENDATIONS
    assert rows[2].r[0] == AL.RECOMMENDATIONS[2][1][0]


def test_a_key_that_never_rests_keeps_every_fifteenth_minute(spark):
    # an alert every minute for ten days: one chain of 960 kept alerts
    a = spark.range(14400).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 60 + 1700000000).alias("ts"), "id")
    out = AL.suppress_alerts(a, ["k"], "ts", 15, ["id"])
    assert sorted(r.id for r in out.where("kept").collect()) == list(range(0, 14400, 15))


def test_suppression_ties_and_missing_times(spark):
    t = dt.datetime(2024, 1, 15)
    a = spark.createDataFrame([("k", t, 2), ("k", t, 1), ("k", None, 3), (None, t, 4)], "k string, ts timestamp_ntz, id int")
    out = AL.suppress_alerts(a, ["k"], "ts", 15, ["id"])
    assert sorted(r.id for r in out.where("kept").collect()) == [1, 3, 4] and out.count() == 4


def test_work_on_texts_runs_once_a_document(spark):
    """The exchange above the per-text columns keeps them below the join."""
    from eventlens import fixtures as fx
    from eventlens.functions.text import clean_text
    df = fx.posts(spark, "/root/testdata/sf0.001", lambda d: d.withColumn("cleaned", clean_text("text")), ("cleaned",))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    at = plan.index("RepartitionByExpression")
    assert plan.index("Join") < at < plan.index("regexp_replace")
    assert "regexp_replace" not in plan[:at]
