"""Registered queries over tables that are kept up to date: merged while a
stream writes, versioned, checked on arrival, summarised and clustered."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from eventlens import fixtures as fx
from eventlens.functions.text import TRENDING_STOP_WORDS
from eventlens.operators import keywords as KW
from eventlens.operators import sentiment as S
from eventlens.operators import videos as V
from eventlens.operators.quality import video_suite
from eventlens.plans.lake_queries import _QSQL
from eventlens.plans.registry import query
from eventlens.plans.sentiment_queries import MERGED_HOURLY_DOUBLES, MERGED_HOURLY_SQL, _scored, _sql_list, with_author_bound
from eventlens.session import checkpoint_path
from eventlens.sinks.merged import compact_parts, compact_versions, latest, read_parts, upsert
from eventlens.sinks.skipping import cluster, lookup_cost, row_groups
from eventlens.sinks.writers import staged
from eventlens.sources.streams import batch_files
from eventlens.sources.tables import read_parquet_table
from eventlens.streaming.checks import check_stream, stream_report
from eventlens.streaming.jobs import hourly_stream


def _scratch(spark, name):
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("live_hours", MERGED_HOURLY_SQL, fixtures=["sentiment"], doubles=MERGED_HOURLY_DOUBLES)
def q_live_hours(spark, sf):
    """Hourly parts merged between the micro-batches of the stream that
    writes them, each time twice; posts are dealt by author, so hours meet."""
    base = _scratch(spark, "live-hours")
    cols = ["created_at", "date_partition", "predicted_sentiment", "sentiment_positive", "sentiment_neutral",
            "sentiment_negative", "confidence", "like_count", "retweet_count", "author_id"]
    fx.sentiment_table(spark, sf).select(*cols, F.pmod(F.xxhash64("author_id"), F.lit(3)).alias("load")).write.partitionBy("load").parquet(f"{base}/all")
    posts = spark.read.parquet(f"{base}/all")
    for k in range(3):
        posts.where(F.col("load") == k).select(*cols).write.mode("append").parquet(f"{base}/in")
        src = spark.readStream.schema(posts.select(*cols).schema).parquet(f"{base}/in")
        hourly_stream(src, f"{base}/parts", f"{base}/ckpt", available_now=True).awaitTermination()
        for _ in range(2):
            compact_parts(spark, f"{base}/parts", f"{base}/merged", S.merge_hourly_partials)
    return with_author_bound(S.hourly_merge(read_parts(spark, f"{base}/parts", f"{base}/merged")), posts.select(*cols))


@query("author_table", """
SELECT author_id, date_partition, total_tweets, total_likes FROM (
  SELECT author_id, date_partition, COUNT(*) AS total_tweets, CAST(SUM(like_count) AS BIGINT) AS total_likes,
         ROW_NUMBER() OVER (PARTITION BY author_id ORDER BY date_partition DESC) AS rn
  FROM sentiment GROUP BY author_id, date_partition) a WHERE rn = 1
""", fixtures=["sentiment"])
def q_author_table(spark, sf):
    """A04, W02 as a table: the later half of the days loaded first, then the
    earlier one, compaction, the later half again, compaction."""
    base = _scratch(spark, "author-table")
    S.author_metrics(_scored(spark, sf)).select("author_id", "date_partition", "total_tweets", "total_likes").write.parquet(f"{base}/in")
    m, path = spark.read.parquet(f"{base}/in"), f"{base}/table"
    late = F.dayofmonth("date_partition") > 15
    upsert(m.where(late), path, "author_id", "date_partition", "late")
    upsert(m.where(~late), path, "author_id", "date_partition", "early")
    compact_versions(spark, path, "author_id", "date_partition")
    upsert(m.where(late), path, "author_id", "date_partition", "late")
    compact_versions(spark, path, "author_id", "date_partition")
    return latest(spark, path, "author_id", "date_partition").select("author_id", "date_partition", "total_tweets", "total_likes")


@query("stream_checks", f"""
SELECT model, check_name, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status
FROM ({_QSQL}) r
""", fixtures=["videos_fct"])
def q_stream_checks(spark, sf):
    """Q02 to Q06 on arriving rows: the video models' suite, observed while the
    rows are written in three micro-batches."""
    base = _scratch(spark, "stream-checks")
    stg = V.stg_videos(fx.videos_raw(spark, sf))
    n = stg.count()  # the facts are no more than the staged rows
    files = {"stg_videos": batch_files(stg, f"{base}/in/stg_videos", n)}
    files["fct_video_trends"] = batch_files(V.fct_video_trends(spark.read.parquet(f"{base}/in/stg_videos")), f"{base}/in/fct_video_trends", n)
    out = None
    for model in ("stg_videos", "fct_video_trends"):
        path = f"{base}/in/{model}"
        src = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files[model]).parquet(path)
        check_stream(src, model, video_suite(), f"{base}/out/{model}", f"{base}/report/{model}", f"{base}/ckpt/{model}",
                     available_now=True).awaitTermination()
        report = stream_report(spark, model, video_suite(), f"{base}/report/{model}")
        out = report if out is None else out.unionByName(report)
    return out


@query("keyword_search", r"""
SELECT d.doc_id, k.keyword
FROM documents d, (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS keyword FROM benchmark) k
WHERE d.lang = 'en' AND NOT starts_with(d.text, 'RT @') AND k.keyword <> '' AND contains(lower(d.text), k.keyword)
""")
def q_keyword_search(spark, sf):
    """P10 with a table of keywords: every word of the benchmark items is looked
    for in every English document in one pass."""
    kws = read_parquet_table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("keyword"))
    docs = read_parquet_table(spark, sf, "documents").select("doc_id", "text", "lang")
    return KW.keyword_search(docs, kws).select("doc_id", "keyword")


ITEMS = 512


@query("topics_summary", f"""
WITH w AS (SELECT date_partition, date_trunc('hour', created_at) AS hour_timestamp, keyword
           FROM (SELECT created_at, date_partition, unnest(regexp_extract_all(lower(text), '[a-zA-Z]{{3,}}')) AS keyword FROM sentiment) x
           WHERE keyword NOT IN ({_sql_list(TRENDING_STOP_WORDS)})),
h AS (SELECT date_partition, hour_timestamp, COUNT(*) AS n FROM w GROUP BY 1, 2),
k AS (SELECT date_partition, hour_timestamp, keyword, COUNT(*) AS mention_count FROM w GROUP BY 1, 2, 3)
SELECT date_partition, hour_timestamp, keyword, mention_count, TRUE AS within_bound
FROM k JOIN h USING (date_partition, hour_timestamp) WHERE mention_count > 2 * ceil(n * {KW.summary_error(ITEMS)!r})
""", fixtures=["sentiment"])
def q_topics_summary(spark, sf):
    """A03 as mergeable summaries of two loads: every keyword mentioned more than
    twice the bound is there, and its estimate is within the bound."""
    base = _scratch(spark, "topics")
    posts = _scored(spark, sf)
    load = F.pmod(F.xxhash64("post_id"), F.lit(2)).alias("load")
    KW.topics_summary(posts.where(load == 0), ITEMS).write.parquet(f"{base}/parts")
    KW.topics_summary(posts.where(load == 1), ITEMS).write.mode("append").parquet(f"{base}/parts")
    merged = KW.merge_summaries(spark.read.parquet(f"{base}/parts"), ITEMS)
    found = KW.frequent_keywords(merged, ITEMS)
    key = ["date_partition", "hour_timestamp", "keyword"]
    exact = S.trending_topics_hourly(posts).select(*key, "mention_count")
    hours = merged.select("date_partition", "hour_timestamp", F.ceil(F.col("mentions") * F.lit(KW.summary_error(ITEMS))).alias("_b"))
    # one row for each hour there is
    must = exact.join(F.broadcast(hours), key[:2]).where(F.col("mention_count") > 2 * F.col("_b"))
    near = F.abs(F.col("mentions_estimate") - F.col("mention_count")) <= F.col("_b")
    return must.join(found, key, "left").select(*key, "mention_count", F.coalesce(near, F.lit(False)).alias("within_bound"))


#: rows of a clustered file where 32 files would have more
CLUSTER_ROWS = 1_000_000


@query("skipping", """
SELECT 'l_partkey' AS column_name, CAST(COUNT(*) AS BIGINT) AS n_rows, TRUE AS fewer_than_half, TRUE AS same_rows FROM lineitem
UNION ALL SELECT 'l_suppkey', COUNT(*), TRUE, TRUE FROM lineitem
""")
def q_skipping(spark, sf):
    """Line items clustered by part and supplier; a lookup of any value of
    either column meets, in the mean, less than half of the files and row groups
    that it meets in the same rows dealt at random."""
    base = _scratch(spark, "skipping")
    cols = ("l_partkey", "l_suppkey")
    rows = read_parquet_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *cols)
    files = max(32, -(-rows.count() // CLUSTER_ROWS))
    rows.repartition(files).write.parquet(f"{base}/plain")
    cluster(rows, f"{base}/clustered", cols, files=files)
    plain, clustered = spark.read.parquet(f"{base}/plain"), spark.read.parquet(f"{base}/clustered")
    total = lambda df: df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("s"))
    same = total(plain).crossJoin(total(clustered).select(F.col("n").alias("n2"), F.col("s").alias("s2")))  # one row each
    groups = [staged(row_groups(spark, f"{base}/{t}", cols), "groups") for t in ("plain", "clustered")]
    out = None
    for c in cols:
        values = plain.select(F.col(c).alias("value"))
        a = lookup_cost(groups[0], c, values).agg(F.avg("files").alias("f"), F.avg("row_groups").alias("g"))
        b = lookup_cost(groups[1], c, values).agg(F.avg("files").alias("f2"), F.avg("row_groups").alias("g2"))
        one = a.crossJoin(b).crossJoin(same).select(
            F.lit(c).alias("column_name"), F.col("n2").alias("n_rows"), ((F.col("f2") * 2 < F.col("f")) & (F.col("g2") * 2 < F.col("g"))).alias("fewer_than_half"),
            ((F.col("n") == F.col("n2")) & F.col("s").eqNullSafe(F.col("s2"))).alias("same_rows"))
        out = one if out is None else out.unionByName(one)
    return out
