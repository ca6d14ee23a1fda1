"""Registered sentiment reports over the tweet stand-in (``posts``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens import fixtures as fx
from eventlens.functions.text import (EXPLORE_STOP_WORDS, NEGATIVE_WORDS, POSITIVE_WORDS, TRENDING_STOP_WORDS,
                                      clean_text, with_lexicon_sentiment)
from eventlens.operators import sentiment as S
from eventlens.plans.fixture_sql import AS_OF_SQL
from eventlens.plans.registry import query

AS_OF = fx.AS_OF
AS_OF_DATE = "2024-01-31"


def _sql_list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _scored(spark, sf):
    return fx.sentiment_table(spark, sf)


TRENDING_SQL = f"""
SELECT word, COUNT(*) AS total_mentions,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive_mentions,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative_mentions,
       (COUNT(*) FILTER (WHERE predicted_sentiment = 'positive')
        - COUNT(*) FILTER (WHERE predicted_sentiment = 'negative')) / COUNT(*) AS sentiment_score
FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-zA-Z]{{3,}}')) AS word, predicted_sentiment
      FROM sentiment WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 24 HOUR) w
WHERE word NOT IN ({_sql_list(TRENDING_STOP_WORDS)})
GROUP BY word HAVING COUNT(*) >= 5
ORDER BY total_mentions DESC, word LIMIT 20
"""


@query("trending_words", TRENDING_SQL, fixtures=["sentiment"], doubles=["sentiment_score"])
def q_trending_words(spark, sf):
    """A07 trending words of the last 24 hours."""
    return S.trending_words(_scored(spark, sf), AS_OF)


_WORDS_SQL = f"""
SELECT word, predicted_sentiment, COUNT(*) AS frequency
FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-zA-Z]{{4,}}')) AS word, predicted_sentiment
      FROM posts WHERE created_at >= {AS_OF_SQL} - INTERVAL 24 HOUR) w
WHERE word NOT IN ({_sql_list(EXPLORE_STOP_WORDS)})
GROUP BY word, predicted_sentiment HAVING COUNT(*) >= 3
ORDER BY frequency DESC, word, predicted_sentiment LIMIT 50
"""


@query("words_by_sentiment", _WORDS_SQL, fixtures=["posts"])
def q_words_by_sentiment(spark, sf):
    """A08 top 50 (word, sentiment) pairs."""
    return S.words_by_sentiment(fx.posts(spark, sf), AS_OF)


@query("top_words_per_sentiment", f"""
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY predicted_sentiment ORDER BY frequency DESC, word) AS rank
               FROM ({_WORDS_SQL}) t) r WHERE rank <= 10
""", fixtures=["posts"])
def q_top_words_per_sentiment(spark, sf):
    """A08/W03 ten words per sentiment."""
    return S.top_words_per_sentiment(fx.posts(spark, sf), AS_OF).withColumn("rank", F.col("rank").cast("bigint"))


_HOURLY_SQL = """
SELECT date_trunc('hour', created_at) AS hour_timestamp, date_partition,
       COUNT(*) AS total_tweets,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive_tweets,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'neutral') AS neutral_tweets,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative_tweets,
       AVG(sentiment_positive) AS avg_positive_score, AVG(sentiment_neutral) AS avg_neutral_score,
       AVG(sentiment_negative) AS avg_negative_score, AVG(confidence) AS avg_confidence,
       CAST(SUM(like_count) AS BIGINT) AS total_likes, CAST(SUM(retweet_count) AS BIGINT) AS total_retweets,
       COUNT(DISTINCT author_id) AS unique_authors
FROM sentiment GROUP BY 1, 2
"""


@query("sentiment_hourly", _HOURLY_SQL, fixtures=["sentiment"],
       doubles=["avg_positive_score", "avg_neutral_score", "avg_negative_score", "avg_confidence"])
def q_sentiment_hourly(spark, sf):
    """A01 hourly view over the whole table."""
    return S.sentiment_hourly(_scored(spark, sf))


def with_author_bound(merged, posts):
    """Replaces the author estimate by whether it lies within 10 % (or two) of
    the exact count of ``posts``."""
    exact = (posts.groupBy(F.date_trunc("hour", "created_at").alias("hour_timestamp"), "date_partition")
             .agg(F.count_distinct("author_id").alias("authors")))
    near = F.abs(F.col("unique_authors") - F.col("authors")) <= F.greatest(F.lit(2.0), 0.1 * F.col("authors"))
    return (merged.join(exact, ["hour_timestamp", "date_partition"], "left")
            .withColumn("authors_in_bound", F.coalesce(near, F.lit(False))).drop("unique_authors", "authors"))


MERGED_HOURLY_SQL = f"""
SELECT hour_timestamp, date_partition, total_tweets, positive_tweets, neutral_tweets, negative_tweets,
       avg_positive_score, avg_neutral_score, avg_negative_score, avg_confidence, total_likes, total_retweets,
       TRUE AS authors_in_bound
FROM ({_HOURLY_SQL}) h
"""
MERGED_HOURLY_DOUBLES = ["avg_positive_score", "avg_neutral_score", "avg_negative_score", "avg_confidence"]


@query("hourly_partials", MERGED_HOURLY_SQL, fixtures=["sentiment"], doubles=MERGED_HOURLY_DOUBLES)
def q_hourly_partials(spark, sf):
    """A02 mergeable hourly parts of two loads, merged back."""
    posts = _scored(spark, sf)
    half = F.pmod(F.xxhash64("post_id"), F.lit(2)) == 0
    parts = S.hourly_partials(posts.where(half)).unionByName(S.hourly_partials(posts.where(~half)))
    return with_author_bound(S.hourly_merge(parts), posts)


@query("hourly_trends", f"""
SELECT hour_timestamp, total_tweets, positive_tweets, neutral_tweets, negative_tweets,
       avg_confidence, total_likes, total_retweets
FROM ({_HOURLY_SQL}) h WHERE date_partition >= DATE '{AS_OF_DATE}' - 7
ORDER BY hour_timestamp DESC LIMIT 168
""", fixtures=["sentiment"], doubles=["avg_confidence"])
def q_hourly_trends(spark, sf):
    """T03 latest 168 hours of the hourly view."""
    return S.hourly_trends(S.sentiment_hourly(_scored(spark, sf)), AS_OF_DATE)


HEALTH_SQL = f"""
SELECT total_tweets, positive_tweets, neutral_tweets, negative_tweets,
       ROUND(CASE WHEN total_tweets > 0 THEN positive_tweets * 100.0 / total_tweets ELSE 0.0 END, 2) AS positive_rate_pct,
       ROUND(CASE WHEN total_tweets > 0 THEN negative_tweets * 100.0 / total_tweets ELSE 0.0 END, 2) AS negative_rate_pct,
       COALESCE(ROUND(raw_confidence, 3), 0.0) AS avg_confidence,
       total_likes, total_retweets, unique_authors, tweets_last_hour,
       CASE WHEN total_tweets = 0 THEN '{S.HEALTH_CRITICAL}'
            WHEN tweets_last_hour = 0 THEN '{S.HEALTH_NO_HOUR}'
            WHEN raw_confidence IS NOT NULL AND raw_confidence <> 0 AND raw_confidence < 0.5 THEN '{S.HEALTH_LOW_CONF}'
            WHEN total_tweets < 100 THEN '{S.HEALTH_LOW_VOLUME}'
            ELSE '{S.HEALTH_OK}' END AS health_status
FROM (SELECT COUNT(*) AS total_tweets,
             COUNT(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive_tweets,
             COUNT(*) FILTER (WHERE predicted_sentiment = 'neutral') AS neutral_tweets,
             COUNT(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative_tweets,
             AVG(confidence) AS raw_confidence,
             CAST(COALESCE(SUM(like_count), 0) AS BIGINT) AS total_likes,
             CAST(COALESCE(SUM(retweet_count), 0) AS BIGINT) AS total_retweets,
             COUNT(DISTINCT author_id) AS unique_authors,
             COUNT(*) FILTER (WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 1 HOUR) AS tweets_last_hour
      FROM sentiment WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 24 HOUR) a
"""


@query("pipeline_health", HEALTH_SQL, fixtures=["sentiment"], doubles=["positive_rate_pct", "negative_rate_pct", "avg_confidence"])
def q_pipeline_health(spark, sf):
    """A05 pipeline health."""
    return S.pipeline_health(_scored(spark, sf), AS_OF)


@query("hour_monitor", f"""
SELECT *, total_tweets = 0 AS warn_no_tweets,
       COALESCE(avg_confidence < 0.5 AND avg_confidence <> 0, FALSE) AS warn_low_confidence
FROM (SELECT COUNT(*) AS total_tweets,
             COUNT(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive_tweets,
             COUNT(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative_tweets,
             AVG(confidence) AS avg_confidence
      FROM sentiment WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 1 HOUR) a
""", fixtures=["sentiment"], doubles=["avg_confidence"])
def q_hour_monitor(spark, sf):
    """A06 last-hour monitor."""
    return S.hour_monitor(_scored(spark, sf), AS_OF)


@query("top_influencers", f"""
SELECT author_id, COUNT(*) AS tweet_count, CAST(SUM(like_count + retweet_count) AS BIGINT) AS total_engagement,
       AVG(confidence) AS avg_confidence,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'positive') / COUNT(*) AS positive_rate
FROM sentiment WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 24 HOUR
GROUP BY author_id HAVING COUNT(*) >= 2
ORDER BY total_engagement DESC, author_id LIMIT 10
""", fixtures=["sentiment"], doubles=["avg_confidence", "positive_rate"])
def q_top_influencers(spark, sf):
    """A09 top influencers."""
    return S.top_influencers(_scored(spark, sf), AS_OF)


@query("top_authors", f"""
SELECT author_id, CAST(SUM(like_count + retweet_count) AS BIGINT) AS total_engagement, COUNT(*) AS tweet_count
FROM sentiment WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 24 HOUR
GROUP BY author_id ORDER BY total_engagement DESC, author_id LIMIT 10
""", fixtures=["sentiment"])
def q_top_authors(spark, sf):
    """A10 dashboard top authors."""
    return S.top_authors(_scored(spark, sf), AS_OF)


@query("sentiment_distribution", f"""
SELECT predicted_sentiment, COUNT(*) AS count FROM sentiment
WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 24 HOUR GROUP BY predicted_sentiment
""", fixtures=["sentiment"])
def q_sentiment_distribution(spark, sf):
    """A11 label distribution."""
    return S.sentiment_distribution(_scored(spark, sf), AS_OF)


@query("volume_by_hour", f"""
SELECT date_trunc('hour', created_at) AS hour, COUNT(*) AS total_tweets,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'neutral') AS neutral,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative
FROM posts WHERE created_at >= {AS_OF_SQL} - INTERVAL 24 HOUR GROUP BY 1 ORDER BY 1
""", fixtures=["posts"])
def q_volume_by_hour(spark, sf):
    """A12 hourly volume."""
    return S.volume_by_hour(fx.posts(spark, sf), AS_OF)


@query("confidence_stats", f"""
SELECT predicted_sentiment, AVG(confidence) AS avg_confidence,
       quantile_cont(confidence, 0.5) AS median_confidence,
       MIN(confidence) AS min_confidence, MAX(confidence) AS max_confidence, COUNT(*) AS count
FROM posts WHERE created_at >= {AS_OF_SQL} - INTERVAL 24 HOUR GROUP BY predicted_sentiment
""", fixtures=["posts"], doubles=["avg_confidence", "median_confidence", "min_confidence", "max_confidence"])
def q_confidence_stats(spark, sf):
    """A13 confidence statistics."""
    return S.confidence_stats(fx.posts(spark, sf), AS_OF, exact=True)


@query("confidence_sketches", """
SELECT predicted_sentiment, COUNT(*) AS n, AVG(confidence) AS mean, stddev_pop(confidence) AS deviation, MIN(confidence) AS low, MAX(confidence) AS high,
       TRUE AS median_in_bound
FROM sentiment GROUP BY predicted_sentiment
""", fixtures=["sentiment"], doubles=["mean", "deviation", "low", "high"])
def q_confidence_sketches(spark, sf):
    """A13 from daily KLL sketches, stored and merged: the median's rank among
    all values is within the stated bound of one half."""
    from eventlens.sinks.writers import staged
    rows = _scored(spark, sf).select("predicted_sentiment", "date_partition", "confidence")
    merged = S.merged_confidence(staged(S.confidence_sketches(rows), "confidence"))
    at = F.col("confidence") < F.col("median")
    rank = rows.join(merged.select("predicted_sentiment", "median"), "predicted_sentiment").groupBy("predicted_sentiment").agg(
        F.avg(at.cast("int")).alias("below"), F.avg((F.col("confidence") <= F.col("median")).cast("int")).alias("upto"))
    bound = (F.col("below") <= 0.5 + S.RANK_ERROR) & (F.col("upto") >= 0.5 - S.RANK_ERROR)
    return merged.join(rank, "predicted_sentiment").select("predicted_sentiment", "n", "mean", "deviation", "low", "high", bound.alias("median_in_bound"))


@query("engagement_by_sentiment", f"""
SELECT predicted_sentiment, AVG(like_count) AS avg_likes, AVG(retweet_count) AS avg_retweets,
       AVG(like_count + retweet_count) AS avg_total_engagement
FROM posts WHERE created_at >= {AS_OF_SQL} - INTERVAL 24 HOUR AND (like_count > 0 OR retweet_count > 0)
GROUP BY predicted_sentiment
""", fixtures=["posts"], doubles=["avg_likes", "avg_retweets", "avg_total_engagement"])
def q_engagement_by_sentiment(spark, sf):
    """A14 engagement by sentiment."""
    return S.engagement_by_sentiment(fx.posts(spark, sf), AS_OF)


@query("by_weekday", f"""
SELECT isodow(created_at) AS day_of_week, COUNT(*) AS total_tweets, AVG(confidence) AS avg_confidence,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'positive') / COUNT(*) AS positive_rate,
       CASE isodow(created_at) WHEN 1 THEN 'Lunes' WHEN 2 THEN 'Martes' WHEN 3 THEN 'Miércoles'
            WHEN 4 THEN 'Jueves' WHEN 5 THEN 'Viernes' WHEN 6 THEN 'Sábado' ELSE 'Domingo' END AS day_name
FROM posts WHERE created_at >= {AS_OF_SQL} - INTERVAL 7 DAY GROUP BY 1, 5 ORDER BY 1
""", fixtures=["posts"], doubles=["avg_confidence", "positive_rate"])
def q_by_weekday(spark, sf):
    """A15 weekday profile."""
    return S.by_weekday(fx.posts(spark, sf), AS_OF).withColumn("day_of_week", F.col("day_of_week").cast("bigint"))


@query("executive_summary", f"""
SELECT COUNT(*) AS total_tweets,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'positive') / COUNT(*) * 100 AS positive_pct,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'negative') / COUNT(*) * 100 AS negative_pct,
       AVG(confidence) AS avg_confidence,
       CAST(SUM(like_count + retweet_count) AS BIGINT) AS total_engagement,
       COUNT(DISTINCT author_id) AS unique_authors
FROM posts WHERE created_at >= {AS_OF_SQL} - INTERVAL 24 HOUR
""", fixtures=["posts"], doubles=["positive_pct", "negative_pct", "avg_confidence"])
def q_executive_summary(spark, sf):
    """A16 executive summary."""
    return S.executive_summary(fx.posts(spark, sf), AS_OF)


@query("dashboard_scalars", f"""
SELECT *,
       CASE WHEN tweets_last_hour < 100 THEN 'red' WHEN tweets_last_hour < 500 THEN 'yellow' ELSE 'green' END AS volume_band,
       CASE WHEN avg_confidence_last_hour IS NULL THEN NULL WHEN avg_confidence_last_hour < 0.5 THEN 'red'
            WHEN avg_confidence_last_hour < 0.8 THEN 'yellow' ELSE 'green' END AS confidence_band
FROM (SELECT COUNT(*) FILTER (WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 1 HOUR) AS tweets_last_hour,
             AVG(CASE WHEN processing_timestamp >= {AS_OF_SQL} - INTERVAL 1 HOUR THEN confidence END) AS avg_confidence_last_hour,
             CAST(SUM(like_count + retweet_count) AS BIGINT) AS engagement_24h
      FROM sentiment WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 24 HOUR) a
""", fixtures=["sentiment"], doubles=["avg_confidence_last_hour"])
def q_dashboard_scalars(spark, sf):
    """A17 dashboard single values and colour bands."""
    return S.dashboard_scalars(_scored(spark, sf), AS_OF)


@query("negative_alerts", f"""
SELECT post_id, created_at, text, confidence FROM sentiment
WHERE predicted_sentiment = 'negative' AND confidence > 0.8
  AND processing_timestamp >= {AS_OF_SQL} - INTERVAL 1 HOUR
ORDER BY created_at DESC, post_id LIMIT 20
""", fixtures=["sentiment"], doubles=["confidence"])
def q_negative_alerts(spark, sf):
    """P17 negative high-confidence posts of the last hour."""
    return S.negative_alerts(_scored(spark, sf), AS_OF)


@query("author_metrics", """
SELECT date_partition, author_id, COUNT(*) AS total_tweets, CAST(SUM(like_count) AS BIGINT) AS total_likes,
       CAST(SUM(retweet_count) AS BIGINT) AS total_retweets,
       AVG(sentiment_positive - sentiment_negative) AS avg_sentiment_score,
       CAST(NULL AS DOUBLE) AS follower_impact_score
FROM sentiment GROUP BY date_partition, author_id
""", fixtures=["sentiment"], doubles=["avg_sentiment_score", "follower_impact_score"])
def q_author_metrics(spark, sf):
    """A04 author metrics per day over the whole table."""
    return S.author_metrics(_scored(spark, sf))


@query("trending_topics_hourly", f"""
SELECT date_partition, date_trunc('hour', created_at) AS hour_timestamp, keyword,
       COUNT(*) AS mention_count,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive_mentions,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'neutral') AS neutral_mentions,
       COUNT(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative_mentions,
       AVG(score) AS avg_sentiment_score
FROM (SELECT created_at, date_partition, predicted_sentiment, sentiment_positive - sentiment_negative AS score,
             unnest(regexp_extract_all(lower(text), '[a-zA-Z]{{3,}}')) AS keyword FROM sentiment) w
WHERE keyword NOT IN ({_sql_list(TRENDING_STOP_WORDS)})
GROUP BY 1, 2, 3
""", fixtures=["sentiment"], doubles=["avg_sentiment_score"])
def q_trending_topics_hourly(spark, sf):
    """A03 hour x keyword mentions over the whole table (whole texts)."""
    return S.trending_topics_hourly(_scored(spark, sf))


_LEX_POS = fx.COMMON_POSITIVE
_LEX_NEG = fx.COMMON_NEGATIVE


@query("lexicon_sentiment", """
SELECT post_id, sentiment_positive AS positive, sentiment_neutral AS neutral, sentiment_negative AS negative,
       CASE WHEN sentiment_positive >= sentiment_neutral AND sentiment_positive >= sentiment_negative THEN 'positive'
            WHEN sentiment_neutral >= sentiment_negative THEN 'neutral' ELSE 'negative' END AS predicted_sentiment,
       CASE WHEN sentiment_positive >= sentiment_neutral AND sentiment_positive >= sentiment_negative THEN sentiment_positive
            WHEN sentiment_neutral >= sentiment_negative THEN sentiment_neutral ELSE sentiment_negative END AS confidence
FROM sentiment
""", fixtures=["sentiment"], doubles=["positive", "neutral", "negative", "confidence"])
def q_lexicon_sentiment(spark, sf):
    """F03 lexicon scores for every post (whole texts), common-word lists."""
    cols = ("positive", "neutral", "negative", "label", "sureness")
    s = fx.posts(spark, sf, lambda d: with_lexicon_sentiment(d, "text", _LEX_POS, _LEX_NEG, prefix="").withColumnsRenamed(
        {"predicted_sentiment": "label", "confidence": "sureness"}), cols)
    return s.select("post_id", "positive", "neutral", "negative", F.col("label").alias("predicted_sentiment"), F.col("sureness").alias("confidence"))


KEYWORDS = ("market", "the", "que", "und")


@query("keyword_filter", f"""
SELECT post_id, created_at, author_id, k.keyword
FROM posts p, (SELECT unnest([{_sql_list(KEYWORDS)}]) AS keyword) k
WHERE p.lang = 'en' AND NOT starts_with(p.text, 'RT @') AND contains(lower(p.text), k.keyword)
""", fixtures=["posts"])
def q_keyword_filter(spark, sf):
    """P10 keyword search, English, no retweets, all matches."""
    out = S.keyword_filter(fx.posts(spark, sf), KEYWORDS)
    return out.select("post_id", "created_at", "author_id", "keyword")


@query("clean_text", r"""
SELECT post_id, trim(regexp_replace(regexp_replace(regexp_replace(text, 'http\S+|www\S+|https\S+', '', 'g'),
                                                   '[^\p{L}\p{N}\p{M}_\s@#]', ' ', 'g'), '\s+', ' ', 'g')) AS clean_text
FROM posts
""", fixtures=["posts"])
def q_clean_text(spark, sf):
    """F01 cleaned text of every post, whole texts."""
    return fx.posts(spark, sf, lambda d: d.withColumn("clean", clean_text("text")), ("clean",)).select(
        "post_id", F.col("clean").alias("clean_text"))


@query("trending_hashtags", f"""
SELECT hashtag, COUNT(*) AS mentions FROM (
  SELECT lower(unnest(regexp_extract_all(text || ' #Café' || CAST(like_count % 7 AS VARCHAR) || ' #tag_' || CAST(retweet_count % 5 AS VARCHAR) || '.',
                                         '#([\\p{{L}}\\p{{M}}\\p{{N}}_]+)', 1))) AS hashtag FROM sentiment
  WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 24 HOUR) h
GROUP BY hashtag ORDER BY mentions DESC, hashtag LIMIT 10
""", fixtures=["sentiment"])
def q_trending_hashtags(spark, sf):
    """D03 most used hashtags of the last 24 hours (each post gets two, one
    with an accent: the stand-in texts have none)."""
    tags = F.concat(F.col("text"), F.lit(" #Café"), (F.col("like_count") % 7).cast("string"),
                    F.lit(" #tag_"), (F.col("retweet_count") % 5).cast("string"), F.lit("."))
    return S.trending_hashtags(_scored(spark, sf).withColumn("text", tags), AS_OF)


@query("negative_spike", """
SELECT hour, posts, negative, negative_share, trailing_share,
       COALESCE(posts >= 1 AND negative_share > trailing_share * 1.5, FALSE) AS is_spike
FROM (SELECT *, AVG(negative_share) OVER (ORDER BY hour RANGE BETWEEN INTERVAL 24 HOUR PRECEDING
                                           AND INTERVAL 1 SECOND PRECEDING) AS trailing_share
      FROM (SELECT date_trunc('hour', created_at) AS hour, COUNT(*) AS posts,
                   COUNT(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative,
                   COUNT(*) FILTER (WHERE predicted_sentiment = 'negative') / COUNT(*) AS negative_share
            FROM posts GROUP BY 1) h) w
""", fixtures=["posts"], doubles=["negative_share", "trailing_share"])
def q_negative_spike(spark, sf):
    """D04 hourly negative share against the trailing 24-hour mean."""
    return S.negative_spike(fx.posts(spark, sf))


@query("newest_posts", """
SELECT post_id, created_at, author_id, predicted_sentiment FROM posts
ORDER BY created_at DESC, post_id LIMIT 10
""", fixtures=["posts"])
def q_newest_posts(spark, sf):
    """T04 ten newest posts."""
    from eventlens.operators.common import newest
    return newest(fx.posts(spark, sf).select("post_id", "created_at", "author_id", "predicted_sentiment"),
                  "created_at", 10, "post_id")


def _lex_sql(words) -> str:
    return "(" + " + ".join(f"(CASE WHEN contains(lower(text), '{w}') THEN 1 ELSE 0 END)" for w in words) + ")"


_P0 = f"CAST({_lex_sql(POSITIVE_WORDS)} AS DOUBLE) / {float(len(POSITIVE_WORDS))}"
_N0 = f"CAST({_lex_sql(NEGATIVE_WORDS)} AS DOUBLE) / {float(len(NEGATIVE_WORDS))}"


@query("normalise_tweets", f"""
WITH raw AS (SELECT post_id AS id, text, created_at, author_id, lang, like_count, retweet_count FROM posts),
s AS (SELECT *, {_P0} AS p0, {_N0} AS n0 FROM raw WHERE text IS NOT NULL),
n AS (SELECT *, CASE WHEN text = '' THEN 0.33 ELSE p0 / (p0 + n0 + (1.0 - p0 - n0)) END AS sp,
             CASE WHEN text = '' THEN 0.34 ELSE (1.0 - p0 - n0) / (p0 + n0 + (1.0 - p0 - n0)) END AS su,
             CASE WHEN text = '' THEN 0.33 ELSE n0 / (p0 + n0 + (1.0 - p0 - n0)) END AS sn FROM s)
SELECT id AS tweet_id, created_at, author_id, lang, retweet_count, like_count, 0 AS reply_count, 0 AS quote_count,
       sp AS sentiment_positive, su AS sentiment_neutral, sn AS sentiment_negative,
       CASE WHEN sp >= su AND sp >= sn THEN 'positive' WHEN su >= sn THEN 'neutral' ELSE 'negative' END
         AS predicted_sentiment,
       CASE WHEN sp >= su AND sp >= sn THEN sp WHEN su >= sn THEN su ELSE sn END AS confidence,
       CAST(created_at AS DATE) AS date_partition
FROM n
""", fixtures=["posts"], doubles=["sentiment_positive", "sentiment_neutral", "sentiment_negative", "confidence"])
def q_normalise_tweets(spark, sf):
    """P08/P09/F03 the stream job's projection of raw tweets (ISO time text,
    metrics map without reply/quote counts) with the reference lexicon."""
    p = fx.posts(spark, sf)
    raw = p.select(F.col("post_id").alias("id"), "text",
                   F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("created_at"),
                   "author_id", "lang",
                   F.create_map(F.lit("like_count"), F.col("like_count"),
                                F.lit("retweet_count"), F.col("retweet_count")).alias("public_metrics"))
    out = S.normalise_tweets(raw).drop("processing_timestamp", "text")
    return out.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
