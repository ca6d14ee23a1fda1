"""Social-sentiment analytics.

Input is the scored-tweet table (``sentiment_analysis`` shape: text,
created_at, processing_timestamp, author_id, like_count, retweet_count,
predicted_sentiment, confidence, sentiment_* scores, date_partition).
Every function is ``DataFrame -> DataFrame`` and takes the clock as
``as_of``.  Aggregations are single ``groupBy``s with conditional
aggregates, so Spark plans one partial (map-side) and one final
aggregation per report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.text import (EXPLORE_STOP_WORDS, TRENDING_STOP_WORDS, explode_words,
                                      with_lexicon_sentiment)
from eventlens.operators.common import recent, safe_div, top_k, top_n_per_group
from eventlens.operators.mentions import hourly_mentions

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# Spanish day names by ISO weekday (1 = Monday).
SPANISH_DAY_NAMES = {1: "Lunes", 2: "Martes", 3: "Miércoles", 4: "Jueves",
                     5: "Viernes", 6: "Sábado", 7: "Domingo"}
# Health ladder of the pipeline report.
HEALTH_CRITICAL = "CRITICAL - No data processed in 24h"
HEALTH_NO_HOUR = "WARNING - No data processed in last hour"
HEALTH_LOW_CONF = "WARNING - Low model confidence"
HEALTH_LOW_VOLUME = "WARNING - Low volume"
HEALTH_OK = "HEALTHY"
LOW_CONFIDENCE = 0.5
LOW_VOLUME = 100
# Dashboard colour bands: last-hour count 0/100/500, confidence 0/.5/.8.
COUNT_BANDS = (100, 500)
CONFIDENCE_BANDS = (0.5, 0.8)
# ---------------------------------------------------------------------------

SENTIMENTS = ("positive", "neutral", "negative")


def _is(sent: str) -> Column:
    return F.col("predicted_sentiment") == sent


def _count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("bigint")


def trending_words(df: DataFrame, as_of, hours: int = 24, min_mentions: int = 5, k: int = 20,
                   ts_col: str = "processing_timestamp") -> DataFrame:
    """Words of 3+ letters in the last ``hours``; mentions in total and by
    sentiment, score ``(pos - neg) / total``, ``HAVING total >= min``, top k.

    The reference groups by (word, sentiment) and then by word; sums of the
    counts per distinct text are the same result, pre-aggregated twice.
    """
    # posts per distinct text first: a repeated text is cut into words once
    texts = recent(df, ts_col, hours, as_of).groupBy("text").agg(
        F.count("*").alias("n"), _count_if(_is("positive")).alias("n_pos"), _count_if(_is("negative")).alias("n_neg"))
    w = explode_words(texts, "text", 3, TRENDING_STOP_WORDS)
    agg = w.groupBy("word").agg(
        F.sum("n").alias("total_mentions"),
        F.sum("n_pos").alias("positive_mentions"),
        F.sum("n_neg").alias("negative_mentions"),
    ).where(F.col("total_mentions") >= min_mentions)
    agg = agg.withColumn("sentiment_score",
                         (F.col("positive_mentions") - F.col("negative_mentions")) / F.col("total_mentions"))
    return top_k(agg, k, F.desc("total_mentions"), F.asc("word"))


def words_by_sentiment(df: DataFrame, as_of, hours: int = 24, min_frequency: int = 3, k: int = 50,
                       ts_col: str = "created_at") -> DataFrame:
    """Words of 4+ letters by (word, sentiment), ``frequency >= min``,
    top k overall."""
    texts = recent(df, ts_col, hours, as_of).groupBy("text", "predicted_sentiment").agg(F.count("*").alias("n"))
    w = explode_words(texts, "text", 4, EXPLORE_STOP_WORDS)
    agg = (w.groupBy("word", "predicted_sentiment").agg(F.sum("n").alias("frequency"))
           .where(F.col("frequency") >= min_frequency))
    return top_k(agg, k, F.desc("frequency"), F.asc("word"), F.asc("predicted_sentiment"))


def top_words_per_sentiment(df: DataFrame, as_of, n: int = 10, **kw) -> DataFrame:
    """A08 second step / W03: from the top-k table, ``n`` words per sentiment."""
    top = words_by_sentiment(df, as_of, **kw)
    return top_n_per_group(top, ["predicted_sentiment"], n, F.desc("frequency"), F.asc("word"))


def sentiment_hourly(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """The hourly view: hour x date counts, per-label counts, mean scores,
    likes, retweets, distinct authors.  ``exact_distinct=False`` uses the
    HyperLogLog estimate as the reference's ``uniq`` does."""
    distinct = (F.count_distinct("author_id") if exact_distinct
                else F.approx_count_distinct("author_id"))
    return (df.groupBy(F.date_trunc("hour", "created_at").alias("hour_timestamp"), "date_partition")
            .agg(F.count("*").alias("total_tweets"),
                 _count_if(_is("positive")).alias("positive_tweets"),
                 _count_if(_is("neutral")).alias("neutral_tweets"),
                 _count_if(_is("negative")).alias("negative_tweets"),
                 F.avg("sentiment_positive").alias("avg_positive_score"),
                 F.avg("sentiment_neutral").alias("avg_neutral_score"),
                 F.avg("sentiment_negative").alias("avg_negative_score"),
                 F.avg("confidence").alias("avg_confidence"),
                 F.sum("like_count").cast("bigint").alias("total_likes"),
                 F.sum("retweet_count").cast("bigint").alias("total_retweets"),
                 distinct.cast("bigint").alias("unique_authors")))


def hourly_partials(df: DataFrame) -> DataFrame:
    """A02 (write side): mergeable hourly parts.  Sums and counts instead of
    averages, and an HLL sketch of authors, so parts written by different
    micro-batches can be merged exactly (ruling C2)."""
    return (df.groupBy(F.date_trunc("hour", "created_at").alias("hour_timestamp"), "date_partition")
            .agg(F.count("*").alias("total_tweets"),
                 _count_if(_is("positive")).alias("positive_tweets"),
                 _count_if(_is("neutral")).alias("neutral_tweets"),
                 _count_if(_is("negative")).alias("negative_tweets"),
                 F.sum("sentiment_positive").alias("sum_positive_score"),
                 F.sum("sentiment_neutral").alias("sum_neutral_score"),
                 F.sum("sentiment_negative").alias("sum_negative_score"),
                 F.sum("confidence").alias("sum_confidence"),
                 F.sum("like_count").cast("bigint").alias("total_likes"),
                 F.sum("retweet_count").cast("bigint").alias("total_retweets"),
                 F.hll_sketch_agg("author_id").alias("authors_sketch")))


def merge_hourly_partials(parts: DataFrame) -> DataFrame:
    """A02 (K14): parts of any number of micro-batches as one part per hour."""
    return parts.groupBy("hour_timestamp", "date_partition").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in
          ("total_tweets", "positive_tweets", "neutral_tweets", "negative_tweets",
           "total_likes", "total_retweets")],
        *[F.sum(c).alias(c) for c in ("sum_positive_score", "sum_neutral_score",
                                      "sum_negative_score", "sum_confidence")],
        F.hll_union_agg("authors_sketch").alias("authors_sketch"))


def hourly_merge(parts: DataFrame) -> DataFrame:
    """A02 (read side): merge any number of parts per hour into A01's shape."""
    g = merge_hourly_partials(parts)
    n = F.col("total_tweets")
    return g.select(
        "hour_timestamp", "date_partition", "total_tweets", "positive_tweets", "neutral_tweets",
        "negative_tweets",
        (F.col("sum_positive_score") / n).alias("avg_positive_score"),
        (F.col("sum_neutral_score") / n).alias("avg_neutral_score"),
        (F.col("sum_negative_score") / n).alias("avg_negative_score"),
        (F.col("sum_confidence") / n).alias("avg_confidence"),
        "total_likes", "total_retweets",
        F.hll_sketch_estimate("authors_sketch").alias("unique_authors"))


#: posts for which there is one more task that brings keywords together
HOUR_CHUNK = 10_000


def trending_topics_hourly(df: DataFrame, min_len: int = 3, stop_words=TRENDING_STOP_WORDS) -> DataFrame:
    """Hour x keyword mentions, by sentiment, and mean post score
    (``sentiment_positive - sentiment_negative``).  The reference declares
    the table without a writer; the keyword rule is F02's.

    Mentions are added up where the posts are, a block of posts at a time, and only
    the compressed sums travel, by keyword: neither the posts' words nor a row for
    each mention are shuffled."""
    score = F.col("sentiment_positive") - F.col("sentiment_negative")
    return hourly_mentions(df, SENTIMENTS, score, min_len, stop_words or (), HOUR_CHUNK)


def author_metrics(df: DataFrame, impact: Column | None = None) -> DataFrame:
    """Date x author totals and mean score.  The reference gives the
    impact score no formula, so it is a caller expression (default null)."""
    out = (df.groupBy("date_partition", "author_id")
           .agg(F.count("*").alias("total_tweets"),
                F.sum("like_count").cast("bigint").alias("total_likes"),
                F.sum("retweet_count").cast("bigint").alias("total_retweets"),
                F.avg(F.col("sentiment_positive") - F.col("sentiment_negative")).alias("avg_sentiment_score")))
    return out.withColumn("follower_impact_score",
                          impact if impact is not None else F.lit(None).cast("double"))


def health_label(total_24h: Column, total_1h: Column, avg_conf: Column) -> Column:
    """the status ladder."""
    return (F.when(total_24h == 0, HEALTH_CRITICAL)
            .when(total_1h == 0, HEALTH_NO_HOUR)
            .when(avg_conf.isNotNull() & (avg_conf != 0) & (avg_conf < LOW_CONFIDENCE), HEALTH_LOW_CONF)
            .when(total_24h < LOW_VOLUME, HEALTH_LOW_VOLUME)
            .otherwise(HEALTH_OK))


def pipeline_health(df: DataFrame, as_of, ts_col: str = "processing_timestamp") -> DataFrame:
    """One row of 24-hour and last-hour metrics plus the health label;
    one pass over the last 24 hours (the 1-hour count is a conditional
    count inside the same aggregation)."""
    day = recent(df, ts_col, 24, as_of)
    hour_start = F.lit(str(as_of)).cast(df.schema[ts_col].dataType.simpleString()) - F.expr("INTERVAL 1 HOUR")
    a = day.agg(
        F.count("*").alias("total_tweets"),
        _count_if(_is("positive")).alias("positive_tweets"),
        _count_if(_is("neutral")).alias("neutral_tweets"),
        _count_if(_is("negative")).alias("negative_tweets"),
        F.avg("confidence").alias("raw_confidence"),
        F.coalesce(F.sum("like_count"), F.lit(0)).cast("bigint").alias("total_likes"),
        F.coalesce(F.sum("retweet_count"), F.lit(0)).cast("bigint").alias("total_retweets"),
        F.count_distinct("author_id").alias("unique_authors"),
        _count_if(F.col(ts_col) >= hour_start).alias("tweets_last_hour"),
    )
    n = F.col("total_tweets")
    return a.select(
        "total_tweets", "positive_tweets", "neutral_tweets", "negative_tweets",
        F.round(safe_div(F.col("positive_tweets") * 100.0, n), 2).alias("positive_rate_pct"),
        F.round(safe_div(F.col("negative_tweets") * 100.0, n), 2).alias("negative_rate_pct"),
        F.coalesce(F.round("raw_confidence", 3), F.lit(0.0)).alias("avg_confidence"),
        "total_likes", "total_retweets", F.col("unique_authors").cast("bigint").alias("unique_authors"),
        "tweets_last_hour",
        health_label(n, F.col("tweets_last_hour"), F.col("raw_confidence")).alias("health_status"),
    )


def hour_monitor(df: DataFrame, as_of, ts_col: str = "processing_timestamp") -> DataFrame:
    """Last-hour counts and the two monitor warnings."""
    a = recent(df, ts_col, 1, as_of).agg(
        F.count("*").alias("total_tweets"),
        _count_if(_is("positive")).alias("positive_tweets"),
        _count_if(_is("negative")).alias("negative_tweets"),
        F.avg("confidence").alias("avg_confidence"))
    return a.select("*",
                    (F.col("total_tweets") == 0).alias("warn_no_tweets"),
                    F.coalesce((F.col("avg_confidence") < LOW_CONFIDENCE) & (F.col("avg_confidence") != 0),
                               F.lit(False)).alias("warn_low_confidence"))


def hourly_trends(hourly: DataFrame, as_of_date, days: int = 7, k: int = 168,
                  ascending: bool = False) -> DataFrame:
    """Latest ``k`` hours of the hourly table from ``as_of_date - days``;
    ``ascending=True`` is the dashboard form (all hours, oldest first)."""
    cut = F.date_sub(F.lit(str(as_of_date)).cast("date"), days)
    f = hourly.where(F.col("date_partition") >= cut).select(
        "hour_timestamp", "total_tweets", "positive_tweets", "neutral_tweets", "negative_tweets",
        "avg_confidence", "total_likes", "total_retweets")
    if ascending:
        return f.orderBy("hour_timestamp")
    return top_k(f, k, F.desc("hour_timestamp"))


def top_influencers(df: DataFrame, as_of, hours: int = 24, min_tweets: int = 2, k: int = 10,
                    ts_col: str = "processing_timestamp") -> DataFrame:
    """Per author tweets, engagement, mean confidence, positive rate;
    ``HAVING tweets >= 2``; top k by engagement (author id breaks ties)."""
    a = (recent(df, ts_col, hours, as_of).groupBy("author_id")
         .agg(F.count("*").alias("tweet_count"),
              F.sum(F.col("like_count") + F.col("retweet_count")).cast("bigint").alias("total_engagement"),
              F.avg("confidence").alias("avg_confidence"),
              (F.count_if(_is("positive")) / F.count("*")).alias("positive_rate"))
         .where(F.col("tweet_count") >= min_tweets))
    return top_k(a, k, F.desc("total_engagement"), F.asc("author_id"))


def top_authors(df: DataFrame, as_of, hours: int = 24, k: int = 10,
                ts_col: str = "processing_timestamp") -> DataFrame:
    """A10: dashboard top authors by engagement, no HAVING."""
    a = (recent(df, ts_col, hours, as_of).groupBy("author_id")
         .agg(F.sum(F.col("like_count") + F.col("retweet_count")).cast("bigint").alias("total_engagement"),
              F.count("*").alias("tweet_count")))
    return top_k(a, k, F.desc("total_engagement"), F.asc("author_id"))


def sentiment_distribution(df: DataFrame, as_of, hours: int = 24,
                           ts_col: str = "processing_timestamp") -> DataFrame:
    """Count by label."""
    return recent(df, ts_col, hours, as_of).groupBy("predicted_sentiment").agg(F.count("*").alias("count"))


def volume_by_hour(df: DataFrame, as_of, hours: int = 24, ts_col: str = "created_at") -> DataFrame:
    """Hourly totals and per-label counts, oldest hour first."""
    return (recent(df, ts_col, hours, as_of)
            .groupBy(F.date_trunc("hour", ts_col).alias("hour"))
            .agg(F.count("*").alias("total_tweets"),
                 *[_count_if(_is(s)).alias(s) for s in SENTIMENTS])
            .orderBy("hour"))


#: KLL sketches of this k: a quantile's rank is off by less than RANK_ERROR, with 99 % confidence
KLL_K = 400
RANK_ERROR = 0.01


def confidence_sketches(df: DataFrame, day_col: str = "date_partition") -> DataFrame:
    """A13 as mergeable parts: per label and day the count, sum, sum of squares,
    ends and a KLL sketch of the confidence; bounded by ``KLL_K``, whatever the
    number of distinct values.  Parts of any days merge."""
    c = F.col("confidence").cast("double")
    return df.groupBy("predicted_sentiment", day_col).agg(
        F.count(c).alias("n"), F.sum(c).alias("total"), F.sum(c * c).alias("squares"), F.min(c).alias("low"), F.max(c).alias("high"),
        F.kll_sketch_agg_double(c, F.lit(KLL_K)).alias("sketch"))


def merged_confidence(parts: DataFrame) -> DataFrame:
    """A13 from its parts: count, mean, population deviation, ends, and the
    median within ``RANK_ERROR`` of its rank."""
    m = parts.groupBy("predicted_sentiment").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.kll_merge_agg_double("sketch", F.lit(KLL_K)).alias("sketch"))
    mean = F.col("total") / F.col("n")
    return m.select("predicted_sentiment", "n", mean.alias("mean"), F.sqrt(F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0))).alias("deviation"),
                    "low", "high", F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("median"))


def confidence_stats(df: DataFrame, as_of, hours: int = 24, ts_col: str = "created_at", exact: bool = False) -> DataFrame:
    """Confidence avg / median / min / max / count per label.

    The median is ``percentile_approx`` (bounded memory); ``exact`` takes the
    interpolated ``percentile``, whose memory per label grows with its distinct
    values (fine for scores of two digits).
    """
    median = F.percentile("confidence", 0.5) if exact else F.percentile_approx("confidence", 0.5)
    return (recent(df, ts_col, hours, as_of).groupBy("predicted_sentiment")
            .agg(F.avg("confidence").alias("avg_confidence"),
                 median.cast("double").alias("median_confidence"),
                 F.min("confidence").alias("min_confidence"),
                 F.max("confidence").alias("max_confidence"),
                 F.count("*").alias("count")))


def engagement_by_sentiment(df: DataFrame, as_of, hours: int = 24, ts_col: str = "created_at") -> DataFrame:
    """Mean likes, retweets and their sum where either is positive."""
    f = recent(df, ts_col, hours, as_of).where((F.col("like_count") > 0) | (F.col("retweet_count") > 0))
    return f.groupBy("predicted_sentiment").agg(
        F.avg("like_count").alias("avg_likes"),
        F.avg("retweet_count").alias("avg_retweets"),
        F.avg(F.col("like_count") + F.col("retweet_count")).alias("avg_total_engagement"))


def iso_weekday(ts: Column) -> Column:
    """ISO weekday, Monday = 1 (``dayofweek`` starts on Sunday)."""
    return F.weekday(ts) + 1


def spanish_day_name(iso_day: Column) -> Column:
    """Spanish weekday name of an ISO weekday."""
    m = F.create_map(*[F.lit(x) for kv in SPANISH_DAY_NAMES.items() for x in kv])
    return m[iso_day]


def by_weekday(df: DataFrame, as_of, days: int = 7, ts_col: str = "created_at") -> DataFrame:
    """Per ISO weekday count, mean confidence, positive rate, name."""
    a = (recent(df, ts_col, as_of=as_of, days=days)
         .groupBy(iso_weekday(F.col(ts_col)).alias("day_of_week"))
         .agg(F.count("*").alias("total_tweets"),
              F.avg("confidence").alias("avg_confidence"),
              (F.count_if(_is("positive")) / F.count("*")).alias("positive_rate")))
    return a.withColumn("day_name", spanish_day_name(F.col("day_of_week"))).orderBy("day_of_week")


def executive_summary(df: DataFrame, as_of, hours: int = 24, ts_col: str = "created_at") -> DataFrame:
    """One-row summary of the last ``hours``."""
    return recent(df, ts_col, hours, as_of).agg(
        F.count("*").alias("total_tweets"),
        (F.count_if(_is("positive")) / F.count("*") * 100).alias("positive_pct"),
        (F.count_if(_is("negative")) / F.count("*") * 100).alias("negative_pct"),
        F.avg("confidence").alias("avg_confidence"),
        F.sum(F.col("like_count") + F.col("retweet_count")).cast("bigint").alias("total_engagement"),
        F.count_distinct("author_id").cast("bigint").alias("unique_authors"))


def _band(value: Column, bands, names=("green", "yellow", "red")) -> Column:
    lo, hi = bands
    return F.when(value.isNull(), F.lit(None)).when(value < lo, names[0]).when(value < hi, names[1]).otherwise(names[2])


def dashboard_scalars(df: DataFrame, as_of, ts_col: str = "processing_timestamp") -> DataFrame:
    """The dashboard's single-value panels with their colour bands
    (last-hour count, last-hour mean confidence, 24-hour engagement)."""
    day = recent(df, ts_col, 24, as_of)
    hour_start = F.lit(str(as_of)).cast(df.schema[ts_col].dataType.simpleString()) - F.expr("INTERVAL 1 HOUR")
    in_hour = F.col(ts_col) >= hour_start
    a = day.agg(
        _count_if(in_hour).alias("tweets_last_hour"),
        F.avg(F.when(in_hour, F.col("confidence"))).alias("avg_confidence_last_hour"),
        F.sum(F.col("like_count") + F.col("retweet_count")).cast("bigint").alias("engagement_24h"))
    return a.select("*",
                    _band(F.col("tweets_last_hour"), COUNT_BANDS, ("red", "yellow", "green")).alias("volume_band"),
                    _band(F.col("avg_confidence_last_hour"), CONFIDENCE_BANDS, ("red", "yellow", "green"))
                    .alias("confidence_band"))


def negative_alerts(df: DataFrame, as_of, hours: int = 1, min_confidence: float = 0.8, k: int = 20,
                    ts_col: str = "processing_timestamp") -> DataFrame:
    """Negative posts above a confidence in the last hour, newest k."""
    f = recent(df, ts_col, hours, as_of).where(_is("negative") & (F.col("confidence") > min_confidence))
    return top_k(f.select("post_id", "created_at", "text", "confidence"), k,
                 F.desc("created_at"), F.asc("post_id"))


# --------------------------------------------------------------------------- tweets in


def normalise_tweets(raw: DataFrame, as_of_fallback: Column | None = None) -> DataFrame:
    """The stream job's projection of a raw tweet: drop rows without
    text, score (F03), metric lookups with 0 default, parse times with
    ``try_to_timestamp`` (ANSI ``to_timestamp`` would fail the batch), and
    a date partition falling back to the processing time."""
    now = as_of_fallback if as_of_fallback is not None else F.current_timestamp()
    created = F.coalesce(F.try_to_timestamp(F.col("created_at")),
                         F.try_to_timestamp(F.col("created_at"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")))
    m = F.col("public_metrics")
    base = (raw.where(F.col("text").isNotNull())
            .select(F.col("id").alias("tweet_id"), "text", created.alias("created_at"), "author_id", "lang",
                    *[F.coalesce(m.getItem(k), F.lit(0)).alias(k)
                      for k in ("retweet_count", "like_count", "reply_count", "quote_count")],
                    now.alias("processing_timestamp")))
    s = with_lexicon_sentiment(base, "text")
    return s.select("tweet_id", "text", "created_at", "author_id", "lang", "retweet_count", "like_count",
                    "reply_count", "quote_count", "sentiment_positive", "sentiment_neutral",
                    "sentiment_negative", "predicted_sentiment", "confidence", "processing_timestamp",
                    F.to_date(F.coalesce(F.col("created_at"), F.col("processing_timestamp")))
                    .alias("date_partition"))


def tweet_envelope(df: DataFrame) -> DataFrame:
    """Producer-side defaults (lang ``unknown``, not sensitive, no
    annotations), ingestion time and source tag."""
    return df.select(
        "id", "text", "created_at", "author_id", "public_metrics",
        F.coalesce(F.col("lang"), F.lit("unknown")).alias("lang"),
        F.coalesce(F.col("possibly_sensitive"), F.lit(False)).alias("possibly_sensitive"),
        F.coalesce(F.col("context_annotations"),
                   F.array().cast("array<map<string,string>>")).alias("context_annotations"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingestion_timestamp"),
        F.lit("twitter_api").alias("source"))


def keyword_filter(df: DataFrame, keywords, lang: str = "en", limit: int | None = None,
                   text_col: str = "text", order_col: str = "created_at", id_col: str = "post_id") -> DataFrame:
    """P10: the search ``"<kw> -is:retweet lang:en"`` ; ``limit`` keeps
    the newest posts per keyword (a page of the search; default: all).

    The keywords are a literal array; each post is matched against it with a
    higher-order ``filter`` and exploded, so there is no join at all.  A post
    matching two keywords appears once per keyword, as two searches return
    it.  The per-keyword limit is a ``row_number`` filter, which Spark turns
    into a partial group limit before the shuffle (WindowGroupLimit), so a
    hot keyword ships at most ``limit`` rows per input partition.
    """
    low = F.lower(F.col(text_col))
    kws = F.array(*[F.lit(k.lower()) for k in keywords])
    base = df.where((F.col("lang") == lang) & ~F.col(text_col).startswith("RT @"))
    m = base.withColumn("keyword", F.explode(F.filter(kws, lambda k: low.contains(k))))
    if limit is None:
        return m
    return top_n_per_group(m, ["keyword"], limit, F.desc(order_col), F.asc(id_col), rank_col="rank")


# --------------------------------------------------------------------------- promised in prose


def trending_hashtags(df: DataFrame, as_of, hours: int = 24, k: int = 10,
                      ts_col: str = "processing_timestamp") -> DataFrame:
    """Most used hashtags (``#`` + word characters, lower-cased)."""
    tags = (recent(df, ts_col, hours, as_of)
            .select(F.explode(F.regexp_extract_all(F.col("text"), F.lit(r"(?U)#(\w+)"), 1)).alias("tag"))
            .select(F.lower("tag").alias("hashtag")))
    g = tags.groupBy("hashtag").agg(F.count("*").alias("mentions"))
    return top_k(g, k, F.desc("mentions"), F.asc("hashtag"))


def negative_spike(df: DataFrame, window_hours: int = 1, trailing: int = 24, factor: float = 1.5,
                   min_posts: int = 1, ts_col: str = "created_at") -> DataFrame:
    """Hours whose negative share exceeds ``factor`` x the mean share of
    the previous ``trailing`` hours.  The per-hour table is tiny (one row per
    hour), so the trailing mean is a window over it."""
    from pyspark.sql import Window
    h = (df.groupBy(F.date_trunc("hour", ts_col).alias("hour"))
         .agg(F.count("*").alias("posts"), _count_if(_is("negative")).alias("negative"))
         .withColumn("negative_share", F.col("negative") / F.col("posts")))
    secs = F.unix_seconds(F.col("hour").cast("timestamp"))
    w = Window.orderBy(secs).rangeBetween(-trailing * 3600, -1)
    h = h.withColumn("trailing_share", F.avg("negative_share").over(w))
    return h.withColumn("is_spike", F.coalesce((F.col("posts") >= min_posts)
                                                & (F.col("negative_share") > F.col("trailing_share") * factor),
                                                F.lit(False)))
