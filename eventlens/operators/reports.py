"""The two composed reports, as rows (section, name, value) that one document
is built from.  Every section is one of the report operators' small results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.operators import alerts as AL
from eventlens.operators import security_report as SR
from eventlens.operators import sentiment as S

HEALTH_NUMBERS = ("total_tweets", "positive_tweets", "neutral_tweets", "negative_tweets", "total_likes",
                  "total_retweets", "unique_authors", "tweets_last_hour")


def _section(df: DataFrame, section: str, name, value) -> DataFrame:
    return df.select(F.lit(section).alias("section"), name.cast("string").alias("name"), value.cast("string").alias("value"))


def _rows(*sections: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), sections)


def sentiment_report(df: DataFrame, as_of, as_of_date) -> DataFrame:
    """The full metrics report: pipeline health (A05), trending words (A07),
    hourly trends (T03) and top influencers (A09)."""
    health = S.pipeline_health(df, as_of)
    pairs = F.array(*[F.struct(F.lit(c).alias("n"), F.col(c).cast("string").alias("v")) for c in (*HEALTH_NUMBERS, "health_status")])
    health = health.select(F.inline(pairs))
    hours = S.hourly_trends(S.sentiment_hourly(df), as_of_date)
    return _rows(
        _section(health, "pipeline_health", F.col("n"), F.col("v")),
        _section(S.trending_words(df, as_of), "trending_topics", F.col("word"), F.col("total_mentions")),
        _section(hours, "hourly_trends", F.date_format("hour_timestamp", "yyyy-MM-dd HH:mm"), F.col("total_tweets")),
        _section(S.top_influencers(df, as_of), "top_influencers", F.col("author_id"), F.col("total_engagement")))


def security_report(logs: DataFrame, alerts: DataFrame, ip_col: str = "source_ip") -> DataFrame:
    """The daily security report: event and alert summaries (A18, A19), top
    attackers (A20), attack methods (A21) and the fixed advice (R20)."""
    facet = F.concat_ws(":", "facet", "value")
    patterns = SR.attack_patterns(logs)
    return _rows(
        _section(SR.log_summary(logs), "summary", facet, F.col("count")),
        _section(SR.alert_summary(alerts), "threats_detected", facet, F.col("count")),
        _section(SR.top_attackers(logs, ip_col=ip_col), "top_attackers", F.col("ip"), F.col("attack_count")),
        _section(patterns, "attack_patterns", F.lit("peak_attack_count"), F.col("peak_attack_count")),
        _section(patterns, "attack_patterns", F.lit("common_attack_methods"), F.col("common_attack_methods")),
        _section(AL.static_recommendations(logs.sparkSession), "recommendations", F.col("position"), F.col("recommendation")))


def report_document(rows: DataFrame) -> DataFrame:
    """A report's rows as one row with a JSON document (sections as maps);
    rows are at most a few hundred."""
    maps = rows.groupBy("section").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("name", "value")))).alias("m"))
    return maps.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("section", F.to_json("m").alias("m")))))).alias("report"))
