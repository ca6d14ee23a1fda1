"""Security report figures (A18-A22, A27): facet counts, top attackers,
attack patterns, failed attempts.

Facets follow the search engine's ``terms`` aggregation: ``size`` buckets
ordered by count descending, then by key ascending.  Multi-valued fields
(threat types) count each value; totals count events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TERMS_SIZE = 10


def _terms(df: DataFrame, value: Column, facet: str, size: int = TERMS_SIZE) -> DataFrame:
    g = (df.select(value.alias("value")).where(F.col("value").isNotNull())
         .groupBy("value").agg(F.count("*").alias("count")))
    top = g.orderBy(F.desc("count"), F.asc("value")).limit(size)
    # ranks are numbered over the <= size rows left after the top-k
    w = Window.orderBy(F.desc("count"), F.asc("value"))
    return (top.withColumn("rank", F.row_number().over(w))
            .select(F.lit(facet).alias("facet"), "value", "count", "rank"))


def facet_counts(df: DataFrame, facets: dict[str, Column], size: int = TERMS_SIZE,
                 multi: dict[str, Column] | None = None) -> DataFrame:
    """Total plus top-``size`` counts per facet as (facet, value, count, rank).
    ``multi`` facets are arrays (each value counted).

    One scan and one shuffle: every row emits (facet, value) pairs - one for
    the total, one per single-valued facet, one per array element - and a
    single ``groupBy(facet, value)`` counts them (partially, before the
    shuffle).  The top-``size`` per facet is then taken on the small table
    of distinct values.
    """
    pair = "struct<facet:string,value:string>"
    parts = [F.array(F.struct(F.lit("total").alias("facet"), F.lit(None).cast("string").alias("value")))]
    for name, c in facets.items():
        parts.append(F.array(F.struct(F.lit(name).alias("facet"), c.cast("string").alias("value"))))
    def tag(name):
        return lambda v: F.struct(F.lit(name).alias("facet"), v.cast("string").alias("value"))
    for name, arr in (multi or {}).items():
        parts.append(F.coalesce(F.transform(arr, tag(name)), F.array().cast(f"array<{pair}>")))
    pairs = df.select(F.explode(F.concat(*parts)).alias("p")).select("p.facet", "p.value")
    counts = (pairs.where(F.col("value").isNotNull() | (F.col("facet") == "total"))
              .groupBy("facet", "value").agg(F.count("*").cast("bigint").alias("count")))
    w = Window.partitionBy("facet").orderBy(F.desc("count"), F.asc("value"))
    ranked = counts.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= size)
    return ranked.select("facet", "value", "count", "rank")


def log_summary(logs: DataFrame, size: int = TERMS_SIZE) -> DataFrame:
    """Total logs, and counts by log type, severity and threat type."""
    return facet_counts(logs, {"log_type": F.col("log_type"), "severity": F.col("severity")}, size,
                        multi={"threat_type": F.col("threat_types")})


def alert_summary(alerts: DataFrame, size: int = TERMS_SIZE) -> DataFrame:
    """Total alerts, and counts by alert type and severity."""
    return facet_counts(alerts, {"alert_type": F.col("alert_type"), "severity": F.col("severity")}, size)


def top_attackers(logs: DataFrame, k: int = 10, ip_col: str = "source_ip",
                  country_col: str = "country_name", size: int = TERMS_SIZE) -> DataFrame:
    """HIGH/CRITICAL events by address: count, threat types in terms
    order, the most frequent country or ``Unknown``.

    One scan and one shuffle: each event emits one ``country`` pair (the
    event count) and one pair per threat type; ``groupBy(ip, kind, value)``
    leaves a small table (addresses x values) from which the top ``k``
    addresses, their threat lists and countries are read.
    """
    hi = logs.where(F.col("severity").isin("HIGH", "CRITICAL") & F.col(ip_col).isNotNull())
    country = F.col(country_col) if country_col in hi.columns else F.lit(None).cast("string")
    pair = "struct<kind:string,value:string>"
    pairs = hi.select(F.col(ip_col).alias("ip"), F.explode(F.concat(
        F.array(F.struct(F.lit("c").alias("kind"), country.cast("string").alias("value"))),
        F.coalesce(F.transform("threat_types", lambda t: F.struct(F.lit("t").alias("kind"), t.alias("value"))),
                   F.array().cast(f"array<{pair}>")))).alias("p")).select("ip", "p.kind", "p.value")
    counts = pairs.groupBy("ip", "kind", "value").agg(F.count("*").alias("n"))
    per_ip = counts.groupBy("ip").agg(
        F.sum(F.when(F.col("kind") == "c", F.col("n"))).alias("attack_count"),
        F.min_by(F.when((F.col("kind") == "c") & F.col("value").isNotNull(), F.col("value")),
                 F.when((F.col("kind") == "c") & F.col("value").isNotNull(),
                        F.struct(-F.col("n"), F.col("value")))).alias("country"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "t", F.struct(-F.col("n"), F.col("value")))))
        .alias("_t"))
    top = per_ip.orderBy(F.desc("attack_count"), F.asc("ip")).limit(k)
    return top.select("ip", F.col("attack_count").cast("bigint").alias("attack_count"),
                      F.concat_ws(",", F.slice(F.transform("_t", lambda x: x["value"]), 1, size)).alias("threat_types"),
                      F.coalesce("country", F.lit("Unknown")).alias("country"))


def attack_patterns(logs: DataFrame, ts_col: str = "event_time", size: int = TERMS_SIZE) -> DataFrame:
    """Hourly histogram of events with a threat: peak hour (earliest on a
    tie), its count, the number of hourly buckets from first to last
    (empty hours included), and the method counts as ``type:count`` text."""
    t = logs.where(F.col("threat_type").isNotNull())
    hourly = t.groupBy(F.date_trunc("hour", ts_col).alias("hour")).agg(F.count("*").alias("n"))
    peak = hourly.agg(F.min_by("hour", F.struct(-F.col("n"), F.col("hour"))).alias("peak_attack_hour"),
                      F.max("n").alias("peak_attack_count"),
                      ((F.unix_seconds(F.max("hour").cast("timestamp")) - F.unix_seconds(F.min("hour").cast("timestamp")))
                       / 3600 + 1).cast("bigint").alias("attack_frequency"))
    methods = _terms(t.select(F.explode("threat_types").alias("_v")), F.col("_v"), "m", size)
    m = methods.agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list(F.struct("rank", "value", "count"))),
                                                 lambda x: F.concat(x["value"], F.lit(":"), x["count"].cast("string"))))
                    .alias("common_attack_methods"))
    return peak.join(m, how="inner")


def failed_attempts(logs: DataFrame, ip_col: str = "source_ip", k: int = 10) -> DataFrame:
    """The ``k`` busiest addresses with their FAILED sub-count."""
    g = (logs.where(F.col(ip_col).isNotNull()).groupBy(F.col(ip_col).alias("ip"))
         .agg(F.count("*").alias("events"), F.count_if(F.col("result") == "FAILED").cast("bigint").alias("failures")))
    return g.orderBy(F.desc("events"), F.asc("ip")).limit(k)


def anomaly_stats(scored: DataFrame, flag_col: str = "is_anomaly_pred", score_col: str = "decision") -> DataFrame:
    """Flagged count, total and mean decision score per log type."""
    return scored.groupBy("log_type").agg(
        F.count_if(F.col(flag_col)).cast("bigint").alias("flagged"),
        F.count("*").alias("total"), F.avg(score_col).alias("mean_score"))
