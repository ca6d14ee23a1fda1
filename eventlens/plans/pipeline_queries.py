"""Registered queries for the ends of the pipelines: raw lines to events,
features, detector figures, filters, reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from eventlens import fixtures as fx
from eventlens.ml.features import FEATURES, extract_features, with_trailing_failure_rate
from eventlens.operators import alerts as AL
from eventlens.operators import sentiment as S
from eventlens.operators.common import latest_per_key, time_range
from eventlens.operators.ingest import raw_log_events
from eventlens.operators.quality import key_check
from eventlens.operators.reports import security_report, sentiment_report
from eventlens.operators.security_report import anomaly_stats
from eventlens.operators.security_rules import exists, fill_defaults, in_set, stamp_processing_time, tagged
from eventlens.plans.fixture_sql import AS_OF_SQL
from eventlens.plans.ml_queries import _TIME
from eventlens.plans.registry import query
from eventlens.plans.security_queries import LOG_FIELDS, _enriched, _facet_sql, _geo
from eventlens.plans.sentiment_queries import AS_OF_DATE, HEALTH_SQL, TRENDING_SQL, _HOURLY_SQL, _scored, _sql_list
from eventlens.sinks.writers import staged
from eventlens.sources.tables import read_parquet_table

_JSON_FIELDS = {"firewall": ("src_ip", "dst_port", "packet_count"), "auth": ("src_ip", "username", "result"),
                "system": ("src_ip", "process_name", "event_type"), "dns": ("src_ip", "query", "response_code")}
_INTS = ("dst_port", "packet_count")


def _schema(fields):
    kinds = [StructField(f, IntegerType() if f in _INTS else StringType()) for f in fields]
    return StructType([StructField("event_id", LongType()), StructField("timestamp", StringType()), *kinds])


def raw_lines(spark, sf):
    """The stand-in logs as text: access-log lines for web events (every tenth
    with a second physical line), JSON for the others.  The event id travels as
    the response size, or as a JSON field."""
    e = fx.sec_logs(spark, sf).withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    web = e.where("log_type = 'web'").select(
        "log_type", F.lit("access.log").alias("file_id"), (F.col("event_id") * 2).alias("line_no"),
        F.concat(F.col("src_ip"), F.lit(" - - ["), F.date_format("event_time", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "GET '), F.col("path"),
                 F.lit(' HTTP/1.1" '), F.col("status_code").cast("string"), F.lit(" "), F.col("event_id").cast("string"), F.lit(' "-" "'),
                 F.col("user_agent"), F.lit('"')).alias("message"))
    more = (web.where("line_no % 20 = 0").withColumn("line_no", F.col("line_no") + 1)
            .withColumn("message", F.lit("  continued on a second line")))
    out = web.unionByName(more)
    for log_type, fields in _JSON_FIELDS.items():
        out = out.unionByName(e.where(F.col("log_type") == log_type).select(
            "log_type", F.concat("log_type", F.lit(".json")).alias("file_id"), F.col("event_id").alias("line_no"),
            F.to_json(F.struct("event_id", "timestamp", *fields)).alias("message")))
    return out


@query("raw_log_events", """
WITH n AS (SELECT event_id, ROW_NUMBER() OVER (ORDER BY event_id) AS event_no FROM sec_logs WHERE log_type = 'web')
SELECT e.event_id, log_type, event_no, 0 AS part, src_ip, array_to_string(list_sort(tag_list), ',') AS tags, threat_type, severity
FROM sec_enriched e LEFT JOIN n ON n.event_id = e.event_id
UNION ALL SELECT NULL, 'web', event_no, 1, NULL, NULL, NULL, NULL FROM n WHERE event_id % 10 = 0
""", fixtures=["sec_enriched"])
def q_raw_log_events(spark, sf):
    """S07-S09/F04/U02/R07 text lines folded, parsed by type and enriched; the
    bound on an event's row is one line here, so second lines are continuations."""
    e = raw_log_events(raw_lines(spark, sf), {t: _schema(f) for t, f in _JSON_FIELDS.items()}, max_lines=1)
    event_id = F.coalesce(F.col("event_id"), F.col("response_size").cast("bigint"))
    return e.select(event_id.alias("event_id"), "log_type", "event_no", F.col("part").cast("int").alias("part"), "src_ip",
                    F.array_join(F.array_sort("tags"), ",").alias("tags"), "threat_type", "severity")


@query("web_features", f"""
SELECT event_id, {_TIME}, status_code, 0 AS response_size, 0.0::DOUBLE AS processing_time,
       CASE WHEN regexp_matches(lower(user_agent), 'bot|crawler|spider') THEN 'bot'
            WHEN regexp_matches(lower(user_agent), 'curl|wget|python|sqlmap') THEN 'tool' ELSE 'browser' END AS user_agent_category,
       CASE WHEN regexp_matches(lower(path), '/admin|/wp-admin|/phpmyadmin') THEN 'admin'
            WHEN regexp_matches(lower(path), '/api|/rest|/graphql') THEN 'api'
            WHEN regexp_matches(lower(path), '\\.(php|asp|jsp)$') THEN 'dynamic' ELSE 'static' END AS path_category,
       'GET' AS method
FROM sec_logs WHERE log_type = 'web'
""", fixtures=["sec_logs"], doubles=["processing_time"])
def q_web_features(spark, sf):
    """M01 web features."""
    return extract_features(fx.sec_logs(spark, sf), "web")


@query("system_features", f"""
SELECT event_id, {_TIME}, 0 AS process_id, event_type, 'INFO' AS severity,
       CASE WHEN lower(process_name) IN ('powershell.exe', 'cmd.exe', 'nc.exe', 'wget.exe') THEN 1 ELSE 0 END AS is_suspicious_process,
       CASE WHEN lower(process_name) LIKE '%.exe' THEN 'executable' WHEN lower(process_name) LIKE '%.dll' THEN 'library'
            ELSE 'other' END AS process_category, 'regular' AS user_category
FROM sec_logs WHERE log_type = 'system'
""", fixtures=["sec_logs"])
def q_system_features(spark, sf):
    """M04 system features."""
    return extract_features(fx.sec_logs(spark, sf), "system")


@query("dns_features", f"""
SELECT event_id, {_TIME}, 0.0::DOUBLE AS response_time, 'A' AS query_type, response_code,
       CASE WHEN regexp_matches(lower(query), 'evil\\.com|bad\\.com|suspicious\\.org|attacker\\.net') THEN 'suspicious'
            WHEN regexp_matches(lower(query), '\\.(com|org|net)$') THEN 'legitimate' ELSE 'unknown' END AS domain_category,
       CASE WHEN regexp_matches(lower(query), 'evil\\.com|bad\\.com|suspicious\\.org|attacker\\.net') THEN 0.9
            WHEN regexp_matches(lower(query), '\\.(com|org|net)$') THEN 0.1 ELSE 0.5 END AS domain_reputation_score
FROM sec_logs WHERE log_type = 'dns'
""", fixtures=["sec_logs"], doubles=["response_time", "domain_reputation_score"])
def q_dns_features(spark, sf):
    """M05 dns features."""
    return extract_features(fx.sec_logs(spark, sf), "dns")


@query("trailing_failure_rate", """
WITH a AS (SELECT event_id, username, event_time, result FROM sec_logs WHERE log_type = 'auth')
SELECT a.event_id, COALESCE(AVG(CASE WHEN b.result = 'FAILED' THEN 1.0 WHEN b.result IS NOT NULL THEN 0.0 END), 0.0) AS trailing_failure_rate
FROM a LEFT JOIN a b ON b.username = a.username AND b.event_time < a.event_time AND b.event_time >= a.event_time - INTERVAL 6 HOUR
GROUP BY a.event_id
""", fixtures=["sec_logs"], doubles=["trailing_failure_rate"])
def q_trailing_failure_rate(spark, sf):
    """M03 option: share of failed logins of the user in the six hours before."""
    auth = fx.sec_logs(spark, sf).where("log_type = 'auth'").select("event_id", "username", "event_time", "result")
    return with_trailing_failure_rate(auth, 6 * 3600).select("event_id", "trailing_failure_rate")


@query("scaled_features", """
WITH f AS (SELECT event_id, CAST(dst_port AS DOUBLE) AS port, CAST(packet_count AS DOUBLE) AS packets,
                  CAST(CASE WHEN dst_port IN (22, 23, 3389, 1433, 3306, 5432, 21, 25) THEN 1 ELSE 0 END AS DOUBLE) AS risk
           FROM sec_logs WHERE log_type = 'firewall'),
m AS (SELECT AVG(port) AS mp, STDDEV_POP(port) AS sp, AVG(packets) AS mk, STDDEV_POP(packets) AS sk,
             AVG(risk) AS mr, STDDEV_POP(risk) AS sr FROM f)
SELECT event_id, (port - mp) / sp AS dst_port, (packets - mk) / sk AS packet_count, (risk - mr) / sr AS port_risk_score,
       0.0::DOUBLE AS protocol, 0.0::DOUBLE AS action FROM f, m
""", fixtures=["sec_logs"], doubles=["dst_port", "packet_count", "port_risk_score", "protocol", "action"])
def q_scaled_features(spark, sf):
    """M06/M07 category codes and standard scores of the firewall features."""
    from eventlens.ml.forest import encode, feature_rows, fit_encoders, fit_scalers, scale
    rows = feature_rows(fx.sec_logs(spark, sf), ("firewall",))
    enc = encode(rows, fit_encoders(rows), ("firewall",))
    return scale(enc, fit_scalers(enc)).select("event_id", *[
        F.get("x", F.lit(i)).alias(n) for i, (n, _) in enumerate(FEATURES["firewall"])
        if n in ("dst_port", "packet_count", "port_risk_score", "protocol", "action")])


@query("encode_categories", """
SELECT event_id, CAST(DENSE_RANK() OVER (ORDER BY response_code) - 1 AS DOUBLE) AS response_code
FROM sec_logs WHERE log_type = 'dns'
""", fixtures=["sec_logs"], doubles=["response_code"])
def q_encode_categories(spark, sf):
    """M06/J06 codes of a category in the order of its values."""
    from eventlens.ml.forest import encode, feature_rows, fit_encoders
    rows = feature_rows(fx.sec_logs(spark, sf), ("dns",))
    at = [n for n, _ in FEATURES["dns"]].index("response_code")
    return encode(rows, fit_encoders(rows), ("dns",)).select("event_id", F.get("x", F.lit(at)).alias("response_code"))


def _stand_in_scores(spark, sf):
    """Scored logs with a stand-in score: (event_id % 100) / 100."""
    score = (F.col("event_id") % 100) / F.lit(100.0)
    return fx.sec_logs(spark, sf).withColumns({"anomaly_score": score, "decision": F.lit(0.5) - score, "is_anomaly_pred": score > 0.8})


@query("model_alerts", """
SELECT event_id, log_type, s AS anomaly_score,
       CASE WHEN s > 0.9 THEN 'CRITICAL' WHEN s > 0.8 THEN 'HIGH' WHEN s > 0.6 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
       CASE log_type WHEN 'web' THEN 'Actividad web anómala detectada desde None'
            WHEN 'firewall' THEN 'Tráfico de red sospechoso: ' || src_ip || ' → None:' || dst_port
            WHEN 'auth' THEN 'Intento de autenticación anómalo: usuario ' || username || ' desde ' || src_ip
            WHEN 'system' THEN 'Evento de sistema sospechoso: ' || event_type || ' en proceso ' || process_name
            ELSE 'Consulta DNS sospechosa: ' || query || ' desde None' END || printf(' (Score: %.3f)', s) AS description
FROM (SELECT *, (event_id % 100) / 100.0 AS s FROM sec_logs) x WHERE s > 0.8 AND s >= 0.85
""", fixtures=["sec_logs"], doubles=["anomaly_score"])
def q_model_alerts(spark, sf):
    """R14-R16/P18 alert records of the flagged logs at or above a score."""
    logs = _stand_in_scores(spark, sf)
    alerts = AL.build_alerts(logs, ("event_id", *LOG_FIELDS[:-1]))
    return AL.ml_anomalies(alerts, 0.85).select(F.col("original_log.event_id").alias("event_id"), "log_type", "anomaly_score", "severity", "description")


@query("anomaly_stats", """
SELECT log_type, COUNT(*) FILTER (WHERE s > 0.8) AS flagged, COUNT(*) AS total, AVG(0.5 - s) AS mean_score
FROM (SELECT log_type, (event_id % 100) / 100.0 AS s FROM sec_logs) x GROUP BY log_type
""", fixtures=["sec_logs"], doubles=["mean_score"])
def q_anomaly_stats(spark, sf):
    """A27 flagged count, total and mean score per log type."""
    return anomaly_stats(_stand_in_scores(spark, sf))


@query("detection_quality", """
SELECT tp, fp, tn, fn, fp / (fp + tn) AS false_positive_rate, fn / (fn + tp) AS false_negative_rate FROM (
  SELECT COUNT(*) FILTER (WHERE l AND p) AS tp, COUNT(*) FILTER (WHERE NOT l AND p) AS fp,
         COUNT(*) FILTER (WHERE NOT l AND NOT p) AS tn, COUNT(*) FILTER (WHERE l AND NOT p) AS fn
  FROM (SELECT result = 'FAILED' AS l, (event_id % 100) / 100.0 > 0.8 AS p FROM sec_logs) x) c
""", fixtures=["sec_logs"], doubles=["false_positive_rate", "false_negative_rate"])
def q_detection_quality(spark, sf):
    """D02 confusion counts and error rates."""
    return AL.detection_quality(_stand_in_scores(spark, sf).withColumn("label", F.col("result") == "FAILED"), "label", "is_anomaly_pred")


@query("event_filters", """
SELECT event_id, event_time AS processing_timestamp, threat_type, 'none' AS owner FROM sec_enriched
WHERE event_time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' AND threat_type IS NOT NULL
  AND log_type IN ('web', 'dns') AND list_has_any(tag_list, ['web_attack', 'dns_attack'])
""", fixtures=["sec_enriched"])
def q_event_filters(spark, sf):
    """P15 time range, P16 exists and in-set, P20 defaults, P21 stamp, P22 tags."""
    e = stamp_processing_time(_enriched(spark, sf), "event_time")
    e = time_range(e, "event_time", "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    e = tagged(in_set(exists(e, "threat_type"), "log_type", ("web", "dns")), ("web_attack", "dns_attack"))
    return fill_defaults(e, {"owner": "none"}).select("event_id", "processing_timestamp", "threat_type", "owner")


@query("latest_author_metrics", """
SELECT author_id, date_partition, total_tweets, total_likes FROM (
  SELECT author_id, date_partition, COUNT(*) AS total_tweets, CAST(SUM(like_count) AS BIGINT) AS total_likes,
         ROW_NUMBER() OVER (PARTITION BY author_id ORDER BY date_partition DESC) AS rn
  FROM sentiment GROUP BY author_id, date_partition) a WHERE rn = 1
""", fixtures=["sentiment"])
def q_latest_author_metrics(spark, sf):
    """A04/W02 last-write-wins row of the author table."""
    m = S.author_metrics(_scored(spark, sf)).select("author_id", "date_partition", "total_tweets", "total_likes")
    return latest_per_key(m, ["author_id"], "date_partition").select("author_id", "date_partition", "total_tweets", "total_likes")


@query("key_check", """
SELECT o_custkey, o_orderdate, COUNT(*) AS n_rows FROM orders GROUP BY 1, 2 HAVING COUNT(*) > 1
""")
def q_key_check(spark, sf):
    """Q06 keys that a unique constraint would refuse."""
    return key_check(read_parquet_table(spark, sf, "orders"), ["o_custkey", "o_orderdate"])


@query("tweet_envelope", """
SELECT post_id AS id, author_id, CASE WHEN lang = 'en' THEN lang ELSE 'unknown' END AS lang, FALSE AS possibly_sensitive,
       0 AS annotations, 'twitter_api' AS source FROM posts
""", fixtures=["posts"])
def q_tweet_envelope(spark, sf):
    """P09 producer-side defaults (non-English posts lose their language)."""
    p = fx.posts(spark, sf).select(
        F.col("post_id").alias("id"), "text", "created_at", "author_id", F.create_map(F.lit("like_count"), "like_count").alias("public_metrics"),
        F.when(F.col("lang") == "en", F.col("lang")).alias("lang"), F.lit(None).cast("boolean").alias("possibly_sensitive"),
        F.lit(None).cast("array<map<string,string>>").alias("context_annotations"))
    out = S.tweet_envelope(p)
    return out.select("id", "author_id", "lang", "possibly_sensitive", F.size("context_annotations").alias("annotations"), "source")


@query("sentiment_report", f"""
WITH day AS (SELECT * FROM sentiment WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 24 HOUR),
h AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE predicted_sentiment = 'positive') AS p,
             COUNT(*) FILTER (WHERE predicted_sentiment = 'neutral') AS u, COUNT(*) FILTER (WHERE predicted_sentiment = 'negative') AS g,
             CAST(COALESCE(SUM(like_count), 0) AS BIGINT) AS l, CAST(COALESCE(SUM(retweet_count), 0) AS BIGINT) AS r,
             COUNT(DISTINCT author_id) AS a, COUNT(*) FILTER (WHERE processing_timestamp >= {AS_OF_SQL} - INTERVAL 1 HOUR) AS t FROM day)
SELECT 'pipeline_health' AS section, k.name AS name,
       CAST(CASE k.name WHEN 'total_tweets' THEN n WHEN 'positive_tweets' THEN p WHEN 'neutral_tweets' THEN u WHEN 'negative_tweets' THEN g
            WHEN 'total_likes' THEN l WHEN 'total_retweets' THEN r WHEN 'unique_authors' THEN a ELSE t END AS VARCHAR) AS value
FROM h, (SELECT unnest(['total_tweets', 'positive_tweets', 'neutral_tweets', 'negative_tweets', 'total_likes', 'total_retweets',
                        'unique_authors', 'tweets_last_hour']) AS name) k
UNION ALL SELECT 'hourly_trends', strftime(hour_timestamp, '%Y-%m-%d %H:%M'), CAST(total_tweets AS VARCHAR) FROM (
  SELECT * FROM ({_HOURLY_SQL}) x WHERE date_partition >= DATE '{AS_OF_DATE}' - 7 ORDER BY hour_timestamp DESC LIMIT 168) y
UNION ALL SELECT 'pipeline_health', 'health_status', health_status FROM ({HEALTH_SQL}) hs
UNION ALL SELECT 'trending_topics', word, CAST(total_mentions AS VARCHAR) FROM ({TRENDING_SQL}) tw
UNION ALL SELECT 'top_influencers', author_id, CAST(e AS VARCHAR) FROM (
  SELECT author_id, CAST(SUM(like_count + retweet_count) AS BIGINT) AS e FROM day GROUP BY author_id HAVING COUNT(*) >= 2
  ORDER BY e DESC, author_id LIMIT 10) z
""", fixtures=["sentiment"])
def q_sentiment_report(spark, sf):
    """The full metrics report, every section."""
    return sentiment_report(_scored(spark, sf), fx.AS_OF, AS_OF_DATE)


@query("security_report", f"""
SELECT 'summary' AS section, concat_ws(':', facet, value) AS name, CAST(count AS VARCHAR) AS value FROM (
  {_facet_sql("sec_enriched", {"log_type": "log_type", "severity": "severity"}, {"threat_type": "threat_list"})}) a
UNION ALL SELECT 'threats_detected', concat_ws(':', facet, value), CAST(count AS VARCHAR) FROM (
  {_facet_sql("(SELECT 'rule' AS alert_type, severity FROM sec_enriched WHERE severity = 'HIGH') alerts", {"alert_type": "alert_type", "severity": "severity"})}) b
UNION ALL SELECT 'top_attackers', ip, CAST(n AS VARCHAR) FROM (
  SELECT src_ip AS ip, COUNT(*) AS n FROM sec_geo WHERE severity IN ('HIGH', 'CRITICAL') AND src_ip IS NOT NULL
  GROUP BY src_ip ORDER BY n DESC, ip LIMIT 10) c
UNION ALL SELECT 'attack_patterns', 'peak_attack_count', CAST(MAX(n) AS VARCHAR) FROM (
  SELECT COUNT(*) AS n FROM sec_enriched WHERE threat_type IS NOT NULL GROUP BY date_trunc('hour', event_time)) d
UNION ALL SELECT 'attack_patterns', 'common_attack_methods', (
  SELECT string_agg(value || ':' || CAST(count AS VARCHAR), ',' ORDER BY count DESC, value) FROM (
    SELECT value, COUNT(*) AS count FROM (SELECT unnest(threat_list) AS value FROM sec_enriched WHERE threat_type IS NOT NULL) x
    GROUP BY value ORDER BY count DESC, value LIMIT 10) m)
UNION ALL SELECT 'recommendations', CAST(k AS VARCHAR), line FROM (
  SELECT unnest(generate_series(1, {len(AL.REPORT_RECOMMENDATIONS)})) AS k, unnest([{_sql_list(AL.REPORT_RECOMMENDATIONS)}]) AS line) r
""", fixtures=["sec_enriched", "sec_geo"])
def q_security_report(spark, sf):
    """The daily security report, every section; the enriched logs are staged,
    so rules and lookup run once and a section reads its own columns."""
    logs = staged(_geo(spark, sf), "security-report")
    return security_report(logs, AL.alerts_from_rules(logs, LOG_FIELDS), ip_col="src_ip")
