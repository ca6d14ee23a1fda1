"""Registered model queries: feature projections (with oracles) and the
isolation-forest scores (rows-only check)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens import fixtures as fx
from eventlens.ml.features import FEATURES, extract_features
from eventlens.ml.forest import fit_forests, score_all
from eventlens.operators import alerts as AL
from eventlens.operators.security_report import anomaly_stats
from eventlens.plans.registry import query
from eventlens.sinks.writers import staged

_TIME = ("hour(event_time) AS hour_of_day, isodow(event_time) - 1 AS day_of_week, "
         "CASE WHEN isodow(event_time) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend")


@query("firewall_features", f"""
SELECT event_id, {_TIME}, 0 AS src_port, dst_port, packet_count, 0 AS bytes_transferred,
       CASE WHEN starts_with(src_ip, '192.168.') OR starts_with(src_ip, '10.') OR starts_with(src_ip, '172.16.')
            THEN 'private' ELSE 'public' END AS src_ip_category,
       'public' AS dst_ip_category,
       CASE WHEN dst_port IN (22, 23, 3389, 1433, 3306, 5432, 21, 25) THEN 1 ELSE 0 END AS port_risk_score,
       'TCP' AS protocol, 'ALLOW' AS action
FROM sec_logs WHERE log_type = 'firewall'
""", fixtures=["sec_logs"])
def q_firewall_features(spark, sf):
    """M02 firewall features (absent fields take their defaults)."""
    return extract_features(fx.sec_logs(spark, sf), "firewall")


@query("auth_features", f"""
SELECT event_id, {_TIME}, result, 'password' AS auth_method, 'ssh' AS service,
       CASE WHEN lower(username) IN ('admin', 'root', 'administrator', 'sa') THEN 'admin' ELSE 'regular' END
         AS username_category,
       CASE WHEN lower(username) IN ('admin', 'root', 'administrator', 'sa') THEN 1 ELSE 0 END AS is_admin_user,
       CASE WHEN result = 'FAILED' THEN 0.1 ELSE 0.0 END AS failure_rate
FROM sec_logs WHERE log_type = 'auth'
""", fixtures=["sec_logs"], doubles=["failure_rate"])
def q_auth_features(spark, sf):
    """M03 authentication features."""
    return extract_features(fx.sec_logs(spark, sf), "auth")


@query("score_forest")
def q_score_forest(spark, sf):
    """M08/M09 isolation forests of all log types fitted together on all events
    and scored on all events (rows-only check: one row per event)."""
    logs = fx.sec_logs(spark, sf)
    return score_all(logs, fit_forests(logs))


@query("score_forest_bounds", """
SELECT log_type, COUNT(*) AS events, TRUE AS scores_in_range, TRUE AS share_in_bounds FROM sec_logs GROUP BY log_type
""", fixtures=["sec_logs"])
def q_score_forest_bounds(spark, sf):
    """M08/M09 per type: every event scored once, probabilities in [0, 1], and
    the share below the offset near the contamination (at most a quarter:
    equal events share a score)."""
    s = q_score_forest(spark, sf)
    return s.groupBy("log_type").agg(
        F.count_distinct("event_id").alias("events"), F.bool_and(F.col("anomaly_score").between(0, 1)).alias("scores_in_range"),
        (F.avg((F.col("decision") < 0).cast("int")) <= 0.25).alias("share_in_bounds"))


@query("planted_outliers", """
SELECT log_type, COUNT(*) AS events, COUNT(*) FILTER (WHERE event_id % 97 = 0) AS planted, TRUE AS planted_score_higher
FROM sec_logs GROUP BY log_type
""", fixtures=["sec_logs"])
def q_planted_outliers(spark, sf):
    """M08/M09 every 97th log is made odd in the fields of its type; the models,
    fitted on all logs, give them a higher mean anomaly score than the others."""
    odd = F.col("event_id") % 97 == 0
    logs = fx.sec_logs(spark, sf)
    strange = {"status_code": 900, "path": "/phpmyadmin/x", "dst_port": 31337, "packet_count": 1_000_000, "result": "ZZ_LOCKED",
               "username": "administrator", "event_type": "zz_wiped", "process_name": "nc.exe", "response_code": "ZZFAIL",
               "query": "bad.com"}
    logs = logs.withColumns({c: F.when(odd, F.lit(v)).otherwise(F.col(c)) for c, v in strange.items()})
    scored = score_all(logs, fit_forests(logs))
    mean = lambda of: F.avg(F.when(of, F.col("anomaly_score")))
    return scored.groupBy("log_type").agg(F.count("*").alias("events"), F.count_if(odd).alias("planted"),
                                          (mean(odd) > mean(~odd)).alias("planted_score_higher"))


@query("model_figures", """
SELECT log_type, COUNT(*) AS total, COUNT(*) FILTER (WHERE result = 'FAILED') AS failed, TRUE AS alerts_are_the_flagged,
       TRUE AS quality_adds_up, TRUE AS severity_follows_score
FROM sec_logs GROUP BY log_type
""", fixtures=["sec_logs"])
def q_model_figures(spark, sf):
    """A27, D02, P18, R14-R16 on the models' own scores: the alert records are
    those of the flagged logs, the confusion counts add up to the flagged and the
    failed logs, and a severity holds scores of its range alone."""
    logs = fx.sec_logs(spark, sf)
    scored = staged(score_all(logs, fit_forests(logs)), "scored")
    logs = logs.join(scored.drop("log_type"), "event_id")
    stats = anomaly_stats(scored).select("log_type", "flagged", "total")
    alerts = AL.ml_anomalies(AL.build_alerts(logs.where("is_anomaly_pred"), ("event_id", "src_ip")), 0.0)
    low = {"CRITICAL": 0.9, "HIGH": 0.8, "MEDIUM": 0.6}
    floor = F.coalesce(*[F.when(F.col("severity") == s, F.lit(v)) for s, v in low.items()], F.lit(-1.0))
    alerts = alerts.groupBy("log_type").agg(F.count("*").alias("alerts"), F.bool_and(F.col("anomaly_score") > floor).alias("in_range"))
    out = None
    for t in FEATURES:
        q = AL.detection_quality(logs.where(F.col("log_type") == t).withColumn("label", F.col("result") == "FAILED"), "label", "is_anomaly_pred")
        q = q.withColumn("log_type", F.lit(t))
        out = q if out is None else out.unionByName(q)
    figures = stats.join(out, "log_type").join(alerts, "log_type", "left")
    return figures.select(
        "log_type", "total", (F.col("tp") + F.col("fn")).alias("failed"),
        (F.coalesce("alerts", F.lit(0)) == F.col("flagged")).alias("alerts_are_the_flagged"),
        ((F.col("tp") + F.col("fp") == F.col("flagged")) & (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn") == F.col("total"))).alias("quality_adds_up"),
        F.coalesce("in_range", F.lit(True)).alias("severity_follows_score"))
