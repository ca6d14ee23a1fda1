"""Registered queries of the security-log pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens import fixtures as fx
from eventlens.functions.security import parse_access_log
from eventlens.operators import alerts as AL
from eventlens.operators import security_report as SR
from eventlens.operators.geoip import geoip_enrich, nation_ranges
from eventlens.operators.security_rules import dedupe_events, enrich_logs
from eventlens.plans.registry import query
from eventlens.sources.tables import read_parquet_table

LOG_FIELDS = ("src_ip", "username", "result", "dst_port", "packet_count", "path", "user_agent",
              "status_code", "process_name", "event_type", "query", "response_code", "threat_type")


def _logs(spark, sf):
    """The stand-in logs with the ISO time text the pipeline receives."""
    return fx.sec_logs(spark, sf).withColumn(
        "timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def _enriched(spark, sf):
    return enrich_logs(_logs(spark, sf))


def _ranges(spark, sf):
    return nation_ranges(read_parquet_table(spark, sf, "nation"), read_parquet_table(spark, sf, "region"))


def _geo(spark, sf):
    return enrich_logs(_logs(spark, sf), ranges=_ranges(spark, sf))


@query("enrich_logs", """
SELECT event_id, log_type, array_to_string(list_sort(tag_list), ',') AS tags,
       array_to_string(threat_list, ',') AS threat_types, threat_type, port_risk, severity,
       severity = 'HIGH' AS alert_required, event_hash
FROM sec_enriched
""", fixtures=["sec_enriched"])
def q_enrich_logs(spark, sf):
    """R01-R07 rules, severity, fingerprint for every event."""
    e = _enriched(spark, sf)
    return e.select("event_id", "log_type", F.array_join(F.array_sort("tags"), ",").alias("tags"),
                    F.array_join("threat_types", ",").alias("threat_types"), "threat_type", "port_risk",
                    "severity", "alert_required", "event_hash")


@query("rule_severity", """
SELECT log_type, severity, COUNT(*) AS events FROM sec_enriched GROUP BY log_type, severity
""", fixtures=["sec_enriched"])
def q_rule_severity(spark, sf):
    """R06 severity mix by log type."""
    return _enriched(spark, sf).groupBy("log_type", "severity").agg(F.count("*").alias("events"))


@query("dedupe_events", """
SELECT MIN(event_id) AS event_id, COUNT(*) AS copies FROM (
  SELECT event_id, timestamp, src_ip, 'event of ' || username AS message FROM sec_enriched
  UNION ALL SELECT event_id + 1000000000, timestamp, src_ip, 'event of ' || username FROM sec_enriched WHERE event_id % 20 = 0
  UNION ALL SELECT event_id + 2000000000, timestamp, src_ip, 'another event' FROM sec_enriched WHERE event_id % 30 = 0) e
GROUP BY timestamp, src_ip, message
""", fixtures=["sec_enriched"])
def q_dedupe_events(spark, sf):
    """R08/F06 one event per fingerprint of time, address and message
    (earliest id wins): with repeated events, and others of the same time."""
    logs = _logs(spark, sf).withColumns({"message": F.concat(F.lit("event of "), "username"), "source_ip": F.col("src_ip")})
    again = logs.where("event_id % 20 = 0").withColumn("event_id", F.col("event_id") + 1000000000)
    other = logs.where("event_id % 30 = 0").withColumns({"event_id": F.col("event_id") + 2000000000, "message": F.lit("another event")})
    events = enrich_logs(logs.unionByName(again).unionByName(other)).select("event_hash", "event_id")
    kept = dedupe_events(events)
    copies = events.groupBy("event_hash").agg(F.count("*").alias("copies"))
    return kept.join(copies, "event_hash").select("event_id", "copies")


def _facet_sql(table: str, facets: dict[str, str], multi: dict[str, str] | None = None) -> str:
    parts = [f"SELECT 'total' AS facet, CAST(NULL AS VARCHAR) AS value, COUNT(*) AS count, 1 AS rank FROM {table}"]
    srcs = {name: f"SELECT {expr} AS value FROM {table}" for name, expr in facets.items()}
    for name, expr in (multi or {}).items():
        srcs[name] = f"SELECT unnest({expr}) AS value FROM {table}"
    for name, src in srcs.items():
        parts.append(f"""SELECT '{name}' AS facet, value, count, rank FROM (
            SELECT value, COUNT(*) AS count, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, value) AS rank
            FROM ({src}) s WHERE value IS NOT NULL GROUP BY value) t WHERE rank <= 10""")
    return "SELECT facet, value, CAST(count AS BIGINT) AS count, CAST(rank AS BIGINT) AS rank FROM (" + \
        " UNION ALL ".join(parts) + ") u"


@query("log_summary", _facet_sql("sec_enriched", {"log_type": "log_type", "severity": "severity"},
                                 {"threat_type": "threat_list"}), fixtures=["sec_enriched"])
def q_log_summary(spark, sf):
    """A18 totals and facets of the enriched logs."""
    return SR.log_summary(_enriched(spark, sf))


_ALERTS_SQL = "(SELECT 'rule' AS alert_type, severity FROM sec_enriched WHERE severity = 'HIGH') alerts"


@query("alert_summary", _facet_sql(_ALERTS_SQL, {"alert_type": "alert_type", "severity": "severity"}),
       fixtures=["sec_enriched"])
def q_alert_summary(spark, sf):
    """A19 totals and facets of the rule alerts."""
    e = _enriched(spark, sf)
    return SR.alert_summary(AL.alerts_from_rules(e, LOG_FIELDS))


@query("top_attackers", """
WITH hi AS (SELECT * FROM sec_geo WHERE severity IN ('HIGH', 'CRITICAL') AND src_ip IS NOT NULL),
top AS (SELECT src_ip AS ip, COUNT(*) AS attack_count FROM hi GROUP BY src_ip
        ORDER BY attack_count DESC, ip LIMIT 10),
th AS (SELECT ip, string_agg(t, ',' ORDER BY n DESC, t) AS threat_types FROM (
         SELECT src_ip AS ip, t, COUNT(*) AS n FROM (SELECT src_ip, unnest(threat_list) AS t FROM hi) x
         GROUP BY src_ip, t) y GROUP BY ip),
co AS (SELECT ip, arg_min(country_name, (-n, country_name)) AS country FROM (
         SELECT src_ip AS ip, country_name, COUNT(*) AS n FROM hi WHERE country_name IS NOT NULL
         GROUP BY src_ip, country_name) z GROUP BY ip)
SELECT top.ip, top.attack_count, COALESCE(th.threat_types, '') AS threat_types,
       COALESCE(co.country, 'Unknown') AS country
FROM top LEFT JOIN th ON th.ip = top.ip LEFT JOIN co ON co.ip = top.ip
""", fixtures=["sec_geo"])
def q_top_attackers(spark, sf):
    """A20 top attacking addresses with threats and country."""
    return SR.top_attackers(_geo(spark, sf), ip_col="src_ip")


@query("attack_patterns", """
WITH t AS (SELECT * FROM sec_enriched WHERE threat_type IS NOT NULL),
h AS (SELECT date_trunc('hour', event_time) AS hour, COUNT(*) AS n FROM t GROUP BY 1),
m AS (SELECT value, COUNT(*) AS count FROM (SELECT unnest(threat_list) AS value FROM t) x GROUP BY value
      ORDER BY count DESC, value LIMIT 10)
SELECT (SELECT hour FROM h ORDER BY n DESC, hour LIMIT 1) AS peak_attack_hour,
       (SELECT MAX(n) FROM h) AS peak_attack_count,
       (SELECT CAST((epoch(MAX(hour)) - epoch(MIN(hour))) / 3600 + 1 AS BIGINT) FROM h) AS attack_frequency,
       (SELECT string_agg(value || ':' || CAST(count AS VARCHAR), ',' ORDER BY count DESC, value) FROM m)
         AS common_attack_methods
""", fixtures=["sec_enriched"])
def q_attack_patterns(spark, sf):
    """A21 hourly attack histogram summary."""
    return SR.attack_patterns(_enriched(spark, sf))


@query("failed_attempts", """
SELECT src_ip AS ip, COUNT(*) AS events, COUNT(*) FILTER (WHERE result = 'FAILED') AS failures
FROM sec_logs WHERE src_ip IS NOT NULL GROUP BY src_ip ORDER BY events DESC, ip LIMIT 10
""", fixtures=["sec_logs"])
def q_failed_attempts(spark, sf):
    """A22 busiest addresses with their failures."""
    return SR.failed_attempts(fx.sec_logs(spark, sf), ip_col="src_ip")


BF_THRESHOLD, BF_WINDOW_MIN, BF_SLIDE_MIN = 3, 60, 5


@query("brute_force", f"""
SELECT ip, window_start, window_start + INTERVAL {BF_WINDOW_MIN} MINUTE AS window_end, COUNT(*) AS failures
FROM (SELECT src_ip AS ip, event_time,
             time_bucket(INTERVAL {BF_SLIDE_MIN} MINUTE, event_time) - k * INTERVAL {BF_SLIDE_MIN} MINUTE AS window_start
      FROM sec_logs, (SELECT unnest(range(0, {BF_WINDOW_MIN // BF_SLIDE_MIN})) AS k) ks
      WHERE result = 'FAILED') w
GROUP BY ip, window_start HAVING COUNT(*) >= {BF_THRESHOLD}
""", fixtures=["sec_logs"])
def q_brute_force(spark, sf):
    """R18 failed logins per address in sliding windows (1 h every 5 min, >= 3:
    dense attacks are rare in the stand-in data)."""
    return AL.brute_force(fx.sec_logs(spark, sf), threshold=BF_THRESHOLD,
                          window=f"{BF_WINDOW_MIN} minutes", slide=f"{BF_SLIDE_MIN} minutes")


BUSY_THRESHOLD = 3


@query("busy_ips", f"""
SELECT src_ip AS ip, time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
       time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR AS window_end, COUNT(*) AS requests
FROM sec_logs GROUP BY 1, 2 HAVING COUNT(*) >= {BUSY_THRESHOLD}
""", fixtures=["sec_logs"])
def q_busy_ips(spark, sf):
    """R19 requests per address per tumbling window (1 hour, >= 3 here)."""
    return AL.busy_ips(fx.sec_logs(spark, sf), threshold=BUSY_THRESHOLD, window="1 hour")


@query("related_alerts", """
WITH a AS (SELECT event_id, event_time, src_ip, severity FROM sec_enriched WHERE severity = 'HIGH'),
c AS (SELECT a.event_id, a.src_ip,
             (SELECT COUNT(*) FROM a b WHERE b.src_ip = a.src_ip AND b.severity = 'HIGH'
                AND b.event_time >= a.event_time - INTERVAL 2 HOUR AND b.event_time < a.event_time) AS n
      FROM a)
SELECT event_id, src_ip AS ip,
       CASE WHEN n > 0 THEN n END AS related_alerts_count,
       CASE WHEN n > 0 THEN n > 3 END AS is_part_of_campaign
FROM c
""", fixtures=["sec_enriched"])
def q_related_alerts(spark, sf):
    """J03/R11 related HIGH alerts of the same address in the previous 2 hours."""
    e = _enriched(spark, sf)
    alerts = AL.alerts_from_rules(e, ("src_ip", "event_id"))
    r = AL.related_alerts(alerts)
    return r.select(F.col("original_log.event_id").alias("event_id"), F.col("original_log.src_ip").alias("ip"),
                    "related_alerts_count", "is_part_of_campaign")


SUPPRESS_MINUTES_ORACLE = 24 * 60


@query("suppress_alerts", f"""
WITH RECURSIVE a AS (
  SELECT event_id, log_type, src_ip, event_time,
         ROW_NUMBER() OVER (PARTITION BY log_type, src_ip ORDER BY event_time, event_id) AS rn
  FROM sec_logs WHERE result = 'FAILED'),
f(log_type, src_ip, rn, event_id, last_kept, kept) AS (
  SELECT log_type, src_ip, rn, event_id, event_time, TRUE FROM a WHERE rn = 1
  UNION ALL
  SELECT a.log_type, a.src_ip, a.rn, a.event_id,
         CASE WHEN a.event_time >= f.last_kept + INTERVAL {SUPPRESS_MINUTES_ORACLE} MINUTE
              THEN a.event_time ELSE f.last_kept END,
         a.event_time >= f.last_kept + INTERVAL {SUPPRESS_MINUTES_ORACLE} MINUTE
  FROM f JOIN a ON a.log_type = f.log_type AND a.src_ip = f.src_ip AND a.rn = f.rn + 1)
SELECT event_id, log_type, src_ip, kept FROM f
""", fixtures=["sec_logs"])
def q_suppress_alerts(spark, sf):
    """R10 keep an alert only when the last kept one of its key is a window
    older (1-day window: 15 minutes almost never repeats in the stand-in)."""
    a = fx.sec_logs(spark, sf).where(F.col("result") == "FAILED").select("event_id", "log_type", "src_ip",
                                                                          "event_time")
    out = AL.suppress_alerts(a, ["log_type", "src_ip"], "event_time", SUPPRESS_MINUTES_ORACLE,
                             order_cols=["event_id"])
    return out.select("event_id", "log_type", "src_ip", "kept")


_SEV_SQL = "CASE WHEN s > 0.9 THEN 'CRITICAL' WHEN s > 0.8 THEN 'HIGH' WHEN s > 0.6 THEN 'MEDIUM' ELSE 'LOW' END"


@query("alert_channels", f"""
SELECT event_id, severity,
       CASE severity WHEN 'CRITICAL' THEN 'slack,email,pagerduty' WHEN 'HIGH' THEN 'slack,email'
                     WHEN 'MEDIUM' THEN 'slack' ELSE '' END AS channels,
       CASE WHEN contains(COALESCE(threat_type, ''), 'brute_force') THEN 'Bloquear IP origen en firewall'
            WHEN contains(COALESCE(threat_type, ''), 'web_attack') THEN 'Revisar logs del servidor web para otros ataques'
            WHEN contains(COALESCE(threat_type, ''), 'port_scan') THEN 'Bloquear IP origen en firewall perimetral'
            WHEN contains(COALESCE(threat_type, ''), 'malicious_dns') THEN 'Bloquear dominio en DNS resolver'
            ELSE 'Investigar el evento en detalle' END AS first_step
FROM (SELECT event_id, threat_type, {_SEV_SQL} AS severity
      FROM (SELECT event_id, threat_type, (event_id % 100) / 100.0 AS s FROM sec_enriched) x) y
""", fixtures=["sec_enriched"])
def q_alert_channels(spark, sf):
    """R12-R14 severity from a score, channels and first response step for
    every event (score = (event_id % 100) / 100 as a stand-in model output)."""
    e = _enriched(spark, sf).withColumn("s", (F.col("event_id") % 100) / F.lit(100.0))
    sev = AL.score_severity("s")
    return e.select("event_id", sev.alias("severity"),
                    F.array_join(AL.channels_for(sev), ",").alias("channels"),
                    F.element_at(AL.recommendations("threat_type"), 1).alias("first_step"))


@query("geoip_nested", """
WITH nets AS (SELECT start_ip, end_ip, country_name AS name FROM ranges
              UNION ALL SELECT 167772160 + r_regionkey * 2048, 167772160 + r_regionkey * 2048 + 2047, r_name FROM region
              UNION ALL SELECT 167772160 + 300, 167772160 + 1500, 'odd range'
              UNION ALL SELECT 0, 268435455, 'all below 16.0.0.0')
SELECT event_id, src_ip, name AS country_name FROM (
  SELECT e.event_id, e.src_ip, n.name, ROW_NUMBER() OVER (PARTITION BY e.event_id ORDER BY n.end_ip - n.start_ip, n.start_ip) AS k
  FROM (SELECT event_id, src_ip, CASE WHEN src_ip IS NOT NULL THEN CAST(split_part(src_ip, '.', 1) AS BIGINT) * 16777216
               + CAST(split_part(src_ip, '.', 2) AS BIGINT) * 65536 + CAST(split_part(src_ip, '.', 3) AS BIGINT) * 256
               + CAST(split_part(src_ip, '.', 4) AS BIGINT) END AS ip FROM sec_logs) e
  LEFT JOIN nets n ON e.ip BETWEEN n.start_ip AND n.end_ip) x WHERE k = 1
""", fixtures=["sec_logs", "ranges"])
def q_geoip_nested(spark, sf):
    """J04 with nested, overlapping and very wide ranges: the narrowest wins."""
    region = read_parquet_table(spark, sf, "region")
    base = F.lit(167772160).cast("long")
    first = base + F.col("r_regionkey").cast("long") * 2048
    wide = region.select(first.alias("start_ip"), (first + 2047).alias("end_ip"), F.col("r_name").alias("country_name"))
    one = region.where("r_regionkey = 0")
    odd = one.select((base + 300).alias("start_ip"), (base + 1500).alias("end_ip"), F.lit("odd range").alias("country_name"))
    all_of = one.select(F.lit(0).cast("long").alias("start_ip"), F.lit(268435455).cast("long").alias("end_ip"), F.lit("all below 16.0.0.0").alias("country_name"))
    nets = _ranges(spark, sf).select("start_ip", "end_ip", "country_name").unionByName(wide).unionByName(odd).unionByName(all_of)
    return geoip_enrich(_logs(spark, sf), "src_ip", nets).select("event_id", "src_ip", "country_name")


@query("geoip_enrich", """
SELECT event_id, log_type, src_ip, country_name, city_name FROM sec_geo
""", fixtures=["sec_geo"])
def q_geoip_enrich(spark, sf):
    """J04 range join of addresses to nation-derived ranges (web and auth
    always, firewall when public)."""
    return _geo(spark, sf).select("event_id", "log_type", "src_ip", "country_name", "city_name")


_LINE_SQL = ("src_ip || ' - - [' || strftime(event_time, '%d/%b/%Y:%H:%M:%S') || ' +0000] \"GET ' || path || "
             "' HTTP/1.1\" ' || CAST(status_code AS VARCHAR) || ' ' || CAST(packet_count * 100 AS VARCHAR) || "
             "' \"-\" \"' || user_agent || '\"'")


@query("parse_access_log", f"""
SELECT event_id, src_ip AS source_ip, 'GET' AS method, path, status_code, packet_count * 100 AS response_size,
       user_agent, CAST(strptime(strftime(event_time, '%d/%b/%Y:%H:%M:%S'), '%d/%b/%Y:%H:%M:%S') AS TIMESTAMP) AS ts
FROM sec_logs WHERE log_type = 'web'
""", fixtures=["sec_logs"])
def q_parse_access_log(spark, sf):
    """F04/F05 web events written as combined log lines, then parsed back."""
    from eventlens.functions.security import parse_ts
    logs = fx.sec_logs(spark, sf).where(F.col("log_type") == "web")
    line = F.concat(F.col("src_ip"), F.lit(" - - ["), F.date_format("event_time", "dd/MMM/yyyy:HH:mm:ss"),
                    F.lit(' +0000] "GET '), F.col("path"), F.lit(' HTTP/1.1" '), F.col("status_code").cast("string"),
                    F.lit(" "), (F.col("packet_count") * 100).cast("string"), F.lit(' "-" "'),
                    F.col("user_agent"), F.lit('"'))
    p = logs.select("event_id", parse_access_log(line).alias("p"))
    return p.select("event_id", F.col("p.source_ip").alias("source_ip"), F.col("p.method").alias("method"),
                    F.col("p.path").alias("path"), F.col("p.status_code").alias("status_code"),
                    F.col("p.response_size").alias("response_size"), F.col("p.user_agent").alias("user_agent"),
                    parse_ts(F.col("p.timestamp")).cast("timestamp_ntz").alias("ts"))


@query("alerts_per_hour", """
SELECT date_trunc('hour', event_time) AS hour, COUNT(*) AS alerts FROM sec_enriched
WHERE severity = 'HIGH' GROUP BY 1
""", fixtures=["sec_enriched"])
def q_alerts_per_hour(spark, sf):
    """D01 rule alerts per hour."""
    a = AL.alerts_from_rules(_enriched(spark, sf), ("src_ip",))
    return AL.alerts_per_hour(a).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query("log_kpis", """
SELECT date_trunc('minute', event_time) AS minute, COUNT(*) AS events FROM sec_logs GROUP BY 1
""", fixtures=["sec_logs"])
def q_log_kpis(spark, sf):
    """D01 events per minute."""
    return AL.log_kpis(fx.sec_logs(spark, sf)).withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query("off_hours", """
SELECT log_type, COUNT(*) AS events FROM sec_logs
WHERE hour(event_time) < 8 OR hour(event_time) >= 18 GROUP BY log_type
""", fixtures=["sec_logs"])
def q_off_hours(spark, sf):
    """D05 events outside 08:00-18:00 by log type."""
    return AL.off_hours(fx.sec_logs(spark, sf)).groupBy("log_type").agg(F.count("*").alias("events"))


@query("http_error_bursts", """
SELECT src_ip AS ip, time_bucket(INTERVAL 1 HOUR, event_time) AS window_start, COUNT(*) AS errors
FROM sec_logs WHERE log_type = 'web' AND status_code >= 400 GROUP BY 1, 2 HAVING COUNT(*) >= 2
""", fixtures=["sec_logs"])
def q_http_error_bursts(spark, sf):
    """D06 web 4xx/5xx per address per hour (>= 2 in the stand-in)."""
    out = AL.http_error_bursts(fx.sec_logs(spark, sf), threshold=2, window="1 hour")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def _enriched_alerts(spark, sf):
    e = _enriched(spark, sf)
    return AL.enrich_alerts(AL.alerts_from_rules(e, LOG_FIELDS + ("event_id",)))


_ENRICHED_ALERTS_SQL = """
WITH RECURSIVE a AS (
  SELECT event_id, event_time, src_ip, severity, threat_type,
         CONCAT('rule:', log_type, ':', COALESCE(src_ip, 'unknown')) AS alert_key
  FROM sec_enriched WHERE severity = 'HIGH'),
o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY alert_key ORDER BY event_time, event_id) AS rn FROM a),
f(alert_key, rn, event_id, last_kept, kept) AS (
  SELECT alert_key, rn, event_id, event_time, TRUE FROM o WHERE rn = 1
  UNION ALL
  SELECT o.alert_key, o.rn, o.event_id,
         CASE WHEN o.event_time >= f.last_kept + INTERVAL 15 MINUTE THEN o.event_time ELSE f.last_kept END,
         o.event_time >= f.last_kept + INTERVAL 15 MINUTE
  FROM f JOIN o ON o.alert_key = f.alert_key AND o.rn = f.rn + 1),
c AS (SELECT a.*, (SELECT COUNT(*) FROM a b WHERE b.src_ip = a.src_ip AND b.severity = 'HIGH'
                   AND b.event_time >= a.event_time - INTERVAL 2 HOUR AND b.event_time < a.event_time) AS n
      FROM a JOIN f ON f.event_id = a.event_id WHERE f.kept)
SELECT CONCAT('SEC-', strftime(event_time, '%Y%m%d%H%M%S'), '-', substr(sha256(alert_key), 1, 8)) AS alert_id,
       alert_key, event_time AS timestamp, severity, CASE WHEN n > 0 THEN n END AS related_alerts_count,
       CASE WHEN n > 0 THEN n > 3 END AS is_part_of_campaign,
       CASE WHEN contains(COALESCE(threat_type, ''), 'brute_force')
              THEN 'Bloquear IP origen en firewall | Revisar logs de autenticación para otros intentos | Considerar implementar rate limiting | Verificar si las credenciales fueron comprometidas'
            WHEN contains(COALESCE(threat_type, ''), 'web_attack')
              THEN 'Revisar logs del servidor web para otros ataques | Verificar integridad de la aplicación web | Considerar bloquear IP en WAF | Revisar configuración de seguridad web'
            WHEN contains(COALESCE(threat_type, ''), 'port_scan')
              THEN 'Bloquear IP origen en firewall perimetral | Revisar configuración de servicios expuestos | Verificar logs de otros sistemas | Considerar implementar IPS'
            WHEN contains(COALESCE(threat_type, ''), 'malicious_dns')
              THEN 'Bloquear dominio en DNS resolver | Investigar sistema que realizó la consulta | Buscar indicadores de compromiso | Revisar tráfico de red del host afectado'
            ELSE 'Investigar el evento en detalle | Revisar logs relacionados | Verificar si es un falso positivo | Documentar el incidente' END AS recommendations,
       CASE severity WHEN 'CRITICAL' THEN 'slack,email,pagerduty' WHEN 'HIGH' THEN 'slack,email'
                     WHEN 'MEDIUM' THEN 'slack' ELSE '' END AS channels
FROM c
"""


@query("enrich_alerts", _ENRICHED_ALERTS_SQL, fixtures=["sec_enriched"])
def q_enrich_alerts(spark, sf):
    """R17 rule alerts keyed (R09), with the related-alert count over all
    alerts (J03/R11), suppressed for 15 minutes (R10), with id,
    recommendations (R12) and channels (R13)."""
    a = _enriched_alerts(spark, sf)
    return a.select("alert_id", "alert_key", "timestamp", "severity", "related_alerts_count",
                    "is_part_of_campaign", F.array_join("response_recommendations", " | ").alias("recommendations"),
                    F.array_join("notification_channels", ",").alias("channels"))


@query("notification_outbox", f"""
SELECT alert_id, channel,
       CASE channel WHEN 'slack' THEN '⚠️ Alerta de Seguridad - HIGH' ELSE '[HIGH] Alerta de Seguridad - rule' END AS heading,
       CASE channel WHEN 'slack' THEN '#FF8C00' END AS color,
       CASE channel WHEN 'slack' THEN split_part(alert_key, ':', 3) END AS source_ip,
       CASE channel WHEN 'slack' THEN '• ' || array_to_string(string_split(recommendations, ' | ')[1:3], chr(10) || '• ') END AS first_steps
FROM (SELECT *, unnest(string_split(channels, ',')) AS channel FROM ({_ENRICHED_ALERTS_SQL}) e) o
""", fixtures=["sec_enriched"])
def q_notification_outbox(spark, sf):
    """K16 one payload per (alert, channel), read back from its JSON."""
    out = AL.notification_outbox(_enriched_alerts(spark, sf))
    get = lambda path: F.get_json_object("payload", path)
    return out.select("alert_id", "channel", F.coalesce(get("$.attachments[0].title"), get("$.subject"), get("$.payload.summary")).alias("heading"),
                      get("$.attachments[0].color").alias("color"), get("$.attachments[0].fields[1].value").alias("source_ip"),
                      get("$.attachments[0].fields[4].value").alias("first_steps"))
