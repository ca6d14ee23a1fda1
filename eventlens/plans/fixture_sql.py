"""DuckDB twins of ``eventlens.fixtures`` for the SQL oracle.

Each entry is the SELECT body of one stand-in table over the driver's views;
:func:`with_fixtures` puts the needed ones in front of a query as CTEs.
Keep each body in step with its DataFrame builder.
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2024-01-31 00:00:00'"

_LEX_POS = ("the", "and", "for", "que", "that")
_LEX_NEG = ("der", "was", "die", "with", "des")


def _hits(words) -> str:
    return "(" + " + ".join(f"(CASE WHEN contains(lower(text), '{w}') THEN 1 ELSE 0 END)" for w in words) + ")"


FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["posts"] = """
SELECT CAST(e.event_id AS VARCHAR) AS post_id, d.text AS text, e.ts AS created_at,
       CAST(e.user_id AS VARCHAR) AS author_id, d.lang AS lang,
       CAST(FLOOR(e.value) AS INTEGER) AS like_count, CAST(e.event_id % 13 AS INTEGER) AS retweet_count,
       CASE e.event_type WHEN 'purchase' THEN 'positive' WHEN 'signup' THEN 'positive'
                         WHEN 'error' THEN 'negative' ELSE 'neutral' END AS predicted_sentiment,
       CAST(ROUND((e.event_id % 101) / 100.0, 2) AS DOUBLE) AS confidence
FROM events e JOIN documents d ON d.doc_id = e.event_id % (SELECT COUNT(*) FROM documents)
"""

FIXTURE_SQL["lex"] = f"""
SELECT *, CAST({_hits(_LEX_POS)} AS DOUBLE) / {float(len(_LEX_POS))} AS p0,
          CAST({_hits(_LEX_NEG)} AS DOUBLE) / {float(len(_LEX_NEG))} AS n0
FROM posts
"""

FIXTURE_SQL["sentiment"] = """
SELECT post_id, text, created_at, author_id, lang, like_count, retweet_count, predicted_sentiment, confidence,
       CASE WHEN text IS NULL OR text = '' THEN 0.33 ELSE p0 / (p0 + n0 + (1.0 - p0 - n0)) END AS sentiment_positive,
       CASE WHEN text IS NULL OR text = '' THEN 0.34 ELSE (1.0 - p0 - n0) / (p0 + n0 + (1.0 - p0 - n0)) END AS sentiment_neutral,
       CASE WHEN text IS NULL OR text = '' THEN 0.33 ELSE n0 / (p0 + n0 + (1.0 - p0 - n0)) END AS sentiment_negative,
       created_at AS processing_timestamp, CAST(created_at AS DATE) AS date_partition
FROM lex
"""

FIXTURE_SQL["incidents"] = """
SELECT o_orderkey AS incident_seq, CAST(o_orderdate AS DATE) AS fecha_accidente,
       CONCAT(LPAD(CAST(o_orderkey % 4 AS VARCHAR), 2, '0'), ':00') AS hora_accidente,
       o_orderpriority AS gravedad_accidente, c_mktsegment AS clase_accidente,
       n_name AS comuna, o_orderstatus AS barrio,
       CAST(6.15 + (o_custkey % 10) / 1000.0 AS DECIMAL(10,6)) AS latitud,
       CAST(-75.6 + (o_custkey % 10) / 1000.0 AS DECIMAL(10,6)) AS longitud
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
"""

FIXTURE_SQL["incidents_raw"] = """
SELECT incident_seq, CAST(fecha_accidente AS VARCHAR) AS fecha, hora_accidente AS hora,
       gravedad_accidente AS gravedad, clase_accidente AS clase_incidente, comuna, barrio,
       CASE WHEN barrio = 'P' THEN 'sin dato' ELSE CAST(latitud AS VARCHAR) END AS latitud,
       CAST(longitud AS VARCHAR) AS longitud
FROM incidents
"""

FIXTURE_SQL["sec_logs"] = """
SELECT event_id, ts AS event_time,
       CASE event_id % 5 WHEN 0 THEN 'web' WHEN 1 THEN 'firewall' WHEN 2 THEN 'auth'
                         WHEN 3 THEN 'system' ELSE 'dns' END AS log_type,
       CONCAT('10.0.', CAST(CAST(FLOOR(user_id / 16) AS INTEGER) AS VARCHAR), '.', CAST(user_id % 16 AS VARCHAR)) AS src_ip,
       CASE event_id % 7 WHEN 0 THEN 'admin' WHEN 1 THEN 'root' ELSE CONCAT('u', CAST(user_id AS VARCHAR)) END AS username,
       CASE WHEN event_type IN ('error', 'click') THEN 'FAILED' ELSE 'SUCCESS' END AS result,
       CASE event_id % 6 WHEN 0 THEN 22 WHEN 1 THEN 3389 ELSE 443 END AS dst_port,
       CAST(FLOOR(value) AS INTEGER) AS packet_count,
       CASE event_id % 11 WHEN 0 THEN '/search/union-select' WHEN 1 THEN '/wp-admin/index.php'
                          WHEN 2 THEN '/api/items' WHEN 3 THEN '/cart.jsp'
                          ELSE CONCAT('/page/', CAST(user_id AS VARCHAR)) END AS path,
       CASE event_id % 9 WHEN 0 THEN 'sqlmap/1.5' WHEN 1 THEN 'curl/7.68' WHEN 2 THEN 'Googlebot/2.1'
                         ELSE 'Mozilla/5.0' END AS user_agent,
       CASE event_type WHEN 'error' THEN 500 WHEN 'click' THEN 404 ELSE 200 END AS status_code,
       CASE event_id % 8 WHEN 0 THEN 'cmd.exe' WHEN 1 THEN 'powershell.exe' WHEN 2 THEN 'svchost.dll'
                         ELSE 'bash' END AS process_name,
       CASE WHEN event_id % 10 = 0 THEN 'privilege_escalation' ELSE 'process_start' END AS event_type,
       CASE event_id % 12 WHEN 0 THEN 'malware-cdn.evil.com' WHEN 1 THEN 'api.example.org'
                          ELSE CONCAT('host', CAST(user_id AS VARCHAR), '.example.com') END AS query,
       CASE event_id % 7 WHEN 0 THEN 'NXDOMAIN' WHEN 1 THEN 'REFUSED' ELSE 'NOERROR' END AS response_code
FROM events
"""

FIXTURE_SQL["videos_raw"] = """
SELECT CONCAT('v', CAST(l_partkey AS VARCHAR)) AS video_id,
       strftime(l_shipdate, '%y.%d.%m') AS trending_date,
       CONCAT('title ', CAST(l_orderkey AS VARCHAR)) AS title,
       CONCAT('ch', CAST(l_suppkey AS VARCHAR)) AS channel_title,
       l_linenumber AS category_id,
       CAST(l_shipdate AS VARCHAR) AS publish_time,
       CONCAT(l_returnflag, '|', l_linestatus) AS tags,
       CAST(l_quantity * 1000 AS BIGINT) AS views,
       CAST(FLOOR(l_extendedprice / 100) AS BIGINT) AS likes,
       CAST(FLOOR(l_discount * 100) AS BIGINT) AS dislikes,
       CAST(FLOOR(l_tax * 100) AS BIGINT) AS comment_count,
       CONCAT('https://img.example/v', CAST(l_partkey AS VARCHAR)) AS thumbnail_link,
       l_returnflag = 'R' AS comments_disabled,
       l_linestatus = 'F' AS ratings_disabled,
       FALSE AS video_error_or_removed,
       '' AS description
FROM lineitem
"""

FIXTURE_SQL["price_flat"] = """
SELECT event_id AS tick_id,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * 1 END AS bitcoin_usd,
       CASE WHEN event_id % 3 = 1 THEN NULL ELSE value * 2 END AS dogecoin_usd,
       CASE WHEN event_id % 3 = 2 THEN NULL ELSE value * 3 END AS ethereum_usd,
       epoch_us(ts) / 1e6 AS event_epoch
FROM events
"""

FIXTURE_SQL["price_batch"] = """
SELECT CAST(event_id AS INTEGER) AS trade_id,
       CASE event_id % 3 WHEN 0 THEN 'bitcoin' WHEN 1 THEN 'ethereum' ELSE 'dogecoin' END AS coin_name,
       value AS price_usd,
       CAST(epoch_us(ts) // 1000000 AS INTEGER) AS trade_timestamp
FROM events
"""

FIXTURE_SQL["log_lines"] = """
SELECT doc_id AS file_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS line_no,
       unnest(string_split(text, chr(10))) AS line
FROM documents
"""

FIXTURE_SQL["incidents_clean"] = """
SELECT incident_seq, CAST(TRY_CAST(fecha AS TIMESTAMP) AS DATE) AS fecha_accidente, hora AS hora_accidente,
       gravedad AS gravedad_accidente, clase_incidente AS clase_accidente, 'DESCONOCIDO' AS lugar_accidente,
       comuna, barrio, TRY_CAST(latitud AS DECIMAL(10,6)) AS latitud, TRY_CAST(longitud AS DECIMAL(10,6)) AS longitud
FROM incidents_raw
WHERE TRY_CAST(latitud AS DECIMAL(10,6)) IS NOT NULL AND TRY_CAST(longitud AS DECIMAL(10,6)) IS NOT NULL
"""

FIXTURE_SQL["videos_stg"] = """
SELECT video_id,
       CAST(try_strptime(CASE WHEN CAST(substr(trending_date, 1, 2) AS INTEGER) >= 70 THEN '19' ELSE '20' END
                         || trending_date, '%Y.%d.%m') AS DATE) AS trending_date,
       title, channel_title, category_id, publish_time, tags, views, likes, dislikes, comment_count,
       thumbnail_link, comments_disabled, ratings_disabled, video_error_or_removed, description
FROM videos_raw
"""

FIXTURE_SQL["videos_fct"] = """
SELECT video_id, trending_date, title, channel_title, category_id, views, likes, dislikes, comment_count,
       CAST(likes + dislikes + comment_count AS DOUBLE) / CAST(views AS DOUBLE) AS engagement_rate,
       dayname(trending_date) AS trending_day_of_week
FROM videos_stg WHERE views > 0
"""

_TS = "CAST(make_timestamp(CAST(round({e} * 1e6) AS BIGINT)) AS TIMESTAMP)"

FIXTURE_SQL["price_stream"] = " UNION ALL ".join(
    f"""SELECT CAST(NULL AS BIGINT) AS trade_id, '{c}' AS coin, {c}_usd AS price, event_epoch,
       {_TS.format(e="event_epoch")} AS event_timestamp, 'streaming' AS source
FROM price_flat WHERE {c}_usd IS NOT NULL""" for c in ("bitcoin", "ethereum", "dogecoin"))

FIXTURE_SQL["price_batch_norm"] = f"""
SELECT CAST(trade_id AS BIGINT) AS trade_id, coin_name AS coin, CAST(price_usd AS DOUBLE) AS price,
       CAST(trade_timestamp AS DOUBLE) AS event_epoch,
       {_TS.format(e="CAST(trade_timestamp AS DOUBLE)")} AS event_timestamp, 'batch' AS source
FROM price_batch
"""

def _arr(cond: str, *vals: str) -> str:
    lit = ", ".join(f"'{v}'" for v in vals)
    return f"(CASE WHEN COALESCE({cond}, FALSE) THEN [{lit}] ELSE CAST([] AS VARCHAR[]) END)"


_WEB_ATTACK = "regexp_matches(path, '(?i)(union|select|insert|delete|drop|script|alert|javascript)')"
_TOOL = "regexp_matches(user_agent, '(?i)(sqlmap|nikto|nmap|curl|wget|python-requests)')"
_R = {
    "web_attack": f"log_type = 'web' AND {_WEB_ATTACK}",
    "tool": f"log_type = 'web' AND {_TOOL}",
    "client_error": "log_type = 'web' AND status_code >= 400 AND status_code < 500",
    "server_error": "log_type = 'web' AND status_code >= 500",
    "port_scan": "log_type = 'firewall' AND packet_count > 50",
    "sensitive_port": "log_type = 'firewall' AND dst_port IN (22, 23, 3389, 1433, 3306, 5432)",
    "auth_failure": "log_type = 'auth' AND result = 'FAILED'",
    "brute": "log_type = 'auth' AND result = 'FAILED' AND username IN ('admin', 'root', 'administrator')",
    "proc": "log_type = 'system' AND process_name IN ('powershell.exe', 'cmd.exe', 'nc.exe', 'wget.exe')",
    "privesc": "log_type = 'system' AND event_type = 'privilege_escalation'",
    "mal_dns": "log_type = 'dns' AND regexp_matches(query, '(?i)(evil|malware|phishing|suspicious|attacker)')",
    "dns_failure": "log_type = 'dns' AND response_code IN ('NXDOMAIN', 'REFUSED')",
}

FIXTURE_SQL["sec_tagged"] = f"""
SELECT *, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
       list_distinct({" || ".join([
           _arr(_R["web_attack"], "sql_injection_attempt", "web_attack"),
           _arr(_R["tool"], "suspicious_user_agent", "web_attack"),
           _arr(_R["client_error"], "client_error"), _arr(_R["server_error"], "server_error"),
           _arr(_R["port_scan"], "port_scan", "network_attack"), _arr(_R["sensitive_port"], "sensitive_port"),
           _arr(_R["auth_failure"], "auth_failure"), _arr(_R["brute"], "admin_brute_force", "auth_attack"),
           _arr(_R["proc"], "suspicious_process", "system_attack"),
           _arr(_R["privesc"], "privilege_escalation", "system_attack"),
           _arr(_R["mal_dns"], "malicious_domain", "dns_attack"), _arr(_R["dns_failure"], "dns_failure")])}) AS tag_list,
       {" || ".join([_arr(_R["web_attack"], "web_attack"), _arr(_R["tool"], "automated_tool"),
                     _arr(_R["port_scan"], "port_scan"), _arr(_R["brute"], "brute_force"),
                     _arr(_R["proc"], "suspicious_execution"), _arr(_R["privesc"], "privilege_escalation"),
                     _arr(_R["mal_dns"], "malicious_dns")])} AS threat_list,
       CASE WHEN COALESCE({_R["sensitive_port"]}, FALSE) THEN 'high' END AS port_risk
FROM sec_logs
"""

FIXTURE_SQL["sec_enriched"] = """
SELECT *, threat_list[-1] AS threat_type,
       CASE WHEN list_has_any(tag_list, ['web_attack', 'network_attack', 'auth_attack', 'system_attack', 'dns_attack'])
            THEN 'HIGH'
            WHEN list_has_any(tag_list, ['client_error', 'auth_failure', 'dns_failure']) THEN 'MEDIUM'
            ELSE 'LOW' END AS severity,
       sha256(concat_ws('|', '∅', '∅', timestamp)) AS event_hash
FROM sec_tagged
"""

FIXTURE_SQL["ranges"] = """
SELECT CAST(167772160 + n_nationkey * 256 AS BIGINT) AS start_ip,
       CAST(167772160 + n_nationkey * 256 + 255 AS BIGINT) AS end_ip,
       n_name AS country_name, r_name AS city_name
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""

FIXTURE_SQL["sec_geo"] = r"""
SELECT e.*, r.country_name, r.city_name
FROM (SELECT *, CASE WHEN log_type IN ('web', 'auth')
                       OR (log_type = 'firewall'
                           AND NOT regexp_matches(src_ip, '^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)'))
                     THEN CAST(split_part(src_ip, '.', 1) AS BIGINT) * 16777216
                          + CAST(split_part(src_ip, '.', 2) AS BIGINT) * 65536
                          + CAST(split_part(src_ip, '.', 3) AS BIGINT) * 256
                          + CAST(split_part(src_ip, '.', 4) AS BIGINT) END AS ip_long
      FROM sec_enriched) e
LEFT JOIN ranges r ON e.ip_long BETWEEN r.start_ip AND r.end_ip
"""

# Which fixtures each fixture needs (CTE order).
_DEPS = {
    "posts": [], "lex": ["posts"], "sentiment": ["posts", "lex"], "incidents": [],
    "incidents_raw": ["incidents"], "incidents_clean": ["incidents", "incidents_raw"],
    "sec_logs": [], "videos_raw": [], "videos_stg": ["videos_raw"],
    "videos_fct": ["videos_raw", "videos_stg"], "price_flat": [],
    "price_stream": ["price_flat"], "price_batch": [], "price_batch_norm": ["price_batch"],
    "log_lines": [], "sec_tagged": ["sec_logs"], "sec_enriched": ["sec_logs", "sec_tagged"],
    "ranges": [], "sec_geo": ["sec_logs", "sec_tagged", "sec_enriched", "ranges"],
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with ``WITH`` CTEs for the named fixtures (and what they
    need).  ``sql`` may start with its own ``WITH``; its CTEs are appended."""
    if not names:
        return sql.strip()
    order: list[str] = []
    for n in names:
        for d in _DEPS[n] + [n]:
            if d not in order:
                order.append(d)
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]})" for n in order)
    body = sql.strip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def round6(sql: str, cols) -> str:
    """Round the named double columns to 6 digits (hash hygiene)."""
    if not cols:
        return sql
    rep = ", ".join(f"CASE WHEN abs({c}) < 1e12 THEN floor({c} * 1e6 + 0.5) / 1e6 + 0.0 ELSE {c} END AS {c}"
                    for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) q_round"
