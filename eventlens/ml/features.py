"""Per-log-type feature extraction (M00-M05) as column expressions.

Each log type has a fixed, ordered feature list; the projection is plain
Spark columns (no Python), so extraction runs inside codegen and works on
streams too.  Missing source fields take the reference's defaults (P20).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.security import day_of_week, hour_of_day, ip_private_prefix, is_weekend

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
BOT_WORDS = ("bot", "crawler", "spider")
TOOL_WORDS = ("curl", "wget", "python", "sqlmap")
ADMIN_PATHS = ("/admin", "/wp-admin", "/phpmyadmin")
API_PATHS = ("/api", "/rest", "/graphql")
DYNAMIC_SUFFIXES = (".php", ".asp", ".jsp")
HIGH_RISK_PORTS = (22, 23, 3389, 1433, 3306, 5432, 21, 25)
ADMIN_USERS = ("admin", "root", "administrator", "sa")
SUSPICIOUS_PROCESSES = ("powershell.exe", "cmd.exe", "nc.exe", "wget.exe")
SYSTEM_USERS = ("system", "administrator", "root")
SUSPICIOUS_DOMAINS = ("evil.com", "bad.com", "suspicious.org", "attacker.net")
LEGIT_SUFFIXES = (".com", ".org", ".net")
FAILED_RATE = 0.1
DEFAULTS = {
    "status_code": 200, "response_size": 0, "processing_time": 0.0, "method": "GET",
    "user_agent": "", "path": "", "src_port": 0, "dst_port": 0, "packet_count": 0,
    "bytes_transferred": 0, "src_ip": "", "dst_ip": "", "protocol": "TCP", "action": "ALLOW",
    "result": "SUCCESS", "auth_method": "password", "service": "ssh", "username": "",
    "process_id": 0, "event_type": "unknown", "severity": "INFO", "process_name": "", "user": "",
    "response_time": 0.0, "query_type": "A", "response_code": "NOERROR", "query": "",
}
# ---------------------------------------------------------------------------

# Ordered features per type: time features first, then the type's own, in
# the order the reference builds them; (name, kind) with kind num or cat.
FEATURES = {
    "web": [("hour_of_day", "num"), ("day_of_week", "num"), ("is_weekend", "num"),
            ("status_code", "num"), ("response_size", "num"), ("processing_time", "num"),
            ("user_agent_category", "cat"), ("path_category", "cat"), ("method", "cat")],
    "firewall": [("hour_of_day", "num"), ("day_of_week", "num"), ("is_weekend", "num"),
                 ("src_port", "num"), ("dst_port", "num"), ("packet_count", "num"),
                 ("bytes_transferred", "num"), ("src_ip_category", "cat"), ("dst_ip_category", "cat"),
                 ("port_risk_score", "num"), ("protocol", "cat"), ("action", "cat")],
    "auth": [("hour_of_day", "num"), ("day_of_week", "num"), ("is_weekend", "num"),
             ("result", "cat"), ("auth_method", "cat"), ("service", "cat"),
             ("username_category", "cat"), ("is_admin_user", "num"), ("failure_rate", "num")],
    "system": [("hour_of_day", "num"), ("day_of_week", "num"), ("is_weekend", "num"),
               ("process_id", "num"), ("event_type", "cat"), ("severity", "cat"),
               ("is_suspicious_process", "num"), ("process_category", "cat"), ("user_category", "cat")],
    "dns": [("hour_of_day", "num"), ("day_of_week", "num"), ("is_weekend", "num"),
            ("response_time", "num"), ("query_type", "cat"), ("response_code", "cat"),
            ("domain_category", "cat"), ("domain_reputation_score", "num")],
}


def _f(df: DataFrame, name: str) -> Column:
    """Field with the reference's default when absent or null."""
    d = DEFAULTS.get(name)
    if name in df.columns:
        return F.coalesce(F.col(name), F.lit(d)) if d is not None else F.col(name)
    return F.lit(d)


def _any_contains(s: Column, words) -> Column:
    out = s.contains(words[0])
    for w in words[1:]:
        out = out | s.contains(w)
    return out


def _any_endswith(s: Column, suffixes) -> Column:
    out = s.endswith(suffixes[0])
    for w in suffixes[1:]:
        out = out | s.endswith(w)
    return out


def feature_columns(df: DataFrame, log_type: str, ts_col: str = "event_time") -> dict[str, Column]:
    """M01-M05 for one log type (plus F09 time features)."""
    ts = F.col(ts_col)
    c: dict[str, Column] = {"hour_of_day": hour_of_day(ts), "day_of_week": day_of_week(ts),
                            "is_weekend": is_weekend(ts)}
    if log_type == "web":                                                    # M01
        ua, path = F.lower(_f(df, "user_agent")), F.lower(_f(df, "path"))
        c.update({
            "status_code": _f(df, "status_code"), "response_size": _f(df, "response_size"),
            "processing_time": _f(df, "processing_time"),
            "user_agent_category": F.when(_any_contains(ua, BOT_WORDS), "bot")
            .when(_any_contains(ua, TOOL_WORDS), "tool").otherwise("browser"),
            "path_category": F.when(_any_contains(path, ADMIN_PATHS), "admin")
            .when(_any_contains(path, API_PATHS), "api")
            .when(_any_endswith(path, DYNAMIC_SUFFIXES), "dynamic").otherwise("static"),
            "method": _f(df, "method"),
        })
    elif log_type == "firewall":                                             # M02
        c.update({
            "src_port": _f(df, "src_port"), "dst_port": _f(df, "dst_port"),
            "packet_count": _f(df, "packet_count"), "bytes_transferred": _f(df, "bytes_transferred"),
            "src_ip_category": F.when(ip_private_prefix(_f(df, "src_ip")), "private").otherwise("public"),
            "dst_ip_category": F.when(ip_private_prefix(_f(df, "dst_ip")), "private").otherwise("public"),
            "port_risk_score": F.when(_f(df, "dst_port").isin(*HIGH_RISK_PORTS), 1).otherwise(0),
            "protocol": _f(df, "protocol"), "action": _f(df, "action"),
        })
    elif log_type == "auth":                                                 # M03
        user = F.lower(_f(df, "username"))
        admin = user.isin(*ADMIN_USERS)
        c.update({
            "result": _f(df, "result"), "auth_method": _f(df, "auth_method"), "service": _f(df, "service"),
            "username_category": F.when(admin, "admin").otherwise("regular"),
            "is_admin_user": F.when(admin, 1).otherwise(0),
            "failure_rate": F.when(_f(df, "result") == "FAILED", F.lit(FAILED_RATE)).otherwise(F.lit(0.0)),
        })
    elif log_type == "system":                                               # M04
        proc = F.lower(_f(df, "process_name"))
        c.update({
            "process_id": _f(df, "process_id"), "event_type": _f(df, "event_type"),
            "severity": _f(df, "log_severity") if "log_severity" in df.columns else _f(df, "severity"),
            "is_suspicious_process": F.when(proc.isin(*SUSPICIOUS_PROCESSES), 1).otherwise(0),
            "process_category": F.when(proc.endswith(".exe"), "executable")
            .when(proc.endswith(".dll"), "library").otherwise("other"),
            "user_category": F.when(F.lower(_f(df, "user")).isin(*SYSTEM_USERS), "system").otherwise("regular"),
        })
    elif log_type == "dns":                                                  # M05
        q = F.lower(_f(df, "query"))
        sus = _any_contains(q, SUSPICIOUS_DOMAINS)
        legit = _any_endswith(q, LEGIT_SUFFIXES)
        c.update({
            "response_time": _f(df, "response_time"), "query_type": _f(df, "query_type"),
            "response_code": _f(df, "response_code"),
            "domain_category": F.when(sus, "suspicious").when(legit, "legitimate").otherwise("unknown"),
            "domain_reputation_score": F.when(sus, 0.9).when(legit, 0.1).otherwise(0.5),
        })
    else:
        raise ValueError(f"unknown log type {log_type}")
    return {name: c[name] for name, _ in FEATURES[log_type]}


def extract_features(df: DataFrame, log_type: str, keep=("event_id",), ts_col: str = "event_time") -> DataFrame:
    """Rows of one log type -> its ordered feature columns (unknown
    types have no features)."""
    rows = df.where(F.col("log_type") == log_type)
    cols = feature_columns(rows, log_type, ts_col)
    return rows.select(*[F.col(k) for k in keep if k in rows.columns],
                       *[v.alias(k) for k, v in cols.items()])


def with_trailing_failure_rate(df: DataFrame, window_seconds: int = 3600, key: str = "username",
                               ts_col: str = "event_time") -> DataFrame:
    """M03 option: adds ``trailing_failure_rate``, the share of the key's
    events in the ``window_seconds`` before this one that failed (0 without
    any).  Windows run per key and time bucket, so a hot key is split."""
    from eventlens.operators.alerts import trailing_count
    out = trailing_count(df, [key], ts_col, window_seconds, F.lit(True), "_all")
    out = trailing_count(out, [key], ts_col, window_seconds, F.col("result") == "FAILED", "_failed")
    rate = F.when(F.col("_all") > 0, F.col("_failed") / F.col("_all")).otherwise(F.lit(0.0))
    return out.withColumn("trailing_failure_rate", rate).drop("_all", "_failed")
