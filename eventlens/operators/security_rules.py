"""Rule-based enrichment of security logs.

All rules are column expressions evaluated in one projection over a wide
event table (missing fields behave as absent: their tests are false).  Tags
are ``array<string>`` (first occurrence order, no repeats), threat types are
an array with ``threat_type`` = the last one (ruling C5).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.functions.security import event_hash, ip_private_rfc1918, parse_ts, source_ip_of

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
WEB_ATTACK_PATTERN = r"(?i)(union|select|insert|delete|drop|script|alert|javascript)"
TOOL_AGENT_PATTERN = r"(?i)(sqlmap|nikto|nmap|curl|wget|python-requests)"
PORT_SCAN_PACKETS = 50
SENSITIVE_PORTS = (22, 23, 3389, 1433, 3306, 5432)
ADMIN_NAMES = ("admin", "root", "administrator")
SUSPICIOUS_PROCESSES = ("powershell.exe", "cmd.exe", "nc.exe", "wget.exe")
MALICIOUS_DOMAIN_PATTERN = r"(?i)(evil|malware|phishing|suspicious|attacker)"
DNS_FAILURE_CODES = ("NXDOMAIN", "REFUSED")
ATTACK_TAGS = ("web_attack", "network_attack", "auth_attack", "system_attack", "dns_attack")
ERROR_TAGS = ("client_error", "auth_failure", "dns_failure")
DROPPED_FIELDS = ("message", "ident", "auth", "rawrequest", "params")
# ---------------------------------------------------------------------------

LOG_TYPES = ("web", "firewall", "auth", "system", "dns")
def _empty() -> Column:
    return F.array().cast("array<string>")


def _field(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def _when(cond: Column, *values: str) -> Column:
    return F.when(cond, F.array(*[F.lit(v) for v in values])).otherwise(_empty())


def rule_columns(df: DataFrame, scan_query: bool = False) -> dict[str, Column]:
    """R01-R06 as column expressions: ``tags``, ``threat_types``, ``port_risk``,
    ``severity``."""
    lt = _field(df, "log_type")
    path = _field(df, "path")
    if scan_query:                                   # ruling C4: optionally test the query too
        path = F.concat_ws("", path, _field(df, "params"))
    ua = _field(df, "user_agent")
    status = _field(df, "status_code", "int")
    web, fw, auth, sysl, dns = [lt == t for t in LOG_TYPES]
    c = {}
    # R01 web
    c["web_attack"] = web & path.rlike(WEB_ATTACK_PATTERN)
    c["tool"] = web & ua.rlike(TOOL_AGENT_PATTERN)
    c["client_error"] = web & (status >= 400) & (status < 500)
    c["server_error"] = web & (status >= 500)
    # R02 firewall
    c["port_scan"] = fw & (_field(df, "packet_count", "int") > PORT_SCAN_PACKETS)
    c["sensitive_port"] = fw & _field(df, "dst_port", "int").isin(*SENSITIVE_PORTS)
    # R03 auth
    failed = auth & (_field(df, "result") == "FAILED")
    c["auth_failure"] = failed
    c["brute"] = failed & _field(df, "username").isin(*ADMIN_NAMES)
    # R04 system
    c["proc"] = sysl & _field(df, "process_name").isin(*SUSPICIOUS_PROCESSES)
    c["privesc"] = sysl & (_field(df, "event_type") == "privilege_escalation")
    # R05 dns
    c["mal_dns"] = dns & _field(df, "query").rlike(MALICIOUS_DOMAIN_PATTERN)
    c["dns_failure"] = dns & _field(df, "response_code").isin(*DNS_FAILURE_CODES)
    c = {k: F.coalesce(v, F.lit(False)) for k, v in c.items()}

    given = {
        "web_attack": ("sql_injection_attempt", "web_attack"),
        "tool": ("suspicious_user_agent", "web_attack"),
        "client_error": ("client_error",),
        "server_error": ("server_error",),
        "port_scan": ("port_scan", "network_attack"),
        "sensitive_port": ("sensitive_port",),
        "auth_failure": ("auth_failure",),
        "brute": ("admin_brute_force", "auth_attack"),
        "proc": ("suspicious_process", "system_attack"),
        "privesc": ("privilege_escalation", "system_attack"),
        "mal_dns": ("malicious_domain", "dns_attack"),
        "dns_failure": ("dns_failure",),
    }
    tags = F.array_distinct(F.concat(*[_when(c[k], *values) for k, values in given.items()]))
    threats = F.concat(
        _when(c["web_attack"], "web_attack"), _when(c["tool"], "automated_tool"),
        _when(c["port_scan"], "port_scan"), _when(c["brute"], "brute_force"),
        _when(c["proc"], "suspicious_execution"), _when(c["privesc"], "privilege_escalation"),
        _when(c["mal_dns"], "malicious_dns"),
    )
    return {
        "tags": tags,
        "threat_types": threats,
        "port_risk": F.when(c["sensitive_port"], F.lit("high")),
        "severity": rule_severity([c[k] for k, values in given.items() if set(values) & set(ATTACK_TAGS)],
                                  [c[k] for k, values in given.items() if set(values) & set(ERROR_TAGS)]),
    }


def rule_severity(attack: list[Column], error: list[Column]) -> Column:
    """A rule that gives an ``*_attack`` tag -> HIGH, one that gives an error
    tag -> MEDIUM, else LOW.  It asks the rules, not the tags: a filter on the
    severity builds no arrays for the events it drops."""
    return F.when(reduce(or_, attack), "HIGH").when(reduce(or_, error), "MEDIUM").otherwise("LOW")


def enrich_logs(df: DataFrame, scan_query: bool = False, ranges: DataFrame | None = None,
                drop_raw: bool = True) -> DataFrame:
    """Rules by log type, time parse (F05), fingerprint (F06), severity
    and alert flag (R06), processing stamp (P21) and raw-field removal (P19),
    as one projection; GeoIP (J04) when ``ranges`` is given.

    Existing ``severity`` (system logs carry one) is kept as
    ``log_severity``; the rule severity goes to ``severity``.
    """
    out = df
    if "severity" in out.columns:
        out = out.withColumnRenamed("severity", "log_severity")
    rc = rule_columns(out, scan_query)
    ts_text = _field(out, "timestamp")
    new = {
        "processing_timestamp": F.coalesce(parse_ts(ts_text), F.current_timestamp().cast("timestamp_ntz"))
        if "event_time" not in out.columns else F.col("event_time"),
        "tags": rc["tags"],
        "threat_types": rc["threat_types"],
        "threat_type": F.try_element_at(rc["threat_types"], F.lit(-1)),
        "port_risk": rc["port_risk"],
        "event_time_parsed": parse_ts(ts_text),
        "event_hash": event_hash(_field(out, "message"), _field(out, "source_ip"), ts_text),
    }
    out = out.withColumns(new)
    out = out.withColumns({"severity": rc["severity"], "alert_required": rc["severity"] == "HIGH"})
    if drop_raw:
        out = out.drop(*[c for c in DROPPED_FIELDS if c in out.columns])
    if ranges is not None:
        from eventlens.operators.geoip import geoip_enrich
        ip = source_ip_of(*[_field(out, x) for x in ("source_ip", "src_ip")])
        lt = F.col("log_type")
        use = (lt.isin("web", "auth")) | ((lt == "firewall") & ~F.coalesce(ip_private_rfc1918(ip), F.lit(False)))
        out = geoip_enrich(out.withColumn("_geo_ip", F.when(use, ip)), "_geo_ip", ranges).drop("_geo_ip")
    return out


def dedupe_events(df: DataFrame, hash_col: str = "event_hash", order_col: str = "event_id",
                  watermark: str | None = None, ts_col: str | None = None) -> DataFrame:
    """One event per fingerprint.

    Batch: the earliest by ``order_col`` wins, as a ``min_by`` aggregation
    (partial before the shuffle).  Stream: ``dropDuplicatesWithinWatermark``
    keeps state only for the watermark delay.
    """
    if df.isStreaming:
        if watermark and ts_col:
            return df.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark([hash_col])
        return df.dropDuplicates([hash_col])
    others = [c for c in df.columns if c != hash_col]
    bare = df.where(F.col(hash_col).isNull())  # nothing to compare: never duplicates
    return (df.where(F.col(hash_col).isNotNull()).groupBy(hash_col).agg(F.min_by(F.struct(*others), F.col(order_col)).alias("_r"))
            .select(hash_col, *[F.col(f"_r.{c}").alias(c) for c in others]).unionByName(bare))


def stamp_processing_time(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Copy the event time into ``processing_timestamp`` on arrival."""
    return df.withColumn("processing_timestamp", F.col(ts_col))


def drop_fields(df: DataFrame, fields=DROPPED_FIELDS) -> DataFrame:
    """P19."""
    return df.drop(*[c for c in fields if c in df.columns])


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """P20: per-field default for a missing value (absent columns are added)."""
    out = df
    for k, v in defaults.items():
        out = out.withColumn(k, F.coalesce(F.col(k), F.lit(v)) if k in out.columns else F.lit(v))
    return out


def exists(df: DataFrame, field: str) -> DataFrame:
    """Field-exists filter."""
    return df.where(F.col(field).isNotNull())


def in_set(df: DataFrame, col: str, values) -> DataFrame:
    """Terms filter; ``values`` may be a list or a one-column DataFrame
    (then a left-semi join, so big value sets are shuffled, not collected)."""
    if isinstance(values, DataFrame):
        v = values.select(F.col(values.columns[0]).alias(col))
        return df.join(v, on=col, how="left_semi")
    return df.where(F.col(col).isin(*values))


def tagged(df: DataFrame, tags, ts_col: str | None = None, start=None, end=None) -> DataFrame:
    """Events carrying any of ``tags``, optionally in ``[start, end]``."""
    out = df.where(F.arrays_overlap(F.col("tags"), F.array(*[F.lit(t) for t in tags])))
    if ts_col and start is not None:
        out = out.where(F.col(ts_col).between(F.lit(str(start)).cast(out.schema[ts_col].dataType),
                                              F.lit(str(end)).cast(out.schema[ts_col].dataType)))
    return out


def union_log_types(*frames: DataFrame) -> DataFrame:
    """The five log types into one event table (missing columns null)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
