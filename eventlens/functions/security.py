"""Security-log column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# Combined access-log line (client, ident, user, [time], "request", status,
# size, "referer", "agent"), the request split into method, path, query and
# HTTP version when it has that shape.
ACCESS_LOG_PATTERN = (
    r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "(?:([A-Z]+) ([^\s?"]+)(\?[^\s"]*)?(?: HTTP/([0-9.]+))?|([^"]*))" '
    r'(\d+) (\d+|-) "([^"]*)" "([^"]*)"'
)
ACCESS_LOG_FIELDS = ("source_ip", "ident", "auth", "timestamp", "method", "path", "params",
                     "http_version", "rawrequest", "status_code", "response_size", "referer", "user_agent")
# Time formats tried in order after ISO-8601.
TIME_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSSZ", "dd/MMM/yyyy:HH:mm:ss Z")
# Private address tests: the rule engine's full RFC 1918 pattern, and the
# model's prefix list.
RFC1918_PATTERN = r"^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)"
PRIVATE_PREFIXES = ("192.168.", "10.", "172.16.")
# Alert id format.
ALERT_ID_PREFIX = "SEC-"
ALERT_ID_FORMAT = "yyyyMMddHHmmss"
# ---------------------------------------------------------------------------

HASH_NULL_MARKER = "∅"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_access_log(c) -> Column:
    """combined log line -> struct of the 13 captured fields (status and
    size as ints via ``try_cast``) plus ``_parsefailure`` when the line does
    not match."""
    line = _c(c)
    ok = line.rlike(ACCESS_LOG_PATTERN)
    fields = []
    for i, name in enumerate(ACCESS_LOG_FIELDS, start=1):
        v = F.nullif(F.regexp_extract(line, ACCESS_LOG_PATTERN, i), F.lit(""))
        if name in ("status_code", "response_size"):
            v = v.try_cast("int")
        fields.append(F.when(ok, v).alias(name))
    fields.append((~ok).alias("_parsefailure"))
    return F.struct(*fields)


def parse_ts(c) -> Column:
    """first of ISO-8601 and the two patterns that parses; null if none."""
    s = _c(c)
    return F.coalesce(F.try_to_timestamp(s), *[F.try_to_timestamp(s, F.lit(f)) for f in TIME_FORMATS])


def event_hash(*cols) -> Column:
    """SHA-256 fingerprint of the fields joined with ``|``; nulls become a
    marker so (a, null) and (null, a) differ (``concat_ws`` would skip them).
    Null when all fields are null: such events have nothing to compare."""
    parts = [F.coalesce(_c(x).cast("string"), F.lit(HASH_NULL_MARKER)) for x in cols]
    return F.when(F.coalesce(*[_c(x).cast("string") for x in cols]).isNotNull(), F.sha2(F.concat_ws("|", *parts), 256))


def ip_private_rfc1918(c) -> Column:
    """the rule engine's private test (full 172.16/12)."""
    return _c(c).rlike(RFC1918_PATTERN)


def ip_private_prefix(c) -> Column:
    """the model's private test (``172.16.`` prefix only)."""
    s = _c(c)
    out = s.startswith(PRIVATE_PREFIXES[0])
    for p in PRIVATE_PREFIXES[1:]:
        out = out | s.startswith(p)
    return F.coalesce(out, F.lit(False))


def ip_to_long(c) -> Column:
    """dotted IPv4 -> 32-bit number (null when not four octets of 0-255)."""
    parts = F.split(_c(c), r"\.")
    octets = F.transform(parts, lambda x: F.when(x.rlike("^[0-9]{1,3}$") & (x.try_cast("int") <= 255), x.try_cast("long")))
    num = F.aggregate(octets, F.lit(0).cast("long"), lambda acc, x: acc * 256 + x)
    return F.when(F.size(parts) == 4, num)


def source_ip_of(*cols) -> Column:
    """first non-empty of the IP fields (source_ip, src_ip, client_ip)."""
    return F.coalesce(*[F.nullif(_c(x), F.lit("")) for x in cols])


def hour_of_day(ts) -> Column:
    """F09."""
    return F.hour(_c(ts))


def day_of_week(ts) -> Column:
    """Monday = 0."""
    return F.weekday(_c(ts))


def is_weekend(ts) -> Column:
    """Saturday or Sunday as 1/0."""
    return F.when(F.weekday(_c(ts)) >= 5, F.lit(1)).otherwise(F.lit(0))


def alert_id(ts, salt=None) -> Column:
    """``SEC-yyyyMMddHHmmss`` of the alert time; ``salt`` (any column)
    appends 8 hex digits of its hash so ids within one second stay unique."""
    base = F.concat(F.lit(ALERT_ID_PREFIX), F.date_format(_c(ts), ALERT_ID_FORMAT))
    if salt is None:
        return base
    return F.concat(base, F.lit("-"), F.substring(F.sha2(_c(salt).cast("string"), 256), 1, 8))
