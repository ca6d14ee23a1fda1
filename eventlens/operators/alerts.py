"""Alert building, suppression and enrichment.

Per-key time logic (trailing counts, suppression) never runs one window
over a whole key: time is cut into buckets so a hot source address is
spread over many tasks, and only small per-(key, bucket) summaries are
carried between buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.functions.security import alert_id, source_ip_of

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
SUPPRESS_MINUTES = 15
RELATED_HOURS = 2
CAMPAIGN_MIN = 3            # campaign when more than this many related alerts
BRUTE_FORCE_THRESHOLD = 10
BRUTE_FORCE_WINDOW = "5 minutes"
BUSY_IP_PER_MINUTE = 50
ANOMALY_THRESHOLD = 0.8
SEVERITY_BANDS = ((0.9, "CRITICAL"), (0.8, "HIGH"), (0.6, "MEDIUM"))
CHANNELS = {
    "CRITICAL": ["slack", "email", "pagerduty"],
    "HIGH": ["slack", "email"],
    "MEDIUM": ["slack"],
    "LOW": [],
}
RECOMMENDATIONS = [
    ("brute_force", ["Bloquear IP origen en firewall",
                     "Revisar logs de autenticación para otros intentos",
                     "Considerar implementar rate limiting",
                     "Verificar si las credenciales fueron comprometidas"]),
    ("web_attack", ["Revisar logs del servidor web para otros ataques",
                    "Verificar integridad de la aplicación web",
                    "Considerar bloquear IP en WAF",
                    "Revisar configuración de seguridad web"]),
    ("port_scan", ["Bloquear IP origen en firewall perimetral",
                   "Revisar configuración de servicios expuestos",
                   "Verificar logs de otros sistemas",
                   "Considerar implementar IPS"]),
    ("malicious_dns", ["Bloquear dominio en DNS resolver",
                       "Investigar sistema que realizó la consulta",
                       "Buscar indicadores de compromiso",
                       "Revisar tráfico de red del host afectado"]),
]
DEFAULT_RECOMMENDATIONS = ["Investigar el evento en detalle",
                           "Revisar logs relacionados",
                           "Verificar si es un falso positivo",
                           "Documentar el incidente"]
REPORT_RECOMMENDATIONS = [
    "Revisar y actualizar reglas de firewall basadas en IPs atacantes identificadas",
    "Implementar rate limiting para prevenir ataques de fuerza bruta",
    "Considerar implementar Web Application Firewall (WAF) para ataques web",
    "Revisar configuración de autenticación multifactor (MFA)",
    "Actualizar sistemas y aplicaciones con últimos parches de seguridad",
    "Realizar auditoría de usuarios con privilegios elevados",
    "Implementar monitoreo de integridad de archivos críticos",
    "Revisar políticas de retención y backup de logs de seguridad",
]
SLACK_EMOJI = {"CRITICAL": "🚨", "HIGH": "⚠️", "MEDIUM": "⚡", "LOW": "ℹ️"}
SLACK_COLORS = {"CRITICAL": "#FF0000", "HIGH": "#FF8C00", "MEDIUM": "#FFD700", "LOW": "#00CED1"}
DESCRIPTION_TEMPLATES = {
    "web": ("Actividad web anómala detectada desde %s", ("source_ip",)),
    "firewall": ("Tráfico de red sospechoso: %s → %s:%s", ("src_ip", "dst_ip", "dst_port")),
    "auth": ("Intento de autenticación anómalo: usuario %s desde %s", ("username", "src_ip")),
    "system": ("Evento de sistema sospechoso: %s en proceso %s", ("event_type", "process_name")),
    "dns": ("Consulta DNS sospechosa: %s desde %s", ("query", "client_ip")),
}
DESCRIPTION_OTHER = "Anomalía detectada en log tipo %s"
DESCRIPTION_SCORE = " (Score: %.3f)"
# ---------------------------------------------------------------------------


def _micros(ts) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


# --------------------------------------------------------------------------- builders


def score_severity(score) -> Column:
    """> .9 CRITICAL, > .8 HIGH, > .6 MEDIUM, else LOW."""
    s = F.col(score) if isinstance(score, str) else score
    out = None
    for limit, name in SEVERITY_BANDS:
        out = (F.when(s > limit, name) if out is None else out.when(s > limit, name))
    return out.otherwise("LOW")


def _fmt_field(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def alert_description(df: DataFrame, score_col: str = "anomaly_score", log_prefix: str = "") -> Column:
    """Per-log-type template and the score to 3 digits."""
    def f(name):
        full = f"{log_prefix}{name}"
        return _fmt_field(F.col(full)) if full.split(".")[-1] in _cols(df, log_prefix) else F.lit("None")
    lt = F.col("log_type")
    out = None
    for t, (tpl, fields) in DESCRIPTION_TEMPLATES.items():
        text = F.format_string(tpl, *[f(x) for x in fields])
        out = F.when(lt == t, text) if out is None else out.when(lt == t, text)
    out = out.otherwise(F.format_string(DESCRIPTION_OTHER, _fmt_field(lt)))
    return F.concat(out, F.format_string(DESCRIPTION_SCORE, F.col(score_col)))


def _cols(df: DataFrame, prefix: str):
    if not prefix:
        return set(df.columns)
    struct = df.schema[prefix.rstrip(".")].dataType
    return {f.name for f in struct.fields}


def build_alerts(scored: DataFrame, log_fields, alert_type: str = "anomaly_detected",
                 ts_col: str = "event_time") -> DataFrame:
    """Alert records (flagged rows only) with the original log nested."""
    flagged = scored.where(F.col("is_anomaly_pred"))
    return flagged.select(
        F.col(ts_col).alias("timestamp"),
        F.lit(alert_type).alias("alert_type"),
        "log_type",
        F.col("anomaly_score"),
        F.struct(*[F.col(c) for c in log_fields]).alias("original_log"),
        score_severity("anomaly_score").alias("severity"),
        alert_description(flagged, "anomaly_score").alias("description"),
    )


def alerts_from_rules(enriched: DataFrame, log_fields, ts_col: str = "event_time") -> DataFrame:
    """Alerts made by the rules (severity HIGH).  Unlike the reference, they
    carry ``alert_type = 'rule'`` and the original log, so their keys are
    per address (section 3.3 of the survey)."""
    return enriched.where(F.col("alert_required")).select(
        F.col(ts_col).alias("timestamp"),
        F.lit("rule").alias("alert_type"),
        "log_type",
        F.lit(None).cast("double").alias("anomaly_score"),
        F.struct(*[F.col(c) for c in log_fields]).alias("original_log"),
        F.col("severity"),
        F.concat_ws(",", "tags").alias("description"),
    )


def _orig(df: DataFrame, name: str) -> Column:
    if "original_log" in df.columns:
        fields = {f.name for f in df.schema["original_log"].dataType.fields}
        if name in fields:
            return F.col(f"original_log.{name}")
    return F.lit(None).cast("string")


def alert_ip(df: DataFrame) -> Column:
    """F10 over the nested original log."""
    return source_ip_of(_orig(df, "source_ip"), _orig(df, "src_ip"), _orig(df, "client_ip"))


def alert_key(df: DataFrame) -> Column:
    """``alert_type:log_type:ip`` with ``unknown`` for missing parts."""
    def part(c):
        return F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))
    return F.concat_ws(":", part(F.col("alert_type")), part(F.col("log_type")),
                       F.coalesce(alert_ip(df), F.lit("unknown")))


def recommendations(threat_type) -> Column:
    """Four response steps chosen by the first matching substring of the
    threat type, in the reference's priority order."""
    t = F.coalesce(F.col(threat_type) if isinstance(threat_type, str) else threat_type, F.lit(""))
    out = None
    for key, steps in RECOMMENDATIONS:
        arr = F.array(*[F.lit(s) for s in steps])
        out = F.when(t.contains(key), arr) if out is None else out.when(t.contains(key), arr)
    return out.otherwise(F.array(*[F.lit(s) for s in DEFAULT_RECOMMENDATIONS]))


def channels_for(severity) -> Column:
    """Notification channels by severity."""
    s = F.col(severity) if isinstance(severity, str) else severity
    out = None
    for sev, chans in CHANNELS.items():
        arr = F.array(*[F.lit(c) for c in chans]).cast("array<string>")
        out = F.when(s == sev, arr) if out is None else out.when(s == sev, arr)
    return out.otherwise(F.array().cast("array<string>"))


def static_recommendations(spark) -> DataFrame:
    """The report's fixed recommendation lines (literal, 8 rows)."""
    return spark.createDataFrame([(i + 1, r) for i, r in enumerate(REPORT_RECOMMENDATIONS)],
                                 "position int, recommendation string")


# --------------------------------------------------------------------------- time logic per key


def trailing_count(df: DataFrame, key_cols, ts_col: str, window_seconds: int, counted: Column,
                   alias: str = "trailing_count") -> DataFrame:
    """W04/J03 core: per row, the number of earlier rows of the same key with
    ``counted`` true and time in ``[t - window, t)``.

    Rows are bucketed by ``floor(t / window)``; each counted row is also
    copied into the next bucket as context, so the window
    ``rangeBetween(-window, -1 µs)`` partitioned by (key, bucket) sees every
    row it needs.  A hot key is split over its time buckets.
    """
    w_us = int(window_seconds) * 1_000_000
    keys = list(key_cols)
    base = df.withColumns({"_t": _micros(ts_col), "_cnt": F.coalesce(counted, F.lit(False)).cast("int")})
    base = base.withColumns({"_b": F.floor(F.col("_t") / F.lit(w_us)), "_ctx": F.lit(0)})
    ctx = (base.where(F.col("_cnt") == 1)
           .select(*keys, "_t", "_cnt", (F.col("_b") + 1).alias("_b"), F.lit(1).alias("_ctx")))
    both = base.unionByName(ctx, allowMissingColumns=True)
    w = Window.partitionBy(*keys, "_b").orderBy("_t").rangeBetween(-w_us, -1)
    out = both.withColumn(alias, F.coalesce(F.sum("_cnt").over(w), F.lit(0)).cast("bigint"))
    return out.where(F.col("_ctx") == 0).drop("_t", "_cnt", "_b", "_ctx")


def related_alerts(alerts: DataFrame, hours: int = RELATED_HOURS, cap: int | None = None,
                   ts_col: str = "timestamp") -> DataFrame:
    """J03 + R11: HIGH alerts (CRITICAL excluded) from the same address in the
    previous ``hours``; the alert itself is not counted.  ``cap`` limits the
    count to a search page (default: the true count).
    ``related_alerts_count`` and ``is_part_of_campaign`` stay null when there
    are none, as the reference only sets them for a non-empty result."""
    a = alerts.withColumn("_ip", alert_ip(alerts))
    with_ip = a.where(F.col("_ip").isNotNull())
    no_ip = a.where(F.col("_ip").isNull()).withColumn("_n", F.lit(0).cast("bigint"))
    counted = trailing_count(with_ip, ["_ip"], ts_col, hours * 3600, F.col("severity") == "HIGH", "_n")
    out = counted.unionByName(no_ip)
    n = F.least(F.col("_n"), F.lit(cap)) if cap else F.col("_n")
    return out.withColumns({
        "related_alerts_count": F.when(n > 0, n),
        "is_part_of_campaign": F.when(n > 0, n > CAMPAIGN_MIN),
    }).drop("_ip", "_n")


def _next_after(points: DataFrame, gap_us: int) -> DataFrame:
    """``points`` (distinct ``_k``, ``_t``) with ``_next``, the key's first
    time at least ``gap_us`` later, and ``_root``: no time of the key lies
    less than ``gap_us`` before.

    Times are cut into buckets of one gap: ``_t + gap`` lies in the bucket
    after ``_t``'s own, so windows run per (key, bucket), and only one row per
    key and bucket crosses bucket borders.
    """
    gap = F.lit(gap_us)
    p = points.withColumn("_b", F.floor(F.col("_t") / gap))
    per = Window.partitionBy("_k").orderBy("_b")
    edge = p.groupBy("_k", "_b").agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    beside = F.lead("_b").over(per) == F.col("_b") + 1
    edge = edge.select("_k", "_b", F.lag("_last").over(per).alias("_before"),
                       F.when(beside, F.lead("_first", 2).over(per)).otherwise(F.lead("_first").over(per)).alias("_after"))
    # a point asks its next bucket for the first point at or after _t + gap
    asks = p.select("_k", (F.col("_b") + 1).alias("_b"), (F.col("_t") + gap).alias("_x"), F.lit(None).cast("long").alias("_at"), "_t")
    have = p.select("_k", "_b", F.col("_t").alias("_x"), F.col("_t").alias("_at"), F.lit(None).cast("long").alias("_t"))
    ahead = Window.partitionBy("_k", "_b").orderBy("_x").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    inside = (asks.unionByName(have).withColumn("_in", F.min("_at").over(ahead)).where("_t is not null")
              .select("_k", "_t", "_in"))
    prev = F.lag("_t").over(Window.partitionBy("_k", "_b").orderBy("_t"))
    p = p.withColumn("_prev", prev).join(edge, ["_k", "_b"])
    p = p.withColumn("_prev", F.coalesce("_prev", "_before"))
    return p.join(inside, ["_k", "_t"]).select(
        "_k", "_t", F.coalesce("_in", "_after").alias("_next"),
        (F.col("_prev").isNull() | (F.col("_t") - F.col("_prev") >= gap)).alias("_root"))


def _kept_times(points: DataFrame, gap_us: int) -> DataFrame:
    """The times (``_k``, ``_t``) whose alerts are kept.

    After a silence of one gap the next time is always kept (a root), and a
    kept time is followed by its ``_next``.  Pointer doubling follows all
    chains at once: with round k the first 2**k steps of every chain are
    known, so a key that never rests takes a few more rounds, not one long
    task.  Rounds are written to the shared checkpoint folder.
    """
    from eventlens.sinks.writers import staged
    steps = staged(_next_after(points, gap_us), "suppress-next")
    kept = staged(steps.where("_root").select("_k", "_t"), "suppress-kept")
    jump = steps.where("_next is not null").select("_k", "_t", "_next")
    n = kept.count()
    while n:
        more = kept.join(jump, ["_k", "_t"]).select("_k", F.col("_next").alias("_t"))
        kept = staged(kept.unionByName(more).distinct(), "suppress-kept")
        last, n = n, kept.count()
        if n == last:
            break
        onward = jump.select("_k", F.col("_t").alias("_next"), F.col("_next").alias("_far"))
        jump = staged(jump.join(onward, ["_k", "_next"]).select("_k", "_t", F.col("_far").alias("_next")), "suppress-jump")
    return kept


def suppress_alerts(alerts: DataFrame, key_cols, ts_col: str = "timestamp", minutes: int = SUPPRESS_MINUTES,
                    order_cols=()) -> DataFrame:
    """R10 (batch): keep an alert only if the last *kept* alert of its key is
    at least ``minutes`` older (alerts at 0, 10, 20, 29, 35 min keep 0, 20, 35).

    Works on the distinct (key, time) pairs alone (:func:`_kept_times`); of
    alerts of one key and time the first by ``order_cols`` is kept (any one
    of full ties).  The clock is the alert's own time, so replays agree; an
    alert without a time is kept.  Adds ``kept`` (boolean).
    """
    a = alerts.withColumns({"_k": F.to_json(F.struct(*key_cols)), "_t": _micros(ts_col)})
    kept = _kept_times(a.where("_t is not null").select("_k", "_t").distinct(), int(minutes) * 60 * 1_000_000)
    kept = kept.withColumn("_hit", F.lit(True))
    first = Window.partitionBy("_k", "_t").orderBy(*(order_cols or ["_t"]))
    a = a.withColumn("_n", F.row_number().over(first)).join(kept, ["_k", "_t"], "left")
    keep = F.col("_t").isNull() | ((F.col("_n") == 1) & F.coalesce("_hit", F.lit(False)))
    return a.withColumn("kept", keep).drop("_k", "_t", "_n", "_hit")


# --------------------------------------------------------------------------- enrichment and outbox


def enrich_alerts(alerts: DataFrame, key_cols=("alert_key",), ts_col: str = "timestamp",
                  minutes: int = SUPPRESS_MINUTES) -> DataFrame:
    """Key (R09) -> related alerts (J03, R11, counted over all alerts, as
    the index they are searched in holds them all) -> suppression (R10) -> id
    and processing time (F12) -> recommendations (R12) -> channels (R13).  The
    alerts are written once, so their source is read once."""
    from eventlens.sinks.writers import staged
    a = staged(alerts.withColumn("alert_key", alert_key(alerts)), "alerts")
    a = related_alerts(a, ts_col=ts_col)
    tie = [F.to_json("original_log")] if "original_log" in a.columns else []
    a = suppress_alerts(a, list(key_cols), ts_col, minutes, tie).where(F.col("kept")).drop("kept")
    a = a.withColumns({"alert_id": alert_id(F.col(ts_col), F.col("alert_key")),
                       "processed_at": F.col(ts_col)})
    return a.withColumns({"response_recommendations": recommendations(_orig(a, "threat_type")),
                          "notification_channels": channels_for("severity")})


def slack_payload(a: DataFrame) -> Column:
    """Slack message: colour, title, description, four short fields, and the
    first three response steps."""
    sev = F.coalesce("severity", F.lit("LOW"))
    style = lambda values: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), sev), F.lit(values["LOW"]))
    field = lambda title, value, short=True: F.struct(F.lit(title).alias("title"), value.alias("value"), F.lit(short).alias("short"))
    fields = F.array(
        field("Tipo de Alerta", F.coalesce("alert_type", F.lit("unknown"))), field("IP Origen", F.coalesce(alert_ip(a), F.lit("N/A"))),
        field("Timestamp", F.coalesce(F.col("timestamp").cast("string"), F.lit("N/A"))),
        field("Score de Anomalía", F.format_string("%.3f", F.coalesce("anomaly_score", F.lit(0.0)))),
        field("Recomendaciones", F.array_join(F.transform(F.slice("response_recommendations", 1, 3), lambda r: F.concat(F.lit("• "), r)), "\n"), False))
    return F.to_json(F.struct(F.array(F.struct(
        style(SLACK_COLORS).alias("color"), F.concat(style(SLACK_EMOJI), F.lit(" Alerta de Seguridad - "), sev).alias("title"),
        F.coalesce("description", F.lit("Sin descripción")).alias("text"), fields.alias("fields"),
        F.lit("Security Pipeline").alias("footer"))).alias("attachments")))


def email_payload(a: DataFrame) -> Column:
    """E-mail subject and body, with the original log and all steps."""
    sev = F.coalesce("severity", F.lit("LOW"))
    kind = F.coalesce("alert_type", F.lit("unknown"))
    steps = F.array_join(F.transform("response_recommendations", lambda r, i: F.concat((i + 1).cast("string"), F.lit(". "), r)), "\n")
    log = F.to_json("original_log") if "original_log" in a.columns else F.lit("{}")
    body = F.concat_ws("\n", F.lit("ALERTA DE SEGURIDAD"), F.concat(F.lit("Severidad: "), sev), F.concat(F.lit("Tipo: "), kind),
                       F.concat(F.lit("Descripción: "), F.coalesce("description", F.lit("Sin descripción"))),
                       F.concat(F.lit("Timestamp: "), F.coalesce(F.col("timestamp").cast("string"), F.lit("N/A"))),
                       F.lit("Detalles del Log Original:"), log, F.lit("Recomendaciones de Respuesta:"), steps,
                       F.concat(F.lit("ID: "), F.coalesce("alert_id", F.lit("N/A"))))
    subject = F.concat(F.lit("["), sev, F.lit("] Alerta de Seguridad - "), kind)
    return F.to_json(F.struct(subject.alias("subject"), body.alias("body")))


def pagerduty_payload(a: DataFrame) -> Column:
    """PagerDuty trigger event, deduplicated by alert id."""
    log = F.col("original_log") if "original_log" in a.columns else F.create_map()
    return F.to_json(F.struct(
        F.lit("trigger").alias("event_action"), F.col("alert_id").alias("dedup_key"), F.struct(
            F.coalesce("description", F.lit("Alerta de seguridad")).alias("summary"),
            F.lower(F.coalesce("severity", F.lit("low"))).alias("severity"), F.lit("Security Pipeline").alias("source"),
            F.coalesce("log_type", F.lit("unknown")).alias("component"), F.lit("security").alias("group"),
            F.coalesce("alert_type", F.lit("unknown")).alias("class"), log.alias("custom_details")).alias("payload")))


def notification_outbox(enriched: DataFrame) -> DataFrame:
    """One payload row per (alert, channel) in the channel's own shape,
    for a sender job (sending itself is out of scope)."""
    out = enriched.withColumn("channel", F.explode("notification_channels"))
    payload = (F.when(F.col("channel") == "slack", slack_payload(out)).when(F.col("channel") == "email", email_payload(out))
               .when(F.col("channel") == "pagerduty", pagerduty_payload(out)))
    return out.select("alert_id", "channel", payload.alias("payload"))


# --------------------------------------------------------------------------- thresholds on windows


def brute_force(df: DataFrame, ip_col: str = "src_ip", ts_col: str = "event_time",
                threshold: int = BRUTE_FORCE_THRESHOLD, window: str = BRUTE_FORCE_WINDOW,
                slide: str = "1 minute", failed: Column | None = None) -> DataFrame:
    """R18/ST07: failed logins per address in sliding windows; windows with
    at least ``threshold``.  Works on a stream after ``withWatermark``."""
    f = df.where(failed if failed is not None else (F.col("result") == "FAILED"))
    g = (f.groupBy(F.col(ip_col).alias("ip"), F.window(ts_col, window, slide).alias("w"))
         .agg(F.count("*").alias("failures")).where(F.col("failures") >= threshold))
    return g.select("ip", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "failures")


def busy_ips(df: DataFrame, ip_col: str = "src_ip", ts_col: str = "event_time",
             threshold: int = BUSY_IP_PER_MINUTE, window: str = "1 minute") -> DataFrame:
    """Requests per address per tumbling minute at or above the
    threshold."""
    g = (df.groupBy(F.col(ip_col).alias("ip"), F.window(ts_col, window).alias("w"))
         .agg(F.count("*").alias("requests")).where(F.col("requests") >= threshold))
    return g.select("ip", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests")


def log_kpis(logs: DataFrame, ts_col: str = "event_time") -> DataFrame:
    """Events per minute (tumbling windows)."""
    g = logs.groupBy(F.window(ts_col, "1 minute").alias("w")).agg(F.count("*").alias("events"))
    return g.select(F.col("w.start").alias("minute"), "events")


def detection_quality(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """Confusion counts and false positive / negative rates."""
    lab = F.col(label_col).cast("boolean")
    pred = F.col(pred_col).cast("boolean")
    a = df.agg(F.count_if(lab & pred).alias("tp"), F.count_if(~lab & pred).alias("fp"),
               F.count_if(~lab & ~pred).alias("tn"), F.count_if(lab & ~pred).alias("fn"))
    return a.withColumns({
        "false_positive_rate": F.when(F.col("fp") + F.col("tn") > 0, F.col("fp") / (F.col("fp") + F.col("tn"))),
        "false_negative_rate": F.when(F.col("fn") + F.col("tp") > 0, F.col("fn") / (F.col("fn") + F.col("tp"))),
    })


def off_hours(df: DataFrame, ts_col: str = "event_time", start_hour: int = 8, end_hour: int = 18) -> DataFrame:
    """Events outside working hours."""
    h = F.hour(ts_col)
    return df.where((h < start_hour) | (h >= end_hour))


def http_error_bursts(df: DataFrame, ts_col: str = "event_time", threshold: int = 10,
                      window: str = "5 minutes") -> DataFrame:
    """4xx/5xx responses per address per window at or above a threshold."""
    e = df.where((F.col("log_type") == "web") & (F.col("status_code") >= 400))
    g = (e.groupBy(F.col("src_ip").alias("ip"), F.window(ts_col, window).alias("w"))
         .agg(F.count("*").alias("errors")).where(F.col("errors") >= threshold))
    return g.select("ip", F.col("w.start").alias("window_start"), "errors")


def ml_anomalies(alerts: DataFrame, threshold: float = ANOMALY_THRESHOLD,
                 alert_type: str = "anomaly_detected") -> DataFrame:
    """Model alerts at or above a score."""
    return alerts.where((F.col("alert_type") == alert_type) & (F.col("anomaly_score") >= threshold))


def alerts_per_hour(alerts: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Alerts per hour (tumbling windows)."""
    g = alerts.groupBy(F.window(ts_col, "1 hour").alias("w")).agg(F.count("*").alias("alerts"))
    return g.select(F.col("w.start").alias("hour"), "alerts")
