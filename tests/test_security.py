"""Rule tables, parsing, related alerts, GeoIP and folding on hand rows."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from eventlens.functions.security import event_hash, ip_to_long, parse_access_log, parse_ts
from eventlens.operators import alerts as AL
from eventlens.operators.geoip import cidr_blocks, geoip_enrich
from eventlens.operators.ingest import raw_log_events
from eventlens.operators.security_rules import enrich_logs
from eventlens.sources.streams import fold_multiline

LOG_SCHEMA = ("log_type string, source_ip string, src_ip string, path string, user_agent string, "
              "status_code int, packet_count int, dst_port int, result string, username string, "
              "process_name string, event_type string, query string, response_code string, timestamp string")


def _row(**kw):
    cols = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
    return tuple(kw.get(c) for c in cols)


def test_rule_table(spark):
    rows = [
        _row(log_type="web", source_ip="1.2.3.4", path="/x?id=1 UNION SELECT", user_agent="sqlmap", status_code=403),
        _row(log_type="web", source_ip="1.2.3.4", path="/index.html", user_agent="Mozilla", status_code=503),
        _row(log_type="firewall", src_ip="8.8.8.8", packet_count=51, dst_port=22),
        _row(log_type="auth", src_ip="10.0.0.1", result="FAILED", username="root"),
        _row(log_type="auth", src_ip="10.0.0.1", result="FAILED", username="bob"),
        _row(log_type="system", process_name="nc.exe", event_type="privilege_escalation"),
        _row(log_type="dns", query="phishing.example", response_code="NXDOMAIN"),
        _row(log_type="dns", query="ok.example", response_code="NOERROR"),
    ]
    out = enrich_logs(spark.createDataFrame(rows, LOG_SCHEMA)).collect()
    web1, web2, fw, auth1, auth2, sysl, dns1, dns2 = out
    assert web1.tags == ["sql_injection_attempt", "web_attack", "suspicious_user_agent", "client_error"]
    assert web1.threat_types == ["web_attack", "automated_tool"] and web1.threat_type == "automated_tool"
    assert web1.severity == "HIGH" and web1.alert_required
    assert web2.tags == ["server_error"] and web2.severity == "LOW"
    assert fw.tags == ["port_scan", "network_attack", "sensitive_port"] and fw.port_risk == "high"
    assert auth1.threat_type == "brute_force" and auth1.severity == "HIGH"
    assert auth2.tags == ["auth_failure"] and auth2.severity == "MEDIUM"
    assert sysl.threat_types == ["suspicious_execution", "privilege_escalation"]
    assert dns1.tags == ["malicious_domain", "dns_attack", "dns_failure"] and dns1.severity == "HIGH"
    assert dns2.tags == [] and dns2.severity == "LOW" and dns2.threat_type is None


def test_enrich_plan_has_no_python(spark):
    df = spark.createDataFrame([_row(log_type="web", path="/a")], LOG_SCHEMA)
    plan = enrich_logs(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_parse_access_log_and_times(spark):
    line = '1.2.3.4 - - [15/Jan/2024:10:00:00 +0000] "GET /a/b?x=1 HTTP/1.1" 404 512 "-" "curl/7.0"'
    df = spark.createDataFrame([(line,), ("garbage",)], "line string")
    good, bad = df.select(parse_access_log("line").alias("p")).collect()
    p = good.p
    assert (p.source_ip, p.method, p.path, p.params, p.http_version) == ("1.2.3.4", "GET", "/a/b", "?x=1", "1.1")
    assert (p.status_code, p.response_size, p.user_agent) == (404, 512, "curl/7.0")
    assert bad.p._parsefailure and bad.p.source_ip is None
    t = spark.createDataFrame([("2024-01-15T10:00:00",), ("15/Jan/2024:10:00:00 +0000",), ("nope",)], "s string")
    vals = [r[0] for r in t.select(parse_ts("s").cast("timestamp_ntz")).collect()]
    assert vals[:2] == [dt.datetime(2024, 1, 15, 10), dt.datetime(2024, 1, 15, 10)] and vals[2] is None


def test_ip_to_long_and_hash(spark):
    df = spark.createDataFrame([("10.0.1.2", "a"), ("bad", None)], "ip string, m string")
    r = df.select(ip_to_long("ip").alias("n"), event_hash("m", "ip").alias("h")).collect()
    assert r[0].n == 10 * 2 ** 24 + 256 + 2 and r[1].n is None
    assert len(r[0].h) == 64 and r[0].h != r[1].h


def test_related_alerts_window(spark):
    base = dt.datetime(2024, 1, 15, 10)
    rows = [(base + dt.timedelta(minutes=m), sev, ip) for m, sev, ip in
            [(0, "HIGH", "1.1.1.1"), (30, "HIGH", "1.1.1.1"), (60, "CRITICAL", "1.1.1.1"),
             (90, "HIGH", "1.1.1.1"), (200, "HIGH", "1.1.1.1"), (10, "HIGH", "2.2.2.2")]]
    a = spark.createDataFrame(rows, "timestamp timestamp_ntz, severity string, ip string") \
        .select("timestamp", "severity", F.struct(F.col("ip").alias("src_ip")).alias("original_log"))
    out = AL.related_alerts(a).orderBy("timestamp").collect()
    counts = [(r.original_log.src_ip, r.timestamp.minute if r.timestamp.hour == 10 else r.timestamp,
               r.related_alerts_count) for r in out]
    by_time = {(r.original_log.src_ip, r.timestamp): r.related_alerts_count for r in out}
    assert by_time[("1.1.1.1", base)] is None
    assert by_time[("1.1.1.1", base + dt.timedelta(minutes=30))] == 1
    assert by_time[("1.1.1.1", base + dt.timedelta(minutes=60))] == 2      # CRITICAL itself counted by others only
    assert by_time[("1.1.1.1", base + dt.timedelta(minutes=90))] == 2      # the CRITICAL one is not counted
    assert by_time[("1.1.1.1", base + dt.timedelta(minutes=200))] == 1     # 90 is within 2 h, 60 is not
    assert by_time[("2.2.2.2", base + dt.timedelta(minutes=10))] is None
    assert len(counts) == 6


def test_geoip_range_join(spark):
    ranges = spark.createDataFrame([(10 * 2 ** 24, 10 * 2 ** 24 + 255, "X", "cx"),
                                    (11 * 2 ** 24, 11 * 2 ** 24 + 2 ** 17, "Y", "cy")],
                                   "start_ip long, end_ip long, country_name string, city_name string")
    df = spark.createDataFrame([("10.0.0.7",), ("11.1.0.1",), ("11.9.0.0",), (None,)], "ip string")
    out = {r.ip: r.country_name for r in geoip_enrich(df, "ip", ranges).collect()}
    assert out == {"10.0.0.7": "X", "11.1.0.1": "Y", "11.9.0.0": None, None: None}


def test_geoip_nested_ranges_and_block_counts(spark):
    lo = 10 * 2 ** 24
    rows = [(0, 2 ** 28 - 1, "wide"), (lo, lo + 1023, "net"), (lo + 100, lo + 199, "odd"), (lo + 150, lo + 150, "one"),
            (lo + 500, lo + 1500, "over"), (2 ** 32 - 4, 2 ** 32 - 1, "end"), (9, 3, "empty")]
    ranges = spark.createDataFrame(rows, "start_ip long, end_ip long, country_name string")
    n = {r.country_name: r["count"] for r in cidr_blocks(ranges).groupBy("country_name").count().collect()}
    assert n["wide"] == 1 and n["net"] == 1 and n["one"] == 1 and n["end"] == 1 and "empty" not in n and max(n.values()) <= 62
    ips = {"10.0.0.0": "net", "10.0.0.99": "net", "10.0.0.100": "odd", "10.0.0.150": "one", "10.0.0.199": "odd", "10.0.0.200": "net",
           "10.0.1.255": "over", "10.0.5.220": "over", "10.0.5.221": "wide", "15.255.255.255": "wide", "16.0.0.0": None, "255.255.255.255": "end"}
    df = spark.createDataFrame([(ip, k) for ip in [*ips, None, "10.0.0.150"] for k in range(3)], "ip string, k int")
    out = geoip_enrich(df, "ip", ranges)
    got = out.collect()
    assert len(got) == 3 * (len(ips) + 2) and all(r.country_name == ips.get(r.ip) for r in got)
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    assert geoip_enrich(df, "ip", ranges.limit(0)).where("country_name is not null").count() == 0


def test_event_of_25000_lines_is_one_event(spark):
    start = '1.2.3.4 - - [10/Oct/2024:13:55:36 +0000] "GET /a HTTP/1.1" 200 5 "-" "x"'
    rows = [("web", "f", 1, start)] + [("web", "f", k, f"  at frame {k}") for k in range(2, 25001)] + [("web", "f", 25001, start)]
    lines = spark.createDataFrame(rows, "log_type string, file_id string, line_no long, message string")
    out = raw_log_events(lines, {}).select("event_no", "part", "message", "severity", "src_ip", "_parsefailure").collect()
    events = sorted((r.event_no, r.severity, r.src_ip, r._parsefailure) for r in out if r.part == 0)
    assert [e[0] for e in events] == [1, 2] and {e[2] for e in events} == {"1.2.3.4"} and all(not e[3] for e in events)
    rest = sorted((r.event_no, r.part, len(r.message.split("\n")), r.severity) for r in out if r.part > 0)
    assert [r[:2] for r in rest] == [(1, 1), (1, 2)] and all(r[3] is None for r in rest)
    assert sum(len(r.message.split("\n")) for r in out) == 25001


def test_fold_multiline(spark):
    lines = [(1, 1, "1.2.3.4 start"), (1, 2, "  at x"), (1, 3, "  at y"), (1, 4, "5.6.7.8 next"),
             (2, 1, "orphan"), (2, 2, "9.9.9.9 ok")]
    df = spark.createDataFrame(lines, "file_id long, line_no long, line string")
    out = sorted((r.file_id, r.event_no, r.n_lines, r.text) for r in fold_multiline(df).collect())
    assert out == [(1, 1, 3, "1.2.3.4 start\n  at x\n  at y"), (1, 2, 1, "5.6.7.8 next"),
                   (2, 0, 1, "orphan"), (2, 1, 1, "9.9.9.9 ok")]


def test_fold_multiline_chunked_prefix(spark):
    # a chunk size of 2 lines forces the cross-chunk offset path
    from eventlens.sources.streams import running
    df = spark.createDataFrame([(1, i, i % 3 == 0) for i in range(1, 11)], "f long, n long, s boolean")
    out = {r.n: r.c for r in running(df, ["f"], "n", {"c": (F.sum, F.col("s").cast("long"))}, chunk_rows=2).collect()}
    assert [out[i] for i in range(1, 11)] == [0, 0, 1, 1, 1, 2, 2, 2, 3, 3]


def test_brute_force_threshold(spark):
    base = dt.datetime(2024, 1, 15, 10)
    rows = [("1.1.1.1", base + dt.timedelta(seconds=20 * i), "FAILED") for i in range(10)]
    df = spark.createDataFrame(rows, "src_ip string, event_time timestamp_ntz, result string")
    out = AL.brute_force(df).collect()
    assert out and all(r.failures >= 10 for r in out)


def test_log_files_decode_and_fold(spark, tmpdir_path):
    from eventlens.sources.streams import decode_json, read_log_files
    web = f"{tmpdir_path}/web"
    fw = f"{tmpdir_path}/fw"
    import os
    os.makedirs(web)
    os.makedirs(fw)
    with open(f"{web}/web.log", "w") as f:
        f.write("1.2.3.4 - - [15/Jan/2024:10:00:00 +0000] \"GET /a HTTP/1.1\" 500 1 \"-\" \"x\"\n"
                "  stack line 1\n  stack line 2\n"
                "5.6.7.8 - - [15/Jan/2024:10:00:01 +0000] \"GET /b HTTP/1.1\" 200 1 \"-\" \"x\"\n")
    with open(f"{fw}/fw.log", "w") as f:
        f.write('{"src_ip": "8.8.8.8", "packet_count": 99}\nnot json\n')
    lines = read_log_files(spark, web, "web", "apache", streaming=False)
    events = fold_multiline(lines.withColumnRenamed("message", "line"), file_col="file")
    texts = sorted(r.text.split("\n")[0][:7] for r in events.collect())
    assert texts == ["1.2.3.4", "5.6.7.8"]
    assert sorted(r.n_lines for r in events.collect()) == [1, 3]
    raw = read_log_files(spark, fw, "firewall", "iptables", streaming=False)
    dec = decode_json(raw, StructType([StructField("src_ip", StringType()), StructField("packet_count", IntegerType())]))
    rows = sorted(dec.collect(), key=lambda r: r.message)
    assert rows[1].packet_count == 99 and rows[1]._json_error is None
    assert rows[0].src_ip is None and rows[0]._json_error == "not json"


def test_severity_asks_the_rules_and_builds_no_tags(spark):
    """The severity is that of the tags, for events of every rule and none; a
    filter on it makes no array of tags."""
    from eventlens.operators.security_rules import ATTACK_TAGS, ERROR_TAGS, enrich_logs
    schema = ("event_id long, log_type string, path string, user_agent string, status_code int, packet_count int, dst_port int, "
              "result string, username string, process_name string, event_type string, query string, response_code string")
    seen = [[t, p, a, s, n, d, r, u, x, e, q, c]
            for t in ("web", "firewall", "auth", "system", "dns", "other", None)
            for p, a in (("/union-select", "x"), ("/page", "sqlmap/1"), (None, None)) for s in (200, 404, 500, None)
            for n, d in ((60, 22), (1, 443), (None, None)) for r, u in (("FAILED", "admin"), ("FAILED", "u1"), (None, None))
            for x, e, q, c in (("cmd.exe", "start", "evil.com", "NOERROR"), ("bash", "privilege_escalation", "a.org", "NXDOMAIN"), (None,) * 4)]
    logs = enrich_logs(spark.createDataFrame([(i, *r) for i, r in enumerate(seen)], schema))
    for r in logs.select("tags", "severity", "alert_required").collect():
        want = "HIGH" if set(r.tags) & set(ATTACK_TAGS) else "MEDIUM" if set(r.tags) & set(ERROR_TAGS) else "LOW"
        assert (r.severity, r.alert_required) == (want, want == "HIGH")
    plan = logs.where("alert_required").select("event_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "array" not in plan
