"""A sample of registered queries against their DuckDB oracles at sf0.001
(the full comparison at sf0.01 is scripts/oracle_check.py)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from eventlens.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
SAMPLE = ("trending_words", "sentiment_hourly", "pipeline_health", "fct_video_trends", "quality_report",
          "insert_ignore", "incident_kpis", "unified_prices", "enrich_logs", "log_summary", "top_attackers",
          "related_alerts", "suppress_alerts", "geoip_enrich", "fold_multiline", "keyword_filter", "trending_hashtags",
          "enrich_alerts", "notification_outbox", "raw_log_events", "stream_hourly", "stream_suppress", "security_report")


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if v is not None and type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_a_callable_and_named_columns():
    qs, orc = entry.queries(), entry.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 60


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, d_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "total_mentions", "positive_mentions", "negative_mentions", "sentiment_score"]
    df.collect()
