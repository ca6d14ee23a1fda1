"""Registered queries of the video, incident and price pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventlens import fixtures as fx
from eventlens.operators import incidents as I
from eventlens.operators import prices as P
from eventlens.operators import quality as Q
from eventlens.operators import videos as V
from eventlens.plans.registry import query

# --------------------------------------------------------------------------- videos

_STG_COLS = ", ".join(V.STG_COLUMNS)


@query("stg_videos", f"SELECT {_STG_COLS} FROM videos_stg", fixtures=["videos_stg"])
def q_stg_videos(spark, sf):
    """P04 staging model (YY.DD.MM with the century pivot)."""
    return V.stg_videos(fx.videos_raw(spark, sf))


@query("fct_video_trends", "SELECT * FROM videos_fct", fixtures=["videos_fct"], doubles=["engagement_rate"])
def q_fct_video_trends(spark, sf):
    """P05 mart: engagement rate and weekday name."""
    return V.fct_video_trends(V.stg_videos(fx.videos_raw(spark, sf)))


@query("dup_keys", """
SELECT video_id, COUNT(*) AS n_rows FROM videos_stg GROUP BY video_id HAVING COUNT(*) > 1
""", fixtures=["videos_stg"])
def q_dup_keys(spark, sf):
    """A26/Q01 duplicated video ids in the staging model."""
    return Q.dup_keys(V.stg_videos(fx.videos_raw(spark, sf)), ["video_id"])


def _check_sql(model: str, label: str, failures: str, table: str) -> str:
    return f"SELECT '{model}' AS model, '{label}' AS check_name, CAST(({failures}) AS BIGINT) AS failures FROM {table}"


_QSQL = " UNION ALL ".join([
    _check_sql("stg_videos", "not_null:video_id", "COUNT(*) FILTER (WHERE video_id IS NULL)", "videos_stg"),
    _check_sql("stg_videos", "not_null:trending_date", "COUNT(*) FILTER (WHERE trending_date IS NULL)", "videos_stg"),
    _check_sql("stg_videos", "not_null:views", "COUNT(*) FILTER (WHERE views IS NULL)", "videos_stg"),
    _check_sql("stg_videos", "at_least_one:views", "CASE WHEN COUNT(views) = 0 THEN 1 ELSE 0 END", "videos_stg"),
    _check_sql("stg_videos", "expression:views:views > 0",
               "COUNT(*) FILTER (WHERE NOT COALESCE(views > 0, FALSE))", "videos_stg"),
    "SELECT 'stg_videos' AS model, 'unique:video_id' AS check_name, CAST(COUNT(*) AS BIGINT) AS failures "
    "FROM (SELECT video_id FROM videos_stg GROUP BY video_id HAVING COUNT(*) > 1) d",
    _check_sql("fct_video_trends", "not_null:video_id", "COUNT(*) FILTER (WHERE video_id IS NULL)", "videos_fct"),
    _check_sql("fct_video_trends", "not_null:engagement_rate",
               "COUNT(*) FILTER (WHERE engagement_rate IS NULL)", "videos_fct"),
    _check_sql("fct_video_trends", "at_least_one:engagement_rate",
               "CASE WHEN COUNT(engagement_rate) = 0 THEN 1 ELSE 0 END", "videos_fct"),
    _check_sql("fct_video_trends", "expression:engagement_rate:engagement_rate >= 0",
               "COUNT(*) FILTER (WHERE NOT COALESCE(engagement_rate >= 0, FALSE))", "videos_fct"),
    "SELECT 'fct_video_trends' AS model, 'unique:video_id' AS check_name, CAST(COUNT(*) AS BIGINT) AS failures "
    "FROM (SELECT video_id FROM videos_fct GROUP BY video_id HAVING COUNT(*) > 1) d",
])


@query("quality_report", f"""
SELECT model, check_name, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status
FROM ({_QSQL}) r
""", fixtures=["videos_fct"])
def q_quality_report(spark, sf):
    """Q01-Q05 the model test suite as one report."""
    stg = V.stg_videos(fx.videos_raw(spark, sf))
    return Q.run_checks({"stg_videos": stg, "fct_video_trends": V.fct_video_trends(stg)}, Q.video_suite())


# --------------------------------------------------------------------------- incidents

_INC_COLS = "incident_seq, " + ", ".join(I.TABLE_COLUMNS)


def _clean(spark, sf):
    return I.clean_incidents(fx.incidents_raw(spark, sf))


@query("clean_incidents", f"SELECT {_INC_COLS} FROM incidents_clean", fixtures=["incidents_clean"])
def q_clean_incidents(spark, sf):
    """P06/P07 select present columns, coerce, drop rows without coordinates."""
    return _clean(spark, sf)


FIRST_LOAD_BEFORE = "1998-01-01"
_KEY = " AND ".join(f"t.{k} = b.{k}" for k in I.INCIDENT_KEY)
_KEY_NOT_NULL = " AND ".join(f"{k} IS NOT NULL" for k in I.INCIDENT_KEY)


@query("insert_ignore", f"""
SELECT {_INC_COLS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {", ".join(I.INCIDENT_KEY)} ORDER BY incident_seq) AS rn
  FROM incidents_clean WHERE {_KEY_NOT_NULL}) b
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM incidents_clean t
                             WHERE t.fecha_accidente < DATE '{FIRST_LOAD_BEFORE}' AND {_KEY})
UNION ALL
SELECT {_INC_COLS} FROM incidents_clean WHERE NOT ({_KEY_NOT_NULL})
""", fixtures=["incidents_clean"])
def q_insert_ignore(spark, sf):
    """K07 second load of all incidents over a first load of those before 1998:
    the rows the second load inserts."""
    c = _clean(spark, sf)
    target = c.where(F.col("fecha_accidente") < F.lit(FIRST_LOAD_BEFORE).cast("date"))
    return I.insert_ignore(target, c)


def _mode_sql(expr: str) -> str:
    return (f"(SELECT v FROM (SELECT {expr} AS v FROM incidents) m WHERE v IS NOT NULL "
            f"GROUP BY v ORDER BY COUNT(*) DESC, v LIMIT 1)")


@query("incident_kpis", f"""
SELECT (SELECT COUNT(*) FROM incidents) AS total,
       {_mode_sql("comuna")} AS comuna_mas_afectada,
       {_mode_sql("clase_accidente")} AS clase_mas_comun,
       {_mode_sql("substr(hora_accidente, 1, 2)")} || ':00' AS hora_pico
""", fixtures=["incidents"])
def q_incident_kpis(spark, sf):
    """A23/A25 total, most affected comuna, most common class, peak hour."""
    return I.incident_kpis(fx.incidents(spark, sf))


@query("value_counts", """
SELECT gravedad_accidente, COUNT(*) AS count FROM incidents WHERE gravedad_accidente IS NOT NULL
GROUP BY gravedad_accidente
""", fixtures=["incidents"])
def q_value_counts(spark, sf):
    """A24 incidents per severity."""
    return I.value_counts(fx.incidents(spark, sf), "gravedad_accidente")


@query("class_top5", """
SELECT clase_accidente, COUNT(*) AS count FROM incidents WHERE clase_accidente IS NOT NULL
GROUP BY clase_accidente ORDER BY count DESC, clase_accidente LIMIT 5
""", fixtures=["incidents"])
def q_class_top5(spark, sf):
    """A24 five most common classes."""
    return I.value_counts(fx.incidents(spark, sf), "clase_accidente", 5)


FILTER_COMUNA, FILTER_GRAVEDAD = "NATION_3", "1-URGENT"


@query("incident_filter", f"""
SELECT * FROM incidents WHERE comuna = '{FILTER_COMUNA}' AND gravedad_accidente = '{FILTER_GRAVEDAD}'
""", fixtures=["incidents"])
def q_incident_filter(spark, sf):
    """P11 dashboard filters (one comuna, one severity)."""
    return I.incident_filter(fx.incidents(spark, sf), FILTER_COMUNA, FILTER_GRAVEDAD)


@query("filter_options", "SELECT DISTINCT comuna FROM incidents WHERE comuna IS NOT NULL",
       fixtures=["incidents"])
def q_filter_options(spark, sf):
    """P12 comuna choices."""
    return I.filter_options(fx.incidents(spark, sf), "comuna")


@query("map_points", """
SELECT CAST(latitud AS DOUBLE) AS lat, CAST(longitud AS DOUBLE) AS lon, clase_accidente, fecha_accidente, barrio
FROM incidents WHERE latitud IS NOT NULL AND longitud IS NOT NULL
""", fixtures=["incidents"], doubles=["lat", "lon"])
def q_map_points(spark, sf):
    """P13 map layer."""
    return I.map_points(fx.incidents(spark, sf))


# --------------------------------------------------------------------------- prices

_PRICE_COLS = ", ".join(P.UNIFIED_COLUMNS)
FIRST_BATCH_BEFORE_EPOCH = 1705363200   # 2024-01-16 00:00:00 UTC


@query("unpivot_prices", f"SELECT {_PRICE_COLS} FROM price_stream", fixtures=["price_stream"],
       doubles=["price", "event_epoch"])
def q_unpivot_prices(spark, sf):
    """P02 wide ticks -> (coin, price) rows, nulls dropped."""
    return P.unpivot_prices(fx.price_wide(spark, sf))


def _lake_state(spark, sf):
    stream_rows = P.unpivot_prices(fx.price_wide(spark, sf))
    batch = P.normalise_batch_prices(fx.price_batch(spark, sf))
    first = batch.where(F.col("event_epoch") < F.lit(float(FIRST_BATCH_BEFORE_EPOCH)))
    target = P.unified(stream_rows, first)
    return target, batch


_MERGE_SQL = f"""
SELECT {_PRICE_COLS} FROM price_batch_norm s
WHERE NOT EXISTS (SELECT 1 FROM price_batch_norm t
                  WHERE t.event_epoch < {float(FIRST_BATCH_BEFORE_EPOCH)} AND t.trade_id = s.trade_id)
"""


@query("merge_insert_only", _MERGE_SQL, fixtures=["price_batch_norm"], doubles=["price", "event_epoch"])
def q_merge_insert_only(spark, sf):
    """K03 re-run of the batch load over a table holding stream rows and the
    first half of the batch: the rows the merge inserts."""
    target, batch = _lake_state(spark, sf)
    return P.merge_insert_only(target, batch).select(*P.UNIFIED_COLUMNS)


@query("unified_prices", f"""
SELECT {_PRICE_COLS} FROM price_stream
UNION ALL SELECT {_PRICE_COLS} FROM price_batch_norm WHERE event_epoch < {float(FIRST_BATCH_BEFORE_EPOCH)}
UNION ALL {_MERGE_SQL}
""", fixtures=["price_stream", "price_batch_norm"], doubles=["price", "event_epoch"])
def q_unified_prices(spark, sf):
    """U01 the unified table after the merge."""
    target, batch = _lake_state(spark, sf)
    return P.unified(target, P.merge_insert_only(target, batch))


@query("record_explorer", "SELECT * FROM incidents ORDER BY incident_seq LIMIT 100", fixtures=["incidents"])
def q_record_explorer(spark, sf):
    """T02 first 100 records of the incident table."""
    from eventlens.operators.common import record_explorer
    return record_explorer(fx.incidents(spark, sf), "incident_seq", 100)
