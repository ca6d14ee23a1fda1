"""Road-incident cleaning, loading and dashboard figures (P06, P07, K07,
P11-P13, A23-A25)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's.
# API field -> table column.
INCIDENT_COLUMNS = {
    "fecha": "fecha_accidente",
    "hora": "hora_accidente",
    "gravedad": "gravedad_accidente",
    "clase_incidente": "clase_accidente",
    "direccion": "lugar_accidente",
    "comuna": "comuna",
    "barrio": "barrio",
    "latitud": "latitud",
    "longitud": "longitud",
}
# Load defaults, applied when the column is absent from the batch.
LOAD_DEFAULTS = {
    "gravedad_accidente": "DESCONOCIDO",
    "clase_accidente": "DESCONOCIDO",
    "lugar_accidente": "DESCONOCIDO",
    "comuna": "SIN COMUNA",
    "barrio": "SIN BARRIO",
}
# Unique key of the loaded table.
INCIDENT_KEY = ("fecha_accidente", "hora_accidente", "latitud", "longitud")
# "All values" choice of the dashboard filters; text when there is no data.
ALL = "Todas"
NOT_AVAILABLE = "N/A"
# ---------------------------------------------------------------------------

TABLE_COLUMNS = ("fecha_accidente", "hora_accidente", "gravedad_accidente", "clase_accidente",
                 "lugar_accidente", "comuna", "barrio", "latitud", "longitud")


def select_present(df: DataFrame, mapping: dict[str, str] = INCIDENT_COLUMNS, keep=()) -> DataFrame:
    """Keep the known source columns that exist in this batch (schema
    drift tolerant) and rename them; ``keep`` passes extra columns through."""
    present = [c for c in mapping if c in df.columns]
    return df.select(*[F.col(c) for c in keep], *[F.col(c).alias(mapping[c]) for c in present])


def clean_incidents(raw: DataFrame, fill_nulls: bool = False, keep=("incident_seq",)) -> DataFrame:
    """Date to day, coordinates to numbers (unparsable -> null, never an
    error), rows without both coordinates dropped, then the load defaults
    for absent columns (ruling C13; ``fill_nulls`` also fills null values).
    Coordinates are typed as the table's ``decimal(10,6)``."""
    df = select_present(raw, keep=[k for k in keep if k in raw.columns])
    if "fecha_accidente" in df.columns:
        df = df.withColumn("fecha_accidente", F.to_date(F.try_to_timestamp(F.col("fecha_accidente"))))
    if "latitud" in df.columns and "longitud" in df.columns:
        df = df.withColumns({c: F.col(c).try_cast("decimal(10,6)") for c in ("latitud", "longitud")})
        df = df.dropna(subset=["latitud", "longitud"])
    for col, default in LOAD_DEFAULTS.items():
        if col not in df.columns:
            df = df.withColumn(col, F.lit(default))
        elif fill_nulls:
            df = df.withColumn(col, F.coalesce(F.col(col), F.lit(default)))
    for col in TABLE_COLUMNS:
        if col not in df.columns:
            df = df.withColumn(col, F.lit(None).cast("string"))
    return df.select(*[k for k in keep if k in df.columns], *TABLE_COLUMNS)


def insert_ignore(target: DataFrame, batch: DataFrame, key=INCIDENT_KEY, order_col: str = "incident_seq") -> DataFrame:
    """The rows an ``INSERT ... ON CONFLICT (key) DO NOTHING`` adds.

    Rows with a null key part never conflict (the database treats nulls as
    distinct) and are all inserted.  Among the others, the first row of each
    key in batch order wins, and keys already in the target are skipped.
    First-per-key is a ``min_by`` aggregation (partial before the shuffle),
    and the target test is a left-anti join on the key.
    """
    key = list(key)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    nulls = batch.where(any_null)
    rest = batch.where(~any_null)
    others = [c for c in batch.columns if c not in key]
    first = (rest.groupBy(*key).agg(F.min_by(F.struct(*others), F.col(order_col)).alias("_r"))
             .select(*key, *[F.col(f"_r.{c}").alias(c) for c in others]))
    new = first.join(target.select(*key).where(~reduce(lambda a, b: a | b,
                                                          [F.col(k).isNull() for k in key])),
                     on=key, how="left_anti")
    return new.select(*batch.columns).unionByName(nulls)


def incident_filter(df: DataFrame, comuna: str = ALL, gravedad: str = ALL) -> DataFrame:
    """Dashboard filters; ``Todas`` passes everything."""
    if comuna != ALL:
        df = df.where(F.col("comuna") == comuna)
    if gravedad != ALL:
        df = df.where(F.col("gravedad_accidente") == gravedad)
    return df


def filter_options(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def map_points(df: DataFrame) -> DataFrame:
    """Map layer: coordinates renamed to lat/lon, rows without them
    dropped, hover fields kept."""
    return (df.where(F.col("latitud").isNotNull() & F.col("longitud").isNotNull())
            .select(F.col("latitud").cast("double").alias("lat"), F.col("longitud").cast("double").alias("lon"),
                    "clase_accidente", "fecha_accidente", "barrio"))


def mode_of(df: DataFrame, col, alias: str = "mode") -> DataFrame:
    """Most frequent non-null value, the smallest one on a tie; one row
    (null when there is no value).  Counting is a partial aggregation; the
    pick is a ``min_by`` over (-count, value), so nothing is sorted."""
    c = F.col(col) if isinstance(col, str) else col
    counts = df.select(c.alias("_v")).where(F.col("_v").isNotNull()).groupBy("_v").agg(F.count("*").alias("_n"))
    return counts.agg(F.min_by("_v", F.struct(-F.col("_n"), F.col("_v"))).alias(alias))


def value_counts(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """Counts per value, descending, nulls dropped; top ``k`` if given
    (value order breaks ties)."""
    out = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("count"))
    out = out.orderBy(F.desc("count"), F.asc(col))
    return out.limit(k) if k else out


def incident_kpis(df: DataFrame) -> DataFrame:
    """Total, most affected comuna, most common class and peak hour
    in one row; ``N/A`` when there are no rows.

    One pass over the incidents: each emits its (facet, value) pairs, which are
    counted together; the modes are read from that small table.
    """
    facets = {"total": F.lit("all"), "comuna": F.col("comuna"), "clase": F.col("clase_accidente"),
              "hora": F.substring(F.col("hora_accidente").cast("string"), 1, 2)}
    pairs = F.array(*[F.struct(F.lit(f).alias("facet"), c.cast("string").alias("value")) for f, c in facets.items()])
    counts = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("facet", "value").agg(F.count("*").alias("n"))

    def mode(facet):
        mine = F.col("facet") == facet
        return F.min_by(F.when(mine, F.col("value")), F.when(mine, F.struct(-F.col("n"), F.col("value"))))

    one = counts.agg(F.coalesce(F.sum(F.when(F.col("facet") == "total", F.col("n"))), F.lit(0)).alias("total"),
                     mode("comuna").alias("comuna_mas_afectada"), mode("clase").alias("clase_mas_comun"), mode("hora").alias("_h"))
    one = one.withColumn("hora_pico", F.concat("_h", F.lit(":00")))
    na = F.col("total") == 0
    return one.select("total", *[F.when(na, F.lit(NOT_AVAILABLE)).otherwise(F.col(c)).alias(c)
                                 for c in ("comuna_mas_afectada", "clase_mas_comun", "hora_pico")])
