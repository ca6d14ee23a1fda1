"""Shared relational helpers: time windows relative to an explicit clock,
top-k with tie-breaks, latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ts_literal(df: DataFrame, ts_col: str, value) -> Column:
    """``value`` as a literal of the same timestamp flavour as ``ts_col``
    (NTZ columns compare with NTZ literals, so no time-zone shift)."""
    dtype = df.schema[ts_col].dataType.simpleString()
    return F.lit(str(value)).cast(dtype)


def recent(df: DataFrame, ts_col: str, hours: float | None = None, as_of=None,
           days: float | None = None, part_col: str | None = None) -> DataFrame:
    """Rows with ``ts_col >= as_of - interval``.

    ``as_of`` is explicit (never ``now()`` inside), so reruns and tests are
    reproducible; pass ``F.current_timestamp()`` for the live form.
    ``part_col`` names a date partition column of ``ts_col``'s own day.
    """
    if as_of is None:
        raise ValueError("recent() needs an explicit as_of")
    clock = as_of if isinstance(as_of, Column) else ts_literal(df, ts_col, as_of)
    seconds = (hours or 0) * 3600 + (days or 0) * 86400
    start = clock - F.make_dt_interval(secs=F.lit(seconds))
    out = df.where(F.col(ts_col) >= start)
    if part_col:  # the same limit on the partition column prunes folders
        out = out.where(F.col(part_col) >= F.to_date(start))
    return out


def time_range(df: DataFrame, ts_col: str, start, end) -> DataFrame:
    """Inclusive ``start <= ts <= end``."""
    return df.where(F.col(ts_col).between(ts_literal(df, ts_col, start), ts_literal(df, ts_col, end)))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """``orderBy(...).limit(k)``; Spark plans it as TakeOrderedAndProject
    (per-partition top-k, then one merge of k rows per partition)."""
    return df.orderBy(*order).limit(k)


def top_n_per_group(df: DataFrame, group_cols, n: int, *order: Column, rank_col: str = "rank") -> DataFrame:
    """``row_number() <= n`` per group."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def latest_per_key(df: DataFrame, keys, order_col: str, tie_cols=()) -> DataFrame:
    """Last-write-wins row per key (``row_number`` over a descending order).

    Uses ``max_by`` on a struct instead of a window so the work is a
    partial (map-side) aggregation: a hot key does not funnel all its rows
    into one window partition.
    """
    others = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(order_col), *[F.col(c) for c in tie_cols])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_row"))
    return agg.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields 0 when the denominator is 0 (the reference's
    zero guards)."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def record_explorer(df: DataFrame, id_col: str, n: int = 100) -> DataFrame:
    """The first ``n`` records by id (the dashboard's record table)."""
    return df.orderBy(F.asc(id_col)).limit(n)


def newest(df: DataFrame, ts_col: str, n: int = 10, tie_col: str | None = None) -> DataFrame:
    """The ``n`` newest rows by a timestamp (id breaks ties)."""
    order = [F.desc(ts_col)] + ([F.asc(tie_col)] if tie_col else [])
    return df.orderBy(*order).limit(n)
