"""Unified price lake: tick parsing, unpivot, batch normalisation and the
insert-only merge (P01-P03, K03/J01, U01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

COINS = ("bitcoin", "ethereum", "dogecoin")

# Topic payload of one price tick: ``{coin: {usd: double}}`` plus an epoch.
PRICE_TICK_SCHEMA = StructType(
    [StructField(c, StructType([StructField("usd", DoubleType(), True)]), True)
     for c in ("bitcoin", "dogecoin", "ethereum")]
    + [StructField("timestamp", DoubleType(), True)])

# Columns of the unified table (ruling C1).
UNIFIED_COLUMNS = ("trade_id", "coin", "price", "event_epoch", "event_timestamp", "source")


def parse_json_value(df: DataFrame, schema: StructType, keep_broker_time: bool = True) -> DataFrame:
    """Topic bytes -> string -> JSON -> flat columns, carrying the
    broker timestamp."""
    cols = [F.from_json(F.col("value").cast("string"), schema).alias("data")]
    if keep_broker_time and "timestamp" in df.columns:
        cols.append(F.col("timestamp").alias("kafka_timestamp"))
    out = df.select(*cols)
    return out.select("data.*", *(["kafka_timestamp"] if keep_broker_time and "timestamp" in df.columns else []))


def epoch_to_timestamp(c) -> F.Column:
    """Double epoch seconds -> wall-clock (UTC) timestamp at microsecond
    precision."""
    col = F.col(c) if isinstance(c, str) else c
    return F.timestamp_micros(F.round(col * F.lit(1e6)).cast("long")).cast("timestamp_ntz")


def unpivot_prices(ticks: DataFrame, coins=COINS, source: str = "streaming") -> DataFrame:
    """One row per (tick, coin) with a price; null prices dropped; tagged
    with the source.  ``stack`` is a generator inside the same projection, so
    this stays a narrow, stateless transformation (batch or stream)."""
    pairs = ", ".join(f"'{c}', {c}.usd" for c in coins)
    out = ticks.select(
        F.col("timestamp").alias("event_epoch"),
        F.expr(f"stack({len(coins)}, {pairs}) AS (coin, price)"),
    ).where(F.col("price").isNotNull())
    return out.select(
        F.lit(None).cast("bigint").alias("trade_id"), "coin", "price", "event_epoch",
        epoch_to_timestamp("event_epoch").alias("event_timestamp"), F.lit(source).alias("source"))


def normalise_batch_prices(batch: DataFrame) -> DataFrame:
    """Historical CSV rows renamed to the lake columns and tagged
    ``batch``; the integer epoch becomes both ``event_epoch`` and a
    timestamp."""
    return batch.select(
        F.col("trade_id").cast("bigint").alias("trade_id"),
        F.col("coin_name").alias("coin"),
        F.col("price_usd").cast("double").alias("price"),
        F.col("trade_timestamp").cast("double").alias("event_epoch"),
        epoch_to_timestamp(F.col("trade_timestamp").cast("double")).alias("event_timestamp"),
        F.lit("batch").alias("source"))


def merge_insert_only(target: DataFrame, source: DataFrame, on: str = "trade_id",
                      target_source: str = "batch") -> DataFrame:
    """Rows of ``source`` that a ``MERGE ... WHEN NOT MATCHED THEN
    INSERT`` on ``target.source = 'batch' AND target.trade_id =
    source.trade_id`` inserts.

    A left-anti join against the target's batch rows: null keys never match,
    so they are always inserted, and duplicates inside ``source`` are all
    inserted, exactly as the merge does.  The target-side filter is on the
    partition column, so only the batch folder is read.
    """
    keys = target.where(F.col("source") == target_source).select(on).where(F.col(on).isNotNull())
    return source.join(keys, on=on, how="left_anti")


def unified(target: DataFrame, inserted: DataFrame) -> DataFrame:
    """The table after the merge: stream and batch rows in one frame."""
    return target.select(*UNIFIED_COLUMNS).unionByName(inserted.select(*UNIFIED_COLUMNS))
