"""Table reads: the driver's parquet tables, warehouse tables and date-split
folders (S10, S11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, ``{sf_dir}/{name}.parquet``.

    Parquet keeps filters and projections pushed into the scan, so callers
    select and filter freely afterwards.
    """
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Full read of a catalog table or view (a dbt ``source()``)."""
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, num_partitions: int, **options) -> DataFrame:
    """Warehouse read split into ``num_partitions`` range scans so a big
    table is not pulled through one connection."""
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table)
            .option("partitionColumn", partition_column)
            .option("lowerBound", lower).option("upperBound", upper)
            .option("numPartitions", num_partitions).options(**options).load())


def read_daily(spark: SparkSession, path: str, start, end, part_col: str = "dt",
               fmt: str = "parquet") -> DataFrame:
    """Read a date-partitioned table (the index pattern) limited to
    ``start <= part_col <= end``; the predicate on the partition column prunes
    folders before any file is opened.  Days are dates (``dt=2024-10-15``),
    months strings (``month=2024-10``; ISO text sorts by time)."""
    df = spark.read.format(fmt).load(path)
    kind = df.schema[part_col].dataType
    return df.where(F.col(part_col).between(F.lit(str(start)).cast(kind), F.lit(str(end)).cast(kind)))
