"""Tables written to the shared checkpoint folder.

A written table cuts the lineage: every later read finds the rows on storage
that all executors share, also after executors are lost.  The folder is the
one named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.session import checkpoint_path


def table_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder (or the running block's)."""
    return checkpoint_path(spark, f"llm/{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder (or at
    ``path``), read it back."""
    spark = df.sparkSession
    path = path or table_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(df: DataFrame) -> int:
    """The number of shuffle partitions the session is set to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bucket_keys(df: DataFrame, parts: int) -> np.ndarray:
    """``parts`` ints of which ``repartition(parts, key)`` sends one to each
    partition: bucket numbers themselves would leave some partitions empty
    and give others several."""
    ids = df.sparkSession.range(parts * (int(math.log(parts)) + 12)).select(F.col("id").cast("int").alias("k"))
    rows = ids.groupBy(F.pmod(F.hash("k"), F.lit(parts)).alias("p")).agg(F.min("k").alias("k")).collect()
    keys = [r["k"] for r in sorted(rows, key=lambda r: r["p"])]
    return np.array(keys + [-1 - i for i in range(parts - len(keys))], np.int32)
