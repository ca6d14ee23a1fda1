"""The training-data pipeline: documents in, packed token sequences out.

``STAGES`` are applied in order.  Each takes (spark, docs, sf_dir), works on all
rows its predecessor kept and returns a DataFrame; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import decontaminate, minhash, packing, pii, quality
from eventlens.llm.spill import table_path, written
from eventlens.session import drop_folder, scratch_run


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.5 or more)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, 0.8)."""
    return minhash.keep_one(docs, width=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its personal data replaced; n_chars follows the text."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 4096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("pack", pack_sequences),
]

#: SQL cannot express the classifier
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again.  What a stage
    wrote for itself and the table before it are dropped when its own table is
    there; the last of these tables stays, as the result reads it."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        before, path = path, table_path(spark, f"pipeline-{name}")
        with scratch_run(spark, f"pipeline-{name}"):
            docs = written(stage(spark, docs, sf_dir), name, path)
        if before:
            drop_folder(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
