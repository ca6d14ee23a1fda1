"""Q02 to Q06 on arriving rows: row checks are observed while a micro-batch is
written, key counts of uniqueness checks are kept by micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlens.operators.quality import Check, _failing_rows, assert_checks
from eventlens.sinks.writers import overwrite_partitions
from eventlens.streaming.jobs import _trigger


def _figure(check: Check):
    """What a check adds up over micro-batches: failing rows, or for
    ``at_least_one`` the values that are there."""
    if check.kind == "at_least_one":
        return F.count(F.col(check.target))
    return _failing_rows(check)


def check_stream(rows: DataFrame, model: str, checks: list[Check], out_path: str, report_path: str, checkpoint: str,
                 fail: bool = False, available_now: bool = False):
    """Write each micro-batch to ``out_path`` and its check figures to
    ``report_path``, both by batch id, so a replayed batch counts once.  The row
    checks cost no pass of their own (``observe``); the key counts of uniqueness
    checks are one more aggregation.  With ``fail`` a failed check ends the query
    after its figures are written; ``at_least_one`` is left to the report then,
    as later rows may still satisfy it."""
    mine = [c for c in checks if c.model == model]
    row_checks = [c for c in mine if c.kind != "unique"]
    keyed = [c for c in mine if c.kind == "unique"]

    def handle(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        if keyed:
            batch = batch.persist()
        try:
            seen = Observation()
            out = batch
            if row_checks:
                out = batch.observe(seen, *[_figure(c).cast("bigint").alias(f"c{i}") for i, c in enumerate(row_checks)])
            overwrite_partitions(out.withColumn("batch_id", F.lit(batch_id)), out_path, ["batch_id"])
            got = seen.get if row_checks else {}
            figures = [(model, c.label(), c.kind, int(got[f"c{i}"] or 0), batch_id) for i, c in enumerate(row_checks)]
            for i, c in enumerate(keyed):
                counts = batch.groupBy(*c.target).agg(F.count("*").alias("n_rows")).withColumn("batch_id", F.lit(batch_id))
                overwrite_partitions(counts, f"{report_path}/keys-{i}", ["batch_id"])
            report = spark.createDataFrame(figures, "model string, check_name string, kind string, figure bigint, batch_id bigint")
            overwrite_partitions(report, f"{report_path}/rows", ["batch_id"])
        finally:
            if keyed:
                batch.unpersist()
        if fail:
            assert_checks(report.where("kind <> 'at_least_one'").select(
                "model", "check_name", F.when(F.col("figure") > 0, "fail").otherwise("pass").alias("status")))

    return _trigger(rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint), None, available_now).start()


def stream_report(spark: SparkSession, model: str, checks: list[Check], report_path: str) -> DataFrame:
    """The figures of all micro-batches as the report of ``run_checks``."""
    mine = [c for c in checks if c.model == model]
    n = F.sum("figure")
    failures = F.when(F.first("kind") == "at_least_one", F.when(n == 0, F.lit(1)).otherwise(F.lit(0))).otherwise(n).cast("bigint")
    parts = []
    if any(c.kind != "unique" for c in mine):
        parts.append(spark.read.parquet(f"{report_path}/rows").groupBy("model", "check_name").agg(failures.alias("failures")))
    for i, c in enumerate(c for c in mine if c.kind == "unique"):
        keys = spark.read.parquet(f"{report_path}/keys-{i}").groupBy(*c.target).agg(F.sum("n_rows").alias("n_rows"))
        parts.append(keys.select(F.count_if(F.col("n_rows") > 1).cast("bigint").alias("failures"))
                     .select(F.lit(model).alias("model"), F.lit(c.label()).alias("check_name"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
