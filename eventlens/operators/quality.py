"""Data-quality checks.

Row-level checks of one table are evaluated together in a single
aggregation pass; each uniqueness check is one ``groupBy`` (partial
aggregation first, so a hot key costs one counter per partition).  The
report is a small DataFrame: one row per check.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dup_keys(df: DataFrame, keys) -> DataFrame:
    """Key groups occurring more than once, with their count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
            .where(F.col("n_rows") > 1))


@dataclass
class Check:
    """One check: ``kind`` in unique / not_null / at_least_one / expression /
    max_length; ``target`` a column or key list; ``arg`` an expression string
    or a length."""
    model: str
    kind: str
    target: object
    arg: object = None
    name: str = field(default="")

    def label(self) -> str:
        if self.name:
            return self.name
        t = ",".join(self.target) if isinstance(self.target, (list, tuple)) else str(self.target)
        return f"{self.kind}:{t}" + (f":{self.arg}" if self.arg is not None else "")


def _failing_rows(check: Check) -> Column:
    c = F.col(check.target) if isinstance(check.target, str) else None
    if check.kind == "not_null":                    # Q02
        return F.count_if(c.isNull())
    if check.kind == "at_least_one":                # Q03: fails once when no value exists
        return F.when(F.count(c) == 0, F.lit(1)).otherwise(F.lit(0))
    if check.kind == "expression":                  # Q04: rows where the expression is not true
        return F.count_if(~F.coalesce(F.expr(str(check.arg)), F.lit(False)))
    if check.kind == "max_length":                  # Q06 length limit
        return F.count_if(F.length(c) > int(check.arg))
    raise ValueError(check.kind)


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Q05: every check of a suite -> one report (model, check, failures,
    status).  Row-level checks of a model share one aggregation."""
    parts = []
    for model, df in tables.items():
        mine = [c for c in checks if c.model == model]
        row_checks = [c for c in mine if c.kind != "unique"]
        if row_checks:
            agg = df.agg(*[_failing_rows(c).cast("bigint").alias(f"c{i}") for i, c in enumerate(row_checks)])
            rows = F.array(*[F.struct(F.lit(c.label()).alias("check_name"), F.col(f"c{i}").alias("failures"))
                             for i, c in enumerate(row_checks)])
            parts.append(agg.select(F.lit(model).alias("model"), F.inline(rows)))
        for c in mine:
            if c.kind == "unique":                  # Q01: number of duplicated keys
                n = dup_keys(df, c.target).agg(F.count("*").cast("bigint").alias("failures"))
                parts.append(n.select(F.lit(model).alias("model"), F.lit(c.label()).alias("check_name"),
                                      "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def assert_checks(report: DataFrame) -> None:
    """Raise when any check failed (a data test run).  The report is one row
    per check, so collecting it is bounded by the suite size."""
    failed = [r.asDict() for r in report.where(F.col("status") == "fail").collect()]
    if failed:
        raise AssertionError(f"data checks failed: {failed}")


def video_suite() -> list[Check]:
    """The reference's model tests for the video models."""
    return [
        Check("stg_videos", "unique", ["video_id"]),
        Check("stg_videos", "not_null", "video_id"),
        Check("stg_videos", "not_null", "trending_date"),
        Check("stg_videos", "not_null", "views"),
        Check("stg_videos", "at_least_one", "views"),
        Check("stg_videos", "expression", "views", "views > 0"),
        Check("fct_video_trends", "unique", ["video_id"]),
        Check("fct_video_trends", "not_null", "video_id"),
        Check("fct_video_trends", "not_null", "engagement_rate"),
        Check("fct_video_trends", "at_least_one", "engagement_rate"),
        Check("fct_video_trends", "expression", "engagement_rate", "engagement_rate >= 0"),
    ]


def key_check(df: DataFrame, keys) -> DataFrame:
    """Q06: rows whose unique key would collide (the table's UNIQUE
    constraint), null keys excluded as the database treats them as
    distinct."""
    keys = list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return dup_keys(df.where(~any_null), keys)
