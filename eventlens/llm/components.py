"""Connected components by alternating large-star and small-star steps.

Every step is a ``groupBy(...).min`` and a join back.  A node with a third of
all edges is pre-aggregated; the minima are written before they are joined, so
the join has an exchange of its own on both sides and AQE can split a hot node.
No adjacency list is ever gathered.  Each round is written to the shared
checkpoint folder; its tables are dropped when the next round is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.spill import table_path, written
from eventlens.session import drop_folder, scratch_run


def _mark(edges: DataFrame):
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges`` (a, b) of longs -> (node, component): the smallest node each
    node can reach.  Nodes without an edge do not appear; self links and
    repeated links count as nothing; no edges give no rows."""
    spark, path = edges.sparkSession, table_path(edges.sparkSession, name)
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .distinct(), name, path)
    mark = _mark(e)
    while mark[0]:
        before, path = path, table_path(spark, name)
        with scratch_run(spark, f"{name}-round"):
            both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
            large = (both.join(low, "u").where("v > u and v > m")
                     .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
            large = written(large, name)
            low = written(large.groupBy("u").agg(F.min("v").alias("m")), name)
            small = (large.join(low, "u").where("v <> m")
                     .select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
            e = written(small, name, path)
        drop_folder(spark, before)
        last, mark = mark, _mark(e)
        if mark == last:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
