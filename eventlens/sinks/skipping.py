"""K15 with proof: tables clustered by several columns, and what a lookup meets
by the min/max figures of Parquet footers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: bits of a column's rank in the clustering key
BITS = 6


def _rank(df: DataFrame, cols, accuracy: int = 10_000) -> dict[str, Column]:
    """Each column's place among 2^BITS - 1 quantiles (one aggregation, at most
    that many bounds a column, however large the table)."""
    shares = [k / 2 ** BITS for k in range(1, 2 ** BITS)]
    bounds = df.agg(*[F.percentile_approx(c, shares, accuracy).alias(c) for c in cols]).first()

    def place(c):
        return F.size(F.filter(F.array(*[F.lit(b) for b in bounds[c] or []]), lambda b: b < F.col(c)))
    return {c: place(c) for c in cols}


def cluster(df: DataFrame, path: str, cols, files: int) -> None:
    """Write ``files`` files clustered by numeric ``cols`` alike: ranks of the
    columns are interleaved bit by bit, rows dealt to files by ranges of that
    key and sorted by it, so a file (and a row group) is narrow in each column.
    Nulls rank first."""
    ranks = _rank(df, cols)
    places = [F.when(F.col(c).isNotNull(), ranks[c]).otherwise(0) for c in cols]
    # the places are an array of their own, so that each is computed once and not once a bit
    bits = [F.shiftleft(F.shiftright(F.col("_key")[k], bit).bitwiseAND(F.lit(1)), bit * len(cols) + k)
            for bit in range(BITS) for k in range(len(cols))]
    out = df.withColumn("_key", F.array(*places)).withColumn("_key", reduce(lambda a, b: a.bitwiseOR(b), bits))
    out = out.repartitionByRange(files, "_key", *cols).sortWithinPartitions("_key", *cols)
    out.drop("_key").write.mode("overwrite").parquet(path)


def row_groups(spark: SparkSession, path: str, cols) -> DataFrame:
    """The row groups of a table's files with min and max of numeric ``cols``,
    from the footers, which Spark tasks read (the driver lists the files, as for any scan): (path, row_group, n_rows, column,
    low, high).  A row group without figures has null bounds, and must be read."""
    names = spark.read.parquet(path).inputFiles()
    files = spark.createDataFrame([(n,) for n in names], "path string").repartition(max(1, min(len(names), 256)))
    cols = list(cols)

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.parse import unquote

        import pyarrow.parquet as pq
        from pyarrow import fs
        for batch in batches:
            rows = []
            for p in batch["path"]:
                where, name = fs.FileSystem.from_uri(p.replace("file:///", "/") if p.startswith("file:///") else p)
                with where.open_input_file(unquote(name)) as f:
                    meta = pq.ParquetFile(f).metadata
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    at = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
                    for c in cols:
                        s = at[c] if at[c] is not None and at[c].has_min_max else None
                        rows.append((p, g, group.num_rows, c, s and float(s.min), s and float(s.max)))
            yield pd.DataFrame(rows, columns=["path", "row_group", "n_rows", "column", "low", "high"])

    return files.mapInPandas(footers, "path string, row_group int, n_rows long, column string, low double, high double")


def lookup_cost(groups: DataFrame, col: str, values: DataFrame, value_col: str = "value") -> DataFrame:
    """For each distinct value the files and row groups (rows of ``row_groups``)
    that a lookup of ``col`` has to read.  No value meets a row group: the column's
    range is cut into 256 cells, and a value's figures are those of the ranges that
    reach into its cell from below, and of the bounds in the cell up to the value,
    as a running sum.  So the work is that of the values and the row groups, not of
    their pairs."""
    groups = groups.where(F.col("column") == col)
    span = groups.agg(F.min("low").alias("lo"), F.max("high").alias("hi")).first()
    lo, hi = span.lo or 0.0, span.hi or 0.0
    step = max((hi - lo) / 256, 1e-9)
    cell = lambda c: F.floor((c - F.lit(lo)) / F.lit(step))
    known = groups.where("low is not null").select("path", "low", "high")
    # a file's row groups that overlap are one range of the file
    before = F.max("high").over(Window.partitionBy("path").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    ranges = known.withColumn("new", F.when(F.col("low") <= before, 0).otherwise(1))
    ranges = ranges.withColumn("island", F.sum("new").over(Window.partitionBy("path").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0)))
    ranges = ranges.groupBy("path", "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    ranges = ranges.select("low", "high", F.lit(1).alias("files"), F.lit(0).alias("row_groups")).unionByName(
        known.select("low", "high", F.lit(0).alias("files"), F.lit(1).alias("row_groups")))
    ranges = ranges.withColumns({"from": cell(F.col("low")), "to": cell(F.col("high"))})
    reach = ranges.where(F.col("to") > F.col("from")).withColumn("cell", F.explode(F.sequence(F.col("from") + 1, F.col("to"))))
    reach = reach.groupBy("cell").agg(F.sum("files").alias("base_files"), F.sum("row_groups").alias("base_groups"))

    wanted = values.select(F.col(value_col).cast("double").alias("value")).where("value is not null").distinct()
    # of equal places a range's low comes before the value, its high after it
    points = wanted.select(cell(F.col("value")).alias("cell"), F.col("value").alias("at"), F.lit(1).alias("turn"), F.lit(0).alias("f"), F.lit(0).alias("g"))
    for place, at, turn, sign in (("from", "low", 0, 1), ("to", "high", 2, -1)):
        bounds = ranges.groupBy(F.col(place).alias("cell"), F.col(at).alias("at")).agg((sign * F.sum("files")).alias("f"), (sign * F.sum("row_groups")).alias("g"))
        points = points.unionByName(bounds.withColumn("turn", F.lit(turn)))
    up_to = Window.partitionBy("cell").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    met = points.withColumns({"f": F.sum("f").over(up_to), "g": F.sum("g").over(up_to)}).where("turn = 1").join(F.broadcast(reach), "cell", "left")
    blind = groups.where("low is null").agg(F.count("*").alias("n"), F.count_distinct("path").alias("f")).first()
    inside = lambda n, base: F.when(F.col("at").between(lo, hi), n + F.coalesce(base, F.lit(0))).otherwise(0)
    return met.select(F.col("at").alias("value"), (inside(F.col("f"), F.col("base_files")) + blind.f).alias("files"),
                      (inside(F.col("g"), F.col("base_groups")) + blind.n).alias("row_groups"))
