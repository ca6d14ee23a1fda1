"""Operator 8: shards by a Feistel permutation, in DataFrame functions only.

Every row gets a global number (its rank by doc_id, then text checksum and
size).  A keyed Feistel network over ``a x b`` cells, ``a = ceil(sqrt(n))`` and
``b = ceil(n / a)``, permutes the numbers; a result outside ``[0, n)`` walks on
along its cycle until it is inside.  Shard is the permuted number modulo the
shard count and slot its quotient, so row counts differ by one at most, slots
have no gaps, and both can be computed again from the row number, ``n`` and the
seed alone.

Fewer than ``a`` cells lie outside ``[0, n)``.  ``WALK`` steps therefore always
suffice for ``a <= WALK``, and otherwise fail with chance below WALK**-WALK.

Row numbers: rows are sorted by range partitions, written once to the shared
checkpoint folder with their place in the partition, and shifted by the sizes
of the partitions before (one row per partition).

Cases.  Null text: size 1, checksum 0.  Null doc_id: first in the order.
Repeated rows are rows of their own; equal ones are interchangeable.  No rows
give no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.spill import shuffle_parts, written

ROUNDS, WALK = 6, 48


def quotient(x: Column, by: int) -> Column:
    """Integer quotient of a number not below 0."""
    return F.call_function("div", x, F.lit(by).cast("long"))


def permuted(x: Column, n: int, seed: int) -> Column:
    """Place of number ``x`` in a keyed permutation of 0 .. n - 1."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    def once(y):
        def step(s, r):
            left = F.when(r % 2 == 0, F.pmod(s["l"] + F.pmod(F.xxhash64(F.lit(seed), r, s["r"]), F.lit(a)), F.lit(a))).otherwise(s["l"])
            right = F.when(r % 2 == 1, F.pmod(s["r"] + F.pmod(F.xxhash64(F.lit(seed), r, s["l"]), F.lit(b)), F.lit(b))).otherwise(s["r"])
            return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

        start = F.struct(quotient(y, b).alias("l"), F.pmod(y, F.lit(b)).cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["l"] * F.lit(b).cast("long") + s["r"])

    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), x.cast("long"),
                       lambda y, i: F.when((i > 1) & (y < F.lit(n)), y).otherwise(once(y)))


def numbered(rows: DataFrame, by) -> DataFrame:
    """``rows`` with ``row``: their number in the order of ``by``, from 0."""
    parts = shuffle_parts(rows)
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    placed = written(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
                     .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
                     .withColumn("at", inside), "numbered")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    shift = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    return placed.join(F.broadcast(shift), "part").withColumn("row", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def shards(docs: DataFrame, n_shards: int = 16, seed: int = 20240517) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, size, text_crc32, row, shard, slot."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    rows = numbered(rows, ["doc_id", "text_crc32", "size"])
    rows = written(rows, "rows")
    place = permuted(F.col("row"), rows.count(), seed)
    return rows.withColumn("place", place).select(
        "doc_id", "size", "text_crc32", "row", F.pmod("place", F.lit(n_shards)).cast("int").alias("shard"),
        quotient(F.col("place"), n_shards).alias("slot"))
