"""IP-range enrichment (J04): the most specific range that holds an address,
without a nested-loop join.

Each range is cut into the CIDR blocks that make it up (at most 62, whatever
its width), so a lookup is an equality on (prefix length, address prefix).  The
distinct addresses of the input meet the blocks at each prefix length that the
ranges have, the narrowest range wins, and the result is joined back to the
rows by address.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from eventlens.functions.security import ip_to_long

GEO_COLUMNS = ("country_name", "city_name", "location")
#: rows without an address are dealt over this many join keys
SPREAD = 4096


def cidr_blocks(ranges: DataFrame) -> DataFrame:
    """Adds ``host_bits`` and ``prefix`` (address >> host_bits): one row for each
    maximal aligned block of a range (start_ip, end_ip, both in it).  At a block
    size of 2**k the blocks from ceil(start / 2**k) to floor((end + 1) / 2**k)
    fit; an odd first and an odd end are not part of a larger block."""
    r = ranges.where("start_ip <= end_ip").withColumn("host_bits", F.explode(F.sequence(F.lit(0), F.lit(32))))
    size = F.expr("shiftleft(1L, host_bits)")
    first, stop = F.ceil(F.col("start_ip") / size).cast("long"), F.floor((F.col("end_ip") + 1) / size).cast("long")
    fits = first < stop
    blocks = F.array(F.when(fits & (first % 2 == 1), first), F.when(fits & (stop % 2 == 1), stop - 1))
    return r.withColumn("prefix", F.explode(F.array_distinct(F.array_compact(blocks))))


def geoip_enrich(df: DataFrame, ip_col: str, ranges: DataFrame) -> DataFrame:
    """Left-join ``ranges`` (start_ip, end_ip, geo columns) to ``df`` by the
    IPv4 in ``ip_col``; rows without an address or a range keep null geo fields.
    Of ranges that hold one address the narrowest wins, then the one that starts
    first.  Rows without an address are dealt over ``SPREAD`` keys."""
    geo = [c for c in GEO_COLUMNS if c in ranges.columns]
    blocks = cidr_blocks(ranges.select("start_ip", "end_ip", *geo))
    blocks = blocks.select("host_bits", "prefix", F.struct((F.col("end_ip") - F.col("start_ip")).alias("width"), "start_ip").alias("_rank"), *geo)
    levels = blocks.agg(F.array_sort(F.collect_set("host_bits"))).scalar()
    seen = df.select(ip_to_long(F.col(ip_col)).alias("_g_ip")).where("_g_ip is not null").distinct()
    tried = seen.withColumn("host_bits", F.explode(levels)).withColumn("prefix", F.expr("shiftright(_g_ip, host_bits)"))
    best = tried.join(blocks, ["host_bits", "prefix"]).groupBy(F.col("_g_ip").alias("_g_key")).agg(
        F.min_by(F.struct(*geo), "_rank").alias("_g"))
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    key = F.coalesce(ip_to_long(F.col(ip_col)), -1 - F.pmod(F.xxhash64(*plain), F.lit(SPREAD)))
    out = df.withColumn("_g_ip", key).join(best, F.col("_g_ip") == F.col("_g_key"), "left")
    return out.select(*df.columns, *[F.col(f"_g.{c}").alias(c) for c in geo])


def nation_ranges(nation: DataFrame, region: DataFrame | None = None) -> DataFrame:
    """A small range table derived from ``nation``: nation ``k`` owns
    ``10.0.k.0 - 10.0.k.255``; the city is the nation's region name."""
    base = nation.select("n_nationkey", "n_name", "n_regionkey")
    if region is not None:
        base = base.join(F.broadcast(region.select("r_regionkey", "r_name")),
                         base.n_regionkey == F.col("r_regionkey"), "left")
        city = F.col("r_name")
    else:
        city = F.lit(None).cast("string")
    start = F.lit(10 * 16777216) + F.col("n_nationkey").cast("long") * 256
    return base.select(start.alias("start_ip"), (start + 255).alias("end_ip"),
                       F.col("n_name").alias("country_name"), city.alias("city_name"),
                       F.struct((F.col("n_nationkey") * 1.0).alias("lat"),
                                (F.col("n_regionkey") * 1.0).alias("lon")).alias("location"))
