"""P10 for keywords from a table, and A03 as a bounded summary."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.functions.text import TRENDING_STOP_WORDS
from eventlens.operators.mentions import hour_sketches
from eventlens.sinks.writers import staged

#: an automaton takes up to about this many characters of keywords (some 100 bytes of memory each)
BLOCK_CHARS = 1_000_000
#: a task's sketches track up to so many items (some 100 bytes of memory each) before it sorts
TASK_ITEMS = 2_000_000


def _matcher(block):
    """Texts -> the keywords of the broadcast ``block`` that each contains; the
    automaton is built once per task."""
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick
        automaton = ahocorasick.Automaton()
        for k in block.value:
            automaton.add_word(k, k)
        automaton.make_automaton()
        for texts in batches:
            yield pd.Series([sorted({k for _, k in automaton.iter(t)}) if t and len(automaton) else [] for t in texts])
    return F.pandas_udf(match, "array<string>")


def keyword_search(df: DataFrame, keywords: DataFrame, keyword_col: str = "keyword", lang: str = "en",
                   text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """P10 with a table of keywords: one row for each post and keyword that its
    lower-cased text contains, in ``lang`` and without retweets, as
    ``keyword_filter`` gives.  Every text is read once by an Aho-Corasick
    automaton, however many keywords there are.  Null and empty keywords match
    nothing, repeated ones and those that differ in case count once.

    What is broadcast is bounded: the keywords are dealt by hash into as many
    blocks of about ``block_chars`` characters as they need, each a scan of its
    own."""
    spark = df.sparkSession
    kws = keywords.select(F.lower(F.col(keyword_col)).alias("k")).where(F.length("k") > 0).distinct()
    chars = kws.agg(F.coalesce(F.sum(F.length("k")), F.lit(0))).first()[0]
    blocks = int(chars) // block_chars + 1
    base = df.where((F.col("lang") == lang) & ~F.col(text_col).startswith("RT @"))
    out = None
    for b in range(blocks):
        mine = kws.where(F.pmod(F.xxhash64("k"), F.lit(blocks)) == b)
        found = _matcher(spark.sparkContext.broadcast([r.k for r in mine.toLocalIterator()]))(F.lower(F.col(text_col)))
        hits = base.withColumn("keyword", F.explode(found))
        out = hits if out is None else out.unionByName(hits)
    return out


def topics_summary(df: DataFrame, items: int = 4096, min_len: int = 3, stop_words=TRENDING_STOP_WORDS) -> DataFrame:
    """A03 as a summary that merges: per date and hour the mentions of all
    keywords and a frequent-items sketch that tracks ``items`` of them.  Sketches
    are made of the sums of a block of posts and merged before the shuffle, so
    neither the keywords nor a hot hour grow a task.  The summary is written to the
    shared checkpoint folder."""
    out = merge_summaries(hour_sketches(df, items, min_len, stop_words), items)
    # beyond 128 hours Spark would sort the sketches of a task's blocks, on disk, instead of merging them an hour
    spark, name = df.sparkSession, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(128, TASK_ITEMS // int(items))))
    try:
        return staged(out, "summary")
    finally:
        spark.conf.set(name, before)


def merge_summaries(parts: DataFrame, items: int = 4096) -> DataFrame:
    """Summaries of several loads as one per date and hour."""
    return parts.groupBy("date_partition", "hour_timestamp").agg(
        F.sum("mentions").alias("mentions"), F.expr(f"approx_top_k_combine(sketch, {int(items)})").alias("sketch"))


def summary_error(items: int = 4096) -> float:
    """The greatest error of an estimate as a share of the hour's mentions: 3.5
    over the sketch's table size, the power of two that ``items`` fill to three
    quarters at most."""
    size = 1
    while size * 0.75 < items:
        size *= 2
    return 3.5 / size


def frequent_keywords(summary: DataFrame, items: int = 4096) -> DataFrame:
    """The keywords of a summary whose estimate is above the error bound, with
    ``bound``: all that are mentioned more than twice the bound are among them, and
    estimates are off by at most the bound."""
    s = summary.withColumn("bound", F.ceil(F.col("mentions") * F.lit(summary_error(items))))
    top = s.select("date_partition", "hour_timestamp", "bound", F.inline(F.expr(f"approx_top_k_estimate(sketch, {int(items)})")))
    return top.where(F.col("count") > F.col("bound")).select(
        "date_partition", "hour_timestamp", F.col("item").alias("keyword"), F.col("count").alias("mentions_estimate"), "bound")
