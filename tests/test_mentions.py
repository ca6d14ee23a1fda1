"""Mentions of keywords by hour, added up where the posts are."""

import datetime as dt
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from eventlens.functions.text import TRENDING_STOP_WORDS
from eventlens.operators import keywords as KW
from eventlens.operators import mentions as M
from eventlens.operators import sentiment as S


def test_hourly_topics_shuffle_sums_not_words(spark):
    """Posts are not sent to their hours with their words, nor is there a row for each mention."""
    t = dt.datetime(2024, 1, 15, 10)
    texts = [" ".join(f"{a}word{b}" for a in "abcdefgh" for b in "xyz" for _ in range(1 + (ord(b) + k) % 3)) for k in range(3)]
    df = spark.range(900).select(F.lit(t).alias("created_at"), F.lit(t.date()).alias("date_partition"), F.lit("positive").alias("predicted_sentiment"),
                                 (F.col("id") % 3).alias("k"), F.lit(0.5).alias("sentiment_positive"), F.lit(0.25).alias("sentiment_negative"))
    df = df.join(F.broadcast(spark.createDataFrame(list(enumerate(texts)), "k long, text string")), "k")
    out = S.trending_topics_hourly(df)
    got = {r.keyword: (r.mention_count, r.positive_mentions, r.negative_mentions, r.avg_sentiment_score) for r in out.collect()}
    assert got == {f"{a}word{b}": (1800, 1800, 0, 0.25) for a in "abcdefgh" for b in "xyz"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.find("== Initial Plan")] if "== Initial Plan" in plan else plan
    assert "Generate" not in final and "explode" not in final
    # below the exchange each task has added up its posts: at most a row for each part
    sent = out._jdf.queryExecution().optimizedPlan().toString()
    assert sent.count("MapInArrow") == 2 and "sums" in sent


def _brute(rows):
    want = {}
    for day, hour, kind, score, text in rows:
        for w in re.findall("[a-z]{3,}", (text or "").lower()):
            if w != "the":
                n = want.setdefault((day, hour, w), [0, 0, 0, 0, 0.0, 0])
                n[0] += 1
                if kind // 2 < 3:
                    n[1 + kind // 2] += 1
                if score is not None:
                    n[4] += score
                    n[5] += 1
    return want


def test_blocks_of_posts_add_up(monkeypatch):
    """Blocks, slabs of words and batches end anywhere; dates, hours, scores and texts may be null."""
    rnd = random.Random(5)
    hours = [dt.datetime(2024, 1, 15, h, tzinfo=dt.timezone.utc) for h in range(3)] + [None]
    texts = [None, "", "1 2 the", "é the ünder\x00abc"] + [" ".join(rnd.choice(["The", "Alpha", "BETA", "beta", "gamma", "xx", "w" + rnd.choice("abcd") * 3]) for _ in range(9)) for _ in range(20)]
    rows = []
    for _ in range(400):
        h, score = rnd.choice(hours), rnd.choice([None, 0.5, -0.25, 1.0])
        rows.append((h and h.date() if rnd.random() < 0.9 else None, h, 2 * rnd.randrange(4) + (score is None), score, rnd.choice(texts)))
    types = (pa.date32(), pa.timestamp("us", "UTC"), pa.int32(), pa.float64(), pa.string())
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 37]), types)], ["d", "h", "kind", "score", "text"]) for i in range(0, 400, 37)]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*dict.fromkeys(r[:2] for r in rows)), types)], names=["d", "h"])
    for posts, words, pairs, some in ((10**6, 10**6, 10**6, 10**6), (50, 10**6, 100, 7), (10**6, 30, 1, 3)):
        for name, value in (("BLOCK_POSTS", posts), ("BLOCK_WORDS", words), ("PAIRS", pairs), ("ROWS", some)):
            monkeypatch.setattr(M, name, value)
        packed = pa.Table.from_batches(M._pack(3, ["the"], table, np.array([7, 8, 9]))(iter(batches)))
        got, names = [], ["d", "h", "keyword", "n", "positive", "neutral", "negative", "score"]
        for part in (7, 8, 9):
            mine = packed.filter(pc.equal(packed["part"], part))
            got += [r for b in M._unpack(table, names)(iter(mine.to_batches())) for r in b.to_pylist()]
        want = _brute(rows)
        assert len(got) == len(want) and {(r["d"], r["h"], r["keyword"]) for r in got} == want.keys()
        for r in got:
            n = want[r["d"], r["h"], r["keyword"]]
            assert [r[c] for c in names[3:7]] == n[:4] and (r["score"] == pytest.approx(n[4] / n[5]) if n[5] else r["score"] is None)
    with pytest.raises(ValueError):
        list(M._pack(3, [], table.slice(0, 2), np.array([7]))(iter(batches)))


def _posts(spark, texts):
    """Posts of three hours and of none, for (times, text)."""
    posts = spark.createDataFrame(texts, "times int, text string").select("text", F.explode(F.sequence(F.lit(1), "times")).alias("i"))
    at = F.expr("CASE WHEN i % 4 < 3 THEN timestamp_ntz'2024-01-15 10:00:00' + make_dt_interval(0, i % 4) END")
    return posts.select("text", at.alias("created_at"), F.to_date(at).alias("date_partition"))


def _letters(i):
    return "".join("abcdefghij"[int(d)] for d in str(i))


def test_stored_sketch_is_what_spark_stores(spark):
    for items in (5, 64, 512, 4096):
        like = spark.range(1).select(F.lit("word").alias("k")).agg(F.expr(f"approx_top_k_accumulate(k, {items})").alias("s")).first().s
        most = next(2 ** k for k in range(3, 20) if 2 ** k * 0.75 >= items)
        assert bytes(like.sketch) == M.sketch([M.with_length(b"word")], np.array([1]), 0, 1, most)


def test_summary_is_made_of_sums(spark, monkeypatch):
    """No row for each mention: a sketch gets a word's count at once."""
    seen, real = [], KW.staged
    monkeypatch.setattr(KW, "staged", lambda df, name: (seen.append(df._jdf.queryExecution().optimizedPlan().toString()), real(df, name))[1])
    posts = _posts(spark, [(40, "Alpha beta beta the"), (8, "beta"), (4, None), (4, "1 the")])
    out = KW.topics_summary(posts, 64)
    assert len(seen) == 1 and "MapInArrow" in seen[0] and "keyword" not in seen[0]
    got = {(r.hour_timestamp and r.hour_timestamp.hour, r.item): r["count"] for r in
           out.select("hour_timestamp", F.inline(F.expr("approx_top_k_estimate(sketch, 64)"))).collect()}
    assert got == {(h, w): n for h in (10, 11, 12, None) for w, n in (("alpha", 10), ("beta", 22))}
    assert [r.mentions for r in out.collect()] == [32] * 4


def test_summary_without_the_known_layout(spark, monkeypatch):
    """Spark updates its sketches itself where it stores them otherwise."""
    posts = _posts(spark, [(40, "Alpha beta beta the"), (8, "beta"), (4, None)])
    rows = lambda: {(r.hour_timestamp, r.mentions): {(i.item, i["count"]) for i in r.e} for r in KW.topics_summary(posts, 64).select(
        "hour_timestamp", "mentions", F.expr("approx_top_k_estimate(sketch, 64)").alias("e")).collect()}
    want = rows()
    monkeypatch.setattr(M, "sketch", lambda *_: b"other")
    plan = M.hour_sketches(posts, 64, 3, TRENDING_STOP_WORDS)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and rows() == want and len(want) == 4


def test_sketch_of_more_words_than_fit(spark):
    """What is taken from the counts is in the sketch's offset: estimates stay within the bound, also after merging."""
    texts = [(max(1, 600 // (i + 1)), "zipf" + _letters(i)) for i in range(700)]
    posts = _posts(spark, texts).withColumn("created_at", F.lit(dt.datetime(2024, 1, 15, 10)).cast("timestamp_ntz")).withColumn("date_partition", F.to_date("created_at"))
    exact = {text: n for n, text in texts}
    third = lambda i: KW.topics_summary(posts.where(F.pmod(F.xxhash64("text"), F.lit(3)) == i), 64)
    whole = KW.topics_summary(posts, 64)
    for times, summary in ((1, whole), (2, whole.unionByName(whole)), (1, third(0).unionByName(third(1)).unionByName(third(2)))):
        merged = KW.merge_summaries(summary, 64)
        n = times * sum(exact.values())
        assert [r.mentions for r in merged.collect()] == [n]
        bound = -(-n * KW.summary_error(64) // 1)
        got = {r.keyword: r.mentions_estimate for r in KW.frequent_keywords(merged, 64).collect()}
        assert all(abs(m - times * exact[w]) <= bound for w, m in got.items())
        assert {w for w, m in exact.items() if times * m > 2 * bound} <= set(got) and len(got) >= 2


def test_block_sketches_of_hot_hours(monkeypatch):
    """An hour of more pairs than are added up together is in several sketches, whose mentions are all of its."""
    t = dt.datetime(2024, 1, 15, 10, tzinfo=dt.timezone.utc)
    rows = [(t.date(), t + dt.timedelta(hours=i % 3), 0, 0.0, " ".join(f"w{_letters(k)}" for k in range(i % 7, 40))) for i in range(60)]
    types = (pa.date32(), pa.timestamp("us", "UTC"), pa.int32(), pa.float64(), pa.string())
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), types)], ["d", "h", "kind", "score", "text"])
    want = {}
    for _, h, _, _, text in rows:
        want[h] = want.get(h, 0) + sum(len(w) >= 3 for w in text.split())
    for pairs in (10**6, 100):
        monkeypatch.setattr(M, "PAIRS", pairs)
        got = [r for b in M._sketches(3, [], 16, ["d", "h", "mentions", "sketch"])(iter([batch])) for r in b.to_pylist()]
        assert (len(got) == 3) == (pairs == 10**6)
        assert {h: sum(r["mentions"] for r in got if r["h"] == h) for h in want} == want
        for r in got:  # what the counts and the offset leave out is less than it could be
            active, total, off = (int.from_bytes(r["sketch"][a:b], "little") for a, b in ((8, 12), (16, 24), (24, 32)))
            counts = np.frombuffer(r["sketch"], "<i8", active, 32)
            assert active <= 12 and total == r["mentions"] and (counts > 0).all() and counts.sum() + 13 * off <= total
