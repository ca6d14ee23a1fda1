"""Tables that are kept up to date: the hard cases."""

import datetime as dt
import glob
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from eventlens.operators import keywords as KW
from eventlens.operators import sentiment as S
from eventlens.operators.quality import Check, run_checks
from eventlens.sinks.merged import compact_parts, compact_versions, latest, read_parts, upsert
from eventlens.sources.streams import batch_files
from eventlens.sinks.skipping import cluster, lookup_cost, row_groups
from eventlens.streaming.checks import check_stream, stream_report
from eventlens.streaming.suppression import Suppress, SuppressKeys

T = dt.datetime(2024, 1, 15, 10)


class _Cell:
    def __init__(self):
        self.v = None

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v

    def clear(self):
        self.v = None


class _Map(dict):
    writes = 0

    def getValue(self, k):
        return self[k]

    def updateValue(self, k, v):
        self.writes += 1
        self[k] = v


class _Handle:
    """The state of one key, and the clock."""

    def __init__(self):
        self.now, self.watermark, self.timers, self.cell, self.map = 0, 0, [], _Cell(), _Map()

    def getValueState(self, *_):
        return self.cell

    def getMapState(self, *_):
        return self.map

    def registerTimer(self, ms):
        self.timers.append(ms)

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getCurrentWatermarkInMs(self):
        return self.watermark


def _chunk(minutes):
    return pd.DataFrame({"ts": [None if m is None else pd.Timestamp(T) + pd.Timedelta(minutes=m) for m in minutes],
                         "alert": [f"{m}" for m in minutes]}).astype({"ts": "datetime64[ns]"})


def test_suppression_chunks_give_what_one_chunk_gives():
    minutes = [(i * 37) % 200 for i in range(180)] + [None, 0, 0, 199]
    kept = []
    for size in (len(minutes), 7):
        h = _Handle()
        s = Suppress(15 * 60 * 1_000_000, 1000)
        s.init(h)
        chunks = [_chunk(minutes[i:i + size]) for i in range(0, len(minutes), size)]
        out = pd.concat(s.handleInputRows(("k",), iter(chunks), h))
        assert len(out) == len(minutes) and not h.map and (h.map.writes > 0) == (size == 7)
        kept.append(out[out["kept"]]["alert"].tolist())
        # the next batch meets the state
        nxt = pd.concat(s.handleInputRows(("k",), iter([_chunk([5, 206, 230])]), h))
        kept[-1].append(nxt["kept"].tolist())
    want, last = [], None
    for m in sorted({m for m in minutes if m is not None}):
        if last is None or m - last >= 15:
            last = m
            want.append(str(m))
    assert kept[0] == kept[1] and sorted(kept[0][:-1]) == sorted(want + ["None"])
    assert kept[0][-1] == [False, 206 - last >= 15, True]


def test_suppression_timer_needs_idleness_and_the_watermark():
    h = _Handle()
    s = Suppress(15 * 60 * 1_000_000, 1000)
    s.init(h)
    list(s.handleInputRows(("k",), iter([_chunk([0])]), h))
    h.now = 500
    list(s.handleInputRows(("k",), iter([_chunk([1])]), h))
    assert h.timers == [1000]                       # one timer a key
    h.now = 1000
    list(s.handleExpiredTimer(("k",), h, None))
    assert h.timers[-1] == 1500 and h.cell.exists()  # seen at 500
    h.now = 1500
    list(s.handleExpiredTimer(("k",), h, None))
    assert h.cell.exists()                          # idle, not behind the watermark
    h.now, h.watermark = 2500, int(pd.Timestamp(T).timestamp() * 1000) + 15 * 60 * 1000
    list(s.handleExpiredTimer(("k",), h, None))
    assert not h.cell.exists()


def _parts(spark, batch, rows, path):
    df = spark.createDataFrame([(T.replace(hour=h), n) for h, n in rows], "hour timestamp_ntz, n bigint").withColumn("batch_id", F.lit(batch))
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def test_parts_merged_under_a_live_stream(spark, tmpdir_path):
    parts, merged = f"{tmpdir_path}/parts", f"{tmpdir_path}/merged"
    merge = lambda df: df.groupBy("hour").agg(F.sum("n").alias("n"))
    total = lambda: {r.hour.hour: r.n for r in merge(read_parts(spark, parts, merged)).collect()}
    _parts(spark, 0, [(1, 1), (2, 1)], parts)
    assert compact_parts(spark, parts, merged, merge) is None  # the only batch may be replayed
    _parts(spark, 1, [(1, 10)], parts)
    _parts(spark, 2, [(3, 100)], parts)
    want = {1: 11, 2: 1, 3: 100}
    assert total() == want
    assert compact_parts(spark, parts, merged, merge) == 1
    assert total() == want
    _parts(spark, 2, [(3, 100)], parts)             # a replayed batch
    assert compact_parts(spark, parts, merged, merge) == 1 and total() == want
    before = read_parts(spark, parts, merged)       # a reader that has begun
    _parts(spark, 3, [(1, 1000)], parts)
    want[1] = 1011
    # a compaction that broke off before it was complete is not seen
    spark.createDataFrame([(T, 5)], "hour timestamp_ntz, n bigint").write.parquet(f"{merged}/up_to=2")
    os.remove(f"{merged}/up_to=2/_SUCCESS")
    assert total() == want
    assert compact_parts(spark, parts, merged, merge) == 2 and total() == want
    assert sorted(os.listdir(merged)) == ["up_to=1", "up_to=2"]
    assert {r.hour.hour: r.n for r in merge(before).collect()} == {1: 11, 2: 1, 3: 100}  # its files are still there
    assert not os.path.exists(f"{parts}/batch_id=0") and os.path.exists(f"{parts}/batch_id=3")


def test_last_write_wins_in_any_order(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    rows = lambda v, keys: spark.createDataFrame([(k, v, f"{k}-{v}") for k in keys], "k int, v int, note string")
    upsert(rows(2, range(20)), path, "k", "v", "b", buckets=8)
    upsert(rows(1, range(30)), path, "k", "v", "a", buckets=8)     # late
    upsert(rows(2, range(20)), path, "k", "v", "b", buckets=8)     # again
    want = {k: f"{k}-{2 if k < 20 else 1}" for k in range(30)}
    got = lambda: {r.k: r.note for r in latest(spark, path, "k", "v").collect()}
    assert got() == want
    assert len(compact_versions(spark, path, "k", "v")) >= 1
    assert got() == want and spark.read.parquet(path).count() == 30
    files = set(glob.glob(f"{path}/bucket=*/load_id=*/*.parquet"))
    assert compact_versions(spark, path, "k", "v") == []           # nothing to do
    upsert(rows(3, [7]), path, "k", "v", "c", buckets=8)
    touched = compact_versions(spark, path, "k", "v")
    want[7] = "7-3"
    assert got() == want and len(touched) == 1
    now = set(glob.glob(f"{path}/bucket=*/load_id=*/*.parquet"))
    assert all(f"bucket={touched[0]}/" in f for f in files ^ now)  # the others are the same files


CHECKS = [Check("m", "unique", ["id"]), Check("m", "not_null", "id"), Check("m", "at_least_one", "note"),
          Check("m", "expression", "x", "x > 0"), Check("m", "max_length", "note", 3)]


def test_checks_on_a_stream_equal_a_batch(spark, tmpdir_path):
    schema = "id int, x int, note string"
    batches = [[(1, 1, None), (2, 0, None)], [(1, 5, None), (None, None, None)], [(3, 1, "long note"), (None, 2, "ok")]]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{tmpdir_path}/in")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmpdir_path}/in")
    run = lambda k: check_stream(src, "m", CHECKS, f"{tmpdir_path}/out", f"{tmpdir_path}/report", f"{tmpdir_path}/ckpt-{k}",
                                 available_now=True).awaitTermination()
    rows = lambda df: sorted((r.check_name, r.failures, r.status) for r in df.collect())
    batch = rows(run_checks({"m": spark.read.parquet(f"{tmpdir_path}/in")}, CHECKS))
    for k in range(2):  # the second run replays every batch id
        run(k)
        assert rows(stream_report(spark, "m", CHECKS, f"{tmpdir_path}/report")) == batch
        assert spark.read.parquet(f"{tmpdir_path}/out").count() == 6
    failing = check_stream(src, "m", CHECKS, f"{tmpdir_path}/out2", f"{tmpdir_path}/report2", f"{tmpdir_path}/ckpt-x", fail=True, available_now=True)
    with pytest.raises(Exception, match="data checks failed"):
        failing.awaitTermination()


def test_keyword_search_equals_the_plain_filter(spark):
    texts = ["Market news", "supermarket", "RT @a market", None, "", "the end", "ünder the sea"]
    df = spark.createDataFrame([(i, t, "de" if i == 5 else "en") for i, t in enumerate(texts)], "post_id int, text string, lang string")
    words = ["market", "Market", "the", "Ün", "ark", "none", "a b"]
    plain = {(r.post_id, r.keyword) for r in S.keyword_filter(df, words).collect()}
    kws = spark.createDataFrame([(w,) for w in words + ["", None]], "keyword string")
    for block in (KW.BLOCK_CHARS, 5):
        got = [(r.post_id, r.keyword) for r in KW.keyword_search(df, kws, block_chars=block).collect()]
        assert len(got) == len(set(got)) and set(got) == plain
    assert KW.keyword_search(df, kws.limit(0)).count() == 0


def test_ten_thousand_keywords_are_one_pass(spark):
    df = spark.range(200).select(F.concat(F.lit("x"), "id", F.lit(" y")).alias("text"), F.lit("en").alias("lang"), F.col("id").alias("post_id"))
    kws = spark.range(10_000).select(F.concat(F.lit("X"), "id", F.lit(" ")).alias("keyword"))
    out = KW.keyword_search(df, kws)
    assert out._jdf.queryExecution().toString().count("Union") == 0
    assert {(r.post_id, r.keyword) for r in out.collect()} == {(i, f"x{i} ") for i in range(200)}


def test_summary_of_more_keywords_than_it_tracks(spark):
    # word i occurs 4000 // (i + 1) times, and 3,000 words once: far more than 64 tracked ones
    letters = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")
    words = (spark.range(40).select(F.concat(F.lit("hot"), letters).alias("text"), F.explode(F.sequence(F.lit(1), F.floor(F.lit(4000) / (F.col("id") + 1))))).drop("col")
             .unionByName(spark.range(3000).select(F.concat(F.lit("once"), letters).alias("text"))))
    posts = words.withColumns({"created_at": F.lit(T).cast("timestamp_ntz"), "date_partition": F.lit(T).cast("date")})
    half = F.pmod(F.xxhash64("text", F.rand(1)), F.lit(2)) == 0
    posts = posts.withColumn("h", half).persist()
    parts = KW.topics_summary(posts.where("h"), 64).unionByName(KW.topics_summary(posts.where("not h"), 64))
    merged = KW.merge_summaries(parts, 64)
    exact = {r.text: r["count"] for r in posts.groupBy("text").count().collect()}
    bound = -(-sum(exact.values()) * KW.summary_error(64) // 1)
    got = {r.keyword: r.mentions_estimate for r in KW.frequent_keywords(merged, 64).collect()}
    posts.unpersist()
    assert all(abs(n - exact[w]) <= bound for w, n in got.items())
    assert {w for w, n in exact.items() if n > 2 * bound} <= set(got) and len(got) >= 2


def test_clustered_table_skips_files(spark, tmpdir_path):
    rows = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(500)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)).alias("b"), "id")
    rows = rows.withColumn("a", F.when(F.col("id") % 50 != 0, F.col("a")))
    rows.repartition(16).write.parquet(f"{tmpdir_path}/plain")
    cluster(rows, f"{tmpdir_path}/clustered", ("a", "b"), files=16)
    back = spark.read.parquet(f"{tmpdir_path}/clustered")
    assert back.exceptAll(rows).count() == 0 and back.count() == 20_000
    assert row_groups(spark, f"{tmpdir_path}/clustered", ["a"]).agg(F.sum("n_rows")).first()[0] == 20_000
    for c in ("a", "b"):
        values = spark.createDataFrame([(7.0,), (250.0,), (499.0,), (9999.0,), (None,)], "value double")
        plain = {r.value: r.files for r in lookup_cost(row_groups(spark, f"{tmpdir_path}/plain", ["a", "b"]), c, values).collect()}
        met = {r.value: r.files for r in lookup_cost(row_groups(spark, f"{tmpdir_path}/clustered", ["a", "b"]), c, values).collect()}
        assert set(met) == {7.0, 250.0, 499.0, 9999.0} and plain[250.0] == 16 and met[9999.0] == 0
        assert all(1 <= met[v] <= 8 for v in (7.0, 250.0, 499.0))
        # every file that has the value is among those counted
        for v in (7.0, 250.0, 499.0):
            assert back.where(F.col(c) == v).select(F.input_file_name()).distinct().count() <= met[v]


def test_stream_input_has_files_by_rows(spark, tmpdir_path):
    rows = spark.range(100)
    assert batch_files(rows, f"{tmpdir_path}/few", 100) == 1
    assert batch_files(rows, f"{tmpdir_path}/many", 100, rows_a_file=10) == 4
    assert batch_files(rows, f"{tmpdir_path}/ranges", 100, by="id", rows_a_file=10) == 4
    for name, files in (("few", 3), ("many", 12), ("ranges", 12)):
        back = spark.read.parquet(f"{tmpdir_path}/{name}")
        assert len(back.inputFiles()) == files and back.exceptAll(rows).count() == 0 and back.count() == 100


def test_lookup_cost_of_overlapping_and_nested_ranges(spark):
    ranges = [("a", 0, 0.0, 10.0), ("a", 1, 5.0, 20.0), ("a", 2, 30.0, 30.0), ("b", 0, 2.0, 1000.0), ("b", 1, 3.0, 4.0), ("c", 0, None, None),
              ("d", 0, 30.0, 31.0), ("d", 1, 31.0, 40.0)]
    groups = spark.createDataFrame([(p, g, 1, "x", lo, hi) for p, g, lo, hi in ranges],
                                   "path string, row_group int, n_rows long, column string, low double, high double")
    wanted = [-1.0, 0.0, 1.5, 3.5, 4.5, 7.0, 10.0, 25.0, 30.0, 31.0, 40.0, 999.0, 1000.0, 1001.0, float("nan")]
    cost = lookup_cost(groups, "x", spark.createDataFrame([(v,) for v in wanted + [7.0, None]], "value double"))
    got = {str(r.value): (r.files, r.row_groups) for r in cost.collect()}
    for v in wanted:
        met = [(p, g) for p, g, lo, hi in ranges if lo is None or lo <= v <= hi]
        assert got[str(v)] == (len({p for p, _ in met}), len(met)), v
    assert len(got) == len(wanted)
    # values are not joined with the row groups: only with one row a cell
    plan = cost._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_summary_of_many_hours_is_not_sorted(spark, tmpdir_path):
    """More hours than Spark's hash aggregate holds by default (128); no mention is sorted for them."""
    hour = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id % 300)")
    posts = spark.range(0, 3000, 1, 2).select(hour.alias("created_at"), F.to_date(hour).alias("date_partition"),
                                              F.concat(F.lit("alpha beta w"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"))
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before, seen, real = spark.conf.get(name), [], KW.staged
    KW.staged = lambda df, as_: (seen.append(spark.conf.get(name)), real(df, as_))[1]
    try:
        out = KW.topics_summary(posts, 64)
    finally:
        KW.staged = real
    assert spark.conf.get(name) == before and int(seen[0]) >= 300
    assert out.count() == 300 and {r.mentions for r in out.collect()} <= set(range(20, 31))
    # the summary is there: it is not computed again, with another threshold
    assert "FileScan parquet" in out._jdf.queryExecution().executedPlan().toString()


class _Lists(_Handle):
    """A handle whose ``keys`` is a list."""
    def getListState(self, *_):
        self.rows = []
        return self

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)
        self.puts = getattr(self, "puts", 0) + 1

    def clear(self):
        self.rows = []


def test_keys_of_a_group_are_judged_as_each_alone():
    rows = [(f"k{i % 5}" if i % 11 else None, None if i % 23 == 0 else (i * 37) % 200, f"{i:03d}") for i in range(230)]
    frame = lambda part: _chunk([m for _, m, _ in part]).assign(alert_key=[k for k, _, _ in part], alert=[a for _, _, a in part])
    want = {a for _, m, a in rows if m is None}
    for key in {k for k, _, _ in rows}:
        last = None
        for m, a in sorted((m, a) for k, m, a in rows if k == key and m is not None):
            if last is None or m - last >= 15:
                last = m
                want.add(a)
    for size in (len(rows), 9):
        h = _Lists()
        s = SuppressKeys(15 * 60 * 1_000_000, 1000)
        s.init(h)
        out = pd.concat(s.handleInputRows((3,), iter([frame(rows[i:i + size]) for i in range(0, len(rows), size)]), h))
        assert sorted(out["alert"]) == [a for _, _, a in rows] and set(out[out["kept"]]["alert"]) == want
        # one write of the state and one timer for all keys
        assert h.puts == 1 and len(h.timers) == 1 and {k for k, _, _ in h.rows} == {k for k, m, _ in rows if m is not None}
        # idle keys stay until the watermark is behind them
        h.now = 5000
        list(s.handleExpiredTimer((3,), h, None))
        assert len(h.rows) == 6 and h.timers[-1] == 6000
        h.now, h.watermark = 7000, int(pd.Timestamp(T).timestamp() * 1000) + 215 * 60 * 1000
        list(s.handleInputRows((3,), iter([frame([("k1", 500, "late")])]), h))
        list(s.handleExpiredTimer((3,), h, None))
        assert [k for k, _, _ in h.rows] == ["k1"] and h.timers[-1] == 8000
