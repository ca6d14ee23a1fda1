"""S08 in a stream against the batch fold."""

from pyspark.sql import functions as F

from eventlens.sources.streams import fold_multiline
from eventlens.streaming.folding import fold_batch, fold_stream, folded_events

SCHEMA = "file_id string, line_no long, line string"
LINES = [(f, n, "1.2.3.4 start" if (n * 7 + len(f)) % 5 == 0 and n > 3 else None if n % 11 == 0 else f"  line {n}")
         for f in ("a", "bb", "ccc") for n in range(1, 60)] + [("never", n, f"l{n}") for n in range(1, 45)] + [("one", 3, "9.9.9.9 only")]


def rows(df):
    return sorted((r.file_id, r.event_no, r.part, r.first_line, r.n_lines, r.text) for r in df.collect())


def run(spark, base, batches, clock=None, **kw):
    for k, lines in enumerate(batches):
        spark.createDataFrame(lines, SCHEMA).repartition(3).write.mode("append").parquet(f"{base}/in")
        src = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
        fold_stream(src, f"{base}/out", f"{base}/open", f"{base}/ckpt", available_now=True, clock=clock or (lambda: 0.0), **kw).awaitTermination()
    return folded_events(spark, f"{base}/out", f"{base}/open")


def test_batches_that_cut_events_equal_the_batch_fold(spark, tmpdir_path):
    cuts = [[x for x in LINES if lo < x[1] <= hi] for lo, hi in ((0, 17), (17, 18), (18, 41), (41, 99))]
    got = run(spark, tmpdir_path, cuts, max_lines=10)
    whole = fold_multiline(spark.createDataFrame(LINES, SCHEMA), max_lines=10)
    assert rows(got) == rows(whole)
    # open events are one row a file, whatever they hold
    import os
    versions = sorted(int(d.split("=")[1]) for d in os.listdir(f"{tmpdir_path}/open") if d.startswith("batch="))
    assert len(versions) == 2 and spark.read.parquet(f"{tmpdir_path}/open/batch={versions[-1]}").count() == 5


def test_replayed_batch_replaces_itself(spark):
    df = spark.createDataFrame([x for x in LINES if x[1] <= 20], SCHEMA)
    more = spark.createDataFrame([x for x in LINES if x[1] > 20], SCHEMA)
    args = ("^\\d+\\.", "file_id", "line_no", "line", 10)
    known = fold_batch(df, None, *args)
    held = known.where("is_open").drop("is_open").withColumn("seen", F.lit(0.0))
    once, twice = (rows(fold_batch(more, held, *args).unionByName(known.where("not is_open"))) for _ in range(2))
    assert once == twice == rows(fold_multiline(spark.createDataFrame(LINES, SCHEMA), "^\\d+\\.", max_lines=10))


def test_open_event_goes_out_after_its_timeout(spark, tmpdir_path):
    now = [0.0]
    batches = [[("a", 1, "1.1.1.1 x"), ("a", 2, "  y"), ("b", 1, "2.2.2.2 x")], [("b", 2, "  z")], [("b", 3, "3.3.3.3 n")], [("a", 3, "  late")]]
    seen = []
    for k, b in enumerate(batches):
        now[0] = 4.0 * k
        run(spark, tmpdir_path, [b], clock=lambda: now[0], timeout_seconds=5)
        out = spark.read.schema("file_id string, text string").parquet(f"{tmpdir_path}/out")
        seen.append(sorted((r.file_id, r.text) for r in out.collect()))
    assert seen[1] == [] and ("a", "1.1.1.1 x\n  y") in seen[2] and ("b", "2.2.2.2 x\n  z") in seen[2]
    every = rows(folded_events(spark, f"{tmpdir_path}/out", f"{tmpdir_path}/open"))
    assert [r[5] for r in every if r[0] == "a"] == ["1.1.1.1 x\n  y", "  late"] and {r[1] for r in every if r[0] == "a"} == {1}
