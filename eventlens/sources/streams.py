"""Stream and file sources.

Topic reads use the Kafka source when its package is on the classpath; the
same envelope (``key, value, timestamp``) can be read from a folder of JSON
files, which is what the tests use.  Offsets live in the query checkpoint,
so a restarted query resumes where it stopped (the consumer-group role).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

ENVELOPE_SCHEMA = StructType([StructField("key", StringType(), True),
                              StructField("value", StringType(), True),
                              StructField("timestamp", TimestampType(), True)])


#: rows of a file that rows to be streamed are dealt into
ROWS_A_FILE = 500_000


def batch_files(rows: DataFrame, path: str, n_rows: int, batches: int = 3, by=None, rows_a_file: int | None = None) -> int:
    """Write ``rows`` as files for ``batches`` micro-batches of a file stream and
    return the files of one (``maxFilesPerTrigger``).  There are as many files as
    ``n_rows`` (at least the rows there are) need, so neither the task that writes
    a file nor one that reads it grows with the table.  Rows are dealt evenly, or
    by ranges of the column ``by``."""
    files = max(1, -(-n_rows // (batches * (rows_a_file or ROWS_A_FILE))))
    dealt = rows.repartitionByRange(batches * files, by) if by else rows.repartition(batches * files)
    dealt.write.parquet(path)
    return files


def read_topic(spark: SparkSession, topic: str, bootstrap: str | None = None, path: str | None = None,
               starting_offsets: str = "latest", fail_on_data_loss: bool = True,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """A topic as a streaming DataFrame with the broker envelope.

    With ``bootstrap`` the Kafka source is used (``startingOffsets``,
    ``failOnDataLoss`` as the reference sets them); with ``path`` the
    envelope is read from JSON files in ``path`` (one folder per topic).
    """
    if bootstrap:
        return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
                .option("subscribe", topic).option("startingOffsets", starting_offsets)
                .option("failOnDataLoss", str(fail_on_data_loss).lower()).load())
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(f"{path.rstrip('/')}/{topic}")


def read_prices_csv(spark: SparkSession, glob: str) -> DataFrame:
    """Historical trade CSVs with a header; an explicit schema instead of
    inference (a blank first line is skipped by the reader)."""
    schema = "trade_id int, coin_name string, price_usd double, trade_timestamp int"
    return spark.read.csv(glob, header=True, schema=schema)


def read_videos_csv(spark: SparkSession, path: str) -> DataFrame:
    """The trending-video CSV (quoted multi-line descriptions)."""
    schema = ("video_id string, trending_date string, title string, channel_title string, category_id int, "
              "publish_time string, tags string, views long, likes long, dislikes long, comment_count long, "
              "thumbnail_link string, comments_disabled boolean, ratings_disabled boolean, "
              "video_error_or_removed boolean, description string")
    return spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"')


def read_incidents_json(spark: SparkSession, path: str, newest: int | None = None,
                        order_col: str = "fecha") -> DataFrame:
    """Incident records; ``newest`` keeps a page of the latest records by
    date (a top-k; the whole record breaks ties)."""
    df = spark.read.json(path)
    if newest:
        df = df.orderBy(F.desc(order_col), F.to_json(F.struct(*df.columns))).limit(newest)
    return df


def read_log_files(spark: SparkSession, directory: str, log_type: str, source: str,
                   streaming: bool = True) -> DataFrame:
    """Tail text log files; the static fields sit at the row root.
    ``file`` and, in batch, ``line_no`` (an order key that increases along a
    file: splits of a file are read in offset order) are kept for multi-line
    folding."""
    reader = spark.readStream if streaming else spark.read
    df = reader.text(directory)
    out = df.select(F.col("value").alias("message"), F.input_file_name().alias("file"),
                    F.lit(log_type).alias("log_type"), F.lit(source).alias("source"))
    if not streaming:
        out = out.withColumn("line_no", F.monotonically_increasing_id())
    return out


def decode_json(df: DataFrame, schema: StructType, col: str = "message",
                error_col: str = "_json_error") -> DataFrame:
    """Decode a JSON text column into root columns; rows that do not
    parse, are no object, or have a field of the wrong type keep their text
    in ``error_col`` (the reader's corrupt-record column)."""
    with_error = StructType([*schema.fields, StructField(error_col, StringType(), True)])
    parsed = F.from_json(F.col(col), with_error, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": error_col})
    out = df.withColumn("_p", parsed)
    not_object = F.col(col).isNotNull() & ~F.col(col).rlike(r"^\s*\{")
    return out.select("*", *[F.col(f"_p.{f.name}").alias(f.name) for f in schema.fields],
                      F.when(not_object, F.col(col)).otherwise(F.col(f"_p.{error_col}")).alias(error_col)).drop("_p")


# --------------------------------------------------------------------------- multi-line folding

# Fixed value: an event starts with an IPv4 address (the shipper's multiline pattern).
IPV4_START = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"


def running(df: DataFrame, key_cols, order_col: str, values: dict, chunk_rows: int = 1_000_000) -> DataFrame:
    """Per key and in ``order_col`` order, running figures: ``values`` maps a
    new column to (aggregate function, column expression), e.g. a running sum.

    A window over a whole key would put a huge file in one task, so the key
    is cut into chunks of ``chunk_rows`` positions: a window runs per
    (key, chunk), chunk totals (one row per chunk) are carried forward, and
    the carry is joined back.
    """
    keys = list(key_cols)
    d = df.withColumn("_chunk", F.floor(F.col(order_col) / F.lit(chunk_rows)))
    w = Window.partitionBy(*keys, "_chunk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    wc = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy(*keys, "_chunk").agg(*[fn(expr).alias(f"_tot_{c}") for c, (fn, expr) in values.items()])
    totals = totals.select(*keys, "_chunk", *[fn(f"_tot_{c}").over(wc).alias(f"_off_{c}") for c, (fn, _) in values.items()])
    d = d.withColumns({f"_in_{c}": fn(expr).over(w) for c, (fn, expr) in values.items()})
    d = d.join(totals, on=[*keys, "_chunk"], how="left")
    both = {c: (F.coalesce(F.col(f"_off_{c}"), F.lit(0)) + F.col(f"_in_{c}")) if fn is F.sum
            else fn_of_two(fn)(F.col(f"_off_{c}"), F.col(f"_in_{c}")) for c, (fn, _) in values.items()}
    return d.withColumns(both).drop("_chunk", *[f"_{k}_{c}" for k in ("in", "off") for c in values])


def fn_of_two(fn):
    """The two-value form of ``max`` or ``min`` (nulls are skipped)."""
    return {F.max: F.greatest, F.min: F.least}[fn]


def fold_multiline(lines: DataFrame, start_pattern: str = IPV4_START, file_col: str = "file_id",
                   line_col: str = "line_no", text_col: str = "line", max_lines: int = 10_000) -> DataFrame:
    """Join lines that do not start an event (``start_pattern``) to the
    previous event of the same file; lines before a file's first start form
    event 0.  Only the order of ``line_col`` matters (it need not be dense).
    Returns one row per event: file, event number, first line, line count,
    text joined with newlines.

    An event whose lines span more than ``max_lines`` positions comes in
    several rows, numbered by ``part`` from 0: no line is lost, and a file that
    never starts an event does not become one row."""
    start = F.coalesce(F.col(text_col).rlike(start_pattern), F.lit(False))
    g = running(lines, [file_col], line_col, {
        "event_no": (F.sum, start.cast("long")), "_from": (F.max, F.when(start, F.col(line_col)))})
    g = g.withColumn("part", F.floor((F.col(line_col) - F.coalesce(F.col("_from"), F.lit(1))) / max_lines).cast("long"))
    return g.groupBy(file_col, "event_no", "part").agg(
        F.min(line_col).alias("first_line"), F.count("*").alias("n_lines"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(line_col), F.col(text_col)))),
                                 lambda x: x[text_col]), "\n").alias("text")
    ).select(file_col, "event_no", "first_line", "n_lines", "text", "part")
