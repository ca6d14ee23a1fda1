"""Raw text lines to enriched events: S07 lines -> S08 folding -> F04 / S09
by log type -> U02 -> R07.

Works on a batch of lines (with an order key per file) and, without folding,
on a stream of whole events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlens.functions.security import ACCESS_LOG_FIELDS, parse_access_log
from eventlens.operators.security_rules import DROPPED_FIELDS, drop_fields, enrich_logs, fill_defaults, union_log_types
from eventlens.sources.streams import IPV4_START, decode_json, fold_multiline


def parse_web(events: DataFrame, col: str = "message") -> DataFrame:
    """Access-log events (F04): the captured fields at the row root, ``src_ip``
    as the other types name it; a line that does not match keeps its text and
    gets ``_parsefailure``."""
    p = events.withColumn("_p", parse_access_log(col))
    fields = [F.col(f"_p.{f}").alias(f) for f in (*ACCESS_LOG_FIELDS, "_parsefailure")]
    return p.select(*[c for c in events.columns if c not in ACCESS_LOG_FIELDS], *fields).withColumn("src_ip", F.col("source_ip"))


def raw_log_events(lines: DataFrame, schemas: dict[str, StructType], fold: bool = True,
                   file_col: str = "file_id", line_col: str = "line_no", max_lines: int = 10_000) -> DataFrame:
    """``lines`` (log_type, file, order key, message) -> enriched events of
    all types in one table.  Web lines are access-log text, folded when
    ``fold``; the types in ``schemas`` are JSON, one event a line.

    A folded event is parsed from its first ``max_lines`` line positions.  The
    rest of a longer one follows as continuation rows: ``part`` from 1, the
    event's file and ``event_no``, the text, and nothing else, so an event of any
    length is one event (the rows with ``part = 0``)."""
    web = lines.where(F.col("log_type") == "web")
    if not fold:
        frames, rest = [parse_web(web)], None
    else:
        folded = (fold_multiline(web, IPV4_START, file_col, line_col, "message", max_lines)
                  .select(F.lit("web").alias("log_type"), F.col(file_col), "event_no", "part", F.col("first_line").alias(line_col),
                          F.col("text").alias("message")))
        frames, rest = [parse_web(folded.where("part = 0"))], folded.where("part > 0")
    for log_type, schema in schemas.items():
        frames.append(decode_json(lines.where(F.col("log_type") == log_type), schema))
    events = enrich_logs(fill_defaults(union_log_types(*frames), {"part": F.lit(0).cast("long")}), drop_raw=False)
    if rest is not None:
        events = events.unionByName(rest, allowMissingColumns=True)
    return drop_fields(events, [f for f in DROPPED_FIELDS if f != "message"])
