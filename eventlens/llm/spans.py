"""Shared by the two span removers: document keys, and joining removal spans
back to their texts.

A document is the key (``key``, ``th``): its doc_id (null counts as the
smallest long) and 32 bits of its text's hash, which tells rows apart that
share a doc_id.  Rows equal in both are one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import arrays as A

NO_ID = -(1 << 63)
SPAN_ROW = "key long, th int, spans binary"


def document_key():
    """The columns key and th of a document (doc_id long, text)."""
    return (F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("key"),
            F.shiftright(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), 32).cast("int").alias("th"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, key, th."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return docs.select("doc_id", "text", *document_key())


class SpanRows:
    """Gathers (key, th, start, length) arrays and gives one row per document,
    its spans packed as int32 pairs."""

    SCHEMA = pa.schema([("key", pa.int64()), ("th", pa.int32()), ("spans", pa.binary())])

    def __init__(self, limit: int = 2_000_000):
        self.parts, self.n, self.limit = [], 0, limit

    def add(self, key, th, start, length):
        if len(key):
            self.parts.append((key, th, start.astype(np.int32), length.astype(np.int32)))
            self.n += len(key)

    def full(self):
        return self.n >= self.limit

    def batch(self):
        key, th, start, length = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.n = [], 0
        order = np.lexsort((start, th, key))
        key, th = key[order], th[order]
        pairs = np.stack([start[order], length[order]], 1)
        at = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (th[1:] != th[:-1])])
        raw = pairs.tobytes()
        cut = np.r_[at, len(key)] * 8
        blobs = pa.array([raw[a:b] for a, b in zip(cut[:-1], cut[1:])], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(th[at]), blobs], schema=self.SCHEMA)


SPAN_BLOCK = "bucket int, key binary, th binary, start binary, length binary"
_BLOCK_SCHEMA = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("key", "th", "start", "length")])


def merged(key, th, start, length):
    """Union of the spans of each document, by (key, th, start); touching spans
    merge."""
    order = np.lexsort((start, th, key))
    key, th, start, length = key[order], th[order], start[order].astype(np.int64), length[order].astype(np.int64)
    at = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (th[1:] != th[:-1])][:len(key)])
    doc = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(key)])) << 32  # documents never touch
    a, b = A.covered(doc + start, doc + start + length)
    return key[at][a >> 32], th[at][a >> 32], (a & 0xFFFFFFFF).astype(np.int32), (b - a).astype(np.int32)


class SpanBlocks(SpanRows):
    """Gathers spans like :class:`SpanRows`, and gives one row for each bucket of
    documents: a document's spans come from many tasks, few from each, so rows by
    document would be nearly as many as spans."""

    def __init__(self, names, limit: int = 2_000_000):
        super().__init__(limit)
        self.names = names

    def batch(self):
        key, th, start, length = merged(*(np.concatenate(c) for c in zip(*self.parts)))
        self.parts, self.n = [], 0
        bucket = A.mix(key.view(np.uint64) ^ A.mix(th.astype(np.uint64))) % A.U(len(self.names))
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(len(self.names) + 1).astype(np.uint64))
        rows = []
        for k in np.flatnonzero(np.diff(cut)):
            sel = order[cut[k]:cut[k + 1]]
            rows.append((int(self.names[k]), *(A.planes(A.deltas(c[sel])) for c in (key, th, start, length))))
        return A.batch_of(_BLOCK_SCHEMA, list(zip(*rows)))


def _by_document(batches):
    """Span blocks by bucket -> one row for each document."""
    out, group, bucket = SpanRows(), [], None

    def close():
        kinds = (np.int64, np.int32, np.int32, np.int32)
        columns = [[np.cumsum(A.unplanes(row[c], t), dtype=t) for c, t in zip(("key", "th", "start", "length"), kinds)] for row in group]
        out.add(*merged(*(np.concatenate(c) for c in zip(*columns))))

    for batch in batches:
        for row in batch.to_pylist():
            if group and row["bucket"] != bucket:
                close()
                group = []
                yield out.batch()
            bucket = row["bucket"]
            group.append(row)
    if group:
        close()
        yield out.batch()


def by_document(blocks: DataFrame, parts: int) -> DataFrame:
    """Span blocks -> (key, th, spans), one row for each document."""
    return blocks.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_by_document, SPAN_ROW)


def unpack(blobs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of packed pairs, one list per row -> (row, start, length)."""
    joined = [b"".join(b) if b else b"" for b in blobs]
    counts = np.array([len(b) // 8 for b in joined], np.int64)
    pairs = np.frombuffer(b"".join(joined), np.int32).reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(joined)), counts), pairs[:, 0], pairs[:, 1]


def with_spans(docs: DataFrame, spans: DataFrame, how: str = "left") -> DataFrame:
    """``keyed`` documents with the list of their packed spans."""
    per_doc = spans.groupBy("key", "th").agg(F.collect_list("spans").alias("spans"))
    return docs.join(per_doc, ["key", "th"], how)


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string array over UTF-8 bytes and n + 1 offsets."""
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1,
                                 [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def span_lists(row: np.ndarray, start: np.ndarray, end: np.ndarray, n: int) -> pa.Array:
    """list<struct<start, end>> of n rows; ``row`` ascends."""
    off = np.r_[0, np.cumsum(np.bincount(row, minlength=n))].astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(start.astype(np.int64)), pa.array(end.astype(np.int64))], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(off), pairs)
