"""Mentions of keywords by hour, counted a block of posts at a time.

A task of the posts keeps a block of them as numbers: each distinct text is cut into
words once, whatever its posts, and a post is its hour, its text's number and what is
summed of it.  The block's mentions are added up word by word over all its hours, so
neither texts nor single mentions leave the task, only the sums ("cells") of the block:
one for each word and hour.  Memory is bounded by the constants below, not by a hot
text, hour or word.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from eventlens.functions.text import words

#: a block ends at so many posts, or so many distinct words of its texts together (8 bytes each, some 30 while it is counted)
BLOCK_POSTS, BLOCK_WORDS = 1_000_000, 3_000_000
#: pairs of a post and a word of it that are added up together (some 60 bytes each)
PAIRS = 400_000
#: rows that are given to Spark together
ROWS = 100_000
#: what a post adds to: its sentiment times two, and one more if it has no score
KINDS = 8


def _ordered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``key`` (not negative) sorted, and where each of it was."""
    bits = len(key).bit_length()
    if not len(key) or int(key.max()) >> (63 - bits):
        order = np.argsort(key)
        return key[order], order
    packed = np.sort(key << bits | np.arange(len(key)))
    return packed >> bits, packed & ((1 << bits) - 1)


def _added(key: np.ndarray, values: Iterable[np.ndarray]) -> list[np.ndarray]:
    """The distinct keys in order, and the sum of each of ``values`` for them."""
    key, order = _ordered(key)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return [key[first], *(np.add.reduceat(v[order], first) if len(key) else v for v in values)]


def _numbered(*columns: pa.Array) -> tuple[np.ndarray, list[pa.Array]]:
    """A number for each row's values (null is one), and the values of each number."""
    key = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        d = c.dictionary_encode(null_encoding="encode")
        key = key * max(1, len(d.dictionary)) + d.indices.to_numpy()
    _, first, number = np.unique(key, return_index=True, return_inverse=True)
    return number, [c.take(pa.array(first)) for c in columns]


def _row_numbers(columns: list[pa.Array], table: list[pa.Array]) -> np.ndarray:
    """The row of ``table`` that holds each row's values."""
    values = [pc.unique(t) for t in table]
    d, h = (pc.index_in(c, value_set=v) for c, v in zip(columns, values, strict=True))
    pairs = [pc.index_in(t, value_set=v).to_numpy().astype(np.int64) for t, v in zip(table, values, strict=True)]
    rows, order = _ordered(pairs[0] * len(values[1]) + pairs[1])
    key = d.fill_null(-1).to_numpy().astype(np.int64) * len(values[1]) + h.fill_null(0).to_numpy()
    at = np.minimum(np.searchsorted(rows, key), len(rows) - 1)
    if h.null_count or (rows[at] != key).any():
        raise ValueError("the posts changed while their hours were counted")
    return order[at]


class Block:
    """Posts and their distinct texts as numbers."""

    def __init__(self, min_len: int, stop_words):
        self.find = re.compile(rb"[a-zA-Z]{%d,}" % min_len).findall
        self.stop = {w.encode() for w in stop_words}
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}  # of each word
        self.texts: dict[bytes, int] = {}  # of each text, by a 128-bit hash
        self.ids: list[np.ndarray] = []  # of each text: its distinct words
        self.times: list[np.ndarray] = []  # and how often each is there
        self.posts: list[tuple] = []
        self.n_posts = self.n_words = 0

    def _text(self, text: bytes) -> int:
        at = self.texts.setdefault(hashlib.blake2b(text, digest_size=16).digest(), len(self.texts))
        if at == len(self.ids):
            number = self.number
            said = Counter(b" ".join(self.find(text)).lower().split())
            for w in self.stop & said.keys():
                del said[w]
            self.ids.append(np.fromiter((number.setdefault(w, len(number)) for w in said), np.int32, len(said)))
            self.times.append(np.fromiter(said.values(), np.int32, len(said)))
            self.n_words += len(said)
        return at

    def add(self, batch: pa.RecordBatch) -> None:
        """Posts: date, hour, kind, score, text; those without a text say nothing."""
        texts = batch.column(4).dictionary_encode()
        there = texts.is_valid()
        as_bytes = pa.large_binary() if pa.types.is_large_string(texts.type.value_type) else pa.binary()
        number = np.fromiter((self._text(t.as_py()) for t in texts.dictionary.cast(as_bytes)), np.int32, len(texts.dictionary))
        days, hours, kind, score, text = (c.filter(there) for c in (*batch.columns[:4], texts.indices))
        self.posts.append((days, hours, kind.to_numpy(), score.fill_null(0.0).to_numpy(), number[text.to_numpy()]))
        self.n_posts += len(days)

    def hours(self) -> list[pa.Array]:
        """The date and the hour of each post."""
        return [pa.concat_arrays([p[i] for p in self.posts]) for i in (0, 1)]

    def by_hour(self, hour: np.ndarray):
        """The sums of the block as arrays of ``hour * number of words + word`` and
        mentions; an hour of more than ``PAIRS`` is in several of them."""
        text = np.concatenate([p[4] for p in self.posts])
        order = _ordered(hour)[1]
        size = np.array([len(x) for x in self.ids])
        start, n = (np.cumsum(size) - size)[text[order]], size[text[order]]
        said, times = np.concatenate(self.ids), np.concatenate(self.times).astype(np.int64)
        ends, low = np.cumsum(n), 0
        while low < len(n):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIRS, "right")))
            many = n[low:high]
            pairs = np.repeat(start[low:high] - np.cumsum(many) + many, many) + np.arange(many.sum())
            yield _added(np.repeat(hour[order[low:high]], many) * len(self.number) + said[pairs], [times[pairs]])
            low = high

    def cells(self, hour: np.ndarray, hours: int, parts: int = 1):
        """The words by part and the part of each, then the sums of the block in slabs:
        arrays of ``(word * hours + hour) * KINDS + kind``, mentions and their scores'
        sum, where the words of a slab all come before those of the next.  ``hour``
        is the number of each post's hour, below ``hours``."""
        kind, score, text = (np.concatenate([p[i] for p in self.posts]) for i in (2, 3, 4))
        what = hour * KINDS + kind
        words, width = list(self.number), hours * KINDS
        part, order = _ordered(np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words)))
        yield [words[i] for i in order], part
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        owner = np.repeat(np.arange(len(self.ids)), [len(x) for x in self.ids])
        # the texts' words in the order of the parts, so that a range of words is a slice of each text
        key, order = _ordered(owner * max(1, len(words)) + rank[np.concatenate(self.ids)])
        said = np.concatenate(self.times)[order]
        rank = (key - owner * max(1, len(words))).astype(np.int32)
        del order
        ends = np.cumsum(np.bincount(rank, weights=np.bincount(text, minlength=len(self.ids))[owner], minlength=len(words)))
        del owner
        low = 0
        while low < len(words):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + PAIRS, "right")))
            base = np.arange(len(self.ids)) * len(words)
            start = np.searchsorted(key, base + low)
            n = (np.searchsorted(key, base + high) - start)[text]
            here = np.flatnonzero(n)
            n, at = n[here], start[text[here]]
            pairs = np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())
            yield _added(rank[pairs].astype(np.int64) * width + np.repeat(what[here], n), (said[pairs].astype(np.int64), said[pairs] * np.repeat(score[here], n)))
            low = high


def _blocks(batches: Iterator[pa.RecordBatch], min_len: int, stop_words) -> Iterator[Block]:
    block = Block(min_len, stop_words)
    for batch in batches:
        block.add(batch)
        if block.n_posts >= BLOCK_POSTS or block.n_words >= BLOCK_WORDS:
            yield block
            block.clear()
    if block.n_posts:
        yield block


def _posts(df: DataFrame, kind: Column, score: Column) -> DataFrame:
    return df.select("date_partition", F.date_trunc("hour", "created_at").alias("hour_timestamp"), kind.cast("int").alias("kind"),
                     score.cast("double").alias("score"), F.col("text").cast("string").alias("text"))


def sketch(words: list[bytes], counts: np.ndarray, off: int, mentions: int, most: int) -> bytes:
    """What ``approx_top_k_accumulate`` stores: a DataSketches sketch of frequent items
    with a table of ``most`` places, and the number of nulls, none.  ``off`` was taken
    from each count; words come with their lengths before them (:func:`with_length`)."""
    size = 8
    while size * 0.75 < len(words):
        size *= 2
    head = struct.pack("<BBBBBxxxIxxxxqq", 4, 1, 10, most.bit_length() - 1, size.bit_length() - 1, len(words), mentions, off)
    return head + counts.astype("<i8").tobytes() + b"".join(words) + bytes(8)


def with_length(word: bytes) -> bytes:
    return struct.pack("<i", len(word)) + word


def _sketches(min_len: int, stop_words, most: int, names: list[str]):
    """Posts -> a sketch for each block and hour.  Of an hour with more words than three
    quarters of the table, the count of the first that does not fit is taken from each."""
    def run(batches):
        fits = most * 3 // 4
        for block in _blocks(batches, min_len, stop_words):
            hour, groups = _numbered(*block.hours())
            words = [with_length(w) for w in block.number]
            for key, n in block.by_hour(hour):
                of, word = np.divmod(key, max(1, len(words)))
                cuts = [*np.flatnonzero(np.diff(of, prepend=-1)), len(of)]
                totals, sketches = [], []
                for a, b in zip(cuts, cuts[1:]):
                    counts, said, off = n[a:b], word[a:b], 0
                    totals.append(int(counts.sum()))
                    if b - a > fits:
                        off = int(np.partition(counts, b - a - fits - 1)[b - a - fits - 1])
                        said, counts = said[counts > off], counts[counts > off] - off
                    sketches.append(sketch([words[i] for i in said], counts, off, totals[-1], most))
                columns = [*(g.take(pa.array(of[cuts[:-1]])) for g in groups), pa.array(totals, pa.int64()), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def hour_sketches(df: DataFrame, items: int, min_len: int, stop_words) -> DataFrame:
    """Rows (date, hour, mentions, sketch), any number for an hour, that
    ``approx_top_k_combine`` merges.  Mentions are added up where the posts are, so a
    sketch is given a word's count at once.  A Spark that stores its sketches otherwise
    updates them itself, by one mention at a time."""
    one, most = f"approx_top_k_accumulate(keyword, {int(items)})", 8
    while most * 0.75 < items:
        most *= 2
    like = df.sparkSession.range(1).select(F.lit("word").alias("keyword")).agg(F.expr(one).alias("s")).first()["s"]
    if bytes(like["sketch"]) != sketch([with_length(b"word")], np.array([1]), 0, 1, most):
        said = df.select("date_partition", F.date_trunc("hour", "created_at").alias("hour_timestamp"), F.explode(words("text", min_len)).alias("keyword"))
        return (said.where(~F.col("keyword").isin(*stop_words)).groupBy("date_partition", "hour_timestamp")
                .agg(F.count("*").alias("mentions"), F.expr(one).alias("sketch")))
    posts = _posts(df, F.lit(0), F.lit(0.0))
    schema = StructType([*posts.schema.fields[:2], StructField("mentions", LongType()), StructField("sketch", BinaryType())])
    stored = [F.lit(like[c]).cast(t).alias(c) for c, t in (("maxItemsTracked", "int"), ("itemDataType", "string"), ("itemDataTypeDDL", "string"))]
    rows = posts.mapInArrow(_sketches(min_len, sorted(set(stop_words)), most, schema.names), schema)
    return rows.withColumn("sketch", F.struct("sketch", *stored))


#: a row for each block and part of its words
PACKED = "part int, n_words int, n_cells int, words_size long, words binary, sums binary"


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers byte by byte: the high bytes are mostly zeros."""
    return values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(data: memoryview) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8")[:, 0]


def _pack(min_len: int, stop_words, hours: pa.Table, parts: np.ndarray):
    """Posts -> the sums of each block, compressed, by part of its words."""
    def run(batches):
        groups = [c.combine_chunks() for c in hours.columns]
        width = len(groups[0]) * KINDS
        for block in _blocks(batches, min_len, stop_words):
            slabs = block.cells(_row_numbers(block.hours(), groups), len(groups[0]), len(parts))
            words, part = next(slabs)
            for key, n, score in slabs:
                of = part[key // width]
                cuts = [*np.flatnonzero(np.diff(of, prepend=-1)), len(of)]
                rows = []
                for a, b in zip(cuts, cuts[1:]):
                    low, high = int(key[a] // width), int(key[b - 1] // width) + 1
                    said = b"\n".join(words[low:high])
                    sums = _planes(np.diff(key[a:b], prepend=low * width)) + _planes(n[a:b]) + score[a:b].astype("<f8").tobytes()
                    rows.append({"part": int(parts[of[a]]), "n_words": high - low, "n_cells": int(b - a), "words_size": len(said),
                                 "words": pa.compress(said, "zstd", asbytes=True), "sums": pa.compress(sums, "zstd", asbytes=True)})
                types = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(rows[0], types))))
    return run


def _unpack(hours: pa.Table, names: list[str]):
    """The sums of all blocks -> a row for each word and hour of the part."""
    def run(batches):
        groups = [c.combine_chunks() for c in hours.columns]
        width = len(groups[0]) * KINDS
        number: dict[bytes, int] = {}
        found, size, most = [], 0, PAIRS

        def add(parts):  # one column after the other is put together
            columns = [*zip(*parts, strict=True)][::-1]
            parts.clear()
            return _added(np.concatenate(columns.pop()), (np.concatenate(columns.pop()) for _ in range(2)))

        for batch in batches:
            for row in batch.to_pylist():
                m = row["n_cells"]
                said = pa.decompress(row["words"], row["words_size"], "zstd", asbytes=True).split(b"\n")
                ids = np.fromiter((number.setdefault(w, len(number)) for w in said), np.int64, row["n_words"])
                sums = memoryview(pa.decompress(row["sums"], 24 * m, "zstd", asbytes=True))
                word, rest = np.divmod(np.cumsum(_from_planes(sums[:8 * m])), width)
                found.append((ids[word] * width + rest, _from_planes(sums[8 * m:16 * m]), np.frombuffer(sums[16 * m:], "<f8")))
                size += m
                if size > most:
                    found = [add(found)]
                    size = len(found[0][0])
                    most = size + max(PAIRS, size // 2)
        if not found:
            return
        key, n, score = add(found)
        words = pa.array(list(number), pa.binary()).cast(pa.string())
        low = 0
        while low < len(key):
            high = min(low + ROWS, len(key))
            high += int(np.searchsorted(key[high:high + KINDS], (key[high - 1] // KINDS + 1) * KINDS))  # to the end of a word and hour
            cell, kind = np.divmod(key[low:high], KINDS)
            first = np.flatnonzero(np.diff(cell, prepend=-1))
            total = lambda which: np.add.reduceat(np.where(which, n[low:high], 0), first)  # noqa: B023, E731
            counts = [np.add.reduceat(n[low:high], first), *(total(kind // 2 == k) for k in range(3))]
            scored = total(kind % 2 == 0)
            mean = np.add.reduceat(score[low:high], first) / np.maximum(scored, 1)
            word, hour = np.divmod(cell[first], len(groups[0]))
            columns = [*(g.take(pa.array(hour)) for g in groups), words.take(pa.array(word)), *map(pa.array, counts), pa.array(mean, mask=scored == 0)]
            yield pa.RecordBatch.from_arrays(columns, names)
            low = high
    return run


def part_keys(df: DataFrame, parts: int) -> np.ndarray:
    """``parts`` ints of which ``repartition(parts, key)`` sends one to each partition."""
    ids = df.sparkSession.range(parts * (parts.bit_length() + 12)).select(F.col("id").cast("int").alias("k"))
    rows = ids.groupBy(F.pmod(F.hash("k"), F.lit(parts)).alias("p")).agg(F.min("k").alias("k")).collect()
    keys = [r["k"] for r in sorted(rows, key=lambda r: r["p"])]
    return np.array(keys + [-1 - i for i in range(parts - len(keys))], np.int32)


def hourly_mentions(df: DataFrame, sentiments, score: Column, min_len: int, stop_words, posts_a_task: int) -> DataFrame:
    """Rows (date, hour, keyword, mentions, those of each of the three ``sentiments``,
    mean ``score``).  The sums of the blocks meet by keyword, in as many tasks as there
    are ``posts_a_task``: an hour or a word is no task's, and a task's rows do not grow
    with the table."""
    kind = F.lit(6)
    for i, s in enumerate(sentiments):
        kind = F.when(F.col("predicted_sentiment") == s, F.lit(2 * i)).otherwise(kind)
    posts = _posts(df, kind + score.isNull().cast("int"), score)
    # one row for each hour there is
    hours = df.groupBy("date_partition", F.date_trunc("hour", "created_at").alias("hour_timestamp")).agg(F.count("*").alias("n")).toArrow()
    tasks = max((pc.sum(hours["n"]).as_py() or 0) // posts_a_task + 1, df.sparkSession.sparkContext.defaultParallelism)
    hours = hours.drop_columns("n")
    names = ["mention_count", *(f"{s}_mentions" for s in sentiments)]
    schema = StructType([*posts.schema.fields[:2], StructField("keyword", StringType()), *(StructField(c, LongType()) for c in names),
                         StructField("avg_sentiment_score", DoubleType())])
    packed = posts.mapInArrow(_pack(min_len, sorted(set(stop_words)), hours, part_keys(df, tasks)), PACKED)
    return packed.repartition(tasks, "part").mapInArrow(_unpack(hours, schema.names), schema)
