"""Operator 6: benchmark decontamination with a broadcast set of n-grams.

The normalised words of the benchmark items go to every worker in blocks of
about ``BLOCK_BYTES`` of text each, whose n-gram hashes are sorted arrays of a
few times that size; a worker builds them once and keeps at most ``GROUP`` of
them.  One scan of the documents meets a group of at most ``GROUP`` blocks; a
benchmark of up to that size (the usual case) is one scan, and nothing is
shuffled.  A larger one is read once more by block, and takes a scan for each
group; hits of a group are written, its broadcast is dropped before the next,
and at the end documents meet their hits by key.  So driver and workers hold one
group, whatever the benchmark's size.  Every hash hit is verified on the words
themselves.

A window is ``width`` consecutive words of an item; an item of fewer words, but
not none, is one window.  A document word inside any occurrence of a window is
hit.  A document is contaminated if it has hits and at least
``num / den`` of its words are hit.

Cases.  Null or empty text: no words, never contaminated; such items have no
window.  Items of one id (repeated rows) count as one; the items of null id
count as one item named "".  No benchmark rows: nothing is hit.  No documents
give no rows.  Extra columns are ignored, or kept by ``clean``.
"""

from __future__ import annotations

import uuid
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventlens.llm import arrays as A
from eventlens.llm.spans import document_key, keyed, span_lists
from eventlens.llm.spill import written

BLOCK_BYTES = 16 << 20
#: blocks that a scan of the documents meets
GROUP = 2
#: windows built by this worker, by block
_BUILT: dict = {}
RULE = (1, 20)


def _normal(buf, starts, ends, first):
    """Words joined by one space: bytes and the place of each word in them."""
    size = ends - starts + 1
    data = np.append(buf, np.uint8(32))[A.ranges(starts, size)]
    at = np.cumsum(size)
    data[at - 1] = 32
    return data.tobytes(), np.r_[0, at]


class Windows:
    """The windows of a block of items: per length, sorted hashes with item
    number and place in the normalised text."""

    def __init__(self, items, texts, width):
        self.items = items
        buf, off = A.text_buffer(pa.array(texts, pa.string()))
        buf = A.LOWER[buf]
        starts, ends, first = A.find_words(buf, off, A.ALNUM)
        words = A.word_hashes(buf, starts, ends)
        self.text, self.place = _normal(buf, starts, ends, first)
        count = np.diff(first)
        self.by_length = {}
        for n in sorted({min(int(c), width) for c in count if c}):
            own = np.flatnonzero(count >= width) if n == width else np.flatnonzero(count == n)
            windows = count[own] - n + 1
            at = A.ranges(first[own], windows)
            prefix = A.prefix_hash(words, A.WORD_BASE)
            h = A.mix(A.span_hash(prefix, at, at + n, A.WORD_BASE) + A.U(n))
            order = np.argsort(h, kind="stable")
            quick = np.zeros(1 << 20, bool)
            quick[(h & A.U((1 << 20) - 1)).astype(np.int64)] = True
            self.by_length[n] = (h[order], at[order], np.repeat(own, windows)[order], quick)
        self.seen = {}

    def matches(self, n, h, text):
        """Names of the items that have the window ``text`` of ``n`` words."""
        found = self.seen.get(text)
        if found is None:
            hashes, at, item, _ = self.by_length[n]
            lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
            same = [i for a, i in zip(at[lo:hi], item[lo:hi])
                    if self.text[self.place[a]:self.place[a + n] - 1] == text]
            found = self.seen[text] = frozenset(self.items[i] for i in same)
        return found


class _Block:
    """A broadcast block; its windows are built once per worker."""

    def __init__(self, shared, width):
        self.shared, self.width, self.name = shared, width, uuid.uuid4().hex

    def windows(self):
        if self.name not in _BUILT:
            while len(_BUILT) >= GROUP:
                del _BUILT[next(iter(_BUILT))]
            _BUILT[self.name] = Windows(*self.shared.value, self.width)
        return _BUILT[self.name]


def block_groups(benchmark: DataFrame, width: int):
    """The benchmark (item_id, text) in groups of broadcast blocks, one group at
    a time: (number of groups, groups)."""
    sc = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // (BLOCK_BYTES // 2)) or 1  # half full on average
    groups = -(-blocks // GROUP)
    items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    if groups > 1:
        items = items.repartitionByRange(groups, "block").sortWithinPartitions("block")

    def each():
        rows = items.collect() if groups == 1 else items.toLocalIterator()
        group = []
        for _, own in groupby(sorted(rows, key=lambda r: r["block"]) if groups == 1 else rows, lambda r: r["block"]):
            own = list(own)
            group.append(_Block(sc.broadcast(([r["item"] for r in own], [r["text"] for r in own])), width))
            if len(group) == GROUP:
                yield group
                group = []
        if group:
            yield group
    return groups, each()


def scan(texts: pa.Array, blocks, width: int):
    """Per piece of the texts: (first row, last row + 1, words per text, hit
    mask over the words, first word of each text, item names per text)."""
    for i, j, buf, off in A.pieces(texts):
        buf = A.LOWER[buf]
        starts, ends, first = A.find_words(buf, off, A.ALNUM)
        words = A.word_hashes(buf, starts, ends)
        step = np.zeros(len(words) + 1, np.int64)
        names = [set() for _ in range(j - i)]
        normal = None
        for block in blocks:
            w = block.windows()
            for n, (hashes, _, _, quick) in w.by_length.items():
                h, at, _ = A.window_hashes(words, first, n)
                maybe = np.flatnonzero(quick[(h & A.U((1 << 20) - 1)).astype(np.int64)])
                spot = np.minimum(np.searchsorted(hashes, h[maybe]), len(hashes) - 1)
                maybe = maybe[hashes[spot] == h[maybe]]
                if not len(maybe):
                    continue
                if normal is None:
                    normal = _normal(buf, starts, ends, first)
                doc = np.searchsorted(first, at[maybe], "right") - 1
                for x, a, d in zip(h[maybe], at[maybe].tolist(), doc.tolist()):
                    found = w.matches(n, x, normal[0][normal[1][a]:normal[1][a + n] - 1])
                    if found:
                        names[d] |= found
                        step[a] += 1
                        step[a + n] -= 1
        yield i, j, np.diff(first), np.cumsum(step[:-1]) > 0, first, names


HITS = "n_words long, hits array<struct<start: long, end: long>>, items array<string>"
_HITS = pa.schema([("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])


def _spans(hit, first, rows):
    """Hit words as intervals: (document, start, end) and their list array."""
    edge = np.zeros(len(hit) + 1, bool)
    edge[first] = True
    begin = np.flatnonzero(hit & (edge[:-1] | ~np.r_[False, hit[:-1]]))
    stop = np.flatnonzero(hit & (edge[1:] | ~np.r_[hit[1:], False])) + 1
    doc = np.searchsorted(first, begin, "right") - 1
    return span_lists(doc, begin - first[doc], stop - first[doc], rows)


def _find(blocks, width, only_hits):
    def run(batches):
        for batch in batches:
            for i, j, n_words, hit, first, names in scan(A.column(batch, "text"), blocks, width):
                part = batch.slice(i, j - i)
                found = pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(n_words.astype(np.int64)), _spans(hit, first, j - i), pa.array([sorted(x) for x in names], pa.list_(pa.string()))],
                    names=[*part.schema.names, *_HITS.names])
                yield found.filter(pa.array([bool(x) for x in names])).drop_columns(["text"]) if only_hits else found
    return run


def _schema(rows: DataFrame, *names) -> StructType:
    return StructType([*(rows.schema[n] for n in names), *StructType.fromDDL(HITS).fields])


def annotated(docs: DataFrame, benchmark: DataFrame, width: int, keep) -> DataFrame:
    """row (struct of the columns ``keep``), text, n_words, hits, items."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    groups, each = block_groups(benchmark, width)
    if groups == 1:
        blocks = next(each, [])
        rows = rows.select("row", "text")
        return rows.mapInArrow(_find(blocks, width, False), _schema(rows, "row", "text"))
    texts = keyed(rows).select("key", "th", "text").dropDuplicates(["key", "th"])
    found = None
    for blocks in each:
        part = written(texts.mapInArrow(_find(blocks, width, True), f"key long, th int, {HITS}"), "benchmark-hits")
        for block in blocks:
            block.shared.destroy()
        found = part if found is None else found.unionByName(part)
    found = found.groupBy("key", "th").agg(F.flatten(F.collect_list("hits")).alias("hits"),
                                           F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    rows = rows.select("row", "text", *document_key()).join(found, ["key", "th"], "left").select("row", "text", "hits", "items")
    return rows.mapInArrow(_union, _schema(rows, "row", "text"))


def _union(batches):
    """Hits of several groups as disjoint intervals, and the words of a text."""
    for batch in batches:
        hits, items = A.column(batch, "hits"), A.column(batch, "items")
        for i, j, buf, off in A.pieces(A.column(batch, "text")):
            first = A.find_words(A.LOWER[buf], off, A.ALNUM)[2]
            mine = hits.slice(i, j - i)
            row = np.repeat(np.arange(j - i), np.diff(mine.offsets.to_numpy()))
            pair = mine.flatten()
            step = np.zeros(first[-1] + 1, np.int64)
            np.add.at(step, first[row] + pair.field(0).to_numpy(), 1)
            np.add.at(step, first[row] + pair.field(1).to_numpy(), -1)
            part = batch.slice(i, j - i)
            names = [x or [] for x in items.slice(i, j - i).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [A.column(part, "row"), A.column(part, "text"), pa.array(np.diff(first)), _spans(np.cumsum(step[:-1]) > 0, first, j - i),
                 pa.array(names, pa.list_(pa.string()))], names=["row", "text", *_HITS.names])


def _contaminated(rule):
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return (hit > 0) & (hit * rule[1] >= F.col("n_words") * rule[0])


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13, rule=RULE) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_words, hits (word intervals, end
    exclusive), items (names, sorted as strings), contaminated."""
    found = annotated(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, width, ["doc_id"])
    return found.select("row.doc_id", "n_words", "hits", "items", _contaminated(rule).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, width: int = 13, rule=RULE) -> DataFrame:
    """``docs`` without the contaminated documents; all columns stay."""
    return annotated(docs, benchmark, width, docs.columns).where(~_contaminated(rule)).select("row.*")


def without_hits(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """doc_id and text of ``docs``, the hit words cut out; what is left of a
    text with hits is its normalised words, other texts stay as they are."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            ids, texts, hits = (A.column(batch, c) for c in ("doc_id", "text", "hits"))
            out = texts.to_pylist()
            for d, spans in enumerate(hits.to_pylist()):
                if spans:
                    buf, off = A.text_buffer(texts.slice(d, 1))
                    buf = A.LOWER[buf]
                    starts, ends, _ = A.find_words(buf, off, A.ALNUM)
                    left = np.ones(len(starts), bool)
                    for span in spans:
                        left[span["start"]:span["end"]] = False
                    out[d] = b" ".join(buf[a:b].tobytes() for a, b in zip(starts[left], ends[left])).decode()
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.string())], schema=schema)

    found = annotated(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, width, ["doc_id"])
    return found.select("row.doc_id", "text", "hits").mapInArrow(run, "doc_id long, text string")
