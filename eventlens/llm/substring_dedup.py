"""Operator 2: removal of repeated passages by Rabin-Karp token windows.

Every window of ``width`` consecutive words gets a 64-bit Rabin-Karp hash
(a difference of word-level prefix hashes).  Windows are dealt to buckets by
their smallest three-word hash, so runs of neighbouring windows travel
together: a block of a bucket is the hashes plus run-length coded places.
Each bucket then counts its windows: all places of a window but the first
(smallest document, earliest start) are repeats, and the repeats of a document
merge into maximal removal intervals over its words.

A task drops the windows it has itself seen before shipping them, so a passage
that a third of all documents share reaches its bucket once per task flush.
Minimizers that hold a large share of all windows so thinned (a phrase shorter
than ``width`` that many documents have has other text beside it each time) are
found in a first pass over all texts; their windows are dealt singly, by their
own hash, so no bucket gathers a hot minimizer.  At most ``4 * buckets``
minimizers can hold that share, which bounds the broadcast set.
Two different windows share a hash with chance n**2 / 2**65 over n windows:
5e-4 at 1.4e8 words.  ``check_bytes`` adds up to 8 bytes of a second hash.

Cases.  Null or empty text: no words, no spans.  A text of fewer words than
``width``: nothing removed.  Rows with equal doc_id and text count as one
document, and each is returned; rows of one doc_id with different texts are
ordered by a hash of the text; a null doc_id sorts first.  No rows give no
rows.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import arrays as A
from eventlens.llm.spans import SPAN_ROW, SpanRows, keyed, span_lists, strings, unpack, with_spans
from eventlens.llm.spill import bucket_keys, shuffle_parts, written

#: windows that a map task holds before it ships them
FLUSH = 1 << 20
SEED_WORDS = 3
BLOCK = "bucket int, hashes binary, checks binary, key binary, th binary, pos binary, n binary"


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values (len(v) - w + 1 of them)."""
    have = 1
    while have * 2 <= w:
        v = np.minimum(v[:len(v) - have], v[have:])
        have *= 2
    return np.minimum(v[:len(v) - (w - have)], v[w - have:]) if have < w else v


def _minimizers(words, at, width):
    """Smallest three-word hash of the windows that start at words ``at``."""
    seed = min(SEED_WORDS, width)
    prefix = A.prefix_hash(words, A.WORD_BASE)
    i = np.arange(len(words) - seed + 1)
    grams = A.mix(A.span_hash(prefix, i, i + seed, A.WORD_BASE))
    low = _sliding_min(grams, width - seed + 1)
    return A.mix(low)[at]


def _runs(key, th, pos):
    """Starts of runs of consecutive windows of one document."""
    return np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (th[1:] != th[:-1]) | (pos[1:] != pos[:-1] + 1)])


def _hot(width: int, share: int):
    """Minimizers with over 1 / share of the different windows of a flush."""
    schema = pa.schema([("low", pa.int64()), ("n", pa.int64()), ("total", pa.int64())])

    def report(held):
        h, low = (np.concatenate(c) for c in zip(*held))
        low = low[np.unique(h, return_index=True)[1]]
        values, n = np.unique(low, return_counts=True)
        top = n > max(16, len(low) // share)
        return A.batch_of(schema, (np.r_[values[top].view(np.int64), np.int64(0)], np.r_[n[top], 0],
                                   np.r_[np.zeros(top.sum(), np.int64), len(low)]))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                starts, ends, first = A.find_words(buf, off, A.SPACED)
                words = A.word_hashes(buf, starts, ends)
                h, at, _ = A.window_hashes(words, first, width)
                if not len(h):
                    continue
                held.append((h, _minimizers(words, at, width)))
                n += len(h)
                if n >= FLUSH:
                    yield report(held)
                    held, n = [], 0
        if held:
            yield report(held)
    return run


def hot_minimizers(docs: DataFrame, width: int, buckets: int) -> np.ndarray:
    """Minimizers with over 1 / (4 * buckets) of all windows that are shipped
    with their hash (at most 4 * buckets of them)."""
    seen = docs.select("text").mapInArrow(_hot(width, 8 * buckets), "low long, n long, total long")
    seen = written(seen.groupBy("low").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "minimizers")
    total = seen.agg(F.sum("total")).first()[0] or 0
    top = seen.where(F.col("n") > max(64, total // (4 * buckets))).select("low").collect()
    return np.array(sorted(r[0] for r in top), np.int64).view(np.uint64)


def _ship(width: int, names: np.ndarray, check_bytes: int, hot):
    """``names``: the number that each bucket goes by."""
    buckets = len(names)
    schema = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("hashes", "checks", "key", "th", "pos", "n")])
    small = np.uint16 if buckets <= 1 << 16 else np.uint32

    def flush(held, turn):
        h, extra, bucket, key, th, pos = (np.concatenate(c) for c in zip(*held))
        after = (key[1:] > key[:-1]) | ((key[1:] == key[:-1]) & (
            (th[1:] > th[:-1]) | ((th[1:] == th[:-1]) & (pos[1:] > pos[:-1]))))
        if not after.all():
            order = np.lexsort((pos, th, key))
            # a repeated row has its copy's places: they are one place, not repeats of each other
            k, t, p = key[order], th[order], pos[order]
            order = order[np.r_[True, (k[1:] != k[:-1]) | (t[1:] != t[:-1]) | (p[1:] != p[:-1])]]
            h, extra, bucket, key, th, pos = (a[order] for a in (h, extra, bucket, key, th, pos))
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        again = np.zeros(len(h), bool)
        again[order[1:][same]] = True
        rows = []

        def block(to, sel, with_hash):
            k, t, p = key[sel], th[sel], pos[sel]
            at = _runs(k, t, p)
            n = np.diff(np.r_[at, len(p)]).astype(np.int32)
            raw = h[sel].tobytes() if with_hash else b""
            more = A.planes(extra[sel])[:check_bytes * len(p)] if with_hash and check_bytes else b""
            rows.append((int(names[to]), raw, more, A.planes(A.deltas(k[at])), A.planes(A.deltas(t[at])),
                         A.planes(A.deltas(p[at])), A.planes(n)))

        if again.any():
            block(turn % buckets, np.flatnonzero(again), False)  # known repeats: places only
        first = np.flatnonzero(~again)
        first = first[np.argsort(bucket[first].astype(small), kind="stable")]
        b = bucket[first]
        cut = np.r_[0, np.flatnonzero(b[1:] != b[:-1]) + 1, len(b)]
        for s, e in zip(cut[:-1], cut[1:]):
            if e > s:
                block(int(b[s]), first[s:e], True)
        return A.batch_of(schema, list(zip(*rows)))

    def run(batches):
        singles = hot.value
        # known repeats go round the buckets, from another one in each task
        held, n, turn = [], 0, int(A.mix(np.array([TaskContext.get().partitionId()], np.uint64))[0] % A.U(buckets))
        for batch in batches:
            ids = A.column(batch, "key").to_numpy()
            ths = A.column(batch, "th").to_numpy()
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                starts, ends, first = A.find_words(buf, off, A.SPACED)
                words = A.word_hashes(buf, starts, ends)
                h, at, counts = A.window_hashes(words, first, width)
                if not len(h):
                    continue
                extra = A.mix(h ^ A.mix(words[at] + words[at + width - 1] * A.U(3) + words[at + width // 2])) if check_bytes else h
                row = np.repeat(np.arange(i, j), counts)
                low = _minimizers(words, at, width)
                if len(singles):
                    low = np.where(np.isin(low, singles), A.mix(h), low)
                held.append((h, extra, (low % A.U(buckets)).astype(np.uint32), ids[row], ths[row],
                             (at - first[row - i]).astype(np.int32)))
                n += len(h)
                if n >= FLUSH:
                    yield flush(held, turn)
                    held, n, turn = [], 0, turn + 1
        if held:
            yield flush(held, turn)
    return run


def _count(check_bytes: int):
    def places(block):
        n = A.unplanes(block["n"], np.int32).astype(np.int64)
        key, th, pos = (np.cumsum(A.unplanes(block[c], t), dtype=t) for c, t in (("key", np.int64), ("th", np.int32), ("pos", np.int32)))
        return np.repeat(key, n), np.repeat(th, n), A.ranges(pos, n).astype(np.int32)

    def repeats(blocks):
        """(key, th, pos) of every window that has an earlier place."""
        known = [places(b) for b in blocks if not b["hashes"]]
        fresh = [b for b in blocks if b["hashes"]]
        if fresh:
            h = np.concatenate([np.frombuffer(b["hashes"], np.uint64) for b in fresh])
            key, th, pos = (np.concatenate(c) for c in zip(*map(places, fresh)))
            extra = np.zeros(len(h), np.uint64)
            if check_bytes:
                at = 0
                for b in fresh:
                    m = len(b["hashes"]) // 8
                    wide = np.zeros((m, 8), np.uint8)
                    wide[:, :check_bytes] = np.frombuffer(b["checks"], np.uint8).reshape(check_bytes, m).T
                    extra[at:at + m] = wide.view(np.uint64).ravel()
                    at += m
            order = np.argsort(h)
            s = h[order]
            twice = np.zeros(len(s), bool)
            twice[1:] = s[1:] == s[:-1]
            twice[:-1] |= twice[1:].copy()
            sel = order[twice]
            sel = sel[np.lexsort((pos[sel], th[sel], key[sel], extra[sel], h[sel]))]
            if len(sel):
                new = np.r_[True, (h[sel][1:] != h[sel][:-1]) | (extra[sel][1:] != extra[sel][:-1])]
                head = sel[np.maximum.accumulate(np.where(new, np.arange(len(sel)), 0))]
                later = (key[sel] != key[head]) | (th[sel] != th[head]) | (pos[sel] != pos[head])
                sel = sel[later]
                known.append((key[sel], th[sel], pos[sel]))
        return known

    def run(batches):
        out, group, bucket = SpanRows(), [], None

        def close():
            found = repeats(group)
            if found:
                key, th, pos = (np.concatenate(c) for c in zip(*found))
                order = np.lexsort((pos, th, key))
                key, th, pos = key[order], th[order], pos[order]
                if len(key):
                    at = _runs(key, th, pos)
                    out.add(key[at], th[at], pos[at], np.diff(np.r_[at, len(pos)]))

        for batch in batches:
            for row in batch.to_pylist():
                if bucket is not None and row["bucket"] != bucket:
                    close()
                    group = []
                    if out.full():
                        yield out.batch()
                bucket = row["bucket"]
                group.append(row)
        if group:
            close()
        if out.n:
            yield out.batch()
    return run


def _cut(width: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", pa.string())])

    def run(batches):
        for batch in batches:
            ids, blobs = A.column(batch, "doc_id"), A.column(batch, "spans")
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                starts, ends, first = A.find_words(buf, off, A.SPACED)
                row, pos, n = unpack(blobs.slice(i, j - i).to_pylist())
                a, b = A.covered(first[row] + pos, first[row] + pos + n + width - 1)
                step = np.zeros(len(starts) + 1, np.int32)
                # spans of two documents may touch; they are told apart below
                np.add.at(step, a, 1)
                np.add.at(step, b, -1)
                gone = np.cumsum(step[:-1]) > 0
                edge = np.zeros(len(starts) + 1, bool)
                edge[first] = True
                edge = edge[:len(starts)]
                begin = np.flatnonzero(gone & (edge | np.r_[True, ~gone[:-1]][:len(gone)]))
                stop = np.flatnonzero(gone & np.r_[edge[1:] | ~gone[1:], True][:len(gone)]) + 1
                doc = np.searchsorted(first, begin, "right") - 1
                spans = span_lists(doc, begin - first[doc], stop - first[doc], j - i)
                keep = np.flatnonzero(~gone)
                size = ends[keep] - starts[keep] + 1
                data = np.append(buf, np.uint8(32))[A.ranges(starts[keep], size)]
                tail = np.cumsum(size) - 1
                data[tail] = 32
                # a document's last kept word has no space after it
                kept_first = np.searchsorted(keep, first)
                last = kept_first[1:][kept_first[1:] > kept_first[:-1]] - 1
                solid = np.ones(len(data), bool)
                solid[tail[last]] = False
                bounds = np.r_[0, tail + 1][kept_first]
                bounds = np.r_[0, np.cumsum(solid)][bounds]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(np.diff(first).astype(np.int64)), spans,
                     strings(data[solid], bounds).cast(pa.string())], schema=schema)
    return run


def _blocks(docs: DataFrame, width: int, check_bytes: int, parts: int) -> DataFrame:
    """Windows of ``keyed`` documents as blocks of ``parts`` buckets."""
    hot = docs.sparkSession.sparkContext.broadcast(hot_minimizers(docs, width, parts))
    return docs.mapInArrow(_ship(width, bucket_keys(docs, parts), check_bytes, hot), BLOCK)


def remove_repeats(docs: DataFrame, width: int = 20, check_bytes: int = 0) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_words, spans (removed word
    intervals, end exclusive), kept_text (kept words joined by one space)."""
    parts = shuffle_parts(docs)
    docs = keyed(docs)
    spans = (_blocks(docs, width, check_bytes, parts).repartition(parts, "bucket").sortWithinPartitions("bucket")
             .mapInArrow(_count(check_bytes), SPAN_ROW))
    return with_spans(docs, spans).select("doc_id", "text", "spans").mapInArrow(
        _cut(width), "doc_id long, n_words long, spans array<struct<start: long, end: long>>, kept_text string")
