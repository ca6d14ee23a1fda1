"""Operator 9: maximal repeats across documents by enhanced suffix arrays.

A byte string of ``width`` bytes that also starts in a document of smaller id
is removed.  All suffixes of a corpus do not fit one array, so the work is cut
where equal strings must meet:

1. Every ``width``-byte window has a minimizer: the smallest hash among its
   ``SEED``-byte grams.  Neighbouring windows with one minimizer form a segment
   (about 14 windows); equal windows have equal minimizers, so they meet in
   the bucket of that minimizer.
2. A bucket keeps the minimizers that two documents have: each different segment
   of them once as text, with all its places and the bytes in front of them.
   They are cut at minimizers into chunks of about ``CHUNK`` suffixes; equal
   windows share their minimizer, so chunks are independent.
3. Per chunk, all suffixes of these segments are sorted into a suffix array with
   its common-prefix array, eight bytes at a time.  A stack scan yields the tree
   of common-prefix intervals (a segment with several places is a leaf with as
   many occurrences) and carries up what the left extensions have in common.  An
   interval whose left extensions differ is a maximal repeat; one whose
   occurrences all start their segment after the same byte goes on a repeat of
   the segment before; any other lies in a longer one and is passed over.
   Occurrences in documents above the group's smallest are removal spans, each
   put out once, by the deepest interval that tells it.  Spans of neighbouring
   segments merge to the whole repeat.

Minimizers that hold a large share of all segments (the edge of a passage that
many documents share has other text beside it each time) are found in a first
pass over all texts; their windows travel singly, keyed by their own hash, so
no bucket gathers a hot minimizer.  At most ``8 * buckets`` minimizers can hold
that share, which bounds the broadcast set.

Segments compare by 80 hash bits; at n segments two different ones meet as
equal with chance n**2 / 2**81.

Cases.  Null or empty text, or one below ``width`` bytes: nothing removed.
Rows with equal doc_id and text count as one document and are each returned; of
rows that share a doc_id none is smaller; a null doc_id is the smallest.  No
rows give no rows.  Extra columns are ignored.  A text is held whole by its
task, with some 80 bytes of working memory for each of its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import arrays as A
from eventlens.llm.spans import SPAN_BLOCK, SpanBlocks, SpanRows, by_document, keyed, span_lists, unpack, with_spans
from eventlens.llm.spill import bucket_keys, shuffle_parts, written
from eventlens.llm.substring_dedup import _sliding_min

SEED = 24
#: segments that a map task holds before it ships them
FLUSH = 1 << 20

FIELDS = (("anchor", np.uint32), ("content", np.uint64), ("key", np.int64), ("th", np.int32), ("pos", np.int32), ("n", np.uint8), ("before", np.uint8))
BLOCK = "bucket int, " + ", ".join(f"{f} binary" for f, _ in FIELDS)
#: no byte in front: a document's start (0xFF is in no UTF-8 text)
NONE = 0xFF
#: left extensions that differ
DIFFER = -1
BLOCK_SCHEMA = pa.schema([("bucket", pa.int32())] + [(f, pa.binary()) for f, _ in FIELDS])


def segments(buf, off, width: int):
    """(anchor hash, first byte, end byte, document) of every segment."""
    if len(buf) < width:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3 + (np.zeros(1, np.uint64),)
    seed = min(SEED, width)
    prefix = A.prefix_hash(A.BYTE_VALUE[buf], A.BASE)
    gram = prefix[seed:] - prefix[:-seed]
    gram *= A.powers(A.inverse(A.BASE), len(gram))
    gram = A.mix(gram)
    packed = (gram & A.U(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    at = _sliding_min(packed, width - seed + 1).astype(np.uint32)  # place of the smallest gram, leftmost of equals
    valid = np.ones(len(at), bool)
    edges = off[1:-1]
    edges = edges[(edges > 0) & (edges < len(buf))]
    lead = np.maximum(edges - width + 1, 0)
    valid[A.ranges(lead, np.minimum(edges, len(at)) - np.minimum(lead, len(at)))] = False
    new = np.ones(len(at) + 1, bool)
    np.not_equal(at[1:], at[:-1], out=new[1:-1])
    new[edges[edges < len(at)]] = True
    begin = np.flatnonzero(new[:-1])
    stop = np.r_[begin[1:], len(at)]
    # a segment is cut where windows would cross into the next document
    ok = valid[begin]
    begin, stop = begin[ok], stop[ok]
    doc = np.searchsorted(off, begin, "right") - 1
    stop = np.minimum(stop, off[doc + 1] - width + 1)
    return gram[at[begin]], begin, stop - 1 + width, doc, prefix


def _hot(width: int, share: int):
    """Minimizers with over 1 / share of the segments of a flush."""
    schema = pa.schema([("anchor", pa.int64()), ("n", pa.int64()), ("total", pa.int64())])

    def report(held):
        anchor = np.concatenate(held)
        values, n = np.unique(anchor, return_counts=True)
        top = n > max(16, len(anchor) // share)
        return A.batch_of(schema, (np.r_[values[top].view(np.int64), np.int64(0)], np.r_[n[top], 0], np.r_[np.zeros(top.sum(), np.int64), len(anchor)]))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                anchor, begin, end, doc, prefix = segments(buf, off, width)
                content = A.span_hash(prefix, begin, end, A.BASE) ^ anchor
                _, keep = np.unique(content, return_index=True)
                held.append(anchor[keep])
                n += len(keep)
                if n >= FLUSH:
                    yield report(held)
                    held, n = [], 0
        if held:
            yield report(held)
    return run


def _ship(width: int, names: np.ndarray, hot):
    """``names``: the number that each bucket goes by."""
    buckets = len(names)
    small = np.uint16 if buckets <= 1 << 16 else np.uint32

    def flush(held):
        cols = [np.concatenate(c) for c in zip(*held)]
        anchor, content, key, th, pos, n, before = cols
        if (key[1:] < key[:-1]).any():
            order = np.lexsort((pos, th, key))
            anchor, content, key, th, pos, n, before = (c[order] for c in cols)
        bucket = anchor % A.U(buckets)
        anchor = ((anchor // A.U(buckets)) & A.U(0xFFFFFFFF)).astype(np.uint32)
        content &= A.U((1 << 48) - 1)
        order = np.argsort(bucket.astype(small), kind="stable")
        b = bucket[order]
        cut = np.r_[0, np.flatnonzero(b[1:] != b[:-1]) + 1, len(b)]
        rows = []
        for s, e in zip(cut[:-1], cut[1:]):
            sel = order[s:e]
            rows.append((int(names[b[s]]), anchor[sel].tobytes(), A.planes(content[sel])[:6 * len(sel)], A.planes(A.deltas(key[sel])),
                         A.planes(A.deltas(th[sel])), A.planes(A.deltas(pos[sel])), n[sel].tobytes(), before[sel].tobytes()))
        return A.batch_of(BLOCK_SCHEMA, list(zip(*rows)))

    def run(batches):
        singles = hot.value
        held, size = [], 0
        for batch in batches:
            keys, ths = A.column(batch, "key").to_numpy(), A.column(batch, "th").to_numpy()
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                anchor, begin, end, doc, prefix = segments(buf, off, width)
                if not len(begin):
                    continue
                if len(singles):
                    one = np.isin(anchor, singles)
                    many = np.flatnonzero(one)
                    count = end[many] - begin[many] - width + 1
                    at = A.ranges(begin[many], count)
                    order = np.argsort(np.r_[begin[~one], at], kind="stable")
                    anchor = np.r_[anchor[~one], A.mix(A.span_hash(prefix, at, at + width, A.BASE) ^ A.U(width))][order]
                    doc = np.r_[doc[~one], np.repeat(doc[many], count)][order]
                    end = np.r_[end[~one], at + width][order]
                    begin = np.r_[begin[~one], at][order]
                n = end - begin
                content = A.mix(A.span_hash(prefix, begin, end, A.BASE) + n.astype(np.uint64))
                before = np.where(begin > off[doc], buf[begin - 1], NONE).astype(np.uint8)
                held.append((anchor, content, keys[i + doc], ths[i + doc], (begin - off[doc]).astype(np.int32), n.astype(np.uint8), before))
                size += len(n)
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)
    return run


def _blocks(batches):
    """Columns of one bucket at a time; rows arrive ordered by bucket."""
    group, bucket = [], None

    def columns():
        out = []
        for name, kind in FIELDS:
            if name == "content":
                parts = []
                for g in group:
                    m = len(g["n"])
                    wide = np.zeros((m, 8), np.uint8)
                    wide[:, :6] = np.frombuffer(g[name], np.uint8).reshape(6, m).T
                    parts.append(wide.view(np.uint64).ravel())
            elif name in ("key", "th", "pos"):
                parts = [np.cumsum(A.unplanes(g[name], kind), dtype=kind) for g in group]
            else:
                parts = [np.frombuffer(g[name], kind) for g in group]
            out.append(np.concatenate(parts))
        return out

    for batch in batches:
        for row in batch.to_pylist():
            if bucket is not None and row["bucket"] != bucket:
                yield bucket, columns()
                group = []
            bucket = row["bucket"]
            group.append(row)
    if group:
        yield bucket, columns()


#: suffixes that are sorted at a time (one minimizer may have more)
CHUNK = 1 << 18
PLACES = (("count", np.int32), ("keys", np.int64), ("ths", np.int32), ("poss", np.int32), ("befores", np.uint8))
FOUND = "kind int, bucket int, chunk int, key long, th int, asked binary, " + ", ".join(f"{c} binary" for c, _ in PLACES)
TEXTS = "kind int, bucket int, chunk int, segment int, text binary"


def _segment_groups(width: int):
    """For each chunk of a bucket, its places (kind 0: by segment, places of a
    segment by document), and the segments' texts to fetch from their first
    places (kind 1: (pos, n, segment) by document)."""
    names = ["kind", "bucket", "chunk", "key", "th", "asked", *(c for c, _ in PLACES)]
    kinds = [pa.int32()] * 3 + [pa.int64(), pa.int32()] + [pa.binary()] * 6

    def rows(bucket, c, count, key, th, pos, n, before):
        first = np.cumsum(count) - count
        packed = (count, key, th, pos, before)
        out = [(0, bucket, c, None, None, None, *(A.planes(x if f in ("count", "befores") else A.deltas(x)) for x, (f, _) in zip(packed, PLACES)))]
        triple = np.stack([pos[first], n[first].astype(np.int32), np.arange(len(first), dtype=np.int32)], 1)
        order = np.lexsort((pos[first], th[first], key[first]))
        k, t, triple = key[first][order], th[first][order], triple[order]
        cut = np.r_[np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (t[1:] != t[:-1])]), len(k)]
        out += [(1, bucket, c, int(k[a]), int(t[a]), triple[a:b].tobytes(), *[None] * 5) for a, b in zip(cut[:-1], cut[1:])]
        return pa.RecordBatch.from_arrays([pa.array(col, kind) for col, kind in zip(zip(*out), kinds)], names=names)

    def run(batches):
        for bucket, (anchor, content, key, th, pos, n, before) in _blocks(batches):
            order = np.argsort(anchor)
            s = anchor[order]
            twice = np.zeros(len(s), bool)
            twice[1:] = s[1:] == s[:-1]
            twice[:-1] |= twice[1:].copy()
            order = order[twice]
            order = order[np.lexsort((key[order], content[order], anchor[order]))]
            if not len(order):
                continue
            a, k = anchor[order], key[order]
            at = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            spread = np.minimum.reduceat(k, at) < np.maximum.reduceat(k, at)
            order = order[np.repeat(spread, np.diff(np.r_[at, len(k)]))]
            if not len(order):
                continue
            a, c = anchor[order], content[order]
            new = np.r_[True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])]
            at = np.flatnonzero(new)
            count = np.diff(np.r_[at, len(order)]).astype(np.int32)
            size = n[order][at].astype(np.int64) - width + 1
            # chunks end where a minimizer does
            edge = np.flatnonzero(np.r_[True, a[at][1:] != a[at][:-1]])
            chunk = np.add.accumulate(size)[edge] - size[edge]
            chunk = np.repeat(chunk // CHUNK, np.diff(np.r_[edge, len(at)]))
            cut = np.r_[np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]), len(at)]
            for j, (x, y) in enumerate(zip(cut[:-1], cut[1:])):
                sel = order[at[x]:at[y] if y < len(at) else len(order)]
                yield rows(bucket, j, count[x:y], key[sel], th[sel], pos[sel], n[sel], before[sel])
    return run


def _texts():
    """The bytes of the segments asked for."""
    schema = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int32()), ("segment", pa.int32()), ("text", pa.binary())])

    def run(batches):
        for batch in batches:
            raw = A.column(batch, "text").cast(pa.large_binary())
            rows = []
            for r, asked in enumerate(A.column(batch, "asked").to_pylist()):
                text = raw[r].as_py()
                for item in asked:
                    for p, n, segment in np.frombuffer(item["asked"], np.int32).reshape(-1, 3).tolist():
                        rows.append((1, item["bucket"], item["chunk"], segment, text[p:p + n]))
                if len(rows) > 100_000:
                    yield A.batch_of(schema, list(zip(*rows)))
                    rows = []
            if rows:
                yield A.batch_of(schema, list(zip(*rows)))
    return run


def suffix_array(texts, width: int):
    """Sorted suffixes of at least ``width`` bytes of ``texts``: (text number,
    offset, lcp); lcp[i] is the common prefix of suffixes i - 1 and i.

    Runs of suffixes that are equal so far are sorted by their next eight bytes,
    until none is left; a shorter suffix goes before a longer one."""
    size = np.array([len(t) for t in texts], np.int64)
    count = np.maximum(size - width + 1, 0)
    text = np.repeat(np.arange(len(texts)), count)
    offset = A.ranges(np.zeros(len(texts), np.int64), count)
    left = size[text] - offset
    longest = int(left.max(initial=0))
    flat = np.frombuffer(b"".join(texts) + b"\0" * (longest + 16), np.uint8)
    eight = np.lib.stride_tricks.sliding_window_view(flat, 8)
    place = (np.cumsum(size) - size)[text] + offset
    order = np.argsort(left, kind="stable")
    lcp = np.zeros(len(order), np.int64)
    run = np.zeros(len(order), np.int64)  # the first position of each position's run
    open_ = np.arange(len(order)) if len(order) > 1 else np.zeros(0, np.int64)
    for done in range(0, longest, 8):
        if not len(open_):
            break
        suffix = order[open_]
        word = eight[place[suffix] + done].view(">u8").ravel().astype(np.uint64)
        rest = left[suffix] - done
        blank = np.clip(8 - rest, 0, 8).astype(np.uint64)
        word = np.where(blank >= 8, A.U(0), (word >> (np.minimum(blank, A.U(7)) * A.U(8))) << (np.minimum(blank, A.U(7)) * A.U(8)))
        by = np.lexsort((word, run[open_]))
        order[open_], word = suffix[by], word[by]
        same_run = np.r_[False, (run[open_][1:] == run[open_][:-1]) & (open_[1:] == open_[:-1] + 1)]
        differ = np.r_[A.U(0), word[1:] ^ word[:-1]]
        common = sum(((differ >> A.U(64 - 8 * k)) == 0).astype(np.int64) for k in range(1, 8)) + (differ == 0)
        split = same_run & (differ != 0)
        lcp[open_[split]] = done + common[split]
        # equal so far, whether or not the next eight bytes decide
        lcp[open_[same_run & ~split]] = done + 8
        begins = ~same_run | split
        run[open_] = open_[np.flatnonzero(begins)][np.cumsum(begins) - 1]
        alone = begins & np.r_[begins[1:], True]
        open_ = open_[~alone]
    if len(order) > 1:
        lcp[1:] = np.minimum(lcp[1:], np.minimum(left[order][1:], left[order][:-1]))
    return text[order], offset[order], lcp


def interval_tree(lcp, least: int, left, inner, low):
    """Stack scan of a common-prefix array: every interval of its tree whose
    length is ``least`` or more, inner ones first, as (length, first, last, left,
    inner, settled).

    ``left``: the byte in front of each suffix (DIFFER: there are several);
    ``inner``: whether it starts inside its text; ``low``: its smallest document.
    Carried up: the one byte in front of an interval or DIFFER, whether all its
    suffixes are inner, and those of its smallest document.  ``settled`` are the
    suffixes that no deeper interval has joined to a smaller document."""
    stack = []  # [length, first, left, inner, low, suffixes of it, settled]

    def join(entry, byte, inside, smallest, own):
        entry[2] = byte if entry[2] is None or entry[2] == byte else DIFFER
        entry[3] &= inside
        if entry[4] is None or smallest < entry[4]:
            entry[6] += entry[5]
            entry[4], entry[5] = smallest, own
        elif smallest == entry[4]:
            entry[5] = entry[5] + own
        else:
            entry[6] += own

    for i, length in enumerate([*lcp[1:], 0]):
        child = (left[i], inner[i], low[i], [i])
        first = i
        while stack and stack[-1][0] > length:
            top = stack.pop()
            join(top, *child)
            yield top[0], top[1], i, top[2], top[3], top[6]
            child, first = (top[2], top[3], top[4], top[5]), top[1]
        if length >= least:
            if not stack or stack[-1][0] < length:
                stack.append([length, first, None, True, None, [], []])
            join(stack[-1], *child)


def _in_front(texts, before, text, offset):
    """The byte in front of each suffix."""
    joined = np.frombuffer(b"".join(texts) or b"\0", np.uint8)
    start = np.cumsum([0] + [len(t) for t in texts])[text]
    return np.where(offset > 0, joined[np.maximum(start + offset - 1, 0)].astype(np.int64), np.asarray(before, np.int64)[text])


def repeat_groups(texts, before, width: int):
    """Groups of equal strings of ``width`` bytes or more that are not part of a
    longer one inside ``texts``: (length, text numbers, offsets, whether the left
    extensions differ), all occurrences.  ``before``: the byte in front of each
    text (DIFFER: none, or several).  A group whose left extensions are one byte
    goes on a repeat that begins before the texts do."""
    text, offset, lcp = suffix_array(texts, width)
    left, inner = _in_front(texts, before, text, offset), offset > 0
    for length, first, last, byte, inside, _ in interval_tree(lcp.tolist(), width, left.tolist(), inner.tolist(), [0] * len(text)):
        if byte == DIFFER or not inside:
            yield length, text[first:last + 1], offset[first:last + 1], byte == DIFFER


def maximal_repeats(texts, before, width: int):
    """The groups of :func:`repeat_groups` whose left extensions differ."""
    for length, text, offset, differ in repeat_groups(texts, before, width):
        if differ:
            yield length, text, offset


def chunk_spans(texts, count, key, th, pos, before, width: int, out: SpanRows):
    """Removal spans of a chunk: texts of its segments, and their places."""
    size = np.array([len(t) for t in texts], np.int64)
    at = np.cumsum(count) - count
    low = key[at]
    owner = np.repeat(np.arange(len(texts)), count)
    later = key > low[owner]
    # a segment with several places is a leaf of the tree; the tail of a repeated
    # segment lies in it, so the leaves of whole segments tell all places but the first's
    out.add(key[later], th[later], pos[later], size[owner[later]])
    mine = np.add.reduceat((~later).astype(np.int64), at)  # places in the smallest document come first
    one = (np.minimum.reduceat(before, at) == np.maximum.reduceat(before, at)) & (before[at] != NONE)
    text, offset, lcp = suffix_array(texts, width)
    left = _in_front(texts, np.where(one, before[at].astype(np.int64), DIFFER), text, offset)
    own, inner = low[text], offset > 0
    begin = np.flatnonzero(lcp < width)
    stop = np.r_[begin[1:], len(lcp)]
    suffix, length = [], []
    if len(begin):
        spread = np.minimum.reduceat(own, begin) < np.maximum.reduceat(own, begin)
        for b, e in zip(begin[spread].tolist(), stop[spread].tolist()):
            common = lcp[b:e].tolist()
            common[0] = 0
            for n, _, _, byte, inside, settled in interval_tree(common, width, left[b:e].tolist(), inner[b:e].tolist(), own[b:e].tolist()):
                if settled and (byte == DIFFER or not inside):
                    suffix += [b + x for x in settled]
                    length += [n] * len(settled)
    suffix, length = np.array(suffix, np.int64), np.array(length, np.int64)
    t = text[suffix]
    places = A.ranges(at[t], mine[t])
    out.add(key[places], th[places], pos[places] + np.repeat(offset[suffix], mine[t]), np.repeat(length, mine[t]))


def _compare(width: int, names: np.ndarray):
    """Places and texts by (bucket, chunk) -> blocks of removal spans."""
    def run(batches):
        out, now, texts, parts = SpanBlocks(names), None, [], None

        def close():
            count, key, th, pos, before = parts
            chunk_spans(texts, count, key, th, pos, before, width, out)

        for batch in batches:
            where = list(zip(A.column(batch, "bucket").to_pylist(), A.column(batch, "chunk").to_pylist()))
            kind, text = A.column(batch, "kind").to_pylist(), A.column(batch, "text")
            columns = [A.column(batch, c) for c, _ in PLACES]
            for r, place in enumerate(where):
                if place != now:
                    if texts:
                        close()
                        if out.full():
                            yield out.batch()
                    now, texts = place, []
                if kind[r] == 0:
                    raw = [A.unplanes(c[r].as_py(), k) for c, (_, k) in zip(columns, PLACES)]
                    parts = [x if f in ("count", "befores") else np.cumsum(x, dtype=k) for x, (f, k) in zip(raw, PLACES)]
                else:
                    texts.append(text[r].as_py())
        if texts:
            close()
        if out.n:
            yield out.batch()
    return run


def _cut():
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])

    def run(batches):
        for batch in batches:
            ids, blobs = A.column(batch, "doc_id"), A.column(batch, "spans")
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                row, pos, n = unpack(blobs.slice(i, j - i).to_pylist())
                # one byte apart per document, so that spans of two never merge
                a, b = A.covered(off[row] + row + pos, off[row] + row + pos + n)
                doc = np.searchsorted(off + np.arange(len(off)), a, "right") - 1
                a, b = a - doc, b - doc
                spans = span_lists(doc, a - off[doc], b - off[doc], j - i)
                keep = np.ones(len(buf), bool)
                keep[A.ranges(a, b - a)] = False
                left = np.r_[0, np.cumsum(keep)][off]
                data = buf[keep].tobytes()
                kept = pa.array([data[s:e] for s, e in zip(left[:-1], left[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(np.diff(off)), spans, kept], schema=schema)
    return run


def hot_minimizers(docs: DataFrame, width: int, buckets: int) -> np.ndarray:
    """Minimizers with over 1 / (4 * buckets) of all segments (at most
    4 * buckets of them)."""
    seen = docs.select("text").mapInArrow(_hot(width, 8 * buckets), "anchor long, n long, total long")
    seen = written(seen.groupBy("anchor").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "minimizers")
    total = seen.agg(F.sum("total")).first()[0] or 0
    top = seen.where(F.col("n") > max(64, total // (4 * buckets))).select("anchor").collect()
    return np.array(sorted(r[0] for r in top), np.int64).view(np.uint64)


def remove_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_bytes, spans (removed byte runs,
    end exclusive), kept (remaining bytes)."""
    if width > 255 - SEED:
        raise ValueError("width must be at most 231 bytes")
    parts = shuffle_parts(docs)
    spark = docs.sparkSession
    docs = keyed(docs)
    hot = spark.sparkContext.broadcast(hot_minimizers(docs, width, parts))
    names = bucket_keys(docs, parts)
    blocks = docs.mapInArrow(_ship(width, names, hot), BLOCK)
    found = written(blocks.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_segment_groups(width), FOUND), "segments")
    asked = found.where("kind = 1").groupBy("key", "th").agg(F.collect_list(F.struct("bucket", "chunk", "asked")).alias("asked"))
    texts = (docs.join(asked, ["key", "th"]).select("doc_id", "key", "th", "text", "asked")
             .dropDuplicates(["key", "th"]).mapInArrow(_texts(), TEXTS))
    places = found.where("kind = 0").select("kind", "bucket", "chunk", *(c for c, _ in PLACES))
    spans = (places.unionByName(texts, allowMissingColumns=True).repartition(parts, "bucket")
             .sortWithinPartitions("bucket", "chunk", "kind", "segment").mapInArrow(_compare(width, names), SPAN_BLOCK))
    return with_spans(docs, by_document(spans, parts)).select("doc_id", "text", "spans").mapInArrow(
        _cut(), "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
