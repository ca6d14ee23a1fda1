"""Operator 13: removal of repeated lines by two Bloom filters.

A line's key is the line without white space at its ends, A-Z in lower case.
Keys of at least ``min_chars`` code points that two documents hold lose their
lines in all documents but the first (smallest doc_id).

1. Map tasks hash the keys of their lines and ship each hash once a flush, to
   the segment of the hash space that it falls in (some 5 bytes a line, neither
   places nor texts).  A segment's task puts them into its filter of once-seen
   hashes; a hash that this filter holds already, or that a flush saw in two
   documents, goes into the filter of twice-seen ones.
2. A second scan probes the twice-seen filters.  Only suspected repeats leave
   it, one row for each key of a document.  The filters travel by broadcast
   while they are at most ``BROADCAST_BYTES`` together; beyond, hashes travel to
   their segment's filter instead, and the suspects of a document back to it.
3. Suspects are grouped by their text, which is the exact confirmation: a false
   positive has one document.  The group's smallest document keeps its lines.
   Keys that hold a large share of the suspects (at most ``4 * partitions``) are
   joined by broadcast, so that no task gets a hot one's rows.

Which lines a document loses is told by two independent 64-bit hashes of the key
(both equal for two different keys of n with chance n**2 / 2**129).

Cases.  Null or empty text: one empty line, kept.  Lines whose key is short:
kept.  A key repeated in one document only: kept.  Rows with equal doc_id and
text count as one document, and each is returned; rows of one doc_id with
different texts are ordered by a hash of the text; a null doc_id sorts first.
No rows give no rows.  Extra columns are ignored.  A text is held whole by its
task, with some 60 bytes of working memory for each of its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import arrays as A
from eventlens.llm.spans import keyed, strings
from eventlens.llm.spill import bucket_keys, shuffle_parts, written

#: line hashes that a map task holds before it ships them
FLUSH = 1 << 20
#: filters of more bytes are not broadcast
BROADCAST_BYTES = 64 << 20
#: bits of a filter for each hash it gets
BITS = 16


def find_lines(buf: np.ndarray, off: np.ndarray):
    """(starts, ends, first line of each text [n + 1]); every text has a line."""
    at = np.flatnonzero(buf == 10)
    row = np.searchsorted(off, at, "right") - 1
    first = np.r_[0, np.cumsum(np.bincount(row, minlength=len(off) - 1) + 1)]
    starts, ends = np.zeros(first[-1], np.int64), np.zeros(first[-1], np.int64)
    starts[first[:-1]], ends[first[1:] - 1] = off[:-1], off[1:]
    line = np.arange(len(at)) + row
    ends[line], starts[line + 1] = at, at + 1
    return starts, ends, first


def stripped(buf, starts, ends):
    """Ends of the lines without white space (empty lines: start, start)."""
    solid = np.flatnonzero(A.SPACED[buf])
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    full = a < b
    s, e = starts.copy(), starts.copy()
    s[full], e[full] = solid[a[full]], solid[b[full] - 1] + 1
    return s, e


class Lines:
    """Lines of a run of texts: ``starts``/``ends``, ``first``, and of those
    with a key that is long enough ``which``, ``row``, ``hash`` and key ends."""

    def __init__(self, buf, off, min_chars):
        self.starts, self.ends, self.first = find_lines(buf, off)
        s, e = stripped(buf, self.starts, self.ends)
        points = np.r_[0, np.cumsum((buf & 0xC0) != 0x80)]
        self.which = np.flatnonzero(points[e] - points[s] >= min_chars)
        self.low = A.LOWER[buf]
        self.s, self.e = s[self.which], e[self.which]
        self.row = np.searchsorted(self.first, self.which, "right") - 1
        prefix = A.prefix_hash(A.BYTE_VALUE[self.low], A.BASE)
        self.hash = A.mix(A.span_hash(prefix, self.s, self.e, A.BASE))

    def text(self, i) -> bytes:
        return self.low[self.s[i]:self.e[i]].tobytes()

    def second(self, sel) -> np.ndarray:
        """The other hash of the keys ``sel``."""
        return np.fromiter((xxhash.xxh3_64_intdigest(self.text(i)) for i in sel), np.uint64, len(sel))


def _segment(h: np.ndarray, n: int) -> np.ndarray:
    return (A.mix(h ^ A.U(0x5851F42D4C957F2D)) % A.U(n)).astype(np.int64)


def _place(h: np.ndarray, words: int):
    """Word and bits of a hash in a filter of ``words`` 64-bit words."""
    bits = np.zeros(len(h), np.uint64)
    for k in range(4):
        bits |= A.U(1) << ((h >> A.U(6 * k)) & A.U(63))
    return ((h >> A.U(24)) & A.U(words - 1)).astype(np.int64), bits


def holds(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    at, bits = _place(h, len(words))
    return (words[at] & bits) == bits


def _add(words, h):
    at, bits = _place(h, len(words))
    np.bitwise_or.at(words, at, bits)


def _folded(words: np.ndarray) -> np.ndarray:
    """The filter in half the words, again while a quarter of its bits at most
    are set: few hashes are seen twice."""
    while len(words) > 1:
        half = words[:len(words) // 2] | words[len(words) // 2:]
        if int(np.bitwise_count(half).sum()) * 4 > len(half) * 64:
            break
        words = half
    return words


def _ship(min_chars: int, names: np.ndarray):
    """Distinct hashes of a flush by segment: those of one document, and those
    of several."""
    schema = pa.schema([("segment", pa.int32()), ("n", pa.int64()), ("one", pa.binary()), ("many", pa.binary())])

    def flush(held):
        h, doc = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((doc, h))
        h, doc = h[order], doc[order]
        at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        several = doc[at] != doc[np.r_[at[1:] - 1, len(h) - 1]]
        h = h[at]
        part = _segment(h, len(names))
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(len(names) + 1))
        rows = []
        for k in np.flatnonzero(np.diff(cut)):
            sel = order[cut[k]:cut[k + 1]]
            pack = [A.planes(A.deltas(h[sel[m]])) for m in (~several[sel], several[sel])]
            rows.append((int(names[k]), len(sel), *pack))
        return A.batch_of(schema, list(zip(*rows)))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            ids = A.column(batch, "key").to_numpy().view(np.uint64)
            ths = A.column(batch, "th").to_numpy().astype(np.uint64)
            docs = A.mix(ids ^ A.mix(ths))
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                lines = Lines(buf, off, min_chars)
                held.append((lines.hash, docs[i:j][lines.row]))
                n += len(lines.hash)
                if n >= FLUSH:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)
    return run


def _filter_pair(words: int):
    """Blocks by segment -> the segment's filter of twice-seen hashes."""
    schema = pa.schema([("segment", pa.int32()), ("words", pa.binary())])

    def run(batches):
        segment = once = twice = None
        done = lambda: A.batch_of(schema, ([segment], [_folded(twice).tobytes()]))
        for batch in batches:
            for row in batch.to_pylist():
                if row["segment"] != segment:
                    if segment is not None:
                        yield done()
                    segment = row["segment"]
                    once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
                one, many = (np.cumsum(A.unplanes(row[c], np.uint64), dtype=np.uint64) for c in ("one", "many"))
                _add(twice, one[holds(once, one)])
                _add(twice, many)
                _add(once, one)
                _add(once, many)
        if segment is not None:
            yield done()
    return run


def twice_seen(docs: DataFrame, min_chars: int, parts: int) -> DataFrame:
    """(segment, words): filters of the hashes that two documents may share."""
    names = bucket_keys(docs, parts)
    blocks = written(docs.select("key", "th", "text").mapInArrow(
        _ship(min_chars, names), "segment int, n long, one binary, many binary"), "line-hashes")
    most = blocks.groupBy("segment").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 1
    words = 1 << max(6, (int(most) * BITS // 64 - 1).bit_length())
    return blocks.repartition(parts, "segment").sortWithinPartitions("segment").mapInArrow(
        _filter_pair(words), "segment int, words binary")


SUSPECT = pa.schema([("key", pa.int64()), ("th", pa.int32()), ("h", pa.int64()), ("h2", pa.int64()), ("line", pa.string())])


def _suspect_rows(lines, sel, ids, ths):
    """One row for each key of a document among the lines ``sel``."""
    order = sel[np.lexsort((lines.hash[sel], lines.row[sel]))]
    h, row = lines.hash[order], lines.row[order]
    order = order[np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])][:len(order)]]
    row, size = lines.row[order], lines.e[order] - lines.s[order]
    text = strings(lines.low[A.ranges(lines.s[order], size)], np.r_[0, np.cumsum(size)]).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(ths[row]), pa.array(lines.hash[order].view(np.int64)),
                                       pa.array(lines.second(order).view(np.int64)), text], schema=SUSPECT)


def _probe(min_chars: int, filters, names: np.ndarray):
    """Suspected lines of each document, by the broadcast filters."""
    def run(batches):
        words = filters.value
        sizes = np.array([len(words.get(k, b"")) // 8 for k in names.tolist()], np.int64)
        start = np.r_[0, np.cumsum(sizes)]
        flat = np.frombuffer(b"".join(words.get(k, b"") for k in names.tolist()), np.uint64)
        for batch in batches:
            ids, ths = A.column(batch, "key").to_numpy(), A.column(batch, "th").to_numpy()
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                lines = Lines(buf, off, min_chars)
                part = _segment(lines.hash, len(names))
                sel = np.flatnonzero(sizes[part] > 0)
                at, bits = _place(lines.hash[sel], 1 << 40)
                part = part[sel]
                word = flat[start[part] + (at & (sizes[part] - 1))]
                sel = sel[(word & bits) == bits]
                if len(sel):
                    yield _suspect_rows(lines, sel, ids[i:j], ths[i:j])
    return run


def _ship_places(min_chars: int, names: np.ndarray):
    """Hashes with their documents by segment, for filters too large to send."""
    schema = pa.schema([("segment", pa.int32()), ("words", pa.binary()), ("h", pa.binary()), ("key", pa.binary()), ("th", pa.binary())])

    def run(batches):
        for batch in batches:
            ids, ths = A.column(batch, "key").to_numpy(), A.column(batch, "th").to_numpy()
            for i, j, buf, off in A.pieces(A.column(batch, "text"), 16 * A.PIECE_BYTES):
                lines = Lines(buf, off, min_chars)
                part = _segment(lines.hash, len(names))
                order = np.argsort(part, kind="stable")
                cut = np.searchsorted(part[order], np.arange(len(names) + 1))
                rows = []
                for k in np.flatnonzero(np.diff(cut)):
                    sel = order[cut[k]:cut[k + 1]]
                    row = lines.row[sel] + i
                    rows.append((int(names[k]), None, lines.hash[sel].tobytes(), A.planes(A.deltas(ids[row])), A.planes(A.deltas(ths[row]))))
                if rows:
                    yield A.batch_of(schema, list(zip(*rows)))
    return run


def _probe_segment(batches):
    """A segment's filter, then its blocks -> (key, th, h) of suspects."""
    schema = pa.schema([("key", pa.int64()), ("th", pa.int32()), ("h", pa.int64())])
    segment = words = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["words"] is not None:
                segment, words = row["segment"], np.frombuffer(row["words"], np.uint64)
                continue
            if row["segment"] != segment:
                continue  # no hash of the segment was seen
            h = np.frombuffer(row["h"], np.uint64)
            key, th = (np.cumsum(A.unplanes(row[c], t), dtype=t) for c, t in (("key", np.int64), ("th", np.int32)))
            sel = holds(words, h)
            yield A.batch_of(schema, (key[sel], th[sel], h[sel].view(np.int64)))


def _pick(min_chars: int):
    """Documents with the hashes of their suspected lines -> suspects."""
    def run(batches):
        for batch in batches:
            ids, ths, known = A.column(batch, "key").to_numpy(), A.column(batch, "th").to_numpy(), A.column(batch, "hs")
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                lines = Lines(buf, off, min_chars)
                mine = known.slice(i, j - i)
                row = np.repeat(np.arange(j - i), np.diff(mine.offsets.to_numpy()))
                code = A.mix(mine.flatten().to_numpy().view(np.uint64)) + row.astype(np.uint64)
                sel = np.flatnonzero(np.isin(A.mix(lines.hash) + lines.row.astype(np.uint64), code))
                if len(sel):
                    yield _suspect_rows(lines, sel, ids[i:j], ths[i:j])
    return run


def suspects(docs: DataFrame, min_chars: int, parts: int) -> DataFrame:
    """(key, th, h, h2, line): keys that ``keyed`` documents may share."""
    filters = written(twice_seen(docs, min_chars, parts), "line-filters")
    names = bucket_keys(docs, parts)
    total = filters.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    schema = "key long, th int, h long, h2 long, line string"
    texts = docs.select("key", "th", "text")
    if total <= BROADCAST_BYTES:
        sent = docs.sparkSession.sparkContext.broadcast({r["segment"]: bytes(r["words"]) for r in filters.collect()})
        return texts.mapInArrow(_probe(min_chars, sent, names), schema)
    blocks = texts.mapInArrow(_ship_places(min_chars, names), "segment int, words binary, h binary, key binary, th binary")
    found = filters.unionByName(blocks, allowMissingColumns=True).repartition(parts, "segment")
    found = found.sortWithinPartitions("segment", F.col("words").isNull()).mapInArrow(_probe_segment, "key long, th int, h long")
    found = found.groupBy("key", "th").agg(F.collect_set("h").alias("hs"))
    return texts.dropDuplicates(["key", "th"]).join(found, ["key", "th"]).select("key", "th", "text", "hs").mapInArrow(_pick(min_chars), schema)


def losses(found: DataFrame, parts: int) -> DataFrame:
    """Suspects -> (key, th, gone): hashes of the keys that a document loses."""
    found = written(found, "line-suspects")
    doc = F.struct("key", "th")
    keys = found.groupBy("h", "h2", "line").agg(F.min(doc).alias("low"), F.max(doc).alias("high"), F.count("*").alias("n"))
    keys = written(keys.where("low <> high").select("h", "h2", "low", "n"), "line-keys")
    share = max(1000, found.count() // (4 * parts))
    rows = found.select("key", "th", "h", "h2")
    hot = keys.where(F.col("n") > share).drop("n")
    held = rows.join(F.broadcast(hot), ["h", "h2"], "left")
    rest = rows.join(F.broadcast(hot), ["h", "h2"], "left_anti").join(keys.where(F.col("n") <= share).drop("n"), ["h", "h2"])
    gone = held.where("low is not null").unionByName(rest).where((F.col("low.key") != F.col("key")) | (F.col("low.th") != F.col("th")))
    return gone.groupBy("key", "th").agg(F.collect_set(F.struct("h", "h2")).alias("gone"))


def _cut(min_chars: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("dropped", pa.list_(pa.int64())), ("kept_text", pa.string())])

    def run(batches):
        for batch in batches:
            ids, gone = A.column(batch, "doc_id"), A.column(batch, "gone")
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                lines = Lines(buf, off, min_chars)
                drop = np.zeros(len(lines.starts), bool)
                mine = gone.slice(i, j - i)
                size = np.diff(mine.offsets.to_numpy())  # a null list is empty
                if size.any():
                    row = np.repeat(np.arange(j - i, dtype=np.uint64), size)
                    pair = mine.flatten()
                    h, h2 = (pair.field(k).to_numpy().view(np.uint64) for k in (0, 1))
                    own = lines.row.astype(np.uint64)
                    sel = np.flatnonzero(np.isin(A.mix(lines.hash) + own, A.mix(h) + row))
                    code = A.mix(lines.hash[sel] ^ A.mix(lines.second(sel))) + own[sel]
                    sel = sel[np.isin(code, A.mix(h ^ A.mix(h2)) + row)]
                    drop[lines.which[sel]] = True
                keep = np.flatnonzero(~drop)
                # a kept line goes with the \n after it, but for a document's last
                length = lines.ends[keep] - lines.starts[keep] + 1
                data = np.append(buf, np.uint8(10))[np.minimum(A.ranges(lines.starts[keep], length), len(buf))]
                tail = np.cumsum(length) - 1
                data[tail] = 10
                kept_first = np.searchsorted(keep, lines.first)
                solid = np.ones(len(data), bool)
                solid[tail[kept_first[1:][kept_first[1:] > kept_first[:-1]] - 1]] = False
                bounds = np.r_[0, np.cumsum(solid)][np.r_[0, tail + 1][kept_first]]
                at = np.flatnonzero(drop)
                owner = np.searchsorted(lines.first, at, "right") - 1
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(at, lines.first).astype(np.int32)),
                                                 pa.array(at - lines.first[owner]))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(np.diff(lines.first)), lists,
                                                  strings(data[solid], bounds).cast(pa.string())], schema=schema)
    return run


def remove_repeats(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_lines, dropped (numbers of the lines
    that go, from 0), kept_text (the other lines, joined by \\n)."""
    parts = shuffle_parts(docs)
    docs = keyed(docs)
    out = docs.join(losses(suspects(docs, min_chars, parts), parts), ["key", "th"], "left")
    return out.select("doc_id", "text", "gone").mapInArrow(
        _cut(min_chars), "doc_id long, n_lines long, dropped array<long>, kept_text string")
