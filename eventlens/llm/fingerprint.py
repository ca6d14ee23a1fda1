"""Operator 5: document fingerprints from modular prefix hashes.

``Prefixes`` holds, for a run of texts, the prefix sums of
``value[byte] * r**i`` modulo 2**31 - 1 for two bases ``r``.  A span's hash is a
difference of two prefixes shifted to a common origin, so any two spans compare
in constant time, and a binary search over lengths gives the longest common
extension of two places.

A fingerprint is the hash of the whole text, followed by ``SLOTS`` samples: the
hashes of all ``GRAM``-byte spans (the whole text if it is shorter) fall into
slots by their leading bits, and a slot keeps 16 bits of its smallest hash.  The
likeness of two fingerprints is the share of equal slots among those that
either has filled, an estimate of the share of common spans; it is 1 for equal
whole hashes.

Cases.  Null or empty text: all slots empty; likeness 1 to another empty text,
0 to any other.  Rows are ordered by (doc_id nulls first, hash of the text);
repeated rows follow each other.  No rows give no rows.  Extra columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import arrays as A
from eventlens.llm.spans import keyed
from eventlens.llm.spill import shuffle_parts

P = np.uint64((1 << 31) - 1)
BASES = (1_103_515_245, 1_664_525_003)
SLOTS, GRAM = 64, 8
VALUE = (A.BYTE_VALUE >> np.uint64(34)) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def reduce_mod(x: np.ndarray) -> np.ndarray:
    """x modulo 2**31 - 1 for x below 2**63."""
    x = (x & P) + (x >> np.uint64(31))
    x = (x & P) + (x >> np.uint64(31))
    return np.where(x >= P, x - P, x)


def powers(r: int, n: int) -> np.ndarray:
    """r**0 .. r**(n-1) modulo 2**31 - 1."""
    have = _powers.get(r)
    if have is None or len(have) < n:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.r_[out, reduce_mod(out * np.uint64(pow(r, len(out), int(P))))]
        have = _powers[r] = out
    return have[:n]


class Prefixes:
    """Prefix hashes of the bytes ``buf``."""

    def __init__(self, buf: np.ndarray):
        self.n = len(buf)
        self.sums = []
        for r in BASES:
            s = np.zeros(self.n + 1, np.uint64)
            np.cumsum(reduce_mod(VALUE[buf] * powers(r, max(1, self.n))), out=s[1:])
            self.sums.append(reduce_mod(s))

    def spans(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """62-bit hashes of the spans [a, b)."""
        out = np.zeros(len(a), np.uint64)
        for r, s in zip(BASES, self.sums):
            back = powers(pow(r, -1, int(P)), self.n + 1)
            out = (out << np.uint64(31)) | reduce_mod((s[b] + P - s[a]) * back[a])
        return out

    def grams(self, q: int) -> np.ndarray:
        """Hashes of all spans of ``q`` bytes, by start."""
        out = np.zeros(max(0, self.n - q + 1), np.uint64)
        for r, s in zip(BASES, self.sums):
            back = powers(pow(r, -1, int(P)), self.n + 1)
            out = (out << np.uint64(31)) | reduce_mod(reduce_mod(s[q:] + P - s[:len(s) - q]) * back[:len(out)])
        return out

    def common_extension(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the longest common extension of places i and j, at most
        ``most``, by binary search on span hashes."""
        lo, hi = np.zeros(len(i), np.int64), np.asarray(most, np.int64).copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self.spans(i, i + mid) == self.spans(j, j + mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo


def fingerprints(p: Prefixes, off: np.ndarray, gram: int = GRAM):
    """(whole-text hashes, slots [text, SLOTS]; 0: empty) of the texts at
    ``off`` in the prefixes."""
    n = len(off) - 1
    whole = A.mix(p.spans(off[:-1], off[1:]) ^ (np.diff(off).astype(np.uint64) << np.uint64(1)))
    slots = np.zeros((n, SLOTS), np.uint16)
    grams = A.mix(p.grams(gram))
    edges = (np.arange(SLOTS, dtype=np.uint64) << np.uint64(58))
    for i in range(n):
        a, b = off[i], off[i + 1]
        if a == b:
            continue
        h = np.sort(grams[a:b - gram + 1]) if b - a >= gram else whole[i:i + 1]
        at = np.searchsorted(h, edges)
        filled = np.r_[at[1:], len(h)] > at
        slots[i, filled] = ((h[at[filled]] >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.uint16) | np.uint16(1)
    return whole, slots


def likeness(whole_a, slots_a, whole_b, slots_b) -> np.ndarray:
    either = ((slots_a > 0) | (slots_b > 0)).sum(1)
    same = ((slots_a == slots_b) & (slots_a > 0)).sum(1)
    return np.where(whole_a == whole_b, 1.0, same / np.maximum(either, 1))


def hexed(whole, slots):
    return [f"{w:016x}" + s.astype(">u2").tobytes().hex() for w, s in zip(whole.tolist(), slots)]


def with_successors(docs: DataFrame) -> DataFrame:
    """Keyed documents dealt to buckets that are ranges of the order (key,
    th), plus ``last``: a copy of the document after a bucket's end, which
    closes the bucket (the first document closes the last bucket).

    Bucket bounds are quantiles; the copies are one per bucket.
    """
    spark, parts = docs.sparkSession, shuffle_parts(docs)
    docs = keyed(docs)
    cuts = docs.agg(F.percentile_approx("key", [i / (4 * parts) for i in range(1, 4 * parts)], 10000)).first()[0]
    cuts = sorted(set(cuts or []))
    group = max(1, math.isqrt(len(cuts)))
    rough = F.array(*[F.lit(c) for c in cuts[::group]]) if cuts else F.array().cast("array<long>")
    # two short searches: the group of bounds, then the bound in it
    fine = F.array(*([F.array().cast("array<long>")] + [F.array(*[F.lit(c) for c in cuts[i:i + group]]) for i in range(0, len(cuts), group)]))
    below = lambda a: F.size(F.filter(a, lambda c: c <= F.col("key")))
    g = below(rough)
    bucket = F.when(g == 0, F.lit(0)).otherwise((g - 1) * group + below(F.element_at(fine, g + 1)))
    docs = docs.withColumn("bucket", bucket.cast("int"))
    heads = docs.groupBy("bucket").agg(F.min(F.struct("key", "th")).alias("head")).orderBy("bucket").collect()
    pairs = [(h["head"]["key"], h["head"]["th"], heads[i - 1]["bucket"]) for i, h in enumerate(heads)]
    closes = F.broadcast(spark.createDataFrame(pairs, "key long, th int, to int"))
    docs = docs.join(closes, ["key", "th"], "left")
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("last"))
    more = F.struct(F.col("to").alias("bucket"), F.lit(True).alias("last"))
    docs = docs.withColumn("at", F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, more))))
    return (docs.select("at.bucket", "at.last", "key", "th", "doc_id", "text")
            .repartition(parts, "bucket").sortWithinPartitions("bucket", "last", "key", "th"))


def _stream(gram: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("common_prefix", pa.int64())])

    def work(rows):
        """rows: (bucket, last, doc_id, text); each but the final one is followed by its successor."""
        own, nxt = [], []
        for a, b in zip(rows[:-1], rows[1:]):
            if not a[1] and a[0] == b[0]:
                own.append(a)
                nxt.append(b[3])
        if not own:
            return None
        texts = [r[3] for r in own]
        edited = [t[:len(t) - len(t) // 4] + s[:len(t) // 4] for t, s in zip(texts, nxt)]
        # each text is hashed once, also where it is the next one of the row before
        every = texts + edited + [s for k, s in enumerate(nxt) if k + 1 == len(own) or own[k + 1][3] is not s]
        place, extra = [], 2 * len(own)
        for k, s in enumerate(nxt):
            if k + 1 == len(own) or own[k + 1][3] is not s:
                place.append(extra)
                extra += 1
            else:
                place.append(k + 1)
        buf, off = A.text_buffer(pa.array(every, pa.large_string()))
        p = Prefixes(buf)
        whole, slots = fingerprints(p, off, gram)
        n = len(own)
        near = likeness(whole[:n], slots[:n], whole[n:2 * n], slots[n:2 * n])
        near_next = likeness(whole[:n], slots[:n], whole[place], slots[place])
        size = np.diff(off)
        common = p.common_extension(off[:n], off[n:2 * n], np.minimum(size[:n], size[n:2 * n]))
        return A.batch_of(schema, ([r[2] for r in own], [len(t) for t in texts], edited, hexed(whole[:n], slots[:n]),
                                   hexed(whole[n:2 * n], slots[n:2 * n]), near, near_next, common))

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(A.column(batch, c).to_pylist() for c in ("bucket", "last", "doc_id", "text"))):
                rows.append(row)
                held += len(row[3])
                if held > A.PIECE_BYTES and len(rows) > 1:
                    out = work(rows)
                    if out is not None:
                        yield out
                    rows, held = rows[-1:], len(rows[-1][3])
        out = work(rows)
        if out is not None:
            yield out
    return run


def fingerprint_edits(docs: DataFrame, gram: int = GRAM) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_chars, edited (its last quarter
    replaced by the start of the next document), fingerprint,
    edited_fingerprint, near_edited, near_next, common_prefix (bytes that text
    and edited text share from the start)."""
    return with_successors(docs).drop("key", "th").mapInArrow(
        _stream(gram), "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
                       "near_edited double, near_next double, common_prefix long")
