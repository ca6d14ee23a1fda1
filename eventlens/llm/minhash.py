"""Operator 1: near-duplicate documents by MinHash with odd sketches.

Method.  A document's set of word shingles gives ``BANDS * ROWS`` MinHash
samples.  Each band of samples is a bucket key; each sample also flips one bit
of a parity bitmap (the odd sketch), so the population count of two sketches'
XOR estimates how many samples differ, most precisely at high similarity.

1. ``signatures``: one pass over the texts.  Equal sets form one class.
2. Classes that meet in a bucket are linked to the bucket's smallest class (a
   star, never all pairs); the components of these links are the candidate
   groups, and hold every pair that shares a bucket.
3. Within a group, classes are dealt into blocks of bounded size and every
   pair of blocks is one unit of work: sketches discard pairs that are far
   apart, and the full shingle sets decide the rest exactly.  Only a spanning
   forest of confirmed links leaves a task.
4. The components of the confirmed links are the near-duplicate groups.

A pair at similarity s shares no bucket with chance (1 - s**ROWS)**BANDS: 8e-7
at 0.85 and 7e-5 at 0.8 for the defaults.  Copies of a set never multiply:
they are one class.

Cases.  Null or empty text, or text without words: empty set, linked with
nothing.  Fewer words than a shingle: the whole sequence is the one shingle.
Repeated rows: each is returned, in one component.  Null ``doc_id``: the row is
returned; a component's id is its smallest non-null id (null if it has none).
No rows give no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import arrays as A
from eventlens.llm.components import components
from eventlens.llm.spill import shuffle_parts, written

BANDS, ROWS = 24, 5
SKETCH_BITS = 512
#: limits of a block of classes that one task compares with another block
BLOCK_DOCS, BLOCK_WORDS = 1024, 2_000_000

SIGNATURE = "doc_id long, node long, n_shingles long, th long, bands array<long>, sketch binary"


def shingle_sets(buf, off, width: int):
    """Per text the sorted distinct hashes of its ``width``-word shingles."""
    starts, ends, first = A.find_words(buf, off, A.SPACED)
    words = A.word_hashes(buf, starts, ends)
    hashes, _, counts = A.window_hashes(words, first, width)
    bounds = np.r_[0, np.cumsum(counts)]
    out = []
    for i in range(len(counts)):
        n = first[i + 1] - first[i]
        if 0 < n < width:
            out.append(A.window_hashes(words[first[i]:first[i + 1]], np.array([0, n]), int(n))[0])
        else:
            out.append(np.unique(hashes[bounds[i]:bounds[i + 1]]))
    return out


@functools.lru_cache(maxsize=4)
def _family(n: int):
    rng = np.random.Generator(np.random.PCG64(7_2024))
    return rng.integers(0, 1 << 32, n, dtype=np.uint32), rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def samples(sets, bands: int, rows: int) -> np.ndarray:
    """MinHash samples [sample, set] of non-empty sets."""
    flat = np.concatenate(sets)
    short = (flat >> A.U(32)).astype(np.uint32) ^ flat.astype(np.uint32)
    at = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    xor, mul = _family(bands * rows)
    out = np.empty((bands * rows, len(sets)), np.uint32)
    work = np.empty_like(short)
    for i in range(bands * rows):
        np.bitwise_xor(short, xor[i], out=work)
        np.multiply(work, mul[i], out=work)
        np.bitwise_xor(work, work >> np.uint32(15), out=work)
        np.multiply(work, np.uint32(0x2C1B3C6D), out=work)
        out[i] = np.minimum.reduceat(work, at)
    return out


def odd_sketches(mins: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmaps [set, bits / 8]: sample i flips the bit hash(i, value)."""
    k, n = mins.shape
    bit = A.mix(mins.astype(np.uint64) + (np.arange(k, dtype=np.uint64)[:, None] << A.U(32))) % A.U(bits)
    cells = np.arange(n, dtype=np.int64)[None, :] * bits + bit.astype(np.int64)
    parity = np.bincount(cells.ravel(), minlength=n * bits) & 1
    return np.packbits(parity.reshape(n, bits).astype(np.uint8), axis=1)


def sketch_limit(threshold: float, k: int, bits: int) -> float:
    """Largest XOR count of a pair at ``threshold``: six standard deviations
    of the number of differing samples, four of the folding."""
    differ = k * (1 - threshold) + 6 * np.sqrt(k * threshold * (1 - threshold))
    count = bits / 2 * (1 - np.exp(-4 * differ / bits))
    return count + 4 * np.sqrt(count * (1 - count / bits))


def _sign(width: int, bands: int, rows: int, bits: int):
    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n_shingles", pa.int64()), ("th", pa.int64()),
                            ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])
        salt = A.mix(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            ids, th = A.column(batch, "doc_id"), A.column(batch, "th")
            for i, j, buf, off in A.pieces(A.column(batch, "text")):
                buf = A.LOWER[buf]
                sets = shingle_sets(buf, off, width)
                size = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(size)
                node = np.zeros(j - i, np.int64)
                keys, sketches = [None] * (j - i), [None] * (j - i)
                if len(full):
                    chosen = [sets[x] for x in full]
                    # of a set: the sum of its mixed members, order-free, and its size
                    at = np.r_[0, np.cumsum(size[full])[:-1]]
                    total = np.add.reduceat(A.mix(np.concatenate(chosen) ^ A.U(A.BASE)), at)
                    node[full] = A.mix(total + size[full].astype(np.uint64)).view(np.int64)
                    mins = samples(chosen, bands, rows)
                    parts = mins.reshape(bands, rows, -1).astype(np.uint64)
                    key = np.zeros(parts[:, 0].shape, np.uint64) + salt[:, None]
                    for r in range(rows):
                        key = A.mix(key ^ parts[:, r])
                    key, sk = key.view(np.int64).T, odd_sketches(mins, bits)
                    for n, x in enumerate(full):
                        keys[x], sketches[x] = key[n], sk[n].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i).cast(pa.int64()), pa.array(node), pa.array(size), th.slice(i, j - i),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], schema=schema)
    return run


def signatures(docs: DataFrame, width: int, bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, node (64-bit hash of the shingle set: its class), n_shingles,
    th (hash of the text), band keys and odd sketch of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64("text").alias("th")).mapInArrow(_sign(width, bands, rows, bits), SIGNATURE)


class _Forest:
    """Disjoint sets over 0..n-1."""

    def __init__(self, n):
        self.up = np.arange(n)

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def roots(self):
        up = self.up
        while True:
            nxt = up[up]
            if (nxt == up).all():
                self.up = nxt
                return nxt
            up = nxt

    def join(self, i, j):
        self.up[self.root(i)] = self.root(j)


def _links(node, block, sketch, sets, same: bool, num: int, den: int, limit: float):
    """Spanning forest of the pairs with den * |A & B| >= num * |A | B|.
    ``same``: all rows are of one block, else only pairs across two blocks."""
    n = len(node)
    size = np.array([len(s) for s in sets], np.int64)
    at = np.r_[0, np.cumsum(size)]
    flat, ids = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(flat), bool)
    sk = np.frombuffer(b"".join(sketch), np.uint64).reshape(n, -1)
    forest, out = _Forest(n), []
    left = range(n - 1) if same else np.flatnonzero(block == block.min())
    for x in left:
        other = np.arange(x + 1, n) if same else np.flatnonzero(block != block[x])
        # of sizes a <= b, |A & B| / |A | B| is a / b at most
        ok = den * np.minimum(size[x], size[other]) >= num * np.maximum(size[x], size[other])
        other = other[ok]
        other = other[np.bitwise_count(sk[other] ^ sk[x]).sum(1) <= limit]
        if len(other):
            roots = forest.roots()
            other = other[roots[other] != roots[x]]
        if not len(other):
            continue
        mine = ids[at[x]:at[x + 1]]
        mark[mine] = True
        common = np.add.reduceat(mark[ids[A.ranges(at[other], size[other])]].astype(np.int32),
                                 np.r_[0, np.cumsum(size[other])[:-1]])
        mark[mine] = False
        hits = other[den * common >= num * (size[x] + size[other] - common)]
        for y in hits:
            if forest.root(x) != forest.root(y):
                forest.join(x, y)
                out.append((node[x], node[y]))
    return out


def _verify(width: int, num: int, den: int, limit: float):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(group):
        node = np.concatenate([g[0] for g in group])
        block = np.concatenate([g[1] for g in group])
        sketch = sum((g[2] for g in group), [])
        sets = sum((g[3] for g in group), [])
        _, keep = np.unique(node, return_index=True)  # a repeated row is one class
        if len(keep) < len(node):
            node, block = node[keep], block[keep]
            sketch, sets = [sketch[i] for i in keep], [sets[i] for i in keep]
        same = block.min() == block.max()
        return _links(node, block, sketch, sets, same, num, den, limit) if len(node) > 1 else []

    def run(batches):
        group, key, out = [], None, []
        for batch in batches:
            comp, b1, b2, node, block = (A.column(batch, c).to_numpy() for c in ("comp", "b1", "b2", "node", "block"))
            sketch = A.column(batch, "sketch").to_pylist()
            sets = []
            for _, _, buf, off in A.pieces(A.column(batch, "text")):
                sets += shingle_sets(A.LOWER[buf], off, width)
            change = (comp[1:] != comp[:-1]) | (b1[1:] != b1[:-1]) | (b2[1:] != b2[:-1])
            cut = np.r_[0, np.flatnonzero(change) + 1, len(comp)]
            for s, e in zip(cut[:-1], cut[1:]):
                if e == s:
                    continue
                own = (comp[s], b1[s], b2[s])
                # rows of one block only, in a unit of two: nothing to compare yet
                if group and own != key:
                    out += links(group)
                    group = []
                key = own
                group.append((node[s:e], block[s:e], sketch[s:e], sets[s:e]))
            if out:
                yield A.batch_of(schema, list(zip(*out)))
                out = []
        if group:
            out = links(group)
            if out:
                yield A.batch_of(schema, list(zip(*out)))
    return run


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                    bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, th, n_shingles, component_id, kept_th.

    Documents whose shingle sets A, B have den * |A & B| >= num * |A | B| are
    linked; ``component_id`` is the smallest doc_id reachable.  ``th`` is
    xxhash64(text); (component_id, kept_th) names the row that stands for the
    component when rows share a doc_id.
    """
    parts = shuffle_parts(docs)
    sig = written(signatures(docs, width, bands, rows, bits), "signatures")
    full = sig.where("n_shingles > 0")
    classes = full.groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("low"),
        F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    classes = written(classes.select("node", "low.doc_id", "low.th", "n_shingles", "bands", "sketch"), "classes")

    rows_ = classes.select("node", F.explode("bands").alias("key"))
    # written before they are joined back: AQE can then split a hot key's join
    heads = written(rows_.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1"), "heads")
    star = rows_.join(heads, "key").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    group = components(star, "candidates")

    limit = sketch_limit(num / den, bands * rows, bits)
    member = group.withColumnRenamed("component", "comp").join(classes.drop("bands"), "node")
    blocks = written(member.groupBy("comp").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("n_shingles") / BLOCK_WORDS)).cast("int").alias("blocks")), "blocks")
    member = (member.join(blocks, "comp")
              .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")))
    member = written(member.select("comp", "node", "block", "blocks", "sketch", "doc_id", "th"), "members")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    texts = member.join(texts, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.xxhash64("text")))
    units = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.select("comp", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"),
                         "node", "block", "sketch", "text")
    links = (units.repartition(parts, "comp", "b1", "b2").sortWithinPartitions("comp", "b1", "b2")
             .mapInArrow(_verify(width, num, den, limit), "a long, b long"))
    found = components(links, "links")

    label = classes.select("node", "doc_id", "th").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    low = written(label.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("low")), "lowest")
    named = label.select("node", "component").join(low, "component").select(
        "node", F.col("low.doc_id").alias("component_id"), F.col("low.th").alias("kept_th"))
    named = written(named, "named")
    out = sig.select("doc_id", "node", "n_shingles", "th").join(
        named, (sig["node"] == named["node"]) & (F.col("n_shingles") > 0), "left")
    alone = F.col("n_shingles") == 0
    return out.select("doc_id", "th", "n_shingles",
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.when(alone, F.col("th")).otherwise(F.col("kept_th")).alias("kept_th"))


def keep_one(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each near-duplicate component (smallest
    doc_id); all columns stay.  Repeated rows (equal doc_id and text) leave one.
    Documents without words are linked with nothing and stay."""
    found = near_duplicates(docs, width, num, den)
    kept = found.where("component_id <=> doc_id and kept_th = th").select(
        F.col("doc_id").alias("__keep_one_id"), F.col("th").alias("__keep_one_th")).distinct()
    out = docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__keep_one_id"))
                    & (F.xxhash64("text") == F.col("__keep_one_th")), "left_semi")
    return out.withColumn("__keep_one_th", F.xxhash64("text")).dropDuplicates(["doc_id", "__keep_one_th"]).drop("__keep_one_th")
