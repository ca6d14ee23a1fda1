"""Operator 7: quality score by hashed word n-grams and FTRL.

A text's features are hashed unigrams and bigrams of its lower-cased words and
of its words' shapes (runs of capital, small letter, digit or one symbol).  The
score is the logistic function of a sparse dot product in which each of the
four kinds of n-gram has its mean weight, so length has no say.

The model is a logistic regression trained with follow-the-regularised-leader
updates.  Training rows are dealt to ``SHARDS`` tasks by a hash of their id;
each runs ``EPOCHS`` passes over its rows in a fixed order, and the weights are
averaged.  At most about ``MAX_ROWS`` labelled rows are used, chosen by a hash
of their id; the model is ``2**BITS`` floats, whatever the input.

Cases.  Null or empty text: no features, the score of the bias.  Null labels
and labels of null ids are left out; rows that label one document twice count
once, as the larger label.  No usable labels: every score is 0.5.  No documents
give no rows.  Extra columns are ignored, or kept by ``accepted``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import arrays as A

BITS = 18
#: about so many labelled rows are learnt from
MAX_ROWS = 20_000
SHARDS, EPOCHS, SCALE = 4, 3, 8.0
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
KINDS = 4

_shape = np.arange(256, dtype=np.uint8)
_shape[65:91] = 65
_shape[97:123] = 97
_shape[48:58] = 48
_shape[128:] = 97


def features(buf, off):
    """Hashed features [kind][n-grams] of the texts, each kind with the bounds
    of its texts."""
    starts, ends, first = A.find_words(buf, off, A.SPACED)
    out = []
    mask = A.U((1 << BITS) - 1)
    lower = A.word_hashes(A.LOWER[buf], starts, ends)
    kinds = _shape[buf]
    new = np.ones(len(kinds), bool)
    if len(kinds):
        new[1:] = kinds[1:] != kinds[:-1]
        new[starts] = True
    place = np.r_[0, np.cumsum(new)]
    shapes = A.mix(A.span_hash(A.prefix_hash(A.BYTE_VALUE[kinds[new]], A.BASE), place[starts], place[ends], A.BASE))
    for salt, words in ((1, lower), (2, shapes)):
        salted = A.mix(words + A.U(salt))
        out.append(((salted & mask).astype(np.int32), first))
        two, _, counts = A.window_hashes(salted, first, 2)
        out.append(((two & mask).astype(np.int32), np.r_[0, np.cumsum(counts)]))
    return out


def _sums(values, bounds):
    """Sums of values between bounds."""
    return np.diff(np.r_[0.0, np.cumsum(values, dtype=np.float64)][bounds])


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Scores of an Arrow column of texts; the last weight is the bias."""
    out = []
    for _, _, buf, off in A.pieces(texts):
        z = np.full(len(off) - 1, float(weights[-1]))
        for idx, bounds in features(buf, off):
            z += SCALE * _sums(weights[idx], bounds) / np.maximum(np.diff(bounds), 1)
        out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
    return np.concatenate(out) if out else np.zeros(0)


class Ftrl:
    """Follow-the-regularised-leader, proximal form, per coordinate."""

    def __init__(self, size):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, i=slice(None)):
        z, n = self.z[i], self.n[i]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, i, x, label):
        w = self.weights(i)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        g = (p - label) * x
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[i] = n + g * g


def _train(batches):
    rows = []
    for batch in batches:
        label, ids = A.column(batch, "label").to_numpy(), A.column(batch, "doc_id").to_numpy()
        for i, j, buf, off in A.pieces(A.column(batch, "text")):
            kinds = features(buf, off)
            for r in range(j - i):
                parts, values = [np.array([1 << BITS])], [np.ones(1)]
                for idx, bounds in kinds:
                    own, count = np.unique(idx[bounds[r]:bounds[r + 1]], return_counts=True)
                    parts.append(own)
                    values.append(SCALE * count / max(1, count.sum()))
                at, back = np.unique(np.concatenate(parts), return_inverse=True)
                rows.append((ids[i + r], label[i + r], at.astype(np.int32), np.bincount(back, np.concatenate(values)).astype(np.float32)))
    if not rows:
        return
    rows.sort(key=lambda r: r[0])
    order = np.random.Generator(np.random.PCG64(11))
    model = Ftrl((1 << BITS) + 1)
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            _, y, at, x = rows[k]
            model.learn(at, x.astype(np.float64), y)
    yield pa.RecordBatch.from_arrays([pa.array([model.weights().astype(np.float32).tobytes()]), pa.array([len(rows)], pa.int64())],
                                     names=["weights", "n"])


def held_out(doc_id):
    """Rows that are never learnt from: crc32 of the id's text mod 3 is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights (2**BITS and the bias) learnt from ``labels`` (doc_id, label)."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    rows = rows.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    n = rows.count()
    if n > max_rows:
        rows = rows.where(F.shiftrightunsigned(F.xxhash64(F.lit(3), "doc_id"), 1) < F.lit((max_rows << 63) // n))
        if rows.isEmpty():
            raise ValueError(f"none of {n} labelled rows was drawn for a sample of {max_rows}")
    # bounded by max_rows, so the documents need not be shuffled to meet it
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(rows), "doc_id").withColumn("th", F.xxhash64("text")).dropDuplicates(["doc_id", "th"]).drop("th")
    parts = texts.repartition(SHARDS, F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(64))).mapInArrow(_train, "weights binary, n long").collect()
    total = sum(r["n"] for r in parts)
    out = np.zeros((1 << BITS) + 1, np.float64)
    for r in parts:
        out += np.frombuffer(r["weights"], np.float32) * (r["n"] / total)
    return out.astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, score."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([A.column(batch, "doc_id"), pa.array(scores(A.column(batch, "text"), shared.value))], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, score double")


def accepted(docs: DataFrame, weights: np.ndarray, least: float = 0.5) -> DataFrame:
    """``docs`` with a score of ``least`` or more; all columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores(A.column(batch, "text"), shared.value) >= least))

    return docs.mapInArrow(run, docs.schema)
