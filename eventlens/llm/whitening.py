"""Operator 11: whitening of embeddings by a blockwise QR and a qd solver.

Entries become integers ``x = floor(64 c) + 1000000``; the fit list is each
distinct x vector once (n of them, sums S).  Each task reduces its centred rows
block by block to one triangle by QR, the triangles are reduced 16 at a time, and
the last one, d x d for d dimensions, has all there is to know: its right
singular vectors are the eigenvectors of the covariance V and its squared
singular values n times the eigenvalues.  They come from :mod:`qd` (Householder
bidiagonalisation, dqds, twisted factorisations).  V itself is never formed, so
small eigenvalues keep their digits.

What travels: each x vector once (``distinct``, its copies merged before the
shuffle), d x d numbers a task, d sums a task.  The driver holds a few d x d
triangles; d is bounded by ``MAX_WIDTH``.

Cases.  Null vectors, and those with null or non-finite entries, or entries of
2**50 and more (whose x has no exact double), are dropped, as the contract says
for the first three.  Vectors of another length than the commonest (of equally
common ones: the longest) are not of the space and are dropped.  Repeated rows
and repeated vectors each get their rows.  Directions whose spread is under 1e-11
of the largest have no whitened value and no component, so one distinct vector
has none.  A deviation of 2**63 or more is null.  No rows give no rows.  Extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm import arrays as A
from eventlens.llm import qd
from eventlens.llm.spill import written

STEP, SHIFT = 64, 1_000_000
LARGEST = 2.0 ** 50
#: triangles that one task reduces to one
FAN_IN = 16
MAX_WIDTH = 4096


def _encode(batches):
    """Rows with a usable vector: vec_id, x - SHIFT as binary."""
    for batch in batches:
        vectors = A.column(batch, "embedding")
        size = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = vectors.flatten().cast(pa.float64())
        values = np.nan_to_num(flat.fill_null(np.nan).to_numpy(zero_copy_only=False), nan=np.inf)
        row = np.repeat(np.arange(len(size)), np.maximum(size, 0))
        good = size > 0
        good[row[~(np.abs(values) < LARGEST)]] = False
        x = np.floor(STEP * np.where(np.abs(values) < LARGEST, values, 0)).astype(np.int64)
        at = np.r_[0, np.cumsum(np.maximum(size, 0))]
        # zigzag byte planes: the upper ones are zeros, which compress
        packed = [A.planes((x[a:b] << 1) ^ (x[a:b] >> 63)) for a, b in zip(at[:-1][good], at[1:][good])]
        ids = A.column(batch, "vec_id").take(pa.array(np.flatnonzero(good)))
        yield pa.RecordBatch.from_arrays([ids, pa.array(packed, pa.binary())], names=["vec_id", "x"])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 8, width)
    zigzag = np.ascontiguousarray(raw.transpose(0, 2, 1)).view(np.uint64).reshape(-1, width)
    return (zigzag >> np.uint64(1)).view(np.int64) ^ -(zigzag & np.uint64(1)).view(np.int64)


@dataclass
class Fit:
    """n, S - n * SHIFT as Python integers, and what comes of them."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray  # columns
    trace: float

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact (Python integers where 64 bits don't do)."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        if most < 1 << 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.numerators(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        y = self.numerators(x)
        if y.dtype != object and y.shape[1] * int(np.abs(y).max(initial=0)) ** 2 < 1 << 63:
            return (y * y).sum(1).tolist()
        y = y.astype(object)
        return [int(v) if v < 1 << 63 else None for v in (y * y).sum(1)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.eigenvalues))


def _sums(width: int):
    schema = pa.schema([("dim", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])

    def run(batches):
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            x = _matrix(A.column(batch, "x"), width)
            n += len(x)
            small = len(x) * int(np.abs(x).max(initial=0)) < 1 << 62
            total = total + (x.sum(0) if small else x.astype(object).sum(0)).astype(object)
        if n:
            yield A.batch_of(schema, (np.arange(width), np.full(width, n), [Decimal(int(t)) for t in total]))
    return run


def _triangles(fit: Fit, width: int):
    schema = pa.schema([("id", pa.int64()), ("r", pa.binary())])

    def run(batches):
        r = np.zeros((0, width))
        for batch in batches:
            r = np.linalg.qr(np.concatenate([r, fit.centred(_matrix(A.column(batch, "x"), width))]), mode="r")
        if len(r):
            yield A.batch_of(schema, ([TaskContext.get().partitionId()], [r.tobytes()]))
    return run


def _reduced(width: int):
    def run(table: pa.Table) -> pa.Table:
        stack = [np.frombuffer(r, float).reshape(-1, width) for _, r in sorted(zip(table["id"].to_pylist(), table["r"].to_pylist()))]
        r = np.linalg.qr(np.concatenate(stack), mode="r")
        return pa.table({"id": pa.array([min(table["id"].to_pylist()) // FAN_IN], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})
    return run


def triangle(distinct: DataFrame, fit: Fit, width: int) -> np.ndarray:
    """The triangle of the QR of all centred rows."""
    rows = written(distinct.mapInArrow(_triangles(fit, width), "id long, r binary"), "triangles")
    top = rows.agg(F.max("id")).first()[0]
    while top:
        rows = rows.groupBy(F.floor(F.col("id") / FAN_IN)).applyInArrow(_reduced(width), "id long, r binary")
        top //= FAN_IN
    return np.frombuffer(bytes(rows.first()["r"]), float).reshape(-1, width)


def encoded(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, x) of the usable vectors, written, and their length."""
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    rows = written(embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(
        _encode, f"vec_id {kind}, x binary"), "vectors")
    size = rows.groupBy((F.octet_length("x") / 8).cast("int").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = size["width"] if size else 0
    if width > MAX_WIDTH:
        raise ValueError(f"vectors of {width} entries: a triangle of more than {MAX_WIDTH} columns is too large for a task")
    return rows.where(F.octet_length("x") == 8 * width), width


def fit(rows: DataFrame, width: int, most: int = 16) -> tuple[Fit | None, DataFrame]:
    """The fit over the distinct vectors of ``encoded`` rows, and these."""
    distinct = written(rows.select("x").distinct(), "distinct-vectors")
    sums = distinct.mapInArrow(_sums(width), "dim int, n long, total decimal(38, 0)")
    sums = sums.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim").collect()
    if not sums:
        return None, distinct
    found = Fit(sums[0]["n"], [int(r["total"]) for r in sums], np.zeros(0), np.zeros((width, 0)), 0.0)
    r = triangle(distinct, found, width)
    square = np.zeros((width, width))
    square[:len(r)] = r
    sigma, found.components = qd.leading(square, most)
    found.eigenvalues, found.trace = sigma ** 2 / found.n, float((square ** 2).sum() / found.n)
    return found, distinct


def _products(fit: Fit, width: int):
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.float64())])

    def run(batches):
        k = len(fit.eigenvalues)
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = fit.whitened(_matrix(A.column(batch, "x"), width))
            w = np.concatenate([w, np.ones((len(w), 1))], 1)
            total += w.T @ w
        i, j = np.divmod(np.arange((k + 1) ** 2), k + 1)
        yield A.batch_of(schema, (i, j, total.ravel()))
    return run


def identity_error(distinct: DataFrame, found: Fit, width: int) -> float:
    """Largest absolute entry of the measured covariance of the whitened fit
    list minus the identity."""
    k = len(found.eigenvalues)
    total = np.zeros((k + 1, k + 1))
    for r in distinct.mapInArrow(_products(found, width), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        total[r["i"], r["j"]] = r["s"]
    mean = total[k, :k] / found.n
    return float(np.abs(total[:k, :k] / found.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def _whiten(found: Fit, width: int):
    def run(batches):
        for batch in batches:
            x = _matrix(A.column(batch, "x"), width)
            w = found.whitened(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([A.column(batch, "vec_id"), pa.array(found.deviations(x), pa.int64()), lists],
                                             names=["vec_id", "deviation", "whitened"])
    return run


def whiten(embeddings: DataFrame, most: int = 16) -> tuple[DataFrame, Fit | None, float]:
    """(vec_id, deviation, whitened: array of at most ``most``), the fit, and the
    identity error."""
    rows, width = encoded(embeddings)
    found, distinct = fit(rows, width, most)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, deviation long, whitened array<double>"
    if found is None:
        return rows.select("vec_id", F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")), None, 0.0
    return rows.mapInArrow(_whiten(found, width), schema), found, identity_error(distinct, found, width)
