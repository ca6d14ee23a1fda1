"""Operator 11 against numpy's eigenvectors."""

import math

import numpy as np
import pytest

from eventlens.llm import qd, queries, whitening

SCHEMA = "vec_id long, embedding array<float>, x string, r string, n string"


def brute(rows, most=16):
    """{(vec_id, x): (deviation, whitened)} and explained shares, by eigh."""
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in v)) for i, v in rows]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    lam, vec = np.linalg.eigh(y.T @ y / n)
    lam, vec = lam[::-1][:most], vec[:, ::-1][:, :most]
    white = lambda x: np.array([(n * c - s) / n for c, s in zip(x, sums)]) @ vec / np.sqrt(lam)
    return [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums)), white(x)) for i, x in xs], lam / (y * y).sum() * n, n


def check(rows, got, fit, error, most=16):
    expected, share, n = brute(rows, most)
    assert fit.n == n and error <= 1e-9
    assert np.allclose(fit.eigenvalues / fit.trace, share[:len(fit.eigenvalues)], rtol=1e-9)
    got = sorted(got, key=lambda r: (repr(r.vec_id), r.deviation))
    expected.sort(key=lambda r: (repr(r[0]), r[1]))
    assert [(r.vec_id, r.deviation) for r in got] == [r[:2] for r in expected]
    a, b = np.array([r.whitened for r in got]), np.array([r[2] for r in expected])[:, :len(fit.eigenvalues)]
    assert np.allclose(a, b * np.sign((a * b).sum(0)), atol=1e-7)


def test_whitening(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((400, 24)) * np.linspace(3, 0.3, 24) + 0.5
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(base)]
    rows += [(i + 1000, rows[7][1]) for i in range(300)] + [(7, rows[7][1]), (None, rows[8][1])]
    odd = [(2000, None), (2001, [None] * 24), (2002, [float("nan")] * 24), (2003, [1.0] * 23 + [float("inf")]), (2004, [1e30] * 24),
           (2005, [1.0, 2.0]), (2006, [])]
    df = spark.createDataFrame([(*r, "x", "r", "n") for r in rows + odd], SCHEMA).repartition(7)
    out, fit, error = whitening.whiten(df)
    check(rows, out.collect(), fit, error)


def test_few_rows_and_no_rows(spark):
    df = spark.createDataFrame([(i, [float(i), float(i % 2), 5.0], "x", "r", "n") for i in range(4)], SCHEMA)
    out, fit, error = whitening.whiten(df)
    assert len(fit.eigenvalues) == 2 and error <= 1e-9 and all(len(r.whitened) == 2 for r in out.collect())
    out, fit, _ = whitening.whiten(df.limit(1))
    assert len(fit.eigenvalues) == 0 and [(r.vec_id, r.deviation, r.whitened) for r in out.collect()] == [(0, 0, [])]
    out, fit, _ = whitening.whiten(df.limit(0))
    assert fit is None and out.count() == 0


def test_large_entries_are_exact(spark):
    rows = [(i, [float(2 ** 40 * i), float(i % 3)]) for i in range(1, 40)]
    df = spark.createDataFrame([(*r, "x", "r", "n") for r in rows], SCHEMA)
    out, fit, error = whitening.whiten(df)
    expected = {i: d if d < 1 << 63 else None for i, d, _ in brute(rows, 2)[0]}
    assert {r.vec_id: r.deviation for r in out.collect()} == expected and error <= 1e-6


def test_query_rows(spark):
    r = queries.op11_whitening(spark, "/root/testdata/sf0.001").collect()
    ids = {x.vec_id for x in r}
    assert len(r) == 16 * len(ids) and {x.component for x in r} == set(range(1, 17)) and r[0].identity_error <= 1e-4
    w = np.array([x.whitened for x in sorted(r, key=lambda x: (x.vec_id, x.component))]).reshape(-1, 16)
    assert np.abs(w.T @ w / len(w) - np.eye(16)).max() < 1e-9


@pytest.mark.parametrize("kind", ["random", "graded", "equal", "zeros", "one", "near"])
def test_singular_values_and_vectors(kind):
    rng = np.random.default_rng(11)
    d = 1 if kind == "one" else 40
    m = rng.standard_normal((d, d))
    if kind == "graded":
        m = m * np.logspace(0, -9, d)
    if kind in ("equal", "near"):
        u, _, v = np.linalg.svd(m)
        m = u @ np.diag(np.repeat([5, 3, 1, 0.5], 10) * (1 + (1e-9 * np.arange(d) if kind == "near" else 0))) @ v
    if kind == "zeros":
        m[:, 5:15] = 0
    r = np.linalg.qr(m, mode="r")
    s, v = qd.leading(r, d, floor=1e-14)
    true = np.linalg.svd(r, compute_uv=False)[:len(s)]
    assert len(s) == (30 if kind == "zeros" else d)
    assert np.allclose(s, true, rtol=1e-10 if kind != "graded" else 1e-6, atol=1e-14 * true[0])
    assert np.abs(v.T @ v - np.eye(len(s))).max() < 1e-9
    assert np.abs(np.linalg.norm(r @ v, axis=0) - s).max() < 1e-9 * s[0]
    assert np.abs(r.T @ (r @ v) - v * s ** 2).max() < 1e-11 * s[0] ** 2


def test_dqds_keeps_digits_of_small_values():
    a, b = np.logspace(0, -12, 30), np.logspace(0, -12, 30)[1:] * 0.5
    from fractions import Fraction
    lam = qd.dqds(a, b)
    # the product of all is that of the diagonal, which is exact to rounding only if the small ones are
    exact = np.prod([Fraction(float(x)) for x in a])
    got = np.prod([Fraction(float(x)) for x in np.sqrt(lam)])
    assert abs(float(got / exact) - 1) < 1e-12
