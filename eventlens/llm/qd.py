"""Singular values and right singular vectors of a small square matrix by the
bidiagonal qd method: Householder reflections to upper bidiagonal form, dqds for
the singular values (to high relative accuracy), twisted factorisations of
``L D L^T - lambda`` for the vectors.

The matrix is d x d for d columns of a table, so it is small whatever the number
of rows; it costs O(d**3).
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
#: eigenvalues that differ by less, relatively, are taken as one cluster
CLUSTER = 1e-6


def bidiagonal(r: np.ndarray):
    """(a, b, w): r = u @ B @ w.T with orthogonal u and w, and B upper bidiagonal
    with diagonal ``a`` and superdiagonal ``b``."""
    r = np.array(r, float)
    d = len(r)
    w = np.eye(d)

    def reflector(x):
        """v with norm 1 or 0: x - 2 v (v @ x) has zeros after its first entry."""
        v = x.copy()
        if not np.any(x[1:]):
            return np.zeros_like(v)
        scale = np.abs(x).max()
        v /= scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        v = reflector(r[k:, k])
        r[k:, k:] -= 2 * np.outer(v, v @ r[k:, k:])
        if k + 1 < d:
            v = reflector(r[k, k + 1:])
            r[k:, k + 1:] -= 2 * np.outer(r[k:, k + 1:] @ v, v)
            w[:, k + 1:] -= 2 * np.outer(w[:, k + 1:] @ v, v)
    return np.diag(r).copy(), np.diag(r, 1).copy(), w


def _sweep(q, e, s):
    """One dqds transform with shift s: (q, e, place of the first negative d)."""
    m = len(q)
    new_q, new_e, d = [0.0] * m, [0.0] * (m - 1), q[0] - s
    for k in range(m - 1):
        if d < 0:
            return new_q, new_e, k, d
        new_q[k] = d + e[k]
        t = q[k + 1] / new_q[k] if new_q[k] > 0 else 1.0
        new_e[k] = e[k] * t
        d = d * t - s
    new_q[m - 1] = d
    return new_q, new_e, (m - 1 if d < 0 else None), d


def _bottom(q, e):
    """The smaller eigenvalue of the last two rows."""
    m = len(q)
    x, z = q[m - 2] + (e[m - 3] if m > 2 else 0.0), q[m - 1] + e[m - 2]
    off = q[m - 2] * e[m - 2]
    half = (x - z) / 2
    return z - off / (abs(half) + (half * half + off) ** 0.5) if half >= 0 and off > 0 else min(x, z) - (
        off / (abs(half) + (half * half + off) ** 0.5) if off > 0 else 0.0)


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the upper bidiagonal (a, b), falling."""
    top = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if top == 0:
        return np.zeros(len(a))
    found = []
    todo = [([float(x) for x in (a / top) ** 2], [float(x) for x in (b / top) ** 2], 0.0)]
    while todo:
        q, e, sigma = todo.pop()
        for _ in range(60 * len(q) + 100):
            if len(q) == 1:
                break
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS * EPS * (sigma + q[k + 1]) or (sigma == 0 and q[k] == e[k] == 0)), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], sigma))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if 1.5 * q[0] < q[-1]:  # the small values go to the end
                q, e = q[::-1], e[::-1]
            s = max(0.0, min(_bottom(q, e), min(q)))
            for attempt in range(8):
                new_q, new_e, bad, d = _sweep(q, e, s)
                if bad is None:
                    break
                # a late failure tells the eigenvalue almost exactly
                s = s + d if bad == len(q) - 1 and attempt < 3 and s + d > 0 else s / 4 if attempt < 5 else 0.0
            q, e, sigma = new_q, new_e, sigma + s
            if q[-1] < 0:
                q[-1] = 0.0
        else:
            raise ArithmeticError("dqds has not converged")
        found.append(q[0] + sigma)
    return np.sort(np.array(found))[::-1] * top * top


def twisted(a: np.ndarray, b: np.ndarray, lam: float) -> np.ndarray:
    """Unit eigenvector of B^T B = L D L^T next to the eigenvalue ``lam``."""
    n, tiny = len(a), EPS * EPS * max(lam, 1e-300)
    dd = a * a
    ell = np.divide(b, a[:-1], out=np.zeros(n - 1), where=a[:-1] != 0)
    safe = lambda x: x if abs(x) > tiny else (tiny if x >= 0 else -tiny)
    s, plus = np.zeros(n), np.zeros(n - 1)
    s[0] = -lam
    for i in range(n - 1):
        plus[i] = dd[i] * ell[i] / safe(s[i] + dd[i])
        s[i + 1] = plus[i] * ell[i] * s[i] - lam
    p, minus = np.zeros(n), np.zeros(n - 1)
    p[n - 1] = dd[n - 1] - lam
    for i in range(n - 2, -1, -1):
        t = dd[i] / safe(dd[i] * ell[i] * ell[i] + p[i + 1])
        minus[i] = ell[i] * t
        p[i] = p[i + 1] * t - lam
    k = int(np.argmin(np.abs(s + p + lam)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -minus[i] * z[i]
    return z / np.linalg.norm(z)


def _cluster(a, b, lams):
    """Orthonormal vectors for eigenvalues that are nearly one: inverse iteration
    of a block, then rotations (Jacobi) inside it."""
    n = len(a)
    t = np.diag(a * a + np.r_[0, b * b]) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    mid = lams.mean() * (1 + 4 * EPS) + EPS * EPS
    x = np.linalg.qr(np.random.default_rng(7).standard_normal((n, len(lams))))[0]
    for _ in range(3):
        x = np.linalg.qr(np.linalg.solve(t - mid * np.eye(n), x))[0]
    bx = a[:, None] * x + np.r_[b[:, None] * x[1:], np.zeros((1, len(lams)))]
    for _ in range(30):
        worst = 0.0
        for i in range(len(lams)):
            for j in range(i + 1, len(lams)):
                p, q, r = bx[:, i] @ bx[:, i], bx[:, j] @ bx[:, j], bx[:, i] @ bx[:, j]
                if abs(r) <= EPS * (p * q) ** 0.5:
                    continue
                worst = max(worst, abs(r) / (p * q) ** 0.5)
                angle = 0.5 * np.arctan2(2 * r, p - q)
                turn = np.array([[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]])
                x[:, [i, j]], bx[:, [i, j]] = x[:, [i, j]] @ turn, bx[:, [i, j]] @ turn
        if worst <= EPS:
            break
    return x[:, np.argsort(-(bx * bx).sum(0), kind="stable")]


def leading(r: np.ndarray, most: int, floor: float = 1e-11):
    """(singular values, right singular vectors as columns) of the ``most``
    largest singular values of r over ``floor`` times the largest, falling."""
    scale = np.abs(r).max(initial=0.0)
    if scale == 0:
        return np.zeros(0), np.zeros((len(r), 0))
    a, b, w = bidiagonal(r / scale)
    lam = dqds(a, b)
    keep = min(most, int((lam > floor * floor * lam[0]).sum()))
    vectors, i = [], 0
    while i < keep:
        j = i + 1
        while j < len(lam) and lam[j - 1] - lam[j] <= CLUSTER * lam[j - 1]:
            j += 1
        vectors.append(twisted(a, b, lam[i])[:, None] if j == i + 1 else _cluster(a, b, lam[i:j]))
        i = j
    return np.sqrt(lam[:keep]) * scale, w @ np.concatenate(vectors, 1)[:, :keep]
