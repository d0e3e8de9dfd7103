"""Singular values and right singular vectors of a small square matrix.

Householder reflections make it bidiagonal, the differential qd algorithm with
shifts (dqds) finds the singular values, and twisted factorisations of the
tridiagonal product give a vector for each.  The matrix is as large as the
vectors have dimensions, whatever the number of rows they come from.
"""

from __future__ import annotations

import math

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny
#: Values closer than this (relative) have their vectors made orthogonal to each other.
CLUSTER = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(v, beta, alpha) with (I - beta v v') x = alpha e1."""
    scale = np.abs(x).max(initial=0.0)
    v = x.astype(float).copy()
    if scale == 0 or len(x) == 1:
        return np.zeros_like(v), 0.0, float(x[0]) if len(x) else 0.0
    v /= scale
    norm = math.sqrt(float(v @ v))
    alpha = -math.copysign(norm, v[0])
    v[0] -= alpha
    beta = 2.0 / float(v @ v) if v.any() else 0.0
    return v, beta, alpha * scale


def bidiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and W with ``a = U B W'`` (B upper bidiagonal)."""
    a = np.array(a, float)
    n = a.shape[1]
    right = []
    for k in range(n):
        v, beta, alpha = _reflector(a[k:, k])
        if beta:
            a[k:, k:] -= np.outer(beta * v, v @ a[k:, k:])
        a[k, k], a[k + 1:, k] = alpha, 0.0
        if k < n - 2:
            v, beta, alpha = _reflector(a[k, k + 1:])
            if beta:
                a[k:, k + 1:] -= np.outer(a[k:, k + 1:] @ v, beta * v)
            a[k, k + 1], a[k, k + 2:] = alpha, 0.0
            right.append((k + 1, v, beta))
    w = np.eye(n)
    for at, v, beta in reversed(right):
        if beta:
            w[at:, at:] -= np.outer(beta * v, v @ w[at:, at:])
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), w


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform; None where the shift is too great."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    d = least = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return None
        new_q[i] = d + e[i]
        if new_q[i] == 0.0:
            new_e[i], d = 0.0, q[i + 1] - shift
        else:
            ratio = q[i + 1] / new_q[i]
            new_e[i] = e[i] * ratio
            d = d * ratio - shift
        least = min(least, d)
    if d < 0 or not math.isfinite(d):
        return None
    new_q[-1] = d
    return new_q, new_e, least


def _smallest_of_two(q: list[float], e: list[float]) -> float:
    """Smaller eigenvalue of the trailing two by two block."""
    a, b, c = q[-2], e[-1], q[-1]
    total, product = a + b + c, a * c
    root = math.sqrt(max(0.0, (a - c + b) ** 2 + 4 * b * c))
    largest = (total + root) / 2
    return product / largest if largest else 0.0


def _bisected(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of the qd arrays by halving intervals on sign counts: for the
    rare blocks on which the shifts make no headway (equal values)."""
    def below(x: float) -> int:
        s, n = -x, 0
        for i in range(len(q)):
            d = q[i] + s
            d = d if abs(d) > least else -least
            n += d < 0
            if i < len(e):
                s = e[i] * (s / d) - x
        return n
    top = 2.5 * (max(q) + max(e, default=0.0)) + TINY       # over every row's sum
    least = EPS * EPS * top + TINY
    out = []
    for k in range(len(q)):
        low, high = 0.0, top
        for _ in range(200):
            mid = (low + high) / 2
            if high - low <= 2 * EPS * high or mid in (low, high):
                break
            low, high = (low, mid) if below(mid) > k else (mid, high)
        out.append((low + high) / 2)
    return out


def dqds(diagonal: np.ndarray, superdiagonal: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, greatest first."""
    found: list[float] = []
    work = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in superdiagonal], 0.0)]
    while work:
        q, e, moved = work.pop()
        stuck = 0
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + moved)
                break
            floor = (16 * EPS) ** 2
            if e[-1] <= floor * (moved + q[-1]) or e[-1] < TINY:
                found.append(q[-1] + moved)
                q, e = q[:-1], e[:-1]
                stuck = 0
                continue
            if n == 2:
                low = _smallest_of_two(q, e)
                found += [moved + low, moved + (q[0] + q[1] + e[0] - low)]
                break
            split = next((i for i in range(n - 2, -1, -1) if e[i] <= floor * (moved + min(q[i], q[i + 1]))
                          or e[i] < TINY), None)
            if split is not None:
                work.append((q[:split + 1], e[:split], moved))
                q, e = q[split + 1:], e[split + 1:]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            if stuck > 60:
                found += [moved + x for x in _bisected(q, e)]
                break
            shift = _smallest_of_two(q, e) * (1 - 4 * EPS)
            while True:
                done = _step(q, e, shift)
                if done is not None:
                    break
                shift = shift / 4 if shift > EPS * EPS * (moved + q[-1]) and shift > TINY else 0.0
            q, e, _ = done
            moved += shift
            stuck += 1
    return np.sort(np.array(found))[::-1]


class _Twisted:
    """Twisted factorisation of T - value, T = L D L' the product B'B."""

    def __init__(self, d: np.ndarray, low: np.ndarray, value: float):
        n = len(d)
        floor = EPS * EPS * float(d.max(initial=TINY)) + TINY
        down, up, self.upper, self.lower = np.empty(n), np.empty(n), np.zeros(n - 1), np.zeros(n - 1)
        self.down_d, self.up_d = np.empty(n), np.empty(n)

        def safe(moved: float, fixed: float) -> tuple[float, float]:
            """``moved`` and its sum with ``fixed``, a sum of nothing being a tiny one."""
            total = moved + fixed
            return (moved, total) if abs(total) > floor else (floor - fixed, floor)
        s = -value
        for i in range(n):
            s, self.down_d[i] = safe(s, d[i])
            down[i] = s
            if i < n - 1:
                self.lower[i] = d[i] * low[i] / self.down_d[i]
                s = self.lower[i] * low[i] * s - value
        p = d[n - 1] - value
        for i in range(n - 2, -1, -1):
            p, self.up_d[i + 1] = safe(p, d[i] * low[i] * low[i])
            up[i + 1] = p
            ratio = d[i] / self.up_d[i + 1]
            self.upper[i] = low[i] * ratio
            p = p * ratio - value
        p, self.up_d[0] = safe(p, 0.0)
        up[0] = p
        gamma = down + up + value
        self.at = int(np.argmin(np.abs(gamma)))
        self.gamma = safe(float(gamma[self.at]), 0.0)[1]

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.down_d))
        z[self.at] = 1.0
        for i in range(self.at - 1, -1, -1):
            z[i] = -self.lower[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] = -self.upper[i] * z[i]
        return z

    def solve(self, b: np.ndarray) -> np.ndarray:
        """(T - value) x = b."""
        y, r = b.astype(float).copy(), self.at
        for i in range(r):
            y[i + 1] -= self.lower[i] * y[i]
        for i in range(len(y) - 2, r - 1, -1):
            y[i] -= self.upper[i] * y[i + 1]
        y[:r] /= self.down_d[:r]
        y[r + 1:] /= self.up_d[r + 1:]
        y[r] /= self.gamma
        for i in range(r - 1, -1, -1):
            y[i] -= self.lower[i] * y[i + 1]
        for i in range(r, len(y) - 1):
            y[i + 1] -= self.upper[i] * y[i]
        return y


def _vectors(diagonal: np.ndarray, superdiagonal: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of B'B for ``values`` (greatest first), one a row."""
    n = len(diagonal)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(superdiagonal).max(initial=0.0)))
    b = np.where(np.abs(diagonal) < EPS * EPS * norm, EPS * EPS * norm, diagonal)
    if n == 1:
        return np.ones((len(values), 1))
    d, low = b * b, superdiagonal / b[:-1]
    out: list[np.ndarray] = []
    for k, value in enumerate(values):
        near = [out[j] for j in range(k) if values[j] - value <= CLUSTER * max(values[j], TINY)]
        at = float(value)
        for _ in range(3):
            factors = _Twisted(d, low, at)
            z = factors.vector()
            size = float(z @ z)
            if not math.isfinite(size) or size == 0:
                z = np.nan_to_num(z, nan=0.0, posinf=0.0, neginf=0.0)
                break
            moved = factors.gamma / size
            if abs(moved) <= 2 * EPS * abs(at):
                break
            if any(abs(moved) > 0.1 * abs(at - v) for j, v in enumerate(values) if j != k):
                break                       # too near another value to be moved safely
            at += moved
        z = z / (math.sqrt(float(z @ z)) or 1.0)
        for _ in range(2):
            for v in near:
                z = z - (v @ z) * v
        if math.sqrt(float(z @ z)) < 0.5:   # equal values: a start outside the vectors found
            z = np.cos(np.arange(n) * (k + 1.0) + 0.5)
            for _ in range(4):
                for _ in range(2):
                    for v in near:
                        z = z - (v @ z) * v
                z = factors.solve(z / math.sqrt(float(z @ z)))
                z = np.nan_to_num(z, nan=0.0, posinf=0.0, neginf=0.0)
                z /= np.abs(z).max() or 1.0
                for _ in range(2):
                    for v in near:
                        z = z - (v @ z) * v
                z /= math.sqrt(float(z @ z)) or 1.0
        z = z / (math.sqrt(float(z @ z)) or 1.0)
        astray = [v for v in out if abs(float(v @ z)) > 1000 * EPS]
        for v in astray:                    # a start that near vectors nearly spanned leaves rounding errors
            z = z - (v @ z) * v
        z = z / (math.sqrt(float(z @ z)) or 1.0) if astray else z
        out.append(z)
    return np.array(out)


def singular(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Squares of all singular values of ``r``, greatest first, and the right
    singular vectors of the first ``k``, one a row."""
    n = r.shape[1]
    if len(r) < n:
        r = np.vstack([r, np.zeros((n - len(r), n))])
    scale = float(np.abs(r).max(initial=0.0))
    if scale == 0:
        return np.zeros(n), np.eye(n)[:k]
    diagonal, superdiagonal, w = bidiagonal(r / scale)
    small = np.abs(superdiagonal) <= EPS / 16 * np.maximum(np.abs(diagonal[:-1]), np.abs(diagonal[1:]))
    ends = [*(np.flatnonzero(small) + 1).tolist(), n]
    blocks = []                                   # (squares, first, end) of what hangs together
    for first, end in zip([0, *ends], ends):
        blocks.append((dqds(diagonal[first:end], superdiagonal[first:end - 1]), first, end))
    greatest = sorted(((-x, b, j) for b, (found, _, _) in enumerate(blocks) for j, x in enumerate(found)))
    wanted: dict[int, int] = {}                   # block -> how many of its values come among the first k
    for _, b, _ in greatest[:k]:
        wanted[b] = wanted.get(b, 0) + 1
    rows = {}
    for b, many in wanted.items():
        found, first, end = blocks[b]
        for j, z in enumerate(_vectors(diagonal[first:end], superdiagonal[first:end - 1], found[:many])):
            rows[b, j] = np.concatenate([np.zeros(first), z, np.zeros(n - end)])
    vectors = np.array([rows[b, j] for _, b, j in greatest[:k]])
    return np.array([-x for x, _, _ in greatest]) * scale * scale, vectors @ w.T
