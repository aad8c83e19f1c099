"""Singular values and right singular vectors of one small square matrix.

Householder reflections make the matrix upper bidiagonal; the differential qd
algorithm with shifts (dqds) finds every squared singular value to high relative
accuracy; the wanted vectors of the bidiagonal come from twisted factorisations
and go back through the reflections.

The side of the matrix is the width of the data, never its length.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Off-diagonals below this share of their neighbours are zero (squared: in qd terms).
NEGLIGIBLE = (100 * EPS) ** 2
#: Values closer than this, relative to the larger, have their vectors made orthogonal.
CLOSE = 1e-3


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, superdiagonal, right reflection vectors) of a square matrix; reflection ``k``
    acts on the coordinates from ``k + 1``."""
    a = np.array(matrix, float)
    d = len(a)
    right = []

    def reflect(x: np.ndarray) -> tuple[np.ndarray, float]:
        """Unit v with (1 - 2 v v') x = (alpha, 0, ..)."""
        size = np.linalg.norm(x)
        if size == 0:
            return np.zeros_like(x), 0.0
        alpha = -size if x[0] > 0 else size
        v = x / size
        v[0] -= alpha / size
        return v / np.linalg.norm(v), alpha

    for k in range(d):
        v, _ = reflect(a[k:, k].copy())
        a[k:, k:] -= 2.0 * np.outer(v, v @ a[k:, k:])
        if k + 2 < d:
            v, _ = reflect(a[k, k + 1:].copy())
            a[k:, k + 1:] -= 2.0 * np.outer(a[k:, k + 1:] @ v, v)
            right.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _dqd(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One differential qd step: (q, e) of the array shifted down by ``shift``, and the least pivot (below 0: too far)."""
    n = len(q)
    q2, e2 = [0.0] * n, [0.0] * (n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        q2[i] = d + e[i]
        if q2[i] == 0.0:
            ratio = 0.0 if q[i + 1] == 0.0 else q[i + 1] / EPS ** 4
            e2[i], d = 0.0, (q[i + 1] if d == 0.0 else d * ratio) - shift
        else:
            ratio = q[i + 1] / q2[i]
            e2[i] = e[i] * ratio
            d = d * ratio - shift
        if d < least:
            least = d
    q2[n - 1] = d
    return q2, e2, least


def _safe_shift(q: list[float], e: list[float]) -> float:
    """A lower bound of the smallest value: one over the trace of the inverse."""
    total, row = 0.0, 0.0
    for i in range(len(q)):
        if q[i] <= 0.0:
            return 0.0
        # Column i of the inverse bidiagonal has squared norm (1 + e[i-1] * that of column i - 1) / q[i].
        row = (1.0 + (e[i - 1] * row if i else 0.0)) / q[i]
        total += row
    return (1.0 - 100 * len(q) * EPS) / total if np.isfinite(total) and total > 0 else 0.0


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """All values of the qd array (squared singular values of the bidiagonal with diagonal sqrt(q) and
    superdiagonal sqrt(e)), falling."""
    found: list[float] = []
    work = [([float(x) for x in q], [float(x) for x in e], 0.0)]
    while work:
        q_, e_, sigma = work.pop()
        steps, guess = 0, 0.0
        while q_:
            n = len(q_)
            if n == 1:
                found.append(max(q_[0], 0.0) + sigma)
                break
            if e_[-1] <= NEGLIGIBLE * (sigma + q_[-1]):
                found.append(max(q_[-1], 0.0) + sigma)
                q_, e_, guess = q_[:-1], e_[:-1], 0.0
                continue
            cut = next((i for i in range(n - 2, -1, -1) if e_[i] <= NEGLIGIBLE * (sigma + min(q_[i], q_[i + 1]))), None)
            if cut is not None:
                work.append((q_[:cut + 1], e_[:cut], sigma))
                q_, e_, guess = q_[cut + 1:], e_[cut + 1:], 0.0
                continue
            if 1.5 * q_[0] < q_[-1]:
                # Graded the wrong way: the same values, read from the other end.
                q_, e_ = _reversed(q_, e_)
            steps += 1
            if steps > 60 * len(q):
                raise ArithmeticError("dqds did not converge")
            for shift in (min(guess, _corner(q_, e_)), _safe_shift(q_, e_), 0.0):
                q2, e2, least = _dqd(q_, e_, shift)
                if least >= 0.0 or shift == 0.0:
                    break
            q_, e_, sigma, guess = q2, e2, sigma + shift, least
    return np.array(sorted(found, reverse=True))


def _reversed(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """The qd array of the reversed bidiagonal: its transpose read backwards."""
    # B = diag(sqrt q) + super(sqrt e); J B' J has the same singular values and is upper bidiagonal.
    return q[::-1], e[::-1]


def _corner(q: list[float], e: list[float]) -> float:
    """Smaller value of the last two rows of the tridiagonal, a little below: near the smallest value at convergence."""
    a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
    mid, half = (a + b) / 2, (a - b) / 2
    return max(0.0, (mid - np.sqrt(half * half + c)) * (1 - 4 * EPS))


class _Block:
    """An unreduced bidiagonal block; T = B'B = L D L'."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) or 1.0
        self.tiny = (scale * EPS) ** 2
        a = np.where(np.abs(a) < scale * EPS, scale * EPS, a)
        self.d, self.l = (a * a).tolist(), (b / a[:-1]).tolist()
        self.n = len(a)

    def twisted(self, value: float) -> tuple[np.ndarray, float]:
        """(z, gamma): z solves (T - value) z = gamma * unit vector at the twist, with the least gamma."""
        n, d, l, tiny = self.n, self.d, self.l, self.tiny
        s, lower = [0.0] * n, [0.0] * (n - 1)
        s[0] = -value
        for i in range(n - 1):  # stationary: L D L' - value = L+ D+ L+'
            pivot = s[i] + d[i]
            if abs(pivot) < tiny:
                pivot = -tiny
            lower[i] = d[i] * l[i] / pivot
            s[i + 1] = lower[i] * l[i] * s[i] - value
        p, upper = [0.0] * n, [0.0] * (n - 1)
        p[n - 1] = d[n - 1] - value
        for i in range(n - 2, -1, -1):  # progressive: L D L' - value = U- D- U-'
            pivot = d[i] * l[i] * l[i] + p[i + 1]
            if abs(pivot) < tiny:
                pivot = -tiny
            ratio = d[i] / pivot
            upper[i] = l[i] * ratio
            p[i] = p[i + 1] * ratio - value
        gamma = [s[i] + p[i] + value for i in range(n)]
        r = min(range(n), key=lambda i: abs(gamma[i]))
        z = np.zeros(n)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -lower[i] * z[i + 1]
        for i in range(r, n - 1):
            z[i + 1] = -upper[i] * z[i]
        return z, gamma[r]

    def solve(self, value: float, y: np.ndarray) -> np.ndarray:
        """x with (T - value) x = y, through the stationary factorisation."""
        n, d, l, tiny = self.n, self.d, self.l, self.tiny
        lower, pivots, s = [0.0] * (n - 1), [0.0] * n, -value
        for i in range(n):
            pivots[i] = s + d[i]
            if abs(pivots[i]) < tiny:
                pivots[i] = -tiny
            if i < n - 1:
                lower[i] = d[i] * l[i] / pivots[i]
                s = lower[i] * l[i] * s - value
        x = y.astype(float).copy()
        for i in range(n - 1):
            x[i + 1] -= lower[i] * x[i]
        x /= pivots
        for i in range(n - 2, -1, -1):
            x[i] -= lower[i] * x[i + 1]
        return x

    def vector(self, value: float, near: list[np.ndarray]) -> np.ndarray:
        """Unit vector of ``value``, orthogonal to the vectors ``near`` of values close to it."""
        z, gamma = self.twisted(value)
        for _ in range(4):  # Rayleigh quotient corrections
            size = z @ z
            if abs(gamma) <= 4 * EPS * abs(value) * np.sqrt(size) or not np.isfinite(size):
                break
            better = value + gamma / size
            if abs(better - value) > CLOSE * abs(value) / 8:
                break
            z2, gamma2 = self.twisted(better)
            if abs(gamma2) / np.linalg.norm(z2) >= abs(gamma) / np.sqrt(size):
                break
            z, gamma, value = z2, gamma2, better
        if not near:
            return z / np.linalg.norm(z)
        # Values this close can share their direction: what is left beside the vectors found, if it still solves
        # the equation, else inverse iteration from fresh starts in the rest of the space.
        rng = np.random.default_rng(len(near))
        best, least = None, np.inf
        for _ in range(8):
            if not np.isfinite(z).all() or not z.any():
                z = rng.normal(size=self.n)
            z = z / np.abs(z).max()
            for _ in range(3):
                z = z / np.linalg.norm(z)
                for other in near:
                    z = z - (other @ z) * other
            size = np.linalg.norm(z)
            if size > CLOSE:
                z = z / size
                off = self.residual(value, z)
                if off < least:
                    best, least = z, off
                if off <= 16 * self.n * EPS * value:
                    break
                z = self.solve(value, z)
            else:
                z = rng.normal(size=self.n)
        return best

    def residual(self, value: float, z: np.ndarray) -> float:
        d, l = np.array(self.d), np.array(self.l)
        y = d * (z + np.append(l * z[1:], 0.0))
        return float(np.linalg.norm(y + np.insert(l * y[:-1], 0, 0.0) - value * z))


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest singular values of a square matrix that are not zero to working precision
    (perhaps fewer), falling, and their right singular vectors, one a row."""
    d = len(matrix)
    scale = np.abs(matrix).max(initial=0.0)
    if not scale:
        return np.zeros(0), np.zeros((0, d))
    a, b, right = bidiagonal(matrix / scale)
    limit = np.sqrt(d) * EPS * max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    cuts = [i + 1 for i in range(d - 1) if abs(b[i]) <= limit]
    parts = []  # (value, first row of its block, block)
    for lo, hi in zip([0, *cuts], [*cuts, d]):
        block = _Block(a[lo:hi], b[lo:hi - 1])
        parts += [(value, lo, block) for value in dqds(a[lo:hi] ** 2, b[lo:hi - 1] ** 2)]
    parts.sort(key=lambda x: (-x[0], x[1]))
    parts = [x for x in parts if np.sqrt(x[0]) > d * EPS * np.sqrt(parts[0][0])][:k]
    values, vectors = [], []
    for value, lo, block in parts:
        near = [v[lo:lo + block.n] for v, (other, at, _) in zip(vectors, parts) if at == lo and other - value <= CLOSE * other]
        z = np.zeros(d)
        z[lo:lo + block.n] = block.vector(value, near)
        values.append(np.sqrt(value) * scale)
        vectors.append(z)
    out = np.array(vectors)
    for i in range(len(right) - 1, -1, -1):
        v = right[i]
        out[:, i + 1:] -= 2.0 * np.outer(out[:, i + 1:] @ v, v)
    return np.array(values), out
