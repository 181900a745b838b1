"""Singular values and right singular vectors of a small matrix: Householder, dqds, twisted factorisations."""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps
#: Eigenvalues whose relative distance is below this are neighbours; their vectors are made orthogonal to each other.
NEIGHBOURS = 1e-3


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and orthogonal W of ``r = U B W'`` (square ``r``) by Householder reflections."""
    r, n = np.array(r, np.float64), len(r)
    w = np.eye(n)

    def reflector(x):
        v = x.copy()
        length = np.linalg.norm(x)
        if length == 0:
            return None
        v[0] += length if x[0] >= 0 else -length
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(r[k:, k])
        if v is not None:
            r[k:, k:] -= 2 * np.outer(v, v @ r[k:, k:])
        if k < n - 2:
            v = reflector(r[k, k + 1:])
            if v is not None:
                r[k:, k + 1:] -= 2 * np.outer(r[k:, k + 1:] @ v, v)
                w[:, k + 1:] -= 2 * np.outer(w[:, k + 1:] @ v, v)
    # signs of B are free: they go into U and W, so that a and b are not negative
    a, b = np.diagonal(r).copy(), np.diagonal(r, 1).copy()
    sign = 1.0
    for k in range(n):
        if k:
            sign = 1.0 if b[k - 1] * left >= 0 else -1.0
        w[:, k] *= sign
        left = 1.0 if a[k] * sign >= 0 else -1.0
    return np.abs(a), np.abs(b), w


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B, falling, from the squares q of B's diagonal and e of its superdiagonal.

    A transform without shift keeps the eigenvalues and yields d with trace((BB')^-1) = sum 1/d; so
    1 / sum(1/d) is a shift that never passes the smallest eigenvalue, every quantity stays positive
    and each eigenvalue keeps its relative accuracy.  Values deflate at the end; a zero in e splits.
    """
    found, work = [], [(list(map(float, q)), list(map(float, e)), 0.0)]
    while work:
        q, e, moved = work.pop()
        while q:
            n = len(q)
            if n == 1:
                found.append(moved + q[0])
                break
            if e[-1] <= _EPS * _EPS * (moved + q[-1]):
                found.append(moved + q.pop())
                e.pop()
                continue
            cut = next((i for i in range(n - 1) if e[i] <= _EPS * _EPS * min(moved + q[i], moved + q[i + 1])), None)
            if cut is not None:
                work.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if 1.5 * q[0] < q[-1]:  # graded the slow way round: the mirrored matrix has the same values
                q, e = q[::-1], e[::-1]
            q, e, low = _step(q, e, 0.0)
            if low > 0:
                shifted = _step(q, e, low * (1 - 64 * _EPS * n))
                if shifted is not None:
                    q, e, moved = shifted[0], shifted[1], moved + low * (1 - 64 * _EPS * n)
    return np.sort(np.array(found))[::-1]


def _step(q, e, shift):
    """One dqds transform: new q and e, and 1 / sum(1/d); None if the shift was too large."""
    d, inverse, zero = q[0] - shift, 0.0, False
    new_q, new_e = [], []
    for i in range(len(e)):
        if d < 0:
            return None
        zero, inverse = (True, inverse) if d == 0 else (zero, inverse + 1 / d)
        top = d + e[i]
        new_q.append(top)
        t = q[i + 1] / top if top else 1.0
        new_e.append(e[i] * t)
        d = d * t - shift
    if d < 0:
        return None
    new_q.append(d)
    zero, inverse = (True, inverse) if d == 0 else (zero, inverse + 1 / d)
    return new_q, new_e, 0.0 if zero or not np.isfinite(inverse) else 1 / inverse


class _Twisted:
    """B'B - value as N diag(g) N', both triangular factors meeting in the row of the least pivot."""

    def __init__(self, a, b, value):
        n, big = len(a), max(a.max(), b.max() if len(b) else 0.0)
        tiny = _EPS * _EPS * big * big
        safe = lambda x: x if abs(x) > tiny else (tiny if x >= 0 else -tiny)
        dd = np.maximum(a, big * 2.0 ** -60) ** 2
        ll = b / np.sqrt(dd[:-1])
        down, self.lower, s = np.empty(n), np.empty(max(n - 1, 0)), np.empty(n)
        s[0] = -value
        for i in range(n - 1):
            down[i] = safe(s[i] + dd[i])
            self.lower[i] = dd[i] * ll[i] / down[i]
            s[i + 1] = self.lower[i] * ll[i] * s[i] - value
        down[-1] = safe(s[-1] + dd[-1])
        up, self.upper, p = np.empty(n), np.empty(max(n - 1, 0)), np.empty(n)
        p[-1] = dd[-1] - value
        for i in range(n - 2, -1, -1):
            up[i + 1] = safe(dd[i] * ll[i] ** 2 + p[i + 1])
            t = dd[i] / up[i + 1]
            self.upper[i] = ll[i] * t
            p[i] = p[i + 1] * t - value
        gamma = s + p + value
        self.at = r = int(np.argmin(np.abs(gamma)))
        self.pivots = np.concatenate([down[:r], [safe(gamma[r])], up[r + 1:]])

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.pivots))
        z[self.at] = 1.0
        return self._outward(z)

    def solve(self, x) -> np.ndarray:
        w, r = x.copy(), self.at
        for i in range(1, r):
            w[i] -= self.lower[i - 1] * w[i - 1]
        for i in range(len(w) - 2, r, -1):
            w[i] -= self.upper[i] * w[i + 1]
        w[r] -= (self.lower[r - 1] * w[r - 1] if r else 0.0) + (self.upper[r] * w[r + 1] if r + 1 < len(w) else 0.0)
        return self._outward(w / self.pivots)

    def _outward(self, z):
        for i in range(self.at - 1, -1, -1):
            z[i] -= self.lower[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] -= self.upper[i] * z[i]
        return z / np.linalg.norm(z)


def _block_vectors(a, b, values) -> np.ndarray:
    """Unit vectors (columns) of an unsplit block for its falling eigenvalues."""
    rng, out, first = np.random.default_rng(1), np.zeros((len(a), len(values))), 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > NEIGHBOURS * values[k - 1]:
            first = k
        twisted, near = _Twisted(a, b, value), out[:, first:k]
        z = twisted.vector()
        if near.shape[1]:
            left = z - near @ (near.T @ z)
            if np.linalg.norm(left) < 0.5:  # as good as a vector found before: iterate from a fresh start
                left = rng.standard_normal(len(a))
            for _ in range(4):
                left -= near @ (near.T @ left)
                left = twisted.solve(left / np.linalg.norm(left))
            for _ in range(2):
                left -= near @ (near.T @ left)
                left /= np.linalg.norm(left)
            z = left
        out[:, k] = z
    return out


def eigen(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues of r'r and their unit vectors (columns)."""
    n, scale = len(r), float(np.abs(r).max()) if len(r) else 0.0
    if scale == 0:
        return np.zeros(n), np.eye(n)
    a, b, w = bidiagonal(r / scale)
    size = max(a.max(), b.max() if len(b) else 0.0)
    b[b <= _EPS * size] = 0.0
    edges = [0, *(np.flatnonzero(b == 0) + 1).tolist(), n]
    values, vectors = [], np.zeros((n, 0))
    for lo, hi in zip(edges[:-1], edges[1:]):
        found = dqds(a[lo:hi] ** 2, b[lo:hi - 1] ** 2)
        values.append(found)
        vectors = np.hstack([vectors, w[:, lo:hi] @ _block_vectors(a[lo:hi], b[lo:hi - 1], found)])
    values = np.concatenate(values)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order]
    return values[order] * scale * scale, vectors @ (1.5 * np.eye(n) - 0.5 * vectors.T @ vectors)  # last digits
