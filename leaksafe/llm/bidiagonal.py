"""Leading right singular vectors of a small triangular matrix by way of its bidiagonal form.

Householder reflections make the matrix upper bidiagonal; the differential qd algorithm with shifts (dqds) finds all squared
singular values, which only needs positive quotients and loses no relative accuracy; twisted factorisations of the
tridiagonal product minus a value give its vector without solving a system. Values closer than `CLUSTER` to each other get
their vectors by inverse iteration with the same factorisation, kept orthogonal to their neighbours.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
CLUSTER = 1e-3


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, superdiagonal, unit vectors of the right reflections) of a square matrix."""
    a = matrix.astype(float).copy()
    size, rights = len(a), []

    def reflector(x: np.ndarray) -> np.ndarray:
        v, norm = x.copy(), np.linalg.norm(x)
        if norm:
            v /= norm
            v[0] += 1.0 if v[0] >= 0 else -1.0
            v /= np.linalg.norm(v)
        return v

    for k in range(size):
        left = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(left, left @ a[k:, k:])
        if k + 1 < size:
            right = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ right, right)
            rights.append(right)
    return np.diag(a).copy(), np.diag(a, 1).copy(), rights


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]] | None:
    """One step of dqds: new quotients, new differences, and the auxiliary values; none if the shift is too large."""
    qs, es, ds = [], [], [q[0] - shift]
    for k in range(len(e)):
        d = ds[-1]
        if d < 0:
            return None
        total = d + e[k]
        ratio = q[k + 1] / total
        qs.append(total)
        es.append(e[k] * ratio)
        ds.append(d * ratio - shift)
    if not ds[-1] >= 0:
        return None
    return [*qs, ds[-1]], es, ds


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling."""
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if not scale:
        return np.zeros(len(diagonal))
    found: list[float] = []
    open_blocks = [([*((diagonal / scale) ** 2)], [*((above / scale) ** 2)], 0.0)]
    while open_blocks:
        q, e, shifted = open_blocks.pop()
        part, newton = 0.25, 0.0
        while q:
            small = [k for k in range(len(e)) if e[k] <= EPS**2 * (shifted + q[k]) or e[k] < 1e-290]
            if small:
                k = small[-1]
                open_blocks.append((q[: k + 1], e[:k], shifted))
                q, e, part, newton = q[k + 1 :], e[k + 1 :], 0.25, 0.0
                continue
            if len(q) == 1:
                found.append(shifted + q[0])
                break
            # The smaller value of the last two rows is a bound from above, and the sum of inverses gives one from below.
            trace = q[-2] + q[-1] + e[-1]
            last = 2 * q[-2] * q[-1] / (trace + max(0.0, trace * trace - 4 * q[-2] * q[-1]) ** 0.5)
            shift = max(last * (1 - part), newton)
            step = _transform(q, e, shift) if shift + shifted > shifted else _transform(q, e, 0.0)
            part = part / 4 if step else min(0.75, 8 * part)
            for lower in (newton, 0.0):
                if step is None:
                    shift = lower
                    step = _transform(q, e, lower)
            if shift + shifted == shifted:
                shift = 0.0
            q, e, ds = step
            shifted += shift
            newton = (1 - 1e-10) / sum(1 / d for d in ds) if min(ds) > 0 else 0.0
    return np.sort(found)[::-1] * scale**2


class Twisted:
    """Factorisations of L D L' - value, from the top and from the bottom, joined where the pivot is least."""

    def __init__(self, d: np.ndarray, low: np.ndarray, value: float):
        n, tiny = len(d), EPS * EPS * max(1e-300, np.abs(d).max() + abs(value))
        top, down, s = np.empty(n), np.empty(max(0, n - 1)), np.empty(n)
        s[0] = -value
        for k in range(n - 1):
            top[k] = s[k] + d[k] or tiny
            down[k] = d[k] * low[k] / top[k]
            s[k + 1] = down[k] * low[k] * s[k] - value
        top[-1] = s[-1] + d[-1]
        bottom, up, p = np.empty(n), np.empty(max(0, n - 1)), np.empty(n)
        p[-1] = d[-1] - value
        for k in range(n - 2, -1, -1):
            if not d[k] * low[k] ** 2 + p[k + 1]:
                p[k + 1] = tiny
            bottom[k + 1] = d[k] * low[k] ** 2 + p[k + 1]
            ratio = d[k] / bottom[k + 1]
            up[k] = low[k] * ratio
            p[k] = p[k + 1] * ratio - value
        bottom[0] = p[0]
        pivots = s + p + value
        self.at = int(np.argmin(np.abs(np.where(np.isfinite(pivots), pivots, np.inf))))
        self.down, self.up = down, up
        self.pivot = pivots[self.at]
        self.pivots = np.concatenate([top[: self.at], [self.pivot or tiny], bottom[self.at + 1 :]])

    def _outward(self, x: np.ndarray) -> np.ndarray:
        for k in range(self.at - 1, -1, -1):
            x[k] -= self.down[k] * x[k + 1]
        for k in range(self.at, len(x) - 1):
            x[k + 1] -= self.up[k] * x[k]
        return x

    def vector(self) -> tuple[np.ndarray, float]:
        """The vector of the value, and what a Rayleigh quotient adds to the value."""
        x = np.zeros(len(self.pivots))
        x[self.at] = 1.0
        self._outward(x)
        return x / np.linalg.norm(x), self.pivot / (x @ x)

    def solve(self, x: np.ndarray) -> np.ndarray:
        x, r = x.copy(), self.at
        for k in range(r):
            x[k + 1] -= self.down[k] * x[k]
        for k in range(len(x) - 1, r, -1):
            x[k - 1] -= self.up[k - 1] * x[k]
        x /= self.pivots
        return self._outward(x)


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values, falling, and the right singular vectors of the first `most` as rows."""
    diagonal, above, rights = bidiagonalise(matrix)
    values = dqds(diagonal, above)
    scale = np.abs(values).max(initial=0) ** 0.5
    vectors: list[np.ndarray] = []
    if not scale:
        return values, np.eye(len(matrix))[:most]
    a = np.where(np.abs(diagonal) > EPS * EPS * scale, diagonal, EPS * EPS * scale) / scale
    d, low = a * a, above / scale / a[:-1]
    noise = np.random.default_rng(0)
    for k in range(min(most, len(values))):
        value = values[k] / scale**2
        near = [j for j in range(k) if values[j] - values[k] <= CLUSTER * (k - j) * values[k]]
        x, better = Twisted(d, low, value).vector()
        if not near:
            for _ in range(2):
                if abs(better) <= 4 * EPS * value:
                    break
                x, better = Twisted(d, low, value := value + better).vector()
        else:
            others, twisted = np.array([vectors[j] for j in near]), Twisted(d, low, value)
            for _ in range(2):
                x -= others.T @ (others @ x)
            if np.linalg.norm(x) < 0.1:
                x = noise.standard_normal(len(d))
            for _ in range(4):
                for _ in range(2):
                    x -= others.T @ (others @ x)
                x = twisted.solve(x / np.linalg.norm(x))
                x /= np.linalg.norm(x)
            for _ in range(2):
                x -= others.T @ (others @ x)
                x /= np.linalg.norm(x)
        vectors.append(x)
    out = np.array(vectors).reshape(len(vectors), len(matrix))
    for k in range(len(rights) - 1, -1, -1):
        out[:, k + 1 :] -= 2 * np.outer(out[:, k + 1 :] @ rights[k], rights[k])
    return values, out / np.linalg.norm(out, axis=1, keepdims=True)
