"""Singular values and right singular vectors of a small square matrix, for ``whitening``.

Householder reflections make it bidiagonal; dqds, which subtracts nothing but
its shifts, finds the squared singular values to high relative accuracy; for
each, the twisted factorisation with the least pivot gives the vector.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)
TINY = float(np.finfo(float).tiny)
#: Eigenvalues whose relative distance is less belong to one cluster.
NEAR = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit ``v`` and ``alpha`` so that ``x - 2 v (v.x)`` is ``alpha`` in its first place and zero else."""
    norm = np.linalg.norm(x)
    if norm == 0.0 or not x[1:].any():
        return np.zeros_like(x), float(x[0])
    alpha = -np.copysign(norm, x[0])
    v = x.copy()
    v[0] -= alpha
    return v / np.linalg.norm(v), float(alpha)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of an upper bidiagonal ``B`` with ``r = U B W'``, and the reflectors of ``W``.

    The i-th reflector acts on the places from ``i + 1`` on."""
    a = np.array(r, np.float64)
    n = len(a)
    diagonal, above, right = np.zeros(n), np.zeros(max(n - 1, 0)), []
    for i in range(n):
        v, diagonal[i] = _reflector(a[i:, i])
        a[i:, i + 1:] -= 2.0 * np.outer(v, v @ a[i:, i + 1:])
        if i + 1 < n:
            w, above[i] = _reflector(a[i, i + 1:])
            a[i + 1:, i + 1:] -= 2.0 * np.outer(a[i + 1:, i + 1:] @ w, w)
            right.append(w)
    return diagonal, above, right


def unfold(z: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """``W z`` from the reflectors."""
    z = z.copy()
    for i in range(len(right) - 1, -1, -1):
        w = right[i]
        z[i + 1:] -= 2.0 * w * (w @ z[i + 1:])
    return z


def _sweep(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One differential quotient-difference transform of a qd array; with it the least and the last of its ``d``."""
    n = len(q)
    q2, e2 = np.empty(n), np.empty(n - 1)
    d = least = q[0] - shift
    for i in range(n - 1):
        q2[i] = d + e[i]
        if q2[i] == 0.0:
            e2[i], d = 0.0, q[i + 1] - shift
        else:
            t = q[i + 1] / q2[i]
            e2[i], d = e[i] * t, d * t - shift
        least = min(least, d)
        if not least >= 0.0 and shift:           # too large a shift (or an overflow): what follows is of no use
            return q2, e2, least if i < n - 2 else -np.inf, d
    q2[n - 1] = d
    return q2, e2, least, d


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues of ``B'B`` from the squares of the diagonal and superdiagonal of ``B``, in no order."""
    out = []
    todo = [(q.astype(float).tolist(), e.astype(float).tolist(), 0.0)]
    while todo:
        q, e, base = todo.pop()
        q, e = np.array(q), np.array(e)
        if len(q) > 1 and 1.5 * q[0] < q[-1]:    # small values are found at the end
            q, e = q[::-1].copy(), e[::-1].copy()
        least = 0.0
        while len(q):
            n = len(q)
            if n == 1 or e[-1] <= EPS * EPS * (base + q[-1]) or e[-1] <= EPS * EPS * q[-2] and e[-1] * q[-1] <= EPS * EPS * q[-2] * (base + q[-1]):
                out.append(base + q[-1])
                q, e, least = q[:-1], e[:-1], 0.0
                continue
            cut = np.flatnonzero(e <= EPS * EPS * (base + q[1:]))
            if len(cut):                          # two arrays that do not touch
                c = int(cut[-1]) + 1
                todo.append((q[:c].tolist(), e[:c - 1].tolist(), base))
                q, e = q[c:], e[c:]
                continue
            # the last row bounds the least value nearly from below when its off-diagonal is small
            near = np.sqrt(q[-1]) - np.sqrt(e[-1]) / 2.0
            guesses = [near * near if near > 0.0 else 0.0, least / 4.0, 0.0]
            for shift in sorted({min(g, q.min()) for g in guesses}, reverse=True):
                q2, e2, least, last = _sweep(q, e, shift)
                if least >= 0.0 or shift == 0.0:
                    break
            q, e, base, least = q2, e2, base + shift, max(least, 0.0)
    return np.array(out)


class _Twisted:
    """The twisted factorisation ``N D N'`` of ``B'B - value`` whose pivot at the twist is the least."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float):
        n = len(diagonal)
        big, low = diagonal * diagonal, above / diagonal[:-1]
        floor = EPS * EPS * (big.max() + abs(value)) + TINY
        self.down, self.up = np.zeros(n - 1), np.zeros(n - 1)     # multipliers of the stationary and the progressive transform
        before, after = np.zeros(n), np.zeros(n)                  # their pivots
        s, p = np.empty(n), np.empty(n)
        s[0] = -value
        for i in range(n - 1):
            pivot = big[i] + s[i]
            before[i] = pivot if abs(pivot) > floor else floor
            self.down[i] = big[i] * low[i] / before[i]
            s[i + 1] = self.down[i] * low[i] * s[i] - value
        p[n - 1] = big[n - 1] - value
        for i in range(n - 2, -1, -1):
            pivot = big[i] * low[i] * low[i] + p[i + 1]
            after[i + 1] = pivot if abs(pivot) > floor else floor
            t = big[i] / after[i + 1]
            self.up[i] = low[i] * t
            p[i] = p[i + 1] * t - value
        gamma = s + p + value
        self.at = int(np.argmin(np.abs(gamma)))
        self.gamma = float(gamma[self.at])
        self.pivots = np.concatenate([before[:self.at], [self.gamma if abs(self.gamma) > floor else floor], after[self.at + 1:]])

    def _back(self, z: np.ndarray) -> np.ndarray:
        for i in range(self.at - 1, -1, -1):
            z[i] -= self.down[i] * z[i + 1]
        for i in range(self.at, len(z) - 1):
            z[i + 1] -= self.up[i] * z[i]
        return z

    def vector(self) -> tuple[np.ndarray, float]:
        """Unit vector, and what its Rayleigh quotient adds to the value."""
        z = np.zeros(len(self.pivots))
        z[self.at] = 1.0
        square = float((z := self._back(z)) @ z)
        return z / np.sqrt(square), self.gamma / square

    def solve(self, y: np.ndarray) -> np.ndarray:
        y = y.copy()
        for i in range(self.at):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(len(y) - 1, self.at, -1):
            y[i - 1] -= self.up[i - 1] * y[i]
        return self._back(y / self.pivots)


def _apart(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            z = z - (other @ z) * other
    return z / max(np.linalg.norm(z), TINY)


def _block_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One column per value, for a ``B`` without zeros.  Values far from each other have orthogonal vectors as they
    come; those of a cluster are kept orthogonal through steps of inverse iteration with the same factorisation."""
    out: list[np.ndarray] = []
    cluster = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > NEAR * value and value > EPS * values[0]:
            cluster = k
        factors = _Twisted(diagonal, above, value)
        z, more = factors.vector()
        near = out[cluster:]
        if not near:
            again, further = _Twisted(diagonal, above, value + more).vector()
            out.append(again if abs(further) <= abs(more) else z)
            continue
        if np.linalg.norm(z - sum((o @ z) * o for o in near)) < 0.5:      # its neighbour's vector
            z = np.random.default_rng(k).standard_normal(len(z))
        for _ in range(4):
            z = factors.solve(_apart(z, near))
            z /= max(np.abs(z).max(), TINY)
        out.append(_apart(z, near))
    return np.column_stack(out)


def right_singular(r: np.ndarray, k: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``r'r`` from the largest, and the unit eigenvectors of the first ``k`` (all) as columns."""
    n = len(r)
    k = n if k is None else min(k, n)
    scale = float(np.abs(r).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(n), np.eye(n)[:, :k]
    diagonal, above, right = bidiagonalise(r / scale)
    # a change of the size of the reflections' own rounding
    diagonal = np.where(np.abs(diagonal) < EPS * 1e-3, EPS * 1e-3, diagonal)
    above = np.where(np.abs(above) < EPS * 1e-3, 0.0, above)
    cuts = [0, *(np.flatnonzero(above == 0.0) + 1).tolist(), n]
    blocks = [(a, b, np.sort(dqds(diagonal[a:b] ** 2, above[a:b - 1] ** 2))[::-1]) for a, b in zip(cuts, cuts[1:])]
    values = np.concatenate([found for _, _, found in blocks])
    order = np.argsort(-values, kind="stable")
    wanted, vectors = set(order[:k].tolist()), {}
    at = 0
    for a, b, found in blocks:
        own = [i for i in range(len(found)) if at + i in wanted]
        if own:
            z = np.zeros((n, len(own)))
            z[a:b] = _block_vectors(diagonal[a:b], above[a:b - 1], found[:len(own)])
            vectors |= {at + i: unfold(z[:, i], right) for i in own}
        at += len(found)
    return values[order] * scale * scale, np.column_stack([vectors[i] for i in order[:k].tolist()])
