"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of ``A - s I``, read off the blocks of an L D L^T factorisation, tells how many eigenvalues
lie above ``s``.  Bisection on these counts isolates each leading eigenvalue; Rayleigh quotient iteration
then converges cubically inside its slice; counts on both sides of the result certify its number.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
GROWTH = (1 + 17 ** 0.5) / 8  # the pivot threshold that bounds growth best


def count_above(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of the symmetric ``a`` above ``shift``: positive pivots of L D L^T.

    Pivots are single entries or two-by-two blocks chosen by size (diagonal pivoting); a block always has one
    eigenvalue of each sign.  A pivot of exact zero counts as not above.
    """
    m = a - shift * np.eye(len(a))
    n, k, above = len(m), 0, 0
    while k < n:
        below = np.abs(m[k + 1:, k])
        here, largest = abs(m[k, k]), below.max(initial=0.0)
        block = 1
        if here < GROWTH * largest:
            r = k + 1 + int(below.argmax())
            line = np.abs(m[r, k:])
            line[r - k] = 0.0
            other = line.max()
            if here * other < GROWTH * largest * largest:
                if abs(m[r, r]) >= GROWTH * other:
                    swap = k
                else:
                    swap, block = k + 1, 2
                if swap != r:
                    m[[swap, r], k:] = m[[r, swap], k:]
                    m[k:, [swap, r]] = m[k:, [r, swap]]
        if block == 1:
            pivot = m[k, k]
            if pivot != 0.0:
                column = m[k + 1:, k].copy()
                m[k + 1:, k + 1:] -= np.outer(column, column / pivot)
            above += pivot > 0.0
        else:
            columns = m[k + 2:, k:k + 2].copy()
            m[k + 2:, k + 2:] -= columns @ np.linalg.solve(m[k:k + 2, k:k + 2], columns.T)
            above += 1
        k += block
    return above


def _solve(a: np.ndarray, shift: float, x: np.ndarray, nudge: float) -> np.ndarray:
    """Normalised columns of ``(a - shift I)^-1 x``; a singular matrix is shifted a little further."""
    eye = np.eye(len(a))
    while True:
        try:
            y = np.linalg.solve(a - shift * eye, x)
            size = np.linalg.norm(y, axis=0)
            if np.isfinite(size).all() and (size > 0).all():
                return y / size
        except np.linalg.LinAlgError:
            pass
        shift, nudge = shift + nudge, 2 * nudge


def _iterate(a: np.ndarray, lo: float, hi: float, x: np.ndarray, small: float):
    """Rayleigh quotient iteration for the one eigenvalue in (lo, hi]: (value, vector), or None if it left the slice."""
    for _ in range(2):
        x = _solve(a, (lo + hi) / 2, x, small)
    for _ in range(12):
        value = float(x @ a @ x)
        if not lo < value <= hi:
            return None
        if np.linalg.norm(a @ x - value * x) <= small:
            x = _solve(a, value, x[:, None], small)[:, 0]  # one step more: to the last digits
            return float(x @ a @ x), x
        x = _solve(a, value, x[:, None], small)[:, 0]
    return None


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest positive eigenvalues, falling, and their unit eigenvectors as columns.

    Fewer come back where fewer are above the rounding error of ``a`` (its rank).  Eigenvalues that rounding
    can't tell apart share a slice, whose vectors are any orthonormal basis of their space.  Numbers are
    certified by counts; an ``ArithmeticError`` says that they could not be.
    """
    d = len(a)
    if not d:
        return np.zeros(0), np.zeros((0, 0))
    a = (a + a.T) / 2
    top = float(np.abs(a).sum(axis=1).max())
    small = 4 * d * EPS * top
    floor = 64 * small  # below, rounding would show in the digits of a value
    rank = count_above(a, floor) if top > 0 else 0
    wanted = min(k, rank)
    if not wanted:
        return np.zeros(0), np.zeros((d, 0))
    rng = np.random.default_rng(0)
    vectors = np.zeros((d, d))
    slices = [(floor, top + small, rank, 0)]  # eigenvalues numbered below + 1 .. upto lie in (lo, hi]
    while slices:
        lo, hi, upto, below = slices.pop()
        if upto == below or below >= wanted:
            continue
        tight = hi - lo <= 2 * small
        if upto == below + 1 and not tight:
            found = _iterate(a, lo, hi, rng.standard_normal(d), small)
            if found is not None:
                vectors[:, below] = found[1]
                continue
        if tight:
            x = rng.standard_normal((d, upto - below))
            for _ in range(4):
                x = np.linalg.qr(_solve(a, (lo + hi) / 2, x, small))[0]
            vectors[:, below:upto] = x
            continue
        mid = (lo + hi) / 2
        inside = count_above(a, mid)
        slices += [(lo, mid, upto, inside), (mid, hi, inside, below)]
    vectors, _ = np.linalg.qr(vectors[:, :wanted])  # close values: vectors differ from orthogonal by rounding only
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    error = np.linalg.norm(a @ vectors - vectors * values, axis=0) + 4 * small
    for j, (value, width) in enumerate(zip(values, error)):
        if width > 1e-9 * top or not count_above(a, value - width) > j >= count_above(a, value + width):
            raise ArithmeticError(f"eigenvalue {j + 1} of {wanted} could not be certified")
    return values, vectors
