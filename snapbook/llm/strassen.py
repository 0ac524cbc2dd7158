"""Exact products of integer matrices by Strassen's recursion (Strassen, 1969)."""

from __future__ import annotations

import numpy as np

# Below this side a block is multiplied directly: seven products of halves no longer pay for eighteen additions.
LEAF = 32
# Whole numbers up to here are exact in a double.
EXACT = 1 << 53


def _largest(a: np.ndarray) -> int:
    return max(int(a.max(initial=0)), -int(a.min(initial=0)))


def _direct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A leaf product: in doubles where every partial sum is exact there, else in 64-bit integers, which add up modulo 2**64."""
    if _largest(a) * _largest(b) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _pad(a: np.ndarray, rows: int, columns: int) -> np.ndarray:
    return a if a.shape == (rows, columns) else np.pad(a, ((0, rows - a.shape[0]), (0, columns - a.shape[1])))


def multiply(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` for int64 matrices of any shape, exact as long as the entries of the product fit 64 bits.

    Odd sides are padded with a zero row or column and the padding is cut off again. Sums on the way may wrap around: whole numbers
    modulo 2**64 are a ring, in which Strassen's identities hold as they stand.
    """
    if a.shape[1] != b.shape[0]:
        raise ValueError("the matrices do not fit")
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return _direct(a, b)
    hm, hk, hn = -(-m // 2), -(-k // 2), -(-n // 2)
    a, b = _pad(a, 2 * hm, 2 * hk), _pad(b, 2 * hk, 2 * hn)
    a11, a12, a21, a22 = a[:hm, :hk], a[:hm, hk:], a[hm:, :hk], a[hm:, hk:]
    b11, b12, b21, b22 = b[:hk, :hn], b[:hk, hn:], b[hk:, :hn], b[hk:, hn:]
    p1 = multiply(a11 + a22, b11 + b22, leaf)
    p2 = multiply(a21 + a22, b11, leaf)
    p3 = multiply(a11, b12 - b22, leaf)
    p4 = multiply(a22, b21 - b11, leaf)
    p5 = multiply(a11 + a12, b22, leaf)
    p6 = multiply(a21 - a11, b11 + b12, leaf)
    p7 = multiply(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * hm, 2 * hn), np.int64)
    out[:hm, :hn] = p1 + p4 - p5 + p7
    out[:hm, hn:] = p3 + p5
    out[hm:, :hn] = p2 + p4
    out[hm:, hn:] = p1 - p2 + p3 + p6
    return out[:m, :n]
