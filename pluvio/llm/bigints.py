"""Exact integers of any size in numpy: quantised vectors, their inner products, and scores that outgrow a long.

Finite doubles can be as large as 1e308, so integers made from them, and still more their products, may exceed 64 bits. Arrays hold
doubles while all results stay below 2**53, and Python integers beyond that.
"""

from __future__ import annotations

import numpy as np

EXACT = float(1 << 53)
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def quantise(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), scale a power of two: doubles, or Python integers if one exceeds 2**53."""
    if not x.size or np.abs(x).max() < EXACT / scale:
        return np.floor(x * scale)
    return np.array([[int(np.floor(c * scale)) if abs(c) < EXACT / scale else int(c) * scale for c in row] for row in x.tolist()], object).reshape(x.shape)


def largest(x: np.ndarray) -> float:
    """The largest absolute value, as a double that is not below it."""
    return float(np.abs(x).max()) * (1 + 1e-15) if x.size else 0.0


def fits(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether all inner products of rows of a and b are exact in doubles."""
    return a.dtype != object and b.dtype != object and largest(a) * largest(b) * max(1, a.shape[-1]) < EXACT


def whole(x: np.ndarray) -> np.ndarray:
    """Integral doubles as Python integers."""
    return x if x.dtype == object else np.array([[int(c) for c in row] for row in x.tolist()], object).reshape(x.shape)


def products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of rows with one vector: longs or Python integers."""
    if fits(rows, q):
        return (rows @ q).astype(np.int64)
    return np.array([sum(a * b for a, b in zip(row, whole(q[None])[0], strict=True)) for row in whole(rows)], object)


def clamped(score: int) -> int:
    """The nearest long."""
    return max(LONG_MIN, min(LONG_MAX, int(score)))


def beyond(score: int) -> bytes | None:
    """None for a score within a long; else bytes that sort (unsigned) as the scores do."""
    score = int(score)
    if LONG_MIN < score < LONG_MAX:
        return None
    size = (abs(score).bit_length() + 7) // 8
    body = size.to_bytes(4, "big") + abs(score).to_bytes(size, "big")
    return b"\1" + body if score > 0 else b"\0" + bytes(255 - b for b in body)


def exact(score: int, more: bytes | None) -> int:
    """The score of which clamped() and beyond() made these."""
    if more is None:
        return int(score)
    return int.from_bytes(more[5:], "big") if more[0] else -int.from_bytes(bytes(255 - b for b in more[5:]), "big")
