"""One-bit codes of rotated vectors, in numpy, with intervals that surely hold the inner products.

A vector x is turned at random (inner products stay) and cut to the signs of its coordinates, a unit vector b of entries +-1/sqrt(d).
Stored are the signs and the alignment a = <x, b>. What b leaves of x is coded in the same way, some levels deep, and the length of what
the last one leaves, y, is stored. For a query q,

    <q, x> = sum of a * <q, b> over the levels + <q, y>,   |<q, y>| <= sqrt(|q|^2 - <q, b>^2) * |y|,

by Cauchy and Schwarz on what the last b leaves of both. <q, b> is estimated by counting bits: q is rounded to whole steps, whose binary
digits are compared with the signs; the length of the rounding error bounds the error.
"""

from __future__ import annotations

import numpy as np

from pluvio.llm.polytope import rotations

SEED, DIGITS, LEVELS = 29, 8, 6
#: Share of |x| |q| that intervals are widened by for the rounding of doubles.
SLACK = 1e-7


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as words of 64."""
    n, d = bits.shape
    words = np.zeros((n, -(-d // 64) * 8), np.uint8)
    packed = np.packbits(bits, axis=1)
    words[:, :packed.shape[1]] = packed
    return words.view(np.uint64)


def turned(x: np.ndarray) -> np.ndarray:
    return next(rotations(x, 1, SEED))


class Codes:
    """The codes of the rows of x (finite doubles)."""

    def __init__(self, x: np.ndarray, levels: int = LEVELS):
        y = turned(x)
        self.d = y.shape[1]
        self.length = np.sqrt((y * y).sum(axis=1))
        signs, aligned = [], []
        for _ in range(levels):
            up = y > 0
            a = np.abs(y).sum(axis=1) / np.sqrt(self.d)
            y = y - np.where(up, 1.0, -1.0) * (a / np.sqrt(self.d))[:, None]
            signs.append(_packed(up))
            aligned.append(a)
        self.signs, self.aligned = np.stack(signs), np.stack(aligned)
        self.ones = np.bitwise_count(self.signs).sum(axis=2).astype(np.float64)
        self.left = np.sqrt((y * y).sum(axis=1))

    def intervals(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products with a turned query."""
        low = float(q.min())
        step = (float(q.max()) - low) / ((1 << DIGITS) - 1) or 1.0
        steps = np.rint((q - low) / step).astype(np.uint64)
        rounded = low + step * steps.astype(np.float64)
        digits = np.arange(DIGITS, dtype=np.uint64)[:, None]
        planes = _packed(((steps >> digits) & np.uint64(1)).astype(bool))
        count = np.bitwise_count(self.signs[:, None] & planes[None, :, None]).sum(axis=3)
        count = np.tensordot(2.0 ** np.arange(DIGITS), count, axes=(0, 1))
        s = (2 * (low * self.ones + step * count) - rounded.sum()) / np.sqrt(self.d)
        size, off = float(np.sqrt((q * q).sum())), float(np.sqrt(((q - rounded) ** 2).sum()))
        least = np.maximum(0.0, np.abs(s[-1]) - off)
        centre = (self.aligned * s).sum(axis=0)
        half = self.aligned.sum(axis=0) * off + np.sqrt(np.maximum(0.0, size * size - least * least)) * self.left + SLACK * size * self.length
        return centre - half, centre + half
