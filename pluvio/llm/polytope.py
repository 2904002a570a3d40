"""Cross-polytope hashing, in numpy: fast Hadamard pseudo-rotations, then the nearest signed axis."""

from __future__ import annotations

import numpy as np

ROUNDS = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, scaled to keep lengths. Rows of a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotations(x: np.ndarray, tables: int, seed: int):
    """Every row turned at random, table by table; rows are padded with zeros to a power of two."""
    d = max(2, 1 << (x.shape[1] - 1).bit_length())
    padded = np.zeros((len(x), d))
    padded[:, :x.shape[1]] = x
    rng = np.random.default_rng([seed, x.shape[1]])
    for _ in range(tables):
        y = padded
        for signs in rng.choice([-1.0, 1.0], (ROUNDS, d)):
            y = hadamard(y * signs)
        yield y


def nearest_axes(y: np.ndarray, probes: int = 1) -> np.ndarray:
    """The nearest signed axes of every row, nearest first: axis k for +, d + k for -."""
    both = np.concatenate([y, -y], axis=1)
    if probes == 1:
        return both.argmax(axis=1)[:, None]
    probes = min(probes, both.shape[1])
    some = np.argpartition(-both, probes - 1, axis=1)[:, :probes]
    order = np.argsort(-np.take_along_axis(both, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1)
