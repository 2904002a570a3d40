"""Generalised additive model with pairwise interactions, boosted in numpy.

Features are cut into bins at quantiles. In cyclic order every feature gets one shallow tree over its bins, shrunk and added
to the feature's lookup table; then the pairs of features that explain most of what is left get trees over both in the same
way. A score is the sum of one table entry per feature and per pair.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np


@dataclass
class Additive:
    edges: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            total += t[b[:, j]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[b[:, i], b[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _leaf(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g / (h + ridge)


def _cut(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[float, int]:
    """Best cut of ordered bins by gradient and curvature: gain and the first bin of the right side (0: none)."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain[(hl < least) | (hr < least)] = 0
    if not len(gain) or gain.max() <= 1e-12:
        return 0.0, 0
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> np.ndarray:
    """Values per bin of a tree of depth two over ordered bins."""
    out = np.full(len(g), _leaf(g.sum(), h.sum(), ridge))
    _, k = _cut(g, h, ridge, least)
    if not k:
        return out
    for part in (slice(0, k), slice(k, len(g))):
        _, m = _cut(g[part], h[part], ridge, least)
        for piece in ((slice(0, m), slice(m, None)) if m else (slice(None),)):
            out[part][piece] = _leaf(g[part][piece].sum(), h[part][piece].sum(), ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[float, np.ndarray]:
    """A cut of one feature with a cut of the other on either side, in the better order: gain and values per cell."""
    best = (0.0, np.zeros_like(g))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        _, k = _cut(a.sum(axis=1), b.sum(axis=1), ridge, least)
        cut = k or a.shape[0] // 2
        out, gain = np.zeros_like(a), 0.0
        for part in (slice(0, cut), slice(cut, None)):
            ga, ha = a[part].sum(axis=0), b[part].sum(axis=0)
            more, m = _cut(ga, ha, ridge, least)
            gain += more
            for piece in ((slice(0, m), slice(m, None)) if m else (slice(None),)):
                gs, hs = ga[piece].sum(), ha[piece].sum()
                out[part, piece] = _leaf(gs, hs, ridge)
        if gain > best[0]:
            best = (gain, out.T if turned else out)
    return best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, pairs: int = 8, rate: float = 0.15, ridge: float = 2.0,
        least: float = 1.0) -> Additive:
    """Fit on rows of features and 0/1 labels. Without rows the score is 0.5; with one label it is that label's smoothed share."""
    n, d = x.shape
    share = (y.sum() + 0.5) / (n + 1.0)
    start = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for j in range(d)]
    model = Additive(edges, start, [np.zeros(len(e) + 1) for e in edges], [], [])
    if not n or y.min() == y.max():
        return model
    b = model.bins(x)
    margin = np.full(n, start)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(d):
            g, h = slopes()
            size = len(model.tables[j])
            step = rate * np.clip(_tree(np.bincount(b[:, j], g, size), np.bincount(b[:, j], h, size), ridge, least), -4, 4)
            model.tables[j] += step
            margin += step[b[:, j]]
    if pairs and d > 1:
        g, h = slopes()

        def grid(i, j, values):
            shape = (len(model.tables[i]), len(model.tables[j]))
            return np.bincount(b[:, i] * shape[1] + b[:, j], values, shape[0] * shape[1]).reshape(shape)

        gains = sorted(((_pair_tree(grid(i, j, g), grid(i, j, h), ridge, least)[0], i, j) for i, j in combinations(range(d), 2)),
                       reverse=True)
        model.pairs = [(i, j) for gain, i, j in gains[:pairs] if gain > 0]
        model.pair_tables = [np.zeros((len(model.tables[i]), len(model.tables[j]))) for i, j in model.pairs]
        for _ in range(rounds // 3):
            for k, (i, j) in enumerate(model.pairs):
                g, h = slopes()
                _, step = _pair_tree(grid(i, j, g), grid(i, j, h), ridge, least)
                step = rate * np.clip(step, -4, 4)
                model.pair_tables[k] += step
                margin += step[b[:, i], b[:, j]]
    return model
