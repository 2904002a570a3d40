"""Sample deviations over sliding windows from mergeable summaries (count, mean, sum of squares about the mean), in numpy.

A series is cut into stretches as long as the window. Every window is the tail of one stretch and the head of the next, so heads are
summed up forwards, tails backwards, and each window merges two summaries. A value never has to be taken out of a summary again:
what has left the window leaves no trace, however large it was.
"""

from __future__ import annotations

import numpy as np

Summary = tuple[np.ndarray, np.ndarray, np.ndarray]


def merged(a: Summary, b: Summary) -> Summary:
    """The summaries of two sets each, put together (Chan and others)."""
    n = a[0] + b[0]
    safe = np.maximum(n, 1)
    gap = np.where((a[0] > 0) & (b[0] > 0), b[1] - a[1], 0.0)
    mean = np.where(a[0] == 0, b[1], np.where(b[0] == 0, a[1], a[1] + gap * b[0] / safe))
    return n, mean, a[2] + b[2] + gap * gap * a[0] * b[0] / safe


def heads(x: np.ndarray) -> Summary:
    """Summaries of the first 1, 2, ... values of every row; NaN counts as missing."""
    known = ~np.isnan(x)
    n, mean, squares = np.zeros(x.shape), np.zeros(x.shape), np.zeros(x.shape)
    count, centre, total = (np.zeros(len(x)) for _ in range(3))
    for j in range(x.shape[1]):
        here = known[:, j]
        value = np.where(here, x[:, j], centre)
        count = count + here
        gap = value - centre
        centre = centre + gap / np.maximum(count, 1)
        total = total + gap * (value - centre)
        n[:, j], mean[:, j], squares[:, j] = count, centre, total
    return n, mean, squares


def deviation(values: np.ndarray, window: int, need: int) -> np.ndarray:
    """Sample deviations of trailing windows; NaN where fewer than `need` (two at least) values are known."""
    size = len(values)
    if not size:
        return np.zeros(0)
    rows = -(-size // window) + 1
    x = np.full(rows * window, np.nan)
    x[window:window + size] = values  # a stretch without values goes first
    x = x.reshape(rows, window)
    head = heads(x)
    tail = tuple(part[:, ::-1] for part in heads(x[:, ::-1]))
    at = np.arange(size)
    stretch, place = at // window + 1, at % window
    # The window that ends at this place begins right after it in the stretch before.
    whole = place == window - 1
    before = tuple(np.where(whole, 0.0, part[stretch - 1, np.minimum(place + 1, window - 1)]) for part in tail)
    n, _, squares = merged(before, tuple(part[stretch, place] for part in head))
    return np.where(n >= max(need, 2), np.sqrt(squares / np.maximum(n - 1, 1)), np.nan)
