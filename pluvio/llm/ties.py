"""Which sets may link, by bitmaps of parities: groups that never part two sets that link."""

from __future__ import annotations

import numpy as np

from pluvio.llm.trie import Groups

#: Sets compared each with each; larger groups are first cut by their distances to pivots.
FEW = 128
PIVOTS = 6


def _folded(bits: bytes, words: int) -> np.ndarray:
    row = np.frombuffer(bits, "<u8")
    while len(row) > words:
        half = len(row) // 2
        row = row[:half] ^ row[half:]
    return row


def _runs(values: np.ndarray, gap: np.ndarray | float) -> list[np.ndarray]:
    """Positions of ascending values, cut where neighbours are further apart than the gap before them."""
    order = np.argsort(values, kind="stable")
    ascending = values[order]
    return np.split(order, np.flatnonzero(np.diff(ascending) > gap) + 1)


def first_meetings(items: np.ndarray, classes: np.ndarray, sizes: np.ndarray, places: np.ndarray, percent: int) -> np.ndarray:
    """Positions of the postings that may be the first item, in the order of items, which a set shares with one that links to it.

    A set of n items that has p of them before the first shared one shares n - p at most, so a set it links to has at most
    (100 + percent) * (n - p) / percent - n items. A posting stays if the item has another set that is within this reach and has
    this set within its own. A class counts once an item.
    """
    order = np.lexsort((classes, sizes, items))
    item, cls = items[order], classes[order]
    once = np.ones(len(order), bool)
    once[1:] = (item[1:] != item[:-1]) | (cls[1:] != cls[:-1])
    order, item = order[once], item[once]
    n = sizes[order].astype(np.int64)
    reach = np.maximum((100 + percent) * (n - places[order]) // percent - n, 0)
    new = np.ones(len(item), bool)
    new[1:] = item[1:] != item[:-1]
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    base = group << 32  # values of a group lie above those of all groups before it
    # The largest and second largest reach among the sets of an item up to a size; the second is for a set that is itself the first.
    far = base + reach + 1
    most = np.maximum.accumulate(far)
    earlier = np.maximum(np.concatenate([base[:1], most[:-1]]), base)
    second = np.maximum.accumulate(np.minimum(earlier, far))
    upto = np.searchsorted(base + n, base + reach, side="right") - 1
    some = upto >= first[group]
    upto = np.maximum(upto, 0)
    best = np.where((upto >= np.arange(len(n))) & (most[upto] == far), second[upto], most[upto])
    return np.sort(order[some & (best > base + n)])


def tie(sizes: list[int], bits: list[bytes], percent: int) -> list[int]:
    """The group of every set, as a position in it."""
    n = np.array(sizes, np.int64)
    groups = Groups(len(n))
    order = np.argsort(n, kind="stable")
    ascending = n[order]
    for run in np.split(order, np.flatnonzero(100 * ascending[:-1] < percent * ascending[1:]) + 1):
        if len(run) > 1:
            words = min(len(bits[k]) for k in run) // 8
            _tie_run(run, n, np.stack([_folded(bits[k], words) for k in run]), percent, groups)
    return [groups.find(k) for k in range(len(n))]


def _tie_run(run: np.ndarray, n: np.ndarray, rows: np.ndarray, percent: int, groups: Groups) -> None:
    """Two sets of sizes p and q that link differ in at most (100 - percent) / (100 + percent) * (p + q) items."""
    waiting = [(np.arange(len(run)), 0)]
    while waiting:
        part, tried = waiting.pop()
        if len(part) < 2:
            continue
        if len(part) <= FEW:
            apart = np.bitwise_count(rows[part][:, None] ^ rows[part][None]).sum(axis=2, dtype=np.int64)
            both = n[run[part]][:, None] + n[run[part]][None]
            smaller, larger = np.minimum.outer(n[run[part]], n[run[part]]), np.maximum.outer(n[run[part]], n[run[part]])
            may = ((100 + percent) * apart <= (100 - percent) * both) & (100 * smaller >= percent * larger)
            for i, j in zip(*np.nonzero(np.triu(may, 1)), strict=True):
                groups.join(int(run[part[i]]), int(run[part[j]]))
            continue
        if tried == PIVOTS:
            for k in part[1:]:
                groups.join(int(run[part[0]]), int(run[k]))
            continue
        pivot = part[(tried * 7919) % len(part)]
        far = np.bitwise_count(rows[part] ^ rows[pivot]).sum(axis=1, dtype=np.int64)
        gap = (100 - percent) * 2 * int(n[run[part]].max()) / (100 + percent)
        cut = _runs(far, gap)
        waiting.extend((part[c], 0 if len(cut) > 1 else tried + 1) for c in cut)
