"""The baseline and wet-antenna recursions of long channels, block by block.

Both carry a small state from row to row. What a block of rows does to the state can be written down without knowing it:

* the last n baselines after a block are averages of the n before it and of path losses in it, a matrix and a vector;
* the wet-antenna attenuation after a block is min(high, max(low, c * x + d)) of that before it, x, and such functions of falling or
  rising lines are closed under composition. A row that is not wet makes it a constant.

So every block is summarised on its own, one row a block is walked through per channel, and every block is then filled from the state
it begins with. A channel that never gets dry is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.operators.grouped import map_groups
from pluvio.operators.quality import CHANNEL
from pluvio.operators.series import with_blocks, with_positions
from pluvio.session import stage


def averages(trsl: np.ndarray, wet: np.ndarray, before: float, pos: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, vector): the last n baselines after some rows from the n before them. `before` is the wet flag of the row before."""
    size = len(trsl)
    share, own = np.zeros((n + size, n)), np.zeros(n + size)
    share[:n] = np.eye(n)
    own[n:] = np.where((pos < n) | ~np.isnan(wet), trsl, np.nan)
    flags = np.concatenate([[before], wet])
    for i in np.flatnonzero((wet == 1) & (pos >= n)).tolist():
        at = n + i
        if flags[i] == 1:
            share[at], own[at] = share[at - 1], own[at - 1]
        else:
            share[at], own[at] = share[at - n:at].mean(axis=0), own[at - n:at].mean()
    return share[size:], own[size:]


def averaged(share: np.ndarray, own: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The state after a block; a baseline that is missing counts only where it has a share."""
    return own + np.where(share != 0, share * state, 0.0).sum(axis=1)


Line = tuple[float, float, float, float]  # low, high, c, d; where c is NaN, the constant d


def clamp(value: float, f: Line) -> float:
    low, high, c, d = f
    return d if np.isnan(c) else float(np.minimum(high, np.maximum(low, c * value + d)))


def constant(value: float) -> Line:
    return (-np.inf, np.inf, np.nan, value)


def after(f: Line, g: Line) -> Line:
    """g of f."""
    if np.isnan(g[2]):
        return g
    if np.isnan(f[2]):
        return constant(clamp(f[3], g))
    low, high = (at_end(g, f[0]), at_end(g, f[1]))[:: 1 if g[2] >= 0 else -1]
    return (low, high, f[2] * g[2], g[2] * f[3] + g[3])


def at_end(g: Line, end: float) -> float:
    """g at the end of a range, which may be infinite."""
    if np.isfinite(end) or g[2] == 0:
        return clamp(end if np.isfinite(end) else 0.0, g)
    return g[1] if (end > 0) == (g[2] > 0) else g[0]


def climb(trsl: np.ndarray, baseline: np.ndarray, wet: np.ndarray, pos: np.ndarray, most: float, rise: float) -> Line:
    """What some rows do to the wet-antenna attenuation."""
    with np.errstate(invalid="ignore"):
        own = np.minimum(trsl - baseline, most)
    fixed = np.flatnonzero((wet != 1) | (pos == 0))
    f, start = (-np.inf, np.inf, 1.0, 0.0), 0
    if len(fixed):
        start = int(fixed[-1]) + 1
        f = constant(float(own[start - 1]))
    for a in own[start:].tolist():
        f = after(f, constant(np.nan) if np.isnan(a) else (-np.inf, a, 1.0 - rise, most * rise))
    return f


def baseline_in_blocks(channels: DataFrame, n: int, waa_max: float, rise: float, block: int) -> DataFrame:
    """`baseline.baseline_and_waa` for channels of any length: no task has more than a block of rows of a channel, or one row a block."""
    from pluvio.operators.baseline import walk

    own = [*CHANNEL, "block_id"]
    placed = with_positions(channels, CHANNEL, ["time"], F.date_trunc("month", "time"))
    rows = stage(with_blocks(placed, block, 1, 0), "blocks")
    slim = rows.select(*own, "pos", "core", "trsl", F.col("wet").cast("double").alias("wet"))
    keys = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in own)

    def parts(pdf: pd.DataFrame, starts: np.ndarray):
        """The rows the blocks of a chunk own as one frame, where each block begins and ends in it, and the wet flag of the row before each."""
        core, ends = pdf["core"].to_numpy(bool), np.append(starts[1:], len(pdf))
        wet = pdf["wet"].to_numpy("float64", na_value=np.nan)
        so_far = np.concatenate([[0], np.cumsum(core)])
        # The row before a block, if it has one, comes first.
        before = np.where(core[starts], np.nan, wet[starts])
        return pdf[core], wet[core], so_far[starts], so_far[ends], before

    def averages_of(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        mine, wet, first, last, before = parts(pdf, starts)
        trsl, pos = mine["trsl"].to_numpy("float64"), mine["pos"].to_numpy()
        made = [averages(trsl[a:b], wet[a:b], flag, pos[a:b], n) for a, b, flag in zip(first.tolist(), last.tolist(), before.tolist(), strict=True)]
        return pdf[own].iloc[starts].assign(share=[share.ravel() for share, _ in made], vector=[vector for _, vector in made])

    def states(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        out, fresh = [], set(starts.tolist())
        for k, (share, vector) in enumerate(zip(pdf["share"].to_numpy(), pdf["vector"].to_numpy(), strict=True)):
            state = np.full(n, np.nan) if k in fresh else state
            out.append(state)
            state = averaged(np.asarray(share).reshape(n, n), np.asarray(vector), state)
        return pdf[own].assign(state=out)

    def walked(pdf: pd.DataFrame, starts: np.ndarray, waa: np.ndarray):
        """Baseline and wet-antenna attenuation of the blocks of a chunk from the states before them, which are laid before their rows."""
        mine, wet, first, last, before = parts(pdf, starts)
        pos, size = mine["pos"].to_numpy(), last - first
        heads = (first + n * np.arange(len(starts)))[:, None] + np.arange(n)
        rows = np.arange(len(mine)) + n * np.repeat(np.arange(1, len(starts) + 1), size)
        total = len(mine) + heads.size
        trsl, flags, since = np.full(total, np.nan), np.full(total, np.nan), np.full(total, n)
        trsl[rows], flags[rows], since[rows] = mine["trsl"].to_numpy("float64"), wet, pos
        flags[heads[:, -1]] = before
        known, base, up = np.zeros(total, bool), np.full(total, np.nan), np.full(total, np.nan)
        known[heads] = True
        base[heads] = np.array([np.asarray(x, float) for x in pdf["state"].iloc[starts]])
        up[heads] = waa[:, None]
        base, up = walk(trsl, flags, since, n, waa_max, rise, (known, base, up))
        return mine, wet, pos, first, last, base[rows], up[rows]

    def climbs_of(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        mine, wet, pos, first, last, base, _ = walked(pdf, starts, np.full(len(starts), np.nan))
        trsl = mine["trsl"].to_numpy("float64")
        made = [climb(trsl[a:b], base[a:b], wet[a:b], pos[a:b], waa_max, rise) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        return pdf[own].iloc[starts].assign(climb=[list(f) for f in made])

    def levels(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        out, fresh = [], set(starts.tolist())
        for k, f in enumerate(pdf["climb"].to_numpy()):
            waa = np.nan if k in fresh else waa
            out.append(waa)
            waa = clamp(waa, tuple(f))
        return pdf[own].assign(waa_before=out)

    columns = [*channels.columns, "baseline", "waa"]
    types = dict(channels.dtypes)

    def filled(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        mine, *_, base, up = walked(pdf, starts, pdf["waa_before"].to_numpy("float64")[starts])
        return mine.assign(baseline=base, waa=up)[columns]

    summaries = map_groups(slim, own, ["pos"], averages_of, f"{keys}, share array<double>, vector array<double>")
    begun = stage(map_groups(summaries, CHANNEL, ["block_id"], states, f"{keys}, state array<double>"), "states")
    climbs = map_groups(slim.join(begun, own), own, ["pos"], climbs_of, f"{keys}, climb array<double>")
    wetted = stage(map_groups(climbs, CHANNEL, ["block_id"], levels, f"{keys}, waa_before double"), "levels")
    schema = ", ".join(f"`{c}` {types.get(c, 'double')}" for c in columns)
    out = map_groups(rows.join(begun, own).join(wetted, own), own, ["pos"], filled, schema)
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("baseline", "waa")})
