"""Wet and dry periods from the short-time spectrum of the received level (Chwala et al. 2012)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators.grouped import map_groups
from pluvio.operators.rolling import rolling
from pluvio.operators.series import with_blocks, with_positions
from pluvio.session import stage

#: Series up to which what is known of each is sent to all tasks, so that spectra need not be shuffled.
BROADCAST_SERIES = 200_000


def spectra(windows: np.ndarray, taper: np.ndarray, f_sampling: float) -> np.ndarray:
    """One-sided power density of tapered windows (rows)."""
    size = windows.shape[1]
    power = np.abs(np.fft.rfft(windows * taper, axis=1)) ** 2 / (f_sampling * (taper**2).sum())
    inner = slice(1, -1) if size % 2 == 0 else slice(1, None)
    power[:, inner] *= 2.0
    return power


def frequencies(size: int, f_sampling: float) -> list[float]:
    return [i * f_sampling / size for i in range(size // 2 + 1)]


def spectrogram(
    df: DataFrame, keys: Sequence[str], value: str, window: int, f_sampling: float = 1 / 60, mirror: bool = False
) -> DataFrame:
    """(keys, time, pos, power array) with a Hamming window around every row; NULL without a whole window.

    With `mirror` (even windows), rows at the end use the samples before them and their mirror
    image. Series are cut into blocks with the overlap a window needs.
    """
    size = window + window % 2 if mirror else window
    before = (size - 1) // 2
    part = F.date_trunc("month", "time")
    placed = with_positions(df.select(*keys, "time", value), keys, ["time"], part, total="rows_")
    blocks = with_blocks(placed, 16384, size, size - 1 - before)
    types = dict(df.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in keys) + ", time timestamp, pos bigint, power array<double>"

    def one(x: np.ndarray, pos: np.ndarray, total: int) -> list:
        power = [None] * len(x)
        if len(x) >= size:
            done = spectra(np.lib.stride_tricks.sliding_window_view(x, size), taper, f_sampling)
            for j in np.flatnonzero(~np.isnan(done).any(axis=1)):
                power[j + before] = done[j]
        if mirror:
            for i in np.flatnonzero(pos >= total - size // 2):
                if i - (size // 2 - 1) >= 0:
                    head = x[i - (size // 2 - 1) : i]
                    both = np.concatenate([head, head[::-1], np.zeros(size - 2 * len(head))])
                    end = spectra(both[None, :], taper, f_sampling)[0]
                    power[i] = None if np.isnan(end).any() else end
        return power

    taper = np.hamming(size)

    def chunk(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        x, pos, totals = pdf[value].to_numpy("float64"), pdf["pos"].to_numpy(), pdf["rows_"].to_numpy()
        power: list = []
        for a, b in zip(starts, [*starts[1:], len(pdf)]):
            power += one(x[a:b], pos[a:b], int(totals[a]))
        return pdf[[*keys, "time", "pos"]].assign(power=power)[pdf["core"].to_numpy()]

    return map_groups(blocks, [*keys, "block_id"], ["pos"], chunk, schema)


def calmest_period(df: DataFrame, keys: Sequence[str], value: str, window: int = 600) -> DataFrame:
    """(keys, dry_start, dry_stop): row numbers of the first rolling window with the smallest sample deviation (to 1e-9)."""
    order = Window.partitionBy(*keys).orderBy("time")
    stds = rolling(df, keys, {"std_": value}, window, "std").withColumn("pos", F.row_number().over(order) - 1)
    return (
        stds.where("std_ is not null")
        .groupBy(*keys)
        .agg(F.min_by("pos", F.struct(F.floor(F.col("std_") * 1e9 + 0.4997), "pos")).cast("bigint").alias("dry_stop"))
        .select(*keys, (F.col("dry_stop") - window).alias("dry_start"), "dry_stop")
    )


def classify(
    spectrum: DataFrame, dry: DataFrame, keys: Sequence[str], freqs: list[float], f_divide: float, threshold: float
) -> DataFrame:
    """Add p_diff and wet: mean of the low minus the high band, both relative to the dry spectrum.

    Only the rows of the dry period are spread out by frequency; the mean dry spectrum comes back
    as one array per series. Both small tables are staged, so that no two shuffles of the spectra are on disk at once.
    """

    def small(df: DataFrame, name: str) -> DataFrame:
        df = stage(df, name)
        return F.broadcast(df) if df.limit(BROADCAST_SERIES + 1).count() <= BROADCAST_SERIES else df

    in_dry = (F.col("pos") >= F.col("dry_start")) & (F.col("pos") < F.col("dry_stop"))
    mean = small(
        spectrum.where("power is not null").join(small(dry, "dry"), [*keys]).where(in_dry)
        .select(*keys, F.posexplode("power").alias("i", "p"))
        .groupBy(*keys, "i").agg(F.avg("p").alias("p"))
        .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("i", "p"))).getField("p").alias("dry_power")),
        "dry_power",
    )
    low = sum(1 for f in freqs if f <= f_divide)
    high = len(freqs) - low

    def band(first: int, n: int):
        ratios = F.zip_with(
            F.slice("power", first + 1, n), F.slice("dry_power", first + 1, n), lambda p, q: p / F.nullif(q, F.lit(0.0))
        )
        return F.aggregate(ratios, F.lit(0.0), lambda acc, r: acc + r) / float(n)

    out = spectrum.join(mean, [*keys], "left").withColumn(
        "p_diff", F.when(F.col("power").isNotNull(), band(0, low) - band(low, high))
    )
    return out.withColumn("wet", F.coalesce(F.col("p_diff") > threshold, F.lit(False))).drop("dry_power")
