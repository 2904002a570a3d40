"""Cleaning of paired link series before wet/dry classification.

Operators take the key columns of a series, ordered by `time`, one row per step.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators.grouped import map_groups
from pluvio.operators.rolling import rolling

# Fixed value: path loss from here on is not a measurement.
MAX_PATH_LOSS = 99.0


def _ordered(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("time")


def _so_far(keys: Sequence[str]):
    return _ordered(keys).rowsBetween(Window.unboundedPreceding, 0)


def _from_here(keys: Sequence[str]):
    """The rows from here on, walked from the end."""
    return Window.partitionBy(*keys).orderBy(F.col("time").desc()).rowsBetween(Window.unboundedPreceding, 0)


def paired_path_loss(paired: DataFrame) -> DataFrame:
    def loss(side: str) -> Column:
        x = F.col(f"tsl_{side}") - F.col(f"rsl_{side}")
        return F.when(x < MAX_PATH_LOSS, x)

    return paired.withColumns({"trsl_a": loss("a"), "trsl_b": loss("b")})


def fill_by_position(df: DataFrame, keys: Sequence[str], columns: Sequence[str], limit: int = 10) -> DataFrame:
    """Straight-line fill by row number, at most `limit` rows into a gap; a trailing gap repeats its last value."""
    numbered = df.withColumn("n_", F.row_number().over(_ordered(keys)))

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col(c).cast("double").alias("v"), F.col("n_").alias("n")))

    found = numbered.withColumns({f"{c}_p": F.last(known(c), True).over(_so_far(keys)) for c in columns}).withColumns(
        {f"{c}_q": F.last(known(c), True).over(_from_here(keys)) for c in columns}
    )

    def filled(c: str) -> Column:
        p, q, n = F.col(f"{c}_p"), F.col(f"{c}_q"), F.col("n_")
        line = p["v"] + (q["v"] - p["v"]) * (n - p["n"]) / (q["n"] - p["n"])
        return F.when(F.col(c).isNotNull(), F.col(c)).when(
            n - p["n"] <= limit, F.when(q.isNotNull(), line).otherwise(p["v"])
        )

    return found.withColumns({c: filled(c) for c in columns}).drop(
        "n_", *[f"{c}_p" for c in columns], *[f"{c}_q" for c in columns]
    )


def drop_unsteady(df: DataFrame, keys: Sequence[str], columns: Sequence[str], window: int = 10, limit: float = 5.0) -> DataFrame:
    """Blank values where the centred rolling sample deviation reaches the limit.

    Rows without a whole window take the next deviation, at the end the last one. Deviations are
    compared to nine decimals: levels come in fixed steps, and the order of summing must not decide.
    """
    out = rolling(df, keys, {f"{c}_d": c for c in columns}, window, "std", centered=True)
    out = out.withColumns({f"{c}_q": F.last(f"{c}_d", True).over(_from_here(keys)) for c in columns})
    out = out.withColumns({f"{c}_d": F.coalesce(f"{c}_d", f"{c}_q") for c in columns})
    out = out.withColumns({f"{c}_p": F.last(f"{c}_d", True).over(_so_far(keys)) for c in columns})
    out = out.withColumns(
        {c: F.when(F.round(F.coalesce(F.col(f"{c}_d"), F.col(f"{c}_p")), 9) < limit, F.col(c)) for c in columns}
    )
    return out.drop(*[f"{c}_{x}" for c in columns for x in "dqp"])


def drop_outliers(df: DataFrame, keys: Sequence[str], columns: Sequence[str], limit: float = 10.0, lowest: float = -5.0) -> DataFrame:
    """Blank values whose z-score is beyond the limits."""
    whole = Window.partitionBy(*keys)

    def kept(c: str) -> Column:
        z = (F.col(c) - F.avg(c).over(whole)) / F.nullif(F.stddev_samp(c).over(whole), F.lit(0.0))
        return F.when((F.abs(z) < limit) & (z > lowest), F.col(c))

    return df.withColumns({c: kept(c) for c in columns})


def step_scores(df: DataFrame, keys: Sequence[str], column: str, half: int = 500) -> DataFrame:
    """Add `score`: how far the sums of the `half` rows from here on and before differ, scaled to 0..1 values.

    Both sums are differences of one running sum. Rows without both halves, or with a missing
    value in them, score 0.
    """
    whole, order = Window.partitionBy(*keys), _ordered(keys)
    low, high = F.min(column).over(whole), F.max(column).over(whole)
    scaled = (F.col(column) - low) / F.nullif(high - low, F.lit(0.0))
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("x_", scaled).withColumns(
        {"s_": F.sum(F.coalesce("x_", F.lit(0.0))).over(run), "k_": F.count("x_").over(run)}
    )

    def at(c: str, offset: int) -> Column:
        return (F.lead(c, offset) if offset >= 0 else F.lag(c, -offset)).over(order)

    # The running values before the first row are 0.
    out = out.withColumn("n_", F.row_number().over(order))
    before = {c: F.when(F.col("n_") == half + 1, F.lit(0)).otherwise(at(c, -half - 1)) for c in ("s_", "k_")}
    out = out.withColumns(
        {
            "up_": at("s_", half - 1) - at("s_", -1), "down_": at("s_", -1) - before["s_"],
            "seen_": at("k_", half - 1) - before["k_"],
        }
    )
    score = F.when(F.col("seen_") == 2 * half, F.abs(F.col("up_") - F.col("down_"))).otherwise(0.0)
    return out.withColumn("score", score).drop("x_", "s_", "k_", "n_", "up_", "down_", "seen_")


def prominent(levels: np.ndarray, least: float) -> np.ndarray:
    """Places of the local peaks of a run that stand out by at least so much.

    A flat peak counts once, in its middle; the ends of a run are no peaks. A peak stands out above the higher of the lowest values
    towards either side, up to the next higher value or the end of the run.
    """
    first = np.flatnonzero(np.diff(levels, prepend=np.nan))
    value = levels[first]
    last = np.append(first[1:], len(levels)) - 1

    def lowest(v: list) -> list:
        """The lowest value from the nearest higher one before up to each."""
        out, higher = [], []
        for k, x in enumerate(v):
            low = x
            while higher and v[higher[-1]] <= x:
                low = min(low, out[higher.pop()])
            out.append(low)
            higher.append(k)
        return out

    inner = np.flatnonzero((value[1:-1] > value[:-2]) & (value[1:-1] > value[2:])) + 1
    base = np.maximum(lowest(value.tolist()), lowest(value[::-1].tolist())[::-1]) if len(value) else value
    peaks = inner[value[inner] - base[inner] >= least]
    return (first[peaks] + last[peaks]) // 2


def step_rows(scored: DataFrame, keys: Sequence[str], threshold: float, prominence: float = 1.0) -> DataFrame:
    """Add `step`: the peaks of at least this prominence within each run of scores above the threshold.

    Scores that agree to 1e-6 are equal. Only rows above the threshold are brought together, run by run.
    """
    order = _ordered(keys)
    above = F.col("score") > threshold
    runs = scored.select(*keys, "time", above.alias("above_"), F.floor(F.col("score") * 1e6 + 0.4997).cast("double").alias("level_")).withColumn(
        "run_", F.sum(F.when(F.col("above_") != F.lag("above_", 1, False).over(order), 1).otherwise(0)).over(_so_far(keys))
    )
    columns = [*keys, "time"]

    def peaks(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        levels = pdf["level_"].to_numpy()
        at = [a + prominent(levels[a:b], prominence * 1e6) for a, b in zip(starts, [*starts[1:], len(pdf)], strict=True)]
        return pdf.iloc[np.concatenate(at)][columns]

    schema = ", ".join(f"`{c}` {scored.schema[c].dataType.simpleString()}" for c in columns)
    found = map_groups(runs.where("above_").drop("above_"), [*keys, "run_"], ["time"], peaks, schema)
    marked = scored.join(found.withColumn("step", F.lit(True)), columns, "left").withColumn("step", F.coalesce("step", F.lit(False)))
    return marked.select(*scored.columns, "step")


def repair_steps(df: DataFrame, keys: Sequence[str], column: str, half: int = 500, threshold: float = 250.0) -> DataFrame:
    """Blank the rows around each step and take the mean of each stretch between steps out of it."""
    whole, order = Window.partitionBy(*keys), _ordered(keys)
    marked = step_rows(step_scores(df, keys, column, half), keys, threshold)
    near = F.max("step").over(order.rowsBetween(-4, 5))
    varies = F.min(column).over(whole) < F.max(column).over(whole)
    marked = marked.withColumns(
        {
            "blank_": F.when(near, F.lit(None)).otherwise(F.col(column)),
            "stretch_": F.sum(F.col("step").cast("int")).over(_so_far(keys)),
            "varies_": varies,
        }
    )
    mean = F.avg("blank_").over(Window.partitionBy(*keys, "stretch_"))
    return marked.withColumn(
        column, F.when(F.col("varies_"), F.col("blank_") - mean).otherwise(F.col(column))
    ).drop("blank_", "stretch_", "varies_", "score", "step")


def drop_resets(df: DataFrame, keys: Sequence[str], columns: Sequence[str], uptimes: Sequence[str]) -> DataFrame:
    """Blank rows at which any uptime did not grow, and drop rows with nothing left."""
    order = _ordered(keys)
    reset = F.lit(False)
    for u in uptimes:
        reset = reset | F.coalesce(F.col(u) <= F.lag(u).over(order), F.lit(False))
    out = df.withColumn("reset_", reset)
    out = out.withColumns({c: F.when(~F.col("reset_"), F.col(c)) for c in columns}).drop("reset_")
    return out.na.drop(how="all", subset=list(columns))


def subtract_median(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], window: int = 10000, centered: bool = True, min_rows: int | None = None
) -> DataFrame:
    out = rolling(df, keys, {f"{c}_m": c for c in columns}, window, "median", centered=centered, min_rows=min_rows)
    return out.withColumns({c: F.col(c) - F.col(f"{c}_m") for c in columns}).drop(*[f"{c}_m" for c in columns])


def shift_ahead(df: DataFrame, keys: Sequence[str], columns: Sequence[str], rows: int = 29) -> DataFrame:
    """Values moved `rows` rows forward in time; the last value fills the end."""
    order = _ordered(keys)
    last = {
        c: F.last(c).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) for c in columns
    }
    n, size = F.row_number().over(order), F.count(F.lit(1)).over(Window.partitionBy(*keys))
    out = df.withColumns({"n_": n, "size_": size, **{f"{c}_l": last[c] for c in columns}, **{f"{c}_f": F.lead(c, rows).over(order) for c in columns}})
    out = out.withColumns(
        {c: F.when(F.col("n_") + rows > F.col("size_"), F.col(f"{c}_l")).otherwise(F.col(f"{c}_f")) for c in columns}
    )
    return out.drop("n_", "size_", *[f"{c}_{x}" for c in columns for x in "lf"])


def scale_by_max(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(x - mean) / max; missing where the maximum is 0."""
    whole = Window.partitionBy(*keys)
    return df.withColumns(
        {c: (F.col(c) - F.avg(c).over(whole)) / F.nullif(F.max(c).over(whole), F.lit(0.0)) for c in columns}
    )


def scale_to_range(df: DataFrame, keys: Sequence[str], columns: Sequence[str], constant: str = "missing") -> DataFrame:
    """(x - min) / (max - min); a constant series becomes `missing` or is left as it is (`keep`)."""
    whole = Window.partitionBy(*keys)

    def scaled(c: str) -> Column:
        low, high = F.min(c).over(whole), F.max(c).over(whole)
        value = (F.col(c) - low) / F.nullif(high - low, F.lit(0.0))
        return F.coalesce(value, F.col(c)) if constant == "keep" else value

    return df.withColumns({c: scaled(c) for c in columns})


def z_normalise(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation."""
    whole = Window.partitionBy(*keys)
    return df.withColumns(
        {c: (F.col(c) - F.avg(c).over(whole)) / F.nullif(F.stddev_pop(c).over(whole), F.lit(0.0)) for c in columns}
    )


def preprocess(
    paired: DataFrame,
    keys: Sequence[str] = ("cml_id",),
    *,
    max_gap: int = 10,
    keep_rows: bool = False,
    step_half: int = 500,
    step_threshold: float = 250.0,
    window: int = 10,
    deviation: float = 5.0,
    z_limit: float = 10.0,
    median_window: int = 10000,
) -> DataFrame:
    """The whole chain on rows with tsl, rsl of both channels and two temperatures.

    With `keep_rows` no row is dropped and steps are not repaired, so results can be put back on
    the time axis.
    """
    both, temperatures = ["trsl_a", "trsl_b"], ["temperature_rx", "temperature_tx"]
    df = fill_by_position(paired_path_loss(paired), keys, [*both, *temperatures], max_gap)
    if not keep_rows:
        df = df.na.drop(how="all", subset=both)
        for c in both:
            df = repair_steps(df, keys, c, step_half, step_threshold)
    df = drop_unsteady(df, keys, both, window, deviation)
    df = drop_outliers(df, keys, both, z_limit)
    df = drop_unsteady(df, keys, temperatures, 10, 2.0)
    df = subtract_median(df, keys, both, median_window)
    df = scale_by_max(df, keys, both)
    return scale_to_range(df, keys, temperatures, "missing" if keep_rows else "keep")


