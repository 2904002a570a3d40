"""Baseline of the path loss and the time-dependent wet-antenna attenuation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators import recursion
from pluvio.operators.grouped import whole_groups
from pluvio.operators.quality import CHANNEL
from pluvio.session import ship


def last_dry_baseline(channels: DataFrame) -> DataFrame:
    """Baseline with one averaged sample: the last dry value, carried on through wet rows.

    Rows marked in a column `given` bring the value held at them in `given_baseline`, from which later rows go on; `held` is then
    returned as well.
    """
    w = Window.partitionBy(*CHANNEL).orderBy("time")
    numbered = channels.withColumn("first_", F.row_number().over(w) == 1)
    own = F.struct(F.col("trsl").alias("v"))
    anchor = F.when(F.col("first_") | (F.col("wet") == False), own)  # noqa: E712
    given = "given" in channels.columns
    if given:
        anchor = F.when(F.col("given"), F.struct(F.col("given_baseline").alias("v"))).otherwise(anchor)
    held = F.last(anchor, True).over(w.rowsBetween(Window.unboundedPreceding, 0))["v"]
    out = numbered.withColumn("held", held).withColumn("baseline", F.when(F.col("wet").isNotNull() | F.col("first_"), F.col("held")))
    return out.drop("first_") if given else out.drop("first_", "held")


def with_episodes(channels: DataFrame, n: int, block: int = 4096) -> DataFrame:
    """Number pieces of a channel that can be walked independently.

    A piece may begin where the next n rows are all dry: there the baseline equals the path loss,
    just as at the start of a series, and nothing before matters. Pieces begin at the first such
    row of each block of positions. `since` counts the rows from the start of the piece.
    """
    w = Window.partitionBy(*CHANNEL).orderBy("time")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    dry = F.coalesce(F.col("wet") == False, F.lit(False)).cast("int")  # noqa: E712
    marked = channels.withColumns(
        {
            "pos": F.row_number().over(w) - 1,
            "quiet_": F.sum(dry).over(w.rowsBetween(0, n - 1)) == n,
        }
    )
    previous = F.max(F.when(F.col("quiet_"), F.col("pos"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    cut = F.col("quiet_") & (
        F.floor(F.col("pos") / block) > F.floor(F.coalesce(previous, F.lit(0)) / block)
    )
    return marked.withColumn("cut_", F.coalesce(cut, F.lit(False))).withColumns(
        {
            "episode": F.sum(F.col("cut_").cast("int")).over(so_far),
            "since": F.col("pos") - F.coalesce(F.max(F.when(F.col("cut_"), F.col("pos"))).over(so_far), F.lit(0)),
        }
    ).drop("quiet_", "cut_")


def walk(
    trsl: np.ndarray, wet: np.ndarray, since: np.ndarray, n: int, waa_max: float, rise: float,
    given: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """Baseline and wet-antenna attenuation of pieces, one after the other; wet is 0, 1 or NaN.

    Only wet rows need the walk: on dry rows both follow from the path loss alone. `given` has a mask of rows whose baseline and
    wet-antenna attenuation are known, and these; the walk goes on from them.
    """
    baseline = np.where((since < n) | ~np.isnan(wet), trsl, np.nan)
    known = np.zeros(len(trsl), bool) if given is None else given[0]
    if given is not None:
        baseline[known] = given[1][known]
    rows = np.flatnonzero((wet == 1) & ~known)
    with np.errstate(invalid="ignore"):
        for i in rows[since[rows] >= n]:
            onset = wet[i - 1] != 1
            baseline[i] = baseline[i - n : i].mean() if onset else baseline[i - 1]
        waa = np.minimum(trsl - baseline, waa_max)
        if given is not None:
            waa[known] = given[2][known]
        for i in rows[since[rows] > 0]:
            waa[i] = np.minimum(waa[i], waa[i - 1] + (waa_max - waa[i - 1]) * rise)
    return baseline, waa


def baseline_and_waa(
    channels: DataFrame,
    n: int = 5,
    waa_max: float = 2.2,
    tau: float = 15.0,
    step_minutes: float = 10.0,
    step_in_hours: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """Add `baseline` (n samples averaged before each wet period) and `waa` (Schleiss 2013).

    The wet-antenna attenuation climbs by 3*step/tau of the distance to its maximum per step;
    step and tau are both in minutes unless `step_in_hours`. Rows marked in a column `given` have both in `given_baseline` and
    `given_waa`, from which later rows go on.

    With `block_rows`, a long channel is spread over tasks of that many rows (see `recursion`); carried rows are not looked at then.

    The windows that number the pieces leave each channel whole and sorted in one partition, so the
    walk needs no further shuffle.
    """
    rise = 3.0 * (step_minutes / 60.0 if step_in_hours else step_minutes) / tau
    if block_rows and "given" not in channels.columns:
        return recursion.baseline_in_blocks(channels, n, waa_max, rise, max(block_rows, n))
    pieces = with_episodes(channels, n).sortWithinPartitions(*CHANNEL, "pos")
    columns = [*channels.columns, "baseline", "waa"]
    carried = "given" in channels.columns
    types = dict(channels.dtypes)
    schema = ", ".join(f"`{c}` {types.get(c, 'double')}" for c in columns)

    def chunk(pdf: pd.DataFrame, _starts: np.ndarray) -> pd.DataFrame:
        wet = pdf["wet"].astype("float64").to_numpy()
        given = None
        if carried:
            mask = pdf["given"].fillna(False).to_numpy(bool)
            given = (mask, pdf["given_baseline"].to_numpy("float64"), pdf["given_waa"].to_numpy("float64"))
        base, waa = walk(pdf["trsl"].to_numpy("float64"), wet, pdf["since"].to_numpy(), n, waa_max, rise, given)
        return pdf.assign(baseline=base, waa=waa)[columns]

    ship(pieces.sparkSession)
    out = pieces.mapInPandas(lambda batches: whole_groups(batches, [*CHANNEL, "episode"], chunk), schema)
    return out.withColumns(
        {c: F.when(~F.isnan(c), F.col(c)) for c in ("baseline", "waa")}
    )
