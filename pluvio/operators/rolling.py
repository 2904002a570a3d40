"""Rolling statistics with long windows, worked out in blocks of a series."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.functions.missing import null_if_nan
from pluvio.operators.grouped import map_groups
from pluvio.operators.series import with_blocks, with_positions
from pluvio.operators.sliding import deviation

# Up to this length Spark goes over the rows of every frame, which is cheapest and needs no other partitioning; longer windows go
# through blocks. Both work on nothing but the values of a window, so results do not depend on it.
FRAME_LIMIT = 64


def window_bounds(window: int, centered: bool) -> tuple[int, int]:
    """Rows back and ahead; the longer half of an even centred window lies before the row."""
    return (window // 2, (window - 1) // 2) if centered else (window - 1, 0)


def statistic(values: np.ndarray, window: int, need: int, stat: str) -> np.ndarray:
    """Trailing medians or sample deviations of one series; NaN where too few values are known.

    A deviation depends on the values of its window alone, and that of equal values is exactly 0.
    """
    if stat == "median":
        return pd.Series(values).rolling(window, min_periods=need).median().to_numpy()
    return deviation(values, window, need)


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    columns: dict[str, str],
    window: int,
    stat: str,
    *,
    centered: bool = False,
    min_rows: int | None = None,
    order: Sequence[str] = ("time",),
    part: Column | None = None,
) -> DataFrame:
    """Add columns {new: source} with the rolling `median` or sample `std` of known values.

    NaN and infinite values count as missing, whatever the window length. Fewer than `min_rows` known values (default: the whole window) give NULL. Long windows cost
    O(log window) per row in a block, and a long series is spread over as many tasks as it has
    blocks: positions come from `part`, a coarse slice of the order.
    """
    need = window if min_rows is None else min_rows
    back, ahead = window_bounds(window, centered)
    df = df.withColumns({f"__{src}": null_if_nan(F.col(src).cast("double")) for src in set(columns.values())})
    columns = {new: f"__{src}" for new, src in columns.items()}
    if window <= FRAME_LIMIT:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-back, ahead)
        make = (lambda c: F.percentile(c, 0.5)) if stat == "median" else F.stddev_samp
        return df.withColumns(
            {new: F.when(F.count(src).over(w) >= need, make(src).over(w)) for new, src in columns.items()}
        ).drop(*columns.values())
    part = F.date_trunc("month", order[0]) if part is None else part
    blocks = with_blocks(with_positions(df, keys, order, part), max(4 * window, 65536), back, ahead)
    names = [*[c for c in df.columns if c not in set(columns.values())], *columns]
    types = dict(df.dtypes)
    schema = ", ".join(f"`{c}` {types.get(c, 'double')}" for c in names)

    def chunk(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        done = {new: np.empty(len(pdf)) for new in columns}
        for a, b in zip(starts, [*starts[1:], len(pdf)]):
            for new, src in columns.items():
                # Trailing windows shifted back: rows beyond the end of the series count as missing.
                values = np.full(b - a + ahead, np.nan)
                values[: b - a] = pdf[src].iloc[a:b]
                done[new][a:b] = statistic(values, window, need, stat)[ahead:]
        return pdf.assign(**done).loc[pdf["core"].to_numpy(), names]

    out = map_groups(blocks, [*keys, "block_id"], ["pos"], chunk, schema)
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})
