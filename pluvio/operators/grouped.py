"""Walking sorted groups in pandas, many small groups per Arrow batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from pluvio.session import ship

Chunk = Callable[[pd.DataFrame, np.ndarray], pd.DataFrame]


def group_starts(pdf: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """Offsets at which a new group begins, in rows sorted by the keys."""
    changed = np.zeros(len(pdf), dtype=bool)
    changed[:1] = True
    for k in keys:
        v = pdf[k].to_numpy()
        changed[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(changed)


def whole_groups(batches: Iterator[pd.DataFrame], keys: Sequence[str], fn: Chunk) -> Iterator[pd.DataFrame]:
    """Call fn(rows, group starts) on chunks of whole groups; the last group of a batch waits for the next.

    Held back are the rows of one group, whose size the caller bounds.
    """
    held: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        if held and all(held[-1][k].iloc[-1] == pdf[k].iloc[-1] for k in keys) and all(
            held[-1][k].iloc[-1] == pdf[k].iloc[0] for k in keys
        ):
            held.append(pdf)  # the whole batch goes on with the same group
            continue
        rows = pd.concat([*held, pdf], ignore_index=True) if held else pdf
        starts = group_starts(rows, keys)
        if len(starts) > 1:
            yield fn(rows.iloc[: starts[-1]], starts[:-1])
        held = [rows.iloc[starts[-1] :]]
    if held:
        rows = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
        yield fn(rows, group_starts(rows, keys))


def map_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], fn: Chunk, schema: str) -> DataFrame:
    """Bring groups together, sort them and map them in chunks.

    The number of partitions is given, so that the optimizer does not merge small ones: the work
    is in Python, not in reading the rows.
    """
    ship(df.sparkSession)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = list(keys)
    placed = df.repartition(n, *keys).sortWithinPartitions(*keys, *order)
    return placed.mapInPandas(lambda batches: whole_groups(batches, columns, fn), schema)
