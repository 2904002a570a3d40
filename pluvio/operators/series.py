"""Row positions in long series and cutting a series into blocks with overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], part: Column, total: str | None = None) -> DataFrame:
    """Add `pos`, the 0-based row number of a series, without gathering a series in one task.

    `part` is a coarse, monotone slice of the order (such as the month). Rows are counted per
    slice before the shuffle, slice starts are running sums of the counts, and only the rows of
    one slice are sorted together. `total` names a column for the number of rows of the series.
    """
    sliced = df.withColumn("part_", part)
    counts = sliced.groupBy(*keys, "part_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy(*keys).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    size = [F.sum("n_").over(Window.partitionBy(*keys)).alias(total)] if total else []
    starts = counts.select(
        *keys, "part_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("start_"), *size
    )
    inside = Window.partitionBy(*keys, "part_").orderBy(*order)
    return (
        sliced.join(starts, [*keys, "part_"])
        .withColumn("pos", F.col("start_") + F.row_number().over(inside) - 1)
        .drop("part_", "start_")
    )


def with_blocks(df: DataFrame, block: int, back: int, ahead: int) -> DataFrame:
    """Copy rows into blocks of `block` positions, each with the overlap its rows look at.

    A row looks back `back` rows and ahead `ahead` rows. `core` tells the rows a block owns; every
    row is core in one block. Operators run per (series, block_id) and keep the core rows.
    """
    pos = F.col("pos")
    first = F.greatest(F.lit(0), F.floor((pos - ahead) / block))
    last = F.floor((pos + back) / block)
    return df.withColumn("block_id", F.explode(F.sequence(first, last))).withColumn(
        "core", F.col("block_id") == F.floor(pos / block)
    )
