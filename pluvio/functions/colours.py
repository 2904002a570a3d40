"""Colours of rain intensity (classes) and of hour sums (ramp)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Class boundaries in mm/h and the RGB colour of each class.
CLASS_LEVELS = [
    0.1, 0.115307, 0.205048, 0.364633, 0.648420, 1.153072, 2.050483,
    3.646332, 6.484198, 11.53072, 20.50483, 36.46332, 64.84198, 115.3072,
]
CLASS_RGB = [
    (57, 0, 112), (47, 1, 169), (0, 0, 252), (0, 108, 192), (0, 160, 0), (0, 188, 0), (52, 216, 0),
    (156, 220, 0), (224, 220, 0), (252, 176, 0), (252, 132, 0), (252, 88, 0), (252, 0, 0), (160, 0, 0),
]
# Levels of the hour-sum ramp in mm and their colours.
RAMP = {
    0.1: "#370070", 0.3: "#2e02a5", 0.6: "#0001fc", 1.0: "#006dbd", 2.0: "#00a000",
    4.0: "#00bb02", 6.0: "#35d700", 10.0: "#9fdb00", 15.0: "#dfdd00", 20.0: "#fcb100",
    30.0: "#fb8500", 40.0: "#ff5700", 60.0: "#fc0000", 80.0: "#9f0100", 100.0: "#fdfbfd",
}


def _levels_reached(v: Column, levels: list[float]) -> Column:
    total = F.lit(0)
    for level in levels:
        total = total + (v >= level).cast("int")
    return total


def intensity_class(v: Column, variant: str = "in_use") -> Column:
    """Class 0..13 of a rate, NULL (transparent) below 0.1 mm/h and for missing values.

    The variant in use starts at class 1; `exact` is one class lower.
    """
    reached = _levels_reached(v, CLASS_LEVELS)
    chosen = F.least(reached, F.lit(13)) if variant == "in_use" else reached - 1
    return F.when(v >= CLASS_LEVELS[0], chosen)


def intensity_rgba(v: Column, variant: str = "in_use") -> Column:
    """Array of four 0..255 values."""
    table = F.array(*[F.array(*[F.lit(c) for c in (*rgb, 255)]) for rgb in CLASS_RGB])
    return F.coalesce(F.get(table, intensity_class(v, variant)), F.array(*[F.lit(0)] * 4))


def _ramp_table() -> tuple[list[float], list[tuple[int, int, int]]]:
    levels = sorted(RAMP)
    return levels, [tuple(bytes.fromhex(RAMP[v][1:])) for v in levels]


def with_hour_sum_rgba(df: DataFrame, value: str, name: str = "rgba") -> DataFrame:
    """Add the colour mixed between the two enclosing levels; visible from the second level on.

    Interval and position are columns of their own, so the generated code computes them once.
    """
    levels, colours = _ramp_table()
    low = F.array(*[F.lit(x) for x in levels])
    out = df.withColumn("z_", F.least(F.greatest(value, F.lit(levels[0])), F.lit(levels[-1])))
    out = out.withColumn("i_", F.least(_levels_reached(F.col("z_"), levels) - 1, F.lit(len(levels) - 2)))
    base = F.get(low, F.col("i_"))
    out = out.withColumn("t_", (F.col("z_") - base) / (F.get(low, F.col("i_") + 1) - base))

    def channel(c: int) -> Column:
        table = F.array(*[F.lit(float(rgb[c])) for rgb in colours])
        mixed = (F.lit(1.0) - F.col("t_")) * F.get(table, F.col("i_")) + F.col("t_") * F.get(table, F.col("i_") + 1)
        return F.rint(mixed).cast("int")

    shown = F.array(channel(0), channel(1), channel(2), F.lit(255))
    hidden = F.array(*[F.lit(0)] * 4)
    return out.withColumn(name, F.when(F.col(value) >= levels[1], shown).otherwise(hidden)).drop("z_", "i_", "t_")


def ramp_levels(spark: SparkSession) -> DataFrame:
    """The hour-sum palette ordered by level."""
    levels, colours = _ramp_table()
    return spark.createDataFrame(
        [(i, lv, *rgb) for i, (lv, rgb) in enumerate(zip(levels, colours))],
        "idx int, level double, red int, green int, blue int",
    ).orderBy("level")
