"""Wet and dry periods from the rolling deviation of the path loss."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pluvio.operators.quality import CHANNEL


def rolling_frame(keys: list[str], n: int, centered: bool = False, order: str = "time") -> WindowSpec:
    """n rows ending at the current one, or n rows around it (the longer half before it)."""
    frame = (-(n // 2), (n - 1) // 2) if centered else (-(n - 1), 0)
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(*frame)


def rolling_wet(channels: DataFrame, n: int = 10, threshold: float = 0.8, centered: bool = False) -> DataFrame:
    """wet = population deviation over n known rows above the threshold; short windows are dry."""
    w = rolling_frame(CHANNEL, n, centered)
    full = F.count("trsl").over(w) == n
    return channels.withColumn("wet", F.when(full, F.stddev_pop("trsl").over(w) > threshold).otherwise(False))


def wet_fraction(channels: DataFrame) -> DataFrame:
    """Share of wet rows per channel."""
    return channels.groupBy("cml_id", "channel_id").agg(
        F.avg(F.coalesce(F.col("wet"), F.lit(False)).cast("int")).alias("wet_fraction"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def flags_to_steps(flags: DataFrame, minutes: int = 10, rule: str = "max") -> DataFrame:
    """Fine wet flags (cml_id, time, wet 0/1/NULL) to steps labelled by their start."""
    wet = F.col("wet").cast("double")
    value = F.max(wet) if rule == "max" else F.when(F.avg(wet) >= 0.5, 1.0).otherwise(0.0)
    return (
        flags.groupBy("cml_id", F.window("time", f"{minutes} minutes"))
        .agg(value.alias("wet"))
        .select("cml_id", F.col("window.start").alias("time"), "wet")
    )


def attach_flags(channels: DataFrame, steps: DataFrame) -> DataFrame:
    """Wet flags joined on the exact time; a time without a flag is dry."""
    flags = steps.select("cml_id", "time", F.col("wet").alias("wet_"))
    return channels.join(flags, ["cml_id", "time"], "left").withColumn(
        "wet", F.coalesce(F.col("wet_"), F.lit(0.0)) > 0.5
    ).drop("wet_")
