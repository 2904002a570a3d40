"""Signal validity, gap filling and path loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHANNEL = ["cml_id", "channel_id"]
# Levels beyond these are not measurements.
MAX_TSL, MIN_RSL = 40.0, -70.0


def valid_signals(channels: DataFrame) -> DataFrame:
    rsl = F.col("rsl")
    return channels.withColumns(
        {
            "tsl": F.when(F.col("tsl") < MAX_TSL, F.col("tsl")),
            "rsl": F.when((rsl != 0.0) & (rsl > MIN_RSL), rsl),
        }
    )


def _micros(c: Column) -> Column:
    return F.unix_micros(c).cast("double")


def fill_gaps(df: DataFrame, keys: list[str], nearest: list[str] = (), linear: list[str] = ()) -> DataFrame:
    """Fill missing values between two known ones, by the nearest in time or on a straight line.

    A tie goes to the earlier value; leading and trailing gaps stay missing. The next known value
    is the previous one in descending order: both frames grow row by row, and all columns share
    the two sorts.
    """
    past = Window.partitionBy(*keys).orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    future = (
        Window.partitionBy(*keys).orderBy(F.col("time").desc()).rowsBetween(Window.unboundedPreceding, 0)
    )
    columns = [*nearest, *linear]

    def known(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), _micros(F.col("time")).alias("t")))

    found = df.withColumns({f"{c}_p": F.last(known(c), True).over(past) for c in columns}).withColumns(
        {f"{c}_n": F.last(known(c), True).over(future) for c in columns}
    )
    now = _micros(F.col("time"))

    def filled(c: str) -> Column:
        p, n = F.col(f"{c}_p"), F.col(f"{c}_n")
        back, ahead = now - p["t"], n["t"] - now
        if c in nearest:
            value = F.when(back <= ahead, p["v"]).otherwise(n["v"])
        else:
            value = p["v"] + (n["v"] - p["v"]) * back / (back + ahead)
        return F.when(F.col(c).isNotNull(), F.col(c)).when(p.isNotNull() & n.isNotNull(), value)

    return found.withColumns({c: filled(c) for c in columns}).drop(
        *[f"{c}_p" for c in columns], *[f"{c}_n" for c in columns]
    )


def path_loss(channels: DataFrame) -> DataFrame:
    return channels.withColumn("trsl", F.col("tsl") - F.col("rsl"))


def clean(channels: DataFrame, temperature: bool = True) -> DataFrame:
    """Validity, nearest fill of the levels, linear fill of the temperatures, path loss."""
    linear = ["temperature_rx", "temperature_tx"] if temperature else []
    return path_loss(fill_gaps(valid_signals(channels), CHANNEL, nearest=["tsl", "rsl"], linear=linear))
