"""Link series on the output step, on a common time axis, and rolling hour sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.functions.clock import unix_seconds


def channel_mean(rain: DataFrame, value: str = "r") -> DataFrame:
    return rain.groupBy("cml_id", "time").agg(F.avg(value).alias(value))


def output_steps(rain: DataFrame, step: int, output_step: int, keys: tuple[str, ...] = ("cml_id", "channel_id")) -> DataFrame:
    """Mean of r per output step (minutes), bins closed left and labelled by their right edge.

    Bins start at midnight of the first day. Equal steps pass the rows on; finer output is an error.
    """
    if output_step < step:
        raise ValueError("output_step must not be smaller than step")
    if output_step == step:
        return rain.select(*keys, "time", "r")
    offset = 0
    if 1440 % output_step:
        first = rain.agg(unix_seconds(F.date_trunc("day", F.min("time"))).alias("s")).first()
        offset = (first["s"] or 0) % (output_step * 60)
    bins = F.window("time", f"{output_step} minutes", startTime=f"{offset} seconds")
    return rain.groupBy(*keys, bins).agg(F.avg("r").alias("r")).select(
        *keys, F.col("window.end").alias("time"), "r"
    )


def time_axis(link_rain: DataFrame, regular_minutes: int | None = None) -> DataFrame:
    """The times any link has, numbered from 0: (time, pos, n_times).

    With `regular_minutes`, every step between the first and the last time. The axis has one row
    per step of the job.
    """
    if regular_minutes is None:
        times = link_rain.select("time").distinct()
    else:
        times = link_rain.agg(F.min("time").alias("a"), F.max("time").alias("b")).select(
            F.explode(F.sequence("a", "b", F.expr(f"INTERVAL {regular_minutes} MINUTES"))).alias("time")
        )
    order = Window.orderBy("time")
    return times.withColumns(
        {"pos": F.row_number().over(order) - 1, "n_times": F.count(F.lit(1)).over(Window.partitionBy())}
    )


def align(link_rain: DataFrame, axis: DataFrame) -> DataFrame:
    """One row per link and time of the axis; times a link lacks have a missing value.

    Each row fills the gap behind it up to the link's next row (the first one also the gap before
    it), so links and times are never multiplied with each other.
    """
    w = Window.partitionBy("cml_id").orderBy("pos")
    rows = link_rain.join(axis, "time").withColumns({"next_": F.lead("pos").over(w), "first_": F.row_number().over(w) == 1})
    start = F.when(F.col("first_"), F.lit(0)).otherwise(F.col("pos"))
    stop = F.coalesce(F.col("next_"), F.col("n_times")) - 1
    filled = rows.select(
        "cml_id", "r", F.col("pos").alias("own_"), F.explode(F.sequence(start.cast("int"), stop.cast("int"))).alias("pos")
    )
    return filled.select(
        "cml_id", "pos", F.when(F.col("pos") == F.col("own_"), F.col("r")).alias("r")
    ).join(axis.select("pos", "time"), "pos").select("cml_id", "time", "pos", "r")


def hour_sums(aligned: DataFrame, output_step: int, window_minutes: int = 60) -> DataFrame:
    """Add r_hour_sum, millimetres over the window; missing rates count as 0, short windows are missing."""
    n = max(1, round(window_minutes / output_step))
    w = Window.partitionBy("cml_id").orderBy("pos").rowsBetween(-(n - 1), 0)
    total = F.coalesce(F.sum(F.col("r") * (output_step / 60.0)).over(w), F.lit(0.0))
    return aligned.withColumn("r_hour_sum", F.when(F.col("pos") >= n - 1, total))


def audit_hour_sums(link_rain: DataFrame, output_step: int, window_minutes: int = 60) -> DataFrame:
    """Recompute every wet hour sum from the rates and report the largest difference.

    Each rate is sent to the windows it falls into and summed there, which shares nothing with
    the rolling frame under test.
    """
    n = max(1, round(window_minutes / output_step))
    sent = link_rain.where("r is not null").select(
        "cml_id",
        F.explode(F.sequence(F.col("pos"), F.col("pos") + (n - 1))).alias("pos"),
        (F.col("r") * (output_step / 60.0)).alias("mm"),
    )
    expected = sent.groupBy("cml_id", "pos").agg(F.sum("mm").alias("expected"))
    wet = link_rain.where(F.col("pos") >= n - 1).join(expected.where("expected > 0"), ["cml_id", "pos"])
    return wet.agg(
        F.count(F.lit(1)).alias("checked"),
        F.coalesce(F.max(F.abs(F.col("expected") - F.col("r_hour_sum"))), F.lit(0.0)).alias("max_abs_diff"),
    )
