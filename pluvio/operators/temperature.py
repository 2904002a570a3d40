"""Correlation of path loss with temperature: links to drop, or series to correct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _pearson(x: Column, t: Column, over: WindowSpec | None = None) -> Column:
    """Pearson correlation over the rows where both are known; NULL where either does not vary.

    `F.corr` divides by zero there, and an aggregate is worked out before any condition around it.
    """
    known = x.isNotNull() & t.isNotNull()
    parts = F.covar_pop(x, t), F.stddev_pop(F.when(known, x)), F.stddev_pop(F.when(known, t))
    both, of_x, of_t = parts if over is None else [p.over(over) for p in parts]
    return both / F.nullif(of_x * of_t, F.lit(0.0))


def correlations(channels: DataFrame) -> DataFrame:
    """Pearson correlation and slope per channel over the rows where both values are known."""
    t, x = F.col("temperature_tx"), F.col("trsl")
    both = F.when(t.isNotNull() & x.isNotNull(), 1)
    varies = (F.min(F.when(both == 1, t)) < F.max(F.when(both == 1, t))) & (
        F.min(F.when(both == 1, x)) < F.max(F.when(both == 1, x))
    )
    return channels.groupBy("cml_id", "channel_id").agg(
        F.when(varies, _pearson(x, t)).alias("correlation"),
        F.when(varies, F.regr_slope(x, t)).alias("slope"),
    )


def flagged_links(channels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Links with both correlations defined and at least one of them strong."""
    r = F.col("correlation")
    return (
        correlations(channels)
        .groupBy("cml_id")
        .agg(F.count(r).alias("n"), F.max(F.abs(r)).alias("strongest"))
        .where((F.col("n") == 2) & (F.col("strongest") >= threshold))
        .select("cml_id", "strongest")
    )


def mark_flagged(channels: DataFrame, threshold: float) -> DataFrame:
    """Add flagged_ (the link passes the test of `flagged_links`) and slope_ of the channel.

    The statistics are window aggregates over the channel and the link, so the partitioning by
    cml_id that the channels come with is enough and the channels are worked out once.
    """
    t, x = F.col("temperature_tx"), F.col("trsl")
    channel, link = Window.partitionBy("cml_id", "channel_id"), Window.partitionBy("cml_id")
    known = t.isNotNull() & x.isNotNull()
    varies = (F.min(F.when(known, t)).over(channel) < F.max(F.when(known, t)).over(channel)) & (
        F.min(F.when(known, x)).over(channel) < F.max(F.when(known, x)).over(channel)
    )
    stats = channels.withColumns(
        {
            "r_": F.when(varies, _pearson(x, t, channel)),
            "slope_": F.when(varies, F.regr_slope(x, t).over(channel)),
        }
    )
    # Two channels per link: both are defined if the smallest and the largest channel name are.
    defined = F.when(F.col("r_").isNotNull(), F.col("channel_id"))
    both = F.min(defined).over(link) < F.max(defined).over(link)
    flagged = F.coalesce(both & (F.max(F.abs("r_")).over(link) >= threshold), F.lit(False))
    return stats.withColumn("flagged_", flagged).drop("r_")


def drop_flagged(channels: DataFrame, threshold: float = 0.7) -> DataFrame:
    return mark_flagged(channels, threshold).where(~F.col("flagged_")).drop("flagged_", "slope_")


def compensate(channels: DataFrame, threshold: float = 0.7, reference: float = 21.0) -> DataFrame:
    """Take the linear temperature effect above the reference out of flagged links."""
    t, x = F.col("temperature_tx"), F.col("trsl")
    corrected = x - F.col("slope_") * (t - reference)
    return (
        mark_flagged(channels, threshold)
        .withColumn("trsl", F.when(F.col("flagged_") & (t >= reference), corrected).otherwise(x))
        .drop("flagged_", "slope_")
    )
