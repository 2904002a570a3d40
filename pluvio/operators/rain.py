"""Rain attenuation, wet-antenna correction and rain rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.config import WetAntenna
from pluvio.functions.rainrate import RATE_GRID, leijnse_curve, pastorek_curve, rain_rate, waa_from_observed
from pluvio.session import ship


def at_least_zero(c: Column) -> Column:
    """Negative and missing values become 0."""
    return F.when(c >= 0, c).otherwise(0.0)


def rain_attenuation(channels: DataFrame) -> DataFrame:
    return channels.withColumn("a_rain", at_least_zero(F.col("trsl") - F.col("baseline")))


def leijnse_table(channels: DataFrame) -> DataFrame:
    """Curve per distinct frequency: (frequency, curve array<double>)."""

    def curves(batches):
        for pdf in batches:
            pdf["curve"] = [leijnse_curve(f) for f in pdf["frequency"]]
            yield pdf

    ship(channels.sparkSession)
    return channels.select("frequency").distinct().mapInPandas(
        curves, "frequency double, curve array<double>"
    )


def wet_antenna(channels: DataFrame, cfg: WetAntenna = WetAntenna(), curves: DataFrame | None = None) -> DataFrame:
    """Add `waa` by the configured method (the Schleiss walk has already added it).

    `curves` may name the Leijnse curves of the links' frequencies, to save deriving them from the
    samples.
    """
    kl = F.col("k") * F.col("length")
    if cfg.method == "schleiss":
        return channels
    if cfg.method == "pastorek":
        values = pastorek_curve(cfg.pastorek_max, cfg.pastorek_zeta, cfg.pastorek_d)
        curve = F.array(*[F.lit(v) for v in values])
        return channels.withColumn("waa", waa_from_observed(F.col("a_rain"), kl, F.col("alpha"), curve))
    if cfg.method == "leijnse":
        table = curves if curves is not None else leijnse_table(channels)
        return (
            channels.join(table, "frequency")
            .withColumn("waa", waa_from_observed(F.col("a_rain"), kl, F.col("alpha"), F.col("curve")))
            .drop("curve")
        )
    return channels.withColumn("waa", F.lit(0.0))


def rates(channels: DataFrame, ignore_dry: bool = False) -> DataFrame:
    """Add `a` and `r`; with `ignore_dry` dry rows have no rate."""
    out = channels.withColumn("a", at_least_zero(F.col("a_rain") - F.col("waa"))).withColumn(
        "r", rain_rate(F.col("a"), F.col("k"), F.col("alpha"), F.col("length"))
    )
    if ignore_dry:
        out = out.withColumn("r", F.when(F.col("wet"), F.col("r")))
    return out


__all__ = ["RATE_GRID", "at_least_zero", "rain_attenuation", "wet_antenna", "rates", "leijnse_table"]
