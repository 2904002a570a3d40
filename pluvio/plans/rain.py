"""From telemetry to rain rates per channel."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.config import Settings, trailing_range
from pluvio.operators import baseline, quality, rain, temperature, wetdry
from pluvio.operators.channels import build_channels, link_ends
from pluvio.sources import metadata, telemetry


def load_channels(
    rows: DataFrame, links: DataFrame, cfg: Settings, scan: tuple[datetime | None, datetime | None] | None = None, every_link: bool = False
) -> DataFrame:
    """Channels of the links over the scan range (by default the configured one with its warm-up)."""
    start, end = scan if scan else cfg.scan_range()
    wanted = telemetry.scan(rows, start, end, cfg.fields, cfg.temperature.needed)
    hosts = metadata.hosts_of(links)
    if telemetry.few(hosts, telemetry.BROADCAST_HOSTS):
        wanted = telemetry.of_hosts(wanted, hosts)
    # Beyond that the raw rows are averaged first: the join with the links drops other hosts.
    wide = telemetry.step_means(wanted, cfg.time.step * 60, cfg.fields, cfg.temperature.needed)
    return build_channels(wide, links, every_link)


def trailing(cfg: Settings, now: datetime, window: str = "1d") -> Settings:
    """The settings with the trailing window as their range."""
    start, end = trailing_range(now, window, cfg.time.step)
    return replace(cfg, time=replace(cfg.time, start=start, end=end))


def load_trailing(rows: DataFrame, links: DataFrame, cfg: Settings, now: datetime, window: str = "1d") -> DataFrame:
    """Channels of the trailing window and of the warm-up before it."""
    return load_channels(rows, links, trailing(cfg, now, window))


def rain_rates(
    channels: DataFrame, cfg: Settings = Settings(), links: DataFrame | None = None, slim: bool = False
) -> DataFrame:
    """Add trsl, wet, baseline, a_rain, waa, a and r.

    Everything runs on the partitioning by cml_id that `build_channels` sets up. With method
    `given`, a `wet` column is expected. Leijnse's curves are derived from `links` if given.
    `slim` drops the signals and temperatures once they are used: columns cannot be pruned through
    the walk along the series. Rows marked in a column `given` (see `carry`) keep the path loss, wet flag, baseline and
    wet-antenna attenuation they bring.
    """
    wd, waa = cfg.wet_dry, cfg.waa
    given = "given" in channels.columns

    def keep(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.when(F.col("given"), F.col(f"given_{name}")).otherwise(F.col(name))) if given else df

    out = quality.clean(channels, cfg.temperature.needed)
    if cfg.temperature.filtered:
        out = temperature.drop_flagged(out, cfg.temperature.threshold)
    if cfg.temperature.compensated:
        out = temperature.compensate(out, cfg.temperature.threshold, cfg.temperature.reference)
    out = keep(out, "trsl")
    if wd.method == "rolling":
        out = keep(wetdry.rolling_wet(out, wd.rolling_values, wd.deviation, wd.centered), "wet")
    if slim:
        out = out.drop("tsl", "rsl", "temperature_rx", "temperature_tx", "polarization")
    if wd.baseline_samples == 1 and waa.method != "schleiss":
        out = baseline.last_dry_baseline(out)
    else:
        out = baseline.baseline_and_waa(
            out, wd.baseline_samples, waa.schleiss_max, waa.schleiss_tau, cfg.time.step, waa.schleiss_step_in_hours,
            wd.block_rows,
        )
        if waa.method != "schleiss":
            out = out.drop("waa")
    out = rain.rain_attenuation(out)
    curves = None
    if waa.method == "leijnse" and links is not None:
        curves = rain.leijnse_table(link_ends(links).select(F.explode(F.array("f_ab", "f_ba")).alias("frequency")))
    return rain.rates(rain.wet_antenna(out, waa, curves), wd.ignore_dry_links)
