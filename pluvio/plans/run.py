"""Batch jobs: a historic range, trailing windows, and a long history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from pluvio.config import Settings
from pluvio.plans import carry
from pluvio.plans.fields import Products, rain_fields
from pluvio.plans.publish import publish
from pluvio.plans.rain import load_channels, rain_rates, trailing
from pluvio.session import stage, staging


def run_historic(rows: DataFrame, links: DataFrame, cfg: Settings, outline: DataFrame | None = None) -> Products:
    """All products of [start, end), scanned with warm-up and trimmed to the range."""
    return rain_fields(rain_rates(load_channels(rows, links, cfg), cfg, links, slim=True), links, cfg, outline)


def run_trailing(
    rows: DataFrame, links: DataFrame, cfg: Settings, now: datetime, window: str = "1d", outline: DataFrame | None = None,
    state: str | None = None,
) -> Products:
    """All products of the trailing window, recomputed as a whole and trimmed to the window.

    `state` names a folder in which one run leaves for the next what it needs of the time before the window (see `carry`). Every
    value is then that of a run over the whole history up to now. The first run scans all telemetry, later ones what came since
    the window of the run before began. Without it the scan begins a warm-up before the window, and values that depend on
    what lies further back (a wet spell or a gap that began before) can differ.
    """
    cfg = trailing(cfg, now, window)
    if state is None:
        return run_historic(rows, links, cfg, outline)
    spark, start = rows.sparkSession, cfg.time.start
    found = carry.latest(spark, state, start)
    since, carried = found if found else (None, None)
    scanned = load_channels(rows, links, cfg, (since, cfg.time.end), every_link=True)
    rates = stage(rain_rates(carry.with_known(scanned, carried), cfg, links), "rates")
    if since != start:
        columns = [c for c in rates.columns if c not in {*carry.GIVEN, "held", "a_rain", "a", "r"}]
        carry.save(carry.state(rates, cfg, start).select(columns), state, start)
    return rain_fields(carry.recent(rates.where("has_a and has_b"), cfg), links, cfg, outline)


def run_history(rows: DataFrame, links: DataFrame, cfg: Settings, root: str, outline: DataFrame | None = None) -> None:
    """A long history as one job, written once.

    Nothing grows with the history but the number of tasks: telemetry is averaged where it is read, a link has one row a step,
    and its windows are sorted with spilling; tasks interpolate a tile for some hundred steps that follow each other. There are no borders
    at which values could differ, and a lost task repeats itself alone.
    """
    with staging(rows.sparkSession):
        publish(run_historic(rows, links, cfg, outline), root, cfg)
