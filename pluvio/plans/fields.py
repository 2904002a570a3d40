"""From rain rates to link series and gridded frames."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.config import Settings
from pluvio.operators import idw, mask, products, resample
from pluvio.operators.grid import Grid, make_grid
from pluvio.session import stage

#: Steps of a tile that one task interpolates.
PART_STEPS = 256


@dataclass(frozen=True)
class Products:
    grid: Grid
    links: DataFrame  # cml_id, time, pos, r, r_hour_sum
    frames: DataFrame | None  # time, row, col, v; none if the settings ask for neither frames nor flags
    frames_sum: DataFrame | None
    info: DataFrame | None
    info_sum: DataFrame | None


def link_series(rain: DataFrame, cfg: Settings) -> DataFrame:
    """Rates on the output step, averaged over channels, on the common time axis, with hour sums.

    The channel means are written once: the time axis and the rows are both read from them.
    """
    step, out = cfg.time.step, cfg.time.output_step
    steps = resample.output_steps(rain, step, out)
    series = stage(resample.channel_mean(steps), "link-rain")
    aligned = resample.align(series, resample.time_axis(series, out if out > step else None))
    if not cfg.hour_sum.enabled:
        return aligned.withColumn("r_hour_sum", F.lit(None).cast("double"))
    return resample.hour_sums(aligned, out, cfg.hour_sum.window_minutes)


def rain_fields(rain: DataFrame, links: DataFrame, cfg: Settings = Settings(), outline: DataFrame | None = None) -> Products:
    """Frames, their summaries and the link series. `outline` has polygon edges in degrees.

    The requested range starts after the warm-up; rows before it are dropped once the rolling sums
    are made.
    """
    series = link_series(rain, cfg)
    if cfg.time.start is not None:
        series = products.trim_warm_up(series, cfg.time.start)
    if cfg.time.end is not None and cfg.margin:
        series = series.where(F.col("time") <= F.lit(cfg.time.end))
    series = stage(series, "link-series")
    if not (cfg.output.frames or cfg.output.flags):
        return Products(make_grid(cfg.interp, cfg.limits), series, None, None, None, None)
    grid = make_grid(cfg.interp, cfg.limits)
    inside = None
    if outline is not None and cfg.output.crop:
        inside = mask.inside_cells(mask.to_mercator(outline) if cfg.interp.mercator else outline, grid)

    # Steps that follow each other, some 256 of a tile per task.
    span = series.agg(F.unix_seconds(F.min("time")).alias("a"), F.unix_seconds(F.max("time")).alias("b")).first()
    seconds = PART_STEPS * cfg.time.output_step * 60
    first, parts = (0, 1) if span["a"] is None else (span["a"], (span["b"] - span["a"]) // seconds + 1)
    part = F.floor((F.unix_seconds("time") - first) / seconds)

    minutes = cfg.hour_sum.window_minutes
    dry = cfg.interp.dry_as_missing
    kinds = {"r": (F.nullif(F.col("r"), F.lit(0.0)) if dry else F.col("r"), cfg.score.min_rain)}
    if cfg.hour_sum.enabled:
        kinds["r_hour_sum"] = (F.col("r_hour_sum"), cfg.score.min_rain * minutes / 60.0)
    made = idw.frames_by_kind(
        series, links, grid, kinds, near=cfg.interp.near, radius=cfg.interp.max_distance, power=cfg.interp.power,
        mercator=cfg.interp.mercator, tile=cfg.interp.tile, parts=parts, part=part, inside=inside,
    )
    return with_info(Products(grid, series, made["r"], made.get("r_hour_sum"), None, None), cfg)


def with_info(made: Products, cfg: Settings) -> Products:
    """Products with the summaries of their frames."""
    info = products.frame_info(made.frames, made.links, cfg.score)
    info_sum = None
    if made.frames_sum is not None:
        info_sum = products.frame_info(
            made.frames_sum, made.links, cfg.score, "r_hour_sum", cfg.hour_sum.window_minutes
        )
    return replace(made, info=info, info_sum=info_sum)
