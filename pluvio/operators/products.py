"""Frame scores, per-frame link flags, frame catalogues and series for output."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.config import Score
from pluvio.functions.clock import frame_name, frame_time


def _unit(c: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))


def _strength(stat: Column, reference: float) -> Column:
    return F.when(stat > 0, _unit(F.log1p(stat) / F.log1p(F.lit(max(reference, 1e-6))))).otherwise(0.0)


def score_of(v: Column, cfg: Score = Score()) -> Column:
    """Aggregate: one number 0..1 for the known values of a frame in mm/h."""
    if cfg.method in ("coverage", "coverage_strength"):
        wet = v > cfg.threshold
        coverage = F.when(F.count(v) > 0, F.count_if(wet) / F.count(v)).otherwise(0.0)
        if cfg.method == "coverage":
            return _unit(coverage)
        strength = _strength(F.avg(F.when(wet, v)), cfg.reference)
        return F.when(
            strength > 0,
            _unit(
                F.pow(coverage, F.lit(max(cfg.coverage_gamma, 1e-6)))
                * F.pow(strength, F.lit(max(cfg.strength_gamma, 1e-6)))
            ),
        ).otherwise(0.0)
    if cfg.method in ("p90", "p95"):
        stat = F.percentile(v, 0.9 if cfg.method == "p90" else 0.95)
    else:
        stat = F.avg(v)
    return _strength(stat, cfg.reference)


def frame_scores(frames: DataFrame, cfg: Score = Score(), window_minutes: float | None = None) -> DataFrame:
    """(time, overall). Sums over `window_minutes` are turned into mm/h first."""
    v = F.col("v")
    if window_minutes is not None:
        hours = window_minutes / 60.0
        v = v / (hours if hours > 0 else 1.0)
    return frames.groupBy("time").agg(score_of(v, cfg).alias("overall"))


def link_flags(link_rain: DataFrame, value: str = "r") -> DataFrame:
    """Per time: the links with rain in id order, their number and the number of links."""
    rainy = F.col(value) > 0
    return link_rain.groupBy("time").agg(
        F.sort_array(F.collect_list(F.when(rainy, F.col("cml_id")))).alias("cml_rain_true"),
        F.count_if(rainy).alias("count_true"),
        F.count(F.lit(1)).alias("count_total"),
        F.coalesce(F.max(F.col("r") > 0), F.lit(False)).alias("any_wet"),
    )


def frame_info(
    frames: DataFrame,
    link_rain: DataFrame,
    cfg: Score = Score(),
    value: str = "r",
    window_minutes: float | None = None,
) -> DataFrame:
    """One summary per time of the link series, whether or not its frame has a value.

    A frame in which any link is wet scores at least `min_if_any`.
    """
    flags = link_flags(link_rain, value)
    scored = flags.join(frame_scores(frames, cfg, window_minutes), "time", "left")
    overall = F.coalesce(F.col("overall"), F.lit(0.0))
    overall = F.when(F.col("any_wet"), F.greatest(overall, F.lit(cfg.min_if_any))).otherwise(overall)
    return scored.select(
        "time", frame_name(F.col("time")).alias("utc"), F.bround(overall, 4).alias("overall"),
        "cml_rain_true", "count_true", "count_total",
    )


def stored_name(info: DataFrame) -> DataFrame:
    """Frame names carrying the score."""
    return info.withColumn(
        "name", F.concat(F.col("utc"), F.lit("_"), F.format_number("overall", "0.000"), F.lit(".png"))
    )


def not_yet_written(frames: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Frames (with a `time`) whose name is not in the catalogue (name); score suffixes do not matter."""
    written = catalogue.select(frame_time(F.col("name")).alias("time")).where("time is not null").distinct()
    return frames.join(written, "time", "left_anti")


def retention(catalogue: DataFrame, now: Column | datetime, keep: str) -> DataFrame:
    """Add `expired` to stored names: older than the kept interval; other names are kept."""
    limit = (F.lit(now) if isinstance(now, datetime) else now) - F.expr(f"INTERVAL {keep}")
    return catalogue.withColumn("expired", F.coalesce(frame_time(F.col("name")) < limit, F.lit(False)))


def retention_counts(catalogue: DataFrame, now: Column | datetime, keep: str) -> DataFrame:
    return retention(catalogue, now, keep).agg(
        F.count_if("expired").alias("deleted"), F.count_if(~F.col("expired")).alias("kept")
    )


def intensity_points(link_rain: DataFrame, since: Column | None = None) -> DataFrame:
    """Output rows of the rain rate. With `since`, newer times only and no all-missing time."""
    rows = link_rain
    if since is not None:
        known = link_rain.groupBy("time").agg(F.count("r").alias("n")).where("n > 0").select("time")
        rows = rows.where(F.col("time") > since).join(known, "time", "left_semi")
    return rows.select(
        "cml_id", F.unix_timestamp("time").alias("time"), F.lit("rain_intensity").alias("field"), F.col("r").alias("value")
    )


def hour_sum_points(link_rain: DataFrame, since: Column | None = None) -> DataFrame:
    """Output rows of the hour sum, known values only."""
    rows = link_rain.where("r_hour_sum is not null")
    if since is not None:
        rows = rows.where(F.col("time") > since)
    return rows.select(
        "cml_id", F.unix_timestamp("time").alias("time"), F.lit("rain_hour_sum").alias("field"), F.col("r_hour_sum").alias("value")
    )


def newest(frames: DataFrame, axis: DataFrame, n: int) -> DataFrame:
    """Frames of the last n times of the axis (time, pos, n_times)."""
    kept = axis.where(F.col("pos") >= F.col("n_times") - n).select("time")
    return frames.join(kept, "time", "left_semi")


def trim_warm_up(rows: DataFrame, start: datetime) -> DataFrame:
    return rows.where(F.col("time") >= F.lit(start))
