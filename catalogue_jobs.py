"""Registered queries that run whole jobs of `pluvio.plans`: rates, fields, history, publishing."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import catalogue as c
from oracle_views import ROLL, THRESHOLD, VIEWS, r, ts
from pluvio.config import HourSum, Output, Settings, TimeAxis, WetAntenna, WetDry
from pluvio.plans import fields, publish, rain, run
from pluvio.session import shared_folder, stage, staging
from pluvio.sources import demo
from pluvio.sources import frames as frame_store

#: Jobs that need no temperature do not scan it, so steps with nothing else have no row.
SCANNED = {"telemetry": f"SELECT * FROM ({VIEWS['telemetry']}) WHERE field <> 'temperature'"}
LEAST_SUM = c.LEAST * c.HOUR_SUM_MINUTES / 60


def settings(spark, sf) -> Settings:
    """The daily job over the whole range of the events."""
    span = demo.telemetry(spark, sf).agg(F.min("time").alias("a"), F.max("time").alias("b")).first()  # two times
    first = span["a"].replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=timezone.utc)
    last = span["b"].replace(hour=0, minute=0, second=0, microsecond=0, tzinfo=timezone.utc) + timedelta(days=1)
    return Settings(
        time=TimeAxis(demo.STEP_MINUTES, demo.STEP_MINUTES, first, last), fields=demo.NAMES,
        wet_dry=WetDry(rolling_values=ROLL, deviation=THRESHOLD, baseline_samples=1), waa=WetAntenna(method="none"),
        interp=c.INTERP, limits=c.LIMITS, hour_sum=HourSum(True, c.HOUR_SUM_MINUTES, write_series=True), output=Output(intensities=True),
    )


def telemetry(spark, sf) -> DataFrame:
    return demo.telemetry(spark, sf).select("time", "agent_host", "field", "value")


def historic(spark, sf, outline=None) -> fields.Products:
    return run.run_historic(telemetry(spark, sf), stage(c.links(spark, sf), "links"), settings(spark, sf), outline)


@c.query("job_rain_rates", f"""SELECT cml_id, channel_id, {ts()} AS time, wet, {r('r', 3)} AS r FROM rain""", SCANNED)
def _(spark, sf):
    cfg, links = settings(spark, sf), c.links(spark, sf)
    out = rain.rain_rates(rain.load_channels(telemetry(spark, sf), links, cfg), cfg, links, slim=True)
    return out.select("cml_id", "channel_id", c.stamp(), "wet", c.rr("r", 3).alias("r"))


@c.query("job_link_series", f"SELECT cml_id, {ts()} AS time, {r('r', 3)} AS r, {r('r_hour_sum', 2)} AS r_hour_sum FROM hour_sum", SCANNED)
def _(spark, sf):
    return historic(spark, sf).links.select("cml_id", c.stamp(), c.rr("r", 3).alias("r"), c.rr("r_hour_sum", 2).alias("r_hour_sum"))


@c.query("job_frames", c.FRAME_SQL, {**c._field_sql("r"), **SCANNED})
def _(spark, sf):
    return c._frame_out(historic(spark, sf).frames)


@c.query("job_frames_hour_sum", c.FRAME_SQL, {**c._field_sql("r_hour_sum", least=LEAST_SUM), **SCANNED})
def _(spark, sf):
    return c._frame_out(historic(spark, sf).frames_sum)


SERIES_SQL = f"""SELECT cml_id, CAST(epoch(time) AS BIGINT) AS time, 'rain_intensity' AS field, {r('r', 3)} AS value FROM hour_sum
    UNION ALL SELECT cml_id, CAST(epoch(time) AS BIGINT), 'rain_hour_sum', {r('r_hour_sum', 2)} FROM hour_sum
    WHERE r_hour_sum IS NOT NULL"""


def _points(spark, root) -> DataFrame:
    rows = spark.read.parquet(f"{root}/series")
    value = F.when(F.col("field") == "rain_intensity", c.rr("value", 3)).otherwise(c.rr("value", 2))
    return rows.select("cml_id", "time", "field", value.alias("value"))


def _root(spark) -> str:
    return f"{shared_folder(spark)}/published/{uuid.uuid4().hex}"


@c.query("published_twice_series", SERIES_SQL, SCANNED)
def _(spark, sf):
    """The whole range published, and the part after a time published again as a cycle would."""
    root, cfg = _root(spark), settings(spark, sf)
    with staging(spark):
        made = historic(spark, sf)
        cfg = replace(cfg, output=Output(frames=False, flags=False, intensities=True))
        publish.publish(made, root, cfg)
        publish.publish(made, root, cfg, since=cfg.time.end - timedelta(days=9))
    return _points(spark, root)


@c.query("history_slices_equal_whole", SERIES_SQL, SCANNED)
def _(spark, sf):
    """The history up to a time, and then as a whole, each as one job that writes once into the same series."""
    root, links = _root(spark), stage(c.links(spark, sf), "links")
    cfg = replace(settings(spark, sf), output=Output(frames=False, flags=False, intensities=True))
    for end in (cfg.time.end - timedelta(days=10), cfg.time.end):
        run.run_history(telemetry(spark, sf), links, replace(cfg, time=replace(cfg.time, end=end)), root)
    return _points(spark, root)


SPAN_SQL = "(SELECT date_trunc('day', max(ts)) - INTERVAL {} DAY FROM events)"


@c.query("trailing_equals_whole", f"""SELECT cml_id, {ts()} AS time, {r('r', 3)} AS r, {r('r_hour_sum', 2)} AS r_hour_sum FROM hour_sum
    WHERE time >= {SPAN_SQL.format(13)}""", SCANNED)
def _(spark, sf):
    """The link series of the last of three cycles over trailing windows, each with the state that the one before left."""
    cfg = replace(settings(spark, sf), output=Output(frames=False, flags=False, intensities=True))
    root, links = _root(spark), stage(c.links(spark, sf), "links")
    for back in (9, 5, 0):
        made = run.run_trailing(telemetry(spark, sf), links, cfg, cfg.time.end - timedelta(days=back), "14d", state=f"{root}/state")
    return made.links.select("cml_id", c.stamp(), c.rr("r", 3).alias("r"), c.rr("r_hour_sum", 2).alias("r_hour_sum"))


@c.query("published_trailing_cycles", f"""SELECT strftime(time, '%Y-%m-%d_%H%M') AS utc, "row", col, round_even({r("v", 3)}, 3) AS v FROM frames
    WHERE time >= {SPAN_SQL.format(17)}""", {**c._field_sql("r"), **SCANNED})
def _(spark, sf):
    """Two overlapping cycles over trailing windows of 14 days; the second leaves the frames before its window."""
    root, state, cfg = _root(spark), _root(spark), settings(spark, sf)
    links = stage(c.links(spark, sf), "links")
    for back in (4, 0):
        with staging(spark):
            made = run.run_trailing(telemetry(spark, sf), links, cfg, cfg.time.end - timedelta(days=back), "14d", state=state)
            publish.write_frames(made.frames.withColumn("v", c.rr("v", 3)), root, made.links.select("time").distinct())
    return frame_store.read_frames(spark, root).select("utc", "row", "col", "v")

