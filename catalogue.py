"""Registered queries with their oracle SQL."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle_views import ROLL, THRESHOLD, r, ts, with_views
from pluvio.config import Interp, Limits, Score, WetAntenna
from pluvio.functions import clock
from pluvio.functions import colours as co
from pluvio.functions.geo import lat_of, lon_of, mercator_x, mercator_y
from pluvio.functions.missing import without_nan
from pluvio.operators import baseline as bl
from pluvio.operators import channels as ch
from pluvio.operators import grid as gr
from pluvio.operators import idw, mask
from pluvio.operators import nearby as nb
from pluvio.operators import preprocess as pp
from pluvio.operators import products as pr
from pluvio.operators import quality as q
from pluvio.operators import rain as rn
from pluvio.operators import resample as rs
from pluvio.operators import spectral as sp
from pluvio.operators import temperature as tc
from pluvio.operators import training as tr
from pluvio.operators import wetdry as wd
from pluvio.plans import classify, publish
from pluvio.session import shared_folder, ship, stage
from pluvio.sources import demo, metadata, polygons, telemetry
from pluvio.sources import frames as frame_store
from pluvio.streaming import live, ordered

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: dict[str, str] | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return fn

    return register


def rr(c: str | Column, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    scale = F.lit(float(f"1e{digits}"))
    return F.floor(c * scale + 0.4997).cast("double") / scale


def stamp(c: str = "time") -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


# --- shared stages ---------------------------------------------------------------------------


def wide(spark, sf):
    rows = telemetry.scan(demo.telemetry(spark, sf), names=demo.NAMES)
    return telemetry.step_means(rows, demo.STEP_SECONDS, demo.NAMES)


def links(spark, sf, **kw):
    kw = {"min_length": 0.5, "max_length": 100.0, "excluded": demo.excluded(spark, sf), **kw}
    return metadata.load_links(
        demo.raw_links(spark, sf), demo.sites(spark, sf), demo.technologies(spark, sf), demo.mapping(spark, sf), **kw
    )


def channels(spark, sf):
    return ch.build_channels(wide(spark, sf), links(spark, sf))


def clean(spark, sf):
    return q.clean(channels(spark, sf))


def wet(spark, sf, centered=False):
    return wd.rolling_wet(clean(spark, sf), ROLL, THRESHOLD, centered)


def rain(spark, sf):
    held = rn.rain_attenuation(bl.last_dry_baseline(wet(spark, sf)))
    return rn.rates(rn.wet_antenna(held, WetAntenna(method="none")))


def link_rain(spark, sf):
    return rs.channel_mean(rain(spark, sf))


def aligned(spark, sf):
    lr = stage(link_rain(spark, sf), "link_rain")  # read for the time axis and for the rows
    return rs.align(lr, rs.time_axis(lr))


HOUR_SUM_MINUTES = 3 * demo.STEP_MINUTES


def hour_sum(spark, sf):
    return rs.hour_sums(aligned(spark, sf), demo.STEP_MINUTES, HOUR_SUM_MINUTES)


# --- sources ---------------------------------------------------------------------------------

WIDE_SQL = f"""SELECT agent_host, {ts()} AS time, {r('rx_power')} AS rx_power, {r('tx_power')} AS tx_power,
    {r('temperature')} AS temperature FROM wide"""


def _wide_out(df):
    return df.select("agent_host", stamp(), rr("rx_power").alias("rx_power"), rr("tx_power").alias("tx_power"),
                     rr("temperature").alias("temperature"))


@query("telemetry_wide", WIDE_SQL)
def _(spark, sf):
    return _wide_out(wide(spark, sf))


@query("telemetry_range", f"""SELECT agent_host, field, count(*) AS n, {r('avg(value)')} AS mean FROM telemetry
    WHERE time >= TIMESTAMP '2024-01-08 00:00:00' AND time < TIMESTAMP '2024-01-22 00:00:00' AND field <> 'temperature'
    GROUP BY 1, 2""")
def _(spark, sf):
    from datetime import datetime, timezone

    rows = telemetry.scan(
        demo.telemetry(spark, sf), datetime(2024, 1, 8, tzinfo=timezone.utc),
        datetime(2024, 1, 22, tzinfo=timezone.utc), demo.NAMES, temperature=False,
    )
    return rows.groupBy("agent_host", "field").agg(F.count(F.lit(1)).alias("n"), rr(F.avg("value")).alias("mean"))


@query("telemetry_of_links", f"""SELECT agent_host, count(*) AS n, {r('sum(value)', 4)} AS total FROM telemetry
    WHERE agent_host IN (SELECT ip_a FROM links UNION SELECT ip_b FROM links) GROUP BY 1""")
def _(spark, sf):
    rows = telemetry.of_hosts(demo.telemetry(spark, sf), metadata.hosts_of(links(spark, sf)))
    return rows.groupBy("agent_host").agg(F.count(F.lit(1)).alias("n"), rr(F.sum("value"), 4).alias("total"))


@query("telemetry_union_dedup", f"""
    SELECT agent_host, {ts()} AS time, event_id, field, {r('value')} AS value FROM (
      SELECT *, row_number() OVER (PARTITION BY agent_host, time ORDER BY event_id DESC) AS rn FROM (
        SELECT agent_host, date_trunc('day', time) AS time, event_id, field, value FROM telemetry)) WHERE rn = 1""")
def _(spark, sf):
    rows = demo.telemetry(spark, sf).withColumn("time", F.date_trunc("day", "time"))
    levels, temperatures = rows.where("field <> 'temperature'"), rows.where("field = 'temperature'")
    both = telemetry.union_parts(levels, temperatures, temperatures)
    last = telemetry.keep_last(both, "event_id")
    return last.select("agent_host", stamp(), "event_id", "field", rr("value").alias("value"))


@query("telemetry_bounds", f"""SELECT {ts('min(time)')} AS first_time, {ts('max(time)')} AS last_time,
    count(DISTINCT agent_host) AS n_hosts FROM wide""")
def _(spark, sf):
    w = wide(spark, sf)
    return w.agg(
        F.date_format(F.min("time"), "yyyy-MM-dd HH:mm:ss").alias("first_time"),
        F.date_format(F.max("time"), "yyyy-MM-dd HH:mm:ss").alias("last_time"),
        F.count_distinct("agent_host").alias("n_hosts"),
    )


@query("telemetry_sorted", f"""SELECT agent_host, {ts()} AS time,
    row_number() OVER (PARTITION BY agent_host ORDER BY time) AS row_no FROM wide""")
def _(spark, sf):
    return telemetry.per_host_rank(wide(spark, sf)).select("agent_host", stamp(), F.col("row_no").cast("bigint"))


LINK_COLUMNS = ["lat_a", "lon_a", "lat_b", "lon_b", "length"]


@query("link_metadata", f"""SELECT cml_id, name, tech, freq_a, freq_b, polarization, ip_a, ip_b,
    {", ".join(f"{r(c)} AS {c}" for c in LINK_COLUMNS)} FROM links""")
def _(spark, sf):
    return links(spark, sf).select(
        "cml_id", "name", "tech", F.col("freq_a").cast("bigint"), F.col("freq_b").cast("bigint"), "polarization",
        "ip_a", "ip_b", *[rr(c).alias(c) for c in LINK_COLUMNS],
    )


@query("links_by_id", """SELECT cml_id, name, tech FROM links WHERE cml_id < 400 AND cml_id % 3 = 1 AND cml_id % 7 <> 0""")
def _(spark, sf):
    """Links of a list of ids, without those named in a file of one id a line."""
    path = f"{shared_folder(spark)}/excluded/{uuid.uuid4().hex}"
    ids = demo.sites(spark, sf).where("ID % 13 = 0 OR ID % 7 = 0").select(F.col("ID").cast("string"))
    ids.unionByName(ids.limit(1).select(F.lit("").alias("ID"))).write.text(path)  # blank lines are skipped
    some = links(spark, sf, ids=list(range(1, 400, 3)), excluded=metadata.read_excluded(spark, path))
    return some.select("cml_id", "name", "tech")


@query("link_selection", """SELECT polarization, tech, count(*) AS n FROM links WHERE cml_id % 2 = 0 GROUP BY 1, 2""")
def _(spark, sf):
    choice = demo.sites(spark, sf).select(F.col("ID").alias("cml_id"), (F.col("ID") % 2 == 0).alias("enabled"))
    return metadata.selected(links(spark, sf), choice).groupBy("polarization", "tech").agg(F.count(F.lit(1)).alias("n"))


@query("missing_hosts", """SELECT host AS agent_host FROM (SELECT ip_a AS host FROM links UNION SELECT ip_b FROM links)
    WHERE host NOT IN (SELECT agent_host FROM wide)""")
def _(spark, sf):
    return metadata.missing_hosts(links(spark, sf), wide(spark, sf))


@query("missing_links", """SELECT cml_id, count(*) AS n_missing FROM (
      SELECT cml_id, ip_a AS host FROM links UNION ALL SELECT cml_id, ip_b FROM links)
    WHERE host NOT IN (SELECT agent_host FROM wide) GROUP BY 1""")
def _(spark, sf):
    return metadata.missing_links(links(spark, sf), wide(spark, sf))


# --- link series -----------------------------------------------------------------------------

CHANNEL_VALUES = ["tsl", "rsl", "temperature_rx", "temperature_tx", "frequency"]


@query("link_channels", f"""SELECT cml_id, channel_id, {ts()} AS time, polarization,
    {", ".join(f"{r(c)} AS {c}" for c in CHANNEL_VALUES)} FROM channels""")
def _(spark, sf):
    return channels(spark, sf).select(
        "cml_id", "channel_id", stamp(), "polarization", *[rr(c).alias(c) for c in CHANNEL_VALUES]
    )


CLEAN_VALUES = ["tsl", "rsl", "trsl", "temperature_rx", "temperature_tx"]


@query("signal_clean_fill", f"""SELECT cml_id, channel_id, {ts()} AS time,
    {", ".join(f"{r(c)} AS {c}" for c in CLEAN_VALUES)} FROM clean""")
def _(spark, sf):
    return clean(spark, sf).select("cml_id", "channel_id", stamp(), *[rr(c).alias(c) for c in CLEAN_VALUES])


CORRELATED = {
    "known_t": """SELECT cml_id, channel_id, trsl, temperature_tx FROM clean
        WHERE trsl IS NOT NULL AND temperature_tx IS NOT NULL""",
    "stats": """SELECT cml_id, channel_id,
          CASE WHEN min(trsl) < max(trsl) AND min(temperature_tx) < max(temperature_tx) THEN corr(trsl, temperature_tx) END AS correlation,
          CASE WHEN min(trsl) < max(trsl) AND min(temperature_tx) < max(temperature_tx) THEN regr_slope(trsl, temperature_tx) END AS slope
        FROM known_t GROUP BY 1, 2""",
    "flagged": """SELECT cml_id, max(abs(correlation)) AS strongest FROM stats GROUP BY 1
        HAVING count(correlation) = 2 AND max(abs(correlation)) >= 0.3""",
}
TEMP_THRESHOLD = 0.3


@query("temp_correlation", f"""SELECT cml_id, channel_id, {r('correlation')} AS correlation, {r('slope')} AS slope
    FROM stats""", CORRELATED)
def _(spark, sf):
    both = tc.correlations(clean(spark, sf))
    known = clean(spark, sf).where("trsl is not null and temperature_tx is not null").select("cml_id", "channel_id")
    return both.join(known, ["cml_id", "channel_id"], "left_semi").select(
        "cml_id", "channel_id", rr("correlation").alias("correlation"), rr("slope").alias("slope")
    )


@query("temp_flagged", f"SELECT cml_id, {r('strongest')} AS strongest FROM flagged", CORRELATED)
def _(spark, sf):
    return tc.flagged_links(clean(spark, sf), TEMP_THRESHOLD).select("cml_id", rr("strongest").alias("strongest"))


@query("temp_filtered", f"""SELECT cml_id, channel_id, count(*) AS n, {r('avg(trsl)')} AS mean_trsl FROM clean
    WHERE cml_id NOT IN (SELECT cml_id FROM flagged) GROUP BY 1, 2""", CORRELATED)
def _(spark, sf):
    kept = tc.drop_flagged(clean(spark, sf), TEMP_THRESHOLD)
    return kept.groupBy("cml_id", "channel_id").agg(F.count(F.lit(1)).alias("n"), rr(F.avg("trsl")).alias("mean_trsl"))


@query("temp_compensated", f"""SELECT c.cml_id, c.channel_id, {ts()} AS time,
    {r('CASE WHEN f.cml_id IS NOT NULL AND temperature_tx >= 21 THEN trsl - slope*(temperature_tx - 21) ELSE trsl END')} AS trsl
    FROM clean c LEFT JOIN flagged f ON f.cml_id = c.cml_id
    LEFT JOIN stats s ON s.cml_id = c.cml_id AND s.channel_id = c.channel_id""", CORRELATED)
def _(spark, sf):
    return tc.compensate(clean(spark, sf), TEMP_THRESHOLD).select(
        "cml_id", "channel_id", stamp(), rr("trsl").alias("trsl")
    )


WET_SQL = f"SELECT cml_id, channel_id, {ts()} AS time, wet FROM "


@query("wet_rolling", WET_SQL + "wet")
def _(spark, sf):
    return wet(spark, sf).select("cml_id", "channel_id", stamp(), "wet")


@query("wet_rolling_centered", WET_SQL + "wet_centered")
def _(spark, sf):
    return wet(spark, sf, centered=True).select("cml_id", "channel_id", stamp(), "wet")


@query("wet_fraction", f"""SELECT cml_id, channel_id, {r('avg(CASE WHEN wet THEN 1.0 ELSE 0.0 END)')} AS wet_fraction,
    count(*) AS n_rows FROM wet GROUP BY 1, 2""")
def _(spark, sf):
    return wd.wet_fraction(wet(spark, sf)).select("cml_id", "channel_id", rr("wet_fraction").alias("wet_fraction"), "n_rows")


@query("baseline_last_dry", f"SELECT cml_id, channel_id, {ts()} AS time, {r('baseline')} AS baseline FROM based")
def _(spark, sf):
    return bl.last_dry_baseline(wet(spark, sf)).select("cml_id", "channel_id", stamp(), rr("baseline").alias("baseline"))


@query("rain_rate", f"""SELECT cml_id, channel_id, {ts()} AS time, {r('a_rain')} AS a_rain, {r('k')} AS k, {r('alpha')} AS alpha,
    {r('r', 3)} AS r FROM rain""")
def _(spark, sf):
    return rain(spark, sf).select(
        "cml_id", "channel_id", stamp(), rr("a_rain").alias("a_rain"), rr("k").alias("k"), rr("alpha").alias("alpha"),
        rr("r", 3).alias("r"),
    )


@query("rain_ignore_dry", f"""SELECT cml_id, {ts()} AS time, count(*) AS n, {r('avg(CASE WHEN wet THEN r END)', 3)} AS r
    FROM rain GROUP BY 1, 2""")
def _(spark, sf):
    held = rn.wet_antenna(rn.rain_attenuation(bl.last_dry_baseline(wet(spark, sf))), WetAntenna(method="none"))
    return rn.rates(held, ignore_dry=True).groupBy("cml_id", "time").agg(
        F.count(F.lit(1)).alias("n"), F.avg("r").alias("r")
    ).select("cml_id", stamp(), "n", rr("r", 3).alias("r"))


CURVE = {
    # The tabulated rates of the wet-antenna curve and the curve at them.
    "grid": """SELECT i, CASE WHEN i = 0 THEN 0.0 ELSE pow(10, -10 + 13*(i-1)/510.0) END AS rate FROM range(512) t(i)""",
    "curve": "SELECT i, rate, 2.2*(1 - exp(-0.55*pow(rate, 0.1))) AS waa FROM grid",
    "lut": """SELECT d.cml_id, d.channel_id, c.i, d.kl*pow(c.rate, d.alpha) + c.waa AS a_obs, c.waa FROM
        (SELECT DISTINCT cml_id, channel_id, k*length AS kl, alpha FROM attenuated) d CROSS JOIN curve c""",
    "spans": """SELECT cml_id, channel_id, a_obs AS a0, waa AS w0, lead(a_obs) OVER w AS a1, lead(waa) OVER w AS w1
        FROM lut WINDOW w AS (PARTITION BY cml_id, channel_id ORDER BY i)""",
    "wetted": """SELECT t.*, CASE WHEN t.a_rain <= 0 THEN 0.0
          WHEN s.a0 IS NULL THEN (SELECT max(waa) FROM curve)
          ELSE s.w0 + (s.w1 - s.w0)*(t.a_rain - s.a0)/(s.a1 - s.a0) END AS waa
        FROM attenuated t LEFT JOIN spans s ON s.cml_id = t.cml_id AND s.channel_id = t.channel_id
          AND t.a_rain >= s.a0 AND t.a_rain < s.a1""",
}


@query("waa_pastorek", f"""SELECT cml_id, channel_id, {ts()} AS time, {r('waa')} AS waa,
    {r('CASE WHEN a_rain - waa >= 0 THEN a_rain - waa ELSE 0.0 END')} AS a FROM wetted""", CURVE)
def _(spark, sf):
    held = rn.rain_attenuation(bl.last_dry_baseline(wet(spark, sf)))
    return rn.rates(rn.wet_antenna(held)).select(
        "cml_id", "channel_id", stamp(), rr("waa").alias("waa"), rr("a").alias("a")
    )


def _walked(spark, sf, n=3):
    return bl.baseline_and_waa(wet(spark, sf), n=n, tau=6.0 * demo.STEP_MINUTES, step_minutes=demo.STEP_MINUTES)


@query("baseline_constant", f"SELECT cml_id, channel_id, {ts()} AS time, {r('baseline')} AS baseline FROM walked")
def _(spark, sf):
    return _walked(spark, sf).select("cml_id", "channel_id", stamp(), rr("baseline").alias("baseline"))


@query("waa_schleiss", f"SELECT cml_id, channel_id, {ts()} AS time, {r('waa')} AS waa, {r('r', 3)} AS r FROM rain_walk")
def _(spark, sf):
    out = rn.rates(rn.rain_attenuation(_walked(spark, sf)))
    return out.select("cml_id", "channel_id", stamp(), rr("waa").alias("waa"), rr("r", 3).alias("r"))


@query("walk_in_blocks", f"""SELECT w.cml_id, w.channel_id, {ts('w.time')} AS time, {r('w.baseline')} AS baseline, {r('x.waa')} AS waa
    FROM walked w JOIN rain_walk x USING (cml_id, channel_id, time)""")
def _(spark, sf):
    """The same recursions, a channel spread over tasks of a few rows."""
    out = bl.baseline_and_waa(wet(spark, sf), n=3, tau=6.0 * demo.STEP_MINUTES, step_minutes=demo.STEP_MINUTES, block_rows=8)
    return out.select("cml_id", "channel_id", stamp(), rr("baseline").alias("baseline"), rr("waa").alias("waa"))


@query("waa_leijnse")
def _(spark, sf):
    held = rn.rain_attenuation(bl.last_dry_baseline(wet(spark, sf)))
    ends = ch.link_ends(links(spark, sf))
    curves = rn.leijnse_table(ends.select(F.explode(F.array("f_ab", "f_ba")).alias("frequency")))
    out = rn.rates(rn.wet_antenna(held, WetAntenna(method="leijnse"), curves))
    return out.select("cml_id", "channel_id", stamp(), rr("waa").alias("waa"), rr("r", 3).alias("r"))


# --- link products ---------------------------------------------------------------------------


@query("rain_channel_mean", f"SELECT cml_id, {ts()} AS time, {r('r', 3)} AS r FROM link_rain")
def _(spark, sf):
    return link_rain(spark, sf).select("cml_id", stamp(), rr("r", 3).alias("r"))


@query("rain_output_step", f"""SELECT cml_id, channel_id, {ts("time_bucket(INTERVAL 5 DAY, time, (SELECT date_trunc('day', min(time)) FROM rain)) + INTERVAL 5 DAY")} AS time,
    {r('avg(r)', 3)} AS r FROM rain GROUP BY ALL""")
def _(spark, sf):
    out = rs.output_steps(rain(spark, sf), demo.STEP_MINUTES, 5 * demo.STEP_MINUTES)
    return out.select("cml_id", "channel_id", stamp(), rr("r", 3).alias("r"))


@query("rain_hourly", f"""SELECT cml_id, {ts("date_trunc('hour', time) + INTERVAL 1 HOUR")} AS time, {r('avg(value)')} AS r
    FROM (SELECT user_id AS cml_id, ts AS time, value FROM events) GROUP BY ALL""")
def _(spark, sf):
    rows = demo.table(spark, sf, "events").select(
        F.col("user_id").alias("cml_id"), F.col("ts").cast("timestamp").alias("time"), F.col("value").alias("r")
    )
    return rs.output_steps(rows, 10, 60, keys=("cml_id",)).select("cml_id", stamp(), rr("r").alias("r"))


@query("rain_aligned", f"SELECT cml_id, {ts()} AS time, pos, {r('r', 3)} AS r FROM aligned")
def _(spark, sf):
    return aligned(spark, sf).select("cml_id", stamp(), F.col("pos").cast("bigint").alias("pos"), rr("r", 3).alias("r"))


@query("rain_hour_sum", f"SELECT cml_id, {ts()} AS time, {r('r_hour_sum', 2)} AS r_hour_sum FROM hour_sum")
def _(spark, sf):
    return hour_sum(spark, sf).select("cml_id", stamp(), rr("r_hour_sum", 2).alias("r_hour_sum"))


@query("hour_sum_audit", """SELECT count(*) AS checked, 0.0 AS max_abs_diff FROM hour_sum
    WHERE r_hour_sum > 0""")
def _(spark, sf):
    return rs.audit_hour_sums(hour_sum(spark, sf), demo.STEP_MINUTES, HOUR_SUM_MINUTES).select(
        "checked", rr("max_abs_diff", 3).alias("max_abs_diff")
    )


# --- grid, interpolation, mask ---------------------------------------------------------------

# They hold the sites of every scale factor (lon 11.5 to 18.95, lat 48.2 to 51.15).
LIMITS = Limits(11.3, 19.2, 48.0, 51.4)
INTERP = Interp(nx=60, ny=54, near=5, dist_m=20000.0, tile=8)
GRID = gr.make_grid(INTERP, LIMITS)
STEP_GRID = gr.make_grid(replace(INTERP, nx=None, ny=None, step_m=9000.0), LIMITS)
DEGREE_GRID = gr.make_grid(replace(INTERP, mercator=False, res_deg=0.1), LIMITS)
LEAST = 0.1


def _cells_sql(g: gr.Grid) -> str:
    return f"""SELECT CAST(i // {g.nx} AS INTEGER) AS "row", CAST(i % {g.nx} AS INTEGER) AS col,
        {g.x0!r}e0 + ((i % {g.nx}) + {g.shift!r}e0)*{g.dx!r}e0 AS x,
        {g.y0!r}e0 + ((i // {g.nx}) + {g.shift!r}e0)*{g.dy!r}e0 AS y FROM range({g.nx * g.ny}) t(i)"""


def _field_sql(value: str, k: int = 5, radius: str = "20000e0", mercator: bool = True, least: float = 0.1) -> dict[str, str]:
    lon, lat = "(lon_a+lon_b)/2", "(lat_a+lat_b)/2"
    px = f"6378137e0*radians({lon})" if mercator else lon
    py = f"6378137e0*ln(tan(pi()/4 + radians({lat})/2))" if mercator else lat
    return {
        "cells": _cells_sql(GRID if mercator else DEGREE_GRID),
        "centers": f"SELECT cml_id, {px} AS px, {py} AS py FROM links",
        "cand": f"""SELECT * FROM (SELECT "row", col, cml_id, sqrt((px-x)*(px-x)+(py-y)*(py-y)) AS d FROM cells CROSS JOIN centers)
            WHERE d < {radius}""",
        "zvals": f"SELECT cml_id, time, {value} AS z FROM hour_sum",
        "ranked": f"""SELECT time, "row", col, d, z, row_number() OVER (PARTITION BY time, "row", col
            ORDER BY floor(d/{radius}*1e8), cml_id) AS rk FROM cand JOIN zvals USING (cml_id) WHERE z IS NOT NULL""",
        "frames": f"""SELECT time, "row", col, CASE WHEN v < {least} THEN 0.0 ELSE v END AS v FROM (
            SELECT time, "row", col, CASE WHEN min(d) < 1e-10 THEN arg_min(z, d) ELSE sum(z*pow(d,-2))/sum(pow(d,-2)) END AS v
            FROM ranked WHERE rk <= {k} GROUP BY 1, 2, 3)""",
    }


def _frames(spark, sf, value="r", series=None, mercator=True, **kw):
    series = stage(hour_sum(spark, sf), "hour_sum") if series is None else series
    kw = {"near": INTERP.near, "radius": INTERP.dist_m if mercator else 0.25, "tile": INTERP.tile, "least": LEAST, **kw}
    return idw.rain_frames(
        series, links(spark, sf), GRID if mercator else DEGREE_GRID, value=value, mercator=mercator, **kw
    )


FRAME_SQL = f"""SELECT {ts()} AS time, "row", col, {r('v', 3)} AS v FROM frames"""


def _frame_out(frames):
    return frames.select(stamp(), "row", "col", rr("v", 3).alias("v"))


@query("grid_cells", f"""SELECT g."row", g.col, {r('x', 2)} AS x, {r('y', 2)} AS y, count(cml_id) AS n_links
    FROM cells g LEFT JOIN centers c ON g.col = floor((c.px - {GRID.x0!r}e0) / {GRID.dx!r}e0)
      AND g."row" = floor((c.py - {GRID.y0!r}e0) / {GRID.dy!r}e0) GROUP BY ALL""", _field_sql("r"))
def _(spark, sf):
    centers = idw.link_centers(links(spark, sf)).select(
        F.floor((F.col("py") - GRID.y0) / GRID.dy).cast("int").alias("row"),
        F.floor((F.col("px") - GRID.x0) / GRID.dx).cast("int").alias("col"), "cml_id",
    )
    out = gr.cells(spark, GRID).join(centers, ["row", "col"], "left")
    return out.groupBy("row", "col", rr("x", 2).alias("x"), rr("y", 2).alias("y")).agg(F.count("cml_id").alias("n_links"))


@query("grid_nearest_link", f"""SELECT kind, "row", col, cml_id, {r('d', 4)} AS d FROM (
      SELECT kind, "row", col, cml_id, d, row_number() OVER (PARTITION BY kind, "row", col ORDER BY floor(d/radius*1e8), cml_id) AS rk FROM (
        SELECT 'step' AS kind, 30000e0 AS radius, "row", col, cml_id, sqrt((px-x)*(px-x)+(py-y)*(py-y)) AS d
          FROM step_cells CROSS JOIN centers
        UNION ALL
        SELECT 'degree', 0.3e0, "row", col, cml_id, sqrt((lon-x)*(lon-x)+(lat-y)*(lat-y)) FROM degree_cells
          CROSS JOIN (SELECT cml_id, (lon_a+lon_b)/2 AS lon, (lat_a+lat_b)/2 AS lat FROM links))
      WHERE d < radius) WHERE rk = 1""",
       {**_field_sql("r"), "step_cells": _cells_sql(STEP_GRID), "degree_cells": _cells_sql(DEGREE_GRID)})
def _(spark, sf):
    lk = links(spark, sf)

    def nearest(kind, grid, mercator, radius):
        centers = idw.link_centers(lk, mercator)
        found = idw.nearest_links(
            centers.withColumn("grp", F.lit(0)), gr.cells(spark, grid), 1, radius, idw.halvings(centers, radius)
        )
        return found.select(F.lit(kind).alias("kind"), "row", "col", "cml_id", rr("d", 4).alias("d"))

    return nearest("step", STEP_GRID, True, 30000.0).unionByName(nearest("degree", DEGREE_GRID, False, 0.3))


@query("idw_field", FRAME_SQL, _field_sql("r"))
def _(spark, sf):
    return _frame_out(_frames(spark, sf))


@query("idw_dry_as_missing", FRAME_SQL, _field_sql("nullif(r, 0.0)"))
def _(spark, sf):
    return _frame_out(_frames(spark, sf, dry_as_missing=True))


@query("idw_hour_sum", FRAME_SQL, _field_sql("r_hour_sum"))
def _(spark, sf):
    return _frame_out(_frames(spark, sf, "r_hour_sum"))


@query("idw_degrees", FRAME_SQL, _field_sql("r", radius="0.25e0", mercator=False))
def _(spark, sf):
    return _frame_out(_frames(spark, sf, mercator=False))


# A chevron below and above the row of sites, concave at its upper side.
RING_SQL = {
    "extent": "SELECT min(lon) AS w, max(lon) AS e, min(lat) AS s FROM sites",
    "corners": """SELECT * FROM (SELECT 0 AS i, w - 0.02 AS lon, s - 0.13 AS lat FROM extent UNION ALL SELECT 1, (w+e)/2, s + 0.02 FROM extent
        UNION ALL SELECT 2, e, s - 0.21 FROM extent UNION ALL SELECT 3, (w+e)/2 + 0.01, s + 0.31 FROM extent)""",
    "points": "SELECT i, 6378137e0*radians(lon) AS x, 6378137e0*ln(tan(pi()/4 + radians(lat)/2)) AS y FROM corners",
    "sides": "SELECT a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM points a JOIN points b ON b.i = (a.i + 1) % 4",
    "inside": """SELECT "row", col FROM cells JOIN sides ON (y1 <= y) <> (y2 <= y)
        AND x1 + (x2 - x1)*(y - y1)/(y2 - y1) > x GROUP BY 1, 2 HAVING count(*) % 2 = 1""",
}


def _extent(spark, sf):
    return demo.sites(spark, sf).agg(
        F.min("X_coordinate").alias("w"), F.max("X_coordinate").alias("e"), F.min("Y_coordinate").alias("s")
    )


def _ring(spark, sf):
    e = _extent(spark, sf)
    middle = (F.col("w") + F.col("e")) / 2
    return e.select(
        F.lit(0).alias("ring"),
        F.array(
            F.array(F.col("w") - 0.02, F.col("s") - 0.13), F.array(middle, F.col("s") + 0.02),
            F.array(F.col("e"), F.col("s") - 0.21), F.array(middle + 0.01, F.col("s") + 0.31),
        ).alias("points"),
    )


def _inside(spark, sf):
    return mask.inside_cells(mask.to_mercator(polygons.edges(_ring(spark, sf))), GRID)


@query("polygon_mask", 'SELECT "row", col FROM inside', {**_field_sql("r"), **RING_SQL})
def _(spark, sf):
    return _inside(spark, sf)


@query("union_mask", """SELECT DISTINCT "row", col FROM (
      SELECT feature, "row", col FROM cells JOIN parts ON (y1 <= y) <> (y2 <= y) AND x1 + (x2 - x1)*(y - y1)/(y2 - y1) > x GROUP BY 1, 2, 3 HAVING count(*) % 2 = 1)""", {
    **_field_sql("r"), **RING_SQL,
    "shifted": """SELECT 0 AS feature, 0 AS ring, i, lon, lat FROM corners UNION ALL SELECT 1, 0, i, lon + 0.05, lat + 0.04 FROM corners
        UNION ALL SELECT 1, 1, i, lon + 0.05 + 0.3*((w + e)/2 - lon), lat + 0.04 + 0.3*(s - lat) FROM corners, extent""",
    "dots": "SELECT feature, ring, i, 6378137e0*radians(lon) AS x, 6378137e0*ln(tan(pi()/4 + radians(lat)/2)) AS y FROM shifted",
    "parts": """SELECT a.feature, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM dots a JOIN dots b
        ON b.feature = a.feature AND b.ring = a.ring AND b.i = (a.i + 1) % 4""",
})
def _(spark, sf):
    """Two features that overlap, the second with a hole."""
    one = _ring(spark, sf).withColumns({"feature": F.lit(0), "ring": F.lit(0)})
    e = _extent(spark, sf)
    middle = (F.col("w") + F.col("e")) / 2
    moved = lambda p: F.array(p[0] + 0.05, p[1] + 0.04)
    hole = lambda p: F.array(p[0] + 0.05 + 0.3 * (middle - p[0]), p[1] + 0.04 + 0.3 * (F.col("s") - p[1]))
    two = one.withColumns({"points": F.transform("points", moved), "feature": F.lit(1)})
    cut = one.crossJoin(F.broadcast(e)).withColumns({"points": F.transform("points", hole), "feature": F.lit(1), "ring": F.lit(1)}).select(two.columns)
    return mask.inside_cells(mask.to_mercator(polygons.edges(one.unionByName(two).unionByName(cut))), GRID)


@query("masked_field", f"""SELECT {ts()} AS time, f."row", f.col, {r('v', 3)} AS v FROM frames f
    JOIN inside i ON i."row" = f."row" AND i.col = f.col""", {**_field_sql("r"), **RING_SQL})
def _(spark, sf):
    return _frame_out(_frames(spark, sf, inside=_inside(spark, sf)))


EXTENT = Limits(
    GRID.x0 + GRID.dx / 2, GRID.x0 + (GRID.nx - 0.5) * GRID.dx, GRID.y0 + GRID.dy / 2, GRID.y0 + (GRID.ny - 0.5) * GRID.dy
)


@query("point_lookup", f"""SELECT id AS point_id, {ts()} AS time, {r('v', 3)} AS v FROM (
      SELECT id, least(greatest(CAST(round_even((lon_m - {EXTENT.x_min!r}e0)/{GRID.dx!r}e0, 0) AS INTEGER), 0), {GRID.nx - 1}) AS col,
        least(greatest(CAST(round_even((lat_m - {EXTENT.y_min!r}e0)/{GRID.dy!r}e0, 0) AS INTEGER), 0), {GRID.ny - 1}) AS "row"
      FROM (SELECT id, 6378137e0*radians(lon) + 123.4 AS lon_m, 6378137e0*ln(tan(pi()/4 + radians(lat)/2)) AS lat_m FROM sites)) p
    LEFT JOIN frames f USING ("row", col)""", _field_sql("r"))
def _(spark, sf):
    points = demo.sites(spark, sf).select(
        F.col("ID").alias("point_id"), (mercator_x(F.col("X_coordinate")) + 123.4).alias("x"),
        mercator_y(F.col("Y_coordinate")).alias("y"),
    )
    found = gr.lookup(points, _frames(spark, sf), EXTENT, GRID.ny, GRID.nx, "v")
    return found.select("point_id", stamp(), rr("v", 3).alias("v"))


# --- frame products --------------------------------------------------------------------------

SCORES = {m: Score(method=m, threshold=500.0, reference=20000.0) for m in ("mean", "p90", "p95", "coverage", "coverage_strength")}


def _log_score(stat: str) -> str:
    return f"CASE WHEN {stat} > 0 THEN least(1.0, greatest(0.0, ln(1+{stat})/ln(1+20000.0))) ELSE 0.0 END"


SCORE_SQL = {
    "stats": """SELECT time, avg(v) AS m, quantile_cont(v, 0.9) AS p90, quantile_cont(v, 0.95) AS p95,
        count(*) FILTER (WHERE v > 500.0)*1.0/count(*) AS cov, avg(v) FILTER (WHERE v > 500.0) AS wm FROM frames GROUP BY 1""",
    "scores": f"""SELECT time, {_log_score('m')} AS mean, {_log_score('p90')} AS p90, {_log_score('p95')} AS p95, cov AS coverage,
        CASE WHEN wm > 0 THEN pow(cov, 0.3)*({_log_score('wm')}) ELSE 0.0 END AS coverage_strength FROM stats""",
}


@query("frame_scores", f"SELECT {ts()} AS time, {', '.join(f'{r(m)} AS {m}' for m in SCORES)} FROM scores",
       {**_field_sql("r"), **SCORE_SQL})
def _(spark, sf):
    frames = _frames(spark, sf)
    scores = [rr(pr.score_of(F.col("v"), cfg)).alias(m) for m, cfg in SCORES.items()]
    return frames.groupBy("time").agg(*scores).select(stamp(), *SCORES)


def _info_sql(value: str, hours: float | None) -> str:
    v = "v" if hours is None else f"v/{hours}"
    return f"""SELECT {ts('l.time')} AS time, strftime(l.time, '%Y-%m-%d_%H%M') AS utc,
        round_even(CASE WHEN any_wet THEN greatest(coalesce(cov, 0.0), 0.001) ELSE coalesce(cov, 0.0) END, 4) AS overall,
        ids, count_true, count_total FROM (
          SELECT time, array_to_string(list_sort(list(cml_id) FILTER (WHERE {value} > 0)), ',') AS ids,
            count(*) FILTER (WHERE {value} > 0) AS count_true, count(*) AS count_total, coalesce(bool_or(r > 0), FALSE) AS any_wet
          FROM hour_sum GROUP BY 1) l
        LEFT JOIN (SELECT time, count(*) FILTER (WHERE {v} > 0)*1.0/count(*) AS cov FROM frames GROUP BY 1) f ON f.time = l.time"""


def _info_out(info):
    ids = F.when(F.size("cml_rain_true") > 0, F.array_join(F.col("cml_rain_true").cast("array<string>"), ","))
    return info.select(stamp(), "utc", "overall", ids.alias("ids"), "count_true", "count_total")


@query("frame_flags", _info_sql("r", None), _field_sql("r"))
def _(spark, sf):
    series = stage(hour_sum(spark, sf), "hour_sum")
    return _info_out(pr.frame_info(_frames(spark, sf, series=series), series))


@query("frame_flags_hour_sum", _info_sql("r_hour_sum", 72.0), _field_sql("r_hour_sum"))
def _(spark, sf):
    series = stage(hour_sum(spark, sf), "hour_sum")
    frames = _frames(spark, sf, "r_hour_sum", series)
    return _info_out(pr.frame_info(frames, series, value="r_hour_sum", window_minutes=HOUR_SUM_MINUTES))


# Rates in the range of the colour classes, from prices.
AMOUNTS_SQL = {"amounts": """SELECT l_orderkey, l_linenumber, l_extendedprice*l_discount*l_tax/8 AS v FROM lineitem"""}


def _amounts(spark, sf):
    return demo.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax") / 8).alias("v")
    )


_REACHED = " + ".join(f"CASE WHEN v >= {lv} THEN 1 ELSE 0 END" for lv in co.CLASS_LEVELS)
_RGB_SQL = "[" + ", ".join(f"'{a},{b},{c},255'" for a, b, c in co.CLASS_RGB) + "]"


@query("color_class", f"""SELECT l_orderkey, l_linenumber, CASE WHEN v >= 0.1 THEN least({_REACHED}, 13) END AS class,
      CASE WHEN v >= 0.1 THEN ({_REACHED}) - 1 END AS class_exact,
      CASE WHEN v >= 0.1 THEN {_RGB_SQL}[least({_REACHED}, 13) + 1] ELSE '0,0,0,0' END AS rgba FROM amounts""", AMOUNTS_SQL)
def _(spark, sf):
    v = F.col("v")
    return _amounts(spark, sf).select(
        "l_orderkey", "l_linenumber", co.intensity_class(v).alias("class"), co.intensity_class(v, "exact").alias("class_exact"),
        F.array_join(co.intensity_rgba(v).cast("array<string>"), ",").alias("rgba"),
    )


_LEVELS, _COLOURS = co._ramp_table()
RAMP_SQL = {
    **AMOUNTS_SQL,
    "palette": "SELECT * FROM (VALUES " + ", ".join(
        f"({i}, {lv}e0, {a}e0, {b}e0, {c}e0)" for i, (lv, (a, b, c)) in enumerate(zip(_LEVELS, _COLOURS))
    ) + ") p(idx, level, red, green, blue)",
    "steps": """SELECT idx, level AS l0, lead(level) OVER (ORDER BY idx) AS l1, red AS r0, lead(red) OVER (ORDER BY idx) AS r1,
        green AS g0, lead(green) OVER (ORDER BY idx) AS g1, blue AS b0, lead(blue) OVER (ORDER BY idx) AS b1 FROM palette""",
}


@query("color_ramp", """SELECT l_orderkey, l_linenumber, CASE WHEN v >= 0.3 THEN
      CAST(CAST(round_even((1-t)*r0 + t*r1, 0) AS INTEGER) AS VARCHAR) || ',' || CAST(CAST(round_even((1-t)*g0 + t*g1, 0) AS INTEGER) AS VARCHAR)
      || ',' || CAST(CAST(round_even((1-t)*b0 + t*b1, 0) AS INTEGER) AS VARCHAR) || ',255' ELSE '0,0,0,0' END AS rgba
    FROM (SELECT *, (least(v, 100e0) - l0)/(l1 - l0) AS t FROM amounts LEFT JOIN steps
      ON l1 IS NOT NULL AND greatest(v, 0.1) >= l0 AND (greatest(v, 0.1) < l1 OR l1 = 100e0))""", RAMP_SQL)
def _(spark, sf):
    return co.with_hour_sum_rgba(_amounts(spark, sf), "v").select(
        "l_orderkey", "l_linenumber", F.array_join(F.col("rgba").cast("array<string>"), ",").alias("rgba")
    )


@query("color_palette_use", """SELECT idx, level, CAST(red AS INTEGER) AS red, CAST(green AS INTEGER) AS green, CAST(blue AS INTEGER) AS blue,
      (SELECT count(*) FROM amounts WHERE v >= level) AS n_reached FROM palette""", RAMP_SQL)
def _(spark, sf):
    counts = [F.struct(F.lit(i).alias("idx"), F.count_if(F.col("v") >= lv).alias("n")) for i, lv in enumerate(_LEVELS)]
    reached = _amounts(spark, sf).agg(F.array(*counts).alias("s")).select(F.inline("s"))
    return co.ramp_levels(spark).join(reached, "idx", "left").select(
        "idx", "level", "red", "green", "blue", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_reached")
    )


NAMES_SQL = {
    "stored": """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'preview_' || o_orderkey || '.png'
        WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d_%H%M') || '.npy'
        ELSE strftime(o_orderdate, '%Y-%m-%d_%H%M') || '_0.' || (100 + o_orderkey % 900) || '.png' END AS name, o_orderdate FROM orders"""
}


def _stored(spark, sf):
    key, day = F.col("o_orderkey"), clock.frame_name(F.col("o_orderdate").cast("timestamp"))
    return demo.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 11 == 0, F.concat(F.lit("preview_"), key, F.lit(".png")))
        .when(key % 3 == 0, F.concat(day, F.lit(".npy")))
        .otherwise(F.concat(day, F.lit("_0."), (100 + key % 900).cast("string"), F.lit(".png"))).alias("name"),
    )


@query("frame_retention", """SELECT expired, count(*) AS n FROM (
      SELECT o_orderkey % 11 <> 0 AND o_orderdate < TIMESTAMP '2000-01-01 00:00:00' - INTERVAL 1000 DAY AS expired FROM stored) GROUP BY 1""", NAMES_SQL)
def _(spark, sf):
    from datetime import datetime, timezone

    out = pr.retention(_stored(spark, sf), datetime(2000, 1, 1, tzinfo=timezone.utc), "1000 DAYS")
    return out.groupBy("expired").agg(F.count(F.lit(1)).alias("n"))


@query("frame_names", """SELECT o_orderkey, name, CASE WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS time
    FROM stored""", NAMES_SQL)
def _(spark, sf):
    return _stored(spark, sf).select(
        "o_orderkey", "name", F.date_format(clock.frame_time(F.col("name")), "yyyy-MM-dd HH:mm:ss").alias("time")
    )


@query("frames_to_write", """SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d_%H%M') AS utc FROM lineitem
    WHERE l_shipdate NOT IN (SELECT o_orderdate FROM stored WHERE o_orderkey % 11 <> 0)""", NAMES_SQL)
def _(spark, sf):
    frames = demo.table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("timestamp").alias("time")).distinct()
    return pr.not_yet_written(frames, _stored(spark, sf)).select(clock.frame_name(F.col("time")).alias("utc"))


@query("latest_frame", """SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS time, array_to_string(list_sort(list(l_partkey)), ',') AS links
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_orderkey = (SELECT max_by(o_orderkey, (o_orderdate, o_orderkey)) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))
    GROUP BY o_orderkey, o_orderdate""")
def _(spark, sf):
    # The newest order with lines first, then its lines alone.
    lines = demo.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    last = (
        demo.table(spark, sf, "orders").join(lines.select("o_orderkey"), "o_orderkey", "left_semi")
        .orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(1).select("o_orderkey", "o_orderdate")
    )
    records = lines.join(F.broadcast(last), "o_orderkey").groupBy("o_orderkey", "o_orderdate").agg(  # one order
        F.to_json(F.sort_array(F.collect_list("l_partkey"))).alias("links")
    ).select(F.struct(F.col("o_orderdate").cast("timestamp").alias("day"), "o_orderkey").alias("time"), "links")
    newest = frame_store.latest_record(records)
    return newest.select(
        F.date_format("time.day", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.array_join(F.col("links").cast("array<string>"), ",").alias("links"),
    )


@query("stored_values", """SELECT l_orderkey, l_linenumber, round_even(v*1000, 0)/1000 AS v FROM amounts""", AMOUNTS_SQL)
def _(spark, sf):
    return frame_store.rounded(_amounts(spark, sf), "v")


@query("series_points", f"""SELECT cml_id, CAST(epoch(time) AS BIGINT) AS time, 'rain_intensity' AS field, {r('r', 3)} AS value
    FROM aligned WHERE time > TIMESTAMP '2024-01-10 00:00:00' AND time IN (SELECT time FROM aligned WHERE r IS NOT NULL)
    UNION ALL SELECT cml_id, CAST(epoch(time) AS BIGINT), 'rain_hour_sum', {r('r_hour_sum', 2)} FROM hour_sum
    WHERE r_hour_sum IS NOT NULL""")
def _(spark, sf):
    series = stage(hour_sum(spark, sf), "hour_sum")
    since = F.timestamp_seconds(F.lit(1704844800))
    rate = pr.intensity_points(series, since).withColumn("value", rr("value", 3))
    return rate.unionByName(pr.hour_sum_points(series).withColumn("value", rr("value", 2)))


@query("newest_frames", f"""SELECT cml_id, {ts()} AS time, {r('r', 3)} AS r FROM aligned WHERE pos >= (SELECT max(pos) FROM aligned) - 6""")
def _(spark, sf):
    lr = stage(link_rain(spark, sf), "link_rain")
    axis = rs.time_axis(lr)
    return pr.newest(rs.align(lr, axis), axis, 7).select("cml_id", stamp(), rr("r", 3).alias("r"))


@query("time_functions", """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS unix, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS rfc,
      strftime(ts, '%Y-%m-%d_%H%M') AS frame, strftime(time_bucket(INTERVAL 10 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS floor10,
      ts = time_bucket(INTERVAL 10 MINUTE, ts) AS aligned FROM events""")
def _(spark, sf):
    t = F.col("ts").cast("timestamp")
    return demo.table(spark, sf, "events").select(
        "event_id", clock.unix_seconds(t).alias("unix"), clock.rfc3339(t).alias("rfc"), clock.frame_name(t).alias("frame"),
        F.date_format(clock.floor_minutes(t, 10), "yyyy-MM-dd HH:mm:ss").alias("floor10"), clock.on_step(t, 10).alias("aligned"),
    )


@query("site_projection", f"""SELECT id, {r('6378137e0*radians(lon)', 3)} AS x, {r('6378137e0*ln(tan(pi()/4 + radians(lat)/2))', 3)} AS y,
      {r('lon')} AS lon, {r('lat')} AS lat FROM sites""")
def _(spark, sf):
    xy = demo.sites(spark, sf).select(
        F.col("ID").alias("id"), mercator_x(F.col("X_coordinate")).alias("x"), mercator_y(F.col("Y_coordinate")).alias("y")
    )
    return xy.select("id", rr("x", 3).alias("x"), rr("y", 3).alias("y"), rr(lon_of(F.col("x"))).alias("lon"), rr(lat_of(F.col("y"))).alias("lat"))


# --- nearby links ----------------------------------------------------------------------------

RADIUS = 15.0
NEARBY = {"radius": RADIUS, "min_links": 3, "interval": 1440, "hours": 120, "min_hours": 48, "f_rows": 4}


def _haversine_sql(p: str, q: str) -> str:
    h = (f"pow(sin((radians(b.lat_{q})-radians(a.lat_{p}))/2),2) + cos(radians(a.lat_{p}))*cos(radians(b.lat_{q}))"
         f"*pow(sin((radians(b.lon_{q})-radians(a.lon_{p}))/2),2)")
    return f"CASE WHEN a.cml_id = b.cml_id THEN 0.0 ELSE 2*6373.0*atan2(sqrt({h}), sqrt(1-({h}))) END AS {p}_to_{q}"


NEARBY_SQL = {
    "pairs": f"""SELECT a.cml_id AS id1, b.cml_id AS id2, {", ".join(_haversine_sql(p, q) for p in "ab" for q in "ab")}
        FROM links a CROSS JOIN links b""",
    "close": f"SELECT * FROM pairs WHERE greatest(a_to_a, a_to_b, b_to_a, b_to_b) < {RADIUS}",
    "levels": "SELECT cml_id, time, min(rsl) AS pmin, any_value(length) AS length FROM clean GROUP BY 1, 2",
    "drops0": """SELECT *, pmin - CASE WHEN count(pmin) OVER w >= 2 THEN max(pmin) OVER w END AS delta_p FROM levels
        WINDOW w AS (PARTITION BY cml_id ORDER BY time ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "drops": "SELECT *, delta_p/length AS delta_pl FROM drops0",
    "medians": """SELECT id1 AS cml_id, time, median(delta_p) AS median_p, median(delta_pl) AS median_pl
        FROM close JOIN drops ON drops.cml_id = id2
        WHERE id1 IN (SELECT id1 FROM close GROUP BY 1 HAVING count(*) > 3)
        GROUP BY 1, 2 HAVING count(delta_p) > 3""",
    "judged": """SELECT d.*, median_p, median_pl, median_p < -1.4 AND median_pl < -0.7 AS wet0,
          coalesce(median_p < -1.4 AND median_pl < -0.7 AND delta_p < -2, FALSE) AS strong
        FROM drops d LEFT JOIN medians m ON m.cml_id = d.cml_id AND m.time = d.time""",
    "spread": """SELECT *, lag(strong, 1, FALSE) OVER w OR lead(strong, 1, FALSE) OVER w OR lead(strong, 2, FALSE) OVER w AS near,
          CASE WHEN count(delta_pl - median_pl) OVER back = 4 THEN sum(delta_pl - median_pl) OVER back * 24.0 END AS f
        FROM judged WINDOW w AS (PARTITION BY cml_id ORDER BY time),
          back AS (PARTITION BY cml_id ORDER BY time ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""",
}


def _levels(spark, sf):
    return clean(spark, sf).groupBy("cml_id", "time").agg(F.min("rsl").alias("pmin"), F.min("length").alias("length"))


@query("endpoint_distances", f"SELECT id1, id2, {', '.join(f'{r(d)} AS {d}' for d in nb.DISTANCES)} FROM close", NEARBY_SQL)
def _(spark, sf):
    return nb.link_pairs(links(spark, sf), RADIUS).select("id1", "id2", *[rr(d).alias(d) for d in nb.DISTANCES])


@query("nearby_links", "SELECT id1 AS cml_id, count(*) AS n_nearby FROM close GROUP BY 1", NEARBY_SQL)
def _(spark, sf):
    return nb.neighbour_counts(links(spark, sf), RADIUS)


@query("nearby_drop", f"SELECT cml_id, {ts()} AS time, {r('delta_p')} AS delta_p, {r('delta_pl')} AS delta_pl FROM drops", NEARBY_SQL)
def _(spark, sf):
    out = nb.power_drop(_levels(spark, sf), 5, 2)
    return out.select("cml_id", stamp(), rr("delta_p").alias("delta_p"), rr("delta_pl").alias("delta_pl"))


@query("nearby_medians", f"SELECT cml_id, {ts()} AS time, {r('median_p')} AS median_p, {r('median_pl')} AS median_pl FROM medians", NEARBY_SQL)
def _(spark, sf):
    drops = nb.power_drop(_levels(spark, sf), 5, 2)
    out = nb.neighbourhood_medians(drops, links(spark, sf), RADIUS, 3)
    return out.select("cml_id", stamp(), rr("median_p").alias("median_p"), rr("median_pl").alias("median_pl"))


@query("nearby_wetdry", f"""SELECT cml_id, {ts()} AS time, CASE WHEN wet0 IS NOT NULL THEN wet0 OR near END AS wet,
    {r('f', 4)} AS f FROM spread""", NEARBY_SQL)
def _(spark, sf):
    out = nb.nearby_wet(_levels(spark, sf), links(spark, sf), **NEARBY)
    return out.select("cml_id", stamp(), "wet", rr("f", 4).alias("f"))


# --- series preparation ----------------------------------------------------------------------

KEY = ["cml_id"]
ROWS = "PARTITION BY cml_id ORDER BY time"


def series(spark, sf):
    return demo.regular_series(spark, sf)


def _values(df, *columns, digits=6):
    return df.select("cml_id", stamp(), *[rr(c, digits).alias(c) for c in columns])


def _values_sql(view: str, *columns, digits=6) -> str:
    return f"SELECT cml_id, {ts()} AS time, {', '.join(f'{r(c, digits)} AS {c}' for c in columns)} FROM {view}"


GAPPY = {
    "gappy": f"""SELECT cml_id, time, CASE WHEN uptime % 5 >= 2 THEN x END AS x, row_number() OVER ({ROWS}) AS n FROM series""",
    "edges": """SELECT *, last_value(x IGNORE NULLS) OVER back AS pv, last_value(CASE WHEN x IS NOT NULL THEN n END IGNORE NULLS) OVER back AS pn,
          first_value(x IGNORE NULLS) OVER ahead AS qv, first_value(CASE WHEN x IS NOT NULL THEN n END IGNORE NULLS) OVER ahead AS qn
        FROM gappy WINDOW back AS (PARTITION BY cml_id ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          ahead AS (PARTITION BY cml_id ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "bridged": """SELECT cml_id, time, CASE WHEN x IS NOT NULL THEN x WHEN n - pn <= 2 THEN
          CASE WHEN qv IS NOT NULL THEN pv + (qv - pv)*(n - pn)/(qn - pn) ELSE pv END END AS x FROM edges""",
}


def gappy(spark, sf):
    return series(spark, sf).withColumn("x", F.when(F.col("uptime") % 5 >= 2, F.col("x")))


@query("gap_fill_limit", _values_sql("bridged", "x"), GAPPY)
def _(spark, sf):
    return _values(pp.fill_by_position(gappy(spark, sf), KEY, ["x"], 2), "x")


@query("std_outliers", _values_sql("kept", "x"), {
    "dev": f"""SELECT cml_id, time, x, CASE WHEN count(x) OVER w = 10 THEN stddev_samp(x) OVER w END AS d FROM series
        WINDOW w AS ({ROWS} ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)""",
    "dev2": f"""SELECT *, coalesce(first_value(d IGNORE NULLS) OVER (PARTITION BY cml_id ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
        last_value(d IGNORE NULLS) OVER ({ROWS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS e FROM dev""",
    "kept": "SELECT cml_id, time, CASE WHEN round(e, 9) < 14.0 THEN x END AS x FROM dev2",
})
def _(spark, sf):
    return _values(pp.drop_unsteady(series(spark, sf), KEY, ["x"], 10, 14.0), "x")


@query("z_outliers", _values_sql("kept", "x"), {
    "zs": "SELECT cml_id, time, x, (x - avg(x) OVER w)/stddev_samp(x) OVER w AS z FROM series WINDOW w AS (PARTITION BY cml_id)",
    "kept": "SELECT cml_id, time, CASE WHEN abs(z) < 1.5 AND z > -1.2 THEN x END AS x FROM zs",
})
def _(spark, sf):
    return _values(pp.drop_outliers(series(spark, sf), KEY, ["x"], 1.5, -1.2), "x")


@query("rolling_median", _values_sql("less", "x"), {
    "less": f"""SELECT cml_id, time, x - CASE WHEN count(x) OVER w = 9 THEN quantile_cont(x, 0.5) OVER w END AS x FROM series
        WINDOW w AS ({ROWS} ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)"""})
def _(spark, sf):
    return _values(pp.subtract_median(series(spark, sf), KEY, ["x"], 9), "x")


@query("rolling_median_long", _values_sql("less", "x"), {
    "less": f"""SELECT cml_id, time, x - CASE WHEN count(x) OVER w = 100 THEN quantile_cont(x, 0.5) OVER w END AS x FROM series
        WINDOW w AS ({ROWS} ROWS BETWEEN 50 PRECEDING AND 49 FOLLOWING)"""})
def _(spark, sf):
    return _values(pp.subtract_median(series(spark, sf), KEY, ["x"], 100), "x")


@query("median_shifted", _values_sql("less", "x"), {
    "moved": f"""SELECT cml_id, time, CASE WHEN row_number() OVER ({ROWS}) + 3 > count(*) OVER (PARTITION BY cml_id)
        THEN last_value(x) OVER ({ROWS} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) ELSE lead(x, 3) OVER ({ROWS}) END AS x FROM series""",
    "less": f"""SELECT cml_id, time, x - CASE WHEN count(x) OVER w >= 4 THEN quantile_cont(x, 0.5) OVER w END AS x FROM moved
        WINDOW w AS ({ROWS} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""})
def _(spark, sf):
    moved = pp.shift_ahead(series(spark, sf).select("cml_id", "time", "x"), KEY, ["x"], 3)
    return _values(pp.subtract_median(moved, KEY, ["x"], 12, centered=False, min_rows=4), "x")


STEPS_SQL = {
    "scaled": """SELECT cml_id, time, x, (x - min(x) OVER w)/(max(x) OVER w - min(x) OVER w) AS s FROM series WINDOW w AS (PARTITION BY cml_id)""",
    "scored": f"""SELECT *, CASE WHEN count(s) OVER a = 20 AND count(s) OVER b = 20 THEN abs(sum(s) OVER a - sum(s) OVER b) ELSE 0.0 END AS score
        FROM scaled WINDOW a AS ({ROWS} ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING), b AS ({ROWS} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)""",
    "flipped": f"SELECT *, coalesce(lag(score > 4.003) OVER ({ROWS}), FALSE) <> (score > 4.003) AS flip FROM scored",
    "runs": f"SELECT *, sum(CASE WHEN flip THEN 1 ELSE 0 END) OVER ({ROWS}) AS run FROM flipped",
    "levels": """SELECT cml_id, run, time, CAST(floor(score*1e6+0.4997) AS BIGINT) AS lv, row_number() OVER (PARTITION BY cml_id, run ORDER BY time) AS n
        FROM runs WHERE score > 4.003""",
    "flats": """SELECT cml_id, run, flat, min(lv) AS lv, min(n) AS a, max(n) AS b FROM (
        SELECT *, sum(CASE WHEN lv = before THEN 0 ELSE 1 END) OVER (PARTITION BY cml_id, run ORDER BY n) AS flat FROM (
            SELECT *, lag(lv) OVER (PARTITION BY cml_id, run ORDER BY n) AS before FROM levels)) GROUP BY 1, 2, 3""",
    "tops": """SELECT * FROM (SELECT *, lag(lv) OVER w AS l, lead(lv) OVER w AS r FROM flats WINDOW w AS (PARTITION BY cml_id, run ORDER BY flat))
        WHERE l < lv AND r < lv""",
    "reach": """SELECT t.cml_id, t.run, t.flat, t.lv, t.a, t.b, coalesce(max(CASE WHEN f.flat < t.flat AND f.lv > t.lv THEN f.flat END), -1) AS lo,
        coalesce(min(CASE WHEN f.flat > t.flat AND f.lv > t.lv THEN f.flat END), 1000000000) AS hi
        FROM tops t JOIN flats f ON f.cml_id = t.cml_id AND f.run = t.run GROUP BY 1, 2, 3, 4, 5, 6""",
    "peaks": """SELECT q.cml_id, q.run, (q.a + q.b)//2 AS n FROM reach q JOIN flats f ON f.cml_id = q.cml_id AND f.run = q.run AND f.flat > q.lo AND f.flat < q.hi
        GROUP BY q.cml_id, q.run, q.flat, q.lv, q.a, q.b
        HAVING q.lv - greatest(min(CASE WHEN f.flat < q.flat THEN f.lv END), min(CASE WHEN f.flat > q.flat THEN f.lv END)) >= 1000000""",
    "stepped": """SELECT runs.*, peaks.n IS NOT NULL AS step FROM runs LEFT JOIN levels ON levels.cml_id = runs.cml_id AND levels.time = runs.time
        LEFT JOIN peaks ON peaks.cml_id = levels.cml_id AND peaks.run = levels.run AND peaks.n = levels.n""",
    "blanked": f"""SELECT *, CASE WHEN bool_or(step) OVER ({ROWS} ROWS BETWEEN 4 PRECEDING AND 5 FOLLOWING) THEN NULL ELSE x END AS bx,
        sum(CASE WHEN step THEN 1 ELSE 0 END) OVER ({ROWS}) AS stretch FROM stepped""",
    "repaired": "SELECT cml_id, time, bx - avg(bx) OVER (PARTITION BY cml_id, stretch) AS x FROM blanked",
}


@query("step_score", _values_sql("scored", "score"), STEPS_SQL)
def _(spark, sf):
    return _values(pp.step_scores(series(spark, sf), KEY, "x", 20), "score")


@query("step_rows", f"SELECT cml_id, {ts()} AS time, step FROM stepped", STEPS_SQL)
def _(spark, sf):
    scored = pp.step_scores(series(spark, sf), KEY, "x", 20)
    return pp.step_rows(scored, KEY, 4.003).select("cml_id", stamp(), "step")


@query("step_repair", _values_sql("repaired", "x"), STEPS_SQL)
def _(spark, sf):
    return _values(pp.repair_steps(series(spark, sf), KEY, "x", 20, 4.003), "x")


@query("device_reset", _values_sql("left_over", "x", "y"), {
    "resets": f"SELECT *, coalesce(uptime <= lag(uptime) OVER ({ROWS}), FALSE) AS reset FROM series",
    "left_over": "SELECT cml_id, time, x, y FROM resets WHERE NOT reset",
})
def _(spark, sf):
    return _values(pp.drop_resets(series(spark, sf), KEY, ["x", "y"], ["uptime"]), "x", "y")


@query("standardized", _values_sql("scaled", "x", "temp", "y"), {
    "scaled": """SELECT cml_id, time, (x - avg(x) OVER w)/nullif(max(x) OVER w, 0) AS x,
        (temp - min(temp) OVER w)/nullif(max(temp) OVER w - min(temp) OVER w, 0) AS temp,
        (y - avg(y) OVER w)/nullif(stddev_pop(y) OVER w, 0) AS y FROM series WINDOW w AS (PARTITION BY cml_id)"""})
def _(spark, sf):
    df = pp.scale_to_range(pp.scale_by_max(series(spark, sf), KEY, ["x"]), KEY, ["temp"])
    return _values(pp.z_normalise(df, KEY, ["y"]), "x", "temp", "y")


@query("paired_channels", f"""SELECT cml_id, {ts()} AS time, {r('trsl_a')} AS trsl_a, {r('trsl_b')} AS trsl_b,
    {r('temperature_rx')} AS temperature_rx, {r('temperature_tx')} AS temperature_tx FROM (
      SELECT cml_id, time, CASE WHEN max(tsl - rsl) FILTER (WHERE channel_id LIKE 'A%') < 99 THEN max(tsl - rsl) FILTER (WHERE channel_id LIKE 'A%') END AS trsl_a,
        CASE WHEN max(tsl - rsl) FILTER (WHERE channel_id LIKE 'B%') < 99 THEN max(tsl - rsl) FILTER (WHERE channel_id LIKE 'B%') END AS trsl_b,
        max(temperature_rx) FILTER (WHERE channel_id LIKE 'A%') AS temperature_rx, max(temperature_tx) FILTER (WHERE channel_id LIKE 'B%') AS temperature_tx
      FROM channels GROUP BY 1, 2 HAVING count(*) = 2)""")
def _(spark, sf):
    return _values(pp.paired_path_loss(ch.paired_channels(channels(spark, sf))), "trsl_a", "trsl_b", "temperature_rx", "temperature_tx")


@query("preprocess_chain")
def _(spark, sf):
    paired = ch.paired_channels(channels(spark, sf))
    out = pp.preprocess(paired, KEY, step_half=4, step_threshold=2.0, window=4, deviation=20.0, median_window=5)
    return _values(out, "trsl_a", "trsl_b", "temperature_rx", "temperature_tx")


# --- reference flags and training sets -------------------------------------------------------

WEEK = 7 * 1440.0
FLAGS_SQL = {
    "weekly": """SELECT *, sum(rain) OVER (PARTITION BY cml_id, floor(epoch(time)/604800))/20.0 AS wrain FROM series""",
    "flagged_rows": f"SELECT *, wrain > 0.15 AND row_number() OVER ({ROWS}) > 1 AS ref_wd FROM weekly",
    "changes": f"SELECT *, coalesce(CAST(ref_wd <> lag(ref_wd) OVER ({ROWS}) AS INTEGER), 1) AS changed FROM flagged_rows",
    "numbered_islands": f"SELECT *, sum(changed) OVER ({ROWS}) AS island FROM changes",
    "island_sizes": """SELECT *, count(*) OVER (PARTITION BY cml_id, island) AS island_rows,
        row_number() OVER (PARTITION BY cml_id, island ORDER BY time) AS k FROM numbered_islands""",
    "rows0": f"SELECT *, row_number() OVER ({ROWS}) - 1 AS row0 FROM flagged_rows",
}


def flagged_rows(spark, sf):
    return tr.reference_flags(series(spark, sf), KEY, WEEK)


@query("ref_flags", f"SELECT cml_id, {ts()} AS time, {r('wrain')} AS rain, ref_wd FROM flagged_rows", FLAGS_SQL)
def _(spark, sf):
    return flagged_rows(spark, sf).select("cml_id", stamp(), rr("rain").alias("rain"), "ref_wd")


@query("single_zero_repair", _values_sql("fixed", "rain"), {
    "wets": f"SELECT *, rain <> 0 AS w FROM series",
    "fixed": f"""SELECT cml_id, time, CASE WHEN NOT w AND (lead(w, 1, FALSE) OVER o OR lead(w, 2, FALSE) OVER o)
        AND (lag(w, 1, FALSE) OVER o OR lag(w, 2, FALSE) OVER o) THEN 0.01 ELSE rain END AS rain FROM wets WINDOW o AS ({ROWS})"""})
def _(spark, sf):
    return _values(tr.repair_single_zeros(series(spark, sf), KEY), "rain")


@query("event_tail_zero", _values_sql("cut", "rain"), {
    "ends": f"SELECT *, rain <> 0 AND NOT lead(rain <> 0, 1, FALSE) OVER ({ROWS}) AS e FROM series",
    "cut": f"""SELECT cml_id, time, CASE WHEN bool_or(e) OVER ({ROWS} ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) THEN 0.0 ELSE rain END AS rain FROM ends"""})
def _(spark, sf):
    return _values(tr.zero_event_tails(series(spark, sf), KEY, 3), "rain")


@query("wet_islands", f"SELECT cml_id, {ts()} AS time, CAST(island AS BIGINT) AS island, island_rows FROM island_sizes", FLAGS_SQL)
def _(spark, sf):
    return tr.islands(flagged_rows(spark, sf), KEY).select("cml_id", stamp(), "island", "island_rows")


@query("class_balance", f"""SELECT cml_id, {ts()} AS time, ref_wd FROM island_sizes
    WHERE ref_wd OR island_rows <= 4 OR k <= 2 OR k > island_rows - 2""", FLAGS_SQL)
def _(spark, sf):
    return tr.balance(flagged_rows(spark, sf), KEY, 4).select("cml_id", stamp(), "ref_wd")


@query("segments", f"SELECT cml_id, {ts()} AS time, row0//60 AS segment_id FROM rows0", FLAGS_SQL)
def _(spark, sf):
    return tr.segments(series(spark, sf), KEY, 60).select("cml_id", stamp(), "segment_id")


@query("segment_order")
def _(spark, sf):
    return tr.segments(series(spark, sf), KEY, 60, seed=3).groupBy("cml_id", "segment_id").agg(
        F.min("shuffled_id").alias("shuffled_id"), F.count(F.lit(1)).alias("n_rows")
    )


@query("segment_arrays", f"""SELECT cml_id, row0//60 AS segment_id, count(*) AS n, {r('sum(x)', 4)} AS total,
      {r('arg_min(x, row0)')} AS first_x, {r('arg_max(y, row0)')} AS last_y, arg_min(ref_wd, row0) AS ref_wd
    FROM rows0 GROUP BY 1, 2 HAVING count(*) = 60""", FLAGS_SQL)
def _(spark, sf):
    out = tr.segment_arrays(flagged_rows(spark, sf), KEY, 60, ["x", "y"], "ref_wd")
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return out.select(
        "cml_id", "segment_id", F.size("x").cast("bigint").alias("n"), rr(total, 4).alias("total"),
        rr(F.col("x")[0]).alias("first_x"), rr(F.element_at("y", -1)).alias("last_y"), "ref_wd",
    )


@query("segment_scores_expanded", f"""SELECT s.cml_id, {ts()} AS time, p >= 0.5 AS wet FROM rows0 s LEFT JOIN (
      SELECT cml_id, row0//60 AS segment_id, avg(x)/51 AS p FROM rows0 GROUP BY 1, 2 HAVING count(*) = 60) t
    ON t.cml_id = s.cml_id AND t.segment_id = s.row0//60""", FLAGS_SQL)
def _(spark, sf):
    df = series(spark, sf)
    scores = tr.segment_arrays(df, KEY, 60, ["x"]).select(
        "cml_id", "segment_id", (F.aggregate("x", F.lit(0.0), lambda a, v: a + v) / 60 / 51).alias("probability")
    )
    return tr.expand_segments(df, scores, KEY, 60).select("cml_id", stamp(), "wet")


@query("feature_windows", f"""SELECT cml_id, {ts()} AS time, CASE WHEN ok THEN 40 END AS n, {r('CASE WHEN ok THEN sx + sy END', 4)} AS total,
      {r('CASE WHEN ok THEN fx END')} AS first_x, {r('CASE WHEN ok THEN ly END')} AS last_y FROM (
      SELECT *, count(x) OVER w = 20 AND count(y) OVER w = 20 AS ok, sum(x) OVER w AS sx, sum(y) OVER w AS sy,
        first_value(x) OVER w AS fx, last_value(y) OVER w AS ly
      FROM (SELECT cml_id, time, CASE WHEN uptime % 23 <> 0 THEN x END AS x, y FROM series)
      WINDOW w AS ({ROWS} ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING))""")
def _(spark, sf):
    df = series(spark, sf).withColumn("x", F.when(F.col("uptime") % 23 != 0, F.col("x")))
    out = tr.feature_windows(df, KEY, ["x", "y"], 10, 9)
    f = F.col("features")
    total = F.aggregate(f, F.lit(0.0), lambda a, v: a + v)
    return out.select(
        "cml_id", stamp(), F.when(f.isNotNull(), F.size(f)).alias("n"), rr(total, 4).alias("total"),
        rr(F.get(f, F.lit(0))).alias("first_x"), rr(F.get(f, F.lit(39))).alias("last_y"),
    )


@query("sliding_classifier", f"""SELECT c.cml_id, c.channel_id, {ts('c.time')} AS time, coalesce(f.p > 0.51, FALSE) AS wet FROM clean c
    JOIN judged f ON f.cml_id = c.cml_id AND f.time = c.time WHERE f.n > 3""", {
    "pairs": """SELECT cml_id, time, max(CASE WHEN channel_id = 'A(rx)_B(tx)' THEN trsl END) AS a, max(CASE WHEN channel_id = 'B(rx)_A(tx)' THEN trsl END) AS b
        FROM clean GROUP BY 1, 2""",
    "ahead": f"""SELECT cml_id, time, {', '.join(f"""CASE WHEN row_number() OVER ({ROWS}) + 2 > count(*) OVER (PARTITION BY cml_id)
        THEN last_value({x}) OVER ({ROWS} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) ELSE lead({x}, 2) OVER ({ROWS}) END AS {x}"""
        for x in 'ab')} FROM pairs""",
    "centred": f"""SELECT cml_id, time, {', '.join(f"{x} - CASE WHEN count({x}) OVER w >= 3 THEN quantile_cont({x}, 0.5) OVER w END AS {x}" for x in 'ab')}
        FROM ahead WINDOW w AS ({ROWS} ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""",
    "rated": f"""SELECT cml_id, time, CASE WHEN count(a) OVER w = 6 AND count(b) OVER w = 6 THEN 0.5 + 0.1*(sum(a) OVER w + sum(b) OVER w)/12 END AS q
        FROM centred WINDOW w AS ({ROWS} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
    "judged": f"""SELECT cml_id, time, n, CASE WHEN n BETWEEN 6 AND 7 THEN f WHEN n >= 8 THEN m END AS p FROM (
        SELECT cml_id, time, row_number() OVER ({ROWS}) AS n, lag(q, 2) OVER ({ROWS}) AS m,
            nth_value(q, 6) OVER ({ROWS} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS f FROM rated)""",
})
def _(spark, sf):
    """Wet flags from windows of six rows that slide over both path losses, by a linear scorer."""
    flags = classify.sliding_flags(
        channels(spark, sf).drop("wet"), lambda w: 0.5 + 0.1 * w.mean(axis=(1, 2)), threshold=0.51, window=6, shift=2, median_rows=8, median_min=3, trim=3)
    return flags.select("cml_id", "channel_id", stamp(), "wet")


@query("prediction_alignment", f"""SELECT cml_id, {ts()} AS time, {r('CASE WHEN n BETWEEN 12 AND 14 THEN f WHEN n >= 15 THEN m END')} AS x FROM (
      SELECT *, row_number() OVER ({ROWS}) AS n, lag(x, 3) OVER ({ROWS}) AS m,
        nth_value(x, 12) OVER ({ROWS} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS f FROM series)
    WHERE n > 10""")
def _(spark, sf):
    df = tr.align_predictions(series(spark, sf), KEY, "x", 12, 3)
    return _values(tr.trim_leading(df, KEY, 10), "x")


@query("fine_flags", f"""SELECT user_id AS cml_id, {ts("date_trunc('day', ts)")} AS time, max(CASE WHEN value > 30 THEN 1.0 ELSE 0.0 END) AS wet_max,
      CASE WHEN avg(CASE WHEN value > 30 THEN 1.0 ELSE 0.0 END) >= 0.5 THEN 1.0 ELSE 0.0 END AS wet_mean FROM events GROUP BY ALL""")
def _(spark, sf):
    flags = _fine_flags(spark, sf)
    most = wd.flags_to_steps(flags, demo.STEP_MINUTES, "max").withColumnRenamed("wet", "wet_max")
    mean = wd.flags_to_steps(flags, demo.STEP_MINUTES, "mean").withColumnRenamed("wet", "wet_mean")
    return most.join(mean, ["cml_id", "time"]).select("cml_id", stamp(), "wet_max", "wet_mean")


def _fine_flags(spark, sf):
    return demo.table(spark, sf, "events").select(
        F.col("user_id").alias("cml_id"), F.col("ts").cast("timestamp").alias("time"), (F.col("value") > 30).cast("int").alias("wet")
    )


@query("flags_attached", f"""SELECT c.cml_id, channel_id, {ts('c.time')} AS time, coalesce(w.wet, 0) > 0.5 AS wet FROM channels c LEFT JOIN (
      SELECT user_id AS cml_id, date_trunc('day', ts) AS time, max(CASE WHEN value > 30 THEN 1 ELSE 0 END) AS wet FROM events GROUP BY 1, 2) w
    ON w.cml_id = c.cml_id AND w.time = c.time""")
def _(spark, sf):
    steps = wd.flags_to_steps(_fine_flags(spark, sf), demo.STEP_MINUTES)
    return wd.attach_flags(channels(spark, sf), steps).select("cml_id", "channel_id", stamp(), "wet")


@query("training_sets")
def _(spark, sf):
    rows = tr.segment_arrays(tr.balance(flagged_rows(spark, sf), KEY, 20), KEY, 20, ["x", "y"], "ref_wd")
    train, held = tr.split(rows, 0.8, seed=5)
    parts = train.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("held")))
    return parts.groupBy("part", "ref_wd").agg(F.count(F.lit(1)).alias("n_segments"))


@query("classifier_scores")
def _(spark, sf):
    rows = tr.segment_arrays(pp.z_normalise(flagged_rows(spark, sf), KEY, ["x", "y"]), KEY, 20, ["x", "y"], "ref_wd")
    rows = stage(
        rows.select("cml_id", "segment_id", F.concat("x", "y").alias("features"), F.col("ref_wd").cast("double").alias("label")),
        "segments",
    )
    train, _held = tr.split(rows, 0.8, seed=5)
    model = tr.fit_classifier(train, hidden=(8,))
    scored = tr.score_with_model(rows, model)
    return scored.select("cml_id", "segment_id", "label", rr("probability").alias("probability"), (F.col("probability") >= 0.5).alias("wet"))


# --- spectra ---------------------------------------------------------------------------------

DRY_SQL = {
    "deviations": f"""SELECT cml_id, row_number() OVER ({ROWS}) - 1 AS pos, CASE WHEN count(x) OVER w = 30 THEN stddev_samp(x) OVER w END AS d
        FROM series WINDOW w AS ({ROWS} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"""}


@query("dry_period", """SELECT cml_id, dry_stop - 30 AS dry_start, dry_stop FROM (
      SELECT cml_id, min_by(pos, (floor(d*1e9 + 0.4997), pos)) AS dry_stop FROM deviations WHERE d IS NOT NULL GROUP BY 1)""", DRY_SQL)
def _(spark, sf):
    return sp.calmest_period(series(spark, sf), KEY, "x", 30)


# Windows of 16 rows, 7 of them before the row; frequencies i/16 for i = 0..8.
SPECTRUM_SQL = {
    **DRY_SQL,
    "placed": f"SELECT cml_id, time, x, row_number() OVER ({ROWS}) - 1 AS pos FROM series",
    "sizes": "SELECT cml_id, count(*) AS total FROM placed GROUP BY 1",
    "taper": "SELECT m, 0.54 - 0.46*cos(2*pi()*m/15) AS h FROM range(16) t(m)",
    "waves": """SELECT m, k, h*cos(2*pi()*k*m/16) AS re, h*sin(2*pi()*k*m/16) AS im FROM taper CROSS JOIN range(9) f(k)""",
    "windows": """SELECT p.cml_id, p.time, p.pos, q.x, q.pos - p.pos + 7 AS m FROM placed p JOIN sizes z ON z.cml_id = p.cml_id
        JOIN placed q ON q.cml_id = p.cml_id AND q.pos BETWEEN p.pos - 7 AND p.pos + 8 WHERE p.pos >= 7 AND p.pos + 8 < z.total""",
    "powers": """SELECT cml_id, time, pos, k, (pow(sum(x*re), 2) + pow(sum(x*im), 2))/(SELECT sum(h*h) FROM taper)
        * CASE WHEN k IN (0, 8) THEN 1 ELSE 2 END AS p FROM windows JOIN waves USING (m) GROUP BY 1, 2, 3, 4""",
    "dry": """SELECT cml_id, min_by(pos, (floor(d*1e9 + 0.4997), pos)) AS stop FROM deviations WHERE d IS NOT NULL GROUP BY 1""",
    "dry_means": """SELECT cml_id, k, avg(p) AS q FROM powers JOIN dry USING (cml_id) WHERE pos >= stop - 30 AND pos < stop GROUP BY 1, 2""",
    "bands": """SELECT cml_id, pos, avg(p/q) FILTER (WHERE k/16.0 <= 0.2) - avg(p/q) FILTER (WHERE k/16.0 > 0.2) AS p_diff
        FROM powers JOIN dry_means USING (cml_id, k) GROUP BY 1, 2""",
}


@query("spectral_plain", f"""SELECT p.cml_id, {ts('p.time')} AS time, p.pos, {r('b.p_diff')} AS p_diff, coalesce(b.p_diff > 0.5, FALSE) AS wet
    FROM placed p LEFT JOIN bands b ON b.cml_id = p.cml_id AND b.pos = p.pos""", SPECTRUM_SQL)
def _(spark, sf):
    df = series(spark, sf)
    spectrum = stage(sp.spectrogram(df, KEY, "x", 16, 1.0), "spectrum")
    out = sp.classify(spectrum, sp.calmest_period(df, KEY, "x", 30), KEY, sp.frequencies(16, 1.0), 0.2, 0.5)
    return out.select("cml_id", stamp(), "pos", rr("p_diff").alias("p_diff"), "wet")


@query("spectral_wetdry")
def _(spark, sf):
    df = series(spark, sf)
    spectrum = stage(sp.spectrogram(df, KEY, "x", 16, 1.0, mirror=True), "spectrum")
    dry = sp.calmest_period(df, KEY, "x", 30)
    out = sp.classify(spectrum, dry, KEY, sp.frequencies(16, 1.0), 0.2, 0.5)
    return out.select("cml_id", stamp(), "pos", rr("p_diff").alias("p_diff"), "wet")


# --- streaming -------------------------------------------------------------------------------


@query("stream_step_means", WIDE_SQL)
def _(spark, sf):
    """The events replayed as a stream of files, landed and averaged by the streaming job."""
    folder = f"{shared_folder(spark)}/replay/{uuid.uuid4().hex}"
    rows = demo.telemetry(spark, sf).select("time", "agent_host", "field", "value")
    rows.repartitionByRange(4, "time").write.parquet(f"{folder}/in")
    stream = live.read_stream(spark, f"{folder}/in", files_per_trigger=2)

    def job(landed_rows: DataFrame, _newest) -> None:
        means = telemetry.step_means(landed_rows, demo.STEP_SECONDS, demo.NAMES)
        means.withColumn("day", F.to_date("time")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("day").parquet(f"{folder}/out")

    live.recompute_loop(stream, f"{folder}/landed", f"{folder}/checkpoint", job).awaitTermination()
    return _wide_out(spark.read.parquet(f"{folder}/out"))


@query("stream_baseline", f"""SELECT cml_id, channel_id, {ts()} AS time, wet, {r('baseline')} AS baseline, {r('waa')} AS waa FROM walked""")
def _(spark, sf):
    """The cleaned path losses replayed in three files, with the state of each channel kept in between."""
    folder = f"{shared_folder(spark)}/replay/{uuid.uuid4().hex}"
    rows = stage(clean(spark, sf).select("cml_id", "channel_id", "time", "trsl"), "clean")
    days = F.floor((F.dayofmonth("time") - 1) / 11)
    schema = rows.schema
    for part in range(3):
        rows.where(days == part).coalesce(1).write.parquet(f"{folder}/in/part={part}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/part=*")
    walked = live.stream_baseline(stream, roll=ROLL, threshold=THRESHOLD, n=3, rise=0.5)
    walked.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    out = without_nan(spark.read.parquet(f"{folder}/out"))
    return out.select("cml_id", "channel_id", stamp(), "wet", rr("baseline").alias("baseline"), rr("waa").alias("waa"))


@query("stream_baseline_shuffled", f"""SELECT cml_id, channel_id, {ts()} AS time, wet, {r('baseline')} AS baseline, {r('waa')} AS waa FROM walked
    WHERE time <= (SELECT max(time) FROM walked) - INTERVAL 4 DAY""")
def _(spark, sf):
    """The cleaned path losses in files by their day of arrival, up to two days late, so that days of a channel come out of order."""
    folder = f"{shared_folder(spark)}/replay/{uuid.uuid4().hex}"
    rows = stage(clean(spark, sf).select("cml_id", "channel_id", "time", "trsl"), "clean")
    span = rows.agg(F.min("time").alias("a"), F.max("time").alias("b")).first()
    arrival = F.datediff("time", F.lit(span["a"])) + F.pmod(F.xxhash64("cml_id", "channel_id", "time"), F.lit(3))
    stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in/part=*")
    walked = ordered.stream_baseline_ordered(stream, roll=ROLL, threshold=THRESHOLD, n=3, rise=0.5, lateness="3 days")
    replay = walked.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
    for k in range(((span["b"] - span["a"]).days + 2) // 8 + 1):  # each run takes the files that have come since the one before
        rows.where(F.floor(arrival / 8) == k).write.parquet(f"{folder}/in/part={k}")
        replay.trigger(availableNow=True).start().awaitTermination()
    out = without_nan(spark.read.parquet(f"{folder}/out")).where(F.col("time") <= F.lit(span["b"]) - F.expr("INTERVAL 4 DAYS"))
    return out.select("cml_id", "channel_id", stamp(), "wet", rr("baseline").alias("baseline"), rr("waa").alias("waa"))


# --- published products ----------------------------------------------------------------------


def _root(spark) -> str:
    return f"{shared_folder(spark)}/published/{uuid.uuid4().hex}"


@query("published_frames", f"""SELECT strftime(time, '%Y-%m-%d_%H%M') AS utc, {GRID.ny - 1} - "row" AS img_row, col,
    round_even({r('v', 3)}, 3) AS v FROM frames""", _field_sql("r"))
def _(spark, sf):
    """Frames written by date and read back, rows counted from the top."""
    path = _root(spark)
    publish.write_frames(_frames(spark, sf).withColumn("v", rr("v", 3)), path)
    back = frame_store.read_frames(spark, path)
    return back.select("utc", gr.display_row(GRID, F.col("row")).alias("img_row"), "col", "v")


@query("expired_frames", f"""SELECT strftime(time, '%Y-%m-%d_%H%M') AS utc, count(*) AS n FROM frames
    WHERE CAST(time AS DATE) >= CAST((SELECT max(time) FROM hour_sum) - INTERVAL 14 DAY AS DATE) GROUP BY 1""", _field_sql("r"))
def _(spark, sf):
    """Frames written by date, and the dates before a retained window deleted."""
    path, series = _root(spark), stage(hour_sum(spark, sf), "hour_sum")
    publish.write_frames(_frames(spark, sf, series=series), path)
    newest = series.agg(F.max("time").alias("t")).first()["t"]
    publish.expire(spark, path, newest, "14d")
    return spark.read.parquet(path).groupBy("utc").agg(F.count(F.lit(1)).alias("n"))


@query("published_flags", f"""SELECT utc, overall, ids, count_true, count_total FROM ({_info_sql("r", None)})""", _field_sql("r"))
def _(spark, sf):
    """Frame summaries written as JSON and read back."""
    path = _root(spark)
    series = stage(hour_sum(spark, sf), "hour_sum")
    publish.write_info(pr.frame_info(_frames(spark, sf, series=series), series), path)
    schema = "time timestamp, utc string, overall double, cml_rain_true array<bigint>, count_true bigint, count_total bigint"
    return _info_out(spark.read.schema(schema).json(path)).drop("time")


@query("warm_up_trimmed", f"""SELECT cml_id, {ts()} AS time, {r('r_hour_sum', 2)} AS r_hour_sum FROM hour_sum
    WHERE time >= TIMESTAMP '2024-01-11 00:00:00'""")
def _(spark, sf):
    from datetime import datetime, timezone

    kept = pr.trim_warm_up(hour_sum(spark, sf), datetime(2024, 1, 11, tzinfo=timezone.utc))
    return kept.select("cml_id", stamp(), rr("r_hour_sum", 2).alias("r_hour_sum"))
