"""Closed forms: power law, distances, projection, wet-antenna curves, colours, scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.config import Score, Settings, WetAntenna
from pluvio.functions import colours
from pluvio.functions.geo import haversine_km, lat_of, lon_of, mercator_x, mercator_y
from pluvio.functions.rainrate import RATE_GRID, kr_alpha, kr_k, leijnse_curve, pastorek_curve, rain_rate
from pluvio.operators import products, rain


def test_power_law(spark):
    df = spark.createDataFrame([(10.0, "H"), (10.0, "V"), (30.0, "H"), (30.0, "V")], "f double, p string")
    got = [v for r in df.select(kr_k("f", "p"), kr_alpha("f", "p")).collect() for v in r]
    assert got == pytest.approx([0.01217, 1.2571, 0.01129, 1.2156, 0.2403, 0.9485, 0.2291, 0.9129], rel=3e-4)


def test_rain_rate_limits(spark):
    df = spark.createDataFrame([(0.0,), (1e-6,), (None,)], "a double")
    got = [r[0] for r in df.select(rain_rate(F.col("a"), F.lit(0.01), F.lit(1.2), F.lit(3.0))).collect()]
    assert got == [0.0, 0.0, None]


def test_distance_and_projection(spark):
    df = spark.createDataFrame([(50.0, 14.0, 50.0, 15.0)], "la double, oa double, lb double, ob double")
    x, y = mercator_x(F.col("oa")), mercator_y(F.col("la"))
    row = df.select(
        haversine_km(F.col("la"), F.col("oa"), F.col("lb"), F.col("ob")).alias("d"),
        lon_of(x).alias("lon"), lat_of(y).alias("lat"),
    ).first()
    c = math.cos(math.radians(50)) ** 2 * math.sin(math.radians(0.5)) ** 2
    assert row["d"] == pytest.approx(6373 * 2 * math.asin(math.sqrt(c)))
    assert (row["lon"], row["lat"]) == (pytest.approx(14.0), pytest.approx(50.0))


@pytest.mark.parametrize("method", ["pastorek", "leijnse"])
def test_wet_antenna_inverts(spark, method):
    """The wet-antenna part solves A_obs = k R^alpha L + waa(R)."""
    k, alpha, length, f = 0.05, 1.1, 4.0, 23.0
    rates = [0.0, 0.3, 1.0, 7.0, 40.0, 180.0]
    curve = pastorek_curve(2.2, 0.55, 0.1) if method == "pastorek" else leijnse_curve(f)
    waa = [float(w) for w in np.interp(rates, RATE_GRID, curve)]
    rows = [(k * r**alpha * length + w, k, alpha, length, f, w) for r, w in zip(rates, waa)]
    df = spark.createDataFrame(rows, "a_rain double, k double, alpha double, length double, frequency double, want double")
    for row in rain.wet_antenna(df, WetAntenna(method=method)).collect():
        assert row["waa"] == pytest.approx(row["want"], abs=2e-3)


def test_leijnse_curve_grows():
    curve = leijnse_curve(38.0)
    assert curve[0] == 0.0 and all(b >= a for a, b in zip(curve, curve[1:])) and 0.5 < curve[-1] < 20


def test_colours(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.2,), (200.0,), (None,)], "v double")
    assert [r[0] for r in df.select(colours.intensity_class(F.col("v"))).collect()] == [None, 1, 2, 13, None]
    assert df.select(colours.intensity_rgba(F.col("v"))).collect()[4][0] == [0, 0, 0, 0]
    sums = colours.with_hour_sum_rgba(spark.createDataFrame([(0.2,), (0.3,), (1.5,), (500.0,)], "v double"), "v")
    got = [r["rgba"] for r in sums.collect()]
    assert got[0] == [0, 0, 0, 0] and got[1] == [0x2E, 0x02, 0xA5, 255] and got[3] == [0xFD, 0xFB, 0xFD, 255]
    assert got[2] == [0, 134, 94, 255]  # half way between 006dbd and 00a000, halves to even


def test_scores(spark):
    frames = spark.createDataFrame([("t", v) for v in (0.0, 0.0, 1.0, 3.0, None)], "time string, v double")

    def score(**kw):
        return products.frame_scores(frames, Score(**kw)).first()["overall"]

    assert score(method="coverage") == 0.5
    assert score(method="p90") == pytest.approx(math.log1p(2.4) / math.log1p(20))
    assert score(method="mean") == pytest.approx(math.log1p(1.0) / math.log1p(20))
    strength = math.log1p(2.0) / math.log1p(20)
    assert score(method="coverage_strength") == pytest.approx(0.5**0.3 * strength)
    hourly = products.frame_scores(frames, Score(method="mean"), 30.0).first()["overall"]
    assert hourly == pytest.approx(math.log1p(2.0) / math.log1p(20))


def test_warmup_rows():
    from dataclasses import replace

    cfg = Settings()
    assert cfg.warmup_rows() == 10
    assert replace(cfg, wet_dry=replace(cfg.wet_dry, classifier=True)).warmup_rows() == 327
    assert replace(cfg, warm_up=False).warmup_rows() == 0
