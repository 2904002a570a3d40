"""Filling, baseline, rolling blocks and spectra against numpy and pandas."""

from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pluvio.operators import baseline as bl
from pluvio.operators import recursion
from pluvio.operators import preprocess as pp
from pluvio.operators import resample as rs
from pluvio.operators import rolling as ro
from pluvio.operators import series as se
from pluvio.operators import sliding
from pluvio.operators import spectral as sp
from pluvio.operators.grouped import whole_groups
from pluvio.operators.quality import fill_gaps

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def channel(spark, trsl, wet=None, cml=1):
    rows = [
        (cml, "c", T0 + timedelta(minutes=10 * i), None if x is None else float(x), None if wet is None or wet[i] is None else bool(wet[i]))
        for i, x in enumerate(trsl)
    ]
    return spark.createDataFrame(rows, "cml_id bigint, channel_id string, time timestamp, trsl double, wet boolean")


def column(df, name):
    return [r[name] for r in df.orderBy("cml_id", "time").collect()]


def test_nearest_and_linear_fill(spark):
    df = channel(spark, [None, 1, None, None, None, 5, None]).withColumn("line", F.col("trsl"))
    out = fill_gaps(df, ["cml_id", "channel_id"], nearest=["trsl"], linear=["line"])
    assert column(out, "trsl") == [None, 1, 1, 1, 5, 5, None]
    assert column(out, "line") == [None, 1, 2, 3, 4, 5, None]


def test_fill_by_position(spark):
    df = channel(spark, [None, 0, None, None, None, 4, None, None, None])
    out = pp.fill_by_position(df, ["cml_id"], ["trsl"], 2)
    assert column(out, "trsl") == [None, 0, 1, 2, None, 4, 4, 4, None]


def test_baseline_literal(spark):
    df = channel(spark, [1, 2, 3, 9, 9, 4, 9, 5], [0, 0, 0, 1, 1, 0, 1, 0])
    out = bl.baseline_and_waa(df, n=3)
    assert column(out, "baseline") == pytest.approx([1, 2, 3, 2, 2, 4, 8 / 3, 5])


def test_schleiss_literal(spark):
    df = channel(spark, [1, 6, 6, 6], [0, 1, 1, 1])
    out = bl.baseline_and_waa(df, n=1, tau=60.0, step_minutes=10.0)
    assert column(out, "waa") == pytest.approx([0, 1.1, 1.65, 1.925])


def twin(trsl, wet, n, top, rise):
    """The definition, row by row."""
    base, waa = [], []
    for i, (x, w) in enumerate(zip(trsl, wet)):
        if i < n:
            b = x
        elif w is None:
            b = np.nan
        elif w and wet[i - 1] != 1:
            b = np.mean(base[i - n : i])
        elif w:
            b = base[i - 1]
        else:
            b = x
        base.append(b)
        a = np.minimum(x - b, top)
        if w and i > 0:
            a = np.minimum(a, waa[i - 1] + (top - waa[i - 1]) * rise)
        waa.append(a)
    return base, waa


@pytest.mark.parametrize("seed", range(4))
def test_baseline_pieces_equal_whole(spark, seed):
    rng = np.random.default_rng(seed)
    trsl = list(rng.uniform(40, 60, 200))
    wet = [int(v) for v in rng.uniform(size=200) < (0.2, 0.5, 0.8, 0.3)[seed]]
    if seed == 3:
        wet[50] = wet[120] = None
        wet[0] = 1
    df = channel(spark, trsl, wet)
    cut = bl.with_episodes(df, 3, block=16)
    if seed == 0:
        assert cut.agg(F.max("episode")).first()[0] > 3
    expect_b, expect_w = twin(trsl, wet, 3, 2.2, 0.4)

    def piece(pdf):
        pdf = pdf.sort_values("pos")
        wet = pdf["wet"].astype("float64").to_numpy()
        b, w = bl.walk(pdf["trsl"].to_numpy(), wet, pdf["since"].to_numpy(), 3, 2.2, 0.4)
        return pd.DataFrame({"pos": pdf["pos"], "b": b, "w": w})

    out = cut.groupBy("episode").applyInPandas(piece, "pos bigint, b double, w double").toPandas().sort_values("pos")
    np.testing.assert_allclose(out["b"], expect_b)
    np.testing.assert_allclose(out["w"], expect_w)


@pytest.mark.parametrize("rise", [0.4, 1.0, 2.0])
@pytest.mark.parametrize("seed", range(3))
def test_block_summaries_equal_the_walk(seed, rise):
    """A block's summary, put on any state, gives what walking its rows gives, at every block size."""
    rng = np.random.default_rng(seed)
    size, n = 120, 3
    trsl = rng.uniform(40, 60, size)
    wet = (rng.uniform(size=size) < (0.3, 0.9, 1.0)[seed]).astype(float)
    if seed < 2:
        wet[rng.integers(0, size, 6)] = np.nan
        trsl[rng.integers(0, size, 4)] = np.nan
    want_b, want_w = bl.walk(trsl, wet, np.arange(size), n, 2.2, rise)
    for block in (3, 4, 7, 50, 200):
        state, waa = np.full(n, np.nan), np.nan
        for a in range(0, size, block):
            part, pos = slice(a, a + block), np.arange(size)[a:a + block]
            base = want_b[part]
            waa = recursion.clamp(waa, recursion.climb(trsl[part], base, wet[part], pos, 2.2, rise))
            state = recursion.averaged(*recursion.averages(trsl[part], wet[part], wet[a - 1] if a else np.nan, pos, n), state)
            seen = want_b[:a + block][-n:]
            np.testing.assert_allclose(state[-len(seen):], seen, rtol=1e-12)
            np.testing.assert_allclose(waa, want_w[:a + block][-1], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("block", [5, 64])
def test_baseline_in_blocks_equals_the_definition(spark, block):
    rng = np.random.default_rng(9)
    trsl = list(rng.uniform(40, 60, 300))
    wet = [1] * 300 if block == 5 else [int(v) for v in rng.uniform(size=300) < 0.6]
    wet[0] = 0
    df = channel(spark, trsl, wet)
    out = bl.baseline_and_waa(df, n=3, tau=75.0, step_minutes=10.0, block_rows=block)
    expect_b, expect_w = twin(trsl, wet, 3, 2.2, 0.4)
    assert column(out, "baseline") == pytest.approx(expect_b) and column(out, "waa") == pytest.approx(expect_w)
    assert out.columns == bl.baseline_and_waa(df, n=3).columns


def test_a_wet_channel_is_spread_over_tasks(spark):
    """20,000 rows that never dry, in blocks of 500: no task walks more than a few blocks."""
    t = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 600)
    df = spark.range(20_000).select(F.lit(1).alias("cml_id"), F.lit("A").alias("channel_id"), t.alias("time"), (50 + F.col("id") % 7).cast("double").alias("trsl"),
                                    (F.col("id") > 10).alias("wet"))
    out = bl.baseline_and_waa(df, n=5, tau=75.0, step_minutes=10.0, block_rows=500).withColumn("task", F.spark_partition_id())
    most = out.groupBy("task").count().agg(F.max("count")).first()[0]
    assert most < 20_000 and out.agg(F.sum("baseline")).first()[0] == pytest.approx(
        bl.baseline_and_waa(df, n=5, tau=75.0, step_minutes=10.0).agg(F.sum("baseline")).first()[0])


def test_a_chunk_of_blocks_is_walked_at_once(spark, monkeypatch):
    """200 channels of one block each: one walk over all of them, not a frame and a walk for each."""
    rng, walk, walks, steps = np.random.default_rng(4), bl.walk, [], []
    monkeypatch.setattr(bl, "walk", lambda *given: walks.append(1) or walk(*given))
    monkeypatch.setattr(recursion, "stage", lambda df, _name: df)
    monkeypatch.setattr(recursion, "map_groups", lambda _df, _keys, _order, fn, schema: steps.append(fn) or spark.createDataFrame([], schema))
    recursion.baseline_in_blocks(channel(spark, [50.0], [0]), 3, 2.2, 0.4, 8)
    trsl, wet = rng.uniform(40, 60, (200, 8)), rng.uniform(size=(200, 8)) < 0.6
    wet[:, 0] = False
    pdf = pd.DataFrame({"cml_id": np.repeat(np.arange(200), 8), "channel_id": "A", "time": pd.Timestamp(0), "block_id": 0, "pos": np.tile(np.arange(8), 200),
                        "core": True, "trsl": trsl.ravel(), "wet": wet.ravel(), "waa_before": np.nan})
    pdf["state"] = [np.full(3, np.nan)] * len(pdf)
    out = steps[-1](pdf, np.arange(0, 1600, 8))
    assert len(walks) == 1 and len(out) == 1600
    for k in range(200):
        base, waa = twin(trsl[k].tolist(), wet[k].astype(int).tolist(), 3, 2.2, 0.4)
        assert out["baseline"][8 * k:8 * k + 8].tolist() == pytest.approx(base) and out["waa"][8 * k:8 * k + 8].tolist() == pytest.approx(waa)


@pytest.mark.parametrize("window", [2, 3, 10, 64, 65, 200])
def test_deviation_forgets_what_has_left_the_window(window):
    rng = np.random.default_rng(window)
    x = rng.normal(0, 1e-3, 900) + 50
    x[[100, 400]] = 1e8, -1e12
    x[200:230] = np.nan
    x[500:520] = 7.25
    got = sliding.deviation(x, window, min(window, 5))
    for i in range(len(x)):
        part = x[max(0, i + 1 - window):i + 1]
        part = part[~np.isnan(part)]
        if len(part) < max(2, min(window, 5)):
            assert np.isnan(got[i])
        elif np.ptp(part) == 0:
            assert got[i] == 0.0
        else:
            assert got[i] == pytest.approx(np.std(part, ddof=1), rel=1e-9)


@pytest.mark.parametrize("stat", ["std", "median"])
def test_rolling_is_the_same_by_frames_and_by_blocks(spark, monkeypatch, stat):
    rng = np.random.default_rng(1)
    x = [None if rng.uniform() < 0.05 else float(v) for v in 50 + rng.normal(0, 1e-3, 400)]
    x[60], x[200], x[201] = 1e8, float("nan"), float("inf")
    df = channel(spark, x)
    got = []
    for limit in (64, 0):
        monkeypatch.setattr(ro, "FRAME_LIMIT", limit)
        got.append(column(ro.rolling(df, ["cml_id", "channel_id"], {"y": "trsl"}, 40, stat, min_rows=30, centered=True), "y"))
    assert [v is None for v in got[0]] == [v is None for v in got[1]]
    assert [v for v in got[0] if v is not None] == pytest.approx([v for v in got[1] if v is not None], rel=1e-9)


def prominent_by_definition(x, least):
    found = []
    k = 1
    while k < len(x) - 1:
        end = k
        while end + 1 < len(x) and x[end + 1] == x[k]:
            end += 1
        if x[k - 1] < x[k] and end + 1 < len(x) and x[end + 1] < x[k]:
            mid = (k + end) // 2
            sides = []
            for step in (-1, 1):
                at, low = mid, x[mid]
                while 0 <= at < len(x) and x[at] <= x[mid]:
                    low, at = min(low, x[at]), at + step
                sides.append(low)
            if x[mid] - max(sides) >= least:
                found.append(mid)
        k = end + 1
    return found


@pytest.mark.parametrize("seed", range(6))
def test_prominent_peaks_equal_the_definition(seed):
    rng = np.random.default_rng(seed)
    for size in (1, 2, 3, 10, 200):
        x = rng.integers(0, (3, 6, 50)[seed % 3], size).astype(float)
        for least in (0, 1, 2, 10):
            assert pp.prominent(x, least).tolist() == prominent_by_definition(x, least)


@pytest.mark.parametrize("block", [4, 16, 4096])
def test_scores_by_blocks_equal_windows(spark, block):
    from pluvio.operators import training as tr

    rng = np.random.default_rng(2)
    x = [None if rng.uniform() < 0.03 else float(v) for v in rng.normal(size=120)]
    df = channel(spark, x).withColumn("y", F.col("trsl") * 2 + F.minute("time"))
    got = tr.score_blocks(df, ["cml_id"], ["trsl", "y"], 5, 2, lambda w: w[:, 0].mean(axis=1) + w[:, 1, 0], block=block)
    windows = tr.feature_windows(df, ["cml_id"], ["trsl", "y"], 5, 2)
    want = [None if r.features is None else np.mean(r.features[:8]) + r.features[8] for r in windows.orderBy("time").collect()]
    found = column(got, "probability")
    assert [v is None for v in found] == [v is None for v in want] and sum(v is not None for v in want) > 40
    assert [v for v in found if v is not None] == pytest.approx([v for v in want if v is not None])


def test_whole_groups_across_batches():
    """Groups that end inside a batch, at its edge, or go on over several batches."""
    rng = np.random.default_rng(1)
    key = np.repeat(np.arange(40), rng.integers(1, 30, 40))
    pdf = pd.DataFrame({"k": key, "x": np.arange(len(key))})
    for size in (1, 7, 50, 1000):
        batches = (pdf.iloc[i : i + size] for i in range(0, len(pdf), size))
        seen = []
        for rows in whole_groups(batches, ["k"], lambda r, starts: r.assign(n=len(starts))):
            assert rows["n"].iloc[0] == rows["k"].nunique()
            seen.append(rows)
        out = pd.concat(seen)
        assert list(out["x"]) == list(pdf["x"])
        assert sum(r["k"].nunique() for r in seen) == 40


def long_series(spark, n=700):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({
        "cml_id": 1, "time": [T0 + timedelta(hours=i) for i in range(n)], "x": rng.normal(size=n),
    })
    pdf.loc[pdf.index % 53 == 5, "x"] = np.nan
    df = spark.createDataFrame(pdf, "cml_id bigint, time timestamp, x double")
    return pdf, df.withColumn("x", F.when(~F.isnan("x"), F.col("x")))


def test_positions_and_blocks(spark):
    _pdf, df = long_series(spark)
    placed = se.with_positions(df, ["cml_id"], ["time"], F.date_trunc("week", "time"))
    assert [r["pos"] for r in placed.orderBy("time").collect()] == list(range(700))
    blocks = se.with_blocks(placed, 100, 30, 10)
    assert blocks.where("core").count() == 700
    one = [r["pos"] for r in blocks.where("block_id = 2").orderBy("pos").collect()]
    assert one == list(range(170, 310))


@pytest.mark.parametrize("stat,centered", [("median", True), ("std", False), ("median", False)])
def test_rolling_blocks_equal_pandas(spark, monkeypatch, stat, centered):
    monkeypatch.setattr(ro, "max", lambda *a: 128, raising=False)  # small blocks
    pdf, df = long_series(spark)
    out = ro.rolling(df, ["cml_id"], {"m": "x"}, 80, stat, centered=centered, min_rows=70).toPandas().sort_values("time")
    r = pdf["x"].rolling(80, min_periods=70, center=centered)
    want = r.median() if stat == "median" else r.std()
    np.testing.assert_allclose(out["m"].astype(float), want, atol=1e-9)


@pytest.mark.parametrize("mirror", [False, True])
def test_spectrogram(spark, mirror):
    pdf, df = long_series(spark, 200)
    x, size = pdf["x"].to_numpy(), 16
    got = sp.spectrogram(df, ["cml_id"], "x", size, 1.0, mirror).toPandas().sort_values("pos")
    taper = np.hamming(size)
    for pos, power in zip(got["pos"], got["power"]):
        start = pos - (size - 1) // 2
        if start >= 0 and start + size <= len(x) and not np.isnan(x[start : start + size]).any():
            raw = np.abs(np.fft.rfft(x[start : start + size] * taper)) ** 2 / (taper**2).sum()
            raw[1:-1] *= 2
            np.testing.assert_allclose(power, raw)
        elif mirror and pos >= len(x) - size // 2 and not np.isnan(x[pos - 7 : pos]).any():
            head = x[pos - 7 : pos]
            raw = np.abs(np.fft.rfft(np.concatenate([head, head[::-1], [0, 0]]) * taper)) ** 2 / (taper**2).sum()
            raw[1:-1] *= 2
            np.testing.assert_allclose(power, raw)
        else:
            assert power is None


def test_spectral_classes(spark):
    pdf, df = long_series(spark, 200)
    df = df.withColumn("x", F.coalesce("x", F.lit(0.0)))
    spectrum = sp.spectrogram(df, ["cml_id"], "x", 16, 1.0)
    dry = spark.createDataFrame([(1, 20, 60)], "cml_id bigint, dry_start bigint, dry_stop bigint")
    freqs = sp.frequencies(16, 1.0)
    got = sp.classify(spectrum, dry, ["cml_id"], freqs, 0.2, 0.1).toPandas().sort_values("pos")
    full = np.array([p if p is not None else [np.nan] * 9 for p in got["power"]], dtype=float)
    norm = full / np.nanmean(full[20:60], axis=0)
    low = np.array(freqs) <= 0.2
    diff = norm[:, low].mean(axis=1) - norm[:, ~low].mean(axis=1)
    np.testing.assert_allclose(got["p_diff"].astype(float), diff)
    assert list(got["wet"]) == [bool(d > 0.1) for d in diff]


@pytest.mark.parametrize("limit", [sp.BROADCAST_SERIES, 0])
def test_spectra_are_shuffled_only_for_many_series(spark, monkeypatch, limit):
    monkeypatch.setattr(sp, "BROADCAST_SERIES", limit)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(k, T0 + timedelta(minutes=i), i, None if i < 2 else [float((k or 0) + i), 2.0 + i % 3]) for k in (1, 2, None) for i in range(9)]
        spectrum = spark.createDataFrame(rows, "cml_id bigint, time timestamp, pos bigint, power array<double>")
        dry = spark.createDataFrame([(1, 1, 4), (2, 0, 2)], "cml_id bigint, dry_start bigint, dry_stop bigint")
        out = sp.classify(spectrum, dry, ["cml_id"], [0.0, 0.5], 0.2, 0.1)
        assert ("Exchange hashpartitioning" in out._jdf.queryExecution().executedPlan().toString()) == (limit == 0)
        got = {(r.cml_id, r.pos): r.p_diff for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len(got) == 27
    # Rows 2 and 3 are the known ones of the first dry period; no row of the second is known.
    assert all(p == (pytest.approx((1 + i) / 3.5 - (2 + i % 3) / 3.0) if k == 1 and i >= 2 else None) for (k, i), p in got.items())


def test_hour_sum_constant(spark):
    rows = [(1, T0 + timedelta(minutes=10 * i), 6.0) for i in range(8)]
    lr = spark.createDataFrame(rows, "cml_id bigint, time timestamp, r double")
    out = rs.hour_sums(rs.align(lr, rs.time_axis(lr)), 10)
    assert column(out, "r_hour_sum") == [None] * 5 + [pytest.approx(6.0)] * 3


def test_align_fills_gaps(spark):
    rows = [(1, T0 + timedelta(hours=h), float(h)) for h in range(5)] + [(2, T0 + timedelta(hours=h), 1.0) for h in (1, 3)]
    lr = spark.createDataFrame(rows, "cml_id bigint, time timestamp, r double")
    out = rs.align(lr, rs.time_axis(lr)).where("cml_id = 2")
    assert column(out, "r") == [None, 1.0, None, 1.0, None]
    finer = rs.time_axis(lr.where("cml_id = 2"), 60)
    assert finer.count() == 3


def test_output_step_anchor(spark):
    """A step that does not divide the day starts at midnight of the first day."""
    rows = [(1, "c", T0 + timedelta(hours=h), float(h)) for h in range(48)]
    df = spark.createDataFrame(rows, "cml_id bigint, channel_id string, time timestamp, r double")
    out = rs.output_steps(df, 60, 420)
    assert out.agg(F.min("time")).first()[0].hour == 7
    with pytest.raises(ValueError):
        rs.output_steps(df, 60, 30)


def test_rolling_is_the_same_at_every_length(spark):
    """Windows evaluated by Spark and those cut into blocks agree with each other and with a plain count."""
    from pluvio.operators.rolling import FRAME_LIMIT, rolling

    rng = np.random.default_rng(4)
    data = {
        "constant": np.full(400, 7.1), "tied": rng.integers(0, 3, 400).astype(float), "offset": 1e6 + rng.normal(size=400),
        "holes": np.where(rng.random(400) < 0.2, np.nan, rng.normal(size=400)), "infinite": rng.normal(size=400),
    }
    data["infinite"][[200, 300]] = [np.inf, -np.inf]
    rows = [(k, datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(hours=i), float(x)) for k, v in data.items() for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "k string, time timestamp, x double")
    for window in (FRAME_LIMIT, FRAME_LIMIT + 1):
        for stat in ("median", "std"):
            out = rolling(df, ["k"], {"y": "x"}, window, stat, min_rows=5).orderBy("k", "time").toPandas()
            assert list(out.columns) == ["k", "time", "x", "y"]
            for k, v in data.items():
                got = out.loc[out.k == k, "y"].to_numpy()
                clean = np.where(np.isfinite(v), v, np.nan)
                for i in range(400):
                    part = clean[max(0, i - window + 1):i + 1]
                    part = part[~np.isnan(part)]
                    want = np.nan if len(part) < 5 else np.median(part) if stat == "median" else part.std(ddof=1)
                    assert got[i] == pytest.approx(want, rel=1e-9, abs=1e-9, nan_ok=True), (window, stat, k, i)


def test_constant_temperature_has_no_correlation(spark):
    """A channel whose temperature or path loss never varies has neither correlation nor an error."""
    from pluvio.operators import temperature as tc

    rows = [(1, "a", float(v), 0.0) for v in (50, 52, 54)] + [(1, "b", 50.0, float(v)) for v in (3, 4, 5)]
    rows += [(2, c, 50.0 + v, 30.0 + s * v) for c, s in (("a", 1), ("b", -2)) for v in (0, 1, 2)]
    df = spark.createDataFrame(rows, "cml_id long, channel_id string, trsl double, temperature_tx double")
    got = {(r["cml_id"], r["channel_id"]): (r["correlation"], r["slope"]) for r in tc.correlations(df).collect()}
    assert got[1, "a"] == got[1, "b"] == (None, None)
    assert got[2, "a"] == pytest.approx((1, 1)) and got[2, "b"] == pytest.approx((-1, -0.5))
    assert [r["cml_id"] for r in tc.flagged_links(df, 0.3).collect()] == [2]
    assert {r["cml_id"] for r in tc.drop_flagged(df, 0.3).collect()} == {1}
    fixed = {(r["cml_id"], r["channel_id"], r["temperature_tx"]): r["trsl"] for r in tc.compensate(df, 0.3).collect()}
    assert fixed[2, "a", 32.0] == pytest.approx(41) and fixed[1, "b", 5.0] == 50


def test_reference_flags_deal_series_to_all_partitions(spark):
    """Partitions are not put together by their size, whatever the optimizer thinks of it, and a run is sorted once to be counted and numbered."""
    from pluvio.operators import training as tr

    df = spark.range(4000).selectExpr("id % 40 AS cml_id", "timestamp_seconds(id * 600) AS time", "CAST(id % 7 = 0 AS double) AS rain")
    out = tr.balance(tr.reference_flags(df, ["cml_id"], 60.0), ["cml_id"], 4)
    used = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(used) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert any("island_rows" in line and "row_number" in line for line in plan.splitlines() if "Window [" in line), plan


def test_positions_bring_the_size_of_the_series(spark):
    df = spark.range(10).selectExpr("id % 3 AS cml_id", "timestamp_seconds(id * 2000000) AS time")
    out = se.with_positions(df, ["cml_id"], ["time"], F.date_trunc("month", "time"), total="rows_").collect()
    assert {(r["cml_id"], r["rows_"]) for r in out} == {(0, 4), (1, 3), (2, 3)} and len(out) == 10
