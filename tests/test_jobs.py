"""Whole jobs, publishing and streaming."""

import os
import shutil
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pluvio.config import HourSum, Interp, Limits, Output, Settings, TimeAxis, WetAntenna, WetDry
from pluvio.operators import baseline as bl
from pluvio.operators import wetdry as wd
from pluvio.plans import publish, run
from pluvio.plans.rain import load_channels, rain_rates
from pluvio.streaming import live

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
HOURS = 48
CFG = Settings(
    time=TimeAxis(start=T0 + timedelta(hours=6), end=T0 + timedelta(hours=HOURS)),
    limits=Limits(14.0, 14.6, 49.9, 50.3),
    interp=Interp(nx=12, ny=10, near=4, tile=4),
    hour_sum=HourSum(enabled=True, write_series=True),
    output=Output(intensities=True),
    wet_dry=WetDry(rolling_values=6, baseline_samples=3),
)


def telemetry_pdf():
    rng = np.random.default_rng(5)
    rows = []
    for link in range(6):
        rain = 8 * (rng.uniform(size=HOURS * 12).cumsum() % 40 < 6)
        for end in "ab":
            for i in range(HOURS * 12):
                t = T0 + timedelta(minutes=5 * i)
                host = f"{link}{end}"
                rows.append((t, host, "PrijimanaUroven", -50.0 - rain[i] + 0.3 * rng.normal()))
                rows.append((t, host, "VysilaciVykon", 10.0))
    return pd.DataFrame(rows, columns=["time", "agent_host", "field", "value"])


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(telemetry_pdf(), "time timestamp, agent_host string, field string, value double").cache()


@pytest.fixture(scope="module")
def links(spark):
    data = [
        (i, f"{i}a", f"{i}b", 23000, 24000, "V" if i % 2 else "H", "ceragon", 3.0, 50.0 + 0.03 * i, 14.1 + 0.05 * i, 50.02 + 0.03 * i, 14.12 + 0.05 * i)
        for i in range(6)
    ]
    return spark.createDataFrame(
        data, "cml_id bigint, ip_a string, ip_b string, freq_a int, freq_b int, polarization string, tech string, length double, "
        "lat_a double, lon_a double, lat_b double, lon_b double",
    )


@pytest.fixture(scope="module")
def made(spark, rows, links):
    return run.run_historic(rows, links, CFG)


def test_historic_products(made):
    assert made.links.agg(F.min("time")).first()[0] == datetime(2024, 1, 1, 6)
    # 10-minute steps labelled by their end, from 06:00 to the end of the range.
    steps = (HOURS - 6) * 6 + 1
    assert made.info.count() == steps and made.links.count() == 6 * steps
    assert made.frames.select("time").distinct().count() == steps
    assert made.links.agg(F.min("r")).first()[0] >= 0 and made.links.agg(F.max("r")).first()[0] > 1
    first = made.links.orderBy("time").first()
    assert first["r_hour_sum"] is not None  # the warm-up fills the first window


def test_slices_equal_whole(rows, links):
    """Rolling flags and sums over two slices with warm-up equal one run."""
    cfg = replace(CFG, wet_dry=replace(CFG.wet_dry, baseline_samples=1), waa=WetAntenna(method="none"))
    whole = load_channels(rows, links, cfg)
    middle = T0 + timedelta(hours=24)
    parts = [replace(cfg, time=replace(cfg.time, start=a, end=b)) for a, b in ((cfg.time.start, middle), (middle, cfg.time.end))]

    def wet(ch, start, end):
        out = rain_rates(ch, cfg).where((F.col("time") > F.lit(start)) & (F.col("time") <= F.lit(end)))
        return {(r["cml_id"], r["channel_id"], r["time"]): r["wet"] for r in out.collect()}

    one = wet(whole, cfg.time.start, cfg.time.end)
    two = {}
    for p in parts:
        two |= wet(load_channels(rows, links, p), p.time.start, p.time.end)
    assert one == two and any(one.values())


def test_crowded_host_is_split(spark, rows, links):
    """A host that ends very many links gives the same rows whether or not it is split."""
    from pluvio.operators.channels import join_crowded, link_ends
    from pluvio.sources.telemetry import few, of_hosts, step_means

    wide = step_means(rows, 600)
    ends = link_ends(links.withColumn("ip_b", F.lit("0b")))
    cols = ["agent_host", "time", "cml_id", "side", "rx_power"]
    split, plain = join_crowded(wide, ends, crowd=2).select(*cols), wide.join(ends, "agent_host").select(*cols)
    assert split.count() == plain.count() and split.exceptAll(plain).count() == 0
    hosts = links.select(F.col("ip_a").alias("agent_host"))
    assert few(hosts, 6) and not few(hosts, 5)
    assert of_hosts(rows, hosts, 6).count() == of_hosts(rows, hosts, 5).count() == rows.count() / 2


def test_row_order_and_partitions_do_not_matter(rows, links):
    a = rain_rates(load_channels(rows, links, CFG), CFG).select("cml_id", "channel_id", "time", F.round("r", 9))
    shuffled = rows.orderBy(F.rand(1)).repartition(7)
    b = rain_rates(load_channels(shuffled, links, CFG), CFG).select("cml_id", "channel_id", "time", F.round("r", 9))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("method", ["schleiss", "leijnse", "none"])
def test_other_methods(rows, links, method):
    cfg = replace(CFG, waa=WetAntenna(method=method))
    out = rain_rates(load_channels(rows, links, cfg), cfg, links)
    row = out.agg(F.max("r").alias("r"), F.count_if(F.isnan("r") | F.col("r").isNull()).alias("bad")).first()
    assert row["r"] > 0 and row["bad"] == 0


def test_temperature_options(rows, links):
    warm = rows.unionByName(rows.where("field = 'VysilaciVykon'").withColumns({
        "field": F.lit("Teplota"), "value": 15 + F.hour("time").cast("double") / 2}))
    for kw in ({"filtered": True}, {"compensated": True}):
        cfg = replace(CFG, temperature=replace(CFG.temperature, threshold=0.01, **kw))
        n = rain_rates(load_channels(warm, links, cfg), cfg).select("cml_id").distinct().count()
        assert n == (0 if "filtered" in kw else 6)


def test_publish_skip_and_expire(spark, made, tmp_path):
    root = str(tmp_path / "out")
    publish.publish(made, root, CFG)
    frames = spark.read.parquet(f"{root}/frames")
    assert frames.count() == made.frames.count()
    assert {"frames", "frames_sum", "info", "info_sum", "series"} <= set(os.listdir(root))
    assert spark.read.parquet(f"{root}/series").where("field = 'rain_hour_sum'").count() == made.links.count()
    stored = {r["utc"]: r["overall"] for r in spark.read.json(f"{root}/info").collect()}
    assert stored == {r["utc"]: r["overall"] for r in made.info.collect()} and max(stored.values()) > 0
    publish.publish(made, root, CFG, skip_written=True)
    assert spark.read.parquet(f"{root}/frames").count() == made.frames.count()
    again = publish.only_new(made, spark, f"{root}/info")
    assert again.info.count() == 0 and again.frames.count() == 0
    fresh = publish.only_new(made, spark, f"{root}/nothing")
    assert fresh.info.count() == made.info.count()
    now = datetime(2024, 1, 4, tzinfo=timezone.utc)
    assert publish.expire(spark, f"{root}/frames", now, "2d") == (1, 2)
    assert spark.read.parquet(f"{root}/frames").agg(F.min("time")).first()[0] >= datetime(2024, 1, 2)


def stored(spark, root):
    rows = spark.read.parquet(f"{root}/series").select("cml_id", "field", "time", F.round("value", 9)).collect()
    info = spark.read.json(f"{root}/info").select("utc", "overall", "count_true").collect()
    frames = spark.read.parquet(f"{root}/frames").select("time", "row", "col", F.round("v", 9)).collect()
    return sorted(rows, key=str), sorted(info), sorted(frames, key=str)


def test_history_equals_the_products_of_one_range(spark, rows, links, tmp_path):
    """The whole history, and a part of it that is written again, are what one range gives."""
    cfg = replace(CFG, time=replace(CFG.time, start=T0 + timedelta(hours=12)))
    run.run_history(rows, links, cfg, str(tmp_path / "one"))
    points, info, frames = stored(spark, tmp_path / "one")
    made = run.run_historic(rows, links, cfg)
    assert len(info) == 36 * 6 + 1
    assert frames == sorted(made.frames.select("time", "row", "col", F.round("v", 9)).collect(), key=str)


def ragged_pdf():
    """Levels with gaps longer than a window, wet spells of many hours, an end that dies and one that comes late."""
    rng = np.random.default_rng(11)
    rows = []
    for link in range(5):
        steps = HOURS * 6
        rain = 9.0 * ((np.arange(steps) + 40 * link) % 150 < 70) * rng.uniform(0.3, 1, steps)
        for end in "ab":
            for name, base, gaps in (("PrijimanaUroven", -50.0 - rain, (60, 130) if link == 1 else (200, 230)), ("VysilaciVykon", np.full(steps, 10.0), (90, 110))):
                for i in range(steps):
                    gone = gaps[0] <= i < gaps[1] and (link + ord(end)) % 2 == 0 or rng.uniform() < 0.05
                    gone |= link == 3 and end == "b" and i < 170 or link == 4 and end == "a" and i > 120
                    gone |= link == 2 and name == "VysilaciVykon" and 30 < i < 260 and end == "a"
                    if not gone:
                        rows.append((T0 + timedelta(minutes=10 * i), f"{link}{end}", name, float(base[i] + 0.2 * rng.normal())))
    return pd.DataFrame(rows, columns=["time", "agent_host", "field", "value"])


@pytest.mark.parametrize(("wet_dry", "waa", "output_step"), [
    (WetDry(rolling_values=6, baseline_samples=1), WetAntenna(method="none"), 10),
    (WetDry(rolling_values=7, baseline_samples=3, centered=True), WetAntenna(method="schleiss", schleiss_tau=60.0), 20),
])
def test_trailing_windows_equal_the_whole(spark, links, tmp_path, wet_dry, waa, output_step):
    """Cycle after cycle, a window has the values of a run over the whole history up to then, with the state carried in a folder."""
    rows = spark.createDataFrame(ragged_pdf(), "time timestamp, agent_host string, field string, value double").cache()
    links = links.where("cml_id < 5")
    cfg = replace(CFG, wet_dry=wet_dry, waa=waa, time=replace(CFG.time, output_step=output_step))
    scans = []
    plain = run.load_channels
    run.load_channels = lambda *a, **k: scans.append(a[3][0] if len(a) > 3 else None) or plain(*a, **k)
    try:
        for hours in (18, 21, 30, 46):
            now = T0 + timedelta(hours=hours)
            part = run.run_trailing(rows, links, cfg, now, "6h", state=str(tmp_path / "state")).links.collect()
            whole = run.rain_fields(rain_rates(plain(rows, links, cfg, (None, now)), cfg, links), links, replace(
                cfg, time=replace(cfg.time, start=now - timedelta(hours=6), end=now))).links.collect()
            want = {(r.cml_id, r.time): (r.r, r.r_hour_sum) for r in whole}
            got = {(r.cml_id, r.time): (r.r, r.r_hour_sum) for r in part}
            assert set(got) == set(want) and len(got) > 30
            for k, v in want.items():
                assert got[k] == pytest.approx(v, abs=1e-9), (hours, k)
    finally:
        run.load_channels = plain
    assert scans[0] is None and [s for s in scans[1:] if s] == [T0 + timedelta(hours=h) for h in (12, 15, 24)]


@pytest.mark.parametrize("lost", ["before the dates are touched", "after they are deleted"])
def test_a_write_that_is_lost_half_way_loses_nothing(spark, tmp_path, monkeypatch, lost):
    def points(first, last, value):
        return spark.range(first, last).selectExpr("1L AS cml_id", "1704103200 + 600*id AS time", "'rain_intensity' AS field", f"{value} AS value")

    path = str(tmp_path / "points")
    publish.write_points(points(0, 72, "0.0D"), path)

    def fails(rows, path, kind, parts):
        if lost == "after they are deleted":
            shutil.rmtree(f"{path}/field=rain_intensity")
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(publish, "_rewrite", fails)
        with pytest.raises(RuntimeError):
            publish.write_points(points(70, 75, "1.0D"), path)
    assert publish.recover(spark, path, "parquet", ["field", publish.DATE]) == 1
    got = {r.time: r.value for r in spark.read.parquet(path).collect()}
    assert len(got) == 75 and sum(got.values()) == 5
    publish.write_points(points(75, 76, "2.0D"), path)
    publish.write_points(points(0, 0, "2.0D"), path)
    assert spark.read.parquet(path).count() == 76 and not os.listdir(f"{path}/{publish.PENDING}")


def test_trailing_without_state_scans_a_warm_up(rows, links):
    made = run.run_trailing(rows, links, CFG, T0 + timedelta(hours=40), "6h").links.collect()
    assert len(made) == 6 * 37


def test_writing_twice_keeps_what_was_there(spark, tmp_path):
    def points(first, last):
        return spark.range(first, last).selectExpr("1L AS cml_id", "1704103200 + 600*id AS time", "'rain_intensity' AS field", "double(id) AS value")

    path = str(tmp_path / "points")
    publish.write_points(points(0, 72), path)
    publish.write_points(points(72, 78), path)
    publish.write_points(points(70, 75).withColumn("value", F.lit(-1.0)), path)
    got = {r.time: r.value for r in spark.read.parquet(path).collect()}
    assert len(got) == 78 and sum(v == -1 for v in got.values()) == 5 and spark.read.parquet(path).count() == 78

    def frames(first, last, cells):
        return spark.range(first, last).selectExpr(
            "timestamp_seconds(1704103200 + 600*id) AS time", f"explode(sequence(1, {cells})) AS col").selectExpr("time", "0 AS row", "col", "1.0 AS v")

    path = str(tmp_path / "frames")
    publish.write_frames(frames(0, 100, 2), path)
    publish.write_frames(frames(50, 144, 1), path)
    back = spark.read.parquet(path)
    assert back.select("time").distinct().count() == 144 and back.count() == 50 * 2 + 94


def test_skip_written_without_summaries(spark, made, tmp_path):
    cfg = replace(CFG, output=Output(flags=False), hour_sum=HourSum())
    only = replace(made, frames_sum=None, info_sum=None)
    publish.publish(only, str(tmp_path), cfg)
    assert publish.new_times(only, spark, f"{tmp_path}/frames", "parquet").count() == 0


def test_jobs_run_from_another_folder(rows, links, tmp_path):
    """The package reaches the workers although they do not run beside it; intermediate tables go."""
    import subprocess
    import sys

    rows.write.parquet(str(tmp_path / "rows"))
    links.write.parquet(str(tmp_path / "links"))
    script = tmp_path / "job.py"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script.write_text(f"""
import sys
sys.path.insert(0, {root!r})
from dataclasses import replace
from datetime import datetime, timedelta, timezone
from pluvio.config import *
from pluvio.plans.run import run_history
from pluvio.session import local_session, _stage_root
spark = local_session("2", partitions=2, memory="2g")
t = datetime(2024, 1, 1, tzinfo=timezone.utc)
cfg = Settings(time=TimeAxis(start=t + timedelta(hours=6), end=t + timedelta(hours=30)), limits=Limits(14.0, 14.6, 49.9, 50.3),
               interp=Interp(nx=6, ny=5, near=4, tile=4), output=Output(intensities=True))
run_history(spark.read.parquet({str(tmp_path / "rows")!r}), spark.read.parquet({str(tmp_path / "links")!r}), cfg, {str(tmp_path / "out")!r})
path = spark._jvm.org.apache.hadoop.fs.Path(_stage_root(spark))
fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
print("LEFT", fs.exists(path) and len(fs.listStatus(path)))
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    assert "LEFT 0" in done.stdout or "LEFT False" in done.stdout
    assert (tmp_path / "out" / "series").exists()


def test_stream_means_equal_batch(spark, rows, tmp_path):
    from pluvio.sources.telemetry import step_means

    late = rows.agg(F.max("time").alias("time")).select(
        (F.col("time") + F.expr("INTERVAL 1 DAY")).alias("time"), F.lit("0a").alias("agent_host"),
        F.lit("PrijimanaUroven").alias("field"), F.lit(-50.0).alias("value"))
    rows.where("agent_host like '0%'").repartitionByRange(3, "time").write.parquet(str(tmp_path / "in"))
    late.write.mode("append").parquet(str(tmp_path / "in"))
    means = live.stream_step_means(live.read_stream(spark, str(tmp_path / "in")), 600)
    q = means.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).where(F.col("time") <= F.lit(T0 + timedelta(hours=HOURS)))
    want = step_means(rows.where("agent_host like '0%'"), 600)
    cols = ["agent_host", "time", F.round("rx_power", 9), F.round("tx_power", 9)]
    assert got.count() == want.count() and got.select(*cols).exceptAll(want.select(*cols)).count() == 0


def test_stream_hour_sums(spark, tmp_path):
    data = [(1, T0 + timedelta(minutes=10 * i), 6.0) for i in range(24)] + [(1, T0 + timedelta(days=2), 0.0)]
    spark.createDataFrame(data, "cml_id bigint, time timestamp, r double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("cml_id bigint, time timestamp, r double").parquet(str(tmp_path / "in"))
    q = live.stream_hour_sums(stream, 10).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {r["time"]: r["r_hour_sum"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[datetime(2024, 1, 1, 2, 0)] == pytest.approx(6.0)
    # As in batch, a window that begins before the data has no sum.
    assert got[datetime(2024, 1, 1, 0, 0)] is None and got[datetime(2024, 1, 1, 0, 50)] == pytest.approx(6.0)


def test_stream_hour_sums_with_fractions_of_a_second(spark, tmp_path):
    first = T0 + timedelta(microseconds=500)
    data = [(1, first + timedelta(minutes=10 * i), 6.0) for i in range(24)] + [(1, T0 + timedelta(days=2), 0.0)]
    spark.createDataFrame(data, "cml_id bigint, time timestamp, r double").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("cml_id bigint, time timestamp, r double").parquet(str(tmp_path / "in"))
    live.stream_hour_sums(stream, 10).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    known = [r["r_hour_sum"] for r in spark.read.parquet(str(tmp_path / "out")).collect() if r["r_hour_sum"] is not None]
    assert len(known) == 19 and all(x == pytest.approx(6.0) for x in known)


def test_recompute_takes_late_rows(spark, rows, links, tmp_path):
    """Late rows inside the window change what was written before."""
    early = rows.where("not (agent_host = '0b' and hour(time) = 20)")
    late = rows.where("agent_host = '0b' and hour(time) = 20")
    cfg = replace(CFG, time=TimeAxis(), hour_sum=HourSum())
    source = str(tmp_path / "in")

    def job(landed_rows, newest):
        products = run.run_trailing(landed_rows, links, cfg, newest.replace(tzinfo=timezone.utc) + timedelta(minutes=10), "2d")
        publish.write_points(products_points(products), str(tmp_path / "series"))

    def products_points(p):
        from pluvio.operators.products import intensity_points

        return intensity_points(p.links)

    def go():
        stream = live.read_stream(spark, source)
        live.recompute_loop(stream, str(tmp_path / "landed"), str(tmp_path / "cp"), job, window="2d").awaitTermination()
        return spark.read.parquet(str(tmp_path / "series")).where("cml_id = 0 and value is not null").count()

    early.write.parquet(source)
    before = go()
    late.write.mode("append").parquet(source)
    after = go()
    assert after >= before and spark.read.parquet(str(tmp_path / "landed")).count() == rows.count()
    newest = rows.agg(F.max("time")).first()[0].replace(tzinfo=timezone.utc) + timedelta(minutes=10)
    want = products_points(run.run_trailing(rows, links, cfg, newest, "2d"))
    got = spark.read.parquet(str(tmp_path / "series"))
    cols = ["cml_id", "time", F.round("value", 9)]
    assert got.count() == want.count() and got.select(*cols).exceptAll(want.select(*cols)).count() == 0


def test_stateful_baseline_equals_batch(spark, tmp_path):
    rng = np.random.default_rng(2)
    data = [(c, "x", T0 + timedelta(minutes=10 * i), float(rng.normal(50, 0.5 if (i // 20) % 2 else 4))) for c in (1, 2) for i in range(120)]
    df = spark.createDataFrame(data, "cml_id bigint, channel_id string, time timestamp, trsl double")
    source = str(tmp_path / "in")
    out = str(tmp_path / "out")
    for part in range(3):
        df.where((F.minute("time") >= 0) & (F.floor((F.unix_timestamp("time") - 1704067200) / 24000) == part)).coalesce(1).write.mode(
            "append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        live.stream_baseline(stream, roll=4, threshold=1.5, n=3, rise=0.5).writeStream.format("parquet").option(
            "path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(out).orderBy("cml_id", "time").toPandas()
    batch = bl.baseline_and_waa(wd.rolling_wet(df, 4, 1.5), n=3, tau=60.0, step_minutes=10.0)
    want = batch.orderBy("cml_id", "time").toPandas()
    assert list(got["wet"]) == list(want["wet"]) and any(want["wet"])
    np.testing.assert_allclose(got["baseline"], want["baseline"])
    np.testing.assert_allclose(got["waa"], want["waa"])


def test_stateful_baseline_leaves_late_rows(spark, tmp_path):
    data = [(1, "x", T0 + timedelta(minutes=10 * i), float(50 + i % 3)) for i in range(30)]
    df = spark.createDataFrame(data, "cml_id bigint, channel_id string, time timestamp, trsl double")
    late = df.where(F.col("time") == F.lit(T0 + timedelta(minutes=100)))
    for part in (df.exceptAll(late).where(F.hour("time") < 3), late.unionByName(df.where(F.hour("time") >= 3))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        live.stream_baseline(stream, roll=4, threshold=1.5, n=3, forget="1 day").writeStream.format("parquet").option(
            "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 29 and got.where(F.col("time") == F.lit(T0 + timedelta(minutes=100))).count() == 0


def test_landing_again_replaces(spark, rows, tmp_path):
    path = str(tmp_path / "landed")
    some = rows.where("agent_host = '1a'")
    live.land(some, 0, path)
    live.land(some, 0, path)
    assert live.landed(spark, path).count() == some.count()
    assert live.landed(spark, path, T0 + timedelta(hours=24)).agg(F.min("time")).first()[0] == datetime(2024, 1, 2)


@pytest.fixture
def by_spread():
    def scorer(features):
        return features.map(lambda f: 1.0 if np.std(np.asarray(f, dtype=float)) > 0.35 else 0.0)

    return scorer


def test_segment_classifier(spark, rows, links, by_spread):
    """Flags made on 5-minute rows, put on the 10-minute steps, take the place of the rolling ones."""
    from pluvio.plans.classify import flags_from_fine, segment_flags
    from pluvio.operators.channels import build_channels
    from pluvio.sources.telemetry import step_means

    fine = build_channels(step_means(rows, 300), links)
    options = {"size": 12, "median_window": 9, "deviation": 50.0}
    flags = segment_flags(fine, by_spread, **options)
    counts = {r["wet"]: r["count"] for r in flags.groupBy("wet").count().collect()}
    assert counts[True] > 0 and counts[False] > 0
    channels = flags_from_fine(build_channels(step_means(rows, 600), links), fine, by_spread, **options)
    cfg = replace(CFG, wet_dry=replace(CFG.wet_dry, method="given"))
    out = rain_rates(channels, cfg, slim=True)
    assert out.where("wet").count() > 0 and out.agg(F.max("r")).first()[0] > 0
    assert out.count() == build_channels(step_means(rows, 600), links).count()


def test_sliding_classifier(rows, links):
    from pluvio.plans.classify import sliding_flags
    from pluvio.operators.channels import build_channels
    from pluvio.sources.telemetry import step_means

    channels = build_channels(step_means(rows, 600), links)
    def by_spread(windows):
        return windows.std(axis=(1, 2)) > 0.35

    out = sliding_flags(channels, by_spread, threshold=0.5, window=12, shift=3, median_rows=30, median_min=5, trim=20)
    assert out.count() == channels.count() - 6 * 2 * 20
    assert 0 < out.where("wet").count() < out.count()


def test_rows_that_come_late_take_their_place(spark, tmp_path):
    """Shuffled within half an hour over several files, with a repeated row: what the watermark has passed is what batch gives."""
    from pluvio.streaming import ordered

    rng = np.random.default_rng(3)
    steps = 60
    rows = [(c, "A", T0 + timedelta(minutes=10 * i), float(50 + 6 * (i % 14 > 9) + rng.normal() * 0.2)) for c in (1, 2) for i in range(steps)]
    schema = "cml_id bigint, channel_id string, time timestamp, trsl double"
    arrival = sorted(range(len(rows)), key=lambda k: (rows[k][2] - T0).total_seconds() / 600 + rng.uniform(0, 3))
    for part in range(4):
        some = [rows[k] for k in arrival[part * 30:(part + 1) * 30]]
        spark.createDataFrame(some + some[:1], schema).coalesce(1).write.parquet(f"{tmp_path}/in/part={part}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/part=*")
    walked = ordered.stream_baseline_ordered(stream, roll=4, threshold=1.5, n=3, rise=0.5, lateness="40 minutes")
    walked.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(
        availableNow=True).start().awaitTermination(240)
    got = {(r.cml_id, r.time): (r.wet, r.baseline, r.waa) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    batch = bl.baseline_and_waa(wd.rolling_wet(spark.createDataFrame(rows, schema), 4, 1.5), n=3, tau=60.0, step_minutes=10.0)
    want = {(r.cml_id, r.time): (r.wet, r.baseline, r.waa) for r in batch.collect()}
    assert len(got) >= 2 * (steps - 6) and set(got) <= set(want)
    for k, v in got.items():
        assert v[0] == want[k][0] and v[1:] == pytest.approx(want[k][1:]), k


def test_channels_of_neighbouring_links_share_their_state():
    """40 channels whose rows come up to three steps late: as many messages to the state as for one, and the values of each channel on its own."""
    from types import SimpleNamespace

    from pluvio.streaming import ordered

    messages, timers = [], set()

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            messages.append("get")
            return self.value

        def update(self, value):
            messages.append("update")
            self.value = value

    handle = SimpleNamespace(getValueState=lambda _name, _schema: State(), listTimers=lambda: iter(timers), registerTimer=timers.add, deleteTimer=timers.discard)
    walker = ordered.OrderedWalk(4, 1.5, 3, 2.2, 0.5)
    walker.init(handle)
    rng, steps = np.random.default_rng(8), 60
    start = pd.Timestamp("2024-01-01")
    rows = pd.DataFrame([(c, ch, start + pd.Timedelta(minutes=10 * i), 50 + 6 * (i % 14 > 9) + rng.normal() * 0.2)
                         for c in range(20) for ch in "AB" for i in range(steps + c % 3)], columns=["cml_id", "channel_id", "time", "trsl"])
    rows["arrival"] = (rows["time"] - start) / pd.Timedelta(minutes=10) + rng.uniform(0, 3, len(rows))
    out, watermark = [], 0
    for a in range(0, 72, 12):
        part = rows[(rows["arrival"] >= a) & (rows["arrival"] < a + 12)].sample(frac=1, random_state=a)
        timer = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        out += walker.handleInputRows((0,), iter([part[["cml_id", "channel_id", "time", "trsl"]]]), timer) if len(part) else []
        watermark = int((rows["time"][rows["arrival"] < a + 12].max() - pd.Timedelta(minutes=30)).value // 1_000_000)
        out += walker.handleExpiredTimer((0,), timer, None)
        assert len(timers) <= 1
    assert len(messages) <= 12 * 4
    got = pd.concat(out)
    assert not got.duplicated(["cml_id", "channel_id", "time"]).any() and len(got) >= 40 * (steps - 4)
    for key, own in got.groupby(["cml_id", "channel_id"]):
        x = rows[(rows["cml_id"] == key[0]) & (rows["channel_id"] == key[1])]["trsl"].to_numpy()
        wet = np.array([float(i >= 3 and np.std(x[i - 3:i + 1]) > 1.5) for i in range(len(x))])
        base, waa = bl.walk(x, wet, np.arange(len(x)), 3, 2.2, 0.5)
        own = own.sort_values("time")
        assert list(own["wet"]) == list(wet[:len(own)] == 1) and any(own["wet"])
        np.testing.assert_allclose(own["baseline"], base[:len(own)])
        np.testing.assert_allclose(own["waa"], waa[:len(own)])


def test_landed_batches_are_put_together(spark, tmp_path):
    """Forty batches and a repeated one, compacted by eight: no more folders than that, the same rows, and old dates gone."""
    path = str(tmp_path / "landed")

    def batch(k):
        return spark.createDataFrame([(T0 + timedelta(hours=6 * k + j), "h", "f", float(k)) for j in range(2)], "time timestamp, agent_host string, field string, value double")

    most = 0
    for k in range(24):
        live.land(batch(k).coalesce(1), k, path)
        if k == 20:
            live.land(batch(k).coalesce(1), k, path)
        live.compact(spark, path, k, T0 + timedelta(hours=6 * k) - timedelta(days=2), loose=4)
        most = max(most, len(os.listdir(path)))
    assert most <= 6
    got = sorted(r.value for r in live.landed(spark, path).collect())
    assert len(got) < 48 and got[-16:] == sorted(float(k) for k in range(16, 24) for _ in range(2))
    since = T0 + timedelta(hours=6 * 22)
    assert sorted(r.value for r in live.landed(spark, path, since).collect()) == [22.0, 22.0, 23.0, 23.0]
    # A compaction that was lost half way is not seen.
    os.makedirs(f"{path}/upto=99")
    assert len(live.landed(spark, path).collect()) == len(got)


def test_a_long_first_window_then_a_short_one(spark, rows, tmp_path):
    """The loop starts with a long window over what is there, and goes on with a short one over what comes."""
    def put(name, first, last):
        some = rows.where((F.col("time") >= F.lit(T0 + timedelta(hours=first))) & (F.col("time") < F.lit(T0 + timedelta(hours=last))))
        some.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        for f in os.listdir(f"{tmp_path}/{name}"):
            if f.endswith(".parquet"):
                os.makedirs(f"{tmp_path}/in", exist_ok=True)
                shutil.copy(f"{tmp_path}/{name}/{f}", f"{tmp_path}/in/{name}.parquet")

    seen = []

    def job(landed_rows, newest):
        seen.append((landed_rows.agg(F.min("time")).first()[0], newest))

    def run_once(window):
        stream = live.read_stream(spark, f"{tmp_path}/in", 1)
        live.recompute_loop(stream, f"{tmp_path}/landed", f"{tmp_path}/checkpoint", job, window=window, loose=2).awaitTermination(120)

    put("a", 0, 40)
    run_once("7d")
    put("b", 40, 44)
    put("c", 44, 48)
    run_once("1h")
    begin = datetime(2024, 1, 1)
    assert [(a, b - begin) for a, b in seen] == [
        (begin, timedelta(hours=39, minutes=55)), (begin + timedelta(hours=18, minutes=55), timedelta(hours=43, minutes=55)),
        (begin + timedelta(hours=22, minutes=55), timedelta(hours=47, minutes=55))]


def test_gaps_across_the_carried_rows_are_filled_from_measured_values(spark):
    """A level that is missing around the last settled row is filled from the nearest measured value, not from a filled one."""
    from pluvio.plans import carry

    tsl = [10.0] * 4 + [50.0] * 5 + [14.0] * 6  # 50 is no measurement
    rsl = [-50.0] * 7 + [0.0] * 4 + [-50.0] * 4  # nor is 0; row 6 is the last settled one of the first ten
    rows = [(1, T0 + timedelta(minutes=10 * i), "V", 5.0, "x", t, p, 0.0, 0.0, 20.0, 0.1, 1.0, True, True) for i, (t, p) in enumerate(zip(tsl, rsl, strict=True))]
    names = """cml_id long, time timestamp, polarization string, length double, channel_id string, tsl double, rsl double, temperature_rx double,
        temperature_tx double, frequency double, k double, alpha double, has_a boolean, has_b boolean"""
    cfg = replace(CFG, wet_dry=WetDry(rolling_values=2, baseline_samples=1), waa=WetAntenna(method="none"), hour_sum=HourSum(enabled=False))
    rates = [rain_rates(carry.with_known(spark.createDataFrame(part, names), None), cfg) for part in (rows[:10], rows)]
    state = carry.state(rates[0], cfg, rows[9][1]).select(carry.with_known(spark.createDataFrame(rows, names), None).columns).cache()
    later = rain_rates(carry.with_known(spark.createDataFrame(rows[10:], names), state), cfg)
    want = {r["time"]: r["trsl"] for r in rates[1].collect()}
    got = {r["time"]: (r["given"], r["trsl"]) for r in later.collect()}
    assert sum(not given for given, _ in got.values()) == 8 and len(got) < 14
    assert {t: v for t, (_, v) in got.items()} == {t: want[t] for t in got}
