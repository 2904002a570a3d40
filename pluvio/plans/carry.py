"""State carried from one run over a trailing window to the next, so that a window has the values of the whole history.

What a run needs of the time before its window are the last rows of every channel. A row is settled when nothing that comes later
can change it: gaps are filled from both sides, so a channel is settled up to the last row at which all levels are known (a level
never seen yet is missing up to there whatever comes), less the rows that a centred window looks ahead. Settled rows are carried with
their results (path loss, wet flag, baseline, wet-antenna attenuation), as many as rolling windows, averaged baselines and hour sums
look back on, and the last ones that measured each level, from which later gaps are filled. Rows after them are carried as they were read and are worked out again. A channel that reports one level but not
another carries all rows since then; all others carry a bounded number.

Telemetry that arrives after the state of its time was written no longer changes what lies before the window. Statistics of
temperature are those of the rows at hand.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.config import Settings
from pluvio.operators.quality import CHANNEL, valid_signals

#: Results that settled rows bring.
GIVEN = {"trsl": "double", "wet": "boolean", "baseline": "double", "waa": "double"}
LEVELS = ["tsl", "rsl"]
TEMPERATURES = ["temperature_rx", "temperature_tx"]
#: States kept; older ones are deleted.
KEPT = 3


def lookback(cfg: Settings) -> int:
    """Rows before the first unsettled one that its results depend on."""
    wd, ratio = cfg.wet_dry, max(1, round(cfg.time.output_step / cfg.time.step))
    sums = round(cfg.hour_sum.window_minutes / cfg.time.output_step) if cfg.hour_sum.enabled else 1
    return max(wd.rolling_values, wd.baseline_samples, (sums + 1) * ratio) + 1


def with_known(channels: DataFrame, carried: DataFrame | None) -> DataFrame:
    """The carried rows and the scanned ones after them, with marks of the levels that were measured."""
    columns = LEVELS + TEMPERATURES
    marked = valid_signals(channels)
    marked = marked.withColumns({f"known_{c}": F.col(c).isNotNull() for c in columns})
    marked = marked.withColumns({"given": F.lit(False)} | {f"given_{c}": F.lit(None).cast(kind) for c, kind in GIVEN.items()})
    if carried is not None:
        marked = marked.unionByName(carried.select(marked.columns))
    link = Window.partitionBy("cml_id")
    return marked.repartition("cml_id").withColumns({c: F.max(c).over(link) for c in ("has_a", "has_b")})


def state(rates: DataFrame, cfg: Settings, at: datetime) -> DataFrame:
    """The rows to carry of everything up to the step that ends `at`; a later scan from there on has the steps after it. rates: from `rain_rates` over `with_known`, not slim."""
    columns = LEVELS + (TEMPERATURES if cfg.temperature.needed else [])
    ahead = (cfg.wet_dry.rolling_values - 1) // 2 if cfg.wet_dry.centered else 0
    order = Window.partitionBy(*CHANNEL).orderBy("time")
    channel = Window.partitionBy(*CHANNEL)
    rows = rates.where(F.col("time") <= F.lit(at)).withColumn("place_", F.row_number().over(order))
    last = [F.coalesce(F.max(F.when(F.col(f"known_{c}"), F.col("place_"))).over(channel), F.count("*").over(channel)) for c in columns]
    rows = rows.withColumn("settled_", F.least(*last) - ahead)
    given = F.col("place_") <= F.col("settled_")
    # Gaps that reach beyond the settled rows are filled from the last row that measured the value, however far back it lies.
    before = {f"before_{c}": F.max(F.when(given & F.col(f"known_{c}"), F.col("place_"))).over(channel) for c in columns}
    rows = rows.withColumns(before)
    source = F.coalesce(F.col("place_").isin(*[F.col(c) for c in before]), F.lit(False))
    rows = rows.where((F.col("place_") > F.col("settled_") - lookback(cfg)) | source)
    held = "held" if "held" in rates.columns else "baseline"
    results = {"given_trsl": F.col("trsl"), "given_wet": F.col("wet"), "given_baseline": F.col(held), "given_waa": F.col("waa")}
    # Only measured values are carried: the nearest one to a later gap is not told from a filled one.
    raw = {c: F.when(F.col(f"known_{c}"), F.col(c)) for c in LEVELS + TEMPERATURES}
    out = rows.withColumns(raw | {"given": given} | {c: F.when(given, v) for c, v in results.items()})
    return out.drop("place_", "settled_", *before)


def _folders(spark: SparkSession, root: str) -> dict[int, str]:
    """Complete states by the second they stand for."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for entry in fs.listStatus(path) if fs.exists(path) else []:
        name = entry.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")
        if name.startswith("at=") and fs.exists(done):
            found[int(name[3:])] = entry.getPath().toString()
    return found


def latest(spark: SparkSession, root: str, start: datetime) -> tuple[datetime, DataFrame] | None:
    """The newest state that stands for a time up to `start`."""
    found = {at: p for at, p in _folders(spark, root).items() if at <= start.timestamp()}
    if not found:
        return None
    newest = max(found)
    return datetime.fromtimestamp(newest, timezone.utc), spark.read.parquet(found[newest])


def save(rows: DataFrame, root: str, at: datetime) -> None:
    """Write the state that stands for a time, and delete all but the newest few."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{root}/at={int(at.timestamp())}")
    folders = _folders(spark, root)
    for old in sorted(folders)[:-KEPT]:
        path = spark._jvm.org.apache.hadoop.fs.Path(folders[old])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def recent(rates: DataFrame, cfg: Settings) -> DataFrame:
    """The rows from as far before the start as hour sums reach; of older rows only their link remains, without a rate."""
    start, step, out = cfg.time.start, cfg.time.step, cfg.time.output_step
    sums = round(cfg.hour_sum.window_minutes / out) if cfg.hour_sum.enabled else 1
    if out > step:
        day = datetime(start.year, start.month, start.day, tzinfo=timezone.utc)
        bins = int((start - day) / timedelta(minutes=out)) - sums - 1
        cut = F.lit(day + timedelta(minutes=out * bins))
    else:
        times = rates.where(F.col("time") < F.lit(start)).select("time").distinct().orderBy(F.desc("time")).limit(sums)
        first = times.agg(F.min("time").alias("t")).first()["t"]
        if first is None:
            return rates
        cut = F.lit(first)
    old = F.col("time") < cut
    return rates.withColumn("r", F.when(~old, F.col("r"))).withColumn("time", F.greatest("time", cut))
