"""Structured Streaming: landing telemetry, step means, trailing recomputation, stateful baseline."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.query import StreamingQuery

from pluvio.config import TRAILING_WINDOWS, FieldNames
from pluvio.operators.baseline import walk
from pluvio.session import ship, staging
from pluvio.sources.telemetry import SCHEMA, step_means


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Telemetry files arriving in a folder; event time is a TIMESTAMP, as watermarks need."""
    reader = spark.readStream.schema(SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def stream_step_means(
    stream: DataFrame, seconds: int, names: FieldNames = FieldNames(), lateness: str = "30 minutes", temperature: bool = True
) -> DataFrame:
    """The step means of the batch source over a stream; a step is emitted when the watermark passes it."""
    return step_means(stream.withWatermark("time", lateness), seconds, names, temperature)


def stream_hour_sums(
    link_rain: DataFrame, step_minutes: int, window_minutes: int = 60, lateness: str = "30 minutes"
) -> DataFrame:
    """Sliding sums over a stream (cml_id, time, r): the windows end on the steps, like the row frames in batch.

    A window is open at its start and closed at its end, to the millisecond. As in batch, a window with fewer known values
    than steps has no sum.
    """
    steps = round(window_minutes / step_minutes)
    slide = F.window("time", f"{window_minutes} minutes", f"{step_minutes} minutes", startTime="1 millisecond")
    return (
        link_rain.withWatermark("time", lateness).where(F.col("r").isNotNull()).groupBy("cml_id", slide)
        .agg(F.sum(F.col("r") * (step_minutes / 60.0)).alias("total"), F.count("r").alias("n"))
        .select(
            "cml_id", (F.col("window.end") - F.expr("INTERVAL 1 MILLISECOND")).alias("time"),
            F.when(F.col("n") >= steps, F.col("total")).alias("r_hour_sum"),
        )
    )


#: Batches that lie on their own before they are put together.
LOOSE = 32


def _entries(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """Numbers of the landed batches, and of the last batch in each complete compaction, both ascending."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list[int]] = {"batch": [], "upto": []}
    for entry in fs.listStatus(root) if fs.exists(root) else []:
        kind, _, number = entry.getPath().getName().partition("=")
        if kind in found and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(entry.getPath(), "_SUCCESS")):
            found[kind].append(int(number))
    return sorted(found["batch"]), sorted(found["upto"])


def land(batch: DataFrame, batch_id: int, path: str) -> None:
    """Append a micro-batch to the landed table; a repeated batch replaces itself."""
    (
        batch.withColumn("landed_date", F.to_date("time"))
        .write.mode("overwrite").partitionBy("landed_date").parquet(f"{path}/batch={batch_id}")
    )


def compact(spark: SparkSession, path: str, before: int, since: datetime | None = None, loose: int = LOOSE) -> bool:
    """Put the batches below `before` together by date once there are `loose` of them; True if it was done.

    Dates before `since` expire then. The new table stands beside the old one until it is complete, and what it replaces is deleted after that;
    a loss in between leaves either the old state or batches that readers pass over.
    """
    batches, compacted = _entries(spark, path)
    last = compacted[-1] if compacted else -1
    done = [k for k in batches if last < k < before]
    if len(done) < loose:
        return False
    rows = landed(spark, path, since, before).withColumn("landed_date", F.to_date("time"))
    rows.repartition("landed_date").write.mode("overwrite").partitionBy("landed_date").parquet(f"{path}/upto={done[-1]}")
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in [f"batch={k}" for k in batches if k <= done[-1]] + [f"upto={k}" for k in compacted]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return True


def landed(spark: SparkSession, path: str, since: datetime | None = None, before: int | None = None) -> DataFrame:
    """The landed rows, of batches below `before` if it is given; `since` prunes dates as well as rows.

    They lie in one compacted table by date and in the batches after it.
    """
    batches, compacted = _entries(spark, path)
    last = compacted[-1] if compacted else -1
    folders = [f"{path}/batch={k}" for k in batches if k > last and (before is None or k < before)]
    folders += [f"{path}/upto={last}"] if compacted else []
    columns = ["time", "agent_host", "field", "value"]
    if not folders:
        return spark.createDataFrame([], SCHEMA).select(columns)
    reader = spark.read.schema(f"{SCHEMA}, landed_date date")
    parts = [reader.parquet(f) for f in folders]
    rows = reduce(DataFrame.unionByName, parts)
    if since is not None:
        rows = rows.where((F.col("landed_date") >= F.lit(since.date())) & (F.col("time") >= F.lit(since)))
    return rows.select(columns)


def recompute_loop(
    stream: DataFrame,
    landed_path: str,
    checkpoint: str,
    job: Callable[[DataFrame, datetime], None],
    *,
    every: str | None = None,
    window: str | None = None,
    loose: int = LOOSE,
) -> StreamingQuery:
    """Land each micro-batch, then run `job(landed rows, newest time)` over the trailing window.

    With `window`, only landed dates that the window can touch are read, and older ones expire when batches are put together.

    The job recomputes its window as a whole and replaces the times it writes, so late rows inside
    the window correct what was written before. Intermediate tables of a cycle are deleted after it. `every` is the trigger interval; without it the
    query takes what is there and ends, as the first run over a long window does. A run may go on with another window, as after a
    first run over a long one, from the same checkpoint.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        land(batch.select("time", "agent_host", "field", "value"), batch_id, landed_path)
        # The newest time is at least the batch's own, so only dates from there on are looked at.
        own = spark.read.schema(SCHEMA).parquet(f"{landed_path}/batch={batch_id}").agg(F.max("time").alias("t")).first()["t"]
        if own is not None:
            newest = landed(spark, landed_path, own).agg(F.max("time").alias("t")).first()["t"]
            since = None if window is None else newest - TRAILING_WINDOWS[window] - timedelta(days=1)
            # Batches before this one are done with and come no more.
            compact(spark, landed_path, batch_id, since, loose)
            with staging(spark):
                job(landed(spark, landed_path, since), newest)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


_STATE = "seen bigint, trsl array<double>, base array<double>, was array<double>, waa double, newest timestamp"
_OUT = "cml_id bigint, channel_id string, time timestamp, trsl double, wet boolean, baseline double, waa double"


def stream_baseline(
    channels: DataFrame, *, roll: int = 10, threshold: float = 0.8, n: int = 5, waa_max: float = 2.2, rise: float = 2.0,
    forget: str | None = None,
) -> DataFrame:
    """Wet flags, baseline and wet-antenna attenuation of a stream (cml_id, channel_id, time, trsl).

    The state of a channel is its last path losses, baselines and flags, the last wet-antenna attenuation and its newest
    time; the rows of a micro-batch are walked after them as in batch. Rows at or before the newest time walked come too late
    and are not emitted: land them and recompute (see `recompute_loop`). With `forget`, the stream has a watermark that far
    behind its newest time, and a channel starts anew when the watermark is that far past its last row.
    """
    back = max(roll - 1, n)
    timeout = None if forget is None else int(pd.Timedelta(forget).total_seconds() * 1000)

    def go(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, trsl, base, was, waa, newest = state.get if state.exists else (0, [], [], [], 0.0, None)
        rows = pd.concat(list(parts)).sort_values("time", kind="stable")
        if newest is not None:
            rows = rows[rows["time"] > pd.Timestamp(newest)]
        if not len(rows):
            return
        if timeout is not None:
            state.setTimeoutTimestamp(max(int(rows["time"].iloc[-1].timestamp() * 1000), state.getCurrentWatermarkMs()) + timeout)
        old = len(trsl)
        x = np.concatenate([np.array(trsl, float), rows["trsl"].to_numpy("float64")])
        known = np.lib.stride_tricks.sliding_window_view(x, roll) if len(x) >= roll else np.zeros((0, roll))
        wet = np.concatenate([np.zeros(len(x) - len(known)), (np.std(known, axis=1) > threshold).astype(float)])
        wet[:old] = was
        since = np.arange(len(x)) + seen - old
        done, up = walk_on(x, wet, since, n, waa_max, rise, np.array(base, float), waa)
        state.update((
            int(seen + len(rows)), x[-back:].tolist(), done[-back:].tolist(), wet[-back:].tolist(), float(up[-1]),
            rows["time"].iloc[-1].to_pydatetime(),
        ))
        yield pd.DataFrame({
            "cml_id": key[0], "channel_id": key[1], "time": rows["time"].to_numpy(), "trsl": x[old:], "wet": wet[old:] == 1,
            "baseline": done[old:], "waa": up[old:],
        })

    ship(channels.sparkSession)
    kind = GroupStateTimeout.NoTimeout
    if forget is not None:
        kind, channels = GroupStateTimeout.EventTimeTimeout, channels.withWatermark("time", forget)
    return channels.groupBy("cml_id", "channel_id").applyInPandasWithState(go, _OUT, _STATE, "append", kind)


def walk_on(
    trsl: np.ndarray, wet: np.ndarray, since: np.ndarray, n: int, waa_max: float, rise: float, base: np.ndarray, waa: float
) -> tuple[np.ndarray, np.ndarray]:
    """`baseline.walk` that goes on after rows whose baselines are known; waa is that of the last of them."""
    old = len(base)
    if old == 0:
        return walk(trsl, wet, since, n, waa_max, rise)
    baseline = np.concatenate([base, np.where((since < n) | (wet != 1), trsl, np.nan)[old:]])
    rows = old + np.flatnonzero(wet[old:] == 1)
    for i in rows[since[rows] >= n]:
        baseline[i] = baseline[i - 1] if wet[i - 1] == 1 else baseline[i - n : i].mean()
    up = np.minimum(trsl - baseline, waa_max)
    up[old - 1] = waa
    for i in rows:
        up[i] = np.minimum(up[i], up[i - 1] + (waa_max - up[i - 1]) * rise)
    return baseline, up
