"""Row by row operators over streams whose rows come out of order.

Rows wait in state until the watermark has passed them, and are then worked out in the order of their times. A row that is late, but not
behind the watermark, thus takes its right place; what is behind it is dropped and counted by Spark.

State is kept for a few neighbouring links together, whatever their number in all: every access to it is a message to the JVM, and the
rows of all channels of such a group are walked at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pluvio.operators.baseline import walk
from pluvio.operators.grouped import group_starts
from pluvio.operators.quality import CHANNEL
from pluvio.session import ship

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "cml_id bigint, channel_id string, time timestamp, trsl double, wet boolean, baseline double, waa double"
#: Links whose state is kept together, as a power of two.
TOGETHER = 6
# Frames as columns of values. The rows that wait, and the last rows of every channel with their results; times are in microseconds.
_WAITING = {"cml_id": "bigint", "channel_id": "string", "time": "bigint", "trsl": "double"}
_PAST = {**_WAITING, "pos": "bigint", "wet": "double", "baseline": "double", "waa": "double"}
_TYPES = {"bigint": "int64", "double": "float64", "string": "object"}


def _schema(columns: dict[str, str]) -> str:
    return ", ".join(f"{c} array<{kind}>" for c, kind in columns.items())


def _held(state, columns: dict[str, str]) -> pd.DataFrame:
    values = state.get() if state.exists() else [[] for _ in columns]
    return pd.DataFrame({c: np.array(v, dtype=_TYPES[kind]) for (c, kind), v in zip(columns.items(), values, strict=True)})


def _hold(state, rows: pd.DataFrame, columns: dict[str, str]) -> None:
    state.update(tuple(rows[c].tolist() for c in columns))


class OrderedWalk(StatefulProcessor):
    """Wet flags, baseline and wet-antenna attenuation of the channels of a few links, from rows in any order."""

    def __init__(self, roll: int, threshold: float, n: int, waa_max: float, rise: float):
        self.roll, self.threshold, self.n, self.waa_max, self.rise = roll, threshold, n, waa_max, rise

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", _schema(_WAITING))
        self.past = handle.getValueState("past", _schema(_PAST))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(rows))[list(_WAITING)]
        fresh["time"] = fresh["time"].to_numpy("datetime64[us]").astype("int64")
        yield from self._ripe(fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._ripe(None, timerValues.getCurrentWatermarkInMs())

    def _ripe(self, fresh: pd.DataFrame | None, watermark: int) -> Iterator[pd.DataFrame]:
        """The rows that the watermark has passed, walked in order; the rest waits, and a timer is set for it."""
        past, held = _held(self.past, _PAST), _held(self.waiting, _WAITING)
        if fresh is not None:
            newest = past.drop_duplicates(CHANNEL, keep="last")[[*CHANNEL, "time"]].rename(columns={"time": "newest"})
            fresh = fresh.merge(newest, "left", CHANNEL)
            fresh = fresh[fresh["newest"].isna() | (fresh["time"] > fresh["newest"])]
            held = pd.concat([held, fresh[list(_WAITING)]], ignore_index=True) if len(held) else fresh[list(_WAITING)]
        ripe = held["time"] <= max(watermark, 0) * 1000
        rest = held[~ripe]
        if ripe.any():
            yield self._walked(past, held[ripe].sort_values([*CHANNEL, "time", "trsl"]).drop_duplicates([*CHANNEL, "time"], keep="last"))
        if fresh is not None or ripe.any():
            _hold(self.waiting, rest, _WAITING)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(rest):
            self.handle.registerTimer(int(rest["time"].min() // 1000))

    def _walked(self, past: pd.DataFrame, ripe: pd.DataFrame) -> pd.DataFrame:
        """The ripe rows with their results; the last rows of every channel become the past."""
        roll, back = self.roll, max(self.roll - 1, self.n)
        rows = pd.concat([past.assign(known=True), ripe.assign(known=False)] if len(past) else [ripe.assign(known=False)], ignore_index=True)
        rows = rows.reindex(columns=[*_PAST, "known"]).sort_values([*CHANNEL, "time"], ignore_index=True)
        starts = group_starts(rows, CHANNEL)
        size = np.diff([*starts, len(rows)])
        place = np.arange(len(rows)) - np.repeat(starts, size)
        known, x = rows["known"].to_numpy(bool), rows["trsl"].to_numpy("float64")
        pos = place + np.repeat(np.where(known[starts], rows["pos"].to_numpy("float64")[starts], 0).astype("int64"), size)
        full = np.flatnonzero(~known & (place >= roll - 1))
        wet = np.where(known, rows["wet"].to_numpy("float64"), 0.0)
        if len(full):
            wet[full] = np.std(np.lib.stride_tricks.sliding_window_view(x, roll)[full - roll + 1], axis=1) > self.threshold
        given = (known, rows["baseline"].to_numpy("float64"), rows["waa"].to_numpy("float64"))
        base, up = walk(x, wet, pos, self.n, self.waa_max, self.rise, given)
        rows = rows.assign(pos=pos, wet=wet, baseline=base, waa=up)
        _hold(self.past, rows[np.repeat(size, size) - place <= back], _PAST)
        out = rows[~known]
        return out.assign(time=out["time"].to_numpy("datetime64[us]"), wet=out["wet"] == 1)[[*_WAITING, "wet", "baseline", "waa"]]

    def close(self) -> None:
        pass


def stream_baseline_ordered(
    channels: DataFrame, *, roll: int = 10, threshold: float = 0.8, n: int = 5, waa_max: float = 2.2, rise: float = 2.0, lateness: str = "30 minutes",
) -> DataFrame:
    """`live.stream_baseline` for a stream (cml_id, channel_id, time, trsl) whose rows come up to `lateness` late.

    A row is emitted once the watermark has passed it. Of rows of one channel and time the highest path loss counts.
    """
    spark = channels.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    rows = channels.withWatermark("time", lateness).withColumn("links", F.shiftright("cml_id", TOGETHER)).groupBy("links")
    return rows.transformWithStateInPandas(OrderedWalk(roll, threshold, n, waa_max, rise), OUT, "Append", "EventTime")
