"""Time expressions. The session time zone is UTC; naive input counts as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FRAME_NAME = "yyyy-MM-dd_HHmm"


def unix_seconds(time: Column) -> Column:
    return F.unix_timestamp(time.cast("timestamp"))


def rfc3339(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def frame_name(time: Column) -> Column:
    return F.date_format(time, FRAME_NAME)


def frame_time(name: Column) -> Column:
    """Time in a frame name; NULL if the name does not start with one."""
    stamp = F.regexp_extract(name, r"^(\d{4}-\d{2}-\d{2}_\d{4})(?:[_.].*)?$", 1)
    return F.try_to_timestamp(stamp, F.lit(FRAME_NAME))


def floor_minutes(time: Column, minutes: int) -> Column:
    """Start of the step a time lies in, steps counted from the epoch."""
    seconds = minutes * 60
    t = unix_seconds(time)
    return F.timestamp_seconds(t - F.pmod(t, F.lit(seconds)))


def on_step(time: Column, minutes: int) -> Column:
    """True if the time lies exactly on a multiple of the step."""
    return F.pmod(F.unix_micros(time.cast("timestamp")), F.lit(minutes * 60_000_000)) == 0
