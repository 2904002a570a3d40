"""Telemetry: long rows (time, agent_host, field, value) to one wide row per host and step."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.config import FieldNames
from pluvio.functions.missing import null_if_nan

SCHEMA = "time timestamp, agent_host string, field string, value double"
WIDE = ("rx_power", "tx_power", "temperature")
BROADCAST_HOSTS = 200_000  # names, some 10 MB


def read(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, best partitioned by date so that the range predicate prunes files."""
    return spark.read.schema(SCHEMA).parquet(path)


def scan(
    telemetry: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    names: FieldNames = FieldNames(),
    temperature: bool = True,
) -> DataFrame:
    """Rows of [start, end) with the fields in use; predicates reach the Parquet scan."""
    wanted = [*names.rx, *names.tx] + ([names.temperature] if temperature else [])
    rows = telemetry.where(F.col("field").isin(wanted))
    if start is not None:
        rows = rows.where(F.col("time") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("time") < F.lit(end))
    return rows


def few(rows: DataFrame, limit: int) -> bool:
    """True if there are at most `limit` rows; counts no further than that."""
    return rows.limit(limit + 1).count() <= limit


def of_hosts(telemetry: DataFrame, hosts: DataFrame, limit: int = BROADCAST_HOSTS) -> DataFrame:
    """Rows of the given hosts only.

    A list of at most `limit` hosts is broadcast, so raw rows are filtered where they are read.
    A longer one is joined by shuffle; prefer to build the step means first then.
    """
    wanted = hosts.select("agent_host")
    if few(wanted, limit):
        wanted = F.broadcast(wanted)
    return telemetry.join(wanted, "agent_host", "left_semi")


def step_means(
    telemetry: DataFrame,
    seconds: int,
    names: FieldNames = FieldNames(),
    temperature: bool = True,
) -> DataFrame:
    """Mean per host, field and step, one column per logical field, labelled by the step's end.

    Means are built before the shuffle, so a host with very many raw rows sends one row per step
    and task. Conditional means stand in for a pivot, which streaming does not offer.
    """
    value = null_if_nan(F.col("value"))

    def mean(name: str):
        return F.avg(F.when(F.col("field") == name, value))

    wide = [
        F.coalesce(mean(names.rx[0]), mean(names.rx[1])).alias("rx_power"),
        F.coalesce(mean(names.tx[0]), mean(names.tx[1])).alias("tx_power"),
    ]
    if temperature:
        wide.append(mean(names.temperature).alias("temperature"))
    out = telemetry.groupBy("agent_host", F.window("time", f"{seconds} seconds")).agg(*wide)
    if not temperature:
        out = out.withColumn("temperature", F.lit(None).cast("double"))
    return out.select("agent_host", F.col("window.end").alias("time"), *WIDE).na.drop(
        how="all", subset=list(WIDE)
    )


def keep_last(rows: DataFrame, *order: str) -> DataFrame:
    """One row per (agent_host, time): the last in the given ingest order.

    An aggregate instead of a ranking window: the last row is chosen before the shuffle, so many
    copies of one row cost nothing there.
    """
    rest = [c for c in rows.columns if c not in ("agent_host", "time")]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy("agent_host", "time").agg(last.alias("row")).select(
        "agent_host", "time", *[F.col(f"row.{c}").alias(c) for c in rest]
    )


def union_parts(*parts: DataFrame) -> DataFrame:
    """Parts of a scan put together; columns a part lacks are missing."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def time_bounds(rows: DataFrame) -> DataFrame:
    return rows.agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"))


def host_presence(wide: DataFrame) -> DataFrame:
    return wide.agg(F.count_distinct("agent_host").alias("n_hosts"))


def latest_only(rows: DataFrame, since: datetime) -> DataFrame:
    return rows.where(F.col("time") > F.lit(since))


def per_host_rank(rows: DataFrame) -> DataFrame:
    """Rows numbered in (host, time) order."""
    return rows.withColumn(
        "row_no", F.row_number().over(Window.partitionBy("agent_host").orderBy("time"))
    )
