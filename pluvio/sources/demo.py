"""Telemetry, sites, links and regular series derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.config import FieldNames

NAMES = FieldNames(
    rx=("rx_primary", "rx_fallback"), tx=("tx_primary", "tx_fallback"), temperature="temperature"
)
STEP_MINUTES = 1440
STEP_SECONDS = STEP_MINUTES * 60


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table; its schema is read from the file footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types stand for fields, users for hosts."""
    kind, eid, value = F.col("event_type"), F.col("event_id"), F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("time"),
        F.concat(F.lit("h"), "user_id").alias("agent_host"),
        F.when(kind == "view", NAMES.rx[0])
        .when(kind == "click", NAMES.rx[1])
        .when(kind == "purchase", NAMES.tx[0])
        .when(kind == "signup", NAMES.tx[1])
        .otherwise(NAMES.temperature)
        .alias("field"),
        F.when(
            kind.isin("view", "click"),
            F.when(eid % 97 == 0, 0.0).otherwise(-(30 + eid % 45 + value / 1000)),
        )
        .when(kind.isin("purchase", "signup"), 5 + eid % 37 + value / 1000)
        .otherwise(10 + eid % 25 + value / 1000)
        .alias("value"),
    )


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    # One division each, so that coordinates are the doubles nearest to their decimals.
    lon = (F.lit(1150) + 5 * (key % 150)) / 100.0
    lat = (F.lit(4820) + 5 * (F.floor(key / 150) % 60)) / 100.0
    return table(spark, sf_dir, "supplier").select(
        key.alias("ID"),
        F.col("s_name").alias("address"),
        lon.alias("X_coordinate"),
        lat.alias("Y_coordinate"),
        (lon + 0.001).alias("X_dummy_coordinate"),
        (lat + 0.001).alias("Y_dummy_coordinate"),
        F.col("s_nationkey").alias("technology"),
    )


def raw_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link k joins site k with the next site; the last one goes back to site 0."""
    a = sites(spark, sf_dir)
    first = a.agg(F.min("ID").alias("first"), F.max("ID").alias("last"))
    key = F.col("ID")
    freq = F.lit(7000) + 1000 * (key % 74)
    return a.crossJoin(F.broadcast(first)).select(  # one row of two scalars
        "ID",
        F.concat(F.lit("h"), (2 * key).cast("string")).alias("IP_address_A"),
        F.concat(F.lit("h"), (2 * key + 1).cast("string")).alias("IP_address_B"),
        freq.alias("frequency_A"),
        (freq + F.when(key % 5 == 0, 0).otherwise(500)).alias("frequency_B"),
        F.when(key % 3 == 0, "H").when(key % 3 == 1, "V").otherwise("X").alias("polarization"),
        key.alias("site_A"),
        F.when(key == F.col("last"), F.col("first")).otherwise(key + 1).alias("site_B"),
        "technology",
    )


def technologies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("ID"), F.col("n_regionkey").alias("influx_mapping_ID")
    )


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("ID"),
        F.when(F.col("r_regionkey") == 0, "summit")
        .when(F.col("r_regionkey") == 1, "summit_bt")
        .otherwise(F.col("r_name"))
        .alias("measurement"),
    )


def excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites(spark, sf_dir).where("ID % 13 = 0").select(F.col("ID").alias("cml_id"))


def regular_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means per supplier: (cml_id, time, x, y, temp, rain, uptime).

    One row per series and day, however many line items a supplier has.
    """
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("cml_id"), F.col("l_shipdate").cast("timestamp").alias("time"))
        .agg(
            F.avg("l_quantity").alias("x"),
            F.avg(F.col("l_extendedprice") / 1000).alias("y"),
            F.avg(F.col("l_tax") * 100).alias("temp"),
            F.greatest(F.min("l_discount") * 100 - 5, F.lit(0.0)).alias("rain"),
            F.max("l_orderkey").alias("uptime"),
        )
    )
