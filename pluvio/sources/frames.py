"""Stored rain frames and frame records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_frames(spark: SparkSession, path: str, value: str = "v") -> DataFrame:
    """Frames as written, values rounded half-even to 3 decimals."""
    return rounded(spark.read.parquet(path), value)


def rounded(frames: DataFrame, value: str = "r") -> DataFrame:
    return frames.withColumn(value, F.rint(F.col(value) * 1000.0) / 1000.0)


def latest_record(records: DataFrame) -> DataFrame:
    """The newest (time, links) row, its JSON id list decoded."""
    newest = records.orderBy(F.col("time").desc()).limit(1)
    return newest.select("time", F.from_json("links", "array<bigint>").alias("links"))
