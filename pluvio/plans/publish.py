"""Writing products and expiring old ones."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from pluvio.config import TRAILING_WINDOWS, Settings
from pluvio.functions.clock import frame_name
from pluvio.operators import products
from pluvio.plans.fields import Products, with_info
from pluvio.session import stage

DATE = "frame_date"


def _by_date(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumn(DATE, F.to_date(time))


def _stored(spark: SparkSession, path: str, schema: T.StructType, kind: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _merge(new: DataFrame, path: str, kind: str, keys: list[str], parts: list[str], replaced: DataFrame) -> None:
    """Write new rows, and keep the stored rows of the dates they touch whose keys are not among the replaced ones.

    replaced: the keys and the date. Stored and new rows are put together beside the table first, in a folder that readers do not
    see, and marked as complete there; only then are the dates rewritten, and the folder deleted after that. A write that was lost in
    between is finished by the next one, or by `recover`, from what lies there; nothing of the dates is lost.
    """
    recover(new.sparkSession, path, kind, parts)
    replaced = stage(replaced.select(*keys, DATE).distinct(), "replaced")
    stored = _stored(new.sparkSession, path, new.schema, kind)
    if stored is not None:
        touched = stored.join(replaced.select(DATE).distinct(), DATE, "left_semi")
        kept = touched.join(replaced.select(*keys), keys, "left_anti").select(*new.columns)
        new = kept.unionByName(new)
    folder = f"{path}/{PENDING}/{uuid.uuid4().hex}"
    new.write.parquet(f"{folder}/rows")
    _fs(new.sparkSession, folder)[0].create(_path(new.sparkSession, f"{folder}/{READY}")).close()
    recover(new.sparkSession, path, kind, parts)


PENDING, READY = "_pending", "READY"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    at = _path(spark, path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def recover(spark: SparkSession, path: str, kind: str, parts: list[str]) -> int:
    """Finish the writes below `path` that were complete beside the table but not in it, and drop those that were not.

    A table has one writer at a time.
    """
    fs, folder = _fs(spark, f"{path}/{PENDING}")
    finished = 0
    for entry in sorted(fs.listStatus(folder), key=lambda e: e.getModificationTime()) if fs.exists(folder) else []:
        at = entry.getPath()
        if fs.exists(_path(spark, f"{at.toString()}/{READY}")):
            try:
                _rewrite(spark.read.parquet(f"{at.toString()}/rows"), path, kind, parts)
            except AnalysisException as error:
                if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # no rows, no files
                    raise
            finished += 1
        fs.delete(at, True)
    return finished


def _rewrite(rows: DataFrame, path: str, kind: str, parts: list[str]) -> None:
    """Replace the partitions that the rows lie in."""
    rows.write.format(kind).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).save(path)


def write_frames(frames: DataFrame, path: str, times: DataFrame | None = None) -> None:
    """Frames partitioned by date. `times` are the steps that were made; stored frames of other times stay."""
    out = _by_date(frames).withColumn("utc", frame_name(F.col("time")))
    _merge(out, path, "parquet", ["time"], [DATE], _by_date(frames if times is None else times))


def write_info(info: DataFrame, path: str) -> None:
    """Summaries as JSON lines, one per frame; stored summaries of other times stay."""
    out = _by_date(info)
    _merge(out, path, "json", ["utc"], [DATE], out)


def write_points(points: DataFrame, path: str) -> None:
    """Series rows (cml_id, time in seconds, field, value), missing values included as they come; a stored row of the same
    link, time and field is replaced, all others stay."""
    out = points.withColumn(DATE, F.to_date(F.timestamp_seconds("time")))
    _merge(out, path, "parquet", ["cml_id", "field", "time"], ["field", DATE], out)


def written_names(spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Names of the frames whose summary (or, as parquet, whose cells) is already there; empty before the first run."""
    schema = T.StructType().add("utc", "string").add(DATE, "date")
    stored = _stored(spark, path, schema, kind)
    return spark.createDataFrame([], "name string") if stored is None else stored.select(F.col("utc").alias("name")).distinct()


def new_times(made: Products, spark: SparkSession, path: str, kind: str = "json") -> DataFrame:
    """Steps whose frame is not stored yet."""
    times = made.links.select("time").distinct()
    return stage(products.not_yet_written(times, written_names(spark, path, kind)).select("time"), "new-times")


def at_times(rows: DataFrame | None, times: DataFrame | None) -> DataFrame | None:
    return rows if rows is None or times is None else rows.join(times, "time", "left_semi")


def only_new(made: Products, spark: SparkSession, path: str) -> Products:
    """Products without the steps that were written before."""
    times = new_times(made, spark, path)
    return replace(
        made, frames=at_times(made.frames, times), frames_sum=at_times(made.frames_sum, times),
        info=at_times(made.info, times), info_sum=at_times(made.info_sum, times),
    )


def stored_frames(made: Products, root: str) -> Products:
    """The products with their frames read back, over the times of the link series."""
    spark = made.links.sparkSession
    span = made.links.agg(F.to_date(F.min("time")).alias("a"), F.to_date(F.max("time")).alias("b")).first()

    def read(name: str) -> DataFrame:
        rows = spark.read.parquet(f"{root}/{name}").where(F.col(DATE).between(span["a"], span["b"])).drop(DATE, "utc")
        return rows.join(made.links.select("time").distinct(), "time", "left_semi")

    return replace(
        made, frames=read("frames"), frames_sum=None if made.frames_sum is None else read("frames_sum")
    )


def publish(made: Products, root: str, cfg: Settings, *, since: datetime | None = None, skip_written: bool = False) -> None:
    """Write frames, summaries and series below `root`; what is stored of other times stays.

    `since` limits the series to newer times; `skip_written` leaves steps alone whose summary (without summaries: whose
    frame) is stored.
    """
    spark = made.links.sparkSession
    new = None
    if skip_written:
        new = new_times(made, spark, f"{root}/info") if cfg.output.flags else new_times(made, spark, f"{root}/frames", "parquet")
    after = None if since is None else F.lit(since)
    times = made.links.select("time").distinct() if new is None else new
    summed = made
    if cfg.output.frames:
        write_frames(at_times(made.frames, new), f"{root}/frames", times)
        if made.frames_sum is not None:
            write_frames(at_times(made.frames_sum, new), f"{root}/frames_sum", times)
        # Summaries of the frames just written, so that they are not interpolated again.
        summed = with_info(stored_frames(made, root), cfg)
    if cfg.output.flags:
        write_info(at_times(summed.info, new), f"{root}/info")
        if summed.info_sum is not None:
            write_info(at_times(summed.info_sum, new), f"{root}/info_sum")
    if cfg.output.intensities:
        write_points(products.intensity_points(made.links, after), f"{root}/series")
    if cfg.hour_sum.enabled and cfg.hour_sum.write_series:
        write_points(products.hour_sum_points(made.links, after), f"{root}/series")


def expire(spark: SparkSession, path: str, now: datetime, window: str) -> tuple[int, int]:
    """Delete date partitions that end before the retained window: (deleted, kept)."""
    limit = (now - TRAILING_WINDOWS[window]).date().isoformat()
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    deleted = kept = 0
    for status in fs.listStatus(root) if fs.exists(root) else []:
        name = status.getPath().getName()
        if not name.startswith(f"{DATE}="):
            continue
        if name.split("=", 1)[1] < limit:
            fs.delete(status.getPath(), True)
            deleted += 1
        else:
            kept += 1
    return deleted, kept
