"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_own_folders: dict[str, str] = {}
_scopes: list[str] = []


def local_session(cores: str = "*", partitions: int = 8, memory: str = "20g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pluvio")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Call sites of every column expression are only wanted when debugging.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    package = os.path.dirname(os.path.abspath(__file__))
    done = spark.sparkContext.applicationId
    if done in _shipped:
        return
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="pluvio-"), "pluvio"), "zip", os.path.dirname(package), "pluvio"
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(done)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one in local runs only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="pluvio-")
    return _own_folders[application]


def _stage_root(spark: SparkSession) -> str:
    return "/".join([shared_folder(spark), "stage", spark.sparkContext.applicationId, *_scopes])


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables made inside are deleted at the end; what reads them must be written by then."""
    _scopes.append(f"scope-{uuid.uuid4().hex}")
    root = _stage_root(spark)
    try:
        yield
    finally:
        _scopes.pop()
        _delete(spark, root)


@contextmanager
def spent_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run inside delete their shuffle files when they end, instead of when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    The written table cuts the lineage and survives lost executors; the shuffle files that led to it are deleted.
    """
    spark = df.sparkSession
    path = f"{_stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    with spent_shuffles(spark):
        df.write.mode("errorifexists").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Delete tables that stage() returned; what reads them must be written by then."""
    for df in tables:
        _delete(df.sparkSession, df.staged_at)
