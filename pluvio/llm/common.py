"""Helpers the operators share: shipping, staged tables, Arrow batches, samples and connected components."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.session import ship, stage, unstage

#: Rows of one Arrow batch. Texts are of any length, so batches are kept short.
BATCH_ROWS = 256

INTERNAL = "__llm_"
#: A sieve has at most 2^17 rows of eight words of 64 bits: some 13 MB, 67 million bits.
SIEVE_BITS = 17


def prepare(spark: SparkSession) -> None:
    """Make the package known to the workers and keep the batches sent to them small."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids whose labels are kept for measuring, never for learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def broadcast_below(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint if a count shows that df has at most so many rows; beyond it Spark shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def marked(df: DataFrame, keys: DataFrame, by: list[str], name: str) -> DataFrame:
    """df with a column that is true where its key is one of the keys (null is a key like others), and for few other rows.

    Hashes of the keys are bits of a table of bounded size, which is broadcast: rows can be told apart before they are shuffled.
    """
    types = dict(keys.dtypes)
    h, at, words = INTERNAL + "h", INTERNAL + "at", [f"{INTERNAL}w{k}" for k in range(8)]
    hashed = F.xxhash64(*(F.col(c).cast(types[c]) for c in by))
    row, word = F.expr(f"{h} & {(1 << SIEVE_BITS) - 1}"), f"shiftrightunsigned({h}, {SIEVE_BITS}) & 7"
    bit = f"cast(shiftrightunsigned({h}, {SIEVE_BITS + 3}) & 63 as int)"
    sieve = keys.select(hashed.alias(h)).withColumn(at, row).groupBy(at).agg(
        *(F.expr(f"bit_or(if({word} = {k}, shiftleft(1L, {bit}), 0L))").alias(c) for k, c in enumerate(words)))
    placed = df.withColumn(h, hashed).withColumn(at, row).join(F.broadcast(sieve), at, "left")
    own = f"element_at(array({', '.join(words)}), cast({word} as int) + 1)"
    return placed.select(*df.columns, F.expr(f"coalesce(shiftrightunsigned({own}, {bit}) & 1 = 1, false)").alias(name))


def pack_ids(ids: np.ndarray) -> bytes:
    return np.ascontiguousarray(ids, dtype="<u4").tobytes()


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    prepare(df.sparkSession)
    return df.mapInArrow(fn, schema)


def strings(column: pa.Array) -> list[str]:
    """The texts of a column; a null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) for every node of the edges.

    Each round lowers every node to the smallest label among its neighbours and then jumps to the label of that label,
    so a chain of n nodes takes about log n rounds. Edges are pointed at labels, loops go, and the rest is written to the
    shared folder each round. A node of many edges is aggregated map-side before it is shuffled.
    """
    both = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct()
    left = stage(both, "edges")
    labels = None
    for _ in range(rounds):
        if left.isEmpty():
            break
        # Every node points to its smallest neighbour or itself; roots are nodes that point to themselves.
        point = stage(
            left.select(F.col("v").alias("node"), F.col("u").alias("to"))
            .unionByName(left.select(F.col("u").alias("node"), F.col("u").alias("to")))
            .groupBy("node").agg(F.min("to").alias("to")), "point",
        )
        jumped = point
        for _ in range(2):
            far = jumped.select(F.col("node").alias("to"), F.col("to").alias("far"))
            jumped = jumped.join(far, "to", "left").select("node", F.coalesce("far", "to").alias("to"))
        jumped = stage(jumped, "jumped")
        unstage(point)
        old = labels
        if labels is None:
            labels = jumped
        else:
            step = jumped.select(F.col("node").alias("to"), F.col("to").alias("far"))
            labels = labels.join(step, "to", "left").select("node", F.coalesce("far", "to").alias("to"))
        labels = stage(labels, "labels")
        if old is not None:
            unstage(old)
        of = jumped.select(F.col("node").alias("u"), F.col("to").alias("lu"))
        ov = jumped.select(F.col("node").alias("v"), F.col("to").alias("lv"))
        fewer = stage(
            left.join(of, "u").join(ov, "v")
            .select(F.least("lu", "lv").alias("u"), F.greatest("lu", "lv").alias("v")).where("u < v").distinct(),
            "edges",
        )
        unstage(left, jumped)
        left = fewer
    else:
        raise RuntimeError("components did not settle")
    if labels is None:
        return left.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels.select("node", F.col("to").alias("component"))


def keep_rows(df: DataFrame, mask: Callable[[], Callable[[list[str]], np.ndarray]], text: str = "text") -> DataFrame:
    """Rows whose text the mask keeps, with the columns of df. mask() is called once per task."""

    def kept(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = mask()
        for part in parts:
            if part.num_rows:
                yield part.filter(pa.array(decide(strings(part.column(text)))))

    prepare(df.sparkSession)
    return df.mapInArrow(kept, df.schema)


def score_rows(df: DataFrame, scorer: Callable[[], Callable[[list[str]], np.ndarray]], keys: list[str], text: str = "text",
               name: str = "score") -> DataFrame:
    """The keys of df and a number for each text. scorer() is called once per task."""

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        for part in parts:
            if part.num_rows:
                values = pa.array(np.asarray(score(strings(part.column(part.num_columns - 1))), np.float64))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], values], names=[*keys, name])

    prepare(df.sparkSession)
    picked = df.select(*keys, F.col(text).alias(INTERNAL + "text"))
    fields = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return picked.mapInArrow(scored, f"{fields}, `{name}` double")


def taught_ids(labels: DataFrame, label: str, per_class: int, key: str = "doc_id") -> DataFrame:
    """At most per_class ids of either label, by a hash of the id, none of them held out: a broadcast of known size."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
    known = known.groupBy(key).agg(F.max(label).alias("label"))
    parts = [
        known.where(F.col("label") == side).orderBy(F.xxhash64(key), key).limit(per_class).select(key, "label")
        for side in (0, 1)
    ]
    return F.broadcast(parts[0].unionByName(parts[1]))
