"""Hard negatives: for anchors and their nearest rows of the same label, the highest-scored rows of other labels within a band.

Components become floor(scale * x); a score is the integer inner product with the anchor, higher first, ties to the smaller vec_id.
Rows are dealt into blocks by a hash of the id, whatever their label, and every anchor is sent to every block. A block keeps one-bit
codes (see onebit.py); their intervals leave out rows that cannot be among the best of the block, and all others are scored in
integers. The blocks' best are then ranked together. The search runs twice: for positives, then for negatives between
low * positive score and high * positive score, in per cent.

Rows with a null id or label, a vector null, empty, or with null or non-finite components take no part; of rows of one id the smallest by
label and vector counts. Vectors of different dimensions are never compared. A positive without a negative in its band has no rows. Scores are
exact at any size; one beyond a long is returned as the nearest long, though ranked and compared as it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.llm.bigints import beyond, clamped, exact, fits, products, quantise
from pluvio.llm.common import batches, table
from pluvio.llm.onebit import Codes, turned
from pluvio.llm.vectors import matrix
from pluvio.session import stage

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
#: Rows of a block: the most, and the fewest wanted while there are tasks to spare.
BLOCK_ROWS, FEWEST = 65536, 2048


def usable(df: DataFrame, label: Column, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, label, v (doubles) of the rows that take part, one for each id."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)).where(~bad)
    rows = rows.select(F.col(key).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    least = rows.where("label IS NOT NULL").groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("least"))
    return least.select("vec_id", "least.*")


class Block:
    """Stored rows of one block: quantised vectors, labels, codes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, scale: int):
        self.ids, self.labels, self.v, self.scale = ids, labels, quantise(v, scale), scale
        self.codes = Codes(self.v) if fits(self.v, self.v) else None

    def queries(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        q = quantise(v, self.scale)
        return q, turned(q) if fits(q, q) else None

    def bounds(self, q: np.ndarray, rotated: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Where the scores surely lie; anywhere, if integers are too large for doubles."""
        if self.codes is None or rotated is None or not fits(self.v, q[None]):
            return np.full(len(self.ids), -np.inf), np.full(len(self.ids), np.inf)
        return self.codes.intervals(rotated)

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k highest as (score, row), ties to the smaller id."""
        if scores.dtype != object and len(rows) > 4 * k:
            some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            rows, scores = rows[some], scores[some]
        pairs = sorted(zip((-s for s in scores.tolist()), self.ids[rows].tolist(), rows.tolist(), strict=True))
        return [(-s, r) for s, _, r in pairs[:k]]


def _survivors(low: np.ndarray, high: np.ndarray, sure: np.ndarray, k: int) -> np.ndarray:
    """Which rows can be among the k highest, given that `sure` rows count whatever their score is within its interval."""
    if sure.sum() < k:
        return np.ones(len(low), bool)
    floors = low[sure]
    return high >= np.partition(floors, len(floors) - k)[len(floors) - k]


def positives_of(k: int) -> Callable:
    def find(block: Block, who: int, label: int, q: np.ndarray, rotated, _) -> Iterator[tuple]:
        rows = np.flatnonzero((block.labels == label) & (block.ids != who))
        if len(rows):
            low, high = (x[rows] for x in block.bounds(q, rotated))
            rows = rows[_survivors(low, high, np.ones(len(rows), bool), k)]
            for score, row in block.best(rows, products(block.v[rows], q), k):
                yield who, None, int(block.ids[row]), clamped(score), beyond(score), None, None

    return find


def negatives_of(k: int, low_share: int, high_share: int) -> Callable:
    def find(block: Block, who: int, label: int, q: np.ndarray, rotated, bands) -> Iterator[tuple]:
        rows = np.flatnonzero(block.labels != label)
        if not len(rows) or not bands:
            return
        low, high = (x[rows] for x in block.bounds(q, rotated))
        limits = [(p, s, m, *_band(exact(s, m), low_share, high_share)) for p, s, m in bands]
        wanted = np.zeros(len(rows), bool)
        for *_, least, most in limits:
            maybe = (high >= _down(least)) & (low <= _up(most))
            sure = maybe & (low >= _up(least)) & (high <= _down(most))
            wanted |= maybe & _survivors(low, high, sure, k)
        rows = rows[wanted]
        if not len(rows):
            return
        scores = products(block.v[rows], q)
        for positive, s, m, least, most in limits:
            inside = np.array((scores >= least) & (scores <= most), bool)
            for score, row in block.best(rows[inside], scores[inside], k):
                yield who, positive, int(block.ids[row]), clamped(score), beyond(score), s, m

    return find


def _band(score: int, low_share: int, high_share: int) -> tuple[int, int]:
    """The least and the greatest integer n with low * score <= 100 * n <= high * score."""
    return -((-low_share * score) // 100), (high_share * score) // 100


def _up(n: int) -> float:
    """A double that is not below n."""
    return float("inf") if n > 1e300 else float("-inf") if n < -1e300 else np.nextafter(float(n), np.inf)


def _down(n: int) -> float:
    return -_up(-n)


_SENT = "dims int, block int, kind int, vec_id long, label long, v array<double>, bands array<struct<positive_id: bigint, score: bigint, more: binary>>"
_FOUND = "anchor_id long, positive_id long, vec_id long, score long, more binary, positive_score long, positive_more binary"


def _searched(stored: DataFrame, anchors: DataFrame, blocks: int, scale: int, find: Callable) -> DataFrame:
    """What find yields for every block and anchor. Only the stored rows of one block are held; its anchors stream."""
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None
        for part in parts:
            if not part.num_rows:
                continue
            keys = np.stack([part.column(i).to_numpy() for i in range(3)], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if tuple(keys[a, :2]) != key:
                    key, held, block = tuple(keys[a, :2]), [], None
                some = part.slice(a, b - a)
                ids, labels, v = some.column(3).to_numpy(), some.column(4).to_numpy(), matrix(some.column(5))
                if keys[a, 2] == 0:
                    held.append((ids, labels, v))
                    continue
                if not held:
                    continue
                block = block or Block(*(np.concatenate(c) for c in zip(*held, strict=True)), scale)
                q, rotated = block.queries(v)
                bands = [[(x["positive_id"], x["score"], x["more"]) for x in row or ()] for row in some.column(6).to_pylist()]
                out = [r for i in range(len(ids)) for r in find(block, int(ids[i]), int(labels[i]), q[i], None if rotated is None else rotated[i], bands[i])]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    of = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    none = F.lit(None).cast("array<struct<positive_id: bigint, score: bigint, more: binary>>")
    dealt = stored.select(F.size("v").alias("dims"), of.alias("block"), F.lit(0).alias("kind"), "vec_id", "label", "v", none.alias("bands"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asked = anchors.select(F.size("v").alias("dims"), every.alias("block"), F.lit(1).alias("kind"), "vec_id", "label", "v", "bands")
    sent = dealt.unionByName(asked).repartition("dims", "block").sortWithinPartitions("dims", "block", "kind")
    return batches(sent, run, _FOUND)


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc_nulls_last("more"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE, block_rows: int = BLOCK_ROWS, fewest: int = FEWEST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. rows: from usable."""
    rows = stage(rows, "vectors")
    n = rows.count()
    # At least as many blocks as keep them bounded; more, up to a few for each core, while they do not get small.
    spare = min(-(-n // fewest), 4 * rows.sparkSession.sparkContext.defaultParallelism)
    blocks = max(1, -(-n // block_rows), spare)
    none = F.lit(None).cast("array<struct<positive_id: bigint, score: bigint, more: binary>>")
    anchors = rows.where(is_anchor).withColumn("bands", none)
    near = _ranked(_searched(rows, anchors, blocks, scale, positives_of(positives)), ["anchor_id"], positives)
    bands = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct(F.col("vec_id").alias("positive_id"), "score", "more")).alias("bands"))
    known = stage(anchors.drop("bands").join(bands, "vec_id").select("vec_id", "label", "v", "bands"), "anchors")
    hard = _ranked(_searched(rows, known, blocks, scale, negatives_of(negatives, low, high)), ["anchor_id", "positive_id"], negatives)
    return hard.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_onebit_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(usable(table(spark, sf_dir, "embeddings"), moved), F.col("vec_id") % 100 == 0)
