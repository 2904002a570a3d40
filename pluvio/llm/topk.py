"""Exact top-k by integer inner product, by best-first search of M-trees (see mtree.py).

Components become floor(256 * x). A vector x of squared length at most M gets one more coordinate, sqrt(M - x.x), and a query
gets 0 there; then the distance falls as the inner product rises, and the distances of an M-tree bound it. Rows are dealt into cells
by their nearest of some pivots, a cell into trees of bounded size; every query searches every tree with a bound that a sample of
rows has already set. The sample only sets the bound: all rows are searched, and scores are integers, so results are exact.
Vectors with integers too large for exact products in doubles stay out of the trees; what they score, as rows or as queries, is worked out
in Python integers, block by block. A score beyond a long is given as the nearest long, though ranked as it is.

Vectors null, empty or holding null or non-finite components take no part, zero vectors do; vectors of different dimensions are
never compared; rows of the query's own id are no candidates, and of repeated rows of an id the best counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.llm.bigints import beyond, clamped, products, quantise
from pluvio.llm.common import batches, table
from pluvio.llm.mtree import MTree
from pluvio.llm.vectors import best, in_groups, matrix, valid
from pluvio.session import stage

SCALE, K = 256, 5
#: Rows of one tree; pivots that make cells; rows of the sample that sets the first bound.
TREE_ROWS, CELLS, SAMPLE = 8192, 32, 2048


#: Integers up to this size have exact products in trees, for up to 2,048 dimensions.
NARROW = float(1 << 21)
#: Rows of a block that is scored in Python integers.
WIDE_ROWS = 4096


def quantized(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """Rows with small integers, which are exact in doubles."""
    return rows.where(~wide(scale)).withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))


def wide(scale: int = SCALE) -> Column:
    return F.exists("v", lambda x: F.abs(x) >= NARROW / scale) | (F.size("v") > 2048)


def _scored(k: int, scale: int):
    def search(ids: np.ndarray, v: np.ndarray):
        rows = quantise(v, scale)

        def find(queries: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
            out = []
            for who, point in zip(queries.tolist(), quantise(q, scale), strict=True):
                found: dict[int, int] = {}
                for name, score in zip(ids.tolist(), products(rows, point).tolist(), strict=True):
                    if name != who:
                        found[name] = max(score, found.get(name, score))
                for name in sorted(found, key=lambda n: (-found[n], n))[:k]:
                    out.append((who, name, clamped(found[name]), beyond(found[name])))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                                              names=["query_id", "vec_id", "score", "more"])

        return find

    return search


def scored(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, vec_id, score, more: at least the k best of all vectors for all queries, in Python integers where doubles do not do."""
    blocks = F.lit(max(1, -(-vectors.count() // WIDE_ROWS)))
    stored = vectors.select("dims", F.pmod(F.xxhash64("vec_id"), blocks).cast("int").alias("block"), F.lit(0).alias("kind"), "vec_id", "v")
    asked = queries.select("dims", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))).alias("block"), F.lit(1).alias("kind"), "vec_id", "v")
    return in_groups(stored.unionByName(asked), ["dims", "block"], "query_id long, vec_id long, score long, more binary", _scored(k, scale))


def dealt(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """dims, cell, turn (a running number within the task), vec_id, v."""
    sent = rows.sparkSession.sparkContext.broadcast(pivots)

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, turn = sent.value, 0
        for part in parts:
            n, dims = part.num_rows, part.column(2).to_numpy()
            cell = np.zeros(n, np.int32)
            mine = np.flatnonzero(dims == pivots.shape[1])
            if len(mine):
                x = matrix(part.take(pa.array(mine)).column(1))
                cell[mine] = ((x * x).sum(axis=1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(axis=1)).argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column(2), pa.array(cell), pa.array(np.arange(turn, turn + n), pa.int64()), part.column(0), part.column(1)],
                names=["dims", "cell", "turn", "vec_id", "v"])
            turn += n

    return batches(rows, deal, "dims int, cell int, turn long, vec_id long, v array<double>")


def _searcher(k: int, most: dict[int, float], sent):
    def search(ids: np.ndarray, v: np.ndarray):
        length = most[v.shape[1]]
        extra = np.sqrt(np.maximum(0.0, length - (v * v).sum(axis=1)))
        tree = MTree(np.concatenate([v, extra[:, None]], axis=1))
        sample_ids, sample = sent.value.get(v.shape[1], (np.zeros(0, np.int64), np.zeros((0, v.shape[1]))))

        def find(queries: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
            out: tuple[list, list, list] = ([], [], [])
            for who, point in zip(queries.tolist(), q, strict=True):
                norm = float(point @ point)
                known = np.sort((sample @ point)[sample_ids != who])
                floor = float(known[-k]) if len(known) >= k else -np.inf
                scores: dict[int, float] = {}

                def bound_of(score: float, norm: float = norm) -> float:
                    return np.inf if score == -np.inf else float(np.sqrt(max(0.0, norm + length - 2 * score)))

                def leaf(rows, who=who, point=point, scores=scores, bound_of=bound_of) -> float:
                    # Products of integers below 2**53 are exact in doubles.
                    nonlocal floor
                    near = v[rows] @ point
                    some = np.flatnonzero(near >= floor)
                    for name, score in zip(ids[rows[some]].tolist(), near[some].tolist(), strict=True):
                        if name != who and score > scores.get(name, -np.inf):
                            scores[name] = score
                    if len(some) and len(scores) >= k:
                        top = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
                        floor = max(floor, top[-1][1])
                        scores.clear()
                        scores.update(top)
                    return bound_of(floor)

                tree.search(np.append(point, 0.0), bound_of(floor), leaf)
                for name in sorted(scores, key=lambda n: (-scores[n], n))[:k]:
                    out[0].append(who)
                    out[1].append(name)
                    out[2].append(int(scores[name]))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["query_id", "vec_id", "score"])

        return find

    return search


def top(vectors: DataFrame, queries: DataFrame, k: int = K, tree_rows: int = TREE_ROWS, cells: int = CELLS, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score for every valid query. vectors, queries: quantized."""
    spark = vectors.sparkSession
    squared = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    most = {r.dims: float(r.most) for r in vectors.groupBy("dims").agg(F.max(squared).alias("most")).collect()}  # a row per dimension
    some = vectors.dropDuplicates(["vec_id"]).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    by_dims: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for d in {r.dims for r in some}:
        own = [r for r in some if r.dims == d]
        by_dims[d] = (np.array([r.vec_id for r in own]), np.array([r.v for r in own], np.float64).reshape(len(own), d))
    usual = max(by_dims.values(), key=lambda x: len(x[0]))[1] if by_dims else np.zeros((1, 1))
    rows = stage(dealt(vectors, usual[:cells]), "cells")
    sizes = sorted(tuple(r) for r in rows.groupBy("dims", "cell").count().collect())  # a row per dimension and cell
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    place, trees, at = [], {}, 0
    for dims, cell, n in sizes:
        parts = -(-n // tree_rows)
        place.append((dims, cell, at, parts))
        trees.setdefault(dims, [at, at])[1] = at + parts
        at += parts
    places = F.broadcast(spark.createDataFrame(place, "dims int, cell int, base int, parts int"))
    spans = F.broadcast(spark.createDataFrame([(d, a, b - 1) for d, (a, b) in trees.items()], "dims int, first int, last int"))
    stored = rows.join(places, ["dims", "cell"]).select(
        (F.col("base") + F.pmod("turn", "parts")).cast("int").alias("tree"), F.lit(0).alias("kind"), "vec_id", "v")
    asked = queries.join(spans, "dims").select(F.explode(F.sequence("first", "last")).alias("tree"), F.lit(1).alias("kind"), "vec_id", "v")
    found = in_groups(stored.unionByName(asked), ["tree"], "query_id long, vec_id long, score long",
                      _searcher(k, most, spark.sparkContext.broadcast(by_dims)))
    return best(found, k)


def search(rows: DataFrame, is_query: Column, k: int = K, **sizes) -> DataFrame:
    """query_id, rank, vec_id, score for the queries among the rows. rows: from valid()."""
    small, large = quantized(rows), rows.where(wide())
    found = top(small, small.where(is_query), k, **sizes)
    if large.isEmpty():
        return found
    pairs = scored(large, rows.where(is_query), k).unionByName(scored(rows.where(~wide()), large.where(is_query), k))
    pairs = pairs.unionByName(found.select("query_id", "vec_id", "score", F.lit(None).cast("binary").alias("more")))
    once = pairs.groupBy("query_id", "vec_id").agg(F.max(F.struct("score", "more")).alias("s")).select("query_id", "vec_id", "s.*")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc_nulls_last("more"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_mtree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid(table(spark, sf_dir, "embeddings"), zero_too=True)
    return search(rows, F.col("vec_id") % 50 == 0)
