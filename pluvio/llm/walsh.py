"""Centroid clustering of integer vectors, searched through their Walsh-Hadamard transform.

Components become floor(scale * x). The integer transform of a vector and that of a centroid differ by `dims` times their squared
distance, and any part of the coefficients gives a lower bound. Coefficients are ordered by sign changes, coarse first; partial sums
grow over the first 4, 8, 16, ... of them. After each part, the centroid in the lead is finished over all coefficients, and centroids
whose partial sum is above that are strictly worse and go. Those left are finished over all coefficients, so the nearest one is exact.

Vectors of another length, null, or with null or non-finite components take no part. Rows without an id take part but start no
centroid; repeated rows count as often as they come, and of rows of one id the smaller vector goes first. With fewer rows than centroids
wanted there are fewer centroids, without rows the result is empty. Sums and distances are exact for any finite component (Python
integers where 64 bits might not do); distances and inertias beyond a long are given as the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm.bigints import LONG_MAX, quantise, whole
from pluvio.llm.common import batches, table
from pluvio.llm.vectors import matrix
from pluvio.session import stage

CLUSTERS, ROUNDS, SCALE, DIMS, SEED = 8, 10, 1024, 64, "3"
#: Vectors with larger integers (and 64 dimensions) are computed in Python integers.
NARROW = 1 << 24
LIMB = 32


def _order(dims: int) -> np.ndarray:
    """Rows of the Hadamard matrix by sign changes."""
    rows = np.ones((1, 1), np.int64)
    while len(rows) < dims:
        rows = np.block([[rows, rows], [rows, -rows]])
    return np.argsort((rows[:, 1:] != rows[:, :-1]).sum(axis=1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """The integer Walsh-Hadamard transform of every row, coarse coefficients first. Longs or Python integers."""
    n, dims = x.shape
    order, h = _order(dims), 1
    while h < dims:
        x = x.reshape(n, dims // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, dims)
        h *= 2
    return x[:, order]


def restore(t: np.ndarray) -> np.ndarray:
    """The integers of which these are the transforms."""
    plain = np.empty_like(t)
    plain[:, _order(t.shape[1])] = t
    out = transform(plain)
    back = np.empty_like(out)
    back[:, _order(t.shape[1])] = out
    return back // t.shape[1]


def _levels(dims: int) -> list[tuple[int, int]]:
    edges = [0, min(4, dims)]
    while edges[-1] < dims:
        edges.append(min(dims, 2 * edges[-1]))
    return list(zip(edges[:-1], edges[1:], strict=True))


def nearest(t: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of every row (ties: the smaller number), and how many coefficient
    differences that took. Both are transforms, of one type."""
    n, dims = t.shape
    at = np.arange(n)
    part = np.zeros((n, len(centres)), t.dtype)
    alive = np.ones(part.shape, bool)
    bound, taken = None, 0
    for a, b in _levels(dims):
        row, centre = np.nonzero(alive)
        gap = t[row, a:b] - centres[centre, a:b]
        part[row, centre] += (gap * gap).sum(axis=1)
        taken += len(row) * (b - a)
        if b == dims:
            break
        lead = np.where(alive, part, part.max() + 1 if n else 0).argmin(axis=1)
        gap = t - centres[lead]
        full = (gap * gap).sum(axis=1)
        taken += n * dims
        bound = full if bound is None else np.minimum(bound, full)
        alive &= part <= bound[:, None]
    best = np.where(alive, part, part.max() + 1 if n else 0).argmin(axis=1)
    return best, part[at, best] // dims, taken


def kept(df: DataFrame, dims: int = DIMS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (doubles) of the rows that take part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(vector).isNotNull() & (F.size(vector) == dims)).where(~bad)
    return rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))


def transformed(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, t (the transform), or big (the same as decimal texts) where integers are large."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            q = quantise(matrix(part.column(1)), scale)
            wide = (np.abs(q) > NARROW).any(axis=1).astype(bool)
            small = transform(np.where(wide[:, None], 0, q).astype(np.int64))
            big: list[list[str] | None] = [None] * len(q)
            for i in np.flatnonzero(wide).tolist():
                big[i] = [str(c) for c in transform(whole(q[i:i + 1]))[0]]
            t = pa.ListArray.from_arrays(pa.array(np.arange(len(q) + 1, dtype=np.int32) * q.shape[1]), pa.array(small.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), t, pa.array(big, pa.list_(pa.string()))], names=["vec_id", "t", "big"])

    return batches(rows, run, "vec_id long, t array<long>, big array<string>")


def _assigned(part: pa.RecordBatch, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """t (longs), the rows that are large, their transforms, and (cluster, distance) of all rows as an object array."""
    t = matrix(part.column(1))
    big = np.array([i for i, x in enumerate(part.column(2).is_valid().to_pylist()) if x], np.int64)
    large = np.array([[int(c) for c in x] for x in part.column(2).take(pa.array(big)).to_pylist()], object).reshape(len(big), t.shape[1])
    rest = np.setdiff1d(np.arange(len(t)), big)
    cluster, distance = np.zeros(len(t), np.int64), np.zeros(len(t), object)
    fits = max((abs(c) for c in centres.ravel().tolist()), default=0) <= NARROW * t.shape[1]
    found = nearest(t[rest], centres.astype(np.int64)) if fits else nearest(t[rest].astype(object), centres)
    cluster[rest], distance[rest] = found[0], found[1]
    if len(big):
        cluster[big], distance[big], _ = nearest(large, centres)
    return t, big, large, np.stack([cluster.astype(object), distance], axis=1)


def _limbs(cluster: int, count: int, sums: list[int]) -> Iterator[tuple[int, int, int, list[int]]]:
    """A cluster's sums cut into parts that can be added up as longs."""
    place, mask = 0, (1 << LIMB) - 1
    while True:
        yield cluster, place, count if place == 0 else 0, [s & mask for s in sums]
        sums, place = [s >> LIMB for s in sums], place + 1
        if all(-(1 << LIMB) < s < (1 << LIMB) for s in sums):
            yield cluster, place, 0, sums
            return


def summed(vectors: DataFrame, centres: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and sum of the transforms of every non-empty cluster. Every task adds up its rows; centroids alone reach the driver."""
    dims = centres.shape[1]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centres), np.int64), np.zeros((len(centres), dims), object)
        for part in parts:
            if not part.num_rows:
                continue
            t, big, large, found = _assigned(part, centres)
            cluster = found[:, 0].astype(np.int64)
            counts += np.bincount(cluster, minlength=len(centres))
            for c in np.unique(cluster).tolist():
                sums[c] += t[cluster == c].sum(axis=0).astype(object)  # large rows hold zeros here
            for i, row in zip(big.tolist(), large, strict=True):
                sums[cluster[i]] += row
        rows = [x for c in np.flatnonzero(counts).tolist() for x in _limbs(c, int(counts[c]), sums[c].tolist())]
        if rows:
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), types, strict=True)],
                                             names=["cluster", "place", "n", "s"])

    parts = batches(vectors, run, "cluster int, place int, n long, s array<long>")
    added = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), *[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(dims)])
    out: dict[int, tuple[int, list[int]]] = {}
    for r in added.collect():
        n, sums = out.get(r.cluster, (0, [0] * dims))
        out[r.cluster] = (n + r.n, [a + (r[f"s{i}"] << (LIMB * r.place)) for i, a in enumerate(sums)])
    return out


def seeds(rows: DataFrame, clusters: int = CLUSTERS, scale: int = SCALE, seed: str = SEED) -> list[list[int]]:
    """The integer vectors with the smallest hashes of seed and id."""
    mark: Column = F.sha2(F.concat(F.lit(seed + ":"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = rows.where("vec_id IS NOT NULL").select(mark.alias("mark"), "v").orderBy("mark", "v").limit(clusters).collect()
    return [whole(quantise(np.array([r.v]), scale))[0].tolist() for r in first]


def fit(vectors: DataFrame, start: list[list[int]], rounds: int = ROUNDS) -> list[list[int]]:
    """Centroids after so many rounds. vectors: from transformed, staged."""
    centres = start
    for _ in range(rounds if start else 0):
        sums = summed(vectors, transform(np.array(centres, object)))
        centres = list(centres)
        for c, (n, s) in sums.items():
            centres[c] = [x // n for x in restore(np.array([s], object))[0].tolist()]
    return centres


def assign(vectors: DataFrame, centres: list[list[int]]) -> DataFrame:
    """vec_id, cluster, distance of every vector."""
    turned = transform(np.array(centres, object))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                found = _assigned(part, turned)[3]
                distance = pa.array([min(d, LONG_MAX) for d in found[:, 1].tolist()], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found[:, 0].astype(np.int32)), distance], names=["vec_id", "cluster", "distance"])

    return batches(vectors, run, "vec_id long, cluster int, distance long")


def cluster(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = SEED) -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster, distance for every row of kept(), and the final centroids."""
    vectors = stage(transformed(rows, scale), "transforms")
    start = seeds(rows, clusters, scale, seed)
    if not start:
        return vectors.selectExpr("vec_id", "0 AS cluster", "0L AS distance").limit(0), []
    centres = fit(vectors, start, rounds)
    return stage(assign(vectors, centres), "assigned"), centres


def op13_walsh_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centres = cluster(kept(table(spark, sf_dir, "embeddings")))
    sums = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    whole_sum = min(sum(sums.values()), LONG_MAX)
    of = [(c, min(sums.get(c, 0), LONG_MAX), whole_sum, hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for c, x in enumerate(centres)]
    facts = spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
