"""What the two vector searches share: valid vectors and the best rows of each query."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import batches


def valid(df: DataFrame, zero_too: bool, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (doubles) and dims of rows with an id and a vector without nulls and infinities; zero vectors if wanted."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)).where(~bad)
    if not zero_too:
        rows = rows.where(F.exists(vector, lambda x: x != 0))
    return rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"), F.size(vector).alias("dims"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def in_groups(rows: DataFrame, by: list[str], schema: str, search) -> DataFrame:
    """Search group by group. rows: the columns by, kind (0: stored, 1: query), vec_id, v.

    search(vec_ids, matrix) is called with what a group stores, and returns a function from (query ids, matrix) to a batch.
    Only the stored rows of one group are held; its queries stream.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, held, find = None, [], [], None
        for part in parts:
            if not part.num_rows:
                continue
            keys = np.stack([part.column(i).to_numpy(zero_copy_only=False) for i in range(len(by) + 1)], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                here, kind = tuple(keys[a, :-1].tolist()), int(keys[a, -1])
                if here != key:
                    key, ids, held, find = here, [], [], None
                some = part.slice(a, b - a)
                own, v = some.column(len(by) + 1).to_numpy(), matrix(some.column(len(by) + 2))
                if kind == 0:
                    ids.append(own)
                    held.append(v)
                elif ids:
                    if find is None:
                        find = search(np.concatenate(ids), np.concatenate(held))
                    yield find(own, v)

    ordered = rows.select(*by, "kind", "vec_id", "v").repartition(*by).sortWithinPartitions(*by, "kind", "vec_id")
    return batches(ordered, run, schema)


def best(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest of each query, ties to the smaller vec_id; a vec_id counts once."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
