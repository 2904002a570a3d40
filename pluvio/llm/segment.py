"""SentencePiece encoding by sampled segmentations, and decoding (see lattice.py).

Every text gets up to k distinct segmentations in the order in which they are drawn without replacement, each with its
log-probability among all segmentations, its perturbed key, and its inclusion score: the probability that a draw of k holds it
given the next best key, by which estimates are weighted. A text with fewer segmentations has all of them, each with score 1; an
empty or null text has one, without pieces. Draws depend on the row's key alone; rows of equal keys and texts get equal samples.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm.common import batches, strings, table
from pluvio.llm.lattice import Sampler, Vocabulary
from pluvio.llm.tokens import path_of

K, SEED = 2, 5
#: Characters of the texts drawn together.
TOGETHER = 1 << 18

_samplers: dict[tuple[str, float], Sampler] = {}


def sampler(path: str, temperature: float) -> Sampler:
    """The sampler of this process; the lattices it remembers outlive a task."""
    if (path, temperature) not in _samplers:
        _samplers[path, temperature] = Sampler(Vocabulary(path, temperature))
    return _samplers[path, temperature]


def lists(parts: list[np.ndarray]) -> pa.ListArray:
    """A column of lists from one array for each."""
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))


def segmentations(docs: DataFrame, path: str, k: int = K, seed: int = SEED, temperature: float = 1.0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, rank (from 1), ids, log_prob, perturbed, inclusion."""

    def drawn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(path, temperature)
        for part in parts:
            texts = strings(part.column(2))
            seeds = part.column(1).to_numpy().view(np.uint64)
            a = 0
            while a < len(texts):
                b, held = a, 0
                while b < len(texts) and (b == a or held + len(texts[b]) <= TOGETHER):
                    held += len(texts[b])
                    b += 1
                rows = own.samples(texts[a:b], seeds[a:b], k)
                at = np.repeat(np.arange(a, b), [len(r) for r in rows])
                flat = [s for r in rows for s in r]
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(at)), pa.array([i + 1 for r in rows for i in range(len(r))], pa.int32()),
                    lists([s.ids for s in flat]), pa.array([s.log_prob for s in flat], pa.float64()),
                    pa.array([s.key for s in flat], pa.float64()), pa.array([s.inclusion for s in flat], pa.float64()),
                ], names=[key, "rank", "ids", "log_prob", "perturbed", "inclusion"])
                a = b

    rows = docs.select(key, F.xxhash64(F.col(key), F.lit(seed)).alias("__llm_seed"), F.col(text).alias("__llm_text"))
    kind = docs.schema[key].dataType.simpleString()
    return batches(rows, drawn, f"`{key}` {kind}, rank int, ids array<long>, log_prob double, perturbed double, inclusion double")


def decoded(rows: DataFrame, path: str, keys: list[str], ids: str = "ids") -> DataFrame:
    """keys and the text that the pieces of every row spell."""

    def spelled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sampler(path, 1.0).vocabulary.model
        for part in parts:
            texts = [model.decode(x or []) for x in part.column(part.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*keys, "text"])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys)
    return batches(rows.select(*keys, ids), spelled, f"{fields}, text string")


def op1_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = segmentations(table(spark, sf_dir, "documents"), path_of("piece_bpe_32k.model"))
    return made.select("doc_id", "rank", F.size("ids").cast("long").alias("n_pieces"), "log_prob", "perturbed", "inclusion",
                       F.xxhash64("ids").alias("ids_hash"))
