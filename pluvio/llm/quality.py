"""Quality of documents by a generalised additive model with pairwise interactions (see gam.py).

The features are counts over the whole text: characters by kind, words, lines, repetition. An empty or null text has zeros.
Rows are scored where they lie: nothing is shuffled, repeated rows get equal scores. The model is fitted on at most
`per_class` labelled documents of either label, chosen by a hash of the id; only their features reach the driver.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import gam
from pluvio.llm.common import batches, held_out, keep_rows, prepare, score_rows, strings, table, taught_ids

PER_CLASS = 8000
THRESHOLD = 0.3

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "non_ascii", "punctuation", "symbols", "bars", "marks",
    "byte_entropy", "distinct_words", "top_word", "same_as_before", "log_lines", "line_words", "distinct_lines", "log_longest_word",
]
_BYTES = np.arange(256)
_KINDS = np.stack([
    (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 48) & (_BYTES <= 57), _BYTES >= 0xC0, np.isin(_BYTES, list(b".,;:'\"()?-")),
    np.isin(_BYTES, list(b"#$%&*+/<=>@\\^_`{}~[]")), _BYTES == ord("|"), _BYTES == ord("!"),
]).astype(np.float64).T


def features(text: str) -> list[float]:
    """The features of one text, in the order of FEATURES."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words = text.split()
    if not words:
        return [math.log1p(len(raw)), *[0.0] * (len(FEATURES) - 1)]
    counts = np.bincount(raw, minlength=256).astype(np.float64)
    share = counts / len(raw)
    kinds = share @ _KINDS
    filled = share[share > 0]
    n = len(words)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        math.log1p(len(raw)), math.log1p(n), len(raw) / n, *kinds.tolist(), float(-(filled * np.log(filled)).sum()),
        len(seen) / math.sqrt(n) if n > 400 else len(seen) / n * 20, max(seen.values()) / n, sum(map(eq, words, words[1:])) / n,
        math.log1p(len(lines)), n / len(lines), len(set(lines)) / len(lines), math.log1p(max(map(len, seen))),
    ]


def matrix(texts: list[str]) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> gam.Additive:
    """Learn from labelled documents outside the held-out fifth.

    The sample may hold another share of good documents than the labels do; the intercept is set to the share of all labels.
    """
    def featured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                rows = matrix(strings(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(list(rows), pa.list_(pa.float64())), part.column(2)], names=["doc_id", "x", "label"])

    ids = taught_ids(labels, "quality", per_class)
    # Of several texts of one id the smallest is learned from.
    chosen = docs.select("doc_id", "text").join(ids, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
    rows = sorted(batches(chosen, featured, "doc_id long, x array<double>, label int").collect())
    x = np.array([r.x for r in rows], np.float64).reshape(-1, len(FEATURES))
    y = np.array([r.label for r in rows], np.float64)
    model = gam.fit(x, y)
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    n, good = known.agg(F.count("*"), F.coalesce(F.sum("quality"), F.lit(0))).first()
    if len(y) and 0 < good < n and y.min() < y.max():
        model.intercept += math.log(good / (n - good)) - math.log(y.sum() / (len(y) - y.sum()))
    return model


def scorer(spark: SparkSession, model: gam.Additive):
    prepare(spark)
    return lambda: lambda texts: model.score(matrix(texts)) if texts else np.zeros(0)


def score(docs: DataFrame, model: gam.Additive, keys: list[str], text: str = "text") -> DataFrame:
    """keys, score (0 to 1, higher: good) for every row."""
    return score_rows(docs, scorer(docs.sparkSession, model), keys, text)


def reject(docs: DataFrame, model: gam.Additive, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of docs that score at least the threshold."""
    per_task = scorer(docs.sparkSession, model)

    def mask():
        scores = per_task()
        return lambda texts: np.asarray(scores(texts)) >= threshold

    return keep_rows(docs, mask, text)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, ["doc_id"]).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
