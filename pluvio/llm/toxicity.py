"""Toxicity of documents by a bidirectional gated recurrent network with attention pooling (see gru.py).

A document is cut into overlapping windows of words that reach its last word; its score is that of its highest window. A word of more
than 32 characters (such as a run of unspaced script) is cut into overlapping pieces, each a word of the windows. An
empty or null text has one window of a pad word. Rows are scored where they lie: nothing is shuffled, repeated rows get equal
scores. The model is fitted on a sample bounded by `per_class` documents of at most `longest` characters for either label,
chosen by a hash of the id (of several texts of one id the smallest); scoring covers every window of every text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm.common import held_out, keep_rows, prepare, score_rows, table, taught_ids
from pluvio.llm.gru import Network, Scorer, Shape, train

PER_CLASS = 1000
LONGEST = 6000
THRESHOLD = 0.5


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, longest: int = LONGEST, shape: Shape = Shape()) -> Network:
    """Learn from labelled documents outside the held-out fifth. Without both labels the network is constant."""
    ids = taught_ids(labels, "toxic", per_class)
    rows = (
        docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= longest))
        .join(ids, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect()
    )
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return train([r.text for r in rows], [int(r.label) for r in rows], shape)


def scorer(spark: SparkSession, net: Network):
    """A factory of scoring functions for tasks."""
    prepare(spark)
    sent = spark.sparkContext.broadcast((net.shape, net.weights))

    def per_task():
        own = Scorer(Network(*sent.value))
        return own.scores

    return per_task


def score(docs: DataFrame, net: Network, keys: list[str], text: str = "text") -> DataFrame:
    """keys, score (0 to 1, higher: toxic) for every row."""
    return score_rows(docs, scorer(docs.sparkSession, net), keys, text)


def reject(docs: DataFrame, net: Network, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of docs that score below the threshold."""
    per_task = scorer(docs.sparkSession, net)

    def mask():
        scores = per_task()
        return lambda texts: np.asarray(scores(texts)) < threshold

    return keep_rows(docs, mask, text)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, net, ["doc_id"]).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
