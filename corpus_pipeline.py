"""From raw documents to packed training sequences: toxic and poor documents go, one of each near-duplicate group stays, and
what is left is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import jaccard, packing, quality, toxicity
from pluvio.llm.common import INTERNAL, marked, table
from pluvio.llm.tokens import path_of
from pluvio.session import stage


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold (operator 8)."""
    return toxicity.reject(docs, toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def remove_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold (operator 5)."""
    return quality.reject(docs, quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of every group of linked documents (operator 7): five words, a similarity of 0.8.

    Rows of one id and one text are one document, of which the smallest row by the other columns stays; texts that share an id are
    documents of their own, and the smaller hash of the text stays if they are linked. Documents of null id have no place in the
    order and stay, as do those without words, but for repeated rows.
    """
    own = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    found = jaccard.groups(docs.select("doc_id", "text", own.alias("own")), words=5, percent=80)
    gone = F.expr("coalesce(doc_id <> least.doc_id OR doc_id IS NOT NULL AND own <> least.own, false)")
    # All other rows stay as they are; they are told apart before any text is shuffled.
    odd = found.groupBy("doc_id", "own").agg(F.max(gone).alias("gone"), F.count("*").alias("k")).where("gone OR k > 1")
    odd = stage(odd.select("doc_id", "own", "gone"), "odd")
    apart = marked(docs.withColumn("own", own), odd, ["doc_id", "own"], INTERNAL + "maybe")
    rest = [c for c in docs.columns if c != "doc_id"]
    once = apart.where(INTERNAL + "maybe").groupBy("doc_id", "own").agg(F.min(F.struct(*rest)).alias("row"))
    once = once.join(odd.where("gone"), ["doc_id", "own"], "left_anti").select("doc_id", "row.*").select(docs.columns)
    return apart.where("NOT " + INTERNAL + "maybe").select(docs.columns).unionByName(once)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequence and place (operator 6)."""
    return packing.pack(stage(packing.pieces(docs, path_of("word_bpe_49k.json")), "pieces"))


STAGES = [
    ("toxicity", remove_toxic),
    ("quality classifier", remove_poor),
    ("n-gram Jaccard join", keep_one_of_group),
    ("best-fit packing", pack),
]

#: The models of the first two stages cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
