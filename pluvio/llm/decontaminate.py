"""Passages of benchmark items in documents: a prefix-filtered set join of word shingles, in DataFrame functions only.

A window is a run of `window` words of an item, or the whole item if it has fewer; a run of a document is as long as the window it is
compared with. The set of a window are its shingles of up to `shingle` words. Shingles are ordered by how often the documents hold
them; a run that holds a share `containment` of a window's m shingles, each at its place, must hold one of the m - need + 1 rarest,
where need is that share of m rounded up. So only those prefixes are joined with the places of shingles in the documents. A match fixes
where the run begins; runs that would begin before the document or end after it go, and for the rest all shingles of the window are
looked up. With containment 1, the prefix is the one rarest shingle and a run is found exactly if it equals the window.

Texts are read once: what is kept of them are the places of shingles that some window holds, and one row a document.

Words are maximal runs of digits, letters a-z (A-Z count as a-z) and characters beyond ASCII. A null text has no words. Items without
words have no windows; the windows of an item without an id hit words but are listed under no id. Rows of the same id and text get the
same result, each on its own; texts that share an id, or have none, are told apart by their digest. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.llm.common import table
from pluvio.session import stage

WINDOW, SHINGLE = 10, 5
#: Rows of a table that may be sent to every task; beyond it Spark shuffles.
SMALL = 200_000
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    plain = F.octet_length(text) == F.length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), _APART), "")


def _hash(words: Column, at: Column, size: int) -> Column:
    """A hash of so many words from a place (from 1) on."""
    return F.xxhash64(F.lit(size), *(F.get(words, at + (k - 1)) for k in range(size)))


def _few(df: DataFrame, small: int) -> bool:
    return df.limit(small + 1).count() <= small


def item_windows(items: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, w (words) of every window of every item, each once."""
    words = items.select(F.col(item_id).cast("string").alias("item_id"), words_of(F.col(text)).alias("words")).where("size(words) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    cut = words.select("item_id", "words", F.explode(starts).alias("i"))
    return cut.select("item_id", F.slice("words", F.col("i"), F.lit(window)).alias("w")).distinct()


def window_shingles(windows: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """w, n (words), o (place of a shingle, from 0), s (its words) for every distinct window."""
    parts = windows.select("w").distinct().withColumn("n", F.size("w")).withColumn("size", F.least(F.lit(shingle), F.col("n")))
    placed = parts.select("w", "n", "size", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("size"))).alias("o"))
    return placed.select("w", "n", "o", F.slice("w", F.col("o") + 1, F.col("size")).alias("s"))


def document_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, k (id and digest of the text), words."""
    key = F.concat_ws(":", F.md5(F.col(text).cast("binary")), F.col(doc_id).cast("string"))
    return docs.select(F.col(doc_id).alias("doc_id"), key.alias("k"), words_of(F.col(text)).alias("words"))


def places(words: DataFrame, shingles: DataFrame, small: int = SMALL) -> DataFrame:
    """doc_id, k, n_words, p, sid: where (from 1) the documents hold the shingles, and a row of p and sid 0 for every document.

    words: from document_words; shingles: sid (from 1), s. Few shingles are sent to the documents; many are joined by a shuffle of
    hashes, and the texts that hold some are joined back to compare the words.
    """
    sizes = sorted(r[0] for r in shingles.select(F.size("s").alias("size")).distinct().collect())
    by_size = F.lit(0)
    for size in sizes:
        by_size = F.when(F.size("s") == size, _hash(F.col("s"), F.lit(1), size)).otherwise(by_size)
    wanted = shingles.select("sid", "s", by_size.alias("h"))
    mark = shingles.sparkSession.createDataFrame([(0, [], 0)], wanted.schema)  # finds the row of the document itself
    each = words.select("doc_id", "k", "words", F.size("words").alias("n_words"), F.explode(F.sequence(F.lit(0), F.size("words"))).alias("p"))
    at = [F.when(F.col("p") == 0, F.lit(0)).otherwise(_hash(F.col("words"), F.col("p"), size)) for size in sizes]
    hashed = each.withColumn("h", at[0] if len(at) == 1 else F.explode(F.array_distinct(F.array(*at))) if at else F.lit(0).cast("long"))
    own = (F.col("p") == 0) == (F.col("sid") == 0)
    same = F.slice("words", F.greatest(F.lit(1), F.col("p")), F.size("s")) == F.col("s")
    if _few(wanted, small):
        met = hashed.join(F.broadcast(wanted.unionByName(mark)), "h").where(own).where(same)
        return met.select("doc_id", "k", "n_words", "p", "sid")
    rows = words.select("doc_id", "k", F.size("words").alias("n_words"), F.lit(0).alias("p"), F.lit(0).cast("long").alias("sid"))
    met = hashed.where("p > 0").select("k", "p", "h").join(wanted, "h").select("k", "p", "sid", "s").distinct()
    texts = words.select("doc_id", "k", "words", F.size("words").alias("n_words")).dropDuplicates(["k"])
    return rows.unionByName(met.join(texts, "k").where(same).select("doc_id", "k", "n_words", "p", "sid"))


def prefixes(windows: DataFrame, times: DataFrame, containment: float = 1.0) -> DataFrame:
    """wid, n, o, sid, need: of each window the rarest shingles of which every run that holds enough of the window holds one."""
    rare = Window.partitionBy("wid").orderBy("times", "o")
    m = F.count("*").over(Window.partitionBy("wid"))
    need = F.greatest(F.lit(1), F.ceil(m * F.lit(containment) - 1e-9)).cast("long")
    every = windows.join(times, "sid", "left").withColumn("times", F.coalesce("times", F.lit(0))).withColumn("m", m).withColumn("need", need)
    first = every.withColumn("r", F.row_number().over(rare)).where("r <= m - need + 1 AND times > 0")
    return first.select("wid", "n", "o", "sid", "need")


def occurrences(held: DataFrame, windows: DataFrame, containment: float = 1.0, small: int = SMALL) -> DataFrame:
    """k, start (from 0), n, wid: where the documents hold windows. held: from places; windows: wid, n, o, sid."""
    some = held.where("sid > 0").select("k", "n_words", "p", "sid").distinct()
    times = some.groupBy("sid").agg(F.count("*").alias("times"))
    prefix = stage(prefixes(windows, times, containment), "prefixes")
    start = F.col("p") - 1 - F.col("o")
    met = some.join(F.broadcast(prefix) if _few(prefix, small) else prefix, "sid").withColumn("start", start)
    runs = met.where("start >= 0 AND start + n <= n_words").select("k", "start", "n", "wid", "need").distinct()
    parts = windows.select("wid", "o", "sid")
    looked = runs.join(F.broadcast(parts) if _few(parts, small) else parts, "wid").withColumn("p", F.col("start") + 1 + F.col("o"))
    count = looked.join(some.select("k", "p", "sid"), ["k", "p", "sid"]).groupBy("k", "start", "n", "wid", "need").agg(F.count("*").alias("found"))
    return count.where("found >= need").select("k", "start", "n", "wid")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, containment: float = 1.0,
                  small: int = SMALL) -> DataFrame:
    """doc_id, n_words, n_hit (words inside found runs), n_items, item_ids (as strings, sorted) for every row of docs."""
    # Numbers given to rows hold once they are written.
    owned = stage(item_windows(items, window), "windows")
    windows = stage(window_shingles(owned, shingle), "shingles")
    shingles = stage(windows.select("s").distinct().withColumn("sid", F.monotonically_increasing_id() + 1), "numbered")
    names = stage(windows.select("w").distinct().withColumn("wid", F.monotonically_increasing_id()), "named")
    held = stage(places(document_words(docs), shingles, small), "places")
    placed = stage(windows.join(shingles, "s").join(names, "w").select("wid", "n", "o", "sid"), "placed")
    found = stage(occurrences(held, placed, containment, small), "occurrences")
    # Each run counts the words after the furthest end of the runs that begin before it.
    runs = found.groupBy("k", "start").agg(F.max("n").alias("n")).withColumn("end", F.col("start") + F.col("n"))
    before = Window.partitionBy("k").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))
    hit = runs.withColumn("new", F.greatest(F.lit(0), new)).groupBy("k").agg(F.sum("new").alias("n_hit"))
    owners = owned.where("item_id IS NOT NULL").join(names, "w").select("wid", "item_id")
    owners = F.broadcast(owners) if _few(owners, small) else owners
    named = found.select("k", "wid").distinct().join(owners, "wid").groupBy("k").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    result = hit.join(named, "k", "left")
    base = held.where("sid = 0").select("doc_id", "k", F.col("n_words").cast("long"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return base.join(result, "k", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"))


def op11_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))
