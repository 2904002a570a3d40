"""Exact Jaccard join of documents by their word shingles, with prefix trees (see trie.py).

Documents of equal sets are one class, found by a fingerprint. Two classes can only link if the rarest items of one (its
prefix) meet those of the other, so every class sends the items of its prefix. Among the classes that share an item, bitmaps of
parities bound from below in how many items two sets differ; classes that may still link are tied together (see ties.py; an
item shared by very many classes ties them all by a star); before bitmaps are sent, sizes and places in the order of items leave only
postings that may be where two linked sets first meet. The connected parts of this graph are blocks: each class lies in one
block, and all its links too. A block is joined by a prefix tree in one task, which makes its sets from the texts. A block too large for a task is thinned first: all its classes are compared with one
of them, the leader; those that link to it are joined and leave, unless the triangle inequality of the Jaccard distance lets one
of the rest link to them; what is left after some leaders is cut into shards and joined shard against shard. Nothing is capped.

Results: a document without words (null, empty, white space) has no shingles and is its own component. Repeated rows stay, a
null doc_id is a node like others. `component_id` is the smallest doc_id reachable, the document itself included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import shingles as sh
from pluvio.llm.common import INTERNAL, batches, broadcast_below, components, marked, strings, table
from pluvio.llm.ties import first_meetings, tie
from pluvio.llm.trie import join_within
from pluvio.session import stage, unstage

WORDS = 4
PERCENT = 85
#: Counters of the frequency sketch that orders items; a few hundred kB whatever the corpus.
SKETCH_BITS = 18
#: Items one task may hold of a block before the block is split: 8 bytes each.
TASK_ITEMS = 4_000_000
LEADERS = 3
#: Postings of an item up to which one task compares its classes.
HOT_ITEM = 5000
#: Postings looked at together, and those of one more item.
POSTINGS = 1 << 16
BROADCAST_ROWS = 200_000


def _signed(data: bytes) -> int:
    return int.from_bytes(data, "little", signed=True)


def signatures(docs: DataFrame, words: int, bits: int) -> DataFrame:
    """doc_id, own, n, fp, bits of every row of docs(doc_id, text, own), and one row of item counts per task."""

    def signed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int32)
        schema = pa.schema([("doc_id", pa.int64()), ("own", pa.string()), ("n", pa.int64()), ("fp", pa.binary()), ("bits", pa.binary()),
                            ("counts", pa.list_(pa.int32()))])
        for part in parts:
            sets = sh.shingle_sets(strings(part.column(1)), words)
            if sets:
                counts += np.bincount(sh.bucket(np.concatenate(sets), bits), minlength=1 << bits).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column(0).cast(pa.int64()), part.column(2), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([sh.fingerprint(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([sh.parity_bits(s) if len(s) else None for s in sets], pa.binary()),
                pa.nulls(len(sets), pa.list_(pa.int32())),
            ], schema=schema)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.string()), pa.array([-1], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
             pa.array([counts], pa.list_(pa.int32()))],
            schema=schema)

    return batches(docs, signed, "doc_id long, own string, n long, fp binary, bits binary, counts array<int>")


def item_counts(signed: DataFrame, bits: int) -> np.ndarray:
    """The sketch of all tasks added up: as many numbers as it has counters."""
    rows = (
        signed.where("counts IS NOT NULL").select(F.posexplode("counts").alias("at", "k")).where("k > 0")
        .groupBy("at").agg(F.sum("k").alias("k")).toPandas()
    )
    counts = np.zeros(1 << bits, np.int64)
    counts[rows["at"].to_numpy(np.int64)] = rows["k"].to_numpy(np.int64)
    return counts


def prefix(items: np.ndarray, counts: np.ndarray, bits: int, percent: int) -> np.ndarray:
    """The items of which a linked set must have one, in its own prefix: the rarest by the sketch."""
    n = len(items)
    rare = np.lexsort((items, counts[sh.bucket(items, bits)]))
    return items[rare[:n - -(-percent * n // 100) + 1]]


def postings(docs: DataFrame, counts: np.ndarray, special: dict[bytes, int], words: int, bits: int, percent: int) -> DataFrame:
    """item, cls, n, place for the prefix of every document: the size of its set and the item's place in it. Copies within a task are sent once."""
    sent = docs.sparkSession.sparkContext.broadcast((counts, special))

    def posted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (counts, special), seen = sent.value, set()
        for part in parts:
            items, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            sizes, places = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
            for s in sh.shingle_sets(strings(part.column(0)), words):
                fp = sh.fingerprint(s)
                if not len(s) or fp in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(fp)
                items.append(prefix(s, counts, bits, percent))
                owners.append(np.full(len(items[-1]), special.get(fp, _signed(fp[:8])), np.int64))
                sizes.append(np.full(len(items[-1]), len(s), np.int32))
                places.append(np.arange(len(items[-1]), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(items).view(np.int64)), *(pa.array(np.concatenate(c)) for c in (owners, sizes, places))],
                names=["item", "cls", "n", "place"])

    return batches(docs.select("text"), posted, "item long, cls long, n int, place int")


def may_meet_first(few: DataFrame, percent: int) -> DataFrame:
    """item, cls of those postings(item, cls, n, place) that may be the first item a set shares with one that links to it."""

    def sifted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def kept(item, cls, n, place):
            keep = first_meetings(item, cls, n, place, percent)
            return pa.RecordBatch.from_arrays([pa.array(item[keep]), pa.array(cls[keep])], names=["item", "cls"])

        for part in parts:
            held.append([c.to_numpy(zero_copy_only=False) for c in part.columns])
            rows += part.num_rows
            if rows < POSTINGS:
                continue
            whole = [np.concatenate(c) for c in zip(*held, strict=True)]
            cut = int(np.searchsorted(whole[0], whole[0][-1]))  # the last item may go on
            if cut:
                yield kept(*(c[:cut] for c in whole))
            held, rows = [[c[cut:] for c in whole]], rows - cut
        if rows:
            yield kept(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return batches(few.select("item", "cls", "n", "place").repartition("item").sortWithinPartitions("item"), sifted, "item long, cls long")


def classed(texts: DataFrame, special: dict[bytes, int], words: int) -> DataFrame:
    """cls, text of every text that has words. Copies within a task are sent once."""
    sent = texts.sparkSession.sparkContext.broadcast(special)

    def made(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special, seen = sent.value, set()
        for part in parts:
            keep, classes = [], []
            for k, s in enumerate(sh.shingle_sets(strings(part.column(0)), words)):
                fp = sh.fingerprint(s)
                if not len(s) or fp in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(fp)
                keep.append(k)
                classes.append(special.get(fp, _signed(fp[:8])))
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), part.column(0).take(pa.array(keep, pa.int64()))], names=["cls", "text"])

    return batches(texts, made, "cls long, text string")


def _set_maker(docs: DataFrame, special: dict[bytes, int], words: int):
    """A function from batches of block, cls, text to batches of block, cls, n, items."""
    sent = docs.sparkSession.sparkContext.broadcast(special)

    def made(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = sent.value
        for part in parts:
            keep, n, items = [], [], []
            made_here = sh.shingle_sets(strings(part.column(2)), words)
            for k, (s, cls) in enumerate(zip(made_here, part.column(1).to_pylist(), strict=True)):
                fp = sh.fingerprint(s)
                if special.get(fp, _signed(fp[:8])) == cls:  # another row may carry the same id
                    keep.append(k)
                    n.append(len(s))
                    items.append(s.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pa.array(keep, pa.int64())), part.column(1).take(pa.array(keep, pa.int64())),
                pa.array(n, pa.int64()), pa.array(items, pa.binary()),
            ], names=["block", "cls", "n", "items"])

    return made


def sets_of(docs: DataFrame, special: dict[bytes, int], words: int) -> DataFrame:
    """block, cls, n, items of documents that carry their block and class."""
    return batches(docs.select("block", "cls", "text"), _set_maker(docs, special, words), "block long, cls long, n long, items binary")


def _array(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u8")


def _edges(classes: list[int], groups: list[int]) -> pa.RecordBatch:
    pairs = [(classes[g], c) for c, g in zip(classes, groups, strict=True) if classes[g] != c]
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["a", "b"])


def _joiner(percent: int, sharded: bool):
    """A function from batches of sets, sorted by block (and shard pair) and class, to batches of edges. A class counts once."""
    by = ["block", "one", "two"] if sharded else ["block"]

    def joined(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def done():
            if len(rows) < 2:
                return
            if sharded and key[1] != key[2]:
                mine, theirs = ([r for r in rows if r[0] == k] for k in key[1:])
                groups = join_within([_array(r[2]) for r in mine], percent, [_array(r[2]) for r in theirs])
                yield _edges([r[1] for r in mine + theirs], groups)
            else:
                yield _edges([r[1] for r in rows], join_within([_array(r[2]) for r in rows], percent))

        for part in parts:
            cols = {name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)}
            for k in range(part.num_rows):
                here = tuple(cols[c][k] for c in by)
                if here != key:
                    yield from done()
                    key, rows = here, []
                if not rows or rows[-1][1] != cols["cls"][k]:
                    rows.append((cols["shard"][k] if sharded else None, cols["cls"][k], cols["items"][k]))
        yield from done()

    return joined


def linked_in_blocks(sets: DataFrame, percent: int) -> DataFrame:
    """Edges a, b that connect what links within each block (and shard pair, if those columns are there)."""
    sharded = "shard" in sets.columns
    by = ["block", "one", "two"] if sharded else ["block"]
    return batches(sets.repartition(*by).sortWithinPartitions(*by, "cls"), _joiner(percent, sharded), "a long, b long")


def linked_texts(texts: DataFrame, percent: int, special: dict[bytes, int], words: int) -> DataFrame:
    """Edges a, b that connect what links within each block of texts(block, cls, text); the sets are made where they are joined."""
    made, joined = _set_maker(texts, special, words), _joiner(percent, False)
    placed = texts.select("block", "cls", "text").repartition("block").sortWithinPartitions("block", "cls")
    return batches(placed, lambda parts: joined(made(parts)), "a long, b long")


def tied(few: DataFrame, percent: int) -> DataFrame:
    """Edges a, b of classes that share an item and may link. few: item, cls, n, bits."""

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, done = None, {}, set()

        def flush():
            # Items of one passage meet in the same classes; each such meeting is looked at once.
            meeting = hashlib.md5(np.sort(np.fromiter(rows, np.int64, len(rows))).tobytes(), usedforsecurity=False).digest()
            if len(rows) < 2 or meeting in done:
                return [], []
            if len(done) > 500_000:
                done.clear()
            done.add(meeting)
            names = list(rows)
            groups = tie([rows[c][0] for c in names], [rows[c][1] for c in names], percent)
            pairs = [(min(c, names[g]), max(c, names[g])) for c, g in zip(names, groups, strict=True) if c != names[g]]
            return [p[0] for p in pairs], [p[1] for p in pairs]

        for part in parts:
            a, b = [], []
            for item, cls, n, bits in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if item != key:
                    x, y = flush()
                    a += x
                    b += y
                    key, rows = item, {}
                rows[cls] = (n, bits)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        x, y = flush()
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    return batches(few.select("item", "cls", "n", "bits").repartition("item").sortWithinPartitions("item"), found, "a long, b long")


def thin(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Compare every class of a block with its leader: edges to the leader, and the rows still needed, both staged.

    A block without an open row has no leader; its rows were kept because they may link to each other, and stay.
    """
    first = sets.where("open").groupBy("block").agg(F.min("cls").alias("leader"))
    lead = (
        sets.join(first, "block").where("cls = leader")
        .select("block", "leader", F.col("items").alias("lead_items"))
    )

    def measured(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            common = [
                len(np.intersect1d(_array(x), _array(y), assume_unique=True))
                for x, y in zip(part.column(3).to_pylist(), part.column(6).to_pylist(), strict=True)
            ]
            whole = [(len(x) + len(y)) // 8 - c
                     for x, y, c in zip(part.column(3).to_pylist(), part.column(6).to_pylist(), common, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:6], pa.array(common, pa.int64()), pa.array(whole, pa.int64())],
                names=["block", "cls", "n", "items", "open", "leader", "common", "whole"])

    written = stage(batches(
        sets.join(lead, "block").select("block", "cls", "n", "items", "open", "leader", "lead_items"), measured,
        "block long, cls long, n long, items binary, open boolean, leader long, common long, whole long",
    ), "compared")
    compared = written.withColumn("near", F.expr(f"100 * common >= {percent} * whole")).withColumn("far", F.expr("1 - common / whole"))
    edges = stage(compared.where("near AND cls <> leader").select(F.col("leader").alias("a"), F.col("cls").alias("b")), "led")
    reach = compared.where("NOT near").groupBy("block").agg(F.min("far").alias("least"))
    rest = (
        compared.join(reach, "block").where(f"NOT near OR far >= least - {1 - percent / 100} - 1e-9")
        .select("block", "cls", "n", "items", F.expr("open AND NOT near").alias("open"))
    )
    rest = stage(rest.unionByName(sets.join(first, "block", "left_anti").select("block", "cls", "n", "items", "open")), "rest")
    unstage(written)
    return edges, rest


def links(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bits: int = SKETCH_BITS, task_items: int = TASK_ITEMS):
    """doc_id, n_shingles, component_id for every row of docs(doc_id, text)."""
    found = groups(docs.select("doc_id", "text", F.lit(None).cast("string").alias("own")), words, percent, bits, task_items)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least.doc_id", "doc_id").alias("component_id"))


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bits: int = SKETCH_BITS, task_items: int = TASK_ITEMS):
    """doc_id, own, n, least for every row of docs(doc_id, text, own): least is the smallest (doc_id, own) of its component.

    `own` is a name of the row's text, for ids that stand for several; least is null without words or without any id.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "own")
    signed = stage(signatures(docs, words, bits), "signed")
    rows = signed.where("counts IS NULL").select("doc_id", "own", "n", "fp")
    counts = item_counts(signed, bits)
    # Row ids may be null; min() passes over those, so a class of null ids alone has none.
    classes = stage(
        signed.where("fp IS NOT NULL").groupBy("fp")
        .agg(F.min(F.expr("CASE WHEN doc_id IS NOT NULL THEN struct(doc_id, own) END")).alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")), "classes")
    special = {}
    named = classes.withColumn("low", F.substring("fp", 1, 8))
    twice = named.groupBy("low").agg(F.count("*").alias("k")).where("k > 1")
    clash = named.join(twice, "low").select("low", "fp").limit(100_001).collect()
    if len(clash) > 100_000:
        raise RuntimeError("fingerprints clash too often")
    taken: dict[bytes, int] = {}
    for r in sorted(clash):
        taken[r.low] = taken.get(r.low, 0) + 1
        if taken[r.low] > 1:  # the first keeps its number, others take one from their second half
            special[bytes(r.fp)] = _signed(bytes(r.fp)[8:])

    number = F.udf(lambda fp: special.get(bytes(fp), _signed(bytes(fp)[:8])), "long")("fp") if special else _number("fp")
    numbered = classes.withColumn("cls", number)
    post = stage(postings(docs, counts, special, words, bits, percent), "postings")
    shared = (
        post.groupBy("item").agg(F.min("cls").alias("a"), F.max("cls").alias("z"), F.count("*").alias("k")).where("a < z")
    )
    shared = stage(shared.select("item", "a", (F.col("k") > HOT_ITEM).alias("hot")), "shared")
    meet = stage(post.join(shared, "item").select("item", "hot", "a", "cls", "n", "place"), "meet")
    unstage(post, shared)
    star = meet.where("hot AND a < cls").select("a", F.col("cls").alias("b"))
    near = stage(may_meet_first(meet.where("NOT hot"), percent), "near")
    few = near.join(numbered.select("cls", "n", "bits"), "cls")
    edges = stage(star.unionByName(tied(few, percent)).distinct(), "ties")
    unstage(meet, near)
    blocks = components(edges).select(F.col("node").alias("cls"), F.col("component").alias("block"))
    unstage(edges)
    wanted = stage(numbered.join(blocks, "cls").select("rep.doc_id", "cls", "block", "n"), "wanted")

    heavy = wanted.groupBy("block").agg(F.sum("n").alias("size")).where(F.col("size") > task_items)
    heavy = stage(heavy.select("block"), "heavy")
    found = linked_texts(texts_of(docs, wanted.join(heavy, "block", "left_anti"), special, words), percent, special, words)
    if not heavy.isEmpty():
        few = texts_of(docs, wanted.join(heavy, "block"), special, words)
        large = stage(sets_of(few, special, words).dropDuplicates(["cls"]).withColumn("open", F.lit(True)), "sets")
        for _ in range(LEADERS):
            edges, rest = thin(large, percent)
            unstage(large)
            found = found.unionByName(edges)
            large = rest
            if large.isEmpty():
                break
        found = found.unionByName(sharded(large, percent, task_items))
    joined = components(stage(found, "links"))
    of = numbered.join(joined.select(F.col("node").alias("cls"), "component"), "cls", "left").select(
        "fp", "rep", F.coalesce("component", "cls").alias("component"))
    least = of.groupBy("component").agg(F.min("rep").alias("least"))
    final = of.join(least, "component").select("fp", "least")
    return rows.join(final, "fp", "left").select("doc_id", "own", "n", "least")


def texts_of(docs: DataFrame, wanted: DataFrame, special: dict[bytes, int], words: int) -> DataFrame:
    """block, cls, text of the rows of docs that have the id of a class of wanted(doc_id, cls, block).

    Ids too many to be broadcast are looked for in a sieve first, so that other texts are not shuffled.
    """
    ids = wanted.where("doc_id IS NOT NULL").select("doc_id", "cls", "block")
    small = broadcast_below(ids, BROADCAST_ROWS)
    some = docs if small is not ids else marked(docs, ids, ["doc_id"], INTERNAL + "maybe").where(INTERNAL + "maybe")
    some = some.join(small, "doc_id").select("block", "cls", "text")
    bare = wanted.where("doc_id IS NULL").select("cls", "block")
    if not bare.isEmpty():  # no id leads to the text of such a class
        texts = classed(docs.where("doc_id IS NULL").select("text"), special, words)
        some = some.unionByName(texts.join(broadcast_below(bare, BROADCAST_ROWS), "cls").select("block", "cls", "text"))
    return some


def _number(fp: str):
    """The first eight bytes of a fingerprint, lowest first, as a signed number."""
    bytes_ = [F.conv(F.hex(F.substring(fp, k, 1)), 16, 10).cast("long") for k in range(1, 9)]
    total = bytes_[0]
    for k in range(1, 8):
        total = total.bitwiseOR(F.shiftleft(bytes_[k], 8 * k))
    return total


def sharded(large: DataFrame, percent: int, task_items: int) -> DataFrame:
    """Edges within blocks cut into shards: every shard against itself and every other."""
    size = large.groupBy("block").agg(F.greatest(F.ceil(F.sum("n") * 2 / task_items), F.lit(1)).cast("long").alias("shards"))
    dealt = large.join(size, "block").withColumn("shard", F.pmod(F.xxhash64("cls"), F.col("shards")))
    other = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    pairs = dealt.select("block", "cls", "items", "shard", other.alias("other")).select(
        "block", F.least("shard", "other").alias("one"), F.greatest("shard", "other").alias("two"), "shard", "cls", "items")
    return linked_in_blocks(pairs, percent)


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(table(spark, sf_dir, "documents").select("doc_id", "text"))
