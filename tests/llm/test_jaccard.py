"""The Jaccard join against brute force, with every way a block can take."""

import os
import random
import re
from itertools import combinations

import numpy as np
import pytest

from pluvio import session
from pluvio.llm import jaccard, shingles, trie
from pluvio.llm.common import components, marked
from pluvio.llm.ties import first_meetings, tie


def sets_by_hand(text, size=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def brute(rows, size=4, percent=85):
    sets = [sets_by_hand(t, size) for _, t in rows]
    groups = trie.Groups(len(rows))
    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            groups.join(i, j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            g = groups.find(k)
            least[g] = min(least.get(g, doc), doc)
    return sorted((doc, len(sets[k]), least.get(groups.find(k)) if sets[k] else doc) for k, (doc, _) in enumerate(rows) if doc is not None)


def corpus(seed, n=120, copies=90):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(n):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        if rng.random() < 0.4:
            at = rng.randint(0, len(w))
            w = w[:at] + passage + w[at:]
        texts.append(w)
    base = [rng.choice(vocabulary) for _ in range(80)]
    for _ in range(copies):
        w = list(rng.choice([base, rng.choice(texts)]))
        for _ in range(rng.randint(0, 3)):
            if w:
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(w)
    rows = [(k, rng.choice([" ", "\n", "\t "]).join(w)) for k, w in enumerate(texts)]
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (1003, "One two"), (1004, "one TWO"), (1005, "É x y z a"), (1006, "é x y z a"), (1000, None)]


@pytest.mark.parametrize("limits", [{}, {"TASK_ITEMS": 400, "HOT_ITEM": 5}])
def test_join_against_brute_force(spark, monkeypatch, limits):
    rows = corpus(3)
    monkeypatch.setattr(jaccard, "HOT_ITEM", limits.get("HOT_ITEM", jaccard.HOT_ITEM))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id").selectExpr("*", "1 AS n", "2 AS block", "3 AS component_id")
    got = jaccard.links(docs.repartition(3), task_items=limits.get("TASK_ITEMS", jaccard.TASK_ITEMS))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_chains_under_every_order_of_leaders(spark):
    """Four texts of which only neighbours link: their classes may come up as leaders in any order."""
    rows, orders = [], set()
    for k in range(400):
        words = [f"c{k}w{i}" for i in range(127)]
        texts = [" ".join(words[8 * i:8 * i + 103]) for i in range(4)]
        order = tuple(np.argsort([jaccard._signed(shingles.fingerprint(s)[:8]) for s in shingles.shingle_sets(texts)]).tolist())
        if order not in orders:
            orders.add(order)
            rows += [(4 * k + i, t) for i, t in enumerate(texts)]
    assert len(orders) == 24
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.links(docs, task_items=150)
    assert sorted(tuple(r) for r in got.collect()) == sorted((d, 100, d // 4 * 4) for d, _ in rows) == brute(rows)


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (5, "a b c d e"), (4, "a b c d e"), (None, None)], "doc_id long, text string")
    got = [tuple(r) for r in jaccard.links(docs).collect()]
    assert sorted(got, key=str) == sorted([(None, 2, 4), (5, 2, 4), (4, 2, 4), (None, 0, None)], key=str)
    assert jaccard.links(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [jaccard.TASK_ITEMS, 150])
def test_null_ids_bridge(spark, limit):
    """Rows of a null id link what only they connect."""
    words = [f"w{i}" for i in range(127)]
    chain = [" ".join(words[8 * i:8 * i + 103]) for i in range(4)]
    rows = [(7, chain[0]), (None, chain[1]), (None, chain[1].upper()), (None, chain[2]), (3, chain[3]), (None, "x y z a b"), (9, "q r s t u")]
    got = jaccard.links(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), task_items=limit).collect()
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == brute(rows) == [(3, 100, 3), (7, 100, 3), (9, 2, 9)]
    assert sorted((r.n_shingles, r.component_id or 0) for r in got if r.doc_id is None) == [(2, 0), (100, 3), (100, 3), (100, 3)]


def test_shingles_of_long_words_and_chunks(monkeypatch):
    texts = [" ".join(["ab" * 50, "c", "d" * 300, "e f"] * 3), "x" * 1000, "a b c d", "", " a  b\tc\x0bd "]
    whole = shingles.shingle_sets(texts)
    monkeypatch.setattr(shingles, "CHUNK", 16)
    assert all((a == b).all() for a, b in zip(whole, shingles.shingle_sets(texts), strict=True))
    assert (whole[2] == whole[4]).all() and [len(s) for s in whole] == [len(sets_by_hand(t)) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_trie_and_ties_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 62, 150).astype(np.uint64)
    sets = []
    for _ in range(200):
        keep = base[rng.random(150) > rng.choice([0.03, 0.1, 0.6])]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 62, rng.integers(1, 12)).astype(np.uint64)])))
    want = trie.Groups(200)
    pairs = []
    for i, j in combinations(range(200), 2):
        c = len(np.intersect1d(sets[i], sets[j]))
        if 100 * c >= 85 * (len(sets[i]) + len(sets[j]) - c):
            want.join(i, j)
            pairs.append((i, j))
    assert pairs
    assert trie.join_within(sets) == [want.find(k) for k in range(200)]
    two = trie.join_within(sets[:90], 85, sets[90:])
    assert all(two[i] == two[j] for i, j in pairs if i < 90 <= j)
    loose = tie([len(s) for s in sets], [shingles.parity_bits(s) for s in sets], 85)
    assert all(loose[i] == loose[j] for i, j in pairs)


def test_components_of_chains(spark):
    rng = random.Random(1)
    ids = list(range(300))
    rng.shuffle(ids)
    chain = [(ids[k], ids[k + 1]) for k in range(199)] + [(ids[k], ids[k + 1]) for k in range(200, 299)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{k: min(ids[:200]) for k in ids[:200]}, **{k: min(ids[200:]) for k in ids[200:]}}


def test_words_that_collide_in_polynomial_hashes_are_different_shingles():
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    one, two = shingles.shingle_sets([f"{a} is a word", f"{b} is a word"])
    assert len(one) == len(two) == 1 and one[0] != two[0]


def test_first_meetings_keep_where_linked_sets_meet_first():
    """Items are their own order. Every linked pair stays at its first shared item; most other postings go."""
    rng = np.random.default_rng(3)
    base = rng.permutation(3000)[:400]
    sets = [np.unique(rng.integers(0, 3000, rng.integers(1, 400))) for _ in range(150)]
    sets += [np.unique(np.concatenate([base[rng.random(400) > rng.choice([0.02, 0.06, 0.2])], rng.integers(0, 3000, 5)])) for _ in range(30)]
    for percent in (80, 85):
        rows = [(x, k, len(s), i) for k, s in enumerate(sets) for i, x in enumerate(s[:len(s) - -(-percent * len(s) // 100) + 1])]
        rows += rows[::7]  # copies from other tasks
        rng.shuffle(rows)
        item, cls, n, place = (np.array(c) for c in zip(*rows, strict=True))
        keep = first_meetings(item, cls, n.astype(np.int32), place.astype(np.int32), percent)
        kept = set(zip(item[keep].tolist(), cls[keep].tolist(), strict=True))
        assert len(kept) == len(keep) < len(set(zip(item.tolist(), cls.tolist(), strict=True))) // 2
        linked = 0
        for i, j in combinations(range(len(sets)), 2):
            common = np.intersect1d(sets[i], sets[j])
            if 100 * len(common) >= percent * (len(sets[i]) + len(sets[j]) - len(common)):
                linked += 1
                assert {(int(common[0]), i), (int(common[0]), j)} <= kept
        assert linked > 30
    assert not len(first_meetings(*(np.zeros(0, np.int64) for _ in range(4)), 85))


def test_join_with_ids_that_cannot_be_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jaccard, "POSTINGS", 50)
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in jaccard.links(docs).collect()) == brute(rows)


def test_join_leaves_no_postings_and_no_spent_shuffles_on_disk(spark):
    """What a step has read for the last time goes, whether or not the driver collects its garbage."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: sum("shuffle_" in str(disk.getAllFiles().apply(k)) for k in range(disk.getAllFiles().size()))
    before = shuffles()
    session.stage(spark.range(1000).repartition(4).groupBy("id").count(), "counted")
    assert shuffles() <= before
    root = session._stage_root(spark)
    known = set(os.listdir(root))
    docs = spark.createDataFrame(corpus(5), "doc_id long, text string").repartition(3)
    jaccard.links(docs, task_items=400).collect()
    left = {name.rsplit("-", 5)[0] for name in set(os.listdir(root)) - known}
    assert not left & {"postings", "shared", "meet", "near", "ties", "point", "jumped", "compared"}


def test_marked_rows(spark):
    keys = spark.createDataFrame([(7, "a"), (None, "b"), (9, None), (7, "a")], "k int, s string")
    rows = [(7, "a", 1), (7, "b", 2), (None, "b", 3), (9, None, 4), (None, None, 5)] + [(k, "c", k) for k in range(20, 20000)]
    df = spark.createDataFrame(rows, "k long, s string, v long")
    got = marked(df, keys, ["k", "s"], "in").where("in").collect()
    assert {r.v for r in got if r.v < 20} == {1, 3, 4} and len(got) < 10
    assert marked(df, keys, ["k", "s"], "in").count() == len(rows)
    assert marked(df, keys.limit(0), ["k", "s"], "in").where("in").count() == 0
