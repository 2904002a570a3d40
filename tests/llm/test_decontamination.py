"""Benchmark passages in documents, against a search of every window at every place."""

import hashlib
import random
import re

import pytest

from pluvio.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10, shingle=5, containment=1.0):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, named = words(text), set(), set()
        for x, owners in wins.items():
            n, size = len(x), min(shingle, len(x))
            m = n - size + 1
            for p in range(len(w) - n + 1):
                same = sum(tuple(w[p + j:p + j + size]) == x[j:j + size] for j in range(m))
                if same >= max(1, -(-round(containment * m * 1000) // 1000)):
                    hit |= set(range(p, p + n))
                    named |= {str(o) for o in owners if o is not None}
        out.append((doc, len(w), len(hit), len(named), sorted(named)))
    return sorted(out, key=repr)


def odd_tables():
    rng = random.Random(5)
    vocabulary = ["the", "of", "a", "É", "é", "x9", "Straße", "日本"] + [f"w{k}" for k in range(40)]
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(say(rng.choice([4, 9, 10, 11, 25])))) for k in range(12)]
    items += [(20, "Alone"), (21, "two words"), (22, ""), (23, None), (24, "?!"), (None, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"),
              (3, items[3][1]), (3, "another text of the same item id w1 w2 w3"), (25, items[0][1])]
    docs = []
    for k in range(60):
        text = say(rng.randint(0, 40))
        for _ in range(rng.randint(0, 2)):
            got = (rng.choice(items)[1] or "").split()
            at = rng.randint(0, len(text))
            cut = rng.randint(0, 3)
            text[at:at] = got[cut:] if rng.random() < 0.5 else got[:len(got) - cut]
        docs.append((k, " ".join(text).upper() if k % 3 == 0 else ", ".join(text)))
    same = docs[7]
    docs += [same] * 5 + [(7, docs[8][1]), (None, docs[9][1]), (None, None), (100, None), (101, ""), (102, "w1 " * 500), (103, " ".join(say(30) * 60))]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS k", "2 AS p", "'x' AS words", "3 AS sid", "4 AS n_words"),
            spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' AS w", "1 AS n", "map(1, 2) AS m"))


@pytest.mark.parametrize(("small", "containment"), [(dc.SMALL, 1.0), (0, 1.0), (dc.SMALL, 0.6)])
def test_equals_brute_force(spark, small, containment):
    docs, items = odd_tables()
    got = dc.contamination(*frames(spark, docs, items), small=small, containment=containment).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, list(r.item_ids)) for r in got), key=repr) == brute(docs, items, containment=containment)


def test_empty_tables(spark):
    docs, items = odd_tables()
    d, i = frames(spark, docs[:20], items)
    assert dc.contamination(d.limit(0), i).count() == 0
    none = dc.contamination(d, i.limit(0)).collect()
    assert len(none) == 20 and all(r.n_hit == 0 and r.item_ids == [] for r in none)


def test_the_query_gives_digests(spark, tmp_path):
    docs, items = odd_tables()
    for name, df in zip(("documents", "benchmark"), frames(spark, docs, items), strict=True):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = dc.op11_prefix_decontamination(spark, str(tmp_path)).collect()
    want = [(d, n, h, k, hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0) for d, n, h, k, ids in brute(docs, items)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
