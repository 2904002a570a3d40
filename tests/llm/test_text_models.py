"""Toxicity and quality: gradients, lookup tables, held-out accuracy, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import gam, quality, toxicity
from pluvio.llm.gru import Network, Scorer, Shape, gram_rows, train, window_starts, word_row

SF = "/root/testdata/sf0.01"


def test_gradients_agree_with_differences():
    shape = Shape(window=5, step=3, hidden=3, word_dim=2, char_dim=3, word_rows=50, char_rows=60)
    net = Network.fresh(shape)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    names = ["ab", "cde", "f", "ghi"]
    own = np.array([word_row(x, shape) for x in names])
    flat, n = gram_rows(names, shape)
    index = np.array([[0, 1, 2, 3, 1], [2, 3, 0, 0, 0], [1, 0, 0, 0, 0]])
    args = (own, flat, n, np.array([1, 0, 1, 1.0]), index, np.array([5, 2, 1]), np.array([1.0, 0, 1]))
    _, grads = net.gradients(*args)
    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        was, h = net.weights[name][at], 1e-3
        net.weights[name][at] = was + h
        up, _ = net.gradients(*args)
        net.weights[name][at] = was - h
        down, _ = net.gradients(*args)
        net.weights[name][at] = was
        assert g[at] == pytest.approx((up - down) / (2 * h), rel=2e-3, abs=1e-7), name


def test_windows_overlap_and_reach_the_end():
    shape = Shape(window=8, step=6)
    for n in range(60):
        starts = window_starts(n, shape)
        covered = {i for s in starts for i in range(s, min(n, s + 8))}
        assert covered == set(range(n)) and len(set(starts)) == len(starts)


def test_learns_words_and_spellings_anywhere_in_a_text():
    rng = np.random.default_rng(0)
    syllables = ["ta", "ro", "mi", "ne", "sul", "kor", "pe"]

    def words(n):
        return ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n)]

    def text(bad):
        w = words(int(rng.integers(5, 200)))
        if bad:
            w[int(rng.integers(len(w)))] = str(rng.choice(["zzorg", "qux" + "".join(words(1))]))
        return " ".join(w)

    y = [k % 2 for k in range(600)]
    net = train([text(b) for b in y], y, Shape(window=32, step=24, word_rows=4096, char_rows=4096), epochs=8)
    scorer = Scorer(net, remember=500)
    test = [text(b) for b in y[:200]]
    got = scorer.scores(test) >= 0.5
    assert (got == np.array(y[:200], bool)).mean() > 0.95
    assert np.allclose(scorer.scores(test), Scorer(net).scores(test), atol=1e-5)  # forgetting changes nothing
    long = " ".join(words(3000) + ["zzorg"])
    assert scorer.scores([long, long[:-6]])[0] > 0.5 > scorer.scores([long, long[:-6]])[1]


def test_toxicity_on_held_out_rows_and_odd_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (3, "  \n", 5.0), (None, "word " * 20_000, 5.0), (3, "  \n", 5.0)],
                                "doc_id long, text string, score double")
    rows = toxicity.score(odd, net, ["doc_id"]).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows if r.doc_id}
    assert by[1] == by[2] == by[3]
    assert toxicity.score(odd.limit(0), net, ["doc_id"]).count() == 0
    kept = toxicity.reject(odd, net)
    assert kept.columns == odd.columns
    bad = spark.createDataFrame([(7, " ".join(["idiot moron scum worthless"] * 5))], "doc_id long, text string")
    assert toxicity.score(bad, net, ["doc_id"]).first().score > 0.5 and toxicity.reject(bad, net).count() == 0
    constant = toxicity.fit(docs, labels.limit(0))
    assert toxicity.reject(docs.limit(20), constant).count() == 20


def test_additive_model_finds_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = gam.fit(x, y)
    assert (0, 1) in model.pairs
    assert ((model.score(x) > 0.5) == y.astype(bool)).mean() > 0.93
    b = model.bins(x[:5])
    by_hand = [model.intercept + sum(t[b[k, j]] for j, t in enumerate(model.tables))
               + sum(t[b[k, i], b[k, j]] for (i, j), t in zip(model.pairs, model.pair_tables)) for k in range(5)]
    assert np.allclose(model.margin(x[:5]), by_hand)
    assert np.allclose(gam.fit(np.zeros((0, 3)), np.zeros(0)).score(x[:3]), 0.5)
    assert (gam.fit(x, np.ones(3000)).score(x) > 0.99).all()


def test_quality_on_held_out_rows_and_odd_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.op5_quality(spark, SF)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"] and out.count() == docs.count()
    test = out.where("held_out").join(labels.where("quality IS NOT NULL"), "doc_id")
    right = test.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.95
    model = quality.fit(docs, labels)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "\n \n"), (4, "a" * 200_000)], "doc_id long, text string")
    rows = quality.score(odd, model, ["doc_id"]).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(odd.limit(0), model, ["doc_id"]).count() == 0
    assert quality.score(docs.limit(3), quality.fit(docs.limit(0), labels), ["doc_id"]).first().score == pytest.approx(0.5)


def test_the_middle_of_long_words_counts():
    from pluvio.llm.gru import words_of

    one, two = "a" * 20 + "xy" + "b" * 20, "a" * 20 + "zw" + "b" * 20
    assert words_of(one) != words_of(two)
    for n in (32, 33, 60, 61, 500):
        word = "".join(chr(0x4E00 + k) for k in range(n))
        pieces = words_of(f"hello {word} there")[1:-1]
        assert max(map(len, pieces)) <= 32 and {word[i:i + 4] for i in range(n - 3)} <= {p[i:i + 4] for p in pieces for i in range(len(p) - 3)}
