"""Both vector searches against brute force."""

import numpy as np
import pytest

from pluvio.llm import neighbours, topk
from pluvio.llm.mtree import MTree
from pluvio.llm.polytope import hadamard, nearest_axes, rotations
from pluvio.llm.vectors import valid

SF = "/root/testdata/sf0.01"


def test_rotations_keep_lengths_and_axes():
    x = np.random.default_rng(0).standard_normal((20, 24))
    for y in rotations(x, 3, 1):
        assert y.shape == (20, 32) and np.allclose((y**2).sum(1), (x**2).sum(1))
    assert np.allclose(hadamard(hadamard(x[:, :16])), x[:, :16])
    axes = nearest_axes(np.array([[0.1, -3.0], [2.0, 1.0]]), 4)
    assert axes.tolist() == [[3, 0, 2, 1], [0, 1, 3, 2]]


def odd_vectors(spark, n=900, hot=300):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(16).tolist()) for k in range(n)]
    rows += [(n + k, rows[0][1]) for k in range(hot)]  # one vector makes up a share of the rows
    rows += [(5000, None), (5050, []), (5100, [0.0] * 16), (5150, [1.0, None] + [0.0] * 14), (5200, [float("nan")] + [1.0] * 15),
             (5250, [float("inf")] + [1.0] * 15), (5300, [1.0, 2.0]), (5301, [2.0, 1.0]), (None, [1.0] * 16), (50, rows[50][1])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "0 AS score", "1 AS part", "2 AS cell"), rows


def good(rows, zero):
    kept = {}
    for k, v in rows:
        if k is None or not v or any(x is None or not np.isfinite(x) for x in v) or not zero and not any(v):
            continue
        kept[k] = np.array(v)
    return kept


def test_cosine_neighbours(spark):
    df, rows = odd_vectors(spark)
    vectors = valid(df, zero_too=False)
    got = neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"), part=64).collect()
    kept = good(rows, zero=False)
    want = {}
    for q in (k for k in kept if k % 50 == 0):
        scored = sorted((-float((kept[q] * v).sum() / np.sqrt((kept[q] ** 2).sum() * (v**2).sum())), k)
                        for k, v in kept.items() if k != q and len(v) == len(kept[q]))
        want[q] = scored[:5]
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {q for q, w in want.items() if w}
    hits = 0
    for q, rows_ in found.items():
        rows_.sort()
        assert [r[0] for r in rows_] == list(range(1, len(rows_) + 1)) and len(rows_) == len(want[q])
        keys = [(-round(r[2], 12), r[1]) for r in rows_]
        assert keys == sorted(keys)
        hits += len({r[1] for r in rows_} & {k for _, k in want[q]})
        exact = dict((k, -s) for s, k in want[q])
        assert all(r[2] == pytest.approx(exact[r[1]], abs=1e-12) for r in rows_ if r[1] in exact)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert [r[1] for r in found[900]] == [0, 901, 902, 903, 904]  # ties to the smaller id
    assert neighbours.nearest(vectors.limit(0), vectors.limit(0)).count() == 0


def test_recall_on_the_test_table(spark):
    got = neighbours.op2_cross_polytope(spark, SF).toPandas()
    data = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.array(data.embedding.tolist(), np.float64)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    hits = 0
    for q in range(0, 500, 50):
        near = x @ x[q]
        near[q] = -9
        hits += len(set(np.argsort(-near)[:5]) & set(got[got.query_id == q].vec_id))
    assert len(got) == 50 and hits >= 45


def test_inner_products_are_exact(spark):
    df, rows = odd_vectors(spark)
    vectors = topk.quantized(valid(df, zero_too=True))
    got = topk.top(vectors, vectors.where("vec_id % 50 = 0"), tree_rows=100, cells=4, sample=64).collect()
    kept = {k: np.floor(256 * v).astype(np.int64) for k, v in good(rows, zero=True).items()}
    want = []
    for q in (k for k in kept if k % 50 == 0):
        scored = sorted((-int(kept[q] @ v), k) for k, v in kept.items() if k != q and len(v) == len(kept[q]))
        want += [(q, i + 1, k, -s) for i, (s, k) in enumerate(scored[:5])]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk.top(vectors.limit(0), vectors.limit(0)).count() == 0


def test_tree_visits_all_within_the_bound_and_skips_others():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 6)) * 20
    points = np.concatenate([c + rng.standard_normal((60, 6)) for c in centres] + [np.zeros((200, 6))])
    tree = MTree(points, page=16)
    for q in points[::97] + 0.1:
        seen = []

        def leaf(rows, seen=seen, q=q):
            seen.extend(rows[np.sqrt(((points[rows] - q) ** 2).sum(1)) <= 3.0].tolist())
            return 3.0

        before = tree.computed
        tree.search(q, 3.0, leaf)
        assert sorted(seen) == np.flatnonzero(np.sqrt(((points - q) ** 2).sum(1)) <= 3.0).tolist()
        assert tree.computed - before < len(points) / 2


def test_topk_of_huge_components(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(k, rng.standard_normal(8).tolist()) for k in range(120)]
    rows += [(150, [1e10] * 8), (151, [-1e10] * 7 + [3.0]), (152, [1e300] * 8), (200, [-1e300] + [1.0] * 7), (153, [1e5] * 8), (154, [2e300] * 8)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    whole = {k: [int(np.floor(x * 256)) if abs(x) < 1e12 else int(x) * 256 for x in v] for k, v in rows}
    most = (1 << 63) - 1
    want = []
    for q in (k for k in whole if k % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), k) for k, v in whole.items() if k != q)[:5]
        want += [(q, i + 1, k, max(-most - 1, min(most, -s))) for i, (s, k) in enumerate(best)]
    assert sorted(tuple(r) for r in topk.op3_mtree_topk(spark, str(tmp_path)).collect()) == sorted(want)
