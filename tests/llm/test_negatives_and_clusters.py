"""Hard negatives and centroid clustering against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pluvio.llm import bigints, negatives, walsh
from pluvio.llm.onebit import Codes, turned


def integers(v, scale):
    return [math.floor(x * scale) if abs(x) < 2**40 else int(x) * scale for x in v]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


@given(st.integers(-(1 << 400), 1 << 400), st.integers(-(1 << 400), 1 << 400))
def test_scores_keep_their_order_and_value(a, b):
    assert all(bigints.exact(bigints.clamped(x), bigints.beyond(x)) == x for x in (a, b))
    key = [(bigints.clamped(x), bigints.beyond(x) or b"") for x in (a, b)]
    assert (key[0] < key[1]) == (a < b)


@settings(deadline=None, max_examples=40)
@given(st.integers(0, 10_000), st.sampled_from([3, 16, 64, 100]))
def test_intervals_hold_the_scores(seed, dims):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.standard_normal((50, dims)) * 10.0 ** rng.integers(0, 6, (50, 1)))
    x[0] = 0
    queries = np.concatenate([x[:8], -x[:4], np.floor(rng.standard_normal((4, dims)) * 300)])
    codes = Codes(x)
    for q, r in zip(queries, turned(queries), strict=True):
        low, high = codes.intervals(r)
        assert (low <= x @ q).all() and (x @ q <= high).all()


def test_intervals_leave_out_what_is_far():
    rng = np.random.default_rng(1)
    centre = rng.standard_normal((2, 64)) * 100
    x = np.concatenate([c + rng.standard_normal((200, 64)) for c in (centre[0], -centre[0])])
    low, high = Codes(x).intervals(turned(centre[:1])[0])
    assert high[200:].max() < low[:200].min()


def odd_rows(dims=16, n=260):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((5, dims))
    rows = [(k, (centres[k % 5] + rng.standard_normal(dims) * 0.6).tolist(), int(rng.integers(0, 4))) for k in range(n)]
    rows += [(n + k, rows[0][1], k % 2) for k in range(120)]  # one vector makes up a share of the rows
    return rows + [(900, None, 1), (901, [1.0] * dims, None), (902, [None] + [1.0] * (dims - 1), 2), (903, [float("nan")] * dims, 2),
                   (904, [float("inf")] + [0.0] * (dims - 1), 2), (905, [], 1), (906, [1.0, 2.0], 1), (907, [2.0, 1.0], 2), (908, [1.5, 2.0], 1),
                   (1000, [0.0] * dims, 3), (None, [1.0] * dims, 1), (100, rows[100][1], rows[100][2])]


def brute_negatives(rows, low=30, high=90):
    kept = {}
    for k, v, label in sorted((r for r in rows if r[0] is not None and r[2] is not None and r[1]), key=lambda r: r[0]):
        if all(x is not None and math.isfinite(x) for x in v):
            kept[k] = (integers(v, 256), (label + 1) % 10 if k % 7 == 0 else label)
    out = []
    for a, (q, label) in kept.items():
        if a % 100:
            continue
        scored = sorted((-dot(q, v), k, other) for k, (v, other) in kept.items() if k != a and len(v) == len(q))
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            fit = [(k, -t) for t, k, other in scored if other != label and low * -s <= 100 * -t <= high * -s][:10]
            out += [(a, p, i + 1, k, bigints.clamped(-s), bigints.clamped(t)) for i, (k, t) in enumerate(fit)]
    return sorted(out)


def table_of(spark, rows):
    df = spark.createDataFrame([(k, v, x) for k, v, x in rows], "vec_id long, embedding array<double>, label int")
    return df.selectExpr("*", "1 AS block", "2 AS kind", "3 AS score", "4 AS rank", "'b' AS bands", "5 AS t", "6 AS cluster")


@pytest.mark.parametrize("huge", [False, True])
def test_hard_negatives_equal_brute_force(spark, tmp_path, huge):
    rows = odd_rows()
    if huge:
        rows += [(1100, [1e10] * 16, 1), (1101, [1e10] * 15 + [2e10], 1), (1102, [5e9] * 16, 2), (1103, [-1e300] * 16, 2), (1200, [1e300] + [0.0] * 15, 3)]
    table_of(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert sorted(map(tuple, negatives.op12_onebit_hard_negatives(spark, str(tmp_path)).collect())) == brute_negatives(rows)


def test_hard_negatives_of_many_blocks_and_of_none(spark):
    rows = odd_rows()
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    usable = negatives.usable(table_of(spark, rows), label)
    got = negatives.mine(usable, F.col("vec_id") % 100 == 0, block_rows=20)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)
    assert negatives.mine(usable.limit(0), F.col("vec_id") % 100 == 0).count() == 0


@settings(deadline=None, max_examples=30)
@given(st.integers(0, 10_000), st.sampled_from([1, 2, 8, 64]))
def test_transform_and_search(seed, dims):
    rng = np.random.default_rng(seed)
    x = rng.integers(-50, 50, (30, dims))
    t = walsh.transform(x)
    assert (walsh.restore(t) == x).all() and ((t * t).sum(1) == dims * (x * x).sum(1)).all()
    c = rng.integers(-50, 50, (6, dims))
    c[3] = c[1]
    cluster, distance, _ = walsh.nearest(t, walsh.transform(c))
    full = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (cluster == full.argmin(1)).all() and (distance == full.min(1)).all()


def test_search_takes_less_than_all_coefficients():
    rng = np.random.default_rng(2)
    c = rng.integers(-3000, 3000, (64, 64))
    x = c[rng.integers(0, 64, 500)] + rng.integers(-30, 30, (500, 64))
    assert walsh.nearest(walsh.transform(x), walsh.transform(c))[2] < 0.5 * 500 * 64 * 64


def brute_clusters(rows, k=8, rounds=10):
    kept = [(i, integers(v, 1024)) for i, v, *_ in rows if v and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for j, g in groups.items():
            centres[j] = [sum(x) // len(g) for x in zip(*g, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    most = (1 << 63) - 1
    inertia = [min(most, sum(min(most, d) for _, j, d in found if j == c)) for c in range(len(centres))]
    whole = min(most, sum(min(most, d) for *_, d in found))
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, min(most, d), inertia[j], whole, digest[j]) for i, j, d in found), key=repr)


@pytest.mark.parametrize("kind", ["many", "few", "huge"])
def test_clusters_equal_brute_force(spark, tmp_path, kind):
    rows = odd_rows(64, 200)
    if kind == "few":
        rows = rows[:5] + rows[-9:]
    if kind == "huge":
        rows += [(2000, [1e10] * 64, 1), (2001, [-3e300] + [1e200] * 63, 1), (2002, [20000.0] * 64, 0)]
    table_of(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert sorted(map(tuple, walsh.op13_walsh_clustering(spark, str(tmp_path)).collect()), key=repr) == brute_clusters(rows)


def test_clusters_of_nothing(spark):
    assert walsh.cluster(walsh.kept(table_of(spark, odd_rows(64)).limit(0)))[0].count() == 0
