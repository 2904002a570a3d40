"""Interpolation and masks against brute force."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.operators import grid as gr
from pluvio.operators import idw, mask
from pluvio.config import Interp, Limits
from pluvio.sources import polygons

GRID = gr.Grid(12, 9, 0.0, 0.0, 100.0, 100.0)


def frames(spark, centers, values, **kw):
    c = spark.createDataFrame(centers, "cml_id bigint, px double, py double")
    v = spark.createDataFrame(values, "cml_id bigint, time int, z double")
    targets = gr.cells(spark, GRID)
    out = idw.interpolate(v, c, targets, tile=4, **kw).collect()
    return {(r["time"], r["row"], r["col"]): r["v"] for r in out}


def brute(centers, values, near, radius, power):
    out = {}
    for t in {v[1] for v in values}:
        z = {c: x for c, tt, x in values if tt == t and x is not None}
        for row in range(GRID.ny):
            for col in range(GRID.nx):
                x, y = (col + 0.5) * 100.0, (row + 0.5) * 100.0
                near_by = sorted(
                    (np.floor(np.hypot(px - x, py - y) / radius * 1e8), c, np.hypot(px - x, py - y))
                    for c, px, py in centers if c in z and np.hypot(px - x, py - y) < radius
                )[:near]
                if not near_by:
                    continue
                if near_by[0][2] < 1e-10:
                    out[(t, row, col)] = z[near_by[0][1]]
                else:
                    w = [d**-power for _, _, d in near_by]
                    out[(t, row, col)] = sum(a * z[c] for a, (_, c, _) in zip(w, near_by)) / sum(w)
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], rel=1e-9), key


def test_literals(spark):
    # Links at distances 1 and 2 of the cell point (50, 50); one link on the point (350, 350).
    centers = [(1, 51.0, 50.0), (2, 50.0, 52.0), (3, 350.0, 350.0)]
    values = [(1, 0, 10.0), (2, 0, 0.0), (3, 0, 7.0)]
    got = frames(spark, centers, values, near=12, radius=60.0, power=2.0)
    assert got[(0, 0, 0)] == pytest.approx(8.0)
    assert got[(0, 3, 3)] == 7.0
    assert (0, 8, 11) not in got


@pytest.mark.parametrize("case", ["plain", "missing", "crowded", "copies"])
def test_against_brute_force(spark, monkeypatch, case):
    monkeypatch.setattr(idw, "LEAF", 6)  # so that small data needs several levels
    rng = np.random.default_rng(3)
    centers = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-100, 1200, (60, 2)))]
    if case == "crowded":  # a third of the links in one spot
        centers += [(100 + i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(430, 4, (40, 2)))]
    if case == "copies":
        centers += [(200 + i, 610.0, 390.0) for i in range(40)]
    values = [
        (c, t, None if case == "missing" and rng.uniform() < 0.4 else float(rng.uniform(0, 9)))
        for c, _, _ in centers for t in range(3)
    ]
    got = frames(spark, centers, values, near=5, radius=300.0, power=2.0, parts=2)
    same(got, brute(centers, values, 5, 300.0, 2.0))
    known = [z for _, _, z in values if z is not None]
    assert min(known) - 1e-9 <= min(got.values()) and max(got.values()) <= max(known) + 1e-9


@pytest.mark.parametrize(("depth", "share"), [(5, 0.5), (6, 0.9), (None, 0.98)])
def test_links_that_come_and_go(spark, depth, share):
    """Every step has a set of links of its own; lists that run out are made deeper."""
    rng = np.random.default_rng(6)
    centers = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-100, 1200, (80, 2)))]
    centers += [(100 + i, 610.0, 390.0) for i in range(50)] + [(200, 50.0, 50.0), (201, 50.0, 50.0), (202, 50.0, 50.00000001)]
    values = [(c, t, None if rng.uniform() < share else float(rng.uniform(0, 9))) for c, _, _ in centers for t in range(12)]
    got = frames(spark, centers, values, near=5, radius=420.0, power=2.0, parts=3, depth=depth)
    same(got, brute(centers, values, 5, 420.0, 2.0))


def test_lists_are_searched_once_if_they_last(spark, monkeypatch):
    searches = []
    plain = idw.nearest_links
    monkeypatch.setattr(idw, "nearest_links", lambda *a: searches.append(a[2]) or plain(*a))
    rng = np.random.default_rng(7)
    centers = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 1200, (90, 2)))]
    values = [(c, t, None if (c + t) % 10 == 0 else 1.0) for c, _, _ in centers for t in range(20)]  # no two steps with the same links
    frames(spark, centers, values, near=5, radius=400.0, power=2.0)
    assert searches == [10]


def test_no_values(spark):
    assert frames(spark, [(1, 5.0, 5.0)], [(1, 0, None)], near=3, radius=100.0, power=2.0) == {}


def inside(spark, rings, grid=gr.Grid(6, 6, -0.5, -0.5, 1.0, 1.0)):
    found = mask.inside_cells(polygons.edges(polygons.literal_rings(spark, rings)), grid)
    return {(r["col"], r["row"]) for r in found.collect()}


def test_square(spark):
    got = inside(spark, [[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]])
    assert (1, 1) in got and (3, 1) not in got


def test_concave_and_level_vertex(spark):
    # A notch from above; the vertex (2.5, 2) lies level with a row of points.
    got = inside(spark, [[(0.5, 0.5), (4.5, 0.5), (4.5, 4.5), (2.5, 2.0), (0.5, 4.5)]])
    assert {(1, 1), (2, 1), (1, 2), (4, 2), (1, 3), (4, 3)} <= got
    assert (2, 3) not in got and (3, 3) not in got and (5, 2) not in got and (0, 2) not in got


def test_geojson(spark, tmp_path):
    square = lambda x, y: [[x, y], [x + 2, y], [x + 2, y + 2], [x, y + 2], [x, y]]
    data = {
        "type": "FeatureCollection",
        "features": [
            {"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[square(0.5, 0.5)]]}},
            {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [square(3.5, 3.5)]}},
        ],
    }
    path = tmp_path / "mask.json"
    path.write_text(json.dumps(data, indent=1))
    edges = polygons.read_geojson(spark, str(path))
    assert edges.count() == 8
    found = mask.inside_cells(edges, gr.Grid(6, 6, -0.5, -0.5, 1.0, 1.0))
    assert {(r["col"], r["row"]) for r in found.collect()} == {(1, 1), (2, 1), (1, 2), (2, 2), (4, 4), (5, 4), (4, 5), (5, 5)}


def test_overlapping_features_unite(spark, tmp_path):
    """Features that overlap, repeat, hold another one, or fill another one's hole: a cell is inside if any of them has it, once."""
    def ring(x, y, w, h):
        return [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]

    shapes = [
        [[ring(0.5, 0.5, 4, 4)]], [[ring(2.5, 2.5, 4, 3)]], [[ring(2.5, 2.5, 4, 3)]], [[ring(7.5, 0.5, 4, 4), ring(8.5, 1.5, 2, 2)]],
        [[ring(9.5, 2.5, 1, 1)], [ring(1.5, 6.5, 3, 2), ring(2.5, 6.6, 1, 1)]],
    ]
    features = [{"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": x} if len(x) > 1 else {"type": "Polygon", "coordinates": x[0]}} for x in shapes]
    path = tmp_path / "mask.json"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))

    def within(points, x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(points, points[1:]):
            odd ^= ((y1 <= y) != (y2 <= y)) and x1 + (x2 - x1) * (y - y1) / (y2 - y1) > x
        return odd

    want = {(c, r) for c in range(13) for r in range(10) if any(sum(within(p, c, r) for p in poly) % 2 for shape in shapes for poly in shape)}
    rows = mask.inside_cells(polygons.read_geojson(spark, str(path)), gr.Grid(13, 10, -0.5, -0.5, 1.0, 1.0)).collect()
    assert len(rows) == len({tuple(r) for r in rows}) and {(r["col"], r["row"]) for r in rows} == want


def test_grids():
    assert (gr.make_grid().nx, gr.make_grid().ny) == (598, 378)
    degrees = gr.make_grid(Interp(mercator=False), Limits(0.0, 1.0, 0.0, 0.5))
    assert (degrees.nx, degrees.ny, degrees.shift) == (40, 20, 0.0)
    step = gr.make_grid(Interp(nx=None, ny=None, step_m=10000.0))
    assert step.nx == 93


def test_lookup(spark):
    cells = spark.createDataFrame([(0, r, c, float(10 * r + c)) for r in range(3) for c in range(3)], "time int, row int, col int, r double")
    points = spark.createDataFrame([(1, 0.4, 0.6), (2, 9.0, -9.0), (3, 0.5, 1.5)], "point_id int, x double, y double")
    got = {r["point_id"]: r["r"] for r in gr.lookup(points, cells, Limits(0, 2, 0, 2), 3, 3).collect()}
    assert got == {1: 10.0, 2: 2.0, 3: 20.0}


def test_crowded_cubes_are_split(spark, monkeypatch):
    """A third of the places in one cube gives the pairs that plain comparison gives, split or not."""
    from pluvio.operators import nearby as nb

    rng = np.random.default_rng(8)
    spots = [(50.0 + rng.normal() * 0.005, 14.0 + rng.normal() * 0.005) if k % 3 == 0 else (49 + rng.random() * 2, 13 + rng.random() * 3) for k in range(120)]
    rows = [(k, 1.0, a, b, a + 0.01, b + 0.01) for k, (a, b) in enumerate(spots)]
    links = spark.createDataFrame(rows, "cml_id bigint, length double, lat_a double, lon_a double, lat_b double, lon_b double")
    table, _ = nb.places(links, 5.0)
    plain = {tuple(r) for r in nb.place_pairs(table, 5.0).select("place_id_1", "place_id_2", "n_links").collect()}
    monkeypatch.setattr(nb, "CROWDED_PLACES", 7)
    split = nb.place_pairs(table, 5.0).select("place_id_1", "place_id_2", "n_links").collect()
    assert len(split) == len(plain) and {tuple(r) for r in split} == plain and len(plain) > 1600


def test_link_pairs_with_twins(spark):
    """Every link near another is listed, also those that lie at one place, against all pairs by formula."""
    from pluvio.functions.geo import haversine_km
    from pluvio.operators import nearby as nb

    ends = [(50.0, 14.0, 50.03, 14.0), (50.0, 14.0, 50.03, 14.0), (50.01, 14.0, 50.02, 14.0), (50.0, 14.0, 50.03, 14.0), (50.0, 14.0, 50.2, 14.0),
            (50.0, 14.0, 50.2, 14.0), (52.0, 14.0, 52.01, 14.0)]
    links = spark.createDataFrame([(i, *e) for i, e in enumerate(ends)], "cml_id long, lat_a double, lon_a double, lat_b double, lon_b double")
    links = links.withColumn("length", haversine_km(*[F.col(c) for c in nb.ENDS]))
    got = {(r["id1"], r["id2"]): [r[d] for d in nb.DISTANCES] for r in nb.link_pairs(links, 10.0).collect()}

    def far(p, q):
        h = np.radians(np.array([*p, *q]))
        s = np.sin((h[2] - h[0]) / 2) ** 2 + np.cos(h[0]) * np.cos(h[2]) * np.sin((h[3] - h[1]) / 2) ** 2
        return 2 * 6373.0 * np.arctan2(np.sqrt(s), np.sqrt(1 - s))

    want = {}
    for i, a in enumerate(ends):
        for j, b in enumerate(ends):
            d = [0.0 if i == j else far(a[p:p + 2], b[q:q + 2]) for p in (0, 2) for q in (0, 2)]
            if max(d) < 10.0:
                want[i, j] = d
    assert set(got) == set(want) and len(got) == 19
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
