"""Point in polygon by leaves, against the even-odd test over whole rings."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from civigrid.operators import geo as G
from civigrid.operators import quadtree as Q


def by_rings(e, x, y):
    """Even-odd over all edges, borders inside."""
    return on_edge(e, x, y) or Q.crossed(e, np.array([x]), np.array([y])).sum() % 2 == 1


def by_leaf(tree, x, y):
    """``tree`` has leaves by their cells."""
    met = [tree[c] for c in ((k, math.floor(x / s), math.floor(y / s)) for k, s in enumerate(Q.SIZES)) if c in tree]
    assert len(met) < 2  # leaves don't overlap
    for right, parity, e in met:
        px, py = np.array([x]), np.array([y])
        return on_edge(e, x, y) or (parity + Q.added(e, np.array([right]), px, py).sum()) % 2 == 1
    return False


def on_edge(e, x, y):
    cross = (x - e[:, 0]) * (e[:, 3] - e[:, 1]) - (y - e[:, 1]) * (e[:, 2] - e[:, 0])
    on = (cross == 0) & (x >= np.minimum(e[:, 0], e[:, 2])) & (x <= np.maximum(e[:, 0], e[:, 2])) & (y >= np.minimum(e[:, 1], e[:, 3])) & (y <= np.maximum(e[:, 1], e[:, 3]))
    return bool(on.any())


def star(n, cx=-110.9, cy=32.2, r=0.3, seed=1, step=None, rough=0.4):
    """A ring of n vertices around a centre, more or less rough; with ``step`` on a grid, so that points fall on vertices and edges."""
    rng = random.Random(seed)
    ring = []
    for i in range(n):
        a = 2 * math.pi * i / n
        q = r * (1 - rough * rng.random()) * (0.8 + 0.2 * math.sin(7 * a))
        x, y = cx + q * math.cos(a), cy + q * math.sin(a)
        ring.append([round(x / step) * step, round(y / step) * step] if step else [x, y])
    return [*ring, ring[0]]


@pytest.mark.parametrize("most", [1, 4, 32])
def test_leaves_agree_with_rings(most):
    rng = random.Random(most)
    shapes = [[star(40, seed=s, step=1 / 64), star(12, r=0.1, seed=s + 50, step=1 / 64)] for s in range(6)]
    shapes += [[star(300, seed=9)], [[[-1, -1], [1, -1], [1, 1], [-1, 1], [-1, -1]], [[-0.5, -0.5], [0.5, -0.5], [0.5, 0.5], [-0.5, 0.5]]], [[[-179, -89], [179, -89], [0, 89]]]]
    shapes += [[[[0, 0], [3, 1]] * 60]]  # edges on each other
    shapes += [[[[0, 0], [8, 0], [8, 8], [0, 8], [0, 0], [4, 4], [8, 0]]], [[[0, 0], [0.5, 0.5], [0, 0]]], [[[1, 1]]], [[]], [[[0, 0], [None, 1], [2, 2], [2, 0], [1]]]]
    for shape in shapes:
        rings = [Q.ring_edges(r) for r in shape]
        edges = np.concatenate([e for e, _ in rings])
        tree = list(Q.leaves(edges, all(fine for _, fine in rings), most))
        assert tree or not len(edges)
        tree = {(k, cx, cy): rest for k, cx, cy, *rest in tree}
        if not len(edges):
            continue
        lo, hi = edges.min() - 0.1, edges.max() + 0.1
        spots = [(x, y) for x1, y1, x2, y2 in edges[:30] for x, y in ((x1, y1), ((x1 + x2) / 2, (y1 + y2) / 2), (x1, y2))]
        box = (edges[:, [0, 2]].min() - 0.05, edges[:, [0, 2]].max() + 0.05, edges[:, [1, 3]].min() - 0.05, edges[:, [1, 3]].max() + 0.05)
        spots += [(rng.uniform(*box[:2]), rng.uniform(*box[2:])) for _ in range(300)] + [(rng.uniform(lo, hi), rng.uniform(lo, hi)) for _ in range(50)]
        spots += [(round(x * 64) / 64, round(y * 64) / 64) for x, y in spots[-350:]]
        closed = all(fine for _, fine in rings)
        for x, y in spots:
            if not closed and not (box[0] + 0.05 <= x <= box[1] - 0.05):
                continue  # rings with a gap have no inside there that means anything
            assert by_leaf(tree, x, y) == by_rings(edges, x, y), (x, y)


def test_a_large_boundary_and_one_city(spark, monkeypatch):
    """100,000 vertices; all points in one city: a point meets a bounded number of edges, by broadcast and by shuffle alike."""
    ring, hole = star(100_000, seed=3, rough=0.001), star(500, r=0.1, seed=4)
    edges = np.concatenate([Q.ring_edges(ring)[0], Q.ring_edges(hole)[0]])
    tree = list(Q.leaves(edges))
    assert len(edges) > 100_000 and max(len(e) for *_, e in tree) <= 2 * Q.MOST_EDGES
    assert sum(len(e) for *_, e in tree) < 4 * len(edges) and len(tree) < len(edges)
    spiky, _ = Q.ring_edges(star(3000))  # edges close to each other all along
    assert sum(len(e) for *_, e in Q.leaves(spiky)) < 12 * len(spiky)
    other = [[[-111.5, 31.5], [-110.0, 31.5], [-110.0, 33.0], [-111.5, 33.0], [-111.5, 31.5]]]
    f = spark.createDataFrame([(1, 0, [other, [star(50, cx=10, cy=10)]], "b"), (0, 3, [[ring, hole]], "a"), (2, 0, [], "none"), (3, 0, None, "null")], f"entry_pos int, feature_pos int, coordinates {G.MULTI}, name string")
    rng = random.Random(5)
    spots = [(rng.uniform(-111.3, -110.5), rng.uniform(31.8, 32.6)) for _ in range(3000)] + [tuple(ring[7]), tuple(hole[7]), (10.0, 10.0), (0.0, 0.0)]
    pts = spark.createDataFrame([(i, y, x) for i, (x, y) in enumerate(spots)] + [(9999, 91.0, 0.0), (9998, None, 0.0), (7, spots[7][1], spots[7][0])], "point_id int, lat double, lon double")
    want = {i: "a" if by_rings(edges, x, y) else "b" if -111.5 <= x <= -110 and 31.5 <= y <= 33 or (x, y) == (10.0, 10.0) else None for i, (x, y) in enumerate(spots)}
    for few, hot in ((100_000, 100_000), (0, 100), (0, 100_000)):
        monkeypatch.setattr(G, "FEW_LEAVES", few)
        monkeypatch.setattr(G, "HOT_POINTS", hot)
        got = G.located(pts, f).collect()
        assert len(got) == len(spots) + 3 and {r.point_id: r.name for r in got} == want | {9999: None, 9998: None}
        assert all(r.found == (r.name is not None) for r in got)


def test_whole_rings_agree(spark):
    """The expression over whole rings gives the same."""
    f = spark.createDataFrame([(0, 0, [[star(60, seed=2, step=1 / 32)]], "a")], f"entry_pos int, feature_pos int, coordinates {G.MULTI}, name string")
    pts = spark.range(900).select(F.col("id").alias("point_id"), (32.2 - 0.5 + F.floor(F.col("id") / 30) / 32).alias("lat"), (-110.9 - 0.5 + (F.col("id") % 30) / 32).alias("lon"))
    whole = pts.crossJoin(f.select(G.prepared_edges(F.col("coordinates")).alias("e"))).where(G.inside(F.col("e"), F.col("lon"), F.col("lat"))).count()
    assert 0 < whole == G.located(pts, f).where("found").count()
