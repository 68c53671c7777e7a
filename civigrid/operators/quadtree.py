"""Polygons as leaves of a quadtree: what a point must be compared with is bounded by its leaf, not by the polygon.

A cell is split, eight by eight, while more than ``MOST_EDGES`` of a polygon's edges touch it. A leaf keeps the edges
that touch it and one parity for all others: an edge wholly to the right of the leaf, at its height, is crossed by a ray to the
right from any point between its ends, and along a chain of such edges only the heights of the chain's ends matter. An end
belongs to an edge that touches the leaf, so its height is compared there, or lies above or below the whole leaf. Leaves
inside a polygon that no edge touches keep the parity alone; those outside aren't kept.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Degrees of a cell at each level: powers of two, so that cells are told apart exactly.
SIZES = [256.0 / 8**k for k in range(8)]
#: A leaf has at most this many edges, unless it is of the last level.
MOST_EDGES = 32
#: What leaves may hold together, as a multiple of a polygon's edges, and cells that may be split for each edge.
COPIES, SPLITS = 6, 0.5
#: Degrees by which a cell counts as larger when edges are dealt to it; more than an intersection's rounding.
PAD = 1e-9
EDGE = "struct<x1:double,y1:double,x2:double,y2:double>"


def ring_edges(ring: list | None) -> tuple[np.ndarray, bool]:
    """A ring's edges, the last back to the first, as rows x1, y1, x2, y2, without those that lack a number; whether none does."""
    at = np.array([[p[0], p[1]] if p and len(p) > 1 and p[0] is not None and p[1] is not None else [np.nan, np.nan] for p in ring or ()], float).reshape(-1, 2)
    edges = np.hstack([at, np.roll(at, -1, axis=0)])
    fine = np.isfinite(edges).all(axis=1)
    return edges[fine], bool(fine.all())


def crossed(e: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each point (rows) and edge (columns): whether a ray from the point to the right crosses the edge."""
    spans = (e[:, 1] > y[:, None]) != (e[:, 3] > y[:, None])
    height = e[:, 3] - e[:, 1]
    return spans & (x[:, None] < (e[:, 2] - e[:, 0]) * (y[:, None] - e[:, 1]) / np.where(height == 0, 1, height) + e[:, 0])


def added(e: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What each edge (columns) adds to a leaf's parity at each point (rows), as 0 to 3; ``right`` is where the point's cell ends."""
    ends = ((e[:, 0] > right[:, None]) & (e[:, 1] > y[:, None])).astype(np.int8) + ((e[:, 2] > right[:, None]) & (e[:, 3] > y[:, None]))
    return ends + crossed(e, x, y)


def touching(e: np.ndarray, x: np.ndarray, y: np.ndarray, size: float) -> np.ndarray:
    """For each cell (rows, by their centres) and edge (columns): whether the edge touches the cell, or nearly does."""
    half = size / 2 + PAD
    dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
    from_x, from_y = x[:, None] - e[:, 0], y[:, None] - e[:, 1]
    near = (np.abs(2 * from_x - dx) <= np.abs(dx) + 2 * half) & (np.abs(2 * from_y - dy) <= np.abs(dy) + 2 * half)
    return near & (np.abs(dx * from_y - dy * from_x) <= (np.abs(dx) + np.abs(dy)) * (half + PAD))


def divided(e: np.ndarray, x: np.ndarray, y: np.ndarray, size: float, parity) -> list[tuple[int, np.ndarray]]:
    """For each cell (by its centre): its parity, and the edges that touch it; ``parity(x, y)`` is that of points in the polygon."""
    out: list[tuple[int, np.ndarray]] = []
    n = max(1, (1 << 19) // max(1, len(e)))
    for at in range(0, len(x), n):
        px, py = x[at : at + n], y[at : at + n]
        touch = touching(e, px, py, size)
        own = (np.where(touch, added(e, px + size / 2 + PAD, px, py), 0).sum(axis=1) + parity(px, py)) & 1
        out += [(int(c), e[t]) for c, t in zip(own, touch, strict=True)]
    return out


def centres(columns: range, rows: range, size: float) -> tuple[np.ndarray, np.ndarray]:
    """The centres of all cells of some columns and rows."""
    return np.repeat((np.array(columns) + 0.5) * size, len(rows)), np.tile((np.array(rows) + 0.5) * size, len(columns))


def leaves(edges: np.ndarray, closed: bool = True, most: int = MOST_EDGES) -> Iterator[tuple[int, int, int, float, int, np.ndarray]]:
    """A polygon's leaves from all its rings' edges: level, column, row, where its ends begin to count, parity, edges.

    Rings that aren't ``closed``, as edges are missing, have cells of the first level, with all edges in each.
    The cell with the most edges is split first. When leaves hold ``COPIES`` times the polygon's edges, no more are split,
    so edges that lie close to each other all along don't lead to ever more cells.
    """
    if not len(edges):
        return
    xs, ys = edges[:, [0, 2]], edges[:, [1, 3]]
    extent = max(xs.max() - xs.min(), ys.max() - ys.min())
    level = max((k for k, s in enumerate(SIZES) if s >= extent), default=0)
    size = SIZES[level]
    columns, rows = (range(int(np.floor((v.min() - PAD) / size)), int(np.floor((v.max() + PAD) / size)) + 1) for v in (xs, ys))
    if not closed:
        yield from ((level, cx, cy, np.inf, 0, edges) for cx in columns for cy in rows)
        return
    first = divided(edges, *centres(columns, rows, size), size, lambda x, y: np.array([crossed(edges, x[i : i + 1], y[i : i + 1]).sum() for i in range(len(x))]))
    todo = [(-len(own), level, cx, cy, parity, own) for (cx, cy), (parity, own) in zip(itertools.product(columns, rows), first, strict=True)]
    heapq.heapify(todo)  # no two have the same cell, so edges are never compared
    splits, spare = 100 + int(SPLITS * len(edges)), 1000 + COPIES * len(edges)
    while todo:
        _, k, cx, cy, parity, own = heapq.heappop(todo)
        right = (cx + 1) * SIZES[k] + PAD
        if len(own) <= most or k + 1 == len(SIZES) or not splits or spare <= 0:
            if parity or len(own):
                yield k, cx, cy, right, parity, own
            continue
        splits -= 1
        columns, rows = range(cx * 8, cx * 8 + 8), range(cy * 8, cy * 8 + 8)
        inner = divided(own, *centres(columns, rows, SIZES[k + 1]), SIZES[k + 1], lambda x, y, own=own, right=right, parity=parity: parity + added(own, np.full(len(x), right), x, y).sum(axis=1))
        spare -= sum(len(part) for _, part in inner) - len(own)
        for (i, j), (parity, part) in zip(itertools.product(columns, rows), inner, strict=True):
            heapq.heappush(todo, (-len(part), k + 1, i, j, parity, part))


def grown(features: DataFrame, most: int = MOST_EDGES) -> DataFrame:
    """The leaves of ``features`` (coordinates of multipolygons): their other columns with level, cell_x, cell_y, right_x, parity and edges.

    Each member of a multipolygon has leaves of its own. A row is one polygon's work; nothing is shuffled.
    """
    own = [c for c in features.columns if c != "coordinates"]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, shape in enumerate(b.column(len(own))):
                for polygon in shape.as_py() or ():
                    rings = [ring_edges(r) for r in polygon or ()]
                    edges = np.concatenate([e for e, _ in rings]) if rings else np.zeros((0, 4))
                    yield from packed(b, i, leaves(edges, all(fine for _, fine in rings), most))

    def packed(b: pa.RecordBatch, i: int, found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        rows = list(found)
        for at in range(0, len(rows), 1024):
            k, cx, cy, right, parity, edges = zip(*rows[at : at + 1024], strict=True)
            flat = np.concatenate(edges)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, n]) for n in range(4)], names=["x1", "y1", "x2", "y2"])
            offsets = pa.array(np.cumsum([0, *map(len, edges)]), pa.int32())
            columns = [c.take(pa.array([i] * len(k))) for c in b.columns[: len(own)]]
            made = [pa.array(k, pa.int32()), pa.array(cx, pa.int64()), pa.array(cy, pa.int64()), pa.array(right, pa.float64()), pa.array(parity, pa.int32()), pa.ListArray.from_arrays(offsets, structs)]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[*own, "level", "cell_x", "cell_y", "right_x", "parity", "edges"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in features.select(*own).schema)
    return features.select(*own, "coordinates").mapInArrow(grow, f"{kinds}level int, cell_x long, cell_y long, right_x double, parity int, edges array<{EDGE}>")


def cells(lon: Column, lat: Column, levels: list[int]) -> Column:
    """The cells of a point at some levels."""
    return F.array(*(F.struct(F.lit(k).alias("level"), F.floor(lon / SIZES[k]).alias("cell_x"), F.floor(lat / SIZES[k]).alias("cell_y")) for k in levels))


def in_leaf(x: Column, y: Column) -> Column:
    """Whether a point of a leaf's cell is in the leaf's polygon or on its border; needs the leaf's columns."""
    edges, right = F.col("edges"), F.col("right_x")

    def on(e: Column) -> Column:
        cross = (x - e["x1"]) * (e["y2"] - e["y1"]) - (y - e["y1"]) * (e["x2"] - e["x1"])
        return (cross == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))

    def times(e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        meets = F.when(spans, x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.when(spans, e["y2"] - e["y1"]).otherwise(F.lit(1.0)) + e["x1"]).otherwise(F.lit(False))
        return meets.cast("int") + ((e["x1"] > right) & (e["y1"] > y)).cast("int") + ((e["x2"] > right) & (e["y2"] > y)).cast("int")

    odd = F.aggregate(edges, F.col("parity"), lambda n, e: n + times(e)) % 2 == 1
    return F.exists(edges, on) | odd
