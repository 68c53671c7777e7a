"""Points in polygons: the batch look-up of districts.

Polygons are divided into leaves of a quadtree (``quadtree.py``), points are put into the cells of the levels that there
are, and the two are joined on the cell: an equi-join, with a bounded number of edges for each candidate. The exact test
is even-odd crossings, holes included, and every edge and vertex counts as inside; ``inside`` is the same over whole rings.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civigrid.operators.quadtree import cells, grown, in_leaf
from civigrid.operators.staging import staged

#: Leaves, and edges of them all, that are broadcast at most (some tens of MB).
FEW_LEAVES, FEW_EDGES = 100_000, 500_000
#: Points of a cell that one task meets, about, and tasks that a cell's points are dealt over at most.
HOT_POINTS, MOST_SALTS = 100_000, 4096
MULTI = "array<array<array<array<double>>>>"


def valid_point(lat: Column, lon: Column) -> Column:
    inf = F.lit(float("inf"))
    return F.coalesce((F.abs(lat) < inf) & (F.abs(lon) < inf) & ~F.isnan(lat) & ~F.isnan(lon) & lat.between(-90, 90) & lon.between(-180, 180), F.lit(False))


def check_point(lat: float, lon: float) -> None:
    """For single look-ups: an error before anything is read."""
    if not (math.isfinite(lat) and -90 <= lat <= 90):
        raise ValueError("Latitude must be a finite number between -90 and 90.")
    if not (math.isfinite(lon) and -180 <= lon <= 180):
        raise ValueError("Longitude must be a finite number between -180 and 180.")


def _edges(ring: Column) -> Column:
    n = F.size(ring)
    return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, F.when(i + 1 < n, i + 1).otherwise(F.lit(0))).alias("b")))


def prepared_edges(coordinates: Column) -> Column:
    """A multipolygon's rings as arrays of edges with their coordinates by name."""
    def edge(e: Column) -> Column:
        return F.struct(F.get(e["a"], F.lit(0)).alias("x1"), F.get(e["a"], F.lit(1)).alias("y1"), F.get(e["b"], F.lit(0)).alias("x2"), F.get(e["b"], F.lit(1)).alias("y2"))

    return F.transform(coordinates, lambda poly: F.transform(poly, lambda ring: F.transform(_edges(ring), edge)))


def inside(edges: Column, x: Column, y: Column) -> Column:
    """Whether a point is in (or on the border of) a multipolygon given by ``prepared_edges``."""
    def on(e: Column) -> Column:
        cross = (x - e["x1"]) * (e["y2"] - e["y1"]) - (y - e["y1"]) * (e["x2"] - e["x1"])
        return (cross == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        return F.when(spans, x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.when(spans, e["y2"] - e["y1"]).otherwise(F.lit(1.0)) + e["x1"]).otherwise(F.lit(False))

    def in_poly(poly: Column) -> Column:
        border = F.exists(poly, lambda ring: F.exists(ring, on))
        odd = F.aggregate(poly, F.lit(0), lambda acc, ring: acc + F.size(F.filter(ring, crosses))) % 2 == 1
        return border | odd

    return F.exists(edges, in_poly)


def located(points: DataFrame, features: DataFrame) -> DataFrame:
    """``points`` (point_id, lat, lon) with the first feature that holds each: entry order, then feature order.

    ``features`` has entry_pos, feature_pos, coordinates and the columns to return. Points outside the valid range or
    any polygon come back with found false. Points are counted once for each point_id. A point meets the leaves of its own
    cells. Leaves are broadcast if they are few, which shuffles no point; else cells with very many points are dealt over salts.
    """
    payload = [c for c in features.columns if c != "coordinates"]
    grid = staged(grown(features))
    size = grid.agg(F.count("*").alias("leaves"), F.coalesce(F.sum(F.size("edges")), F.lit(0)).alias("edges"), F.array_sort(F.collect_set("level")).alias("levels")).first()
    asked = points.where(valid_point(F.col("lat"), F.col("lon"))).select("point_id", "lat", "lon", F.explode(cells(F.col("lon"), F.col("lat"), size.levels or [0])).alias("c")).select("point_id", "lat", "lon", "c.*")
    key = ["level", "cell_x", "cell_y"]
    if size.leaves <= FEW_LEAVES and size.edges <= FEW_EDGES:
        met = asked.join(F.broadcast(grid), key)
    else:
        hot = F.broadcast(asked.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > HOT_POINTS).select(*key, F.least(F.lit(MOST_SALTS), F.ceil(F.col("n") / HOT_POINTS)).cast("int").alias("salts")))
        dealt = asked.join(hot, key, "left").withColumn("salt", F.pmod(F.xxhash64("point_id", "lat", "lon"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
        copied = grid.join(hot, key, "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
        met = dealt.join(copied, [*key, "salt"])
    hits = met.where(in_leaf(F.col("lon"), F.col("lat")))
    best = hits.groupBy("point_id").agg(F.min(F.struct("entry_pos", "feature_pos", *(c for c in payload if c not in ("entry_pos", "feature_pos")))).alias("hit"))
    return points.join(best, "point_id", "left").select(*points.columns, F.col("hit").isNotNull().alias("found"), *(F.col(f"hit.{c}").alias(c) for c in payload if c not in ("entry_pos", "feature_pos")))
