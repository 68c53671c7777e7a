"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civigrid.llm.common import by_key, spread, written


class Forest:
    """Links that suffice to connect what many links connect, and what they are kept as."""

    def __init__(self):
        self.root, self.ties = {}, []

    def top(self, x):
        root = self.root
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    def tie(self, a, b, link: tuple) -> None:
        x, y = self.top(a), self.top(b)
        if x != y:
            self.root[max(x, y)] = min(x, y)
            self.ties.append(link)


def _mark(links: DataFrame) -> tuple:
    """The number of links and a sum of their hashes: equal for equal links."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """For each node of the links (a, b; of any type with an order): node and component, the smallest node that it reaches.

    Links are kept from the larger node u to the smaller v. Large-star ties each u to the smallest node that its v is
    linked with (v itself, where v has no smaller one), small-star ties a u's smaller nodes and itself to the smallest of
    them; after few rounds each node is tied to its component's smallest one. Minima are taken with partial aggregation,
    and where they are joined back the rows of a node with very many links are dealt over salts. Each round's links are
    written to the shared folder. Links of a node to itself give a component of one; repeated links change nothing.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b"))
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = _mark(now)
    for _ in range(most_rounds if mark[0] else 1):
        low = now.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large = spread(now, low, "v", how="left", by="u", total=mark[0]).select("u", F.coalesce("m", "v").alias("v")).distinct()
        large = written(large, "links-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = spread(large, low, "u", by="v", total=mark[0]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")).distinct()
        now = written(small, "links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"links did not settle in {most_rounds} rounds")
    return by_key(nodes.distinct(), now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", how="left", spread_by="node").select("node", F.coalesce("component", "node").alias("component"))
