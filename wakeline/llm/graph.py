"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import kept_table


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (columns ``a``, ``b``, long): the smallest node reachable.

    Alternates large and small stars until the links no longer change: each round moves every node's neighbours
    to its smallest neighbour, so the rounds grow with the logarithm of the longest chain. A round is two
    aggregations and two joins whose right side has one row per node, so that a hub with a third of all links is
    pre-aggregated on its way in and, as the hubs are stored first, split on its way out. Links to itself, repeated links and nulls change nothing; no links give no
    rows. Every round is written to the shared folder.
    """
    pairs = links.where("a is not null and b is not null and a <> b")
    edges = kept_table(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = kept_table(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = kept_table(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        hub = kept_table(large.groupBy("u").agg(F.min("v").alias("m")), "hub")
        moved = large.join(hub, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = kept_table(moved.union(hub).distinct(), "small")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select("component", "component").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
