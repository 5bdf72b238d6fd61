"""Connected components of a graph held in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sized


def _stamp(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 2147483647)).first())


def components(edges: DataFrame) -> DataFrame:
    """Smallest id that each node can reach, from links ``a, b`` (longs, either order).

    Returns ``node, component`` for every node of a link between two different
    nodes; nodes without one are absent (their component is themselves). Null
    ends, loops and repeated links have no effect; no links give no rows.

    Alternates the large-star and small-star steps (Kiveris et al., 2014): each
    rewires every node to the least of its neighbours until the links form
    stars. The least neighbour is a partial aggregate, so a hub of many links
    is summed before it is shuffled, and joins back through a skew-splittable
    join. Links never leave the executors.
    """
    links = edges.where("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).select("a", "b").distinct()
    links = sized(links)
    stamp = _stamp(links)
    while stamp[0]:
        parts = -(-stamp[0] // 50_000)  # a step makes at most twice as many rows as there are links
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")).coalesce(parts)
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").coalesce(parts)
        low = large.groupBy("a").agg(F.min("b").alias("least")).coalesce(parts)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
        links = sized(small.unionByName(low.select("a", F.col("least").alias("b"))).distinct())
        stamp, before = _stamp(links), stamp
        if stamp == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
