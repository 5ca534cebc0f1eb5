"""Connected components of a link table, by alternating star contractions.

Every round moves all links of a node to its smallest neighbour, first those to larger nodes, then
those to smaller ones. A round is grouping and joining only, its result is written to the shared
folder, and no links ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (smallest node reachable) of every node in ``links``.

    Nodes are of any type with an order. Links with a null end, and of a node with itself, count for
    nothing; repeated links count once. Empty in, empty out.
    """
    high, low = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    given = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = stored(given.select(high, low).distinct(), "links")
    before = None
    while True:
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before or not now[0]:
            break
        before = now
        # To larger neighbours: (u, v) with v smaller, and all others moved below the smallest. What a
        # node is moved to is stored before it is joined, so that Spark can split the links of a centre
        # with many; a centre without a smaller neighbour keeps its links as they are.
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).filter("m < u").select(
            F.col("u").alias("c"), "m"
        )
        least = stored(least, "link-centres")
        # Of each link only the end away from the centre moves, so the centre is its smaller end.
        large = edges.join(least, edges["v"] == least["c"], "left").select(
            "u", F.coalesce("m", "v").alias("v")
        )
        large = stored(large.filter("u <> v").distinct(), "links")
        # To smaller neighbours.
        small = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
        small = stored(small, "link-centres")
        moved = large.join(small, large["u"] == small["c"]).select(
            F.explode(F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            )).alias("e")
        ).select("e.u", "e.v").filter("u <> v").distinct()
        edges = stored(moved, "links")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionAll(edges.select("v", "v").distinct())
