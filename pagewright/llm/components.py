"""Connected components over an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = materialize(least, "components-least")  # so that the join stands alone and a hub's edges can be split
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that some edge joins to another; component is the least node reachable.

    Self-loops, repeats and direction do not matter; edges with a null end are left out.  Each round is written
    to the shared folder; groups are reduced by minimum and joins may be split, so a hub of any degree is no hot spot.
    """
    now = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).dropna().filter("u <> v").distinct(), "components")
    digest = lambda df: df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    state = digest(now)
    while state["n"]:
        after = materialize(_small_star(_large_star(now)), "components")
        found = digest(after)
        now, same, state = after, found == state, found
        if same:
            break
    labels = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels.unionAll(labels.select(F.col("component").alias("node"), "component").distinct())
