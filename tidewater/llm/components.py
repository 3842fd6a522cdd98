"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.sources.checkpoint import delete_folder, new_folder, settled, stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``least``, the smallest of u and its neighbours.

    The minima are kept first: a join of two plain sides lets Spark split a hub's edges.
    """
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    return edges.join(settled(least), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _least_neighbour(both)
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
        .filter("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Expects u > v in every edge."""
    joined = _least_neighbour(edges)
    moved = joined.select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = joined.select("u", F.col("least").alias("v"))
    return moved.unionByName(own).filter("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v), two bigint columns; root is the least node.

    Alternates large-star and small-star steps, which keep components and never make more edges
    than there were, until every node hangs on its root. Their number grows with the logarithm
    of the longest path. Self-loops and repeated edges do no harm; no edges give no rows.
    """
    ends = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    loops = edges.filter("u = v").select(F.col("u").alias("node"), F.col("u").alias("root"))
    spark, folder = edges.sparkSession, new_folder(edges.sparkSession, "components")
    now = stored(edges.filter("u <> v").select(*ends).distinct(), f"{folder}/0")
    state, step = None, 0
    while True:
        found = now.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("bigint"))).first()
        if found[0] == 0 or tuple(found) == state:
            break
        state = tuple(found)
        large = stored(_large_star(now), f"{folder}/{step + 1}")
        now = stored(_small_star(large), f"{folder}/{step + 2}")
        for done in (step, step + 1):
            delete_folder(spark, f"{folder}/{done}")
        step += 2
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    every = nodes.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("root").alias("root"))
    every = settled(every)
    delete_folder(spark, folder)
    return every
