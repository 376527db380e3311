"""Which packages a root reaches through dependencies of dependencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import checkpointed


def reached(starts: DataFrame, edges: DataFrame) -> DataFrame:
    """(root, package, depth): all that each root reaches, with the fewest steps.

    ``starts``: (root, package), its own dependencies, depth 0. ``edges``: (root, package, dependency).
    Each round follows the edges of the newest pairs only and drops pairs that are known, so cycles end.
    Rounds are checkpointed: their plans stay short and a lost executor costs one round. NULLs
    in any column name no package and are dropped.
    """
    known_edges = checkpointed(edges.select("root", "package", "dependency").dropna().distinct())
    frontier = checkpointed(starts.select("root", "package").dropna().distinct().withColumn("depth", F.lit(0)))
    found, depth = frontier, 0
    while frontier.limit(1).count():
        depth += 1
        next_ = frontier.join(known_edges, ["root", "package"]).select("root", F.col("dependency").alias("package")).distinct()
        next_ = next_.join(found.select("root", "package"), ["root", "package"], "left_anti").withColumn("depth", F.lit(depth))
        frontier = checkpointed(next_)
        found = found.unionByName(frontier)
    return found


def package_reach(starts: DataFrame, edges: DataFrame) -> DataFrame:
    """(package, roots, direct_roots, least_depth): how many roots reach each package, and how many list it themselves."""
    return reached(starts, edges).groupBy("package").agg(
        F.count("*").alias("roots"),
        F.count_if(F.col("depth") == 0).alias("direct_roots"),
        F.min("depth").cast("bigint").alias("least_depth"),
    )
