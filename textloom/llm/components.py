"""Connected components of a graph given as links, by alternating large and small stars.

Every round is one or two shuffles of the links; the links of a node never meet in one task: the smallest
neighbour is an aggregate, joined back, and a node with very many links is split by adaptive execution.
Stars shrink the distance to the smallest node in a logarithmic number of rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import discard, store


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` has both directions (large) or only downward ones (small); result points to smaller nodes."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    moved = links.join(least, "a")
    if large:
        return moved.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))
    )


def components(links: DataFrame, a: str, b: str, rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node with a link; the component is its smallest node.

    Null ends and links of a node to itself are left out. No links give an empty table. Only two numbers per
    round, the count and a hash sum of the links, reach the driver.
    """
    spark = links.sparkSession
    down = (
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter("a > b")
        .distinct()
    )
    current, path = store(down, "links")
    seen = None
    for _ in range(rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, True).filter("a > b").distinct()
        small = _star(large, False).filter("a > b").distinct()
        after, after_path = store(small, "links")
        discard(spark, path)
        current, path = after, after_path
        mark = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("components did not settle")
    # every node now points at the smallest node of its component
    roots = current.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return roots.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())
