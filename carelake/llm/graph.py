"""Connected components of a graph given by its links, by alternating star contraction.

Large star: every node hands its larger neighbours to its smallest neighbour. Small star: every node
hands its smaller neighbours and itself to the smallest of them. Both keep the components; repeated,
they leave one star per component in a number of rounds that grows with the logarithm of its size.
Each step is a minimum per node, combined before the shuffle, and a join in which large nodes can be
split, so no node's links have to meet in one task, and nothing but two numbers reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import written


def _least(directed: DataFrame) -> DataFrame:
    return directed.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))


def _large_star(both: DataFrame) -> DataFrame:
    """``both``: (u, v) in both directions."""
    larger = both.filter(F.col("v") > F.col("u")).join(_least(both), "u")
    return larger.select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()


def _small_star(down: DataFrame) -> DataFrame:
    """``down``: (u, v) with v < u."""
    least = _least(down)
    moved = down.join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
    own = least.select(F.col("m").alias("lo"), F.col("u").alias("hi"))
    return moved.unionByName(own).filter(F.col("lo") < F.col("hi")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``links``: (lo, hi) with lo < hi. Result: (node, root) for every node of a link, root being the
    smallest node of its component."""
    edges = written(links.select("lo", "hi").distinct(), "links")
    state = None
    while True:
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        )
        large = written(_large_star(both), "large-star")
        edges = written(_small_star(large.select(F.col("hi").alias("u"), F.col("lo").alias("v"))), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if tuple(now) == state or not now[0]:
            break
        state = tuple(now)
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )

