"""Connected components of an edge table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.common import written


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Alternates "large star" (hang every larger neighbour on the smallest one) and "small star"
    (hang the smaller neighbours and the node itself on the smallest) until nothing changes,
    each round written to the shared folder. Only one boolean per round reaches the driver.
    Minima are summed before the shuffle, so that a hub is one row per task.
    """
    e = written(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(rounds):
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u != v").distinct(), "large-star")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        after = written(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        changed = after.count() != e.count() or bool(after.join(e, ["u", "v"], "left_anti").head(1))
        e = after
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
