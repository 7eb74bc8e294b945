"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Every step is a grouped minimum and a join, so no node's neighbours meet in one place; what a step leaves is stored, so
a lost executor costs no earlier step. Steps needed grow with the logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored


def _is_forest(now: DataFrame) -> bool:
    """Whether each node has one root, and no root has a root."""
    if not now.groupBy("a").count().filter("count > 1").isEmpty():
        return False
    return now.join(now.select(F.col("b").alias("a")), "a", "left_semi").isEmpty()


def _least(pairs: DataFrame) -> DataFrame:
    """For each u its least neighbour m; dealt out anew, so that a join with it can split a u with many rows."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).repartition("m", "u")


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """edges: a, b bigint, in any direction and number. Returns node, root for each node of an edge; the root is the least node of its component."""
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while not _is_forest(now):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        before, large = now, stored(both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")), name)
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        each = F.explode(F.expr("array(struct(u AS a, m AS b), struct(v AS a, m AS b))")).alias("e")
        now = stored(down.join(_least(down), "u").select(each).select("e.*").filter("a <> b").distinct(), name)
        dropped(before)
        dropped(large)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
