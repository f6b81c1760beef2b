"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang every node's neighbours on the smallest of them: the larger ones
    (large star) or the smaller ones and the node itself (small star)."""
    if large:
        around = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    if large:
        hung = around.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = around.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b")))
    return hung.where("a <> b")


def _settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root and no root hangs on another."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long): root is the
    smallest node it is linked to, itself included.

    Each round is a few shuffles of the links and is written to the shared
    folder; the number of rounds grows with the logarithm of the size.  Loops
    and repeated links do not matter; an empty table gives an empty result.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), f"{name}_links")
    while not _settled(now):
        now = stored(_stars(_stars(now, True), False).distinct(), f"{name}_round")
    rooted = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return rooted.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
