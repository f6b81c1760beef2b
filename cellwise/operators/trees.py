"""Exact regression trees (M7): every distinct value is a candidate cut.

A level is grown for all nodes at once.  Rows are folded to (node, feature,
value) with count and sum of the label; running totals per (node, feature) in
value order give both sides of every cut; one aggregate keeps each node's best
cut.  Nothing but the number of splits reaches the driver, so neither rows nor
distinct values nor nodes are limited by its memory; a level costs one
shuffle of the folded rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.functions.ranges import running_totals
from cellwise.session import scratch_path

#: Splits of a level that are broadcast to the rows; more are joined.
BROADCAST_SPLITS = 100_000


@dataclass
class ExactTree:
    """``levels``: (node, f, cut, low) of each level's split nodes, whose
    children on the next level are low and low + 1; the root is node 0 of level
    0.  ``leaves``: (level, node, mean)."""

    features: list[str]
    levels: list[DataFrame]
    leaves: DataFrame

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` plus the mean of each row's leaf; missing values go right,
        as they do when the tree is grown."""
        x = df.withColumns({"_x": _vector(self.features), "_node": F.lit(0).cast("long"), "_level": F.lit(0)})
        for level, splits in enumerate(self.levels):
            x = _routed(x, splits, level)
        leaves = self.leaves.select(F.col("level").alias("_level"), F.col("node").alias("_node"), F.col("mean").alias(out))
        return _small(x, leaves, ["_level", "_node"], "left").drop("_x", "_node", "_level")


def _vector(features: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in features])


def _small(rows: DataFrame, side: DataFrame, key: str | list[str], how: str) -> DataFrame:
    """Join with a side that is broadcast if it is small, counted."""
    small = side.limit(BROADCAST_SPLITS + 1).count() <= BROADCAST_SPLITS
    return rows.join(F.broadcast(side) if small else side, key, how)


def _routed(x: DataFrame, splits: DataFrame, level: int) -> DataFrame:
    """Rows of the level's split nodes go on to a child."""
    named = splits.select(F.lit(level).alias("_level"), F.col("node").alias("_node"), F.col("f").alias("_f"),
                          F.col("cut").alias("_cut"), F.col("low").alias("_low"))
    value = F.get(F.col("_x"), F.col("_f"))
    left = F.coalesce(~F.isnan(value) & (value <= F.col("_cut")), F.lit(False))
    goes = F.col("_cut").isNotNull()
    return _small(x, named, ["_level", "_node"], "left").withColumns({
        "_node": F.when(goes, F.col("_low") + F.when(left, 0).otherwise(1)).otherwise(F.col("_node")),
        "_level": F.when(goes, F.lit(level + 1)).otherwise(F.col("_level"))}).drop("_f", "_cut", "_low")


def _written(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def best_cuts(rows: DataFrame, min_rows: int = 1) -> DataFrame:
    """(node, f, cut) of the cut that leaves the least squared error, per
    node that some cut improves; ``rows`` has _node, _x and _y.  Of equal
    gains the first feature and the lowest cut win."""
    each = rows.select("_node", "_y", F.posexplode("_x").alias("f", "value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
    folded = each.groupBy("_node", "f", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("t"))
    placed = running_totals(folded, ["_node", "f"], ["value"], ["n", "t"])
    totals = rows.groupBy("_node").agg(F.count(F.lit(1)).alias("all_n"), F.sum("_y").alias("all_t"))
    # What lies before a value is the left side of the cut below it.
    sides = _small(placed, totals, "_node", "inner").select(
        "_node", "f", "value", F.col("cum_n").alias("n"), F.col("cum_t").alias("t"), "all_n", "all_t")
    right_n, right_t = F.col("all_n") - F.col("n"), F.col("all_t") - F.col("t")
    gain = (F.col("t") * F.col("t") / F.col("n") + right_t * right_t / right_n
            - F.col("all_t") * F.col("all_t") / F.col("all_n"))
    ok = sides.where((F.col("n") >= min_rows) & (right_n >= min_rows) & (F.col("n") > 0) & (right_n > 0)).select(
        "_node", "f", "value", gain.alias("gain")).where(F.col("gain") > 1e-9 * F.abs("gain") + 1e-12)
    best = ok.groupBy("_node").agg(F.min(F.struct((-F.col("gain")).alias("g"), "f", "value")).alias("b"))
    # The cut lies half way to the largest value below.
    chosen = best.select("_node", F.col("b.f").alias("f"), F.col("b.value").alias("above"))
    lower = (_small(folded, chosen.withColumnRenamed("f", "of"), "_node", "inner")
             .where((F.col("f") == F.col("of")) & (F.col("value") < F.col("above")))
             .groupBy("_node", "f", "above").agg(F.max("value").alias("below")))
    return lower.select(F.col("_node").alias("node"), "f", ((F.col("below") + F.col("above")) / 2).alias("cut"))


def fit_exact_tree(df: DataFrame, features: Sequence[str], label: str, max_depth: int | None = None,
                   min_rows: int = 1) -> ExactTree:
    """M7 with the original library's defaults: squared error, every cut,
    grown until no cut improves a node (or to ``max_depth``).

    Rows without a label are left out; null and NaN features go right of any
    cut.  Each level's rows are written to the shared folder, so a lost
    executor costs one level.
    """
    spark = df.sparkSession
    rows = df.where(F.col(label).isNotNull()).select(
        F.lit(0).alias("_level"), F.lit(0).cast("long").alias("_node"), _vector(features).alias("_x"),
        F.col(label).cast("double").alias("_y"))
    rows, levels, leaves = _written(rows, spark, "tree_rows"), [], []

    def means(of: DataFrame) -> DataFrame:
        return of.groupBy(F.col("_level").alias("level"), F.col("_node").alias("node")).agg(F.avg("_y").alias("mean"))

    while True:
        splits = None
        if (max_depth is None or len(levels) < max_depth) and len(features):
            splits = _written(best_cuts(rows, min_rows).withColumn("low", 2 * F.monotonically_increasing_id()), spark, "tree_splits")
        if splits is None or splits.isEmpty():
            leaves.append(means(rows))
            break
        split_nodes = splits.select(F.col("node").alias("_node"))
        # Nodes that no cut improves are leaves; only the others go on.
        leaves.append(means(rows.join(split_nodes, "_node", "left_anti")))
        rows = _written(_routed(rows.join(split_nodes, "_node", "left_semi"), splits, len(levels)), spark, "tree_rows")
        levels.append(splits)
    return ExactTree(list(features), levels, _written(reduce(DataFrame.unionByName, leaves), spark, "tree_leaves"))


__all__ = ["ExactTree", "fit_exact_tree", "best_cuts"]
