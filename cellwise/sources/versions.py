"""Batch history of an append-only split table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellwise.sources.files import RUN_ID_COL, STAMP_COL


def batch_versions(df: DataFrame, ts_col: str = STAMP_COL, run_col: str = RUN_ID_COL) -> DataFrame:
    """(version, run_id, committed_at, rows), version 0 = oldest batch.

    The window runs over the per-batch aggregate (one row per append).
    """
    per = df.groupBy(run_col).agg(F.min(ts_col).alias("committed_at"),
                                  F.count(F.lit(1)).alias("rows"))
    # One row per append: a single small partition on purpose.
    w = Window.partitionBy(F.lit(0)).orderBy("committed_at", run_col)
    return per.select((F.row_number().over(w) - 1).alias("version"), run_col,
                      "committed_at", "rows")


def appended_since(df: DataFrame, version: int, ts_col: str = STAMP_COL,
                   run_col: str = RUN_ID_COL) -> DataFrame:
    """Rows of batches with version > ``version``, tagged as inserts.

    The version table has one row per batch; Spark broadcasts it if its
    measured size allows, and on a ``run_id``-partitioned table the filter on
    it becomes dynamic partition pruning.
    """
    v = batch_versions(df, ts_col, run_col).where(F.col("version") > version)
    return (df.join(v.select(run_col, F.col("version").alias("_commit_version")), run_col)
              .withColumn("_change_type", F.lit("insert")))
