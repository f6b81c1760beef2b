"""Exact running totals without a single-partition sort.

A global ``Window.orderBy`` (no partition) pulls every row into one task.
Here the rows are range-partitioned by (group, order columns) into many
buckets, written once with their bucket number, totalled per (group, bucket)
and ranked inside each bucket; a bucket's offset within its group is the
prefix sum of the totals before it.  The buckets only decide where the rows
are cut, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_totals(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                   sum_cols: Sequence[str], n_buckets: int | None = None,
                   rows_per_bucket: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Add ``cum_<c>``: the sum of ``c`` over rows strictly before each row in
    the order (``group_cols``, ``order_cols``), i.e. an exclusive prefix sum.

    Any orderable columns do; null is a group and sorts first.  Rows equal on
    every order column get an arbitrary relative order, and are spread over
    buckets like any others, so neither a large group nor a large tie is one
    task.  There are ``n_buckets`` buckets, else one per ``rows_per_bucket``
    rows (which counts the input), else as many as shuffle partitions.

    Runs a job when called: the bucketed rows are checkpointed, so the input
    is computed once and later steps read the same cut.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    spark = df.sparkSession
    bucket, tie = "_rt_bucket", "_rt_tie"
    if n_buckets is None and rows_per_bucket is not None:
        n_buckets = -(-df.count() // rows_per_bucket)
    n = max(1, n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    # The tie column splits equal rows; its values need not be the same twice,
    # only the checkpointed ones are used afterwards.
    x = (df.withColumn(tie, F.monotonically_increasing_id())
         .repartitionByRange(n, *group_cols, *order_cols, tie)
         .withColumn(bucket, F.spark_partition_id()).checkpoint(eager=True))

    # At most groups + n rows: a bucket holds whole groups but for its ends.
    totals = x.groupBy(*group_cols, bucket).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    before = (Window.partitionBy(*(group_cols or [F.lit(0)])).orderBy(bucket)
              .rowsBetween(Window.unboundedPreceding, -1))
    marks = [f"_og_{i}" for i in range(len(group_cols))]
    offsets = (totals.withColumn("_n_before", F.count(F.lit(1)).over(before))
               .select(F.col(bucket).alias("_ob"), *[F.col(g).alias(m) for g, m in zip(group_cols, marks)],
                       "_n_before", *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}")
                                      for c in sum_cols])
               # Only a bucket's first group can have begun in an earlier
               # bucket, so at most n rows are left to broadcast.
               .where("_n_before > 0").drop("_n_before"))
    same = F.col(bucket) == F.col("_ob")
    for g, m in zip(group_cols, marks):
        same = same & F.col(g).eqNullSafe(F.col(m))
    inside = (Window.partitionBy(*group_cols, bucket).orderBy(*order_cols, tie)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (x.join(F.broadcast(offsets), same, "left")
            .select(*df.columns, *[
                (F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.coalesce(f"_off_{c}", F.lit(0))).alias(f"{prefix}{c}")
                for c in sum_cols]))
