"""Reproducible train/test splits (SP1, SP2) without randomSplit.

``randomSplit`` depends on partitioning; here the side of a row is a
function of (seed, key) alone, so a re-run, a re-partition or a lost
executor gives the same split.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.functions.expr import hash_bucket, hash_u32
from cellwise.functions.ranges import running_totals

SPLIT_COL = "split"


def hash_split(df: DataFrame, key_cols: Sequence[str], test_size: float = 0.2,
               seed: int | None = 42, modulus: int = 10000, out: str = SPLIT_COL) -> DataFrame:
    """SP1: add ``split`` = 'test' when hash_bucket(seed, keys) < test_size*modulus.

    Row-local: no shuffle, and rows sharing a key stay on one side (rows
    with a null key are spread by a content hash).  ``seed=None`` is the unseeded split: a fresh seed is drawn once on the
    driver, so the frame is still consistent within the run.
    """
    if seed is None:
        import secrets

        seed = secrets.randbits(31)
    cut = int(round(test_size * modulus))
    if (0 < test_size and cut == 0) or (test_size < 1 and cut == modulus):
        raise ValueError(f"test_size {test_size} is finer than 1/{modulus}; raise modulus")
    bucket = hash_bucket(seed, key_cols, modulus)
    # A null key is no shared identity: such rows are spread by their content
    # instead of all landing on one side (null is often the largest "key").
    any_null = None
    for c in key_cols:
        t = F.col(c).isNull()
        any_null = t if any_null is None else (any_null | t)
    content = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]), F.lit(modulus))
    bucket = F.when(any_null, content).otherwise(bucket)
    side = F.when(bucket < F.lit(cut), F.lit("test")).otherwise(F.lit("train"))
    return df.withColumn(out, side)


def split_frames(df: DataFrame, out: str = SPLIT_COL) -> tuple[DataFrame, DataFrame]:
    """Two lazy frames from a frame carrying the split column."""
    return (df.where(F.col(out) == "train").drop(out), df.where(F.col(out) == "test").drop(out))


def exact_split(df: DataFrame, key_cols: Sequence[str], test_size: float = 0.2,
                seed: int = 42, out: str = SPLIT_COL, n_buckets: int | None = None,
                hist_bits: int = 16) -> DataFrame:
    """SP2: exactly ceil(n * test_size) rows go to 'test'.

    Rows are ordered by (h, r, keys): h = hash(seed, keys) as in SP1, r = a
    63-bit content hash; the first k rows are the test set.  The data as a
    whole is never shuffled:

    1. one aggregate counts rows per h-bucket (top ``hist_bits`` bits of the
       uniform hash: at most 2^hist_bits small rows reach the driver) and
       finds the bucket that holds the k-th row;
    2. the rows of that bucket are ranked (``running_totals`` spreads a key
       or a row that is repeated very often over many tasks); all others are
       decided by their bucket alone.

    Copies of a row are counted singly, so the size is exact with duplicates
    and with null keys.  Two jobs run when this is called.
    """
    n_bits = max(1, min(20, hist_bits))
    h, r = "_sp_h", "_sp_r"
    x = (df.withColumn(h, hash_u32(seed, key_cols))
           .withColumn(r, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
                       .bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))))
    bucket = F.shiftright(F.col(h), 32 - n_bits)
    hist = sorted((int(b), int(c)) for b, c in
                  x.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1))).collect())
    n = sum(c for _, c in hist)
    k = math.ceil(n * test_size)
    if not 0 < k < n:
        return x.withColumn(out, F.lit("test" if n and k >= n else "train")).drop(h, r)
    before, target = 0, None
    for b, c in hist:
        if before + c >= k:
            target = b
            break
        before += c
    whole = x.where(bucket != F.lit(target)).withColumn(
        out, F.when(bucket < F.lit(target), F.lit("test")).otherwise(F.lit("train")))
    inside = x.where(bucket == F.lit(target)).withColumn("_one", F.lit(1))
    ranked = running_totals(inside, [], [h, r, *key_cols], ["_one"], n_buckets=n_buckets)
    # The first k - before rows of this bucket, copies of a row counted singly.
    cut = ranked.withColumn(out, F.when(F.col("cum__one") < F.lit(k - before), F.lit("test"))
                            .otherwise(F.lit("train"))).checkpoint(eager=True)
    return whole.unionByName(cut.select(*whole.columns)).drop(h, r)
