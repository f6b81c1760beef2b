import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import Window

from cellwise.functions.ranges import running_totals
from cellwise.operators.split import exact_split, hash_split
from tests.conftest import SF_SMALL


def test_hash_split_disjoint_complete_stable(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    a = hash_split(o, ["o_orderkey"]).collect()
    b = hash_split(o.repartition(7), ["o_orderkey"]).collect()
    assert len(a) == o.count()
    assert {(r[0], r[1]) for r in a} == {(r[0], r[1]) for r in b}
    frac = sum(r[1] == "test" for r in a) / len(a)
    assert 0.15 < frac < 0.25


def test_exact_split_size_and_stability(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey")
    n = o.count()
    for nb in (None, 5):
        out = exact_split(o, ["o_orderkey"], 0.2, n_buckets=nb)
        assert out.where("split = 'test'").count() == math.ceil(0.2 * n)
        assert out.count() == n
    s1 = {r[0] for r in exact_split(o, ["o_orderkey"], 0.2, n_buckets=4).where("split='test'").collect()}
    s2 = {r[0] for r in exact_split(o.repartition(5), ["o_orderkey"], 0.2).where("split='test'").collect()}
    assert s1 == s2


def test_exact_split_heavy_duplicate_key(spark):
    # a third of the rows share one key: the count is still exact
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("payload"))
    out = exact_split(df, ["k"], 0.3, n_buckets=8)
    assert out.where("split='test'").count() == 900


def test_running_totals_forced_buckets_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = rng.normal(size=2000).round(2)
    grp = rng.integers(0, 3, size=2000)
    df = spark.createDataFrame([(int(g), float(v), i) for i, (g, v) in enumerate(zip(grp, vals))],
                               ["g", "v", "i"])
    df = df.withColumn("one", F.lit(1))
    for nb, rpb in ((None, 2_000_000), (7, 2_000_000), (None, 100)):
        out = running_totals(df, ["g"], ["v", "i"], ["one"], n_buckets=nb, rows_per_bucket=rpb).toPandas()
        w = Window.partitionBy("g").orderBy("v", "i")
        ref = df.withColumn("r", F.row_number().over(w) - 1).toPandas()
        m = out.merge(ref, on=["g", "v", "i"])
        assert (m["cum_one"] == m["r"]).all()


def test_splits_do_not_shuffle_rows(spark):
    from tests.conftest import plan_text

    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for df in (hash_split(o, ["o_orderkey"]), exact_split(o, ["o_orderkey"], 0.2)):
        assert "Exchange" not in plan_text(df)


def test_unseeded_split_is_consistent_within_a_frame(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    s = hash_split(o, ["o_orderkey"], seed=None).persist()
    a = {r[0] for r in s.where("split='test'").collect()}
    b = {r[0] for r in s.where("split='test'").collect()}
    assert a == b and 0.1 < len(a) / o.count() < 0.3


def test_null_keys_are_spread(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("v"))
    out = hash_split(df, ["k"]).where("k is null").groupBy("split").count().collect()
    frac = {r["split"]: r["count"] for r in out}
    assert 0.15 < frac["test"] / 1000 < 0.25


def test_exact_split_with_duplicates_and_null_keys(spark):
    for rows, size in (([(1, "a")] * 1000, 0.2), ([(k, "x") for k in range(10) for _ in range(100)], 0.25),
                       ([(None, str(i)) for i in range(1000)], 0.2), ([(None, None)] * 500 + [(3, "y")] * 500, 0.31)):
        df = spark.createDataFrame(rows, "k int, v string")
        for nb in (None, 5):
            out = exact_split(df, ["k"], size, n_buckets=nb)
            assert out.count() == 1000
            assert out.where("split='test'").count() == -(-int(round(1000 * size * 1000)) // 1000)


def test_hash_split_rejects_a_size_it_cannot_cut(spark):
    import pytest

    df = spark.range(10)
    for size in (0.00001, 0.99999):
        with pytest.raises(ValueError):
            hash_split(df, ["id"], size)
    assert hash_split(df, ["id"], 0.00001, modulus=10_000_000).count() == 10


def test_running_totals_spread_ties_nulls_and_many_groups(spark):
    rows = [(None if i % 3 == 0 else i % 120, None if i % 5 == 0 else 7, 1 + i % 4) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, v int, w int")
    out = running_totals(df, ["g"], ["v"], ["w"], n_buckets=25)
    got = {}
    for r in out.collect():
        got.setdefault(r["g"], []).append((r["v"] is not None, r["cum_w"], r["w"]))
    assert sum(map(len, got.values())) == 3000
    for g in got.values():
        at = 0
        for _, c, w in sorted(g, key=lambda t: t[1]):
            assert c == at
            at += w
        nulls = [c for known, c, _ in g if not known]
        rest = [c for known, c, _ in g if known]
        assert not nulls or not rest or max(nulls) < min(rest)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
