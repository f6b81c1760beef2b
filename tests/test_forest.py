import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwise.operators import forest as R
from cellwise.operators import models as M


def slow_tree(codes, w, y, depth):
    """The prediction of each row: every cut tried, node by node."""
    mean = float((w * y).sum() / w.sum())
    best = (1e-9, None, None)
    if depth:
        for f in range(codes.shape[1]):
            for c in np.unique(codes[:, f])[:-1].tolist():
                a = codes[:, f] <= c
                gain = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (a, ~a)) - (w * y).sum() ** 2 / w.sum()
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, f, c)
    out = np.full(len(y), mean)
    if best[1] is not None:
        a = codes[:, best[1]] <= best[2]
        for s in (a, ~a):
            out[s] = slow_tree(codes[s], w[s], y[s], depth - 1)
    return out


@pytest.mark.parametrize("depth", [0, 2, 30])
def test_a_grown_tree_is_the_greedy_one(depth):
    rng = np.random.default_rng(4)
    codes = np.stack([rng.integers(0, 9, 300), rng.integers(0, 2, 300), rng.integers(0, 2, 300), np.zeros(300)], axis=1).astype(np.uint8)
    y = rng.normal(size=300) + codes[:, 0] % 4 + 1000
    w = rng.integers(1, 4, 300).astype(float)
    got = R.grown(codes, w, w * y, depth)
    assert np.allclose(got.value[got.reached(codes)], slow_tree(codes, w, y, depth))


def rows_of(spark, n=500):
    rng = np.random.default_rng(8)
    a, b = rng.integers(0, 30, n), rng.integers(0, 2, n)
    y = a * 2.0 + 5 * b + rng.normal(size=n)
    return spark.createDataFrame([(i, float(p), float(q), float(t)) for i, (p, q, t) in enumerate(zip(a, b, y))],
                                 "id long, a double, b double, y double")


def test_bags_are_poisson_and_follow_values():
    key = np.arange(20_000) * 7919
    for n in (1, 3, 64):
        w = R.draws(key, np.full(len(key), n), 5, 42)
        assert abs(w.mean() / n - 1) < 0.05 and abs(w.var() / n - 1) < 0.08
    a, b = (R.draws(key, np.ones(len(key)), t, 42) for t in (0, 1))
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.03


def test_small_groups_and_partitions_give_the_same_forest(spark):
    """Nodes split by histograms first, in other partitions: the same trees."""
    df = rows_of(spark)
    whole = R.fit_forest(df, ["a", "b"], "y", num_trees=5)
    parts = R.fit_forest(df.repartition(7), ["a", "b"], "y", num_trees=5, group_rows=40)
    assert parts.parts.count() > whole.parts.count() == 5
    got, want = ({r["id"]: r["prediction"] for r in m.transform(df).collect()} for m in (parts, whole))
    assert len(got) == 500 and all(abs(got[i] - want[i]) < 1e-9 for i in want)
    flat = [R.fit_forest(df, ["a", "b"], "y", num_trees=3, max_depth=2, group_rows=g).transform(df).agg(F.sum("prediction")).first()[0]
            for g in (10, 10_000)]
    assert flat[0] == pytest.approx(flat[1])


def test_forest_columns_repeated_rows_and_nulls(spark):
    df = rows_of(spark, 60)
    m = M.fit_rf_regressor(df.union(df), ["a", "b"], "y", num_trees=4)
    out = m.transform(df.union(df), "p")
    assert out.columns == [*df.columns, "p"] and out.count() == 120
    assert out.where(F.abs(F.col("p") - F.col("y")) > 20).isEmpty()
    for bad in ("cast(null as double) a, b, y", "a, b, cast(null as double) y"):
        with pytest.raises(Exception, match="must not be null"):
            R.fit_forest(df.selectExpr(*bad.split(", ")), ["a", "b"], "y", num_trees=1)


def test_forest_work_does_not_grow_with_nodes(spark):
    """A fully grown forest takes the same few jobs however many nodes it has."""
    df = spark.range(3000).selectExpr("id", "cast(id as double) a", "cast(hash(id) % 1000 as double) y")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("forest", "forest")
    try:
        M.fit_rf_regressor(df, ["a"], "y", num_trees=3)
        assert len(tracker.getJobIdsForGroup("forest")) < 25
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_equal_codes_fold_though_the_bins_have_many_combinations(spark):
    """One-hot features: 2^12 combinations of bins, 12 that occur."""
    from cellwise.operators import boosting as B

    df = spark.range(600).select("id", *[(F.col("id") % 12 == i).cast("double").alias(f"x{i}") for i in range(12)],
                                 (F.col("id") % 12 * 1.0).alias("y"))
    folds, blocks = [], B._blocks
    try:
        B._blocks = lambda *a: folds.append(a[-1]) or blocks(*a)
        m = B.fit_boosting(df, [f"x{i}" for i in range(12)], "y", B.Growth(rounds=30))
    finally:
        B._blocks = blocks
    assert folds == [True]
    assert m.transform(df).where(F.abs(F.col("prediction") - F.col("y")) > 0.5).isEmpty()
