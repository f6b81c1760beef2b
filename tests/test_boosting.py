"""Second-order boosting against a plain version that sorts and tries every cut."""

import math
import uuid
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwise.operators import boosting as B
from cellwise.operators import models as M
from cellwise.session import scratch_path
from cellwise.sources.files import load_model, save_model


def gain_of(g, h, left, how):
    def term(m):
        return g[m].sum() ** 2 / (h[m].sum() + how.l2)
    right = ~left
    if min(left.sum(), right.sum()) < max(how.min_rows, 1) or min(h[left].sum(), h[right].sum()) < how.min_hessian:
        return -math.inf
    return term(left) + term(right) - g.sum() ** 2 / (h.sum() + how.l2)


def plain_split(x, g, h, how):
    best = (1e-12, None, None)
    for f in range(x.shape[1]):
        gone = np.isnan(x[:, f])
        for missing_left in (False, True):
            for cut in np.unique(x[~gone, f]):
                left = np.where(gone, missing_left, x[:, f] <= cut)
                gain = gain_of(g, h, left, how)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, left, (f, cut, missing_left))
    return best


def plain_tree(x, g, h, how):
    """Leaf values per row, one split at a time: best gain first, or all
    leaves that can be split up to the depth."""
    leaves = [(np.arange(len(g)), 0)]
    while how.max_leaves is None or len(leaves) < how.max_leaves:
        tries = [(plain_split(x[i], g[i], h[i], how), k) for k, (i, d) in enumerate(leaves)
                 if how.max_depth < 1 or d < how.max_depth]
        tries = [t for t in tries if t[0][1] is not None]
        if not tries:
            break
        (_, left, _), k = max(tries, key=lambda t: t[0][0])
        rows, d = leaves.pop(k)
        leaves += [(rows[left], d + 1), (rows[~left], d + 1)]
    out = np.zeros(len(g))
    for rows, _ in leaves:
        out[rows] = -how.rate * g[rows].sum() / (h[rows].sum() + how.l2)
    return out


def table(seed=1, n=90):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[rng.random((n, 3)) < 0.15] = np.nan
    y = np.nan_to_num(x[:, 0], nan=1.5) ** 2 + np.nan_to_num(x[:, 1], nan=-2.0) + rng.normal(size=n) * 0.3
    return x, y


def frame(spark, x, y):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double")


@pytest.mark.parametrize("how", [replace(B.DEPTH_WISE, rounds=3, max_depth=3), replace(B.LEAF_WISE, rounds=3, max_leaves=6),
                                 replace(B.LEAF_WISE, rounds=2, max_leaves=9, max_depth=3, min_rows=5)])
def test_rounds_match_the_plain_version(spark, how):
    x, y = table()
    df = frame(spark, x, y).repartition(5)
    model = B.fit_boosting(df, ["a", "b", "c"], "y", how)
    m = np.full(len(y), y.mean())
    for _ in range(how.rounds):
        m = m + plain_tree(x, m - y, np.ones(len(y)), how)
    got = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert np.allclose([got[i] for i in range(len(y))], m, atol=1e-9)


def test_softmax_matches_the_plain_version(spark):
    x, y = table(4, 120)
    cls = np.digitize(y, np.quantile(y, [0.3, 0.7]))
    how = replace(B.LEAF_WISE, rounds=2, rate=0.3, max_leaves=5, min_rows=4)
    df = frame(spark, x, cls).repartition(4)
    model = B.fit_boosting(df, ["a", "b", "c"], "y", how, classes=3)
    m = np.tile(np.log(np.bincount(cls) / len(cls)), (len(cls), 1))
    for _ in range(how.rounds):
        p = np.exp(m) / np.exp(m).sum(axis=1, keepdims=True)
        m = m + np.stack([plain_tree(x, p[:, k] - (cls == k), 1.5 * p[:, k] * (1 - p[:, k]), how) for k in range(3)], axis=1)
    scored = model.transform(df, "m").withColumn("p", B.probabilities(F.col("m")))
    got = {r["id"]: (r["m"], r["p"]) for r in scored.collect()}
    assert np.allclose([got[i][0] for i in range(len(cls))], m, atol=1e-9)
    assert all(abs(sum(p) - 1) < 1e-12 for _, p in got.values())


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(20_000).select((F.col("id") * 0.5).alias("a"), F.when(F.col("id") > 9_000, 2.0).otherwise(1.0).alias("y"))
    cuts = B.bin_cuts(df, ["a"], 64)[0]
    assert 32 < len(cuts) < 64 and (np.diff(cuts) > 0).all()
    e = F.col("prediction") - F.col("y")
    mse = B.fit_boosting(df, ["a"], "y", replace(B.DEPTH_WISE, rounds=30, max_bins=64)).transform(df).agg(F.avg(e * e)).first()[0]
    assert mse < 0.01


def test_edge_tables(spark):
    empty = spark.createDataFrame([], "a double, y double")
    model = B.fit_boosting(empty, ["a"], "y")
    one = spark.createDataFrame([(None, 2.0), (None, 4.0), (float("nan"), None)], "a double, y double")
    assert [r["prediction"] for r in model.transform(one).collect()] == [0.0] * 3
    got = B.fit_boosting(one, ["a"], "y", replace(B.DEPTH_WISE, rounds=3)).transform(one).collect()
    assert [r["prediction"] for r in got] == [3.0] * 3


def test_saved_classifier_scores_alike(spark):
    rows = [(float(i % 17), "ab"[i % 2] if i % 5 else None, (i % 17 > 8) + (i % 2 and i % 17 > 12)) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, kind string, y int")
    model = M.fit_classifier(df, ["x"], ["kind"], "y", {"learning_rate": 0.2, "n_estimators": 12, "max_depth": 4})
    path = scratch_path(spark, "booster")
    save_model(model, path)
    a, b = (sorted(map(str, M.predict_proba(m, df).collect())) for m in (model, load_model(path)))
    assert a == b
    hits = M.predict(model, df).where(F.col("prediction") == F.col("y")).count()
    assert hits > 380


def test_draws_follow_the_weights(spark):
    """A row's copies are the draws inside its share of the running total."""
    n = 300
    w = [0.0 if i % 50 == 0 else (40.0 if i == 7 else 0.1 + i % 3) for i in range(n)]
    rows = spark.createDataFrame(list(enumerate(w)), "k long, _w double").repartition(6)
    draws = M.hashed_draws(spark, n, 5, 2)
    got = {r["k"]: r["_copies"] for r in M.resample(rows, draws, n, ["k"]).collect()}
    ends = np.cumsum(w)
    at = np.searchsorted(ends, np.array([r["u"] for r in draws.collect()]) * ends[-1], side="right")
    want = dict(zip(*[v.tolist() for v in np.unique(at, return_counts=True)]))
    assert got == want and sum(got.values()) == n and got[7] > 10
    assert M.resample(rows.limit(0), draws, n, ["k"]).count() == 0


def test_adaboost_puts_rows_in_order_once(spark, monkeypatch):
    """Buckets of few rows change no draw, and later rounds sort nothing anew."""
    rows = spark.createDataFrame([(i, float(i % 13), float(i % 7 + i % 13)) for i in range(500)], "k long, x double, y double")
    one = M.fit_adaboost_regressor(rows, ["x"], "y", n_estimators=3, max_depth=1, key_cols=["k"])
    monkeypatch.setattr(M, "ROWS_PER_TASK", 80)
    sorted_, real = [], M.in_order
    monkeypatch.setattr(M, "in_order", lambda *a: sorted_.append(1) or real(*a))
    many = M.fit_adaboost_regressor(rows, ["x"], "y", n_estimators=3, max_depth=1, key_cols=["k"])
    assert len(sorted_) == 1 and len(many.trees) == 3
    assert many.weights == pytest.approx(one.weights, rel=1e-9)
    assert [t.toDebugString.split("\n")[1:] for t in many.trees] == [t.toDebugString.split("\n")[1:] for t in one.trees]
    w = [0.0 if i // 80 in (0, 2) else 1.0 + i % 3 for i in range(500)]
    weighed = spark.createDataFrame(list(enumerate(w)), "k long, _w double")
    draws = M.hashed_draws(spark, 500, 5, 2)
    got = {r["k"]: r["_copies"] for r in M.resample(weighed, draws, 500, ["k"]).collect()}
    at = np.searchsorted(np.cumsum(w), np.array([r["u"] for r in draws.collect()]) * sum(w), side="right")
    assert got == dict(zip(*[v.tolist() for v in np.unique(at, return_counts=True)]))


def test_small_files_are_spread_over_the_cores(spark):
    one = spark.range(1000).select(F.col("id").cast("double").alias("x")).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    assert M.spread(one, 10).rdd.getNumPartitions() == min(100, cores)
    assert M.spread(one).rdd.getNumPartitions() == 1
    assert M.spread(one, 10).count() == 1000 and M.spread(one.limit(0)).count() == 0


def test_exact_tree_matches_a_plain_one(spark):
    """Grown out: every leaf's rows share their features (missing ones go right)."""
    x, y = table(7, 60)
    df = frame(spark, x, y).repartition(3)
    tree = M.fit_tree_regressor(df, ["a", "b", "c"], "y")
    got = {r["id"]: r["prediction"] for r in tree.transform(df).collect()}

    def plain(rows):
        best = (1e-9, None)
        for f in range(3):
            v = x[rows, f]
            for lo, hi in zip(*(lambda u: (u[:-1], u[1:]))(np.unique(v[~np.isnan(v)]))):
                left = np.where(np.isnan(v), False, v <= (lo + hi) / 2)
                a, b = y[rows[left]], y[rows[~left]]
                gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b) - y[rows].sum() ** 2 / len(rows)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, left)
        if best[1] is None:
            return dict.fromkeys(rows.tolist(), float(y[rows].mean()))
        return plain(rows[best[1]]) | plain(rows[~best[1]])

    want = plain(np.arange(len(y)))
    assert np.allclose([got[i] for i in range(len(y))], [want[i] for i in range(len(y))], atol=1e-9)


def test_exact_tree_edges(spark):
    rows = [(1.0, None, 3.0), (2.0, float("nan"), 5.0), (None, 1.0, 7.0), (4.0, 2.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    tree = M.fit_tree_regressor(df, ["a", "b"], "y", max_depth=1)
    # One cut of a (1.5); a missing value goes right.
    assert [r["prediction"] for r in tree.transform(df).collect()] == [3.0, 6.0, 6.0, 6.0]
    empty = M.fit_tree_regressor(df.limit(0), ["a"], "y").transform(df)
    assert [r["prediction"] for r in empty.collect()] == [None] * 4
    same = df.select("a", F.lit(2.0).alias("y"))
    assert {r["prediction"] for r in M.fit_tree_regressor(same, ["a"], "y").transform(same).collect()} == {2.0}


def jobs_of(spark, run):
    sc, group = spark.sparkContext, uuid.uuid4().hex  # a group keeps the jobs of earlier calls
    sc.setJobGroup(group, group)
    out = run()
    jobs = len(sc.statusTracker().getJobIdsForGroup(group))
    sc.setJobGroup("", "")
    return out, jobs


@pytest.mark.parametrize("classes", [0, 3])
def test_folded_and_distributed_rounds_agree(spark, monkeypatch, classes):
    """Rows that share their bins are one row with a number; more tasks, more
    jobs, the same trees."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 4, (600, 3)).astype(float)
    x[rng.random((600, 3)) < 0.1] = np.nan
    y = np.nan_to_num(x[:, 0], nan=1.0) + (x[:, 1] > 1) * 2 + rng.normal(size=600) * 0.2
    y = np.digitize(y, [1.5, 3.0]) if classes else y
    df, how = frame(spark, x, y).repartition(5), replace(B.DEPTH_WISE, rounds=12, max_depth=3)

    def fit():
        return B.fit_boosting(df, ["a", "b", "c"], "y", how, classes)

    columns = [x[:, f] for f in range(3)]
    monkeypatch.setattr(B, "FOLD_LEAST", 10**9)
    monkeypatch.setattr(B, "ROWS_PER_TASK", 150)
    spread = fit()
    monkeypatch.setattr(B, "FOLD_LEAST", 0.1)
    spread_folds = fit()
    monkeypatch.setattr(B, "ROWS_PER_TASK", 20_000)
    folded, jobs = jobs_of(spark, fit)
    assert jobs < 30  # 12 rounds of 3 levels would take more
    for other in (spread_folds, folded):
        assert np.allclose(spread.margins(columns), other.margins(columns), atol=1e-9)


def test_rounds_of_few_rows_are_one_job(spark):
    x, y = table(11, 200)
    df = frame(spark, x, y)
    counts = [jobs_of(spark, lambda: B.fit_boosting(df, ["a", "b", "c"], "y", replace(B.LEAF_WISE, rounds=r)))[1] for r in (2, 30)]
    assert counts[0] == counts[1] < 30


def test_masks_find_the_leaves_that_walking_finds(spark):
    x, y = table(12, 400)
    columns = [x[:, f] for f in range(3)]
    missing = None
    for how in (B.LEAF_WISE, B.DEPTH_WISE, replace(B.DEPTH_WISE, max_depth=9, min_hessian=0.0, l2=0.0)):
        model = B.fit_boosting(frame(spark, x, y), ["a", "b", "c"], "y", replace(how, rounds=5))
        missing = np.array([len(c) + 1 for c in model.cuts])
        walked, codes = np.full(len(y), model.base[0]), B.codes_of(columns, model.cuts)
        for (t,) in model.trees:
            walked = walked + np.array(t.value)[t.leaf_of(codes, missing)]
        assert (model.margins(columns)[:, 0] == walked).all()
        assert (B.leaf_masks([t for (t,) in model.trees], missing) is None) == any(t.feature.count(-1) > 64 for (t,) in model.trees)


def test_rows_walk_by_joint_codes_as_by_each(spark):
    """Features that share a code: the same leaves and the same sums per bin."""
    rng = np.random.default_rng(3)
    sizes = np.array([4, 9, 3, 5])
    offsets, codes = np.concatenate([[0], np.cumsum(sizes)]), np.stack([rng.integers(0, s, 700) for s in sizes], axis=1)
    g, n = rng.normal(size=(700, 1)), rng.integers(1, 4, 700).astype(float)
    tree = B.Tree()
    left, right = tree.split(0, 1, 3, True)
    tree.split(left, 0, 1, False)
    tree.split(tree.split(right, 3, 2, True)[0], 2, 0, False)
    leaf = tree.leaf_of(codes, sizes - 1)
    for largest in (0, 15, 60, 1000):
        joint = B._Joint(offsets, largest)
        packed = joint.encode(codes)
        assert (joint.walk(tree, packed, np.zeros(700, dtype=np.int64)) == leaf).all()
        half = joint.walk(tree, packed, np.where(codes[:, 1] <= 3, left, 0))
        assert (half == leaf)[codes[:, 1] <= 3].all()
        nodes = sorted(set(leaf.tolist()))[:3]
        block = packed, n, -g, np.zeros((700, 1))
        got = B._by_node(B._partial(block, [tree], [nodes], joint, 0), [nodes], int(offsets[-1]))[0]
        for m in nodes:
            for f, a in enumerate(offsets[:-1]):
                for c in range(sizes[f]):
                    hit = (leaf == m) & (codes[:, f] == c)
                    assert np.allclose(got[m][a + c], [g[hit].sum(), n[hit].sum(), n[hit].sum()], atol=1e-12)


def test_levels_give_the_best_first_tree(spark, monkeypatch):
    """Searched by levels or best first, from one sibling's sums or from both."""
    x, y = table(15, 300)
    how = replace(B.LEAF_WISE, rounds=4, max_leaves=7, max_depth=4, min_rows=3)
    by_level = B.fit_boosting(frame(spark, x, y), ["a", "b", "c"], "y", how)
    monkeypatch.setattr(B, "LEVEL_LEAVES", 0)
    best_first = B.fit_boosting(frame(spark, x, y), ["a", "b", "c"], "y", how)
    m = np.full(len(y), y.mean())
    for _ in range(how.rounds):
        m = m + plain_tree(x, m - y, np.ones(len(y)), how)
    columns = [x[:, f] for f in range(3)]
    for model in (by_level, best_first):
        assert np.allclose(model.margins(columns)[:, 0], m, atol=1e-9)
