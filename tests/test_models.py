import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwise.operators import knn
from cellwise.operators import models as M
from cellwise.operators.metrics import accuracy, regression_metrics


@pytest.fixture(scope="module")
def cls_data(spark):
    rng = np.random.default_rng(5)
    n = 600
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    cat = rng.choice(["a", "b", "c"], size=n)
    y = np.where(x1 + (cat == "b") * 1.5 > 0.8, 2, np.where(x2 > 0, 1, 0))
    rows = [(float(a), float(b), str(c), int(t)) for a, b, c, t in zip(x1, x2, cat, y)]
    return spark.createDataFrame(rows, "x1 double, x2 double, kind string, y int")


def test_classifier_learns_and_probabilities_sum_to_one(spark, cls_data):
    model = M.fit_classifier(cls_data, ["x1", "x2"], ["kind"], "y",
                             {"learning_rate": 0.3, "n_estimators": 8, "max_depth": 3})
    scored = M.predict_proba(model, cls_data)
    assert accuracy(scored, "y", "prediction").first()["accuracy"] > 0.85
    sums = scored.select(F.aggregate("probability", F.lit(0.0), lambda a, v: a + v).alias("s"))
    assert sums.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    # argmax of the probabilities is the predicted class
    am = scored.select("prediction", F.array_position("probability", F.array_max("probability")).alias("i"))
    assert am.where(F.col("i") - 1 != F.col("prediction")).count() == 0
    # unseen category scores (code -1) without failing
    new = spark.createDataFrame([(0.1, 0.2, "zzz", 0)], cls_data.schema)
    assert M.predict_proba(model, new).count() == 1


@pytest.fixture(scope="module")
def reg_data(spark):
    rng = np.random.default_rng(6)
    n = 400
    x1, x2 = rng.uniform(0, 10, size=n).round(1), rng.integers(0, 5, size=n).astype(float)
    y = 3 * x1 + 2 * x2 + rng.normal(size=n)
    rows = [(i, float(a), float(b), float(t)) for i, (a, b, t) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, y double")


def test_adaboost_beats_mean(reg_data):
    m = M.fit_adaboost_regressor(reg_data, ["x1", "x2"], "y", n_estimators=6)
    assert 1 <= len(m.trees) <= 6 and len(m.trees) == len(m.weights)
    r2 = regression_metrics(m.transform(reg_data), "y", "prediction").first()["r2"]
    assert r2 > 0.8


def test_knn_matches_brute_force(spark, reg_data):
    tr = reg_data.where("id % 2 = 0")
    te = reg_data.where("id % 2 = 1")
    got = {r["id"]: r["prediction"] for r in
           M.knn_regress(tr, te, ["x1", "x2"], "y", "id", "id", k=5, start_fraction=0.05).collect()}
    trp, tep = tr.toPandas(), te.toPandas()
    for _, q in tep.iterrows():
        d = (trp.x1 - q.x1) ** 2 + (trp.x2 - q.x2) ** 2
        order = np.lexsort((trp.id.values, d.values))[:5]
        assert abs(got[q.id] - trp.y.values[order].mean()) < 1e-9


def test_knn_heavy_duplicate_point(spark):
    # a third of the training rows are one identical point
    tr = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, F.lit(1.0)).otherwise(F.col("id") / 10.0)
                                 .alias("x"), (F.col("id") * 1.0).alias("y"))
    te = spark.createDataFrame([(1000, 1.0), (1001, 29.0)], "id long, x double")
    got = {r["id"]: r["prediction"] for r in M.knn_regress(tr, te, ["x"], "y", "id", "id", k=5).collect()}
    assert got[1000] == pytest.approx((0 + 3 + 6 + 9 + 10) / 5)  # ids 0,3,6,9 at x=1 and id 10 at x=1.0


def test_compare_models_rows(spark, reg_data):
    tr, te = reg_data.where("id % 5 != 0"), reg_data.where("id % 5 = 0")
    out = M.compare_models(tr, te, ["x1", "x2"], "y", "id", models=["DTR", "GBR", "KNN"],
                           params={"GBR": {"max_iter": 5}}).collect()
    assert {r["model"] for r in out} == {"DTR", "GBR", "KNN"}
    assert all(r["r2"] > 0.5 for r in out)


def test_knn_dense_cluster_exact(spark):
    # a third of the training rows in a tiny dense cluster (distinct points)
    import random

    rnd = random.Random(9)
    rows = []
    for i in range(900):
        if i % 3 == 0:
            rows.append((i, 5.0 + rnd.random() * 1e-3, 5.0 + rnd.random() * 1e-3, float(i)))
        else:
            rows.append((i, rnd.random() * 10, rnd.random() * 10, float(i)))
    tr = spark.createDataFrame(rows, "id long, x1 double, x2 double, y double")
    qs = [(10_000 + j, 5.0 + rnd.random() * 1e-3, 5.0 + rnd.random() * 1e-3) for j in range(20)] + \
         [(20_000 + j, rnd.random() * 10, rnd.random() * 10) for j in range(20)]
    te = spark.createDataFrame(qs, "id long, x1 double, x2 double")
    got = {r["id"]: r["prediction"] for r in M.knn_regress(tr, te, ["x1", "x2"], "y", "id", "id").collect()}
    for qid, a, b in qs:
        d = sorted(((x1 - a) ** 2 + (x2 - b) ** 2, i, y) for i, x1, x2, y in rows)[:5]
        assert abs(got[qid] - sum(t[2] for t in d) / 5) < 1e-9


def test_direct_ovr_scoring_matches_spark(spark, cls_data):
    model = M.fit_classifier(cls_data, ["x1", "x2"], ["kind"], "y",
                             {"learning_rate": 0.3, "n_estimators": 4, "max_depth": 3}, family="gbt")
    ours = [r["prediction"] for r in M.predict(model, cls_data).collect()]
    ref = [int(r["prediction"]) for r in model.transform(cls_data).select("prediction").collect()]
    assert ours == ref
    from tests.conftest import plan_text

    assert "InMemory" not in plan_text(M.predict_proba(model, cls_data))


def test_knn_far_and_null_queries(spark):
    """The rounds of far queries do not grow with their distance; null features
    give a row with a null prediction."""
    import numpy as np

    rng = np.random.default_rng(6)
    train = [(i, float(a), float(b), float(y)) for i, (a, b, y) in enumerate(rng.uniform(0, 10, (400, 3)))]
    near = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.uniform(0, 10, (60, 2)))]
    far = [(i, a * s, b * s) for (i, a, b), s in zip(near, [1e2, -1e2] * 30)]
    farther = [(i, a * 1e5, b * 1e5) for i, a, b in far]
    tr = spark.createDataFrame([*train, (9000, None, 1.0, 5.0)], "id int, x1 double, x2 double, y double")
    sc = spark.sparkContext

    def run(rows):
        te = spark.createDataFrame([*rows, (900, None, 1.0), (901, float("nan"), 2.0)], "id int, x1 double, x2 double")
        sc.setJobGroup("knn", "knn")
        got = {r["id"]: r["prediction"] for r in M.knn_regress(tr, te, ["x1", "x2"], "y", "id", "id", k=5).collect()}
        assert got.pop(900) is None and got.pop(901) is None
        for i, a, b in rows:
            best = sorted(train, key=lambda t: ((t[1] - a) ** 2 + (t[2] - b) ** 2, t[0]))[:5]
            assert abs(got[i] - sum(t[3] for t in best) / 5) < 1e-9
        jobs = len(sc.statusTracker().getJobIdsForGroup("knn"))
        sc.setJobGroup("", "")
        return jobs

    run(near)
    assert run(farther) <= run(far) + 8


def test_pivots_find_the_nearest_rows_with_few_candidates(spark):
    """Clusters in five dimensions, queries inside, between and far away."""
    rng = np.random.default_rng(3)
    centres = rng.normal(scale=50, size=(8, 5))
    x = np.concatenate([c + rng.normal(size=(120, 5)) for c in centres] + [np.repeat(centres[:1], 40, axis=0)])
    q = np.concatenate([centres + rng.normal(size=(8, 5)), rng.normal(scale=60, size=(12, 5)), rng.normal(scale=5000, size=(6, 5)), x[-1:]])
    y = rng.normal(size=len(x))
    names = [f"f{i}" for i in range(5)]
    tr = spark.createDataFrame([(i, float(t), *map(float, r)) for i, (r, t) in enumerate(zip(x, y))], ["tid", "y", *names])
    rows = [(i, *map(float, r)) for i, r in enumerate(q)] + [(500, None, 1.0, 1.0, 1.0, 1.0)]
    te = spark.createDataFrame(rows, "qid long, " + ", ".join(f"{n} double" for n in names))
    got = {r["qid"]: r["prediction"] for r in M.knn_regress(tr, te, names, "y", "tid", "qid", k=4).collect()}
    assert got.pop(500) is None and len(got) == len(q)
    for i, point in enumerate(q):
        d2 = ((x - point) ** 2).sum(axis=1)
        assert abs(got[i] - y[np.lexsort((np.arange(len(x)), d2))[:4]].mean()) < 1e-9
    arrays = [df.select(df.columns[0], F.array(*names).alias(c), *extra) for df, c, extra in
              ((tr, "x", [F.col("y").alias("label")]), (te.where("qid < 500"), "q", []))]
    pairs = knn.knn_candidates(*arrays, 5, 4).groupBy("qid").count().collect()
    # A query near a cluster meets that cluster at most; a far one less than half of all rows.
    assert all(r["count"] <= 200 for r in pairs if r["qid"] < 8) and all(r["count"] < len(x) / 2 for r in pairs if r["qid"] >= 20)


def test_blocks_keep_ties_and_never_list_pairs(spark, monkeypatch):
    """Without clusters, in 12 dimensions: small blocks, equal distances go by
    training id, and what leaves a block is k rows a query, not its pairs."""
    rng = np.random.default_rng(4)
    x, q = rng.integers(0, 3, (500, 12)).astype(float), rng.integers(0, 3, (90, 12)).astype(float)
    tr = spark.createDataFrame([(i, v.tolist(), float(i)) for i, v in enumerate(x)], "tid int, x array<double>, label double")
    te = spark.createDataFrame([(f"q{i:03d}", v.tolist()) for i, v in enumerate(q)], "qid string, q array<double>")
    monkeypatch.setattr(knn, "BLOCK_ROWS", 12 * 130)
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 12 * 40)
    found = knn.nearest_rows(tr, te, 12, 4).toPandas()
    assert len(found) <= 90 * 4 * 5
    for i, point in enumerate(q):
        mine = found[found.qid == f"q{i:03d}"].sort_values(["d2", "tid"])
        d2 = ((x - point) ** 2).sum(axis=1)
        order = np.lexsort((np.arange(len(x)), d2))[:4]
        assert mine.tid.tolist()[:4] == order.tolist() and np.allclose(mine.d2[:4], d2[order])


def test_knn_outside_queries_take_no_rounds(spark):
    """Far below the box all rows of its edge are almost equally near: no
    widening of cells, so no more jobs than one round of blocks."""
    rng = np.random.default_rng(7)
    train = [(i, float(a), float(b), float(i)) for i, (a, b) in enumerate(rng.uniform(0, 100, (2000, 2)))]
    far = [(i, float(a), float(-b * 1e4)) for i, (a, b) in enumerate(rng.uniform(1, 100, (50, 2)))]
    tr = spark.createDataFrame(train, "id int, x1 double, x2 double, y double")
    te = spark.createDataFrame(far, "id int, x1 double, x2 double")
    sc = spark.sparkContext
    sc.setJobGroup("outside", "outside")
    got = {r["id"]: r["prediction"] for r in M.knn_regress(tr, te, ["x1", "x2"], "y", "id", "id", k=3).collect()}
    jobs = len(sc.statusTracker().getJobIdsForGroup("outside"))
    sc.setJobGroup("", "")
    assert jobs < 40
    for i, a, b in far:
        best = sorted(train, key=lambda t: ((a - t[1]) * (a - t[1]) + (b - t[2]) * (b - t[2]), t[0]))[:3]
        assert abs(got[i] - sum(t[3] for t in best) / 3) < 1e-9


def test_registered_classifier_is_fitted_on_all_rows(spark, tmp_path, monkeypatch):
    """Rows in the thousands, of which none is left out of the fit."""
    from cellwise.operators.split import hash_split, split_frames
    from cellwise.plans import catalog_models as C
    from cellwise.plans.catalog import prepared_lineitem

    k = F.col("id")
    spark.range(6_000).select(
        (k / 4).cast("long").alias("l_orderkey"), (k % 4 + 1).cast("int").alias("l_linenumber"), (k % 50).cast("double").alias("l_quantity"),
        (k * 7 % 1000 / 4.0).alias("l_extendedprice"), (k % 11 / 100.0).alias("l_discount"), (k % 9 / 100.0).alias("l_tax"),
        F.when(k % 2 == 0, "O").otherwise("F").alias("l_linestatus"), F.lit("N").alias("l_returnflag"),
        F.lit("1995-01-01").cast("date").alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    train, test = split_frames(hash_split(prepared_lineitem(spark, str(tmp_path)), ["order_key"], 0.2, 42))
    assert train.count() > 3_000
    seen, real = [], M.fit_boosting
    monkeypatch.setattr(M, "fit_boosting", lambda rows, *a: seen.append(rows.count()) or real(rows, *a))
    monkeypatch.setattr(C, "GBM_PARAMETERS", {"learning_rate": 0.1, "n_estimators": 2, "max_depth": 3})
    assert C.classifier_facts_lineitem(spark, str(tmp_path)).where("sums_to_one and is_argmax and is_class").count() == test.count()
    assert seen == [train.count()]
