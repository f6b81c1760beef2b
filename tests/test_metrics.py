import itertools
import math

import numpy as np
import pytest

from cellwise.operators import metrics as C


def _prf_weighted(y, p):
    labels = sorted(set(y) | set(p))
    res = []
    for l in labels:
        tp = sum(1 for a, b in zip(y, p) if a == l and b == l)
        pp = sum(1 for b in p if b == l)
        sup = sum(1 for a in y if a == l)
        pr = tp / pp if pp else 0.0
        rc = tp / sup if sup else 0.0
        f = 2 * pr * rc / (pr + rc) if pr + rc else 0.0
        res.append((pr, rc, f, sup))
    n = len(y)
    return tuple(sum(r[i] * r[3] for r in res) / n for i in range(3))


def _auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, size=400)
    p = np.where(rng.random(400) < 0.6, y, rng.integers(0, 3, size=400))
    raw = rng.random((400, 3)) + np.eye(3)[y] * 0.7
    raw = np.round(raw, 2)  # ties
    proba = raw / raw.sum(axis=1, keepdims=True)
    rows = [(int(a), int(b), [float(v) for v in r]) for a, b, r in zip(y, p, proba)]
    return spark.createDataFrame(rows, "y int, prediction int, probability array<double>"), y, p, proba


def test_confusion_and_accuracy(scored):
    df, y, p, _ = scored
    cm = C.confusion_matrix(df, "y", "prediction").collect()
    assert len(cm) == 9 and sum(r["n"] for r in cm) == len(y)
    acc = C.accuracy(df, "y", "prediction").first()["accuracy"]
    assert abs(acc - np.mean(y == p)) < 1e-12
    rec = C.precision_recall_f1(df, "y", "prediction").first()["recall"]
    assert abs(rec - acc) < 1e-12  # weighted recall == accuracy


def test_prf_weighted_and_binary(spark, scored):
    df, y, p, _ = scored
    got = C.precision_recall_f1(df, "y", "prediction").first()
    ref = _prf_weighted(list(y), list(p))
    assert np.allclose([got["precision"], got["recall"], got["f1_score"]], ref, atol=1e-12)
    b = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], ["y", "p"])
    g = C.precision_recall_f1(b, "y", "p").first()
    assert (g["precision"], g["recall"]) == (2 / 3, 2 / 3)


def test_log_loss_matches_numpy(scored):
    df, y, _, proba = scored
    ll = C.log_loss(df, "y", "probability").first()["log_loss"]
    eps = np.finfo(float).eps
    ref = -np.mean(np.log(np.clip(proba[np.arange(len(y)), y], eps, 1 - eps)))
    assert abs(ll - ref) < 1e-12


def test_auc_binary_brute_force_and_invariance(spark, scored):
    _, y, _, proba = scored
    yb = (y == 1).astype(int)
    s = np.round(proba[:, 1], 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(yb, s)], ["y", "s"])
    got = C.roc_auc(df, "y", "s", n_buckets=6).first()["roc_auc"]
    assert abs(got - _auc(list(yb), list(s))) < 1e-12
    mono = df.selectExpr("y", "exp(3 * s) as s")
    assert abs(C.roc_auc(mono, "y", "s").first()["roc_auc"] - got) < 1e-12
    one = spark.createDataFrame([(1, 0.3), (1, 0.5)], ["y", "s"])
    assert C.roc_auc(one, "y", "s").first()["roc_auc"] is None


def test_auc_ovr_weighted(scored):
    df, y, _, proba = scored
    got = C.roc_auc_ovr(df, "y", "probability").first()["roc_auc"]
    ref = sum(_auc(list((y == c).astype(int)), list(proba[:, c])) * np.sum(y == c) for c in range(3)) / len(y)
    assert abs(got - ref) < 1e-12


def test_report_rows(scored):
    df, y, p, _ = scored
    rep = {r["label"]: r for r in C.classification_report(df, "y", "prediction",
                                                          names={0: "Short", 1: "Medium", 2: "Long"}).collect()}
    assert set(rep) == {"Short", "Medium", "Long", "accuracy", "macro avg", "weighted avg"}
    assert abs(rep["accuracy"]["f1_score"] - np.mean(y == p)) < 1e-12
    assert rep["weighted avg"]["support"] == len(y)


def test_regression_metrics_constant_target(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], ["y", "p"])
    r = C.regression_metrics(df, "y", "p").first()
    assert (r["r2"], r["mae"], r["mse"]) == (0.0, 0.5, 0.5)
    df2 = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.5)], ["y", "p"])
    r2 = C.regression_metrics(df2, "y", "p").first()["r2"]
    assert math.isclose(r2, 1 - (0.25 + 0.25 + 0.25) / 2.0)


def test_uncovered_labels_and_null_scores(spark):
    ok = [(0, 0, [0.8, 0.2]), (1, 1, [0.3, 0.7]), (1, 0, [0.6, 0.4]), (0, 0, [0.9, 0.1])]
    df = spark.createDataFrame(ok, "y int, yhat int, p array<double>")
    assert C.roc_auc_ovr(df, "y", "p").first()["roc_auc"] == 1.0
    stray = spark.createDataFrame([*ok, (2, 1, [0.5, 0.5])], "y int, yhat int, p array<double>")
    assert C.roc_auc_ovr(stray, "y", "p").first()["roc_auc"] is None
    assert C.classification_metrics(stray, "y", "yhat", "p").first()["roc_auc"] is None
    null = spark.createDataFrame([*ok, (1, 1, [None, None])], "y int, yhat int, p array<double>")
    assert C.roc_auc_ovr(null, "y", "p").first()["roc_auc"] == 1.0
