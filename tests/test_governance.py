from pyspark.sql import functions as F

from cellwise.operators import governance as G

MET = "run_id string, name string, value double"
PAR = "run_id string, name string, value string"


def _metrics(spark):
    good = [("good", n, v) for n, v in [("accuracy", 0.9), ("f1_score", 0.85), ("precision", 0.8),
                                          ("recall", 0.8), ("roc_auc", 0.9), ("log_loss", 0.3)]]
    edge = [("edge", "accuracy", 0.85), ("edge", "f1_score", float("nan")), ("edge", "precision", None),
            ("edge", "recall", 0.74999), ("edge", "log_loss", 0.5000001)]
    return spark.createDataFrame(good + edge, MET)


def _params(spark):
    return spark.createDataFrame([
        ("good", "learning_rate", "0.01"), ("good", "n_estimators", "1000"), ("good", "max_depth", "6"),
        ("good", "num_leaves", "31"),
        ("edge", "learning_rate", "abc"), ("edge", "n_estimators", "5000"), ("edge", "max_depth", "6"),
        ("edge", "num_leaves", "65")], PAR)


def test_metric_audit_edges(spark):
    f = {r["failure"] for r in G.audit_metrics(_metrics(spark)).collect() if r["run_id"] == "edge"}
    assert f == {"f1_score: not a number", "precision: missing", "recall: 0.7500 < 0.75",
                 "roc_auc: missing", "log_loss: 0.5000 > 0.5"}
    assert G.audit_metrics(_metrics(spark)).where("run_id = 'good'").count() == 0


def test_param_and_leaves_audit(spark):
    f = [r["failure"] for r in G.audit_params(_params(spark)).where("run_id='edge'").collect()]
    assert f == ["learning_rate: not numeric (abc)", "n_estimators: 5000.0 not in [100, 3000]"]
    leaves = [r["failure"] for r in G.audit_leaves(_params(spark)).collect()]
    assert leaves == ["num_leaves 65 > 2^max_depth (64)"]


def test_verdict(spark):
    v = {r["run_id"]: r for r in G.validation_verdict(_metrics(spark), _params(spark)).collect()}
    assert v["good"]["status"] == "passed" and v["good"]["failures"] == []
    assert v["edge"]["status"] == "failed" and len(v["edge"]["failures"]) == 8


def _registry(spark):
    versions = spark.createDataFrame([("m", 1, "r1"), ("m", 2, "r2"), ("m", 3, "r3"), ("n", 1, "s1")],
                                     "model string, version int, run_id string")
    events = spark.createDataFrame([("m", "Champion", 1, 1), ("m", "challenger", 2, 2),
                                    ("m", "champion", 2, 3), ("m", "Challenger", 3, 4)],
                                   "model string, alias string, version int, event_seq long")
    metrics = spark.createDataFrame([("r2", "f1_score", 0.8), ("r2", "roc_auc", 0.9),
                                     ("r3", "f1_score", 0.81), ("r3", "roc_auc", 0.899),
                                     ("s1", "f1_score", 0.5), ("r9", "f1_score", float("nan")),
                                     ("r9", "roc_auc", 0.9)], MET)
    return versions, events, metrics


def test_alias_holder_case_insensitive(spark):
    _, events, _ = _registry(spark)
    h = {(r["model"], r["alias"]): r["version"] for r in G.alias_holder(events).collect()}
    assert h == {("m", "champion"): 2, ("m", "challenger"): 3}


def test_promotion_gate_order(spark):
    versions, events, metrics = _registry(spark)
    cands = spark.createDataFrame([("m", "r3"), ("n", "s1"), ("m", "r9")], "model string, run_id string")
    d = {r["candidate_run_id"]: r for r in G.promotion_gate(cands, metrics, versions, events).collect()}
    assert d["s1"]["status"] == "promote" and d["s1"]["reason"] == "no champion"
    assert d["r9"]["status"] == "invalid"
    assert d["r3"]["status"] == "promote"  # dAUC -0.001 >= -0.002, dF1 +0.01
    strict = {r["candidate_run_id"]: r["status"]
              for r in G.promotion_gate(cands, metrics, versions, events, 0.0, 0.0).collect()}
    assert strict["r3"] == "blocked"


def test_swap_twice_restores(spark):
    versions, events, metrics = _registry(spark)
    dec = spark.createDataFrame([("m", "promote")], "model string, status string")
    ev1 = events.unionByName(G.alias_swap_events(dec, events))
    h1 = {r["alias"]: r["version"] for r in G.alias_holder(ev1).collect()}
    assert h1 == {"champion": 3, "challenger": 2}
    ev2 = ev1.unionByName(G.alias_swap_events(dec, ev1))
    h2 = {r["alias"]: r["version"] for r in G.alias_holder(ev2).collect()}
    assert h2 == {"champion": 2, "challenger": 3}


def test_register_versions_forced_buckets(spark):
    runs = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), (F.col("id") % 5).cast("string")))
        .alias("model"), F.col("id").cast("string").alias("run_id"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=(F.col("id") % 17).cast("int")))
        .alias("registered_at"))
    got = G.register_versions(runs, n_buckets=4).toPandas()
    for _, g in got.groupby("model"):
        g = g.sort_values(["registered_at", "run_id"])
        assert list(g["version"]) == list(range(1, len(g) + 1))
    latest = {r["model"]: r["version"] for r in G.latest_alias(G.register_versions(runs)).collect()}
    assert latest["hot"] == int((got["model"] == "hot").sum())


def test_champion_reeval(spark):
    s = spark.createDataFrame([("candidate", 1, 1), ("candidate", 0, 0), ("champion", 1, 0),
                               ("champion", 0, 0)], "model_tag string, y int, yhat int")
    r = G.champion_reeval(s, "y", "yhat").first()
    assert r["improved"] is True and r["f1_new"] == 1.0
    only = G.champion_reeval(s.where("model_tag = 'candidate'"), "y", "yhat").first()
    assert only["improved"] is True and only["f1_old"] is None


def test_verdict_version_from_uri(spark):
    runs = spark.createDataFrame([("good", "models:/ev_model/7"), ("edge", "models:/ev_model/8")],
                                 "run_id string, model_uri string")
    v = {r["run_id"]: r["version"] for r in G.validation_verdict(_metrics(spark), _params(spark), runs).collect()}
    assert v == {"good": "7", "edge": "8"}
