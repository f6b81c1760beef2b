import numpy as np


from cellwise.plans import flows
from cellwise.session import scratch_path
from cellwise.sources import files as S


def _ev_csv(path, n=240, seed=7):
    rng = np.random.default_rng(seed)
    header = flows.EV_RAW_SCHEMA.fieldNames()  # raw headers, file order
    lines = [",".join(header)]
    modes, types, models = ["Fast", "Normal", "Slow"], ["Li-ion", "LiFePO4"], ["Model A", "Model B", "Model C"]
    for i in range(n):
        soc, dur = rng.uniform(10, 99), rng.uniform(20, 120)
        mode = modes[i % 3]
        cls = 0 if dur < 50 else (1 if dur < 85 else 2)
        target = "Short" if i == 5 else ("" if i == 6 else str(cls))
        vals = {"SOC (%)": f"{soc:.3f}", "Voltage (V)": f"{rng.uniform(3.5, 4.2):.3f}",
                "Current (A)": f"{rng.uniform(12, 99):.2f}", "Battery Temp (°C)": f"{rng.uniform(20, 40):.2f}",
                "Ambient Temp (°C)": f"{rng.uniform(15, 35):.2f}", "Charging Duration (min)": f"{dur:.2f}",
                "Degradation Rate (%)": f"{rng.uniform(4, 15):.2f}", "Charging Mode": mode,
                "Efficiency (%)": f"{rng.uniform(97, 99.1):.2f}", "Battery Type": types[i % 2],
                "Charging Cycles": str(int(rng.integers(100, 1000))), "EV Model": models[i % 3],
                "Optimal Charging Duration Class": target}
        if i == 9:
            vals["SOC (%)"] = ""
        lines.append(",".join(vals[h] for h in header))
    lines.append(lines[-1].replace(lines[-1].split(",")[0], "oops", 1))  # a malformed number
    path.write_text("\n".join(lines) + "\n")


def test_prepare_train_validate_promote(spark, tmp_path):
    csv = tmp_path / "ev.csv"
    _ev_csv(csv)
    base = scratch_path(spark, "ev")
    rid = flows.prepare_flow(spark, str(csv), base, run_id="r1")
    train = S.read_split(spark, f"{base}/train_set")
    test = S.read_split(spark, f"{base}/test_set")
    assert train.count() + test.count() == 238 and test.count() == 48  # 2 bad targets dropped
    rejects = spark.read.parquet(f"{base}/rejects").collect()
    assert [r["_corrupt_record"][:5] for r in rejects] == ["oops,"]
    assert train.unionByName(test).where("SOC = -1.0").count() == 1  # the empty value, not the bad one
    res = flows.train_flow(spark, base, params={"learning_rate": 0.3, "n_estimators": 5, "max_depth": 3})
    m = res.metrics.first()
    assert m["accuracy"] > 0.8 and m["num_classes"] == 3.0 and m["roc_auc"] is not None
    assert {(r["name"], r["version"]) for r in res.lineage.collect()} == {("train_set", "0"), ("test_set", "0")}
    assert {"Short", "Medium", "Long"} <= {r["label"] for r in res.report.collect()}
    assert sum(r["n"] for r in res.confusion.collect()) == 48
    mrows = flows.metric_rows(rid, res.metrics)
    prow = flows.param_rows(spark, rid, {"learning_rate": 0.3, "n_estimators": 5, "max_depth": 3})
    v = flows.validation_flow(mrows, prow).first()
    assert v["status"] == "failed" and "n_estimators: 5.0 not in [100, 3000]" in v["failures"]
    # save / load round trip
    path = scratch_path(spark, "model")
    S.save_model(res.model, path)
    loaded = S.load_model(path)
    a = res.model.transform(test).select("prediction").collect()
    b = loaded.transform(test).select("prediction").collect()
    assert a == b
    # promotion: no champion yet -> promote
    versions = spark.createDataFrame([("ev", 1, rid)], "model string, version int, run_id string")
    events = spark.createDataFrame([("ev", "Challenger", 1, 1)], "model string, alias string, version int, event_seq long")
    cands = spark.createDataFrame([("ev", rid)], "model string, run_id string")
    dec, ev = flows.promotion_flow(cands, mrows, versions, events)
    assert dec.first()["status"] == "promote"
    assert [(r["alias"], r["version"]) for r in ev.collect()] == [("Champion", 1)]


def test_cli_chain(spark, tmp_path, capsys):
    """prepare -> train -> validate -> promote -> check -> score, every table
    written by the steps themselves."""
    import json

    from cellwise.plans import cli

    csv = tmp_path / "ev.csv"
    _ev_csv(csv, n=150, seed=3)
    base, runs = scratch_path(spark, "cli"), scratch_path(spark, "runs")
    assert cli.main(["prepare", "--csv", str(csv), "--out", base, "--run-id", "r1"]) == 0
    assert '"rejected": 1' in capsys.readouterr().out
    bad, model_path = scratch_path(spark, "bad"), scratch_path(spark, "m")
    assert cli.main(["train", "--base", base, "--model-out", bad, "--runs-out", runs,
                     "--params", '{"learning_rate": 0.3, "n_estimators": 3, "max_depth": 3}']) == 0
    # 3 rounds and a rate of 0.3 are outside the allowed ranges
    assert cli.main(["validate", "--runs", runs]) == 1
    out = capsys.readouterr().out
    assert '"status": "failed"' in out and "n_estimators: 3.0 not in [100, 3000]" in out
    assert spark.read.parquet(f"{runs}/alias_events").count() == 0
    assert cli.main(["train", "--base", base, "--model-out", model_path, "--runs-out", runs,
                     "--params", '{"learning_rate": 0.1, "n_estimators": 100, "max_depth": 2}']) == 0
    assert cli.main(["validate", "--runs", runs]) == 1  # the first run stays failed
    tags = {r["version"]: (r["status"], r["alias"]) for r in spark.read.parquet(f"{runs}/run_tags").collect()}
    assert tags == {1: ("failed", None), 2: ("passed", "Challenger")}
    for t in ("run_reports", "run_confusions", "run_lineage", "run_signatures"):
        assert spark.read.parquet(f"{runs}/{t}").select("run_id").distinct().count() == 2
    assert cli.main(["promote", "--runs", runs]) == 0
    events = sorted((r["event_seq"], r["alias"], r["version"]) for r in spark.read.parquet(f"{runs}/alias_events").collect())
    assert [e[1:] for e in events] == [("Challenger", 2), ("Champion", 2)]
    assert [r["status"] for r in spark.read.parquet(f"{runs}/swap_status").collect()] == ["swapped"]
    # before deployment: newest rows through the saved model
    capsys.readouterr()
    signature = spark.read.parquet(f"{runs}/run_signatures").first()["signature"]
    assert cli.main(["check", "--model", model_path, "--table", f"{base}/test_set", "--signature", signature]) == 0
    assert json.loads(capsys.readouterr().out)["scored"] == spark.read.parquet(f"{base}/test_set").count()
    # score a request payload through the saved model (stream, availableNow)
    req = tmp_path / "req"
    req.mkdir()
    rec = {"SOC": 55.0, "Voltage": 3.8, "Current": 40.0, "Battery_Temp": 30.0, "Ambient_Temp": 25.0,
           "Charging_Duration": 95.0, "Degradation_Rate": 9.0, "Charging_Mode": "Fast",
           "Efficiency": 98.0, "Battery_Type": "Li-ion", "Charging_Cycles": 300, "EV_Model": "Model A"}
    (req / "r.json").write_text(json.dumps({"dataframe_records": [rec]}))
    out_dir = scratch_path(spark, "scored")
    assert cli.main(["score", "--model", model_path, "--in", str(req), "--out", out_dir,
                     "--checkpoint", scratch_path(spark, "ck")]) == 0
    row = spark.read.parquet(out_dir).first()
    assert row["prediction"] in (0, 1, 2) and abs(sum(row["probability"]) - 1) < 1e-9


def test_deployability_raises(spark, tmp_path):
    import pytest

    empty = str(tmp_path / "empty")
    spark.createDataFrame([], "x double").write.parquet(empty)
    with pytest.raises(RuntimeError):
        flows.deployability_check(spark, "unused", empty, {"x": "double"})
    bad = str(tmp_path / "bad")
    spark.createDataFrame([("oops",)], "x string").write.parquet(bad)
    with pytest.raises(ValueError):
        flows.deployability_check(spark, "unused", bad, {"x": "double"}, '[["x", "double"]]')
    with pytest.raises(ValueError):
        flows.deployability_check(spark, "unused", bad, {"x": "double"})


def test_config_environment(tmp_path):
    import pytest

    from cellwise.config import ProjectConfig

    pytest.importorskip("yaml")
    f = tmp_path / "c.yml"
    f.write_text("acc:\n  catalog_name: c_acc\n  schema_name: s\n  input_data_path: in.csv\ntarget: T\n")
    cfg = ProjectConfig.from_yaml(str(f), "acc")
    assert (cfg.input_data_path, cfg.table_base("/w/"), cfg.target) == ("in.csv", "/w/c_acc/s", "T")
    with pytest.raises(ValueError):
        ProjectConfig.from_yaml(str(f), "test")
    with pytest.raises(ValueError):
        ProjectConfig.from_yaml(str(f), "dev").table_base("/w")
