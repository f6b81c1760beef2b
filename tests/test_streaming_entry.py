import json

from pyspark.sql import functions as F

from cellwise.operators import models as M
from cellwise.session import scratch_path
from cellwise.streaming import score_stream
from tests.conftest import SF_SMALL


def test_score_stream_scores_and_rejects(spark, tmp_path):
    train = spark.createDataFrame([(float(i % 7), "a" if i % 2 else "b", i % 3) for i in range(90)],
                                  "x double, kind string, y int")
    model = M.fit_classifier(train, ["x"], ["kind"], "y", {"learning_rate": 0.3, "n_estimators": 3,
                                                           "max_depth": 2})
    in_dir = tmp_path / "in"
    in_dir.mkdir()
    (in_dir / "r1.json").write_text(json.dumps({"dataframe_records": [{"x": 1.0, "kind": "a"},
                                                                      {"x": "bad", "kind": "b"}]}))
    (in_dir / "r2.json").write_text(json.dumps({"dataframe_records": [{"x": 3.0, "kind": "zzz"}]}))
    out = scratch_path(spark, "scored")
    score_stream(spark, str(in_dir), out, scratch_path(spark, "ckpt"), model,
                 {"x": "double", "kind": "string"}, multi_line=True)
    res = spark.read.parquet(out).collect()
    assert len(res) == 3
    assert sum(r["rejected"] for r in res) == 1
    assert all(r["prediction"] is not None for r in res if not r["rejected"])


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["split", "target_class", "n", "n_classes"] and len(rows) > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 40
    for name in ("hash_split_orders", "describe_lineitem", "validation_verdict_runs"):
        assert qs[name](spark, SF_SMALL).count() > 0


def test_score_stream_restart_processes_only_new_files(spark, tmp_path):
    train = spark.createDataFrame([(float(i % 5), "a", i % 2) for i in range(60)], "x double, kind string, y int")
    model = M.fit_classifier(train, ["x"], ["kind"], "y", {"learning_rate": 0.3, "n_estimators": 2,
                                                           "max_depth": 2})
    in_dir = tmp_path / "in"
    in_dir.mkdir()
    out, ckpt = scratch_path(spark, "scored"), scratch_path(spark, "ckpt")
    types = {"x": "double", "kind": "string"}
    (in_dir / "a.json").write_text(json.dumps({"dataframe_records": [{"x": 1.0, "kind": "a"}]}))
    score_stream(spark, str(in_dir), out, ckpt, model, types)
    (in_dir / "b.json").write_text(json.dumps({"dataframe_records": [{"x": 2.0, "kind": "a"},
                                                                     {"x": 3.0, "kind": "a"}]}))
    (in_dir / "c.json").write_text(json.dumps({"dataframe_records": [{"x": 4.0, "kind": "a"}]}))
    score_stream(spark, str(in_dir), out, ckpt, model, types, max_files_per_trigger=1)
    res = spark.read.parquet(out)
    assert res.count() == 4
    assert res.select("batch_id").distinct().count() == 3


def test_unreadable_payloads_go_to_the_dead_letters(spark, tmp_path):
    """One good file, one cut off, one without records: nothing vanishes, and
    a restart adds nothing."""
    train = spark.createDataFrame([(float(i % 5), "a", i % 2) for i in range(60)], "x double, kind string, y int")
    model = M.fit_classifier(train, ["x"], ["kind"], "y", {"learning_rate": 0.3, "n_estimators": 2, "max_depth": 2})
    in_dir = tmp_path / "in"
    in_dir.mkdir()
    good = json.dumps({"dataframe_records": [{"x": 1.0, "kind": "a"}, {"x": 2.0, "kind": "a"}]})
    (in_dir / "good.json").write_text(good)
    (in_dir / "cut.json").write_text(good[:40])
    (in_dir / "other.json").write_text('{"records": []}')
    (in_dir / "empty.json").write_text('{"dataframe_records": []}')
    out, ckpt = scratch_path(spark, "scored"), scratch_path(spark, "ckpt")
    for _ in range(2):
        score_stream(spark, str(in_dir), out, ckpt, model, {"x": "double", "kind": "string"})
        assert spark.read.parquet(out).count() == 2
        bad = {r["file"].rsplit("/", 1)[1]: (r["reason"], r["text"]) for r in spark.read.parquet(out + "-rejected").collect()}
        assert bad == {"cut.json": ("malformed", good[:40]), "other.json": ("no dataframe_records", None)}
