"""Edge rows listed in FIXTURES.md (scored frames, batches, payloads)."""

import json
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.operators import metrics as C
from cellwise.operators import profile as A
from cellwise.operators.prepare import cast_features
from cellwise.sources import files as S


def test_metrics_with_absent_classes_and_extreme_probabilities(spark):
    # class 2 never predicted; class 3 predicted but absent from the truth
    rows = [(0, 0, [1.0, 0.0, 0.0, 0.0]), (1, 1, [0.0, 1.0, 0.0, 0.0]), (2, 3, [0.2, 0.2, 0.1, 0.5]),
            (2, 0, [0.5, 0.2, 0.3, 0.0]), (1, 1, [0.1, 0.8, 0.1, 0.0])]
    df = spark.createDataFrame(rows, "y int, prediction int, probability array<double>")
    cm = {(r["y"], r["yhat"]): r["n"] for r in C.confusion_matrix(df, "y", "prediction").collect()}
    assert len(cm) == 16 and cm[(2, 3)] == 1 and cm[(3, 3)] == 0
    st = {r["label"]: r for r in C.per_class_stats(df, "y", "prediction").collect()}
    assert st[2]["precision"] == 0.0 and st[3]["recall"] == 0.0 and st[3]["support"] == 0
    ll = C.log_loss(df, "y", "probability").first()["log_loss"]
    eps = 2.220446049250313e-16
    ref = -(math.log(1 - eps) * 2 + math.log(0.1) + math.log(0.3) + math.log(0.8)) / 5
    assert abs(ll - ref) < 1e-12
    m = C.classification_metrics(df, "y", "prediction", "probability").first()
    assert m["num_classes"] == 3.0 and abs(m["accuracy"] - 0.6) < 1e-12


def test_last_rows_equal_timestamps_tie_break(spark):
    rows = [(i, "2024-01-01 00:00:00" if i < 3 else "2023-12-31 00:00:00") for i in range(6)]
    df = spark.createDataFrame(rows, "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert [r.id for r in A.last_rows(df, 2, "ts", ["id"]).collect()] == [2, 1]
    assert A.last_rows(df.drop("ts"), 2, "ts").count() == 2  # no stamp column: any two rows


def test_payload_edges(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"dataframe_records": []}))
    (tmp_path / "b.json").write_text(json.dumps({"dataframe_records": [{"SOC": 1.5}]}))
    sch = S.payload_schema({"SOC": T.StringType(), "EV_Model": T.StringType()})
    recs = S.read_records(spark, str(tmp_path), sch)
    rows = recs.collect()
    assert len(rows) == 1 and rows[0]["EV_Model"] is None  # empty array: no rows; missing field: null
    out = cast_features(recs, {"SOC": "double", "EV_Model": "string"}).first()
    assert out["SOC"] == 1.5 and out["_rejected"] is False
