import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.config import (
    EV_CAT_FEATURES, EV_NUM_FEATURES, EV_RENAMES, EV_SENTINELS, EV_TARGET, EV_TARGET_DOMAIN,
)
from cellwise.operators import prepare as P

RAW_HEADERS = list(EV_RENAMES)


def ev_raw(spark):
    """Raw EV rows (renamed-from headers), with the edge rows of the fixtures."""
    schema = T.StructType([
        T.StructField("SOC (%)", T.DoubleType()), T.StructField("Voltage (V)", T.DoubleType()),
        T.StructField("Current (A)", T.DoubleType()), T.StructField("Battery Temp (°C)", T.DoubleType()),
        T.StructField("Ambient Temp (°C)", T.DoubleType()),
        T.StructField("Charging Duration (min)", T.DoubleType()),
        T.StructField("Degradation Rate (%)", T.DoubleType()), T.StructField("Charging Mode", T.StringType()),
        T.StructField("Efficiency (%)", T.DoubleType()), T.StructField("Battery Type", T.StringType()),
        T.StructField("Charging Cycles", T.LongType()), T.StructField("EV Model", T.StringType()),
        T.StructField("Optimal Charging Duration Class", T.StringType()),
    ])
    good = (43.7, 3.63, 33.5, 33.4, 26.4, 59.4, 8.8, "Fast", 98.2, "Li-ion", 112, "Model B", "1")
    rows = [
        good,
        good,  # exact duplicate
        (None, 3.6, 30.0, 30.0, 25.0, 50.0, 9.0, "Slow", 97.5, "LiFePO4", 200, "Model A", "0"),
        (50.0, None, 30.0, 30.0, 25.0, 50.0, 9.0, None, 97.5, None, None, None, "2"),
        (float("nan"), 3.7, 30.0, 30.0, 25.0, 50.0, 9.0, "Normal", 97.5, "Li-ion", 300, "Model C", "2"),
        (50.0, 3.7, 30.0, 30.0, 25.0, 50.0, 9.0, "Normal", 97.5, "Li-ion", 300, "Model C", None),
        (50.0, 3.7, 30.0, 30.0, 25.0, 50.0, 9.0, "Normal", 97.5, "Li-ion", 300, "Model C", "3"),
        (50.0, 3.7, 30.0, 30.0, 25.0, 50.0, 9.0, "Normal", 97.5, "Li-ion", 300, "Model C", "1.0"),
        (50.0, 3.7, 30.0, 30.0, 25.0, 50.0, 9.0, "Normal", 97.5, "Li-ion", 300, "Model C", "Short"),
    ]
    return spark.createDataFrame(rows, schema)


def test_clean_frame_drops_only_bad_targets(spark):
    df = P.clean_frame(ev_raw(spark), EV_RENAMES, EV_SENTINELS, EV_TARGET, EV_TARGET_DOMAIN,
                       EV_NUM_FEATURES, EV_CAT_FEATURES)
    assert df.columns == [*EV_NUM_FEATURES, *EV_CAT_FEATURES, EV_TARGET]
    rows = df.collect()
    assert len(rows) == 5  # null, "3", "1.0", "Short" targets dropped; duplicates kept
    assert dict(df.dtypes)[EV_TARGET] == "int"
    assert {r[EV_TARGET] for r in rows} == {0, 1, 2}
    by_target = {r[EV_TARGET]: r for r in rows if r[EV_TARGET] != 1}
    assert by_target[0]["SOC"] == -1.0  # null -> -1.0 (double, not the text "-1")
    r2 = [r for r in rows if r[EV_TARGET] == 2]
    assert any(r["Voltage"] == -1.0 and r["Charging_Mode"] == "Unknown" and r["Charging_Cycles"] == -1
               for r in r2)
    assert any(r["SOC"] == -1.0 for r in r2)  # NaN filled too
    assert all(not (isinstance(r["SOC"], float) and math.isnan(r["SOC"])) for r in rows)


def test_domain_filter_pushed_to_scan(spark, tmp_path):
    path = str(tmp_path / "ev.parquet")
    ev_raw(spark).write.parquet(path)
    df = P.filter_domain(P.rename_columns(spark.read.parquet(path), EV_RENAMES), EV_TARGET, EV_TARGET_DOMAIN)
    from tests.conftest import plan_text

    plan = plan_text(df)
    assert "PushedFilters: [In(`Optimal Charging Duration Class`, [0,1,2])]" in plan


def test_cast_features_rejects_text(spark):
    df = spark.createDataFrame([("1.5", "3"), ("abc", "4"), (None, "x")], ["a", "b"])
    out = P.cast_features(df, {"a": "double", "b": "bigint"}).collect()
    assert [r["_rejected"] for r in out] == [False, True, True]
    assert out[1]["a"] is None and out[0]["a"] == 1.5
    cnt = P.rejected_count(P.cast_features(df, {"a": "double", "b": "bigint"})).first()
    assert (cnt["rejected"], cnt["rows"]) == (2, 3)


def test_flag_is_equality_not_truthiness(spark):
    df = spark.createDataFrame([("Yes",), ("No",), (None,)], ["overheating_issues"])
    vals = [r[0] for r in P.to_flag(df, "overheating_issues").collect()]
    assert vals == [True, False, None]


def test_label_text_and_preview(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (7,)], ["c"])
    out = P.label_text(df, "c", {0: "Short", 1: "Medium", 2: "Long"}, "other", out="name")
    assert [r["name"] for r in out.orderBy("c").collect()] == ["Short", "Medium", "Long", "other"]
    assert [r["c"] for r in P.preview(df, 2, ["c"]).collect()] == [0, 1]
    assert P.to_int_matrix(spark.createDataFrame([(2.9,)], ["x"]), ["x"]).first()["x"] == 2


def test_integer_cast_accepts_integral_decimal_text(spark):
    df = spark.createDataFrame([("310",), ("310.0",), ("310.5",), ("x",)], ["c"])
    out = P.cast_features(df, {"c": "bigint"}).collect()
    assert [(r["c"], r["_rejected"]) for r in out] == [(310, False), (310, False), (None, True), (None, True)]
