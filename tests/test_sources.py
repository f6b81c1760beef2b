import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.session import scratch_path
from cellwise.sources import files as S
from cellwise.sources.lineage import check_schema, dataset_fingerprint, schema_signature
from cellwise.sources.versions import appended_since, batch_versions
from tests.conftest import SF_SMALL


def test_csv_with_corrupt_record(spark, tmp_path):
    p = tmp_path / "ev.csv"
    p.write_text("a,b\n1.5,x\nnot-a-number,y\n2.5,z\n")
    sch = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.StringType())])
    df = S.read_csv(spark, str(p), sch, keep_corrupt=True).cache()
    rows = df.collect()
    assert len(rows) == 3
    assert [r["_corrupt_record"] is not None for r in rows] == [False, True, False]


def test_append_versions_and_since(spark):
    path = scratch_path(spark, "t")
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey")
    S.append_split(o.where("o_orderkey % 2 = 0"), path, "a")
    S.append_split(o.where("o_orderkey % 2 = 1"), path, "b")
    df = spark.read.parquet(path)
    v = [(r["version"], r["run_id"]) for r in batch_versions(df).orderBy("version").collect()]
    assert v == [(0, "a"), (1, "b")]
    since = appended_since(df, 0)
    assert since.count() == o.where("o_orderkey % 2 = 1").count()
    assert S.read_split(spark, path, "latest").count() == since.count()
    assert S.read_split(spark, path).count() == o.count()


def test_records_payload_with_bad_value(spark, tmp_path):
    p = tmp_path / "req.json"
    p.write_text(json.dumps({"dataframe_records": [{"SOC": 64.1, "EV_Model": "Model B"},
                                                   {"SOC": "abc", "EV_Model": "Model A"}]}))
    sch = S.payload_schema({"SOC": T.StringType(), "EV_Model": T.StringType()})
    recs = S.read_records(spark, str(p), sch)
    assert recs.count() == 2
    from cellwise.operators.prepare import cast_features

    out = cast_features(recs, {"SOC": "double", "EV_Model": "string"}).collect()
    assert [r["_rejected"] for r in out] == [False, True]


def test_fingerprint_order_insensitive(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    a = dataset_fingerprint(li, "li").first()
    b = dataset_fingerprint(li.repartition(5).orderBy(F.rand(1)), "li").first()
    assert (a["rows"], a["digest"]) == (b["rows"], b["digest"])


def test_schema_check(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    sig = schema_signature(o)
    assert check_schema(o, sig).count() == 0
    bad = o.withColumn("o_totalprice", F.lit("x")).drop("o_custkey")
    probs = {r["column"]: r for r in check_schema(bad, sig).collect()}
    assert probs["o_custkey"]["problem"] == "missing"
    assert probs["o_totalprice"]["bad_values"] == o.count()
