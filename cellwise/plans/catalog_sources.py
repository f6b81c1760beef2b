"""Registered source / sink queries (S1-S9): each writes a table derived
from a driver table into a fresh folder under the shared checkpoint
directory and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.plans.catalog import SPLIT_SQL_EXPR, register
from cellwise.session import scratch_path
from cellwise.sources import files as S
from cellwise.sources.lineage import check_schema, dataset_fingerprint, schema_signature
from cellwise.sources.versions import appended_since, batch_versions
from cellwise.operators.split import hash_split, split_frames

LINEITEM_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@register("csv_roundtrip_lineitem", "SELECT * FROM lineitem")
def csv_roundtrip_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem written as header CSV, read back with an explicit schema."""
    path = scratch_path(spark, "lineitem_csv")
    li = S.read_table(spark, sf, "lineitem")
    li.write.option("header", "true").option("timestampNTZFormat", TS_FORMAT).csv(path)
    return S.read_csv(spark, path, LINEITEM_SCHEMA, timestampNTZFormat=TS_FORMAT)


@register("payload_records_lineitem", """
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem""")
def payload_records_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """S3: scoring payloads ({"dataframe_records": [...]}) of one record each,
    written as JSON and read back as one row per record."""
    path = scratch_path(spark, "payloads")
    li = S.read_table(spark, sf, "lineitem")
    rec = F.struct("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    li.select(F.array(rec).alias("dataframe_records")).write.json(path)
    schema = S.payload_schema({"l_orderkey": T.LongType(), "l_linenumber": T.IntegerType(),
                               "l_quantity": T.DoubleType(), "l_extendedprice": T.DoubleType(),
                               "l_returnflag": T.StringType()})
    return S.read_records(spark, path, schema, multi_line=False)


@register("payload_dead_letters_lineitem", """
  SELECT CASE WHEN l_orderkey % 50 = 0 THEN 'malformed' WHEN l_orderkey % 50 = 1 THEN 'no dataframe_records' ELSE 'kept' END AS outcome,
         count(*) AS payloads, sum(CASE WHEN l_orderkey % 50 > 1 THEN l_quantity ELSE 0 END) AS quantity
  FROM lineitem GROUP BY ALL""")
def payload_dead_letters_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """S3: a fiftieth of the payloads cut off, a fiftieth without the records'
    name: kept and rejected payloads are all payloads, by reason."""
    path, key = scratch_path(spark, "payloads"), F.col("l_orderkey") % 50
    rec = F.to_json(F.struct("l_orderkey", "l_quantity"))
    text = F.concat(F.when(key == 1, '{"records": [').otherwise('{"dataframe_records": ['), rec, F.lit("]}"))
    S.read_table(spark, sf, "lineitem").select(
        F.when(key == 0, F.substring(text, 1, 30)).otherwise(text).alias("value")).write.text(path)
    raw = S.read_payloads(spark, path, S.payload_schema({"l_orderkey": T.LongType(), "l_quantity": T.DoubleType()}), multi_line=False)
    kept = S.explode_records(raw).agg(F.lit("kept").alias("outcome"), F.count(F.lit(1)).alias("payloads"), F.sum("l_quantity").alias("quantity"))
    bad = S.rejected_payloads(raw).groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("payloads"), F.lit(0.0).alias("quantity"))
    return kept.unionByName(bad)


def _append_two_runs(spark: SparkSession, sf: str) -> str:
    base = scratch_path(spark, "splits")
    o = S.read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    train, test = split_frames(hash_split(o, ["o_orderkey"], 0.2, 42))
    for run in ("run-a", "run-b"):  # a re-run appends the same rows again
        S.append_split(train, f"{base}/train_set", run)
        S.append_split(test, f"{base}/test_set", run)
    return base


@register("append_read_splits", f"""
  SELECT t.tbl AS "table", r.run_id, count(*) AS rows
  FROM (SELECT CASE WHEN {SPLIT_SQL_EXPR.format(key='o_orderkey')} = 'train' THEN 'train_set' ELSE 'test_set' END AS tbl
        FROM orders) t, (SELECT unnest(['run-a', 'run-b']) AS run_id) r
  GROUP BY t.tbl, r.run_id""")
def append_read_splits(spark: SparkSession, sf: str) -> DataFrame:
    """S4 + S2: two stamped appends of the hash split, read back (all batches)."""
    base = _append_two_runs(spark, sf)
    parts = [S.read_split(spark, f"{base}/{t}").withColumn("table", F.lit(t))
             for t in ("train_set", "test_set")]
    both = parts[0].unionByName(parts[1])
    return both.groupBy("table", "run_id").agg(F.count(F.lit(1)).alias("rows"))


@register("read_latest_split", f"""
  SELECT o_orderkey, o_totalprice, 'run-b' AS run_id FROM orders
  WHERE {SPLIT_SQL_EXPR.format(key='o_orderkey')} = 'test'""")
def read_latest_split(spark: SparkSession, sf: str) -> DataFrame:
    """S2 with run_id='latest' (partition-pruned read of the newest batch)."""
    base = _append_two_runs(spark, sf)
    return S.read_split(spark, f"{base}/test_set", "latest").select("o_orderkey", "o_totalprice", "run_id")


def _three_batches(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "batches")
    o = S.read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    for b in range(3):
        S.append_split(o.where(F.col("o_orderkey") % 3 == b), path, f"batch-{b}")
    return spark.read.parquet(path)


@register("batch_versions_orders", """
  SELECT CAST(o_orderkey % 3 AS INTEGER) AS version, 'batch-' || CAST(o_orderkey % 3 AS VARCHAR) AS run_id,
         count(*) AS rows FROM orders GROUP BY o_orderkey % 3""")
def batch_versions_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Version history of an append-only table."""
    return batch_versions(_three_batches(spark, sf)).select("version", "run_id", "rows")


@register("appended_since_orders", """
  SELECT o_orderkey, CAST(o_orderkey % 3 AS INTEGER) AS _commit_version, 'insert' AS _change_type
  FROM orders WHERE o_orderkey % 3 > 0""")
def appended_since_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Rows appended after version 0."""
    out = appended_since(_three_batches(spark, sf), 0)
    return out.select("o_orderkey", "_commit_version", "_change_type")


@register("fingerprint_lineitem", None)
def fingerprint_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """S8 over every column (doubles and dates print differently in SQL)."""
    return dataset_fingerprint(S.read_table(spark, sf, "lineitem"), "lineitem", 0)


FINGERPRINT_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType())])


@register("fingerprint_lineitem_keys", f"""
  SELECT 'lineitem' AS name, '0' AS version, count(*) AS rows,
         CAST(sum(('0x' || substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
              coalesce(l_returnflag, '\\N'), coalesce(l_linestatus, '\\N'))), 1, 15))::BIGINT::HUGEINT) AS VARCHAR) AS digest,
         '{FINGERPRINT_SCHEMA.json()}' AS schema_json
  FROM (SELECT l_orderkey, l_linenumber, l_returnflag,
               CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_linestatus END AS l_linestatus FROM lineitem) l""")
def fingerprint_lineitem_keys(spark: SparkSession, sf: str) -> DataFrame:
    """S8 over integer and text columns, some values null."""
    li = S.read_table(spark, sf, "lineitem")
    status = F.when(F.col("l_orderkey") % 11 != 0, F.col("l_linestatus")).alias("l_linestatus")
    return dataset_fingerprint(li.select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"),
                                         "l_returnflag", status), "lineitem", 0)


@register("csv_rejects_lineitem", """
  SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, l_orderkey % 13 = 0 AS rejected,
         CASE WHEN l_orderkey % 13 <> 0 THEN l_quantity END AS l_quantity FROM lineitem""")
def csv_rejects_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """S1 with malformed numbers by rule: kept rows typed, rejected lines kept
    as text (their keys are read from it here)."""
    path = scratch_path(spark, "bad_csv")
    li = S.read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    bad = F.when(F.col("l_orderkey") % 13 == 0, F.lit("oops")).otherwise(F.col("l_quantity").cast("string"))
    li.withColumn("l_quantity", bad).write.option("header", "true").csv(path)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                           T.StructField("l_quantity", T.DoubleType())])
    raw = S.read_csv(spark, path, schema, keep_corrupt=True).checkpoint(eager=True)
    kept = raw.where(F.col(S.CORRUPT_COL).isNull()).select("l_orderkey", "l_linenumber", F.lit(False).alias("rejected"),
                                                           "l_quantity")
    line = F.split(F.col(S.CORRUPT_COL), ",")
    rejects = raw.where(F.col(S.CORRUPT_COL).isNotNull()).select(
        line[0].cast("long").alias("l_orderkey"), line[1].cast("int").alias("l_linenumber"),
        F.lit(True).alias("rejected"), F.lit(None).cast("double").alias("l_quantity"))
    return kept.unionByName(rejects)


@register("schema_check_orders", """
  SELECT 'o_orderpriority' AS "column", 'string' AS expected, CAST(NULL AS VARCHAR) AS actual,
         'missing' AS problem, CAST(NULL AS BIGINT) AS bad_values
  UNION ALL SELECT 'o_totalprice', 'double', 'string', 'type',
         (SELECT count(*) FROM orders WHERE o_orderkey % 7 = 0)
  UNION ALL SELECT 'note', NULL, 'string', 'unexpected', NULL""")
def schema_check_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Signature of orders, checked against a drifted copy."""
    o = S.read_table(spark, sf, "orders")
    sig = schema_signature(o)
    drifted = (o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a"))
                            .otherwise(F.col("o_totalprice").cast("string")))
                .drop("o_orderpriority").withColumn("note", F.lit("x")))
    return check_schema(drifted, sig)
