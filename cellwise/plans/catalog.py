"""Registered queries over the driver tables, each with an equivalent SQL.

Operators are generic over column names, so each one is exercised on the
TPC-H-like driver tables: nulls and bad values are made by rule (the
tables have none), predictions and probabilities by formulas on real
columns.  Every query reads whole tables.  Floating results are rounded to
``R`` digits on both sides so summation order does not change the hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.operators import metrics as C
from cellwise.operators import prepare as P
from cellwise.operators import profile as A
from cellwise.operators.split import exact_split, hash_split
from cellwise.sources.files import read_table

R = 6  # rounding digits of floating outputs (both sides)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _round(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), R) for c in cols})


# ---------------------------------------------------------------------------
# lineitem as a raw "charging sessions" table: gaps and bad targets by rule
# ---------------------------------------------------------------------------

LI_RENAMES = {
    "l_orderkey": "order_key", "l_quantity": "quantity", "l_extendedprice": "price",
    "l_discount": "discount", "l_tax": "tax", "l_linestatus": "status", "l_class": "target_class",
}
LI_NUM = ["quantity", "price", "discount", "tax"]
LI_CAT = ["status"]
LI_TARGET = "target_class"
LI_SENTINELS = {"quantity": -1.0, "price": -1.0, "discount": -1.0, "tax": -1.0, "status": "Unknown"}

RAW_LINEITEM_SQL = """
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
         l_extendedprice,
         CASE WHEN l_linenumber % 7 = 0 THEN NULL ELSE l_discount END AS l_discount,
         l_tax,
         CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_linestatus END AS l_linestatus,
         CASE WHEN l_orderkey % 13 = 0 THEN '1.0'
              WHEN l_orderkey % 17 = 0 THEN NULL
              WHEN l_returnflag = 'A' THEN '0'
              WHEN l_returnflag = 'N' THEN '1'
              WHEN l_returnflag = 'R' THEN '2' END AS l_class
  FROM lineitem"""

PREPARED_SQL = f"""
  SELECT coalesce(l_quantity, -1.0) AS quantity, coalesce(l_extendedprice, -1.0) AS price,
         coalesce(l_discount, -1.0) AS discount, coalesce(l_tax, -1.0) AS tax,
         coalesce(l_linestatus, 'Unknown') AS status, TRY_CAST(l_class AS INTEGER) AS target_class,
         l_orderkey AS order_key, l_linenumber
  FROM ({RAW_LINEITEM_SQL}) raw WHERE l_class IN ('0', '1', '2')"""

SPLIT_SQL_EXPR = ("CASE WHEN ('0x' || substr(md5(concat_ws('|', '42', CAST({key} AS VARCHAR))), 1, 8))"
                  "::BIGINT % 10000 < 2000 THEN 'test' ELSE 'train' END")


def raw_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(n % 5 == 0, F.lit(None)).otherwise(F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        F.when(n % 7 == 0, F.lit(None)).otherwise(F.col("l_discount")).alias("l_discount"),
        "l_tax",
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("l_linestatus")).alias("l_linestatus"),
        F.when(k % 13 == 0, F.lit("1.0")).when(k % 17 == 0, F.lit(None).cast("string"))
         .when(F.col("l_returnflag") == "A", F.lit("0")).when(F.col("l_returnflag") == "N", F.lit("1"))
         .when(F.col("l_returnflag") == "R", F.lit("2")).alias("l_class"))


def prepared_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return P.clean_frame(raw_lineitem(spark, sf), LI_RENAMES, LI_SENTINELS, LI_TARGET,
                         ("0", "1", "2"), LI_NUM, LI_CAT, extra=["order_key", "l_linenumber"])


@register("clean_split_class_counts", f"""
  SELECT split, target_class, count(*) AS n, count(*) OVER (PARTITION BY split) AS n_classes
  FROM (SELECT target_class, {SPLIT_SQL_EXPR.format(key='order_key')} AS split FROM ({PREPARED_SQL}) p) s
  GROUP BY split, target_class""")
def clean_split_class_counts(spark, sf):
    """Flagship: P1-P6 -> SP1 -> A9."""
    split = hash_split(prepared_lineitem(spark, sf), ["order_key"], 0.2, 42)
    return A.class_counts(split, LI_TARGET, ["split"]).select("split", LI_TARGET, "n", "n_classes")


@register("prepared_rows", PREPARED_SQL)
def prepared_rows(spark, sf):
    """P1-P6 row by row."""
    return prepared_lineitem(spark, sf)


@register("describe_lineitem", """
  WITH v AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem),
  s AS (SELECT
    count(l_quantity) AS c1, avg(l_quantity) AS m1, stddev_samp(l_quantity) AS s1, min(l_quantity) AS n1, max(l_quantity) AS x1,
    quantile_cont(l_quantity, 0.25) AS a1, quantile_cont(l_quantity, 0.5) AS b1, quantile_cont(l_quantity, 0.75) AS d1,
    count(l_extendedprice) AS c2, avg(l_extendedprice) AS m2, stddev_samp(l_extendedprice) AS s2, min(l_extendedprice) AS n2, max(l_extendedprice) AS x2,
    quantile_cont(l_extendedprice, 0.25) AS a2, quantile_cont(l_extendedprice, 0.5) AS b2, quantile_cont(l_extendedprice, 0.75) AS d2,
    count(l_discount) AS c3, avg(l_discount) AS m3, stddev_samp(l_discount) AS s3, min(l_discount) AS n3, max(l_discount) AS x3,
    quantile_cont(l_discount, 0.25) AS a3, quantile_cont(l_discount, 0.5) AS b3, quantile_cont(l_discount, 0.75) AS d3,
    count(l_tax) AS c4, avg(l_tax) AS m4, stddev_samp(l_tax) AS s4, min(l_tax) AS n4, max(l_tax) AS x4,
    quantile_cont(l_tax, 0.25) AS a4, quantile_cont(l_tax, 0.5) AS b4, quantile_cont(l_tax, 0.75) AS d4,
    count(l_linenumber) AS c5, avg(l_linenumber) AS m5, stddev_samp(l_linenumber) AS s5, min(l_linenumber) AS n5, max(l_linenumber) AS x5,
    quantile_cont(l_linenumber, 0.25) AS a5, quantile_cont(l_linenumber, 0.5) AS b5, quantile_cont(l_linenumber, 0.75) AS d5
  FROM v)
  SELECT statistic, round(q1, 6) AS l_quantity, round(q2, 6) AS l_extendedprice, round(q3, 6) AS l_discount,
         round(q4, 6) AS l_tax, round(q5, 6) AS l_linenumber FROM (
    SELECT 'count' AS statistic, CAST(c1 AS DOUBLE) q1, CAST(c2 AS DOUBLE) q2, CAST(c3 AS DOUBLE) q3, CAST(c4 AS DOUBLE) q4, CAST(c5 AS DOUBLE) q5 FROM s
    UNION ALL SELECT 'mean', m1, m2, m3, m4, m5 FROM s
    UNION ALL SELECT 'std', s1, s2, s3, s4, s5 FROM s
    UNION ALL SELECT 'min', n1, n2, n3, n4, n5 FROM s
    UNION ALL SELECT '25%', a1, a2, a3, a4, a5 FROM s
    UNION ALL SELECT '50%', b1, b2, b3, b4, b5 FROM s
    UNION ALL SELECT '75%', d1, d2, d3, d4, d5 FROM s
    UNION ALL SELECT 'max', x1, x2, x3, x4, x5 FROM s) t""")
def describe_lineitem(spark, sf):
    """A2 with exact quantiles."""
    li = read_table(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return _round(A.describe(li, cols), cols)


ORDER_CODE_SQL = "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END"
# Positive scores per class, from price and key digits; normalised to probabilities.
PROBA_RAW_SQL = ("[1.0 + (o_totalprice / 100000.0) * ({c} = 0)::INT + (o_orderkey % 7) / 10.0, "
                 "1.0 + (o_totalprice / 100000.0) * ({c} = 1)::INT + (o_orderkey % 5) / 10.0, "
                 "1.0 + (o_totalprice / 100000.0) * ({c} = 2)::INT + (o_orderkey % 3) / 10.0]")


def scored_orders(spark: SparkSession, sf: str) -> DataFrame:
    """orders as a scored frame: y = status code, prediction = key % 3,
    probability = normalised positive scores (array indexed by class)."""
    o = read_table(spark, sf, "orders")
    y = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    price = F.col("o_totalprice") / F.lit(100000.0)
    raw = [F.lit(1.0) + price * (y == i).cast("int") + (F.col("o_orderkey") % m) / F.lit(10.0)
           for i, m in enumerate((7, 5, 3))]
    tot = raw[0] + raw[1] + raw[2]
    return o.select("o_orderkey", y.alias("y"), (F.col("o_orderkey") % 3).cast("int").alias("prediction"),
                    F.array(*[r / tot for r in raw]).alias("probability"))


SCORED_ORDERS_SQL = f"""
  SELECT o_orderkey, y, prediction,
         [r[1] / (r[1] + r[2] + r[3]), r[2] / (r[1] + r[2] + r[3]), r[3] / (r[1] + r[2] + r[3])] AS probability
  FROM (SELECT o_orderkey, {ORDER_CODE_SQL} AS y, CAST(o_orderkey % 3 AS INTEGER) AS prediction,
               {PROBA_RAW_SQL.format(c=ORDER_CODE_SQL)} AS r FROM orders) t"""


@register("roc_auc_ovr_orders", f"""
  WITH s AS ({SCORED_ORDERS_SQL}),
  e AS (SELECT y, c.cls AS cls, probability[c.cls + 1] AS score
        FROM s, (SELECT unnest([0, 1, 2]) AS cls) c),
  pc AS (SELECT cls, score, sum(CASE WHEN y = cls THEN 1 ELSE 0 END) AS pos,
                sum(CASE WHEN y = cls THEN 0 ELSE 1 END) AS neg FROM e GROUP BY cls, score),
  r AS (SELECT cls, pos, neg, coalesce(sum(neg) OVER (PARTITION BY cls ORDER BY score
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum_neg FROM pc),
  a AS (SELECT cls, sum(pos * (cum_neg + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc, sum(pos) AS p FROM r GROUP BY cls)
  SELECT round(sum(auc * p) / sum(p), 6) AS roc_auc FROM a""")
def roc_auc_ovr_orders(spark, sf):
    """C6 on orders."""
    return _round(C.roc_auc_ovr(scored_orders(spark, sf), "y", "probability"), ["roc_auc"])


# ---------------------------------------------------------------------------
# Casts, flags, labels, preview
# ---------------------------------------------------------------------------

@register("cast_features_lineitem", """
  SELECT TRY_CAST(qty AS DOUBLE) AS quantity, TRY_CAST(price AS DOUBLE) AS price,
         TRY_CAST(line AS BIGINT) AS line, flag AS flag,
         (qty IS NOT NULL AND TRY_CAST(qty AS DOUBLE) IS NULL)
           OR (price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL)
           OR (line IS NOT NULL AND TRY_CAST(line AS BIGINT) IS NULL) AS _rejected
  FROM (SELECT CASE WHEN l_orderkey % 19 = 0 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS qty,
               CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_extendedprice AS VARCHAR) END AS price,
               CASE WHEN l_orderkey % 23 = 0 THEN 'seven' ELSE CAST(l_linenumber AS VARCHAR) END AS line,
               l_returnflag AS flag FROM lineitem) t""")
def cast_features_lineitem(spark, sf):
    """Strict select + try_cast with a rejection flag (text in numeric fields)."""
    li = read_table(spark, sf, "lineitem")
    k = F.col("l_orderkey")
    raw = li.select(
        F.when(k % 19 == 0, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")).alias("qty"),
        F.when(F.col("l_linenumber") == 3, F.lit(None).cast("string"))
         .otherwise(F.col("l_extendedprice").cast("string")).alias("price"),
        F.when(k % 23 == 0, F.lit("seven")).otherwise(F.col("l_linenumber").cast("string")).alias("line"),
        F.col("l_returnflag").alias("flag"))
    out = P.cast_features(raw, {"qty": "double", "price": "double", "line": "bigint", "flag": "string"})
    return out.withColumnRenamed("qty", "quantity")


@register("order_flags_labels", f"""
  SELECT o_orderkey, o_orderstatus = 'F' AS is_final,
         CAST(({ORDER_CODE_SQL}) AS INTEGER) AS class_code,
         CASE {ORDER_CODE_SQL} WHEN 0 THEN 'Short' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Long' END AS class_name,
         CAST(trunc(o_totalprice) AS INTEGER) AS price_int
  FROM orders""")
def order_flags_labels(spark, sf):
    """P9 flag, P12 code -> text, P10 int cast, P7 drop."""
    from cellwise.config import EV_CLASS_NAMES

    o = read_table(spark, sf, "orders")
    code = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    x = P.to_flag(o, "o_orderstatus", "F", out="is_final").withColumn("class_code", code.cast("int"))
    x = P.label_text(x, "class_code", EV_CLASS_NAMES, out="class_name")
    x = P.to_int_matrix(x.withColumn("price_int", F.col("o_totalprice")), ["price_int"])
    x = P.drop_columns(x, ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    return x


@register("label_text_labels", """
  SELECT doc_id, CASE WHEN quality = 1 THEN 'alive' ELSE 'dead' END AS quality_label FROM labels""")
def label_text_labels(spark, sf):
    """P12 with a default: 1 -> 'alive', anything else -> 'dead'."""
    from cellwise.config import ALIVE_DEFAULT, ALIVE_NAMES

    lb = read_table(spark, sf, "labels")
    return P.label_text(lb, "quality", ALIVE_NAMES, ALIVE_DEFAULT, out="quality_label").select(
        "doc_id", "quality_label")


@register("preview_orders", """
  SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10""")
def preview_orders(spark, sf):
    """First 10 rows in key order (top-k, no global sort)."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return P.preview(o, 10, ["o_orderkey"])


# ---------------------------------------------------------------------------
# A1, A3-A8, K1
# ---------------------------------------------------------------------------

@register("shape_lineitem", "SELECT count(*) AS rows, CAST(11 AS INTEGER) AS columns FROM lineitem")
def shape_lineitem(spark, sf):
    """A1."""
    return A.shape(read_table(spark, sf, "lineitem"))


@register("column_info_orders", """
  SELECT * FROM (VALUES
    (0, 'o_orderkey', (SELECT count(o_orderkey) FROM orders), 'bigint'),
    (1, 'o_custkey', (SELECT count(o_custkey) FROM orders), 'bigint'),
    (2, 'o_orderstatus', (SELECT count(o_orderstatus) FROM orders), 'string'),
    (3, 'o_totalprice', (SELECT count(o_totalprice) FROM orders), 'double'),
    (4, 'o_orderdate', (SELECT count(o_orderdate) FROM orders), 'timestamp_ntz'),
    (5, 'o_orderpriority', (SELECT count(o_orderpriority) FROM orders), 'string'))
    AS t(position, "column", non_null, dtype)""")
def column_info_orders(spark, sf):
    """A3: position, name, non-null count, type."""
    return A.column_info(read_table(spark, sf, "orders"))


@register("null_counts_raw_lineitem", f"""
  SELECT "column", nulls FROM (
    SELECT 'l_orderkey' AS "column", count(*) FILTER (WHERE l_orderkey IS NULL) AS nulls FROM ({RAW_LINEITEM_SQL}) r
    UNION ALL SELECT 'l_linenumber', count(*) FILTER (WHERE l_linenumber IS NULL) FROM ({RAW_LINEITEM_SQL}) r
    UNION ALL SELECT 'l_quantity', count(*) FILTER (WHERE l_quantity IS NULL OR isnan(l_quantity)) FROM ({RAW_LINEITEM_SQL}) r
    UNION ALL SELECT 'l_extendedprice', count(*) FILTER (WHERE l_extendedprice IS NULL OR isnan(l_extendedprice)) FROM ({RAW_LINEITEM_SQL}) r
    UNION ALL SELECT 'l_discount', count(*) FILTER (WHERE l_discount IS NULL OR isnan(l_discount)) FROM ({RAW_LINEITEM_SQL}) r
    UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE l_tax IS NULL OR isnan(l_tax)) FROM ({RAW_LINEITEM_SQL}) r
    UNION ALL SELECT 'l_linestatus', count(*) FILTER (WHERE l_linestatus IS NULL) FROM ({RAW_LINEITEM_SQL}) r
    UNION ALL SELECT 'l_class', count(*) FILTER (WHERE l_class IS NULL) FROM ({RAW_LINEITEM_SQL}) r) t""")
def null_counts_raw_lineitem(spark, sf):
    """A4 on the rule-made gaps."""
    return A.null_counts(raw_lineitem(spark, sf))


@register("distinct_values_part", """
  SELECT DISTINCT 'p_brand' AS "column", p_brand AS value FROM part
  UNION ALL SELECT DISTINCT 'p_type', p_type FROM part""")
def distinct_values_part(spark, sf):
    """A5: distinct values of the string columns except the name."""
    return A.distinct_values(read_table(spark, sf, "part"), exclude=["p_name"])


@register("mean_curve_lineitem", """
  SELECT l_quantity, round(avg(l_extendedprice), 6) AS mean, round(stddev_samp(l_extendedprice), 6) AS std,
         count(*) AS n,
         round(avg(l_extendedprice) - 1.96 * stddev_samp(l_extendedprice) / sqrt(count(*)), 6) AS ci_low,
         round(avg(l_extendedprice) + 1.96 * stddev_samp(l_extendedprice) / sqrt(count(*)), 6) AS ci_high
  FROM lineitem GROUP BY l_quantity""")
def mean_curve_lineitem(spark, sf):
    """Mean price per quantity with a 95 % interval."""
    out = A.mean_curve(read_table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return _round(out, ["mean", "std", "ci_low", "ci_high"])


def _bootstrap_sql(table: str, x: str, y: str) -> str:
    """Count-collapsed Poisson bootstrap, 1000 replicates: the hash of (x, y)
    and the replicate is a uniform number, Poisson(n) its inverse; the
    distribution's table is summed from its terms (0 is the first at n = 0)."""
    mix = """xor(h{0}, h{0} >> 16) AS a{0}, (a{0} * 2246822507::UBIGINT) % 4294967296 AS b{0}, xor(b{0}, b{0} >> 13) AS c{0},
           (c{0} * 3266489909::UBIGINT) % 4294967296 AS d{0}, xor(d{0}, d{0} >> 16) AS e{0}"""
    return f"""
  WITH RECURSIVE rows AS (
    SELECT {x} AS x, {y} AS y, count(*) AS n, md5(concat_ws('|', '0', coalesce({x}::VARCHAR, ''), coalesce({y}::VARCHAR, ''))) AS m
    FROM {table} WHERE {y} IS NOT NULL GROUP BY 1, 2),
  terms AS (
    SELECT DISTINCT n, 0 AS k, exp(-n::DOUBLE) AS p, exp(-n::DOUBLE) AS below FROM rows
    UNION ALL SELECT n, k + 1, p * n / (k + 1), below + p * n / (k + 1) FROM terms WHERE k < n + 40),
  tables AS (SELECT n, list(below ORDER BY k) AS t FROM terms GROUP BY n),
  halves AS (SELECT x, y, t, ('0x' || substr(m, 1, 8))::UBIGINT AS high, ('0x' || substr(m, 9, 8))::UBIGINT AS low
             FROM rows JOIN tables USING (n)),
  draws AS (
    SELECT x, y, b, t, (b::UBIGINT * 2654435769::UBIGINT + high) % 4294967296 AS h1, {mix.format(1)},
           xor(e1, low) AS h2, {mix.format(2)}, e2 / 4294967296.0 AS u
    FROM halves, range(1, 1001) r(b)),
  weights AS (SELECT x, y, b, CASE WHEN u < t[1] THEN 0 WHEN u < t[2] THEN 1 WHEN u < t[3] THEN 2 WHEN u < t[4] THEN 3 WHEN u < t[5] THEN 4
    ELSE len(list_filter(t, lambda q: q <= u)) END AS w FROM draws),
  means AS (SELECT x, b, sum(w * y) / nullif(sum(w), 0) AS m FROM weights GROUP BY x, b)
  SELECT x AS {x}, round(quantile_cont(m, 0.025), 4) AS ci_low, round(quantile_cont(m, 0.975), 4) AS ci_high
  FROM means GROUP BY x"""


def _rounded_interval(out, x):
    return out.select(x, F.round("ci_low", 4).alias("ci_low"), F.round("ci_high", 4).alias("ci_high"))


@register("mean_curve_bootstrap_lineitem", _bootstrap_sql("lineitem", "l_quantity", "l_extendedprice"))
def mean_curve_bootstrap_lineitem(spark, sf):
    """A7 bootstrap interval of the price per quantity, 1000 replicates."""
    return _rounded_interval(A.mean_curve_bootstrap(read_table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"),
                             "l_quantity")


@register("mean_curve_bootstrap_customer", _bootstrap_sql("customer", "c_nationkey", "c_acctbal"))
def mean_curve_bootstrap_customer(spark, sf):
    """A7 bootstrap interval of the balance per nation, 1000 replicates."""
    return _rounded_interval(A.mean_curve_bootstrap(read_table(spark, sf, "customer"), "c_nationkey", "c_acctbal"),
                             "c_nationkey")


@register("mean_curve_bootstrap_part", _bootstrap_sql("part", "p_brand", "p_size"))
def mean_curve_bootstrap_part(spark, sf):
    """A7 bootstrap interval of the size per brand: few values, many copies."""
    return _rounded_interval(A.mean_curve_bootstrap(read_table(spark, sf, "part"), "p_brand", "p_size"), "p_brand")


@register("scatter_points_part", "SELECT p_size, p_retailprice, p_type FROM part")
def scatter_points_part(spark, sf):
    """(size, price, type) of every part."""
    return A.scatter_points(read_table(spark, sf, "part"), "p_size", "p_retailprice", "p_type")


@register("last_events", """
  SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 100""")
def last_events(spark, sf):
    """K1: newest 100 events (TakeOrderedAndProject)."""
    ev = read_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return A.last_rows(ev, 100, "ts", ["event_id"])


# ---------------------------------------------------------------------------
# SP1, SP2
# ---------------------------------------------------------------------------

@register("hash_split_orders", f"""
  SELECT o_orderkey, {SPLIT_SQL_EXPR.format(key='o_orderkey')} AS split FROM orders""")
def hash_split_orders(spark, sf):
    """SP1 on orders."""
    return hash_split(read_table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 0.2, 42)


@register("exact_split_sizes_lineitem", """
  SELECT 'test' AS split, CAST(ceil(count(*) * 0.2) AS BIGINT) AS n FROM lineitem
  UNION ALL SELECT 'train', count(*) - CAST(ceil(count(*) * 0.2) AS BIGINT) FROM lineitem""")
def exact_split_sizes_lineitem(spark, sf):
    """SP2 on rows that repeat (seven line numbers, 17 keys) with a third of
    the keys null: the sizes are exact."""
    k = F.col("l_orderkey")
    li = read_table(spark, sf, "lineitem").select(F.when(k % 3 != 0, k % 17).alias("key"), "l_linenumber")
    return exact_split(li, ["key"], 0.2, 42).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("exact_split_orders", """
  SELECT o_orderkey, CASE WHEN rn <= (SELECT ceil(count(*) * 0.2) FROM orders) THEN 'test' ELSE 'train' END AS split
  FROM (SELECT o_orderkey, row_number() OVER (ORDER BY
          ('0x' || substr(md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), 1, 8))::BIGINT, o_orderkey) AS rn
        FROM orders) t""")
def exact_split_orders(spark, sf):
    """SP2: exactly ceil(0.2 n) orders in test."""
    return exact_split(read_table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 0.2, 42)


# ---------------------------------------------------------------------------
# E1-E3 (fit on the SP1 train side of part, apply to every row)
# ---------------------------------------------------------------------------

def _part_fit_apply(spark, sf):
    part = read_table(spark, sf, "part")
    fit_rows = hash_split(part, ["p_partkey"], 0.2, 42).where(F.col("split") == "train")
    # Unseen categories at apply time, made by rule.
    apply_rows = part.withColumn(
        "p_brand", F.when(F.col("p_partkey") % 50 == 0, F.lit("Brand#99")).otherwise(F.col("p_brand")))
    return fit_rows, apply_rows


@register("ordinal_dictionary_part", """
  SELECT "column", category, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY category) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT 'p_type' AS "column", p_type AS category FROM part WHERE CASE WHEN ('0x' || substr(md5(concat_ws('|', '42', CAST(p_partkey AS VARCHAR))), 1, 8))::BIGINT % 10000 < 2000 THEN 'test' ELSE 'train' END = 'train'
        UNION SELECT DISTINCT 'p_brand', p_brand FROM part WHERE CASE WHEN ('0x' || substr(md5(concat_ws('|', '42', CAST(p_partkey AS VARCHAR))), 1, 8))::BIGINT % 10000 < 2000 THEN 'test' ELSE 'train' END = 'train') t""")
def ordinal_dictionary_part(spark, sf):
    """E1."""
    from cellwise.operators.encode import fit_ordinal

    fit_rows, _ = _part_fit_apply(spark, sf)
    return fit_ordinal(fit_rows, ["p_type", "p_brand"])


@register("ordinal_apply_part", """
  WITH d AS (SELECT "column", category, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY category) - 1 AS INTEGER) AS code
             FROM (SELECT DISTINCT 'p_type' AS "column", p_type AS category FROM part WHERE CASE WHEN ('0x' || substr(md5(concat_ws('|', '42', CAST(p_partkey AS VARCHAR))), 1, 8))::BIGINT % 10000 < 2000 THEN 'test' ELSE 'train' END = 'train'
                   UNION SELECT DISTINCT 'p_brand', p_brand FROM part WHERE CASE WHEN ('0x' || substr(md5(concat_ws('|', '42', CAST(p_partkey AS VARCHAR))), 1, 8))::BIGINT % 10000 < 2000 THEN 'test' ELSE 'train' END = 'train') t),
  a AS (SELECT p_partkey, p_type, CASE WHEN p_partkey % 50 = 0 THEN 'Brand#99' ELSE p_brand END AS p_brand FROM part)
  SELECT a.p_partkey, coalesce(dt.code, -1) AS p_type_code, coalesce(db.code, -1) AS p_brand_code
  FROM a LEFT JOIN d dt ON dt."column" = 'p_type' AND dt.category = a.p_type
         LEFT JOIN d db ON db."column" = 'p_brand' AND db.category = a.p_brand""")
def ordinal_apply_part(spark, sf):
    """Unknown -> -1 (map literal, no join)."""
    from cellwise.operators.encode import apply_ordinal, fit_ordinal

    fit_rows, apply_rows = _part_fit_apply(spark, sf)
    d = fit_ordinal(fit_rows, ["p_type", "p_brand"])
    out = apply_ordinal(apply_rows, d, ["p_type", "p_brand"], suffix="_code")
    return out.select("p_partkey", "p_type_code", "p_brand_code")


@register("ordinal_apply_join_part", """
  WITH d AS (SELECT "column", category, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY category) - 1 AS INTEGER) AS code
             FROM (SELECT DISTINCT 'p_type' AS "column", p_type AS category FROM part WHERE CASE WHEN ('0x' || substr(md5(concat_ws('|', '42', CAST(p_partkey AS VARCHAR))), 1, 8))::BIGINT % 10000 < 2000 THEN 'test' ELSE 'train' END = 'train'
                   UNION SELECT DISTINCT 'p_brand', p_brand FROM part WHERE CASE WHEN ('0x' || substr(md5(concat_ws('|', '42', CAST(p_partkey AS VARCHAR))), 1, 8))::BIGINT % 10000 < 2000 THEN 'test' ELSE 'train' END = 'train') t),
  a AS (SELECT p_partkey, p_type, CASE WHEN p_partkey % 50 = 0 THEN 'Brand#99' ELSE p_brand END AS p_brand FROM part)
  SELECT a.p_partkey, coalesce(dt.code, -1) AS p_type_code, coalesce(db.code, -1) AS p_brand_code
  FROM a LEFT JOIN d dt ON dt."column" = 'p_type' AND dt.category = a.p_type
         LEFT JOIN d db ON db."column" = 'p_brand' AND db.category = a.p_brand""")
def ordinal_apply_join_part(spark, sf):
    """E2, join form (used when the dictionary is too large for a map literal)."""
    from cellwise.operators.encode import apply_ordinal, fit_ordinal

    fit_rows, apply_rows = _part_fit_apply(spark, sf)
    d = fit_ordinal(fit_rows, ["p_type", "p_brand"])
    out = apply_ordinal(apply_rows, d, ["p_type", "p_brand"], suffix="_code", mode="join")
    return out.select("p_partkey", "p_type_code", "p_brand_code")


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]  # p_type values (all in train)


@register("one_hot_part", "SELECT " + ", ".join(
    [f"CAST(CASE WHEN p_type = '{t}' THEN 1 ELSE 0 END AS INTEGER) AS one_hot__p_type_{t}" for t in _TYPES[1:]]
    + ["p_partkey AS remainder__p_partkey", "p_size AS remainder__p_size"]) + " FROM part")
def one_hot_part(spark, sf):
    """First category dropped, unknown -> zeros, remainder passthrough."""
    from cellwise.operators.encode import fit_ordinal, one_hot

    fit_rows, _ = _part_fit_apply(spark, sf)
    d = fit_ordinal(fit_rows, ["p_type"])
    part = read_table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    return one_hot(part, d, ["p_type"])


@register("one_hot_vector_part", """
  WITH cats AS (SELECT list(DISTINCT p_brand ORDER BY p_brand) AS l FROM part
                WHERE """ + SPLIT_SQL_EXPR.format(key="p_partkey") + """ = 'train'),
  a AS (SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN 'Brand#99' ELSE p_brand END AS p_brand FROM part)
  SELECT a.p_partkey, [CASE WHEN a.p_brand = b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FOR b IN cats.l[2:]] AS brand_vec
  FROM a, cats""")
def one_hot_vector_part(spark, sf):
    """E3 vector form (sparse vector, shown as an array): first brand
    dropped, unknown brand -> all zeros."""
    from pyspark.ml.functions import vector_to_array

    from cellwise.operators.encode import fit_ordinal, one_hot_vector

    fit_rows, apply_rows = _part_fit_apply(spark, sf)
    d = fit_ordinal(fit_rows, ["p_brand"])
    out = one_hot_vector(apply_rows.select("p_partkey", "p_brand"), d, "p_brand", out="_v")
    return out.select("p_partkey", vector_to_array("_v").alias("brand_vec"))
