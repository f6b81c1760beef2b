"""Registered metric queries (C1-C8) on rule-scored driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellwise.config import EV_CLASS_NAMES
from cellwise.operators import metrics as C
from cellwise.plans.catalog import SCORED_ORDERS_SQL, _round, register, scored_orders
from cellwise.sources.files import read_table

CELLS_SQL = f"""
  s AS ({SCORED_ORDERS_SQL}),
  cells AS (SELECT y, prediction AS yhat, count(*) AS n FROM s GROUP BY y, prediction),
  st AS (SELECT label, sum(tp) AS tp, sum(support) AS support, sum(predicted) AS predicted FROM (
           SELECT y AS label, CASE WHEN y = yhat THEN n ELSE 0 END AS tp, n AS support, 0 AS predicted FROM cells
           UNION ALL SELECT yhat, 0, 0, n FROM cells) u GROUP BY label),
  m AS (SELECT label, support, tp,
               CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS p,
               CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS r,
               CASE WHEN support + predicted = 0 THEN 0.0 ELSE 2.0 * tp / (support + predicted) END AS f
        FROM st)"""


@register("confusion_orders", f"""
  WITH {CELLS_SQL},
  labs AS (SELECT y AS label FROM cells UNION SELECT yhat FROM cells)
  SELECT a.label AS y, b.label AS yhat, CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM labs a CROSS JOIN labs b LEFT JOIN cells c ON c.y = a.label AND c.yhat = b.label""")
def confusion_orders(spark, sf):
    """C1 on the full 3x3 grid."""
    return C.confusion_matrix(scored_orders(spark, sf), "y", "prediction")


@register("prf_weighted_orders", f"""
  WITH {CELLS_SQL}
  SELECT round((SELECT avg(CASE WHEN y = prediction THEN 1.0 ELSE 0.0 END) FROM s), 6) AS accuracy,
         round(sum(p * support) / sum(support), 6) AS precision,
         round(sum(r * support) / sum(support), 6) AS recall,
         round(sum(f * support) / sum(support), 6) AS f1_score FROM m""")
def prf_weighted_orders(spark, sf):
    """C2 + C3 (support-weighted, three classes)."""
    s = scored_orders(spark, sf)
    out = C._zip(C.accuracy(s, "y", "prediction"), C.precision_recall_f1(s, "y", "prediction"))
    return _round(out, ["accuracy", "precision", "recall", "f1_score"])


@register("prf_binary_labels", """
  SELECT round(CASE WHEN sum(toxic) = 0 THEN 0.0 ELSE sum(quality * toxic) / sum(toxic) END, 6) AS precision,
         round(CASE WHEN sum(quality) = 0 THEN 0.0 ELSE sum(quality * toxic) / sum(quality) END, 6) AS recall,
         round(2.0 * sum(quality * toxic) / (sum(quality) + sum(toxic)), 6) AS f1_score
  FROM labels""")
def prf_binary_labels(spark, sf):
    """C3 binary (two classes in the truth -> positive label 1)."""
    lb = read_table(spark, sf, "labels")
    return _round(C.precision_recall_f1(lb, "quality", "toxic"), ["precision", "recall", "f1_score"])


@register("log_loss_orders", f"""
  SELECT round(-avg(ln(least(greatest(probability[y + 1], 2.220446049250313e-16), 1 - 2.220446049250313e-16))), 6) AS log_loss
  FROM ({SCORED_ORDERS_SQL}) s""")
def log_loss_orders(spark, sf):
    """C4."""
    return _round(C.log_loss(scored_orders(spark, sf), "y", "probability"), ["log_loss"])


BIN_SQL = """SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
                    round(o_totalprice / 10000.0) AS score, o_orderpriority FROM orders"""


@register("roc_auc_binary_orders", f"""
  WITH s AS ({BIN_SQL}),
  c AS (SELECT o_orderpriority, score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY o_orderpriority, score),
  r AS (SELECT o_orderpriority, pos, neg, coalesce(sum(neg) OVER (PARTITION BY o_orderpriority ORDER BY score
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum_neg FROM c)
  SELECT o_orderpriority, round(sum(pos * (cum_neg + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc
  FROM r GROUP BY o_orderpriority""")
def roc_auc_binary_orders(spark, sf):
    """C5 per priority group, with many tied scores."""
    o = read_table(spark, sf, "orders")
    s = o.select((F.col("o_orderstatus") == "F").cast("int").alias("y"),
                 F.round(F.col("o_totalprice") / 10000.0).alias("score"), "o_orderpriority")
    return _round(C.roc_auc(s, "y", "score", ["o_orderpriority"]), ["roc_auc"])


@register("classification_report_orders", f"""
  WITH {CELLS_SQL},
  t AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(p) AS mp, avg(r) AS mr, avg(f) AS mf,
               sum(p * support) AS wp, sum(r * support) AS wr, sum(f * support) AS wf FROM m)
  SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
         support FROM (
    SELECT CASE label WHEN 0 THEN 'Short' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Long' ELSE CAST(label AS VARCHAR) END AS label,
           p AS precision, r AS recall, f AS f1_score, CAST(support AS BIGINT) AS support FROM m
    UNION ALL SELECT 'accuracy', NULL, NULL, tp / n, CAST(n AS BIGINT) FROM t
    UNION ALL SELECT 'macro avg', mp, mr, mf, CAST(n AS BIGINT) FROM t
    UNION ALL SELECT 'weighted avg', wp / n, wr / n, wf / n, CAST(n AS BIGINT) FROM t) u""")
def classification_report_orders(spark, sf):
    """C7 with class names."""
    rep = C.classification_report(scored_orders(spark, sf), "y", "prediction", names=EV_CLASS_NAMES)
    return _round(rep, ["precision", "recall", "f1_score"])


@register("regression_metrics_lineitem", """
  SELECT l_returnflag,
         round(CASE WHEN var_pop(y) > 0 THEN 1 - avg((yhat - y) * (yhat - y)) / var_pop(y)
                    WHEN avg((yhat - y) * (yhat - y)) = 0 THEN 1.0 ELSE 0.0 END, 6) AS r2,
         round(avg(abs(yhat - y)), 6) AS mae, round(avg((yhat - y) * (yhat - y)), 6) AS mse
  FROM (SELECT l_returnflag, l_extendedprice / 1000.0 AS y, l_quantity * 0.95 + 1.0 AS yhat FROM lineitem) t
  GROUP BY l_returnflag""")
def regression_metrics_lineitem(spark, sf):
    """C8 per group (price in thousands vs a linear rule on quantity)."""
    li = read_table(spark, sf, "lineitem").select(
        "l_returnflag", (F.col("l_extendedprice") / 1000.0).alias("y"),
        (F.col("l_quantity") * 0.95 + 1.0).alias("yhat"))
    return _round(C.regression_metrics(li, "y", "yhat", ["l_returnflag"]), ["r2", "mae", "mse"])


@register("metric_row_orders", f"""
  WITH {CELLS_SQL},
  e AS (SELECT y, c.cls AS cls, probability[c.cls + 1] AS score FROM s, (SELECT unnest([0, 1, 2]) AS cls) c),
  pc AS (SELECT cls, score, sum(CASE WHEN y = cls THEN 1 ELSE 0 END) AS pos,
                sum(CASE WHEN y = cls THEN 0 ELSE 1 END) AS neg FROM e GROUP BY cls, score),
  rr AS (SELECT cls, pos, neg, coalesce(sum(neg) OVER (PARTITION BY cls ORDER BY score
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum_neg FROM pc),
  a AS (SELECT cls, sum(pos * (cum_neg + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc, sum(pos) AS p FROM rr GROUP BY cls)
  SELECT round((SELECT avg(CASE WHEN y = prediction THEN 1.0 ELSE 0.0 END) FROM s), 6) AS accuracy,
         round((SELECT sum(p * support) / sum(support) FROM m), 6) AS precision,
         round((SELECT sum(r * support) / sum(support) FROM m), 6) AS recall,
         round((SELECT sum(f * support) / sum(support) FROM m), 6) AS f1_score,
         (SELECT CAST(count(DISTINCT y) AS DOUBLE) FROM s) AS num_classes,
         round((SELECT -avg(ln(least(greatest(probability[y + 1], 2.220446049250313e-16), 1 - 2.220446049250313e-16))) FROM s), 6) AS log_loss,
         round((SELECT sum(auc * p) / sum(p) FROM a), 6) AS roc_auc""")
def metric_row_orders(spark, sf):
    """The per-run metric row (C2-C4, C6) in one frame."""
    out = C.classification_metrics(scored_orders(spark, sf), "y", "prediction", "probability")
    return _round(out, ["accuracy", "precision", "recall", "f1_score", "log_loss", "roc_auc"])
