"""Evaluation metrics as DataFrame aggregates.

Every metric is one pass over the scored rows (partial aggregation), then
arithmetic on at most classes^2 rows.  ``group_cols`` evaluates many models
or runs at once (one result row per group).  AUC is exact: scores are
pre-aggregated to distinct values and ranked with ``running_totals`` (range
buckets, no single-partition sort).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellwise.config import LOG_LOSS_EPS
from cellwise.functions.expr import dict_lookup
from cellwise.functions.ranges import running_totals


def _gw(group_cols: Sequence[str]) -> Window:
    return Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))


def _safe_div(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (the zero-division rule of the metrics)."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_counts(df: DataFrame, y: str, yhat: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Non-zero cells (group, y, yhat, n): the one shuffle every metric shares."""
    return df.groupBy(*group_cols, F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str, yhat: str, group_cols: Sequence[str] = (),
                     labels: Sequence | None = None) -> DataFrame:
    """The full label grid (y, yhat, n) with zero cells, per group.

    Labels are the sorted union of truth and prediction values (or given);
    the grid is built from the aggregated cells (classes^2 rows per group).
    """
    cells = confusion_counts(df, y, yhat, group_cols)
    if labels is None:
        labs = (cells.select(*group_cols, F.col("y").alias("label"))
                .unionByName(cells.select(*group_cols, F.col("yhat").alias("label")))
                .where(F.col("label").isNotNull()))
        # One array of labels per group (bounded by the number of classes).
        sets = labs.groupBy(*group_cols).agg(F.array_sort(F.collect_set("label")).alias("_labs"))
    else:
        lit_arr = F.array(*[F.lit(v) for v in labels])
        sets = (cells.select(*group_cols).distinct() if group_cols
                else df.sparkSession.range(1)).select(*group_cols, lit_arr.alias("_labs"))
    grid = (sets.select(*group_cols, F.explode("_labs").alias("y"), "_labs")
                .select(*group_cols, "y", F.explode("_labs").alias("yhat")))
    return (grid.join(cells, on=[*group_cols, "y", "yhat"], how="left")
                .select(*group_cols, "y", "yhat", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def accuracy(df: DataFrame, y: str, yhat: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """C2."""
    hit = (F.col(y) == F.col(yhat)).cast("double")
    return df.groupBy(*group_cols).agg(F.avg(hit).alias("accuracy"))


def per_class_stats(df: DataFrame, y: str, yhat: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per (group, class): tp, fp, fn, support, precision, recall, f1."""
    return stats_from_cells(confusion_counts(df, y, yhat, group_cols), group_cols)


def stats_from_cells(cells: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per-class stats from aggregated cells (group, y, yhat, n): every cell
    counts once for its true label (support, tp) and once for its predicted
    label; one small aggregate, no joins."""
    both = F.explode(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"),
                 F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(F.lit(0)).alias("tp"),
                 F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("yhat").alias("label"), F.lit(0).cast("long").alias("support"),
                 F.lit(0).cast("long").alias("tp"), F.col("n").alias("predicted"))))
    k = [*group_cols, "label"]
    s = (cells.select(*group_cols, both.alias("_c")).select(*group_cols, "_c.*")
              .where(F.col("label").isNotNull())
              .groupBy(*k).agg(*[F.sum(c).cast("long").alias(c) for c in ("tp", "support", "predicted")]))
    p = _safe_div(F.col("tp"), F.col("predicted"))
    r = _safe_div(F.col("tp"), F.col("support"))
    f1 = _safe_div(2 * F.col("tp"), F.col("support") + F.col("predicted"))
    return s.select(*k, "tp", (F.col("predicted") - F.col("tp")).alias("fp"),
                    (F.col("support") - F.col("tp")).alias("fn"), "support",
                    p.alias("precision"), r.alias("recall"), f1.alias("f1_score"))


def _average(st: DataFrame, group_cols: Sequence[str], average: str = "auto", pos_label=1) -> DataFrame:
    """Average per-class stats: binary / weighted / macro (auto = binary for
    two truth classes, else weighted)."""
    w = _gw(group_cols)
    st = st.withColumn("_ncls", F.count_if(F.col("support") > 0).over(w)) \
           .withColumn("_nlab", F.count(F.lit(1)).over(w)) \
           .withColumn("_tot", F.sum("support").over(w))
    is_pos = F.col("label") == F.lit(pos_label)
    binary = (F.col("_ncls") == 2) if average == "auto" else F.lit(average == "binary")
    weight = (F.when(binary, F.when(is_pos, 1.0).otherwise(0.0))
              .otherwise(F.lit(1.0) / F.col("_nlab") if average == "macro"
                         else F.col("support") / F.col("_tot")))
    return st.groupBy(*group_cols).agg(
        *[F.sum(weight * F.col(m)).alias(m) for m in ("precision", "recall", "f1_score")])


def precision_recall_f1(df: DataFrame, y: str, yhat: str, group_cols: Sequence[str] = (),
                        average: str = "auto", pos_label=1) -> DataFrame:
    """Precision, recall, f1_score per group.

    ``auto``: binary (positive label ``pos_label``) when the truth has two
    classes, else support-weighted; also 'binary', 'weighted', 'macro'.
    """
    return _average(per_class_stats(df, y, yhat, group_cols), group_cols, average, pos_label)


def _true_class(y: str, proba: str) -> tuple[Column, Column]:
    """Probability of the true class, and whether the label is covered."""
    code = F.col(y).cast("int")
    return F.get(F.col(proba), code), F.coalesce((code >= 0) & (code < F.size(proba)), F.lit(True))


def log_loss(df: DataFrame, y: str, proba: str, group_cols: Sequence[str] = (),
             eps: float = LOG_LOSS_EPS) -> DataFrame:
    """C4: mean negative log probability of the true class (clipped).

    ``proba`` is array<double> indexed by class code.  Null if a truth label
    lies beyond it; rows without label or probabilities are left out.
    """
    p, covered = _true_class(y, proba)
    clipped = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    return df.groupBy(*group_cols).agg(
        F.when(F.count_if(~covered) == 0, -F.avg(F.ln(clipped))).alias("log_loss"))


def _auc_from_counts(counts: DataFrame, group_cols: Sequence[str], score: str,
                     n_buckets: int | None) -> DataFrame:
    """(group, score, pos, neg) distinct-score counts -> (group, auc, P, N)."""
    ranked = running_totals(counts, list(group_cols), [score], ["neg"], n_buckets=n_buckets)
    num = F.col("pos") * (F.col("cum_neg") + F.col("neg") / F.lit(2.0))
    agg = ranked.groupBy(*group_cols).agg(
        F.sum(num).alias("_num"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0),
                 F.col("_num") / (F.col("P").cast("double") * F.col("N")))
    return agg.select(*group_cols, auc.alias("roc_auc"), "P", "N")


def roc_auc(df: DataFrame, y: str, score: str, group_cols: Sequence[str] = (), pos_label=1,
            n_buckets: int | None = None) -> DataFrame:
    """Binary ROC AUC (ties count one half). Null with one class only."""
    pos = (F.col(y) == F.lit(pos_label)).cast("long")
    counts = df.where(F.col(score).isNotNull()).groupBy(*group_cols, score).agg(
        F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg"))
    return _auc_from_counts(counts, group_cols, score, n_buckets).select(*group_cols, "roc_auc")


def _auc_per_class(df: DataFrame, y: str, proba: str, group_cols: Sequence[str],
                   n_buckets: int | None = None) -> DataFrame:
    """(group, _cls, roc_auc, P, N) for the classes present in the truth.

    A truth label that the probabilities do not cover counts as class -1,
    whose AUC is undefined (null)."""
    scores = F.transform(proba, lambda s, i: F.struct(i.alias("cls"), s.alias("s")))
    outside = F.col(y).isNotNull() & ((F.col(y) < 0) | (F.col(y) >= F.size(proba)))
    stray = F.when(outside, F.array(F.struct(F.lit(-1).alias("cls"), F.lit(0.0).alias("s")))).otherwise(
        F.array().cast("array<struct<cls:int,s:double>>"))
    ex = (df.select(*group_cols, F.col(y).alias("_y"), F.explode(F.concat(scores, stray)).alias("_e"))
          .select(*group_cols, "_y", F.col("_e.cls").alias("_cls"), F.col("_e.s").alias("_s"))
          .where(F.col("_s").isNotNull()))
    pos = ((F.col("_y") == F.col("_cls")) | (F.col("_cls") == -1)).cast("long")
    counts = ex.groupBy(*group_cols, "_cls", "_s").agg(
        F.sum(pos).alias("pos"), F.sum(1 - pos).alias("neg"))
    per = _auc_from_counts(counts, [*group_cols, "_cls"], "_s", n_buckets)
    return per.where(F.col("P") > 0)


def roc_auc_ovr(df: DataFrame, y: str, proba: str, group_cols: Sequence[str] = (),
                average: str = "weighted", n_buckets: int | None = None) -> DataFrame:
    """One-vs-rest AUC per class of the truth, averaged by class share
    (``weighted``) or plainly (``macro``). Null when any class AUC is undefined,
    also when a truth label lies beyond the probabilities; null scores are
    left out."""
    present = _auc_per_class(df, y, proba, group_cols, n_buckets)
    wt = F.col("P") if average == "weighted" else F.lit(1.0)
    out = present.groupBy(*group_cols).agg(
        (F.sum(wt * F.col("roc_auc")) / F.sum(wt)).alias("roc_auc"),
        F.count_if(F.col("roc_auc").isNull()).alias("_undef"))
    return out.select(*group_cols, F.when(F.col("_undef") == 0, F.col("roc_auc")).alias("roc_auc"))


def classification_report(df: DataFrame, y: str, yhat: str, group_cols: Sequence[str] = (),
                          names: Mapping | None = None) -> DataFrame:
    """Per class precision, recall, f1_score, support, then rows
    'accuracy', 'macro avg', 'weighted avg' (accuracy: f1_score column)."""
    st = per_class_stats(df, y, yhat, group_cols)
    label = (dict_lookup(F.col("label"), names, None) if names else None)
    lab = F.coalesce(label, F.col("label").cast("string")) if names else F.col("label").cast("string")
    per = st.select(*group_cols, lab.alias("label"), "precision", "recall", "f1_score",
                    F.col("support").cast("long").alias("support"), F.lit(0).alias("_ord"),
                    F.col("label").cast("string").alias("_key"))
    tot = st.groupBy(*group_cols).agg(
        F.sum("support").alias("_n"), F.sum("tp").alias("_tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("wf"))
    acc = tot.select(*group_cols, F.lit("accuracy").alias("label"),
                     F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"),
                     (F.col("_tp") / F.col("_n")).alias("f1_score"),
                     F.col("_n").cast("long").alias("support"), F.lit(1).alias("_ord"),
                     F.lit("").alias("_key"))
    mac = tot.select(*group_cols, F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                     F.col("mr").alias("recall"), F.col("mf").alias("f1_score"),
                     F.col("_n").cast("long").alias("support"), F.lit(2).alias("_ord"),
                     F.lit("").alias("_key"))
    wei = tot.select(*group_cols, F.lit("weighted avg").alias("label"),
                     (F.col("wp") / F.col("_n")).alias("precision"),
                     (F.col("wr") / F.col("_n")).alias("recall"),
                     (F.col("wf") / F.col("_n")).alias("f1_score"),
                     F.col("_n").cast("long").alias("support"), F.lit(3).alias("_ord"),
                     F.lit("").alias("_key"))
    return per.unionByName(acc).unionByName(mac).unionByName(wei).drop("_ord", "_key")


def regression_metrics(df: DataFrame, y: str, yhat: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """r2, mae, mse per group (r2 of a constant target: 1 if exact, else 0)."""
    e = F.col(yhat) - F.col(y)
    g = df.groupBy(*group_cols).agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.var_pop(y).alias("_vy"), F.count(F.lit(1)).alias("_n"))
    r2 = (F.when(F.col("_vy") > 0, F.lit(1.0) - F.col("mse") / F.col("_vy"))
           .when(F.col("mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return g.select(*group_cols, r2.alias("r2"), "mae", "mse")


def classification_metrics(df: DataFrame, y: str, yhat: str, proba: str | None = None,
                           group_cols: Sequence[str] = (), eps: float = LOG_LOSS_EPS) -> DataFrame:
    """The metric row logged per run: accuracy, precision, recall, f1_score,
    num_classes, log_loss, roc_auc.

    Two passes over the scored rows: one aggregate to (y, yhat) cells that
    also carries the log-loss sums (accuracy, P/R/F1, class count and log
    loss all follow from these k^2 rows), and the per-class AUC counts.
    With two classes roc_auc is the AUC of class 1's score, else the
    one-vs-rest average weighted by class share.
    """
    g = list(group_cols)
    aggs = [F.count(F.lit(1)).alias("n")]
    if proba:
        p, covered = _true_class(y, proba)
        aggs += [F.sum(-F.ln(F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps)))).alias("_ll"),
                 F.count(p).alias("_pn"), F.count_if(~covered).alias("_stray")]
    cells = df.groupBy(*g, F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(*aggs)
    st = stats_from_cells(cells, g)
    prf = _average(st, g)
    tot = cells.groupBy(*g).agg(
        (F.sum(F.when(F.col("y") == F.col("yhat"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"),
        F.count_distinct("y").cast("double").alias("num_classes"),
        *([F.when(F.sum("_stray") == 0, F.try_divide(F.sum("_ll"), F.sum("_pn"))).alias("log_loss")] if proba else []))
    out = tot.join(prf, g, "full") if g else _zip(tot, prf)
    cols = [*g, "accuracy", "precision", "recall", "f1_score", "num_classes"]
    if proba:
        per = _auc_per_class(df, y, proba, g)
        auc = per.groupBy(*g).agg(
            (F.sum(F.col("P") * F.col("roc_auc")) / F.sum("P")).alias("_ovr"),
            F.count_if(F.col("roc_auc").isNull()).alias("_undef"),
            F.max(F.when(F.col("_cls") == 1, F.col("roc_auc"))).alias("_bin"))
        out = out.join(auc, g, "left") if g else _zip(out, auc)
        roc = F.when(F.col("num_classes") == 2, F.col("_bin")).when(F.col("_undef") == 0, F.col("_ovr"))
        out = out.withColumn("roc_auc", roc)
        cols += ["log_loss", "roc_auc"]
    return out.select(*cols)


def _zip(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side by side two one-row aggregates (no join: a union of the two rows,
    each padded with nulls, folded by one global aggregate)."""
    return zip_rows(a, b)


def zip_rows(*frames: DataFrame) -> DataFrame:
    """Combine one-row frames with disjoint columns into one row."""
    fields = [(f.name, f.dataType) for fr in frames for f in fr.schema.fields]
    parts = []
    for fr in frames:
        own = set(fr.columns)
        parts.append(fr.select(*[F.col(f"`{n}`") if n in own else F.lit(None).cast(t).alias(n)
                                 for n, t in fields]))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.first(F.col(f"`{n}`"), ignorenulls=True).alias(n) for n, _ in fields])
