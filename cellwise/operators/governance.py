"""Validation and promotion over tables of runs and model versions.

Inputs are long tables: ``run_metrics(run_id, name, value double)``,
``run_params(run_id, name, value string)``,
``model_versions(model, version, run_id, registered_at)`` and
``alias_events(model, alias, version, event_seq)``.  Each check pivots the
few names it needs with one grouped aggregate per table (partial
aggregation, so a run with very many rows costs one combiner row per task)
and then works row-wise on one row per run: no per-run collect, no joins
of large tables except on already-aggregated, co-partitioned keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.config import (
    ALIAS_CHALLENGER, ALIAS_CHAMPION, ALIAS_LATEST, METRIC_THRESHOLDS, PARAM_RANGES,
    PROMOTION_AUC_MIN, PROMOTION_F1_MIN, UPPER_LIMIT_METRICS,
)
from cellwise.functions.expr import float_text, format_fixed, last_path_segment
from cellwise.functions.ranges import running_totals


def _pivot(long: DataFrame, key: str, names: Sequence[str], value: str = "value",
           prefix: str = "", only_named: bool = True) -> DataFrame:
    """One row per ``key``: for each name its value, whether it was present
    and whether it clashes.

    With a ``step`` column the value of the latest step holds.  Without one, a
    name with different values has no defined value: it clashes.
    ``only_named=False`` keeps keys that have none of the names.
    """
    aggs = []
    for n in names:
        hit = F.col("name") == F.lit(n)
        v = F.when(hit, F.col(value))
        if "step" in long.columns:
            aggs += [F.max_by(F.col(value), F.when(hit, F.col("step"))).alias(f"{prefix}{n}"),
                     F.lit(False).alias(f"{prefix}{n}__clash")]
        else:
            aggs += [F.max(v).alias(f"{prefix}{n}"), (F.min(v) != F.max(v)).alias(f"{prefix}{n}__clash")]
        aggs.append(F.max(hit.cast("int")).alias(f"{prefix}{n}__present"))
    rows = long.where(F.col("name").isin(list(names))) if only_named else long
    return rows.groupBy(key).agg(*aggs)


def _clash(name: str, prefix: str) -> tuple[Column, Column]:
    """Condition and message of a value that was logged twice without order."""
    return (F.coalesce(F.col(f"{prefix}{name}__clash"), F.lit(False)),
            F.lit(f"{name}: logged more than once without a step"))


def _fmt_num(c: Column, digits: int = 4) -> Column:
    return format_fixed(c, digits)


def metric_failure_exprs(thresholds: Mapping[str, float] = METRIC_THRESHOLDS,
                         upper: Sequence[str] = UPPER_LIMIT_METRICS, prefix: str = "m_") -> list[Column]:
    """G1 per-run failure messages (null = pass), in threshold order."""
    out = []
    for name, limit in thresholds.items():
        v = F.col(f"{prefix}{name}")
        present = F.coalesce(F.col(f"{prefix}{name}__present"), F.lit(0)) == 1
        op = ">" if name in upper else "<"
        breach = (v > F.lit(limit)) if name in upper else (v < F.lit(limit))
        msg = (F.when(~present | v.isNull(), F.lit(f"{name}: missing"))
                .when(*_clash(name, prefix))
                .when(F.isnan(v), F.lit(f"{name}: not a number"))
                .when(breach, F.concat(F.lit(f"{name}: "), _fmt_num(v), F.lit(f" {op} {limit}"))))
        out.append(msg)
    return out


def param_failure_exprs(ranges: Mapping[str, tuple] = PARAM_RANGES, prefix: str = "p_") -> list[Column]:
    """G2 per-run failure messages, in range order."""
    out = []
    for name, (low, high) in ranges.items():
        raw = F.col(f"{prefix}{name}")
        present = F.coalesce(F.col(f"{prefix}{name}__present"), F.lit(0)) == 1
        v = raw.try_cast("double")
        msg = (F.when(~present | raw.isNull(), F.lit(f"{name}: missing"))
                .when(*_clash(name, prefix))
                .when(v.isNull(), F.concat(F.lit(f"{name}: not numeric ("), raw, F.lit(")")))
                .when((v < F.lit(low)) | (v > F.lit(high)) | F.isnan(v),
                      F.concat(F.lit(f"{name}: "), float_text(v), F.lit(f" not in [{low}, {high}]"))))
        out.append(msg)
    return out


def leaves_failure_expr(prefix: str = "p_") -> Column:
    """num_leaves <= 2^max_depth when both are positive integers."""
    d_raw, l_raw = F.col(f"{prefix}max_depth"), F.col(f"{prefix}num_leaves")
    d, nl = d_raw.try_cast("bigint"), l_raw.try_cast("bigint")
    bad_text = (d_raw.isNotNull() & d.isNull()) | (l_raw.isNotNull() & nl.isNull())
    d0, l0 = F.coalesce(d, F.lit(-1)), F.coalesce(nl, F.lit(-1))
    cap = F.pow(F.lit(2.0), F.least(d0, F.lit(62))).cast("bigint")
    over = (d0 > 0) & (l0 > 0) & (d0 < 62) & (l0 > cap)
    return (F.when(bad_text, F.lit("num_leaves/max_depth validation error: not an integer"))
             .when(over, F.concat(F.lit("num_leaves "), l0.cast("string"), F.lit(" > 2^max_depth ("),
                                  cap.cast("string"), F.lit(")"))))


def _failures_frame(runs: DataFrame | None, metrics: DataFrame | None, params: DataFrame | None,
                    thresholds, ranges, with_metrics: bool, with_params: bool,
                    with_leaves: bool) -> DataFrame:
    """One row per run with its failure messages (array, in check order).

    Without an explicit ``runs`` table the runs are those present in the
    inputs: the pivots (each already one row per run, hash-partitioned by
    run_id) are full-outer-joined, which needs no extra shuffle.
    """
    piv = []
    if with_metrics:
        piv.append(_pivot(metrics, "run_id", list(thresholds), prefix="m_"))
    if with_params or with_leaves:
        names = list(ranges) + [n for n in ("max_depth", "num_leaves") if n not in ranges]
        piv.append(_pivot(params, "run_id", names, prefix="p_"))
    if runs is not None:
        x = runs.select("run_id").distinct()
        for t in piv:
            x = x.join(t, "run_id", "left")
    else:
        x = piv[0]
        for t in piv[1:]:
            x = x.join(t, "run_id", "full")
    exprs: list[Column] = []
    if with_metrics:
        exprs += metric_failure_exprs(thresholds)
    if with_params:
        exprs += param_failure_exprs(ranges)
    if with_leaves:
        exprs.append(leaves_failure_expr())
    return x.select("run_id", F.array_compact(F.array(*exprs)).alias("failures"))


def audit_metrics(metrics: DataFrame, runs: DataFrame | None = None,
                  thresholds: Mapping[str, float] = METRIC_THRESHOLDS) -> DataFrame:
    """G1: one row per failing (run, metric): (run_id, failure)."""
    f = _failures_frame(runs, metrics, None, thresholds, {}, True, False, False)
    return f.select("run_id", F.explode("failures").alias("failure"))


def audit_params(params: DataFrame, runs: DataFrame | None = None,
                 ranges: Mapping[str, tuple] = PARAM_RANGES) -> DataFrame:
    """One row per failing (run, parameter)."""
    f = _failures_frame(runs, None, params, {}, ranges, False, True, False)
    return f.select("run_id", F.explode("failures").alias("failure"))


def audit_leaves(params: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Runs whose num_leaves exceeds 2^max_depth."""
    f = _failures_frame(runs, None, params, {}, {}, False, False, True)
    return f.select("run_id", F.explode("failures").alias("failure"))


def validation_verdict(metrics: DataFrame, params: DataFrame, runs: DataFrame | None = None,
                       thresholds: Mapping[str, float] = METRIC_THRESHOLDS,
                       ranges: Mapping[str, tuple] = PARAM_RANGES) -> DataFrame:
    """(run_id, status 'passed'/'failed', failures array) for every run;
    with a ``runs`` table carrying ``model_uri``, also the model version
    (last path segment of the URI)."""
    f = _failures_frame(runs, metrics, params, thresholds, ranges, True, True, True)
    status = F.when(F.size("failures") == 0, F.lit("passed")).otherwise(F.lit("failed"))
    out = f.select("run_id", status.alias("status"), "failures")
    if runs is not None and "model_uri" in runs.columns:
        # the version of the model under review: last segment of its URI
        uris = runs.select("run_id", "model_uri").dropDuplicates(["run_id"])
        out = out.join(uris, "run_id", "left").withColumn("version", last_path_segment("model_uri"))
    return out


def alias_holder(events: DataFrame, alias: str | None = None) -> DataFrame:
    """Current version per (model, alias) from an append-only event log
    (latest ``event_seq`` wins; aliases compared lower-case). A null version
    means the alias was removed."""
    ev = events.withColumn("alias", F.lower("alias"))
    if alias is not None:
        ev = ev.where(F.col("alias") == F.lit(alias.lower()))
    return ev.groupBy("model", "alias").agg(
        F.max_by("version", "event_seq").alias("version"), F.max("event_seq").alias("event_seq"))


def promotion_gate(candidates: DataFrame, metrics: DataFrame, versions: DataFrame,
                   events: DataFrame, f1_min: float = PROMOTION_F1_MIN,
                   auc_min: float = PROMOTION_AUC_MIN, f1_name: str = "f1_score",
                   auc_name: str = "roc_auc") -> DataFrame:
    """Decide promotion of each candidate (model, run_id) against the
    model's current champion, in this order: unknown run -> invalid; no
    champion -> promote; missing, clashing or NaN metric -> invalid; dAUC <
    auc_min -> blocked; dF1 < f1_min -> blocked; else promote.

    A run is known if it logged any metric or is a registered version.
    """
    # One pivot for candidates and champions; registered runs without metrics
    # come in as rows without a name.
    logged = metrics.select("run_id", "name", "value", *(["step"] if "step" in metrics.columns else []))
    registered = versions.select("run_id", *[F.lit(None).cast(t).alias(c) for c, t in logged.dtypes[1:]])
    f1, auc = F.col(f"m_{f1_name}"), F.col(f"m_{auc_name}")
    m = _pivot(logged.unionByName(registered), "run_id", [f1_name, auc_name], prefix="m_",
               only_named=False).select(
        "run_id", F.when(~F.coalesce(f"m_{f1_name}__clash", F.lit(False)), f1).alias("f1"),
        F.when(~F.coalesce(f"m_{auc_name}__clash", F.lit(False)), auc).alias("auc"), F.lit(True).alias("known"))
    champ = (alias_holder(events, ALIAS_CHAMPION).where(F.col("version").isNotNull())
             .join(versions.select("model", "version", F.col("run_id").alias("champion_run_id")),
                   ["model", "version"], "inner")
             .join(m.select(F.col("run_id").alias("champion_run_id"), F.col("f1").alias("f1_old"),
                            F.col("auc").alias("auc_old")), "champion_run_id", "left")
             # one row per model, so candidates only join by model
             .select("model", F.col("version").alias("champion_version"), "champion_run_id", "f1_old", "auc_old"))
    c = (candidates.select("model", F.col("run_id").alias("candidate_run_id"))
         .join(champ, "model", "left")
         .join(m.select(F.col("run_id").alias("candidate_run_id"), F.col("f1").alias("f1_new"),
                        F.col("auc").alias("auc_new"), "known"), "candidate_run_id", "left"))
    unknown = F.col("known").isNull()
    d_f1 = F.col("f1_new") - F.col("f1_old")
    d_auc = F.col("auc_new") - F.col("auc_old")
    bad = None
    for v in ("f1_new", "f1_old", "auc_new", "auc_old"):
        t = F.col(v).isNull() | F.isnan(F.col(v))
        bad = t if bad is None else (bad | t)
    status = (F.when(unknown, F.lit("invalid"))
               .when(F.col("champion_run_id").isNull(), F.lit("promote"))
               .when(bad, F.lit("invalid"))
               .when(d_auc < F.lit(auc_min), F.lit("blocked"))
               .when(d_f1 < F.lit(f1_min), F.lit("blocked"))
               .otherwise(F.lit("promote")))
    reason = (F.when(unknown, F.lit("unknown candidate run"))
               .when(F.col("champion_run_id").isNull(), F.lit("no champion"))
               .when(bad, F.lit("missing or invalid metric"))
               .when(d_auc < F.lit(auc_min), F.lit("roc_auc regressed"))
               .when(d_f1 < F.lit(f1_min), F.lit("f1 improvement too small"))
               .otherwise(F.lit("passed")))
    return c.select("model", "candidate_run_id", "champion_run_id", "champion_version",
                    d_f1.alias("delta_f1"), d_auc.alias("delta_auc"), status.alias("status"),
                    reason.alias("reason"))


def alias_swap_events(decisions: DataFrame, events: DataFrame) -> DataFrame:
    """Alias events for approved promotions: the Challenger's version
    becomes Champion; the old Champion (if any) becomes Challenger.

    Returns the rows to append to ``alias_events`` (1 or 2 per model).
    """
    ok = decisions.where(F.col("status") == "promote").select("model").distinct()
    holders = alias_holder(events).where(F.col("alias").isin(ALIAS_CHAMPION, ALIAS_CHALLENGER))
    cur = holders.groupBy("model").agg(
        F.max(F.when(F.col("alias") == ALIAS_CHAMPION, F.col("version"))).alias("champ"),
        F.max(F.when(F.col("alias") == ALIAS_CHALLENGER, F.col("version"))).alias("chall"))
    seq = events.groupBy("model").agg(F.max("event_seq").alias("_seq"))
    x = ok.join(cur, "model").join(seq, "model").where(F.col("chall").isNotNull())
    rows = F.array(
        F.struct(F.lit("Champion").alias("alias"), F.col("chall").alias("version"),
                 (F.col("_seq") + 1).alias("event_seq")),
        F.when(F.col("champ").isNotNull(),
               F.struct(F.lit("Challenger").alias("alias"), F.col("champ").alias("version"),
                        (F.col("_seq") + 2).alias("event_seq"))))
    return (x.select("model", F.explode(F.array_compact(rows)).alias("_e"))
             .select("model", "_e.alias", "_e.version", "_e.event_seq"))


def alias_swap_status(decisions: DataFrame, events: DataFrame) -> DataFrame:
    """One row per approved model: (model, status), 'swapped' or, where
    there is no Challenger to promote, 'no challenger'."""
    ok = decisions.where(F.col("status") == "promote").select("model").distinct()
    chall = alias_holder(events, ALIAS_CHALLENGER).where(F.col("version").isNotNull()).select(
        "model", F.lit("swapped").alias("status"))
    return ok.join(chall, "model", "left").select("model", F.coalesce("status", F.lit("no challenger")).alias("status"))


def challenger_events(verdicts: DataFrame, versions: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """G4's outcome on the registry: per registered run with a verdict
    (model, version, run_id, status tag, alias, event_seq); a passed run's
    version gets the Challenger alias, a failed one only its tag.

    Rows with an alias are the events to append; of a model's passed versions
    the newest comes last, so it holds the alias afterwards.
    """
    seq = (events.groupBy("model").agg(F.max("event_seq").alias("_seq")) if events is not None
           else versions.select("model").distinct().withColumn("_seq", F.lit(0).cast("long")))
    x = (versions.select("model", "version", "run_id").join(verdicts.select("run_id", "status"), "run_id")
         .join(seq, "model", "left"))
    passed = F.col("status") == "passed"
    # Versions are unique within a model, so they order its events.
    return x.select("model", "version", "run_id", "status",
                    F.when(passed, F.lit("Challenger")).alias("alias"),
                    F.when(passed, F.coalesce("_seq", F.lit(0)) + F.col("version")).cast("long").alias("event_seq"))


def champion_reeval(scored: DataFrame, y: str, yhat: str, tag_col: str = "model_tag",
                    candidate: str = "candidate", champion: str = "champion") -> DataFrame:
    """Re-score the champion on the current test set and compare F1
    (support-weighted / binary as C3). No champion rows -> improved."""
    from cellwise.operators.metrics import precision_recall_f1

    f1 = precision_recall_f1(scored, y, yhat, [tag_col])
    wide = f1.groupBy().pivot(tag_col, [candidate, champion]).agg(F.first("f1_score"))
    new, old = F.col(f"`{candidate}`"), F.col(f"`{champion}`")
    return wide.select(new.alias("f1_new"), old.alias("f1_old"),
                       (old.isNull() | (new >= old)).alias("improved"))


def register_versions(runs: DataFrame, existing: DataFrame | None = None,
                      n_buckets: int | None = None) -> DataFrame:
    """Version numbers per model in registration order (registered_at,
    run_id), continuing after ``existing`` versions.

    Numbering uses exact running totals per model (range buckets), so a
    model holding most runs is still numbered by many tasks.
    """
    x = runs.select("model", "run_id", "registered_at",
                    F.unix_micros(F.col("registered_at").cast("timestamp")).alias("_t"),
                    F.lit(1).alias("_one"))
    x = running_totals(x, ["model"], ["_t", "run_id"], ["_one"], n_buckets=n_buckets)
    x = x.withColumn("version", (F.col("cum__one") + 1).cast("int"))
    if existing is not None:
        base = existing.groupBy("model").agg(F.max("version").alias("_base"))
        x = x.join(base, "model", "left").withColumn(
            "version", F.col("version") + F.coalesce(F.col("_base"), F.lit(0))).drop("_base")
    return x.select("model", "version", "run_id", "registered_at")


def latest_alias(versions: DataFrame) -> DataFrame:
    """The latest-model alias per model (newest registration)."""
    return versions.groupBy("model").agg(
        F.max_by("version", F.struct("registered_at", "version")).alias("version")).select(
        "model", F.lit(ALIAS_LATEST).alias("alias"), "version")
