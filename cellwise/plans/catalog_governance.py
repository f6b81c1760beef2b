"""Registered governance queries (G1-G9) on run tables made by rule from orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.operators import governance as G
from cellwise.plans.catalog import _round, register
from cellwise.sources.files import read_table

# ---------------------------------------------------------------------------
# Run tables: run_id = o_orderkey, every order is a run; values from price
# and key digits; a metric or parameter logged under another name (so it is
# missing for the gate), NaN and non-numeric text by rule.
# ---------------------------------------------------------------------------

RUN_METRICS_SQL = """
  SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 10 = 1 THEN 'accuracy_v0' ELSE 'accuracy' END AS name, o_totalprice / 500000.0 AS value, 1 AS step FROM orders
  UNION ALL SELECT o_orderkey, 'accuracy', 0.99, 0 FROM orders WHERE o_orderkey % 10 <> 1 AND o_orderkey % 5 = 0
  UNION ALL SELECT o_orderkey, 'f1_score', (o_totalprice % 1000) / 1000.0, 1 FROM orders
  UNION ALL SELECT o_orderkey, 'precision', CASE WHEN o_orderkey % 23 = 0 THEN 'NaN'::DOUBLE ELSE 0.6 + (o_orderkey % 40) / 100.0 END, 1 FROM orders
  UNION ALL SELECT o_orderkey, 'recall', 0.7 + (o_custkey % 30) / 100.0, 1 FROM orders
  UNION ALL SELECT o_orderkey, 'roc_auc', CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE 0.8 + (o_orderkey % 20) / 100.0 END, 1 FROM orders
  UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'loss' ELSE 'log_loss' END, (o_orderkey % 100) / 100.0, 1 FROM orders"""

RUN_PARAMS_SQL = """
  SELECT o_orderkey AS run_id, CASE WHEN o_orderkey % 8 = 3 THEN 'eta' ELSE 'learning_rate' END AS name,
         CASE WHEN o_orderkey % 31 = 0 THEN '0.0001' WHEN o_orderkey % 37 = 0 THEN '0.00001' ELSE CAST((o_orderkey % 200) / 1000.0 AS VARCHAR) END AS value FROM orders
  UNION ALL SELECT o_orderkey, 'n_estimators', CASE WHEN o_orderkey % 17 = 0 THEN '10000000' ELSE CAST(o_custkey * 3 AS VARCHAR) END FROM orders
  UNION ALL SELECT o_orderkey, 'n_estimators', '7' FROM orders WHERE o_orderkey % 41 = 0
  UNION ALL SELECT o_orderkey, 'max_depth', CASE WHEN o_orderkey % 29 = 0 THEN 'abc' ELSE CAST(o_orderkey % 15 AS VARCHAR) END FROM orders
  UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'leaves' ELSE 'num_leaves' END, CAST(o_orderkey % 130 AS VARCHAR) FROM orders"""


def _explode_named(o: DataFrame, key: Column, items: list[tuple[Column, ...]]) -> DataFrame:
    """One scan of ``o``: each row becomes one (run_id, name, value[, step]) row
    per item; items without a name are left out."""
    fields = ("name", "value", "step")
    arr = F.array(*[F.struct(*[c.alias(n) for c, n in zip(item, fields)]) for item in items])
    out = o.select(key.alias("run_id"), F.explode(arr).alias("_kv")).select("run_id", "_kv.*")
    return out.where(F.col("name").isNotNull())


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics with their logging step; some accuracies are logged twice and
    the later value holds."""
    o = read_table(spark, sf, "orders")
    k, p = F.col("o_orderkey"), F.col("o_totalprice")
    one = F.lit(1)
    return _explode_named(o, k, [
        (F.when(k % 10 == 1, "accuracy_v0").otherwise("accuracy"), p / 500000.0, one),
        (F.when((k % 10 != 1) & (k % 5 == 0), "accuracy"), F.lit(0.99), F.lit(0)),
        (F.lit("f1_score"), (p % 1000) / 1000.0, one),
        (F.lit("precision"), F.when(k % 23 == 0, F.lit(float("nan"))).otherwise(F.lit(0.6) + (k % 40) / 100.0), one),
        (F.lit("recall"), F.lit(0.7) + (F.col("o_custkey") % 30) / 100.0, one),
        (F.lit("roc_auc"), F.when(k % 19 == 0, F.lit(None).cast("double")).otherwise(F.lit(0.8) + (k % 20) / 100.0), one),
        (F.when(k % 9 == 0, "loss").otherwise("log_loss"), (k % 100) / 100.0, one),
    ])


def run_params(spark: SparkSession, sf: str) -> DataFrame:
    """Parameters without a step; some are logged twice with other values."""
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return _explode_named(o, k, [
        (F.when(k % 8 == 3, "eta").otherwise("learning_rate"),
         F.when(k % 31 == 0, "0.0001").when(k % 37 == 0, "0.00001").otherwise(((k % 200) / 1000.0).cast("string"))),
        (F.lit("n_estimators"), F.when(k % 17 == 0, "10000000").otherwise((F.col("o_custkey") * 3).cast("string"))),
        (F.when(k % 41 == 0, "n_estimators"), F.lit("7")),
        (F.lit("max_depth"), F.when(k % 29 == 0, F.lit("abc")).otherwise((k % 15).cast("string"))),
        (F.when(k % 4 == 0, "leaves").otherwise("num_leaves"), (k % 130).cast("string")),
    ])


def _metric_msgs_sql() -> str:
    """SQL twin of the G1 messages for the pivoted metrics (alias m)."""
    from cellwise.config import METRIC_THRESHOLDS, UPPER_LIMIT_METRICS

    parts = []
    for n, lim in METRIC_THRESHOLDS.items():
        op = ">" if n in UPPER_LIMIT_METRICS else "<"
        parts.append(
            f"CASE WHEN coalesce(m.{n}__present, 0) = 0 OR m.{n} IS NULL THEN '{n}: missing' "
            f"WHEN isnan(m.{n}) THEN '{n}: not a number' "
            f"WHEN m.{n} {op} {lim} THEN '{n}: ' || printf('%.4f', m.{n}) || ' {op} {lim}' END")
    return parts


def _param_msgs_sql() -> list[str]:
    from cellwise.config import PARAM_RANGES

    parts = []
    for n, (lo, hi) in PARAM_RANGES.items():
        v = f"TRY_CAST(q.{n} AS DOUBLE)"
        parts.append(
            f"CASE WHEN coalesce(q.{n}__present, 0) = 0 OR q.{n} IS NULL THEN '{n}: missing' "
            f"WHEN q.{n}__clash THEN '{n}: logged more than once without a step' "
            f"WHEN {v} IS NULL THEN '{n}: not numeric (' || q.{n} || ')' "
            f"WHEN {v} < {lo} OR {v} > {hi} OR isnan({v}) THEN '{n}: ' || CAST({v} AS VARCHAR) || ' not in [{lo}, {hi}]' END")
    return parts


LEAVES_MSG_SQL = """CASE WHEN (q.max_depth IS NOT NULL AND TRY_CAST(q.max_depth AS BIGINT) IS NULL)
                      OR (q.num_leaves IS NOT NULL AND TRY_CAST(q.num_leaves AS BIGINT) IS NULL)
                    THEN 'num_leaves/max_depth validation error: not an integer'
                    WHEN coalesce(TRY_CAST(q.max_depth AS BIGINT), -1) > 0 AND coalesce(TRY_CAST(q.num_leaves AS BIGINT), -1) > 0
                         AND TRY_CAST(q.max_depth AS BIGINT) < 62
                         AND TRY_CAST(q.num_leaves AS BIGINT) > (1::BIGINT << TRY_CAST(q.max_depth AS INTEGER))
                    THEN 'num_leaves ' || CAST(TRY_CAST(q.num_leaves AS BIGINT) AS VARCHAR) || ' > 2^max_depth ('
                         || CAST((1::BIGINT << TRY_CAST(q.max_depth AS INTEGER)) AS VARCHAR) || ')' END"""


def _pivot_sql(table_sql: str, names: list[str]) -> str:
    cols = []
    for n in names:
        if table_sql is RUN_METRICS_SQL:
            cols.append(f"arg_max(value, step) FILTER (name = '{n}') AS {n}")
        else:
            cols.append(f"max(CASE WHEN name = '{n}' THEN value END) AS {n}")
            cols.append(f"coalesce(min(value) FILTER (name = '{n}') <> max(value) FILTER (name = '{n}'), false) AS {n}__clash")
        cols.append(f"max(CASE WHEN name = '{n}' THEN 1 ELSE 0 END) AS {n}__present")
    return f"SELECT run_id, {', '.join(cols)} FROM ({table_sql}) t GROUP BY run_id"


def _verdict_sql() -> str:
    from cellwise.config import METRIC_THRESHOLDS, PARAM_RANGES

    msgs = _metric_msgs_sql() + _param_msgs_sql() + [LEAVES_MSG_SQL]
    arr = "list_filter([" + ", ".join(msgs) + "], lambda x: x IS NOT NULL)"
    pnames = list(PARAM_RANGES) + ["num_leaves"]
    return f"""
  WITH runs AS (SELECT run_id FROM ({RUN_METRICS_SQL}) a UNION SELECT run_id FROM ({RUN_PARAMS_SQL}) b),
  m AS ({_pivot_sql(RUN_METRICS_SQL, list(METRIC_THRESHOLDS))}),
  q AS ({_pivot_sql(RUN_PARAMS_SQL, pnames)}),
  f AS (SELECT runs.run_id, {arr} AS failures FROM runs LEFT JOIN m ON m.run_id = runs.run_id
        LEFT JOIN q ON q.run_id = runs.run_id)
  SELECT run_id, CASE WHEN len(failures) = 0 THEN 'passed' ELSE 'failed' END AS status,
         CAST(len(failures) AS INTEGER) AS n_failures, array_to_string(failures, '; ') AS failures FROM f"""


@register("validation_verdict_runs", _verdict_sql())
def validation_verdict_runs(spark, sf):
    """G4 (G1 + G2 + G3) for every run."""
    v = G.validation_verdict(run_metrics(spark, sf), run_params(spark, sf))
    return v.select("run_id", "status", F.size("failures").alias("n_failures"),
                    F.array_join("failures", "; ").alias("failures"))


@register("audit_metrics_runs", f"""
  WITH runs AS (SELECT DISTINCT run_id FROM ({RUN_METRICS_SQL}) a),
  m AS ({_pivot_sql(RUN_METRICS_SQL, ['accuracy', 'f1_score', 'precision', 'recall', 'roc_auc', 'log_loss'])}),
  f AS (SELECT runs.run_id, [{', '.join(_metric_msgs_sql())}] AS msgs FROM runs LEFT JOIN m ON m.run_id = runs.run_id)
  SELECT run_id, failure FROM (SELECT run_id, unnest(msgs) AS failure FROM f) u WHERE failure IS NOT NULL""")
def audit_metrics_runs(spark, sf):
    """G1: one row per failing (run, metric)."""
    return G.audit_metrics(run_metrics(spark, sf))


@register("audit_params_runs", f"""
  WITH runs AS (SELECT DISTINCT run_id FROM ({RUN_PARAMS_SQL}) a),
  q AS ({_pivot_sql(RUN_PARAMS_SQL, ['learning_rate', 'n_estimators', 'max_depth', 'num_leaves'])}),
  f AS (SELECT runs.run_id, [{', '.join(_param_msgs_sql())}] AS msgs FROM runs LEFT JOIN q ON q.run_id = runs.run_id)
  SELECT run_id, failure FROM (SELECT run_id, unnest(msgs) AS failure FROM f) u WHERE failure IS NOT NULL""")
def audit_params_runs(spark, sf):
    """One row per failing (run, parameter)."""
    return G.audit_params(run_params(spark, sf))


@register("audit_leaves_runs", f"""
  WITH q AS ({_pivot_sql(RUN_PARAMS_SQL, ['max_depth', 'num_leaves'])})
  SELECT run_id, failure FROM (SELECT run_id, {LEAVES_MSG_SQL} AS failure FROM q) u WHERE failure IS NOT NULL""")
def audit_leaves_runs(spark, sf):
    """G3."""
    return G.audit_leaves(run_params(spark, sf))


# ---------------------------------------------------------------------------
# Registry: versions per model, alias event log
# ---------------------------------------------------------------------------

MODEL_RUNS_SQL = """SELECT 'model_' || CAST(o_custkey % 50 AS VARCHAR) AS model, o_orderkey AS run_id,
                           o_orderdate AS registered_at FROM orders"""
VERSIONS_SQL = f"""SELECT model, CAST(row_number() OVER (PARTITION BY model ORDER BY registered_at, run_id) AS INTEGER) AS version,
                          run_id, registered_at FROM ({MODEL_RUNS_SQL}) r"""
EVENTS_SQL = """SELECT 'model_' || CAST(o_custkey % 50 AS VARCHAR) AS model,
                       CASE o_orderkey % 3 WHEN 0 THEN 'Champion' WHEN 1 THEN CASE WHEN o_custkey % 50 < 10 THEN 'shadow' ELSE 'challenger' END
                            ELSE 'CHAMPION' END AS alias,
                       CAST(o_orderkey % 37 + 1 AS INTEGER) AS version, o_orderkey AS event_seq
                FROM orders"""


def model_runs(spark, sf) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return o.select(F.concat(F.lit("model_"), (F.col("o_custkey") % 50).cast("string")).alias("model"),
                    F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("registered_at"))


def alias_events(spark, sf) -> DataFrame:
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.select(F.concat(F.lit("model_"), (F.col("o_custkey") % 50).cast("string")).alias("model"),
                    F.when(k % 3 == 0, "Champion")
                    .when(k % 3 == 1, F.when(F.col("o_custkey") % 50 < 10, "shadow").otherwise("challenger"))
                    .otherwise("CHAMPION").alias("alias"), (k % 37 + 1).cast("int").alias("version"), k.alias("event_seq"))


@register("register_versions_runs", VERSIONS_SQL)
def register_versions_runs(spark, sf):
    """Version numbers per model in registration order."""
    return G.register_versions(model_runs(spark, sf))


@register("latest_alias_runs", f"""
  SELECT model, 'latest-model' AS alias, arg_max(version, (registered_at, version)) AS version
  FROM ({VERSIONS_SQL}) v GROUP BY model""")
def latest_alias_runs(spark, sf):
    """Latest-model alias per model."""
    return G.latest_alias(G.register_versions(model_runs(spark, sf)))


@register("alias_holder_events", f"""
  SELECT model, lower(alias) AS alias, arg_max(version, event_seq) AS version, max(event_seq) AS event_seq
  FROM ({EVENTS_SQL}) e GROUP BY model, lower(alias)""")
def alias_holder_events(spark, sf):
    """Current holder of each alias (case-insensitive)."""
    return G.alias_holder(alias_events(spark, sf))


# Every 11th candidate names a run that does not exist.
CANDIDATES_SQL = """SELECT 'model_' || CAST(o_custkey % 50 AS VARCHAR) AS model,
                           CASE WHEN o_orderkey % 11 = 0 THEN -o_orderkey ELSE o_orderkey END AS run_id FROM orders"""


def _gate_sql(f1_min: float, auc_min: float) -> str:
    return f"""
  WITH m AS ({_pivot_sql(RUN_METRICS_SQL, ['f1_score', 'roc_auc'])}),
  champ AS (SELECT h.model, h.version AS champion_version, v.run_id AS champion_run_id
            FROM (SELECT model, arg_max(version, event_seq) AS version FROM ({EVENTS_SQL}) e
                  WHERE lower(alias) = 'champion' GROUP BY model) h
            JOIN ({VERSIONS_SQL}) v ON v.model = h.model AND v.version = h.version
            WHERE h.version IS NOT NULL),
  c AS (SELECT c.model, c.run_id AS candidate_run_id, ch.champion_run_id, ch.champion_version,
               mn.f1_score AS f1_new, mo.f1_score AS f1_old, mn.roc_auc AS auc_new, mo.roc_auc AS auc_old, k.run_id IS NULL AS unknown
        FROM ({CANDIDATES_SQL}) c LEFT JOIN champ ch ON ch.model = c.model
        LEFT JOIN m mn ON mn.run_id = c.run_id LEFT JOIN m mo ON mo.run_id = ch.champion_run_id
        LEFT JOIN (SELECT o_orderkey AS run_id FROM orders) k ON k.run_id = c.run_id),
  d AS (SELECT *, f1_new - f1_old AS delta_f1, auc_new - auc_old AS delta_auc,
               (f1_new IS NULL OR isnan(f1_new) OR f1_old IS NULL OR isnan(f1_old)
                OR auc_new IS NULL OR isnan(auc_new) OR auc_old IS NULL OR isnan(auc_old)) AS bad FROM c)
  SELECT model, candidate_run_id, champion_run_id, champion_version, round(delta_f1, 6) AS delta_f1,
         round(delta_auc, 6) AS delta_auc,
         CASE WHEN unknown THEN 'invalid' WHEN champion_run_id IS NULL THEN 'promote' WHEN bad THEN 'invalid'
              WHEN delta_auc < {auc_min} THEN 'blocked' WHEN delta_f1 < {f1_min} THEN 'blocked'
              ELSE 'promote' END AS status,
         CASE WHEN unknown THEN 'unknown candidate run' WHEN champion_run_id IS NULL THEN 'no champion' WHEN bad THEN 'missing or invalid metric'
              WHEN delta_auc < {auc_min} THEN 'roc_auc regressed'
              WHEN delta_f1 < {f1_min} THEN 'f1 improvement too small' ELSE 'passed' END AS reason
  FROM d"""


def _gate(spark, sf, f1_min, auc_min):
    o = read_table(spark, sf, "orders")
    cands = o.select(F.concat(F.lit("model_"), (F.col("o_custkey") % 50).cast("string")).alias("model"),
                     F.when(F.col("o_orderkey") % 11 == 0, -F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
                     .alias("run_id"))
    versions = G.register_versions(model_runs(spark, sf))
    return G.promotion_gate(cands, run_metrics(spark, sf), versions, alias_events(spark, sf),
                            f1_min=f1_min, auc_min=auc_min)


@register("promotion_gate_runs", _gate_sql(0.0, -0.002))
def promotion_gate_runs(spark, sf):
    """G6 with the function defaults (dF1 >= 0, dAUC >= -0.002)."""
    return _round(_gate(spark, sf, 0.0, -0.002), ["delta_f1", "delta_auc"])


@register("alias_swap_events_runs", f"""
  WITH g AS ({_gate_sql(0.0, 0.0)}),
  ok AS (SELECT DISTINCT model FROM g WHERE status = 'promote'),
  cur AS (SELECT model, max(CASE WHEN alias = 'champion' THEN version END) AS champ,
                 max(CASE WHEN alias = 'challenger' THEN version END) AS chall FROM (
            SELECT model, lower(alias) AS alias, arg_max(version, event_seq) AS version FROM ({EVENTS_SQL}) e
            GROUP BY model, lower(alias)) h GROUP BY model),
  seq AS (SELECT model, max(event_seq) AS s FROM ({EVENTS_SQL}) e GROUP BY model),
  x AS (SELECT ok.model, champ, chall, s FROM ok JOIN cur ON cur.model = ok.model JOIN seq ON seq.model = ok.model
        WHERE chall IS NOT NULL)
  SELECT model, 'Champion' AS alias, chall AS version, s + 1 AS event_seq FROM x
  UNION ALL SELECT model, 'Challenger', champ, s + 2 FROM x WHERE champ IS NOT NULL""")
def alias_swap_events_runs(spark, sf):
    """G6 (flow thresholds 0/0) -> G7 swap events for the approved models."""
    decisions = _gate(spark, sf, 0.0, 0.0)
    return G.alias_swap_events(decisions, alias_events(spark, sf))


@register("alias_swap_status_runs", f"""
  WITH g AS ({_gate_sql(0.0, 0.0)}),
  ok AS (SELECT DISTINCT model FROM g WHERE status = 'promote'),
  ch AS (SELECT DISTINCT model FROM ({EVENTS_SQL}) e WHERE lower(alias) = 'challenger')
  SELECT ok.model, CASE WHEN ch.model IS NULL THEN 'no challenger' ELSE 'swapped' END AS status
  FROM ok LEFT JOIN ch ON ch.model = ok.model""")
def alias_swap_status_runs(spark, sf):
    """What became of every approved model, also without a Challenger."""
    return G.alias_swap_status(_gate(spark, sf, 0.0, 0.0), alias_events(spark, sf))


@register("challenger_events_runs", f"""
  WITH v AS ({_verdict_sql()}), seq AS (SELECT model, max(event_seq) AS s FROM ({EVENTS_SQL}) e GROUP BY model)
  SELECT r.model, r.version, r.run_id, v.status, CASE WHEN v.status = 'passed' THEN 'Challenger' END AS alias,
         CASE WHEN v.status = 'passed' THEN CAST(coalesce(seq.s, 0) + r.version AS BIGINT) END AS event_seq
  FROM ({VERSIONS_SQL}) r JOIN v ON v.run_id = r.run_id LEFT JOIN seq ON seq.model = r.model""")
def challenger_events_runs(spark, sf):
    """G4 on the registry: status tag per version, Challenger for the passed."""
    verdicts = G.validation_verdict(run_metrics(spark, sf), run_params(spark, sf))
    return G.challenger_events(verdicts, G.register_versions(model_runs(spark, sf)), alias_events(spark, sf))


@register("champion_reeval_orders", """
  WITH s AS (SELECT 'candidate' AS tag, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS y,
                    CAST(o_orderkey % 3 AS INTEGER) AS yhat FROM orders
             UNION ALL SELECT 'champion', CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END,
                    CAST(o_custkey % 3 AS INTEGER) FROM orders),
  cells AS (SELECT tag, y, yhat, count(*) AS n FROM s GROUP BY tag, y, yhat),
  st AS (SELECT tag, label, sum(tp) AS tp, sum(support) AS support, sum(predicted) AS predicted FROM (
           SELECT tag, y AS label, CASE WHEN y = yhat THEN n ELSE 0 END AS tp, n AS support, 0 AS predicted FROM cells
           UNION ALL SELECT tag, yhat, 0, 0, n FROM cells) u GROUP BY tag, label),
  f AS (SELECT tag, sum(CASE WHEN support + predicted = 0 THEN 0.0 ELSE 2.0 * tp / (support + predicted) END * support)
                   / sum(support) AS f1 FROM st GROUP BY tag)
  SELECT round(n.f1, 6) AS f1_new, round(o.f1, 6) AS f1_old, n.f1 >= o.f1 AS improved
  FROM f n, f o WHERE n.tag = 'candidate' AND o.tag = 'champion'""")
def champion_reeval_orders(spark, sf):
    """Candidate vs champion F1 on the same test rows."""
    o = read_table(spark, sf, "orders")
    y = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    cand = o.select(F.lit("candidate").alias("model_tag"), y.alias("y"),
                    (F.col("o_orderkey") % 3).cast("int").alias("yhat"))
    champ = o.select(F.lit("champion").alias("model_tag"), y.alias("y"),
                     (F.col("o_custkey") % 3).cast("int").alias("yhat"))
    out = G.champion_reeval(cand.unionByName(champ), "y", "yhat")
    return out.select(F.round("f1_new", 6).alias("f1_new"), F.round("f1_old", 6).alias("f1_old"), "improved")
