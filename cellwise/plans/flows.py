"""End-to-end flows: prepare -> train -> validate -> promote.

Each flow is a few lazy DataFrame plans plus the writes/fits that end them;
configuration is the only driver-side state.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.config import (
    EV_CLASS_NAMES, EV_RENAMES, EV_SENTINELS, EV_TARGET_DOMAIN, PROMOTION_FLOW_AUC_MIN,
    PROMOTION_FLOW_F1_MIN, ProjectConfig,
)
from cellwise.operators import governance as G
from cellwise.operators import metrics as C
from cellwise.operators import models as M
from cellwise.operators.prepare import cast_features, clean_frame
from cellwise.operators.profile import last_rows, require_rows
from cellwise.operators.split import exact_split, split_frames
from cellwise.sources import files as S
from cellwise.sources.lineage import check_schema, dataset_fingerprint, schema_signature
from cellwise.sources.versions import batch_versions

# Raw EV CSV schema: header names as in the file; the target is read as text
# so a bad value drops only its own row.
EV_RAW_SCHEMA = T.StructType([
    T.StructField("SOC (%)", T.DoubleType()), T.StructField("Voltage (V)", T.DoubleType()),
    T.StructField("Current (A)", T.DoubleType()), T.StructField("Battery Temp (°C)", T.DoubleType()),
    T.StructField("Ambient Temp (°C)", T.DoubleType()),
    T.StructField("Charging Duration (min)", T.DoubleType()),
    T.StructField("Degradation Rate (%)", T.DoubleType()), T.StructField("Charging Mode", T.StringType()),
    T.StructField("Efficiency (%)", T.DoubleType()), T.StructField("Battery Type", T.StringType()),
    T.StructField("Charging Cycles", T.LongType()), T.StructField("EV Model", T.StringType()),
    T.StructField("Optimal Charging Duration Class", T.StringType()),
])


def prepare_flow(spark: SparkSession, csv_path: str, out_base: str,
                 config: ProjectConfig | None = None, test_size: float = 0.2, seed: int = 42,
                 run_id: str | None = None) -> str:
    """Entry A: CSV -> clean -> exact split -> two stamped appends sharing
    one run id. Returns the run id.

    A line with a malformed value is no data: it goes to the table
    ``rejects`` (text, same run id) and never meets a sentinel.  The file is
    read once.
    """
    cfg = config or ProjectConfig()
    rid = run_id or uuid.uuid4().hex
    raw = S.read_csv(spark, csv_path, EV_RAW_SCHEMA, keep_corrupt=True).checkpoint(eager=True)
    corrupt = F.col(S.CORRUPT_COL)
    S.append_split(raw.where(corrupt.isNotNull()).select(S.CORRUPT_COL), f"{out_base}/rejects", rid)
    clean = clean_frame(raw.where(corrupt.isNull()).drop(S.CORRUPT_COL), EV_RENAMES, EV_SENTINELS, cfg.target,
                        EV_TARGET_DOMAIN, cfg.num_features, cfg.cat_features)
    split = exact_split(clean, clean.columns, test_size, seed)
    train, test = split_frames(split)
    S.append_split(train, f"{out_base}/train_set", rid)
    S.append_split(test, f"{out_base}/test_set", rid)
    return rid


def _dataset_version(df: DataFrame, run_id: str | None) -> int | None:
    """S5 version of the batch read: the given run's, else the newest one."""
    v = batch_versions(df)
    if run_id not in (None, "latest"):
        v = v.where(F.col(S.RUN_ID_COL) == F.lit(run_id))
    return v.agg(F.max("version")).first()[0]


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: DataFrame          # one row: accuracy, precision, recall, f1_score, ...
    report: DataFrame           # C7
    confusion: DataFrame        # C1
    lineage: DataFrame          # S8 for train and test
    signature: str              # S9
    params: dict


def train_flow(spark: SparkSession, base: str, config: ProjectConfig | None = None,
               run_id: str | None = None, params: dict | None = None) -> TrainResult:
    """Entry B: read splits -> fit -> score the test split -> metrics."""
    cfg = config or ProjectConfig()
    p = dict(params or cfg.parameters)
    train = S.read_split(spark, f"{base}/train_set", run_id)
    test = S.read_split(spark, f"{base}/test_set", run_id)
    model = M.fit_classifier(train, cfg.num_features, cfg.cat_features, cfg.target, p)
    # Scoring runs the model over the whole test split: do it once, derive
    # the three small results, keep them (reliable checkpoint), drop the cache.
    scored = M.predict_proba(model, test.select(*cfg.feature_columns, cfg.target)).persist()
    try:
        metrics = C.classification_metrics(scored, cfg.target, "prediction", "probability") \
            .checkpoint(eager=True)
        # The three display names belong to the three-class problem only.
        three = metrics.first()["num_classes"] == 3
        report = C.classification_report(scored, cfg.target, "prediction",
                                         names=EV_CLASS_NAMES if three else None).checkpoint(eager=True)
        confusion = C.confusion_matrix(scored, cfg.target, "prediction").checkpoint(eager=True)
    finally:
        scored.unpersist()
    lineage = dataset_fingerprint(
        train, "train_set", _dataset_version(S.read_split(spark, f"{base}/train_set"), run_id)).unionByName(
        dataset_fingerprint(test, "test_set", _dataset_version(S.read_split(spark, f"{base}/test_set"), run_id)))
    return TrainResult(model, metrics, report, confusion, lineage,
                       schema_signature(train, cfg.feature_columns), p)


def metric_rows(run_id: str, metrics: DataFrame) -> DataFrame:
    """The one-row metric frame as long run_metrics rows (run_id, name, value)."""
    cols = [c for c in metrics.columns]
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
                             for c in cols]))
    return metrics.select(kv.alias("_kv")).select(F.lit(run_id).alias("run_id"), "_kv.name", "_kv.value")


def param_rows(spark: SparkSession, run_id: str, params: dict) -> DataFrame:
    return spark.createDataFrame([(run_id, k, str(v)) for k, v in params.items()],
                                 "run_id string, name string, value string")


def validation_flow(metrics: DataFrame, params: DataFrame) -> DataFrame:
    """Entry C, validation: verdict per run."""
    return G.validation_verdict(metrics, params)


def promotion_flow(candidates: DataFrame, metrics: DataFrame, versions: DataFrame,
                   events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entry C, promotion: gate with the flow's thresholds, then the alias
    events to append for approved models."""
    decisions = G.promotion_gate(candidates, metrics, versions, events,
                                 f1_min=PROMOTION_FLOW_F1_MIN, auc_min=PROMOTION_FLOW_AUC_MIN)
    return decisions, G.alias_swap_events(decisions, events)


def read_if_any(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one of this schema before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


VERSIONS_SCHEMA = "model string, version int, run_id string, registered_at timestamp"
EVENTS_SCHEMA = "model string, alias string, version int, event_seq long"


def register_run(spark: SparkSession, runs_base: str, model_name: str, run_id: str, result: TrainResult) -> None:
    """Log a training run: metrics, parameters, report, confusion matrix,
    lineage and signature, the model's next version, and a promotion
    candidate."""
    def log(df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(f"{runs_base}/{table}")

    tag = F.lit(run_id).alias("run_id")
    log(metric_rows(run_id, result.metrics), "run_metrics")
    log(param_rows(spark, run_id, result.params), "run_params")
    log(result.report.select(tag, "*"), "run_reports")
    log(result.confusion.select(tag, "*"), "run_confusions")
    log(result.lineage.select(tag, "*"), "run_lineage")
    one = spark.createDataFrame([(model_name, run_id, result.signature)], "model string, run_id string, signature string")
    log(one.select("run_id", "signature"), "run_signatures")
    existing = read_if_any(spark, f"{runs_base}/model_versions", VERSIONS_SCHEMA)
    new = one.select("model", "run_id", F.current_timestamp().alias("registered_at"))
    log(G.register_versions(new, existing), "model_versions")
    log(one.select("model", "run_id"), "candidates")


def verdict_flow(spark: SparkSession, runs_base: str) -> tuple[DataFrame, DataFrame]:
    """Entry C, validation over the run tables: (verdict per run, registry rows
    with status tag and Challenger event); both are stored by the caller."""
    verdicts = validation_flow(spark.read.parquet(f"{runs_base}/run_metrics"),
                               spark.read.parquet(f"{runs_base}/run_params"))
    events = read_if_any(spark, f"{runs_base}/alias_events", EVENTS_SCHEMA)
    return verdicts, G.challenger_events(verdicts, spark.read.parquet(f"{runs_base}/model_versions"), events)


def deployability_check(spark: SparkSession, model_path: str, table_path: str, types: dict[str, str],
                        signature: str | None = None, n: int = 100) -> DataFrame:
    """Before deployment: load the model, check the table against the training
    signature, take its newest rows, cast them strictly, predict.  Raises on an
    empty table, on a schema problem and on a value that cannot be cast."""
    table = require_rows(spark.read.parquet(table_path), table_path)
    if signature is not None:
        problems = [r for r in check_schema(table, signature).collect() if r["problem"] != "unexpected"]
        if problems:
            raise ValueError(f"schema problems: {problems}")
    newest = cast_features(last_rows(table, n), types).checkpoint(eager=True)
    if not newest.where("_rejected").isEmpty():
        raise ValueError("values that cannot be cast to the model's input types")
    return M.predict_proba(S.load_model(model_path), newest.drop("_rejected"))
