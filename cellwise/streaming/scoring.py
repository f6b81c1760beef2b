"""ST1: continuous scoring of request payload files (Structured Streaming).

Replaces the online endpoint and its smoke request: payload files
``{"dataframe_records": [...]}`` arriving in a folder are exploded, cast
strictly, scored by a fitted model and appended to a Parquet sink; payloads
that give no records go to a dead-letter sink of their own, batch by batch.
Stateless, so it scales with the number of files; the checkpoint makes
the sink exactly-once across restarts and lost executors.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.operators.models import predict_proba
from cellwise.operators.prepare import cast_features
from cellwise.sources.files import (
    CORRUPT_COL, explode_records, payload_schema, payloads, rejected_payloads, with_corrupt,
)

def payload_stream(spark: SparkSession, in_dir: str, feature_types: Mapping[str, str],
                   multi_line: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """The streaming DataFrame of payloads as they come.

    Every field is read as text so a bad value is caught by the strict cast
    (``_rejected``) instead of turning the whole record null.
    """
    schema = with_corrupt(payload_schema({c: T.StringType() for c in feature_types}))
    reader = (spark.readStream.schema(schema).option("multiLine", str(multi_line).lower())
              .option("columnNameOfCorruptRecord", CORRUPT_COL))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return payloads(reader.json(in_dir))


def request_stream(spark: SparkSession, in_dir: str, feature_types: Mapping[str, str],
                   multi_line: bool = True, max_files_per_trigger: int | None = None) -> DataFrame:
    """The streaming DataFrame of typed records: source -> explode -> strict cast."""
    src = payload_stream(spark, in_dir, feature_types, multi_line, max_files_per_trigger)
    return cast_features(explode_records(src), dict(feature_types))


def score_batch(model: PipelineModel, records: DataFrame) -> DataFrame:
    """Score one micro-batch: rejected records are kept out of the model
    and written with a null prediction, never silently scored."""
    good = records.where(~F.col("_rejected")).drop("_rejected")
    bad = records.where(F.col("_rejected")).drop("_rejected")
    scored = predict_proba(model, good)
    return scored.withColumn("rejected", F.lit(False)).unionByName(
        bad.withColumn("prediction", F.lit(None).cast("int"))
           .withColumn("probability", F.lit(None).cast("array<double>"))
           .withColumn("rejected", F.lit(True)))


def score_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint_dir: str,
                 model: PipelineModel, feature_types: Mapping[str, str],
                 multi_line: bool = True, available_now: bool = True,
                 max_files_per_trigger: int | None = None, dead_letter_dir: str | None = None):
    """ST1: run the scoring stream into a Parquet sink.

    Each micro-batch is scored inside ``foreachBatch`` and written to
    ``out_dir/batch_id=<n>`` with overwrite, so a replayed batch replaces
    its own output: exactly-once together with the checkpoint.  Payloads
    without records are written the same way to ``dead_letter_dir`` (by
    default ``out_dir`` plus ``-rejected``), with file, reason and text.
    ``available_now`` processes what is present and stops (in batches of
    ``max_files_per_trigger`` files when set); otherwise the query keeps
    running on a processing-time trigger and is returned.
    """
    stream = payload_stream(spark, in_dir, feature_types, multi_line, max_files_per_trigger)
    letters = dead_letter_dir or out_dir.rstrip("/") + "-rejected"

    def write(batch: DataFrame, batch_id: int) -> None:
        # The batch feeds the scored and the rejected rows: read it once.
        batch.persist()
        try:
            records = cast_features(explode_records(batch), dict(feature_types))
            score_batch(model, records).write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")
            rejected_payloads(batch).write.mode("overwrite").parquet(f"{letters}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.trigger(processingTime="10 seconds").start()


__all__ = ["payload_stream", "request_stream", "score_batch", "score_stream"]
