"""File and table sources / sinks."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.session import path_exists

RUN_ID_COL = "run_id"
STAMP_COL = "update_timestamp_utc"
CORRUPT_COL = "_corrupt_record"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A Parquet table ``<base>/<name>.parquet`` (or a directory of parts)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             keep_corrupt: bool = False, **options: Any) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass).

    ``enforceSchema=False`` checks header names against the schema; with
    ``keep_corrupt`` malformed lines land in ``_corrupt_record`` instead of
    silently becoming nulls.
    """
    sch = schema
    if keep_corrupt and CORRUPT_COL not in schema.fieldNames():
        sch = T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType(), True)])
    reader = (spark.read.schema(sch).option("header", str(header).lower())
              .option("enforceSchema", "false").option("mode", "PERMISSIVE"))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def read_split(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """An appended split table. ``run_id=None`` reads every batch (as the
    original does), a value reads that batch, 'latest' the newest one.

    The table is partitioned by ``run_id`` so a batch filter prunes files.
    """
    df = spark.read.parquet(path)
    if run_id is None:
        return df
    if run_id == "latest":
        from cellwise.sources.versions import batch_versions

        newest = (batch_versions(df).orderBy(F.col("version").desc()).limit(1)
                  .select(RUN_ID_COL).collect())
        if not newest:
            return df.limit(0)
        run_id = newest[0][0]
    return df.where(F.col(RUN_ID_COL) == F.lit(run_id))


def payload_schema(feature_types: Mapping[str, T.DataType]) -> T.StructType:
    record = T.StructType([T.StructField(c, t, True) for c, t in feature_types.items()])
    return T.StructType([T.StructField("dataframe_records", T.ArrayType(record), True)])


def with_corrupt(schema: T.StructType) -> T.StructType:
    """``schema`` plus the column that keeps the text of what does not parse."""
    if CORRUPT_COL in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COL, T.StringType(), True)])


def read_payloads(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Payloads as they come: dataframe_records, the text if it does not
    parse, and the file."""
    return payloads(spark.read.schema(with_corrupt(schema)).option("multiLine", str(multi_line).lower())
                    .option("columnNameOfCorruptRecord", CORRUPT_COL).json(path))


def payloads(raw: DataFrame) -> DataFrame:
    return raw.select("dataframe_records", CORRUPT_COL, F.col("_metadata.file_path").alias("file"))


def rejected_payloads(raw: DataFrame) -> DataFrame:
    """Payloads that give no records: file, reason (``malformed`` or ``no
    dataframe_records``) and text.  With those of :func:`explode_records` they
    are all payloads; an empty list of records is no reject."""
    bad = raw.where(F.col("dataframe_records").isNull())
    return bad.select("file", F.when(F.col(CORRUPT_COL).isNotNull(), "malformed").otherwise("no dataframe_records").alias("reason"),
                      F.col(CORRUPT_COL).alias("text"))


def explode_records(df: DataFrame) -> DataFrame:
    """Payload rows -> one row per record (S3 / ST1 body)."""
    return df.select(F.explode("dataframe_records").alias("_r")).select("_r.*")


def read_records(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 multi_line: bool = True) -> DataFrame:
    """S3: ``{"dataframe_records": [...]}`` payload files, one row per record.

    With a schema, text in a numeric field becomes null (PERMISSIVE) and is
    caught by ``cast_features``' rejection flag downstream.  Payloads without
    records are not among the rows: :func:`rejected_payloads` has them.
    """
    reader = spark.read.option("multiLine", str(multi_line).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return explode_records(reader.json(path))


def stamp(df: DataFrame, run_id: str) -> DataFrame:
    """The batch stamp: one timestamp per write and the shared run id."""
    return df.withColumns({STAMP_COL: F.current_timestamp(), RUN_ID_COL: F.lit(run_id)})


def append_split(df: DataFrame, path: str, run_id: str) -> None:
    """Append a stamped batch, partitioned by ``run_id`` (append only).

    ``run_id`` is made once on the driver (``uuid4().hex``) and shared by
    the train and test writes of one preparation.
    """
    stamp(df, run_id).write.mode("append").partitionBy(RUN_ID_COL).parquet(path)


def save_model(model, path: str) -> None:
    """A fitted pipeline, or a model of this library with its own tables."""
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        model.save(SparkSession.getActiveSession(), path)


def load_model(path: str):
    """S7."""
    spark = SparkSession.getActiveSession()
    if path_exists(spark, f"{path}/trees"):
        from cellwise.operators.models import BoostedClassifier

        return BoostedClassifier.load(spark, path)
    return PipelineModel.load(path)
