"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellwise.session import scratch_path

# The six ASCII white-space characters of the contracts, as a Java regex.
ASCII_SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have (names are matched without
    regard to case), so extra columns never clash with helper columns."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name = "_" + name
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    cuts the lineage, and a lost executor costs only its running tasks."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
