"""Dataset fingerprint and schema signature."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dataset_fingerprint(df: DataFrame, name: str, version: str | int | None = None) -> DataFrame:
    """(name, version, rows, digest, schema_json) in one aggregate.

    The digest is the sum of 60 bits of each row's md5 over its values as text
    (null is the text \\N): independent of row order and partitioning, and
    another engine can repeat it for integers and text.
    """
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N")) for c in df.columns]
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(h), F.lit(0)).cast("string")
                  .alias("digest")).select(
        F.lit(name).alias("name"), F.lit(None if version is None else str(version))
        .cast("string").alias("version"), "rows", "digest",
        F.lit(df.schema.json()).alias("schema_json"))


def schema_signature(df: DataFrame, cols: Sequence[str] | None = None) -> str:
    """JSON signature [(name, type)] of the (selected) columns."""
    fields = [f for f in df.schema.fields if cols is None or f.name in set(cols)]
    if cols is not None:
        order = {c: i for i, c in enumerate(cols)}
        fields.sort(key=lambda f: order[f.name])
    return json.dumps([[f.name, f.dataType.simpleString()] for f in fields])


def check_schema(df: DataFrame, signature: str) -> DataFrame:
    """Problems of ``df`` against a signature, as rows
    (column, expected, actual, problem, bad_values).

    Names/types are compared on the driver (metadata only); values that
    cannot be cast to the expected type are counted in one aggregate.
    """
    spark = df.sparkSession
    expected = json.loads(signature)
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = {}
    castable = [(c, t) for c, t in expected if c in actual and actual[c] != t]
    if castable:
        row = df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull())
                       .alias(f"b{i}") for i, (c, t) in enumerate(castable)]).first()
        counts = {c: int(row[f"b{i}"]) for i, (c, _) in enumerate(castable)}
    rows = []
    for c, t in expected:
        if c not in actual:
            rows.append((c, t, None, "missing", None))
        elif actual[c] != t:
            rows.append((c, t, actual[c], "type", counts.get(c)))
    exp_names = {c for c, _ in expected}
    for c, t in actual.items():
        if c not in exp_names:
            rows.append((c, None, t, "unexpected", None))
    schema = T.StructType([T.StructField("column", T.StringType()),
                           T.StructField("expected", T.StringType()),
                           T.StructField("actual", T.StringType()),
                           T.StructField("problem", T.StringType()),
                           T.StructField("bad_values", T.LongType())])
    return spark.createDataFrame(rows, schema)
