"""Projections, casts and predicates used to clean a raw table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.functions.expr import dict_lookup, try_cast


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns present in ``mapping`` (others untouched)."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def fill_sentinels(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Replace nulls (and NaN in floating columns) with per-column sentinels."""
    present = {k: v for k, v in values.items() if k in df.columns}
    return df.na.fill(present) if present else df


def filter_domain(df: DataFrame, col: str, values: Iterable[Any]) -> DataFrame:
    """Keep rows whose ``col`` is one of ``values``.

    Tests the column as stored (no cast inside the predicate) so the
    ``In`` filter reaches the Parquet/CSV scan.
    """
    return df.where(F.col(col).isin(list(values)))


def cast_target(df: DataFrame, col: str, type_name: str = "int") -> DataFrame:
    """Cast the target; a bad value becomes null instead of failing the job."""
    return df.withColumn(col, try_cast(col, type_name))


def project_features(df: DataFrame, num: Sequence[str], cat: Sequence[str],
                     target: str | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """P5: ordered projection numerics, categoricals, [target], [extra]."""
    cols = [*num, *cat, *([target] if target else []), *extra]
    return df.select(*cols)


def as_category(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Categorical typing = string values (the code dictionary is E1)."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P7."""
    return df.drop(*cols)


def cast_features(df: DataFrame, types: Mapping[str, str],
                  rejected_col: str | None = "_rejected") -> DataFrame:
    """Strict ordered select + try_cast; flags rows where a present value
    could not be cast (null input stays null and is not a rejection)."""
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"input is missing feature columns: {missing}")
    typed = {c: strict_cast(c, t) for c, t in types.items()}
    out = [e.alias(c) for c, e in typed.items()]
    if rejected_col:
        bad = None
        for c, e in typed.items():
            term = F.col(c).isNotNull() & e.isNull()
            bad = term if bad is None else (bad | term)
        out.append(bad.alias(rejected_col))
    return df.select(*out)


_INTEGRAL = ("tinyint", "smallint", "int", "integer", "bigint", "long")


def strict_cast(col: str, type_name: str) -> F.Column:
    """try_cast, except that integer types also accept integral decimal text
    ("310.0" -> 310, as a float-to-int cast of the same value would);
    "310.5" stays a rejection."""
    direct = try_cast(col, type_name)
    if type_name.lower() not in _INTEGRAL:
        return direct
    d = try_cast(col, "double")
    integral = d.isNotNull() & (d == F.floor(d))
    return F.coalesce(direct, F.when(integral, d.try_cast(type_name)))


def rejected_count(df: DataFrame, rejected_col: str = "_rejected") -> DataFrame:
    """Rows rejected by P8, as a one-row aggregate."""
    return df.agg(F.count_if(F.col(rejected_col)).alias("rejected"),
                  F.count(F.lit(1)).alias("rows"))


def to_flag(df: DataFrame, col: str, true_value: str = "Yes", out: str | None = None) -> DataFrame:
    """Text -> boolean by equality (``"No"`` is False, null stays null)."""
    return df.withColumn(out or col, F.col(col) == F.lit(true_value))


def to_int_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P10: cast encoded feature columns to int."""
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


def preview(df: DataFrame, n: int, order_cols: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows; with ``order_cols`` the result is stable
    (top-k: each task keeps n rows, no global sort)."""
    return (df.orderBy(*order_cols) if order_cols else df).limit(n)


def label_text(df: DataFrame, col: str, mapping: Mapping[Any, str], default: str | None = None,
               out: str | None = None) -> DataFrame:
    """Code -> text through a map literal, with a default."""
    return df.withColumn(out or f"{col}_label", dict_lookup(col, mapping, default))


def clean_frame(df: DataFrame, renames: Mapping[str, str], sentinels: Mapping[str, Any],
                target: str, domain: Iterable[str], num: Sequence[str], cat: Sequence[str],
                target_type: str = "int", extra: Sequence[str] = ()) -> DataFrame:
    """P1 -> P2 -> P3 -> P4 -> P5 -> P6 as one lazy plan.

    The target is tested as text, so the sentinel is never used for it: a
    null or bad target drops only its own row.
    """
    x = rename_columns(df, renames)
    x = fill_sentinels(x, {k: v for k, v in sentinels.items() if k != target})
    x = filter_domain(x, target, domain)
    x = cast_target(x, target, target_type)
    x = project_features(x, num, cat, target, extra)
    return as_category(x, cat)
