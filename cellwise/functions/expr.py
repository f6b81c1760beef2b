"""Scalar expression helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_u32(seed: int | str, cols: Iterable[str | Column]) -> Column:
    """Unsigned 32-bit hash: the first 8 hex digits of md5('seed|k1|k2...').

    Row-local and portable (DuckDB: ``('0x'||substr(md5(...),1,8))::BIGINT``),
    so a split made with it is independent of partitioning.
    """
    parts = [F.lit(str(seed))] + [_col(c).cast("string") for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def hash_bucket(seed: int | str, cols: Iterable[str | Column], modulus: int = 10000) -> Column:
    return hash_u32(seed, cols) % F.lit(modulus)


def map_literal(mapping: Mapping[Any, Any]) -> Column:
    """A MapType literal; folded to a constant by Catalyst."""
    if not mapping:
        raise ValueError("empty mapping")
    items: list[Column] = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def dict_lookup(col: str | Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """``mapping.get(col, default)`` as an expression (``try_element_at`` on a
    map literal: no join, no shuffle, stays inside whole-stage codegen)."""
    looked = F.try_element_at(map_literal(mapping), _col(col))
    return looked if default is None else F.coalesce(looked, F.lit(default))


def try_cast(col: str | Column, type_name: str) -> Column:
    """ANSI-safe cast: null instead of an error for a bad value."""
    return _col(col).try_cast(type_name)


def logistic2(raw: Column) -> Column:
    """Probability of a boosted-tree margin under logistic loss: 1/(1+exp(-2m))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * raw))


def row_digest(cols: Iterable[str | Column]) -> Column:
    """64-bit content hash of a row (order-insensitive digests sum it)."""
    return F.xxhash64(*[_col(c) for c in cols])


def format_fixed(col: str | Column, digits: int = 4) -> Column:
    """``f"{x:.{digits}f}"`` as an expression, correctly rounded.

    ``format_string('%.4f')`` rounds the *shortest decimal* form half-up
    (0.63425 -> 0.6343) while Python rounds the exact binary value
    (0.63424999.. -> 0.6342).  Here x*10^d is computed with its exact
    rounding error (Dekker's two-product), so a product that lands exactly
    on .5 is resolved by the sign of the error; exact ties go to even.
    Meant for moderate magnitudes (|x| * 10^d < 2^52).
    """
    x = _col(col).cast("double")
    a = F.abs(x)
    scale = float(10 ** digits)
    splitter = 134217729.0  # 2^27 + 1

    def split(v: Column) -> tuple[Column, Column]:
        c = v * F.lit(splitter)
        hi = c - (c - v)
        return hi, v - hi

    p = a * F.lit(scale)
    ah, al = split(a)
    bh, bl = split(F.lit(scale))
    err = ((ah * bh - p) + ah * bl + al * bh) + al * bl
    t = F.floor(p)
    half = (p - t) == F.lit(0.5)
    r = (F.when(half & (err > 0), t + 1).when(half & (err < 0), t)
          .when(half, F.when(t % 2 == 0, t).otherwise(t + 1))
          .otherwise(F.floor(p + F.lit(0.5)))).cast("bigint")
    whole = (r / F.lit(int(scale))).cast("bigint").cast("string")
    frac = F.lpad((r % F.lit(int(scale))).cast("string"), digits, "0")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    body = F.concat(sign, whole, F.lit("."), frac) if digits > 0 else F.concat(sign, whole)
    return F.when(x.isNotNull(), body)


def last_path_segment(col: str | Column) -> Column:
    """Text after the last '/' (e.g. the version of ``models:/name/3``)."""
    return F.substring_index(_col(col), "/", -1)


def float_text(v: Column) -> Column:
    """A double as Python prints it: plain digits from 1e-4 up to 1e16, else
    an exponent of at least two digits (0.0001, 10000000.0, 1e-05)."""
    text, size = v.cast("string"), F.abs(v)
    digits = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"0+\z", "")
    plain = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0\z", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    sci = F.concat(mantissa, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")),
                   F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(power).cast("string"))
    return (F.when(F.isnan(v), F.lit("nan"))
             .when(size == F.lit(float("inf")), F.when(v > 0, F.lit("inf")).otherwise(F.lit("-inf")))
             .when(~text.contains("E"), text)
             .when((size >= F.lit(1e-4)) & (size < F.lit(1e16)), plain).otherwise(sci))
