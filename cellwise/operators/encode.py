"""Categorical encoding.

The dictionary is a small DataFrame (column, category, code). Applying it
uses a map literal when its size is checked to be small (no join at all),
and a shuffle left join otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.functions.expr import dict_lookup

# Largest dictionary (total entries) turned into map literals on the driver.
MAX_MAP_ENTRIES = 50_000


def fit_ordinal(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sorted distinct non-null categories per column -> codes 0..k-1.

    Codes are exact ranks from ``running_totals`` over the distinct
    categories, so a column with a huge dictionary is ranked by many tasks,
    also if its categories share a long prefix.
    """
    from cellwise.functions.ranges import running_totals

    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"))
                      for c in cols])
    cats = (df.select(F.explode(pairs).alias("_kv")).select("_kv.column", "_kv.category")
              .where(F.col("category").isNotNull()).distinct())
    ranked = running_totals(cats.withColumn("_one", F.lit(1)), ["column"], ["category"], ["_one"])
    return ranked.select("column", "category", F.col("cum__one").cast("int").alias("code"))


def dictionary_maps(dictionary: DataFrame, limit: int = MAX_MAP_ENTRIES) -> dict[str, dict[str, int]]:
    """Collect a dictionary to the driver after checking its size."""
    rows = dictionary.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"dictionary has more than {limit} entries; use apply_ordinal(mode='join') "
                         "or one_hot_vector")
    maps: dict[str, dict[str, int]] = {}
    for r in rows:
        maps.setdefault(r["column"], {})[r["category"]] = int(r["code"])
    return maps


def apply_ordinal(df: DataFrame, dictionary: DataFrame | Mapping[str, Mapping[str, int]],
                  cols: Sequence[str], suffix: str = "", mode: str = "auto",
                  unknown: int = -1) -> DataFrame:
    """Replace each category by its code; unknown or null -> ``unknown``.

    ``mode='map'``/'auto' (dictionary within ``MAX_MAP_ENTRIES``): codes come
    from ``try_element_at`` on a map literal, row-local.  ``mode='join'``:
    one left join per column against the dictionary; AQE picks broadcast
    or sort-merge from runtime sizes and splits skewed categories.
    """
    if isinstance(dictionary, Mapping):
        maps = {c: dict(m) for c, m in dictionary.items()}
        mode = "map"
    elif mode in ("auto", "map"):
        try:
            maps = dictionary_maps(dictionary)
            mode = "map"
        except ValueError:
            if mode == "map":
                raise
            mode = "join"
    if mode == "map":
        exprs = {}
        for c in cols:
            m = maps.get(c) or {}
            exprs[c + suffix] = (dict_lookup(F.col(c).cast("string"), m, unknown) if m
                                 else F.lit(unknown)).cast("int")
        return df.withColumns(exprs)
    out = df
    for c in cols:
        d = dictionary.where(F.col("column") == c).select(
            F.col("category").alias(f"_cat_{c}"), F.col("code").alias(f"_code_{c}"))
        out = (out.join(d, F.col(c).cast("string") == F.col(f"_cat_{c}"), "left")
                  .withColumn(c + suffix, F.coalesce(F.col(f"_code_{c}"), F.lit(unknown)).cast("int"))
                  .drop(f"_cat_{c}", f"_code_{c}"))
    return out


def one_hot(df: DataFrame, dictionary: DataFrame | Mapping[str, Mapping[str, int]],
            cols: Sequence[str], drop_first: bool = True, passthrough: Sequence[str] | None = None,
            prefix: str = "one_hot__", remainder_prefix: str = "remainder__") -> DataFrame:
    """One int column per category (code 0 dropped when ``drop_first``),
    unknown -> all zeros; other columns pass through as ``remainder__c``.

    Output names are data-dependent, so the dictionary is read on the driver
    and must fit a schema (``MAX_MAP_ENTRIES`` columns); ``one_hot_vector``
    takes larger ones.
    """
    maps = dictionary if isinstance(dictionary, Mapping) else dictionary_maps(dictionary)
    out = []
    for c in cols:
        for cat, code in sorted((maps.get(c) or {}).items(), key=lambda t: t[1]):
            if drop_first and code == 0:
                continue
            out.append(F.when(F.col(c).cast("string") == F.lit(cat), F.lit(1)).otherwise(F.lit(0))
                       .cast("int").alias(f"{prefix}{c}_{cat}"))
    rest = [c for c in df.columns if c not in set(cols)] if passthrough is None else list(passthrough)
    out += [F.col(c).alias(f"{remainder_prefix}{c}") for c in rest]
    return df.select(*out)


def one_hot_vector(df: DataFrame, dictionary: DataFrame | Mapping[str, Mapping[str, int]],
                   col: str, out: str | None = None, drop_first: bool = True) -> DataFrame:
    """E3, vector form, for dictionaries of any size: a sparse vector per row
    with the same layout as ``one_hot`` (code 0 dropped when ``drop_first``,
    unknown -> all zeros).

    Kept categories get slots 0..m-1; the dropped first category, unknowns
    and nulls map to slot m, which ``OneHotEncoder(dropLast=True)`` drops.
    Codes come from ``apply_ordinal`` (map literal or join by size); only the
    number of categories reaches the driver.
    """
    from pyspark.ml.feature import OneHotEncoder

    if isinstance(dictionary, Mapping):
        size = len(dictionary.get(col) or {})
    else:
        size = dictionary.where(F.col("column") == col).count()
    shift = 1 if drop_first else 0
    m = max(0, size - shift)
    idx, suffix = "_oh_idx", "_oh_code"
    coded = apply_ordinal(df, dictionary, [col], suffix=suffix)
    slot = F.col(col + suffix) - F.lit(shift)
    x = coded.withColumn(idx, F.when(slot >= 0, slot).otherwise(F.lit(m)).cast("double")).drop(col + suffix)
    enc = OneHotEncoder(inputCols=[idx], outputCols=[out or f"{col}_vec"], dropLast=True,
                        handleInvalid="error")
    # The encoder takes the number of slots from the largest one it sees.
    model = enc.fit(df.sparkSession.createDataFrame([(float(m),)], f"{idx} double"))
    return model.transform(x).drop(idx)


def assembler(cat_code_cols: Sequence[str], num_cols: Sequence[str],
              output: str = "features") -> VectorAssembler:
    """Encoded categoricals first, then numerics, as one vector."""
    return VectorAssembler(inputCols=[*cat_code_cols, *num_cols], outputCol=output,
                           handleInvalid="error")


def assemble(df: DataFrame, cat_code_cols: Sequence[str], num_cols: Sequence[str],
             output: str = "features") -> DataFrame:
    """E4 applied to a frame (codes cast to double)."""
    x = df.withColumns({c: F.col(c).cast("double") for c in cat_code_cols})
    return assembler(cat_code_cols, num_cols, output).transform(x)
