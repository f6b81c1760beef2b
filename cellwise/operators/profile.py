"""Profiling aggregates (A1-A9) and the newest-rows top-k (K1)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellwise.config import Z95

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)
_FLOATING = (T.FloatType, T.DoubleType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def shape(df: DataFrame) -> DataFrame:
    """A1: (rows, columns) as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("int"))


def _value(c: str) -> Column:
    """A numeric column as double; NaN counts as missing."""
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)


def _sketch_probs(probs: Sequence[float], accuracy: int) -> list[float]:
    """The quantiles around each wanted one that bracket it: the sketch's rank
    error is at most n/accuracy."""
    eps = 2.0 / accuracy
    return sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-eps, eps)})


def _wide_stats(df: DataFrame, cols: Sequence[str], fr: Sequence[float], accuracy: int) -> list[dict]:
    """Per column: count, mean, std, min, max and sketched quantiles ``fr``;
    one scan for all columns."""
    if not cols:
        return []
    aggs = []
    for i, c in enumerate(cols):
        v = _value(c)
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mean{i}"), F.stddev_samp(v).alias(f"std{i}"),
                 F.min(v).alias(f"min{i}"), F.max(v).alias(f"max{i}"),
                 F.percentile_approx(v, list(fr), accuracy).alias(f"sk{i}")]
    r = df.agg(*aggs).first()
    return [{k: r[f"{k}{i}"] for k in ("n", "mean", "std", "min", "max", "sk")} for i in range(len(cols))]


def _order_statistics(df: DataFrame, cols: Sequence[str], stats: Sequence[dict], probs: Sequence[float],
                      fr: Sequence[float], accuracy: int) -> list[list[float | None]]:
    """Exact linear-interpolated quantiles from the sketches' brackets.

    One scan counts the rows below and inside each bracket; the rows inside
    (a few per ``accuracy`` of the table) are folded to (target, value, count)
    and ranked by ``running_totals``, many tasks for any number of them.  A
    bracket that misses its rank is widened to the whole column.
    """
    import math

    from cellwise.functions.ranges import running_totals

    eps = 2.0 / accuracy
    targets: list[tuple[int, int, float | None, float | None]] = []
    for i, st in enumerate(stats):
        n = int(st["n"])
        at = dict(zip(fr, st["sk"])) if n else {}
        for p in probs if n else ():
            h = (n - 1) * float(p)
            lo, hi = at[min(1.0, max(0.0, p - eps))], at[min(1.0, max(0.0, p + eps))]
            targets += [(i, r, lo, hi) for r in sorted({math.floor(h), math.ceil(h)})]
    if not targets:
        return [[None] * len(probs) for _ in cols]
    counts = df.agg(*[e for j, (i, _, lo, hi) in enumerate(targets) for e in (
        F.count_if(_value(cols[i]) < F.lit(float(lo))).alias(f"b{j}"),
        F.count_if(_value(cols[i]).between(F.lit(float(lo)), F.lit(float(hi)))).alias(f"n{j}"))]).first()
    inside, ranks = [], []
    for j, (i, r, lo, hi) in enumerate(targets):
        v = _value(cols[i])
        if counts[f"b{j}"] <= r < counts[f"b{j}"] + counts[f"n{j}"]:
            cond, k = v.between(F.lit(float(lo)), F.lit(float(hi))), r - counts[f"b{j}"]
        else:
            cond, k = v.isNotNull(), r
        inside.append(F.when(cond, F.struct(F.lit(j).alias("target"), v.alias("value"))))
        ranks.append(int(k))
    found = (df.select(F.explode(F.array_compact(F.array(*inside))).alias("_c")).select("_c.target", "_c.value")
             .groupBy("target", "value").agg(F.count(F.lit(1)).alias("n")))
    ranked = running_totals(found, ["target"], ["value"], ["n"])
    k_of = F.element_at(F.array(*[F.lit(k) for k in ranks]), F.col("target") + 1)
    hit = ranked.where((F.col("cum_n") <= k_of) & (k_of < F.col("cum_n") + F.col("n")))
    value = {targets[r["target"]][:2]: float(r["value"]) for r in hit.collect()}  # one row a target
    out = []
    for i, st in enumerate(stats):
        n = int(st["n"])
        row: list[float | None] = []
        for p in probs:
            if not n:
                row.append(None)
                continue
            h = (n - 1) * float(p)
            lo, hi = value[(i, math.floor(h))], value[(i, math.ceil(h))]
            row.append(lo + (hi - lo) * (h - math.floor(h)))
        out.append(row)
    return out


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    accuracy: int = 10_000) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas / ``quantile_cont``) per
    column: (column, q_<i>...) in the order of ``probs``; null for a column
    without values.  Jobs run when this is called.

    Scans only: the data is neither shuffled nor sorted, only the rows inside
    the sketched brackets are.
    """
    cols, fr = list(cols), _sketch_probs(probs, accuracy)
    stats = _wide_stats(df, cols, fr, accuracy)
    rows = [(c, *q) for c, q in zip(cols, _order_statistics(df, cols, stats, probs, fr, accuracy))]
    schema = "column string, " + ", ".join(f"q_{i} double" for i in range(len(probs)))
    return df.sparkSession.createDataFrame(rows, schema)


def describe(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True,
             accuracy: int = 10000) -> DataFrame:
    """A2: count, mean, std (sample), min, 25%, 50%, 75%, max per numeric column.

    Layout as pandas: one row per statistic, one column per input column; a
    column without values has count 0 and nulls.  ``exact=False`` takes the
    quartiles from the sketch (one scan).  Jobs run when this is called.
    """
    cols = list(cols if cols is not None else numeric_columns(df))
    probs = [0.25, 0.5, 0.75]
    fr = _sketch_probs(probs, accuracy) if exact else probs
    stats = _wide_stats(df, cols, fr, accuracy)
    quart = (_order_statistics(df, cols, stats, probs, fr, accuracy) if exact
             else [list(st["sk"]) if st["sk"] else [None] * 3 for st in stats])
    rows = [("count", *[float(st["n"]) for st in stats])]
    rows += [(k, *[st[k] for st in stats]) for k in ("mean", "std", "min")]
    rows += [(name, *[q[j] for q in quart]) for j, name in enumerate(("25%", "50%", "75%"))]
    rows.append(("max", *[st["max"] for st in stats]))
    schema = T.StructType([T.StructField("statistic", T.StringType()),
                           *[T.StructField(c, T.DoubleType()) for c in cols]])
    return df.sparkSession.createDataFrame(rows, schema)


def column_info(df: DataFrame) -> DataFrame:
    """A3: (position, column, non_null, dtype), one aggregate pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                     F.col(f"c{i}").alias("non_null"), F.lit(t).alias("dtype"))
            for i, (c, t) in enumerate(df.dtypes)]
    return counts.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    """A4: (column, nulls); NaN counts as missing in floating columns."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, _FLOATING)}
    aggs = []
    for i, c in enumerate(df.columns):
        cond = F.col(f"`{c}`").isNull()
        if c in floating:
            cond = cond | F.isnan(F.col(f"`{c}`"))
        aggs.append(F.count_if(cond).alias(f"n{i}"))
    counts = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"))
            for i, c in enumerate(df.columns)]
    return counts.select(F.inline(F.array(*rows)))


def distinct_values(df: DataFrame, cols: Sequence[str] | None = None,
                    exclude: Sequence[str] = ()) -> DataFrame:
    """A5: (column, value) distinct pairs of the string columns, sorted
    (partial aggregation removes duplicates before the shuffle; the sort is
    a distributed range sort of the distinct pairs)."""
    cols = [c for c in (cols or string_columns(df)) if c not in set(exclude)]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in cols])
    return (df.select(F.explode(pairs).alias("_kv")).select("_kv.column", "_kv.value").distinct()
              .orderBy("column", "value"))


def require_rows(df: DataFrame, what: str = "table") -> DataFrame:
    """Raise on an empty input (reads at most one row), else return it."""
    if df.isEmpty():
        raise RuntimeError(f"{what} is empty")
    return df


def mean_curve(df: DataFrame, x: str, y: str, z: float = Z95) -> DataFrame:
    """Mean of y per x with a normal 95 % interval (the data of a line plot).

    Partial aggregation makes a heavy x value cost one combiner row per task.
    """
    g = df.where(F.col(y).isNotNull()).groupBy(x).agg(
        F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.count(F.lit(1)).alias("n"))
    half = F.lit(z) * F.col("std") / F.sqrt(F.col("n"))
    return g.select(x, "mean", "std", "n", (F.col("mean") - half).alias("ci_low"),
                    (F.col("mean") + half).alias("ci_high"))


def _mix32(h: np.ndarray) -> np.ndarray:
    """Finalising rounds of a 32-bit hash, on unsigned 32-bit numbers, in place."""
    h ^= h >> np.uint32(16)
    h *= np.uint32(2246822507)
    h ^= h >> np.uint32(13)
    h *= np.uint32(3266489909)
    h ^= h >> np.uint32(16)
    return h


def replicate_hashes(high: np.ndarray, low: np.ndarray, replicates: int) -> np.ndarray:
    """32 bits per replicate (1 on) and row, from the row's hash halves."""
    b = np.arange(1, replicates + 1, dtype=np.uint32)[:, None] * np.uint32(2654435769)
    h = _mix32(b + high.astype(np.uint32))
    h ^= low.astype(np.uint32)
    return _mix32(h)


def uniform_draws(high: np.ndarray, low: np.ndarray, replicates: int) -> np.ndarray:
    """A number in [0, 1) per replicate (1 on) and row, from the row's hash halves."""
    return replicate_hashes(high, low, replicates) / 4294967296.0


def _poisson_cdf(n: int) -> tuple[int, np.ndarray]:
    """The least number of the table and the distribution function from it on;
    the table spans twelve deviations around n."""
    span = 12 * math.sqrt(n) + 30
    k = np.arange(max(0, math.floor(n - span)), math.ceil(n + span) + 1)
    steps = math.log(n) - np.log(k[1:])
    first = k[0] * math.log(n) - n - math.lgamma(k[0] + 1)
    return int(k[0]), np.cumsum(np.exp(first + np.concatenate([[0.0], np.cumsum(steps)])))


def poisson_draws(n: int, u: np.ndarray) -> np.ndarray:
    """Poisson(n) by inverse distribution function: the sum of n draws of
    Poisson(1)."""
    least, cdf = _poisson_cdf(n)
    return least + np.minimum(np.searchsorted(cdf, u, side="right"), len(cdf) - 1)


@lru_cache(256)
def _poisson_slots(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per slot of equal leading bits: the number at its begin, the 32-bit hash
    from which it is one more (past the slot if none), and whether it rises
    again in the slot."""
    least, cdf = _poisson_cdf(n)
    # A power of two scales exactly, so hashes compare as their quotients do.
    rises = np.ceil(cdf[:-1] * 4294967296.0).astype(np.int64)
    begin = np.arange((1 << _SLOT_BITS) + 1, dtype=np.int64) << (32 - _SLOT_BITS)
    at = np.searchsorted(rises, begin, side="right")
    step = np.append(rises, 1 << 33)[at[:-1]]
    end = np.minimum(step, begin[1:]) - 1
    return (least + at[:-1]).astype(np.float64), end.astype(np.uint32), np.diff(at) > 1


def hashed_poisson(n: int, h: np.ndarray) -> np.ndarray:
    """:func:`poisson_draws` of h / 2^32 for 32-bit hashes, by table: most
    slots hold at most one step of the distribution function."""
    base, end, many = _poisson_slots(n)
    slot = (h >> np.uint32(32 - _SLOT_BITS)).astype(np.intp)
    out = base[slot]
    out += h > end[slot]
    if many.any():
        rest = np.flatnonzero(many[slot.ravel()])
        out.ravel()[rest] = poisson_draws(n, h.ravel()[rest] / 4294967296.0)
    return out


#: Leading bits of a hash that a table of draws is read by.
_SLOT_BITS = 12
#: Cells (rows times replicates) of one numpy step, which stay in a core's
#: cache, and the most copies of a
#: row that one draw stands for.
_DRAW_CELLS = 100_000
_DRAW_COPIES = 10_000_000


def _replicate_sums(replicates: int):
    """Sums of weights and weighted values per run of equal x, a row each time
    a run or the task ends; rows arrive sorted by x, and by copies within it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = weights = values = None

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [x, pa.array([weights], pa.list_(pa.float64())), pa.array([values], pa.list_(pa.float64()))],
                names=["x", "w", "wy"])

        for batch in batches:
            if not batch.num_rows:
                continue
            xs = batch.column(0)
            y, n, high, low = (batch.column(i).to_numpy() for i in (1, 2, 3, 4))
            # Where x changes; null equals null, and NaN's runs are added up later.
            changed = pc.or_(pc.xor(xs[1:].is_null(), xs[:-1].is_null()),
                             pc.fill_null(pc.not_equal(xs[1:], xs[:-1]), False))
            cuts = [0, *(np.flatnonzero(changed.to_numpy(zero_copy_only=False)) + 1).tolist(), len(xs)]
            for a, b in zip(cuts, cuts[1:]):
                if x is None or x[0].as_py() != xs[a].as_py():
                    if x is not None:
                        yield flush()
                    x = xs.slice(a, 1)
                    weights, values = np.zeros(replicates), np.zeros(replicates)
                step = max(1, _DRAW_CELLS // replicates)
                for c in range(a, b, step):
                    part = slice(c, min(b, c + step))
                    h = replicate_hashes(high[part], low[part], replicates)
                    kinds = np.unique(n[part]).tolist()
                    w = hashed_poisson(kinds[0], h) if len(kinds) == 1 else np.empty(h.shape)
                    for copies in kinds if len(kinds) > 1 else ():
                        of = n[part] == copies
                        w[:, of] = hashed_poisson(copies, np.ascontiguousarray(h[:, of]))
                    weights += w.sum(axis=1)
                    values += w @ y[part]
        if x is not None:
            yield flush()
    return run


def mean_curve_bootstrap(df: DataFrame, x: str, y: str, replicates: int = 1000, seed: int = 0,
                         level: float = 0.95) -> DataFrame:
    """A7, bootstrap variant: Poisson bootstrap of the mean per x.

    Equal (x, y) rows are exchangeable: n of them together are drawn
    Poisson(n) times, by a hash of (seed, x, y) and the replicate.  So no key
    is needed, repeated rows cost one, and the result does not depend on the
    partitioning.  Each task keeps two arrays of ``replicates`` sums for the x
    at hand; only these arrays are shuffled afterwards.  The interval is the
    percentile interval of the replicate means (a replicate that draws no row
    of a group is skipped for that group).  Null y is left out, null x is a
    group; an empty table gives an empty result.
    """
    folded = (df.where(F.col(y).isNotNull()).groupBy(F.col(x).alias("x"), F.col(y).alias("y"))
              .agg(F.count(F.lit(1)).alias("n")))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("x", "y")]))
    half = [F.conv(F.substring(digest, at, 8), 16, 10).cast("long") for at in (1, 9)]
    # More copies than a table should span are drawn in parts.
    parts = F.floor((F.col("n") - 1) / F.lit(_DRAW_COPIES)).cast("long")
    each = folded.select("x", "y", F.explode(F.sequence(F.lit(0).cast("long"), parts)).alias("part"), "n").select(
        "x", F.col("y").cast("double").alias("y"),
        F.least(F.col("n") - F.col("part") * _DRAW_COPIES, F.lit(_DRAW_COPIES)).alias("n"),
        *[F.pmod(h + F.col("part") * 40503, F.lit(1 << 32)).alias(name) for h, name in zip(half, ("high", "low"))])
    kind = folded.schema["x"].dataType.simpleString()
    sums = each.sortWithinPartitions("x", "n").mapInArrow(
        _replicate_sums(replicates), f"x {kind}, w array<double>, wy array<double>")
    per = (sums.select("x", F.posexplode(F.arrays_zip("w", "wy")).alias("b", "s"))
           .groupBy("x", "b").agg(F.try_divide(F.sum("s.wy"), F.sum("s.w")).alias("m")))
    a = (1 - level) / 2
    return per.groupBy(F.col("x").alias(x)).agg(F.percentile("m", F.lit(a)).alias("ci_low"),
                                                F.percentile("m", F.lit(1 - a)).alias("ci_high"))


def scatter_points(df: DataFrame, x: str, y: str, hue: str | None = None) -> DataFrame:
    """The projection behind a scatter plot, every row of it."""
    return df.select(*([x, y] + ([hue] if hue else [])))


def class_counts(df: DataFrame, y: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Rows per class (per group), plus the number of distinct classes."""
    g = df.groupBy(*group_cols, y).agg(F.count(F.lit(1)).alias("n"))
    if not group_cols:
        return g.withColumn("n_classes", g.agg(F.count(F.lit(1))).scalar())
    marks = [f"_g{i}" for i in range(len(group_cols))]
    sizes = g.groupBy(*[F.col(c).alias(m) for c, m in zip(group_cols, marks)]).agg(F.count(F.lit(1)).alias("n_classes"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(m)) for c, m in zip(group_cols, marks)])
    return g.join(sizes, same).drop(*marks)


def last_rows(df: DataFrame, n: int, ts_col: str | None = "update_timestamp_utc",
              tie_break: Sequence[str] = ()) -> DataFrame:
    """K1: newest ``n`` rows by ``ts_col`` (desc), ties by ``tie_break`` (desc).

    Planned as TakeOrderedAndProject: each task keeps its own top n.
    Without the column, any n rows.
    """
    if ts_col is None or ts_col not in df.columns:
        return df.limit(n)
    return df.orderBy(F.col(ts_col).desc(), *[F.col(c).desc() for c in tie_break]).limit(n)
