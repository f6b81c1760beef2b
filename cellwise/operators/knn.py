"""Exact nearest neighbours in many dimensions by pivots (M8).

Training rows go to the nearest of some pivots, with their distance to it.
For a query, the distances to all pivots bound everything by the triangle
inequality: the k smallest of (distance to a pivot + a row's distance to it)
bound the k-th neighbour's distance from above, and a cell, or a row in it,
whose lower bound is larger is never met.  So a query joins few cells, and of
these only the rows in a ring around the pivot.

Where the bounds rule out little (tens of dimensions without clusters) that
is most of all pairs, so no pair becomes a row: blocks of queries meet blocks of
cells, distances are matrix products, and a block passes on its k best only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: At most so many pivots (the square root of the rows, up to this).
MAX_PIVOTS = 4096
#: Bounds are loosened by this share, so that rounding never loses a row.
SLACK = 1e-9
#: Numbers (rows times features) of a block of training rows or queries.
BLOCK_ROWS, BLOCK_QUERIES = 1 << 20, 1 << 18
#: Queries measured together, and so many features are subtracted one by one.
STEP, FEW_FEATURES = 512, 8
_REACH = "array<struct<cell:int,low:double,high:double>>"


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Rows x pivots."""
    out = np.empty((len(x), len(pivots)))
    for j, p in enumerate(pivots):
        d = x - p
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", d, d))
    return out


def _rows(column: pd.Series, width: int) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, width))


def reach_of(to_pivots: np.ndarray, between: np.ndarray, near: np.ndarray, far: np.ndarray, k: int) -> list[list[dict]]:
    """For each query the cells that may hold one of its k nearest rows, with
    the range of distances to the pivot there.  ``near`` has each cell's k
    smallest distances (infinite where it has fewer rows), ``far`` the largest."""
    out = []
    for d in to_pivots:
        upper = np.sort((d[:, None] + near).ravel())[k - 1]
        bound = upper * (1 + SLACK) + SLACK if np.isfinite(upper) else np.inf
        own = int(d.argmin())
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = np.where(between[own] > 0, (d * d - d[own] * d[own]) / (2 * between[own]), 0.0)
        least = np.maximum.reduce([d - far, near[:, 0] - d, plane]) * (1 - SLACK) - SLACK
        out.append([{"cell": int(c), "low": float(d[c] - bound), "high": float(d[c] + bound)}
                    for c in np.flatnonzero((least <= bound) & np.isfinite(near[:, 0]))])
    return out


def _cells(train: DataFrame, width: int, k: int, max_pivots: int) -> tuple[DataFrame, dict[str, np.ndarray]]:
    """``train`` with each row's cell and distance r to its pivot, written, and
    what is known about the cells: pivots, distances between them, each cell's
    rows, k smallest distances, largest one, and box (k + 2 * width + 3 numbers
    a pivot)."""
    n = train.count()
    size = max(1, min(max_pivots, math.isqrt(n)))
    # At most max_pivots rows, chosen by a hash.
    pivots = np.array([r[0] for r in train.orderBy(F.xxhash64("tid"), "tid").limit(size).select("x").collect()],
                      dtype="float64").reshape(-1, width)
    # Cells that follow each other lie together, as far as a line can tell.
    pivots = pivots[np.argsort(_distances(pivots, pivots[:1])[:, 0], kind="stable")]

    def place(x: pd.Series) -> pd.DataFrame:
        d = _distances(_rows(x, width), pivots)
        at = d.argmin(axis=1) if len(d) else np.empty(0, dtype=int)
        return pd.DataFrame({"cell": at.astype("int32"), "r": d[np.arange(len(d)), at]})

    cells = train.select("tid", "x", "label", F.pandas_udf(place, "cell int, r double")("x").alias("p")).select(
        "tid", "x", "label", "p.cell", "p.r").checkpoint(eager=True)
    order = Window.partitionBy("cell").orderBy("r", "tid")
    low = (cells.select("cell", "r", F.row_number().over(order).alias("i")).where(F.col("i") <= k)
           .groupBy("cell").agg(F.sort_array(F.collect_list("r")).alias("near")))
    # Boxes tell most where features are few.
    boxed = range(width if width <= FEW_FEATURES else 0)
    high = cells.groupBy("cell").agg(F.max("r").alias("far"), F.count(F.lit(1)).alias("rows"),
                                     F.array(*[F.min(F.col("x")[i]) for i in boxed]).alias("low"),
                                     F.array(*[F.max(F.col("x")[i]) for i in boxed]).alias("high"))
    near, far, rows = np.full((len(pivots), k), np.inf), np.zeros(len(pivots)), np.zeros(len(pivots), dtype=np.int64)
    box = np.zeros((2, len(pivots), len(boxed)))
    for r in low.join(high, "cell").collect():
        c = r["cell"]
        near[c, :len(r["near"])], far[c], rows[c], box[0, c], box[1, c] = r["near"], r["far"], r["rows"], r["low"], r["high"]
    return cells, {"pivots": pivots, "between": _distances(pivots, pivots), "near": near, "far": far, "rows": rows, "box": box}


def knn_candidates(train: DataFrame, queries: DataFrame, width: int, k: int, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(qid, q, tid, x, label): pairs among which each query's k nearest rows
    are.  ``train`` has tid, x, label and ``queries`` qid, q (arrays of
    ``width`` numbers, without nulls); train is read several times."""
    cells, of = _cells(train, width, k, max_pivots)

    def reach(q: pd.Series) -> pd.Series:
        return pd.Series(reach_of(_distances(_rows(q, width), of["pivots"]), of["between"], of["near"], of["far"], k), dtype=object)

    asked = queries.select("qid", "q", F.explode(F.pandas_udf(reach, _REACH)("q")).alias("c")).select("qid", "q", "c.*")
    return (asked.join(cells, "cell").where(F.col("r").between(F.col("low"), F.col("high")))
            .select("qid", "q", "tid", "x", "label"))


def _box_least(q: np.ndarray, box: np.ndarray) -> np.ndarray:
    """Queries x cells: the distance to the cells' boxes."""
    out = np.zeros((len(q), box.shape[1]))
    for i in range(box.shape[2]):
        off = np.maximum(np.maximum(box[0, :, i] - q[:, i, None], q[:, i, None] - box[1, :, i]), 0.0)
        out += off * off
    return np.sqrt(out)


def _bounds(q: np.ndarray, of: dict[str, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The most that each query's k-th neighbour is away, and the least that
    the rows of each cell are (infinite for an empty cell)."""
    d, far = _distances(q, of["pivots"]), of["far"]
    upper = np.full(len(q), np.inf)
    # Cells by the distance within which all their rows lie, and single near rows.
    for a in range(0, len(q), STEP):
        part = d[a:a + STEP]
        each = (part[:, :, None] + of["near"]).reshape(len(part), -1)
        upper[a:a + STEP] = np.partition(each, min(k, each.shape[1]) - 1, axis=1)[:, k - 1] if each.shape[1] >= k else np.inf
    least = np.maximum(d - far, of["near"][:, 0] - d)
    if of["box"].shape[2]:
        least = np.maximum(least, _box_least(q, of["box"]))
    least = np.where(of["rows"] > 0, least * (1 - SLACK) - SLACK, np.inf)
    return upper * (1 + SLACK) + SLACK, least


def _squares(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared distances of pairs of rows, added feature by feature as a SQL
    expression does."""
    total = np.zeros(len(q))
    for i in range(q.shape[1]):
        d = q[:, i] - x[:, i]
        total += d * d
    return total


def _least_squares(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Queries x rows: squared distances, by rounding at most too small."""
    if q.shape[1] <= FEW_FEATURES:
        total = np.zeros((len(q), len(x)))
        for i in range(q.shape[1]):
            d = q[:, i, None] - x[:, i]
            total += d * d
        return total * (1 - SLACK)
    # Seen from the rows' middle, products lose little.
    middle = x.mean(axis=0)
    a, b = q - middle, x - middle
    qq, xx = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    both = qq[:, None] + xx
    return both - 2.0 * (a @ b.T) - SLACK * both


def nearest_of_block(q: np.ndarray, bound: np.ndarray, least: np.ndarray, x: np.ndarray, cell: np.ndarray,
                     rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, squared distance): up to k nearest rows of a block for each
    query, ties by ``rank``.  ``cell`` is ascending and numbers the columns of
    ``least``; rows beyond a query's ``bound`` may be left out."""
    found: list[tuple[np.ndarray, ...]] = []
    edges = np.flatnonzero(np.diff(cell, prepend=-1, append=-1))
    for a in range(0, len(q), STEP):
        at = np.arange(a, min(a + STEP, len(q)))
        bound2, best = bound[at] ** 2, (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))
        low2 = np.maximum(least[at], 0.0) ** 2 * (1 - SLACK)
        ends = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        # What is nearest on the whole comes first and tightens the bounds.
        for s, e in sorted(ends, key=lambda r: low2[:, cell[r[0]]].mean()):
            for s0 in range(s, e, 4 * STEP):
                rows = np.arange(s0, min(s0 + 4 * STEP, e))
                live = np.flatnonzero(low2[:, cell[s]] <= bound2)
                if not len(live):
                    continue
                near = _least_squares(q[at[live]], x[rows])
                i, j = np.nonzero(near <= bound2[live, None])
                if not len(i):
                    continue
                if len(i) > 2 * k * len(live) and len(rows) > k:
                    # The k-th smallest lower bound's row is a row, so k rows lie
                    # within the largest true distance of these k.
                    first = np.argpartition(near, k - 1, axis=1)[:, :k]
                    true = _squares(np.repeat(q[at[live]], k, axis=0), x[rows[first.ravel()]]).reshape(-1, k).max(axis=1)
                    bound2[live] = np.minimum(bound2[live], true * (1 + SLACK))
                    i, j = np.nonzero(near <= bound2[live, None])
                i, j = live[i], rows[j]
                qi, xi = np.concatenate([best[0], i]), np.concatenate([best[1], j])
                d2 = np.concatenate([best[2], _squares(q[at[i]], x[j])])
                order = np.lexsort((rank[xi], d2, qi))
                qi, xi, d2 = qi[order], xi[order], d2[order]
                start = np.flatnonzero(np.diff(qi, prepend=-1))
                size = np.diff(np.append(start, len(qi)))
                place = np.arange(len(qi)) - np.repeat(start, size)
                kth = place == k - 1
                bound2[qi[kth]] = np.minimum(bound2[qi[kth]], d2[kth])
                best = qi[place < k], xi[place < k], d2[place < k]
        found.append((at[best[0]], best[1], best[2]))
    return tuple(np.concatenate(p) for p in zip(*found)) if found else (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def nearest_rows(train: DataFrame, queries: DataFrame, width: int, k: int, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(qid, tid, label, d2): rows among which each query's k nearest are, at
    most k per query and block; arguments as :func:`knn_candidates`."""
    cells, of = _cells(train, width, k, max_pivots)
    rows = of["rows"]
    per, of_queries = max(1, BLOCK_ROWS // width), max(1, BLOCK_QUERIES // width)
    # Cells follow each other in blocks of ``per`` rows; large ones lie in many.
    start = np.cumsum(rows) - rows
    first, last = start // per, (start + np.maximum(rows, 1) - 1) // per
    shares = max(1, -(-queries.count() // of_queries))

    def block_of(cell: pd.Series, h: pd.Series) -> pd.Series:
        c = cell.to_numpy()
        return pd.Series(((start[c] + h.to_numpy() % np.maximum(rows[c], 1)) // per).astype("int32"))

    placed = cells.withColumn("block", F.pandas_udf(block_of, "int")("cell", F.xxhash64("tid", "x")))

    def blocks(q: pd.Series) -> pd.DataFrame:
        upper, least = _bounds(_rows(q, width), of, k)
        met = [np.flatnonzero(v <= u) for u, v in zip(upper, least)]
        return pd.DataFrame({"bound": upper, "blocks": [
            np.unique(np.concatenate([np.arange(first[c], last[c] + 1) if last[c] > first[c] else first[c:c + 1] for c in m])
                      if (last[m] > first[m]).any() else first[m]).astype("int32") for m in met]})

    share = F.pmod(F.xxhash64("qid", "q"), F.lit(shares)).cast("int")
    asked = queries.select("qid", "q", share.alias("share"), F.pandas_udf(blocks, "bound double, blocks array<int>")("q").alias("b"))
    asked = asked.select("qid", "q", "share", "b.bound", F.explode("b.blocks").alias("block")).checkpoint(eager=True)
    # Only pairs of blocks that meet get their rows.
    meets = asked.select(F.col("share").alias("met"), F.col("block").alias("at")).distinct()
    sides = placed.join(meets, F.col("block") == F.col("at")).groupBy("met", "at"), asked.groupBy("share", "block")
    kinds = ", ".join(f"{c} {t.simpleString()}" for c, t in
                      (("qid", queries.schema["qid"].dataType), ("tid", train.schema["tid"].dataType)))

    def run(held: pa.Table, wanted: pa.Table) -> pa.Table:
        # Ties go by training id, null first.
        held = held.take(pc.sort_indices(held, sort_keys=[("tid", "ascending")], null_placement="at_start"))
        cell = held["cell"].to_numpy()
        by_cell = np.argsort(cell, kind="stable")
        x, q = _matrix(held["x"], width)[by_cell], _matrix(wanted["q"], width)
        here = np.unique(cell)
        part = {c: v if c == "box" else v[here] for c, v in of.items() if c != "between"} | {"box": of["box"][:, here]}
        least = _bounds(q, part, k)[1] if len(q) and len(here) else np.empty((len(q), len(here)))
        i, j, d2 = nearest_of_block(q, wanted["bound"].to_numpy(), least, x, np.searchsorted(here, cell[by_cell]), by_cell, k)
        return pa.table({"qid": wanted["qid"].take(pa.array(i)), "tid": held["tid"].take(pa.array(by_cell[j])),
                         "label": held["label"].take(pa.array(by_cell[j])), "d2": d2})

    return sides[0].cogroup(sides[1]).applyInArrow(run, f"{kinds}, label double, d2 double")


def predictions(measured: DataFrame, k: int) -> DataFrame:
    """(qid, prediction): mean label of the k nearest of (qid, tid, label, d2)."""
    w = Window.partitionBy("qid").orderBy("d2", "tid")
    top = measured.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    return top.groupBy("qid").agg(F.avg("label").alias("prediction"))


def knn_by_pivots(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, train_id: str,
                  test_id: str, k: int = 5, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(test_id, prediction): mean label of the k nearest training rows
    (Euclidean, ties by training id); as :func:`models.knn_regress`."""
    feats = list(features)
    values = F.array(*[F.col(c).cast("double") for c in feats])
    known = ~F.exists("x", lambda v: v.isNull() | F.isnan(v))
    tr = train.select(F.col(train_id).alias("tid"), values.alias("x"), F.col(label).cast("double").alias("label")).where(known)
    # Of equal points only the k lowest ids can be neighbours.
    tr = (tr.withColumn("dup", F.row_number().over(Window.partitionBy("x").orderBy("tid"))).where(F.col("dup") <= k)
          .drop("dup").checkpoint(eager=True))
    every = test.select(F.col(test_id).alias("qid"), values.alias("x"))
    asked = every.where(known).select("qid", F.col("x").alias("q"))
    if tr.isEmpty():
        return every.select(F.col("qid").alias(test_id), F.lit(None).cast("double").alias("prediction"))
    found = predictions(nearest_rows(tr, asked, len(feats), k, max_pivots), k)
    return every.select("qid").distinct().join(found, "qid", "left").select(F.col("qid").alias(test_id), "prediction")


__all__ = ["knn_by_pivots", "knn_candidates", "nearest_rows", "predictions", "reach_of"]
