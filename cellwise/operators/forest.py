"""Random forests of regression trees grown until nothing improves (M4).

Rows become bin codes and equal ones (codes and label) fold to one with their
number.  A tree's bag counts a row by a Poisson draw from a hash of its values
and the tree, so bags depend on neither partitions nor order.  A fully grown
tree has about as many leaves as its bag has distinct rows: histograms of
every node, as MLlib's forest makes them, would outgrow the rows many times,
and all trees together would outgrow the driver.  So only nodes with more than
GROUP_ROWS rows are split by histograms that all tasks add up; a smaller node's
rows meet in one group, which grows the rest of that tree.  Grown parts stay a
table, a row a part; rows to score are sent to the parts that they reach.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.operators.boosting import bin_cuts, codes_of
from cellwise.session import scratch_path

#: Rows of a node that may meet in one group.
GROUP_ROWS = 100_000
#: Equal rows that are drawn together.
DRAWN = 64
#: Blocks of so many trees leave a worker together.
TREES_SENT = 10
#: Gains below this share of the sums they are made of are rounding.
LEAST_GAIN = 1e-11

_PART = "tree int, node int, feature binary, cut binary, left binary, value binary"
_TYPES = {"feature": np.int32, "cut": np.int32, "left": np.int32, "value": np.float64}


@dataclass
class Nodes:
    """A tree, or a part of one: a leaf's feature is -1; a row goes left if its
    code is at most the cut; the right child follows the left one."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def reached(self, codes: np.ndarray) -> np.ndarray:
        at = np.zeros(len(codes), dtype=np.int64)
        moving = np.flatnonzero(self.feature[at] >= 0)
        while len(moving):
            n = at[moving]
            at[moving] = self.left[n] + (codes[moving, self.feature[n]] > self.cut[n])
            moving = moving[self.feature[at[moving]] >= 0]
        return at

    def blobs(self) -> tuple[bytes, ...]:
        return tuple(np.ascontiguousarray(getattr(self, c), dtype=t).tobytes() for c, t in _TYPES.items())


def draws(key: np.ndarray, n: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree's bag has each row: Poisson of mean ``n``, from a hash."""
    x = key.astype(np.int64).view(np.uint64) + np.uint64(((seed << 20) + tree + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)
    out = np.zeros(len(key))
    for mean in np.unique(n).tolist():
        k = np.arange(1, int(mean + 12 * mean ** 0.5) + 12)
        below = np.cumsum(np.exp(-mean + np.concatenate([[0.0], np.cumsum(np.log(mean / k))])))
        here = n == mean
        out[here] = np.searchsorted(below, u[here], side="right")
    return out


def _gains(wl, yl, w, y):
    """Sum of squares that a cut explains, and the least that counts."""
    wr, yr = w - wl, y - yl
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = yl * yl / wl + yr * yr / wr
        gain = apart - y * y / w
        return np.where((wl > 0.5) & (wr > 0.5) & (gain > LEAST_GAIN * apart), gain, 0.0)


def best_cuts(at: np.ndarray, codes: np.ndarray, w: np.ndarray, wy: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Per node 0..k-1: gain (0: none), feature and cut of its best split; the
    first feature and the lowest cut win ties."""
    total, sums = np.bincount(at, w, k), np.bincount(at, wy, k)
    gain, feature, cut = np.zeros(k), np.full(k, -1, dtype=np.int32), np.zeros(k, dtype=np.int32)

    def offer(nodes, found, f, cuts) -> None:
        better = found > gain[nodes] * (1 + 1e-9)
        n = nodes[better]
        gain[n], feature[n], cut[n] = found[better], f, cuts[better]

    every = np.arange(k)
    for f in range(codes.shape[1]):
        column = codes[:, f]
        top = int(column.max(initial=0))
        if top == 1:
            up = np.flatnonzero(column)
            wl, yl = total - np.bincount(at[up], w[up], k), sums - np.bincount(at[up], wy[up], k)
            offer(every, _gains(wl, yl, total, sums), f, np.zeros(k, dtype=np.int32))
        elif top:
            # Cells (node, code) that have rows, in order; a cut is behind each.
            cell = at * (top + 1) + column
            order = np.argsort(cell, kind="stable")
            cell = cell[order]
            first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
            cell = cell[first]
            node = cell // (top + 1)
            wl, yl = np.cumsum(np.add.reduceat(w[order], first)), np.cumsum(np.add.reduceat(wy[order], first))
            starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            past = np.searchsorted(node, node)
            wl = wl - np.where(past > 0, wl[past - 1], 0.0)
            yl = yl - np.where(past > 0, yl[past - 1], 0.0)
            found = _gains(wl, yl, total[node], sums[node])
            most = np.maximum.reduceat(found, starts)
            hit = np.flatnonzero((found >= np.repeat(most, np.diff([*starts, len(node)])) * (1 - 1e-9)) & (found > 0))
            n, lowest = np.unique(node[hit], return_index=True)
            hit = hit[lowest]
            offer(n, found[hit], f, (cell[hit] % (top + 1)).astype(np.int32))
    return gain, feature, cut


def grown(codes: np.ndarray, w: np.ndarray, wy: np.ndarray, depth: int) -> Nodes:
    """The tree over these rows, of up to ``depth`` levels of splits, all
    nodes of a level at a time."""
    # Rows of equal codes never part.
    flat = np.ascontiguousarray(codes).view(np.dtype((np.void, codes.dtype.itemsize * codes.shape[1]))).ravel()
    _, first, back = np.unique(flat, return_index=True, return_inverse=True)
    codes, w, wy = codes[first], np.bincount(back, w), np.bincount(back, wy)
    # Labels around their mean keep sums of squares exact.
    mean = wy.sum() / w.sum()
    wy = wy - w * mean
    parts: list[tuple[np.ndarray, ...]] = []
    at, k, n = np.zeros(len(w), dtype=np.int64), 1, 1
    while k:
        value = mean + np.bincount(at, wy, k) / np.bincount(at, w, k)
        if depth > 0:
            gain, feature, cut = best_cuts(at, codes, w, wy, k)
        else:
            gain, feature, cut = np.zeros(k), np.full(k, -1, dtype=np.int32), np.zeros(k, dtype=np.int32)
        split = gain > 0
        place = np.cumsum(split) - 1
        parts.append((feature, cut, np.where(split, n + 2 * place, 0), value))
        rows = np.flatnonzero(split[at])
        old = at[rows]
        codes, w, wy = codes[rows], w[rows], wy[rows]
        at = 2 * place[old] + (codes[np.arange(len(rows)), feature[old]] > cut[old])
        k = 2 * int(split.sum())
        n, depth = n + k, depth - 1
    return Nodes(*(np.concatenate(p) for p in zip(*parts)))


@dataclass
class _Top:
    """The first splits of a tree.  ``rows``: bagged rows of each leaf that is
    still to be split or grown; a leaf without any is done."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])
    rows: dict[int, int] = field(default_factory=dict)

    def nodes(self) -> Nodes:
        return Nodes(*(np.array(v) for v in (self.feature, self.cut, self.left, self.value)))


def _matrix(blobs, width: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype=kind).reshape(-1, width)


@dataclass
class ForestModel:
    """``tops``: each tree's first splits; ``parts``: what grows at their leaves."""

    features: list[str]
    cuts: list[np.ndarray]
    tops: list[Nodes]
    parts: DataFrame

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` plus the mean of its leaves over all trees.  Rows of equal
        codes are scored once."""
        width, kind, tops = len(self.features), _kind(self.cuts), self.tops
        x = df.withColumn("_forest_codes", _coded(df, self.features, self.cuts))

        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if not len(pdf):
                    continue
                codes, rows = _matrix(pdf["_forest_codes"], width, kind), []
                for tree, top in enumerate(tops):
                    at = top.reached(codes)
                    rows += [(tree, int(node), codes[at == node].tobytes()) for node in np.unique(at)]
                yield pd.DataFrame(rows, columns=["tree", "node", "codes"])

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for row in pdf.itertuples():
                    part = Nodes(*(np.frombuffer(getattr(row, c), dtype=t) for c, t in _TYPES.items()))
                    codes = _matrix([row.codes], width, kind)
                    yield pd.DataFrame({"_forest_codes": [c.tobytes() for c in codes], "p": part.value[part.reached(codes)]})

        # A row of ``sent`` has a batch's rows in one part.
        sent = x.select("_forest_codes").distinct().mapInPandas(send, "tree int, node int, codes binary")
        each = sent.join(self.parts, ["tree", "node"]).drop("tree", "node").mapInPandas(score, "_forest_codes binary, p double")
        means = each.groupBy("_forest_codes").agg(F.avg("p").alias("_forest_mean"))
        return x.join(means, "_forest_codes", "left").select(*[F.col(f"`{c}`") for c in df.columns], F.col("_forest_mean").alias(out))


def _kind(cuts: Sequence[np.ndarray]):
    return np.uint8 if max(map(len, cuts), default=0) < 256 else np.uint16


def _coded(df: DataFrame, features: Sequence[str], cuts: list[np.ndarray]) -> Column:
    """A row's bin codes as bytes; null and NaN features raise, as E4 does."""
    kind = _kind(cuts)

    def run(*cols: pd.Series) -> pd.Series:
        x = [c.to_numpy(dtype="float64", na_value=np.nan) for c in cols]
        if any(np.isnan(v).any() for v in x):
            raise ValueError("features must not be null or NaN")
        return pd.Series([c.tobytes() for c in codes_of(x, cuts).astype(kind)], dtype=object)

    return F.pandas_udf(run, "binary")(*[F.col(f"`{c}`").cast("double") for c in features])


def _middles(df: DataFrame, features: Sequence[str], max_bins: int) -> list[np.ndarray]:
    """Cuts halfway between neighbouring values where all are known, as
    MLlib's are; else quantiles."""
    cuts = bin_cuts(df, features, max_bins)
    tops = df.agg(*[F.max(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(features)]).first()
    return [(c + np.append(c[1:], top)) / 2 if 0 < len(c) < max_bins - 1 else c for c, top in zip(cuts, tops)]


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bagged(pdf: pd.DataFrame, width: int, kind, seed: int, trees: Sequence[int]):
    """Per tree the bag of a batch of rows: codes, times, and labels times these."""
    codes = _matrix(pdf["codes"], width, kind)
    key, n, y = pdf["key"].to_numpy(), pdf["n"].to_numpy(), pdf["y"].to_numpy()
    for tree in trees:
        w = draws(key, n, tree, seed)
        held = np.flatnonzero(w)
        yield tree, codes[held], w[held], w[held] * y[held]


def _split_level(rows: DataFrame, tops: list[_Top], width: int, kind, cells: int, seed: int, group_rows: int) -> bool:
    """Splits every leaf of more than ``group_rows`` rows once; False if there
    is none.  Histograms meet by node, their best cut reaches the driver."""
    wanted = {t: [n for n, r in top.rows.items() if r > group_rows] for t, top in enumerate(tops)}
    wanted = {t: nodes for t, nodes in wanted.items() if nodes}
    if not wanted:
        return False
    walk = {t: tops[t].nodes() for t in wanted}

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for pdf in batches:
            for tree, codes, w, wy in _bagged(pdf, width, kind, seed, list(wanted)):
                at = walk[tree].reached(codes)
                for node in wanted[tree]:
                    here = at == node
                    cell = (codes[here] + np.arange(width) * cells).ravel()
                    h = np.stack([np.bincount(cell, np.repeat(v, width), width * cells)
                                  for v in (w[here], wy[here], np.ones(here.sum()))])
                    held[tree, node] = held[tree, node] + h if (tree, node) in held else h
        if held:
            yield pd.DataFrame([(t, n, h.tobytes()) for (t, n), h in held.items()], columns=["tree", "node", "h"])

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        h = sum(np.frombuffer(b).reshape(3, width, cells) for b in pdf["h"])
        w, y, r = (float(v[0].sum()) for v in h)
        f, c = np.nonzero(h[0])
        cell_w, cell_y = h[0][f, c], h[1][f, c]
        # Each feature's cells by themselves, as if the others did not vary.
        best = (0.0, -1, 0)
        for i in range(width):
            _, of, cut = best_cuts(np.zeros((f == i).sum(), dtype=np.int64), c[f == i][:, None], cell_w[f == i],
                                   cell_y[f == i] - cell_w[f == i] * (y / w), 1)
            if of[0] >= 0:
                wl, yl = h[0][i, :cut[0] + 1].sum(), (h[1][i, :cut[0] + 1] - h[0][i, :cut[0] + 1] * (y / w)).sum()
                found = float(_gains(np.array([wl]), np.array([yl]), np.array([w]), np.array([0.0]))[0])
                if found > best[0] * (1 + 1e-9):
                    best = (found, i, int(cut[0]))
        i, cut = best[1:]
        wl, yl, low = (float(v[i, :cut + 1].sum()) if i >= 0 else 0.0 for v in h)
        means = (yl / wl, (y - yl) / (w - wl)) if i >= 0 else (y / w, y / w)
        return pd.DataFrame([(pdf["tree"].iloc[0], pdf["node"].iloc[0], i, cut, y / w, int(low), int(r - low), *means)],
                            columns=[c.split()[0] for c in split.split(", ")])

    split = "tree int, node int, feature int, cut int, value double, low long, high long, low_mean double, high_mean double"
    found = (rows.mapInPandas(sums, "tree int, node int, h binary").groupBy("tree", "node").applyInPandas(choose, split)
             .collect())
    for r in found:
        top = tops[r["tree"]]
        del top.rows[r["node"]]
        top.value[r["node"]] = r["value"]
        if r["feature"] < 0:
            continue
        top.feature[r["node"]], top.cut[r["node"]], top.left[r["node"]] = r["feature"], r["cut"], len(top.feature)
        for n, mean in ((r["low"], r["low_mean"]), (r["high"], r["high_mean"])):
            top.rows[len(top.feature)] = n
            for values, v in ((top.feature, -1), (top.cut, 0), (top.left, 0), (top.value, mean)):
                values.append(v)
            top.depth.append(top.depth[r["node"]] + 1)
    return True


def fit_forest(df: DataFrame, features: Sequence[str], label: str, num_trees: int = 100, max_depth: int = 30,
               seed: int = 42, max_bins: int = 255, group_rows: int = GROUP_ROWS) -> ForestModel:
    """``num_trees`` trees on bags of all rows, every feature tried at every
    split, grown until no cut of up to ``max_bins`` bins improves a node.  A
    null or NaN label or feature raises."""
    spark, width = df.sparkSession, len(features)
    cuts = _middles(df, features, max_bins)
    kind, cells = _kind(cuts), max(map(len, cuts)) + 1
    y = F.col(f"`{label}`").cast("double")
    y = F.when(y.isNull() | F.isnan(y), F.raise_error(F.lit("labels must not be null or NaN")).cast("double")).otherwise(y)
    folded = df.select(_coded(df, features, cuts).alias("codes"), y.alias("y")).groupBy("codes", "y").agg(F.count(F.lit(1)).alias("all"))
    last = ((F.col("all") - 1) / F.lit(DRAWN)).cast("long")
    rows = folded.select("codes", "y", "all", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part")).select(
        "codes", "y", F.xxhash64("codes", "y", "part").alias("key"), F.least(F.col("all") - F.col("part") * DRAWN, F.lit(DRAWN)).cast("int").alias("n"))
    rows = _stored(rows, "forest_rows")
    total = rows.count()
    if not total:
        raise ValueError("a forest needs rows")
    tops = [_Top(rows={0: total}) for _ in range(num_trees)]
    while True:
        for top in tops:  # as deep as allowed: a leaf with its mean
            for node in [n for n in top.rows if 0 < max_depth <= top.depth[n]]:
                del top.rows[node]
        if not _split_level(rows, tops, width, kind, cells, seed, group_rows):
            break
    walk, todo = [t.nodes() for t in tops], [sorted(t.rows) for t in tops]
    depths = [{n: max_depth - t.depth[n] for n in t.rows} for t in tops]

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sent: list[tuple] = []
            for tree, codes, w, wy in _bagged(pdf, width, kind, seed, range(num_trees)):
                at = walk[tree].reached(codes)
                for node in todo[tree]:
                    here = at == node
                    if here.any():
                        sent.append((tree, node, codes[here].tobytes(), w[here].tobytes(), wy[here].tobytes()))
                if sent and (tree % TREES_SENT == TREES_SENT - 1 or tree == num_trees - 1):
                    yield pd.DataFrame(sent, columns=["tree", "node", "codes", "w", "wy"])
                    sent = []

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, node = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
        part = grown(_matrix(pdf["codes"], width, kind), np.frombuffer(b"".join(pdf["w"])), np.frombuffer(b"".join(pdf["wy"])),
                     depths[tree][node])
        return pd.DataFrame([(tree, node, *part.blobs())], columns=[c.split()[0] for c in _PART.split(", ")])

    groups = sum(map(len, todo))
    parts = (rows.mapInPandas(deal, "tree int, node int, codes binary, w binary, wy binary")
             .repartition(min(2 * groups, 32 * spark.sparkContext.defaultParallelism) or 1, "tree", "node")
             .groupBy("tree", "node").applyInPandas(grow, _PART))
    # Leaves of the first splits are parts of one node.
    done = [(t, n, *Nodes(np.array([-1]), np.array([0]), np.array([0]), np.array([top.value[n]])).blobs())
            for t, top in enumerate(tops) for n, f in enumerate(top.feature) if f < 0 and n not in top.rows]
    if done:
        parts = parts.unionByName(spark.createDataFrame([(t, n, *map(bytearray, b)) for t, n, *b in done], _PART))
    return ForestModel(list(features), cuts, walk, _stored(parts, "forest_parts"))


__all__ = ["ForestModel", "fit_forest"]
