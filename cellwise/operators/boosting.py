"""Second-order gradient boosting on histograms.

Features are cut into bins once; rows become blocks of small bin codes, which
stay distributed.  Where the bins have few combinations, rows with equal codes
are folded to one with their number and their labels' sums, from which all
gradients follow.  A round grows one tree per class.  Each step of it is one
job: every task walks its rows down the trees so far and sums gradients,
hessians and counts per (class, node, feature, bin); the sums are added up in
a tree of tasks, and only these histograms (nodes x bins, whatever the number
of rows) reach the driver, which picks the splits.  All classes share the
pass.  Missing values have a bin of their own and go to the side that gains
more.  Rows that fill no more than one task (ROWS_PER_TASK) would pay for
thousands of jobs: there the same steps run inside that task, in one job.

Trees grow by depth (all nodes of a level at once), or best gain first up to a
number of leaves: the nodes that a best-first order would split are searched
together until none of them is unknown, which gives the same tree as splitting
one leaf at a time.  Where the depth bounds a tree to few more leaves, its
levels are searched instead.  Of two siblings only the one of fewer rows is
summed; the other is what is left of their parent.

RDDs of blocks are used because a round's state (margins per row) is numeric
arrays that one task updates in place of a thousand column expressions; the
blocks' lineage is cut by reliable checkpoints.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Gains this close to the best (relative) are ties; the first feature and the
#: lowest cut win, so that the order of summation does not decide.
TIE = 1e-9
CHECKPOINT_ROUNDS = 25
#: Rows that one task takes; so many pass faster in it than the jobs of all
#: steps start.
ROWS_PER_TASK = 500_000
#: Codes that one task holds.
CODES_PER_TASK = 10_000_000
#: Of more, rows (about) that are worth a core that would be idle.
ROWS_PER_CORE = 20_000
#: A best-first tree is searched by levels up to so many times its leaves.
LEVEL_LEAVES = 4
#: Codes that features share, and rows there must be for each.
JOINT_CELLS, JOINT_ROWS = 8192, 32
#: Rows that go down a tree together.
WALKED_ROWS = 1 << 14
#: Cells that are searched for splits together (about).
SEARCHED_CELLS = 1 << 19
#: Rows are folded by code where this many rows or more share one on average.
FOLD_LEAST = 4
#: Rows scored together: masks of all trees for them stay in the cache.
SCORED_ROWS = 256


@dataclass(frozen=True)
class Growth:
    """How trees grow.  ``max_leaves`` None: all nodes of a level; else the
    best gain first.  ``max_depth`` below 1: unlimited."""

    rounds: int = 100
    rate: float = 0.3
    max_depth: int = 6
    max_leaves: int | None = None
    l2: float = 1.0
    min_rows: int = 1
    min_hessian: float = 1.0
    min_gain: float = 0.0
    max_bins: int = 255


#: The published defaults of the two libraries' regressors, with the settings
#: the original project gives (at least 2 rows a leaf).
DEPTH_WISE = Growth()
LEAF_WISE = Growth(rate=0.1, max_depth=-1, max_leaves=31, l2=0.0, min_rows=2, min_hessian=1e-3)


# ---------------------------------------------------------------------------
# Trees
# ---------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes as parallel lists; a leaf's feature is -1.  A row goes left if its
    code is at most the cut, or is missing and ``missing_left``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool) -> tuple[int, int]:
        left = len(self.feature)
        self.feature[node], self.cut[node], self.missing_left[node] = feature, cut, missing_left
        self.left[node], self.right[node] = left, left + 1
        for _ in range(2):
            self.feature.append(-1)
            self.cut.append(0)
            self.missing_left.append(False)
            self.left.append(0)
            self.right.append(0)
            self.value.append(0.0)
        return left, left + 1

    def leaf_of(self, codes: np.ndarray, missing: np.ndarray) -> np.ndarray:
        """The leaf of each row; ``missing`` has each feature's missing code."""
        at = np.zeros(len(codes), dtype=np.int64)
        if self.feature[0] < 0:
            return at
        feature, cut = np.array(self.feature), np.array(self.cut)
        go_left, left, right = np.array(self.missing_left), np.array(self.left), np.array(self.right)
        moving = np.arange(len(codes))
        while len(moving):
            node = at[moving]
            f = feature[node]
            code = codes[moving, f]
            is_left = np.where(code == missing[f], go_left[node], code <= cut[node])
            at[moving] = np.where(is_left, left[node], right[node])
            moving = moving[feature[at[moving]] >= 0]
        return at


def leaf_masks(trees: list[Tree], missing: np.ndarray) -> tuple[list[np.ndarray], np.ndarray] | None:
    """Per feature a table (code x tree) of the leaves, as bits, that a row of
    that code may end in, and the leaves' values (tree x 64): the leaf of a row
    is the one bit that all features leave.  None if a tree has over 64 leaves."""
    values = np.zeros((len(trees), 64))
    tables = [np.full((m + 1, len(trees)), np.uint64(2**64 - 1)) for m in missing.tolist()]
    for i, t in enumerate(trees):
        leaves: list[int] = []
        under: dict[int, int] = {}

        todo = [(0, False)]
        while todo:
            node, done = todo.pop()
            if t.feature[node] < 0:
                under[node] = 1 << len(leaves)
                leaves.append(node)
            elif done:
                under[node] = under[t.left[node]] | under[t.right[node]]
            else:
                todo += [(node, True), (t.right[node], False), (t.left[node], False)]
        if len(leaves) > 64:
            return None
        values[i, :len(leaves)] = [t.value[n] for n in leaves]
        unused = (2**64 - 1) ^ ((1 << len(leaves)) - 1)
        tables[0][:, i] ^= np.uint64(unused)
        for node, f in enumerate(t.feature):
            if f >= 0 and node in under:
                cut, last = t.cut[node] + 1, int(missing[f])
                right, left = ((2**64 - 1) ^ under[t.right[node]]), ((2**64 - 1) ^ under[t.left[node]])
                tables[f][:cut, i] &= np.uint64(right)
                tables[f][cut:last, i] &= np.uint64(left)
                tables[f][last, i] &= np.uint64(right if t.missing_left[node] else left)
    return tables, values


def _masked_sums(codes: np.ndarray, start: np.ndarray, tables: list[np.ndarray], values: np.ndarray) -> np.ndarray:
    """``start`` plus each tree's value, added in the trees' order."""
    out, flat, base = np.empty(len(codes)), values.ravel(), np.arange(len(values)) * 64
    for a in range(0, len(codes), SCORED_ROWS):
        part = codes[a:a + SCORED_ROWS]
        bits = tables[0][part[:, 0]]
        for f in range(1, len(tables)):
            bits &= tables[f][part[:, f]]
        # A power of two's exponent is its place.
        leaf = (bits.astype(np.float64).view(np.int64) >> 52) - 1023
        steps = np.empty((len(part), len(values) + 1))
        steps[:, 0], steps[:, 1:] = start[a:a + len(part)], flat[base + leaf]
        out[a:a + len(part)] = np.cumsum(steps, axis=1)[:, -1]
    return out


@dataclass
class Split:
    gain: float
    feature: int
    cut: int
    missing_left: bool


def best_splits(hists: np.ndarray, offsets: np.ndarray, how: Growth) -> list[Split | None]:
    """The split of largest gain of each node's histogram (cells x (gradient,
    hessian, rows)); a feature's last cell is its missing bin."""
    sizes = np.diff(offsets)
    step = max(1, SEARCHED_CELLS // max(1, int(offsets[-1])))
    if len(hists) > step:
        return [s for a in range(0, len(hists), step) for s in best_splits(hists[a:a + step], offsets, how)]
    total = hists[:, offsets[0]:offsets[1]].sum(axis=1)[:, None]
    gone = hists[:, offsets[1:] - 1]
    # In the order in which ties are decided: feature, missing values right or left, cut.
    sides = np.where(gone[..., 2].any(axis=0), 2, 1) if len(hists) else np.ones(len(sizes), dtype=int)
    parts, marks = [], []
    for f, (a, size) in enumerate(zip(offsets[:-1].tolist(), sizes.tolist())):
        below = np.cumsum(hists[:, a:a + size - 1], axis=1)
        for side in range(int(sides[f])):
            parts.append(below + gone[:, f:f + 1] if side else below)
            marks.append(np.stack([np.full(size - 1, f), np.full(size - 1, side), np.arange(size - 1)]))
    feature, side, cut = np.concatenate(marks, axis=1)
    left = np.concatenate(parts, axis=1)
    right = total - left
    ok = ((np.minimum(left[..., 2], right[..., 2]) >= max(how.min_rows, 1))
          & (np.minimum(left[..., 1], right[..., 1]) >= how.min_hessian))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[..., 0] ** 2 / (left[..., 1] + how.l2) + right[..., 0] ** 2 / (right[..., 1] + how.l2)
                - total[..., 0] ** 2 / (total[..., 1] + how.l2))
    gain = np.where(ok, gain, -np.inf)
    if not gain.shape[1]:
        return [None] * len(hists)
    top = gain.max(axis=1)
    found = top > how.min_gain + 1e-12
    first = np.argmax(gain >= np.where(found, top * (1 - TIE), np.inf)[:, None], axis=1)
    return [Split(float(gain[i, j]), int(feature[j]), int(cut[j]), bool(side[j])) if found[i] else None
            for i, j in enumerate(first.tolist())]


def best_split(hist: np.ndarray, offsets: np.ndarray, how: Growth) -> Split | None:
    """The split of largest gain of one node's histogram."""
    return best_splits(hist[None], offsets, how)[0]


# ---------------------------------------------------------------------------
# Bins and blocks
# ---------------------------------------------------------------------------

def bin_cuts(df: DataFrame, features: Sequence[str], max_bins: int) -> list[np.ndarray]:
    """Upper bounds of the bins but the last, ascending: every distinct value
    but the largest of a feature with up to ``max_bins``, else quantiles.  At
    most ``max_bins`` numbers a feature come to the driver."""
    known = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features]
    sizes = df.agg(*[F.approx_count_distinct(k, 0.02).alias(f"n{i}") for i, k in enumerate(known)]).first()
    few = [i for i in range(len(features)) if sizes[i] <= 1.2 * max_bins]
    cuts: dict[int, np.ndarray] = {}
    if few:
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("f"), known[i].alias("v")) for i in few])).alias("x"))
        values = (pairs.select("x.*").where(F.col("v").isNotNull()).groupBy("f").agg(F.collect_set("v").alias("v"))
                  .where(F.size("v") <= max_bins))
        cuts = {r["f"]: np.unique(r["v"])[:-1] for r in values.collect()}
        cuts |= {i: np.empty(0) for i in few if sizes[i] == 0}
    many = [i for i in range(len(features)) if i not in cuts]
    if many:
        at = [k / max_bins for k in range(1, max_bins)]
        found = df.agg(*[F.percentile_approx(known[i], at, 100 * max_bins).alias(f"q{i}") for i in many]).first()
        cuts |= {i: np.unique(found[f"q{i}"]) for i in many}
    return [cuts[i] for i in range(len(features))]


def codes_of(columns: Sequence[np.ndarray], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bin codes (rows x features); missing values get the code after the last."""
    out = np.empty((len(columns[0]) if len(columns) else 0, len(columns)), dtype=np.int32)
    for f, (v, c) in enumerate(zip(columns, cuts)):
        out[:, f] = np.where(np.isnan(v), len(c) + 1, np.searchsorted(c, v, side="left"))
    return out


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False).astype("float64") for c in batch.columns]


def _label_sums(y: np.ndarray, classes: int) -> np.ndarray:
    """Of each row the label, or one at its class."""
    return (np.trunc(y)[:, None] == np.arange(classes)).astype("float64") if classes else y[:, None]


def _codes(df: DataFrame, features: Sequence[str], label: str, cuts: list[np.ndarray], classes: int) -> DataFrame:
    """Each row's bin codes c0, c1, ... and its label's sums s0, ..."""
    width, outputs = len(features), max(1, classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            *x, y = _columns(b)
            codes, sums = codes_of(x, cuts), _label_sums(y, classes)
            yield pa.RecordBatch.from_arrays([pa.array(codes[:, f]) for f in range(width)] + [pa.array(sums[:, k]) for k in range(outputs)],
                                             names=[*[f"c{f}" for f in range(width)], *[f"s{k}" for k in range(outputs)]])

    rows = df.select(*[F.col(c).cast("double") for c in features], F.col(label).cast("double"))
    return rows.mapInArrow(run, ", ".join([*[f"c{f} int" for f in range(width)], *[f"s{k} double" for k in range(outputs)]]))


def _blocks(df: DataFrame, features: Sequence[str], label: str, cuts: list[np.ndarray], classes: int, fold: bool) -> DataFrame:
    """A row per Arrow batch, in the order given: codes, number of rows and
    their labels' sums (or rows per class) as bytes.  ``fold``: rows of equal
    codes are one, over all tasks."""
    width, outputs = len(features), max(1, classes)

    def pack(codes: np.ndarray, n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (codes, n, sums)],
                                          names=["codes", "n", "sums"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                *x, y = _columns(b)
                one = np.ones(len(y))
                yield pack(codes_of(x, cuts), one, _label_sums(y, classes))

    def repack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.stack(_columns(b), axis=1)
                yield pack(x[:, :width].astype(np.int32), x[:, width], x[:, width + 1:])

    rows, kind = df.select(*[F.col(c).cast("double") for c in features], F.col(label).cast("double")), "codes binary, n binary, sums binary"
    if not fold:
        return rows.mapInArrow(run, kind)
    keys, marks = [f"c{f}" for f in range(width)], [f"s{k}" for k in range(outputs)]
    each = _codes(df, features, label, cuts, classes)
    return each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in marks]).mapInArrow(repack, kind)


def _softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(margins: np.ndarray, sums: np.ndarray, n: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives per folded row (``n`` equal ones) and tree:
    of half the squared error (``classes`` 0, ``sums`` the labels'), or of the
    softmax log loss (``sums`` the rows of each class)."""
    if not classes:
        return n[:, None] * margins - sums, np.broadcast_to(n[:, None], margins.shape)
    p = _softmax(margins)
    return n[:, None] * p - sums, classes / (classes - 1) * n[:, None] * p * (1 - p)


def _add(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
    return b if a is None else a if b is None else a + b


class _Joint:
    """Features of few bins go together: one code names a cell of each, so a
    pass over the rows sums the cells of all, and a table tells where a code
    goes.  ``largest``: codes that a group of several may have."""

    def __init__(self, offsets: np.ndarray, largest: int):
        self.offsets, self.sizes = offsets, np.diff(offsets).tolist()
        self.groups: list[list[int]] = []
        for f in sorted(range(len(self.sizes)), key=lambda f: (-self.sizes[f], f)):
            fits = (g for g in self.groups if math.prod(self.sizes[x] for x in g) * self.sizes[f] <= largest)
            if (g := next(fits, None)) is None:
                self.groups.append(g := [])
            g.append(f)
        self.group = np.array([next(i for i, g in enumerate(self.groups) if f in g) for f in range(len(self.sizes))])
        self.cells = [math.prod(self.sizes[f] for f in g) for g in self.groups]
        #: A feature's code in each code of its group.
        self.own = {f: own.ravel() for g in self.groups for f, own in zip(g, np.indices([self.sizes[f] for f in g]))}

    def encode(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty((len(codes), len(self.groups)), dtype=np.int64, order="F")
        for i, g in enumerate(self.groups):
            out[:, i] = np.ravel_multi_index([codes[:, f] for f in g], [self.sizes[f] for f in g])
        return out

    def summed(self, i: int, each: np.ndarray, out: np.ndarray) -> None:
        """From sums per node and code of group ``i`` those per node and bin of
        its features."""
        shape = [self.sizes[f] for f in self.groups[i]]
        for axis, f in enumerate(self.groups[i]):
            before, after = math.prod(shape[:axis]), math.prod(shape[axis + 1:])
            kept = each.reshape(-1, after) @ np.ones(after) if after > 1 else each
            kept = kept.reshape(-1, before, shape[axis])
            kept = np.ones((1, before)) @ kept if before > 1 else kept
            out[..., self.offsets[f]:self.offsets[f + 1]] = kept.reshape(*each.shape[:-1], shape[axis])

    def walk(self, tree: Tree, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The rows' leaves, from their nodes ``at`` on, which move."""
        inner = np.array(tree.feature) >= 0
        if not inner[0] or not len(at):
            return at
        column, start = np.zeros(len(inner), dtype=np.int64), np.zeros(len(inner), dtype=np.int64)
        held, tables, end = np.bincount(at, minlength=len(inner)) > 0, [], 0
        for m in np.flatnonzero(inner).tolist():  # a child's number is higher
            if not held[m]:
                continue
            f = tree.feature[m]
            own, (left, right) = self.own[f], (tree.left[m], tree.right[m])
            is_left = own <= tree.cut[m]
            if tree.missing_left[m]:
                is_left |= own == self.sizes[f] - 1
            tables.append(np.where(is_left, left, right))
            column[m], start[m], end = self.group[f] * len(codes), end, end + len(own)
            held[left] = held[right] = True
        if not tables:
            return at
        flat, table = codes.ravel(order="F"), np.concatenate(tables)
        for a in range(0, len(at), WALKED_ROWS):  # that stay in the cache
            here = at[a:a + WALKED_ROWS]
            moving = np.flatnonzero(inner[here])
            while len(moving):
                node = here[moving]
                place = column[node]
                place += moving
                place += a
                to = flat[place]
                to += start[node]
                node = table[to]
                here[moving] = node
                moving = moving[inner[node]]
        return at


def _partial(block, trees: list[Tree], wanted: list[list[int]], joint: _Joint, classes: int,
             held_at: list[np.ndarray] | None = None, known: tuple | None = None) -> np.ndarray:
    """Gradients, hessians and rows per (tree, wanted node, cell) of a block.
    ``held_at``: the rows' nodes so far, which move on; ``known``: gradients
    and hessians, if they are at hand."""
    codes, n, sums, margins = block
    g, h = known or gradients(margins, sums, n, classes)
    single = bool((n == 1).all())
    parts = [np.empty(0)]
    for k, nodes in enumerate(wanted):
        if not nodes:
            continue
        at = joint.walk(trees[k], codes, held_at[k] if held_at else np.zeros(len(codes), dtype=np.int64))
        if len(trees[k].feature) == 1:
            held, at = slice(None), np.zeros(len(codes), dtype=np.int64)
        else:
            place = np.full(len(trees[k].feature), -1)
            place[nodes] = np.arange(len(nodes))
            at = place[at]
            held = np.flatnonzero(at >= 0)
            at = at[held]
        weights = [g[:, k][held], h[:, k][held] if classes else None, None if single else n[held]]
        each = np.empty((3, len(nodes), int(joint.offsets[-1])))
        for i, size in enumerate(joint.cells):
            index = at * size
            index += codes[:, i][held]
            cells = np.empty((3, len(nodes), size))
            for c in (0, 1, 2) if classes else (0, 2):
                cells[c] = np.bincount(index, weights[c], len(nodes) * size).reshape(-1, size)
            if not classes:  # a squared error's hessian is the number of rows
                cells[1] = cells[2]
            joint.summed(i, cells, each)
        parts.append(each.ravel())
    return np.concatenate(parts)


def _by_node(total: np.ndarray, wanted: list[list[int]], cells: int) -> list[dict[int, np.ndarray]]:
    out, start = [], 0
    for nodes in wanted:
        size = len(nodes) * cells
        h = np.stack([total[start + i * size:start + (i + 1) * size] for i in range(3)], axis=1).reshape(len(nodes), cells, 3)
        start += 3 * size
        out.append(dict(zip(nodes, h)))
    return out


def _histograms(state, trees: list[Tree], wanted: list[list[int]], joint: _Joint, classes: int) -> list[dict[int, np.ndarray]]:
    """Per tree: node -> histogram of its rows, in one job."""
    def partial(blocks) -> Iterator[np.ndarray]:
        total = None
        for block in blocks:
            total = _add(total, _partial(block, trees, wanted, joint, classes))
        if total is not None:
            yield total

    return _by_node(state.mapPartitions(partial).treeAggregate(None, _add, _add), wanted, int(joint.offsets[-1]))


class _Grower:
    """One tree while it grows: the best split of every searched node."""

    def __init__(self, how: Growth, offsets: np.ndarray):
        self.how, self.offsets = how, offsets
        self.tree, self.depth = Tree(), [0]
        self.splits: dict[int, Split | None] = {}
        self.totals: dict[int, np.ndarray] = {}
        self.held: dict[int, np.ndarray] = {}
        self.ends: dict[int, float] = {}
        self.parent: dict[int, int] = {}
        self.pair: dict[int, tuple[int, int]] = {}
        self.wanted = [0]

    def asked(self) -> list[int]:
        """The nodes whose rows are summed for the wanted ones: of siblings the
        one of fewer rows."""
        return sorted({min(self.pair.get(n, (n,)), key=lambda c: (self.totals[c][2], c) if c in self.totals else (0, c))
                       for n in self.wanted})

    def histograms(self, found: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """With those of the siblings: what is left of the parent."""
        out = dict(found)
        for n, h in found.items():
            for other in self.pair.get(n, ()):
                if other != n:
                    rest = self.held[self.parent[n]] - h
                    rest[rest[:, 2] == 0] = 0.0
                    out[other] = rest
        return out

    def learn(self, histograms: dict[int, np.ndarray], splits: dict[int, Split | None]) -> None:
        """Take nodes' histograms and best splits; want those of the next nodes."""
        for node, h in histograms.items():
            self.held[node] = h
            self.totals[node] = h[self.offsets[0]:self.offsets[1]].sum(axis=0)
            self.splits[node] = s = splits[node]
            if s:  # children exist from now on, chosen or not
                cells = h[self.offsets[s.feature]:self.offsets[s.feature + 1]]
                left = cells[:s.cut + 1].sum(axis=0) + (cells[-1] if s.missing_left else 0)
                children = self.tree.split(node, s.feature, s.cut, s.missing_left)
                for child, total in zip(children, (left, self.totals[node] - left)):
                    self.depth.append(self.depth[node] + 1)
                    self.totals[child], self.parent[child], self.pair[child] = total, node, children
        deep = [n for n, d in enumerate(self.depth) if 0 < self.how.max_depth <= d]
        self.splits.update(dict.fromkeys(deep, None))
        self.wanted = [n for n in self._open() if n not in self.splits]

    def _open(self) -> list[int]:
        """The leaves of the tree as far as it is known."""
        depth, leaves = self.how.max_depth, self.how.max_leaves
        if leaves is None or 0 < depth < 30 and 1 << depth <= LEVEL_LEAVES * leaves:
            return [n for n, f in enumerate(self.tree.feature) if f < 0]
        return self._best_first()[1]

    def _best_first(self) -> tuple[set[int], list[int]]:
        """Nodes split by best gain first among known ones, and the leaves."""
        ready: list[tuple[float, int]] = []
        split, leaves = set(), {0}

        def offer(n: int) -> None:
            if self.splits.get(n):
                heapq.heappush(ready, (-self.splits[n].gain, n))

        offer(0)
        while ready and len(leaves) < self.how.max_leaves:
            n = heapq.heappop(ready)[1]
            split.add(n)
            leaves.remove(n)
            for child in (self.tree.left[n], self.tree.right[n]):
                leaves.add(child)
                offer(child)
        return split, sorted(leaves)

    def finished(self) -> Tree:
        """The tree with its chosen splits only, and its leaves' values."""
        chosen = None if self.how.max_leaves is None else self._best_first()[0]
        out, todo = Tree(), [(0, 0)]
        while todo:
            old, new = todo.pop()
            if self.tree.feature[old] >= 0 and (chosen is None or old in chosen):
                pair = out.split(new, self.tree.feature[old], self.tree.cut[old], self.tree.missing_left[old])
                todo += [(self.tree.left[old], pair[0]), (self.tree.right[old], pair[1])]
            else:
                g, h, _ = self.totals[old]
                out.value[new] = float(-self.how.rate * g / (h + self.how.l2)) if h + self.how.l2 > 0 else 0.0
                self.ends[old] = out.value[new]
        return out

    def values(self) -> np.ndarray:
        """For the nodes in and under each leaf of the finished tree its value."""
        out, inside = np.zeros(len(self.depth)), np.zeros(len(self.depth), dtype=bool)
        for n in range(len(self.depth)):  # a parent's number is lower
            up = self.parent.get(n, -1)
            inside[n] = n in self.ends or (up >= 0 and inside[up])
            out[n] = self.ends[n] if n in self.ends else out[up] if inside[n] else 0.0
        return out


def _grow(find, how: Growth, offsets: np.ndarray, outputs: int) -> list[_Grower]:
    """A round: one grown tree per output, by histograms that ``find`` takes of all rows."""
    growers = [_Grower(how, offsets) for _ in range(outputs)]
    while any(g.wanted for g in growers):
        found = find([g.tree for g in growers], [g.asked() for g in growers])
        found = [g.histograms(h) for g, h in zip(growers, found)]
        splits = iter(best_splits(np.stack([h for each in found for h in each.values()]), offsets, how))
        for g, each in zip(growers, found):
            g.learn(each, {n: next(splits) for n in each})
    return growers


def _updated(trees: list[Tree], joint: _Joint):
    def run(block):
        codes, n, sums, margins = block
        steps = [np.array(t.value)[joint.walk(t, codes, np.zeros(len(codes), dtype=np.int64))] for t in trees]
        return codes, n, sums, margins + np.stack(steps, axis=1)
    return run


def _merged(blocks):
    """The blocks of a task as one."""
    parts = list(blocks)
    if parts:
        codes, *others = (np.concatenate(p) for p in zip(*parts))
        yield np.asfortranarray(codes), *others


def _rounds_in_task(how: Growth, joint: _Joint, classes: int):
    """All rounds of the rows of a single task."""
    def run(blocks) -> Iterator[list[Tree]]:
        for codes, n, sums, margins in _merged(blocks):
            cells = int(joint.offsets[-1])
            # By columns, of which each class is one.
            sums, margins = np.asfortranarray(sums), np.asfortranarray(margins)
            for _ in range(how.rounds):
                block = codes, n, sums, margins
                known = gradients(margins, sums, n, classes)
                at = [np.zeros(len(codes), dtype=np.int64) for _ in range(margins.shape[1])]

                def find(trees, wanted):
                    return _by_node(_partial(block, trees, wanted, joint, classes, at, known), wanted, cells)

                grown = _grow(find, how, joint.offsets, margins.shape[1])
                yield [g.finished() for g in grown]
                margins = margins + np.stack([g.values()[joint.walk(g.tree, codes, a)] for g, a in zip(grown, at)]).T
    return run


# ---------------------------------------------------------------------------
# Models
# ---------------------------------------------------------------------------

@dataclass
class BoostedModel:
    """Rounds of one tree per output.  ``classes`` 0: a regressor, whose
    output is ``prediction``; else the margins of a softmax."""

    features: list[str]
    cuts: list[np.ndarray]
    base: list[float]
    classes: int
    trees: list[list[Tree]] = field(default_factory=list)
    _masks: dict = field(default_factory=dict, repr=False, compare=False)

    def margins(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        codes = codes_of(columns, self.cuts)
        missing = np.array([len(c) + 1 for c in self.cuts])
        out = np.tile(np.array(self.base), (len(codes), 1))
        for k in range(len(self.base)):
            trees = [row[k] for row in self.trees]
            if not trees or not len(codes):
                continue
            if k not in self._masks:
                self._masks[k] = leaf_masks(trees, missing)
            if self._masks[k]:
                out[:, k] = _masked_sums(codes, out[:, k], *self._masks[k])
            else:
                for t in trees:
                    out[:, k] += np.array(t.value)[t.leaf_of(codes, missing)]
        return out

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_masks": {}}

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` plus the prediction (regressor: double) or the margins
        (classifier: array of doubles); Arrow batches, no shuffle."""
        model = self

        def run(*cols: pd.Series) -> pd.Series:
            m = model.margins([c.to_numpy(dtype="float64", na_value=np.nan) for c in cols])
            return pd.Series(m[:, 0]) if not model.classes else pd.Series(list(m), dtype=object)

        kind = "array<double>" if self.classes else "double"
        return df.withColumn(out, F.pandas_udf(run, kind)(*[F.col(c).cast("double") for c in self.features]))

    def tree_rows(self) -> list[tuple]:
        return [(r, k, *[list(getattr(t, f)) for f in ("feature", "cut", "missing_left", "left", "right", "value")])
                for r, row in enumerate(self.trees) for k, t in enumerate(row)]

    def save(self, spark: SparkSession, path: str) -> None:
        """Two Parquet tables: one row about the model, one row per tree."""
        about = [(self.features, [[float(v) for v in c] for c in self.cuts], [float(b) for b in self.base], self.classes)]
        spark.createDataFrame(about, "features array<string>, cuts array<array<double>>, base array<double>, classes int"
                              ).write.mode("overwrite").parquet(f"{path}/about")
        spark.createDataFrame(
            self.tree_rows(), "round int, output int, feature array<int>, cut array<int>, missing_left array<boolean>, "
            "left array<int>, right array<int>, value array<double>").write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        a = spark.read.parquet(f"{path}/about").first()
        model = cls(a["features"], [np.array(c, dtype="float64") for c in a["cuts"]], a["base"], a["classes"])
        for r in spark.read.parquet(f"{path}/trees").orderBy("round", "output").collect():
            if r["output"] == 0:
                model.trees.append([])
            model.trees[-1].append(Tree(*[list(r[f]) for f in ("feature", "cut", "missing_left", "left", "right", "value")]))
        return model


def fit_boosting(df: DataFrame, features: Sequence[str], label: str, how: Growth = DEPTH_WISE,
                 classes: int = 0) -> BoostedModel:
    """Fit ``how.rounds`` rounds on all rows with a label.

    ``classes`` 0 fits a regressor from the labels' mean; K >= 2 fits K trees a
    round from the classes' log shares (labels 0..K-1).  Null and NaN features
    are missing values.  No rows give a model of no trees and a base of zero.
    """
    rows = df.where(F.col(label).isNotNull()).select(*features, label)
    sc = df.sparkSession.sparkContext
    rows = rows.persist()
    try:
        cuts = bin_cuts(rows, features, how.max_bins)
        if classes:
            n = {int(r[0]): r[1] for r in rows.groupBy(F.col(label).cast("int")).count().collect()}
            total = sum(n.values())
            base = [math.log(max(n.get(k, 0), 1e-15) / total) if total else 0.0 for k in range(classes)]
        else:
            total, mean = rows.agg(F.count(F.lit(1)), F.avg(label)).first()
            base = [float(mean)] if total else [0.0]
        model = BoostedModel(list(features), cuts, base, classes)
        if not total or not len(features):
            return model
        offsets = np.concatenate([[0], np.cumsum([len(c) + 2 for c in cuts])])
        width = len(features)

        # No more codes than the bins have combinations, whatever the rows;
        # features that exclude each other have far fewer.
        combinations = math.prod(np.diff(offsets).tolist())
        if FOLD_LEAST * combinations > total:
            combinations = min(combinations, _codes(rows, features, label, cuts, 0).agg(
                F.approx_count_distinct(F.xxhash64(*[f"c{f}" for f in range(width)]), 0.02)).first()[0])
        fold = FOLD_LEAST * combinations <= total
        # Few rows in many small tasks would cost their start, every step.
        held = combinations if fold else total
        tasks = max(-(-held // ROWS_PER_TASK), -(-held * width // CODES_PER_TASK), 1)
        if tasks > 1:
            tasks = max(tasks, min(sc.defaultParallelism, -(-held // ROWS_PER_CORE)))
        joint = _Joint(offsets, min(JOINT_CELLS, held // tasks // JOINT_ROWS))

        def opened(r):
            codes = np.frombuffer(r["codes"], dtype=np.int32).reshape(-1, width)
            sums = np.frombuffer(r["sums"]).reshape(len(codes), -1)
            return joint.encode(codes), np.frombuffer(r["n"]), sums, np.tile(np.array(base), (len(codes), 1))

        spread = rows if fold or rows.rdd.getNumPartitions() >= tasks else rows.repartition(tasks)
        state = _blocks(spread, features, label, cuts, classes, fold).rdd.map(opened).coalesce(tasks)
        if tasks == 1:
            model.trees = state.mapPartitions(_rounds_in_task(how, joint, classes)).collect()
            return model
        state = state.mapPartitions(_merged)
        state = state.persist()
        state.count()
    finally:
        rows.unpersist()
    held = []
    for r in range(how.rounds):
        now = state
        grown = _grow(lambda trees, wanted: _histograms(now, trees, wanted, joint, classes), how, offsets, len(base))
        model.trees.append([g.finished() for g in grown])
        # Made when the next round first reads it.
        held.append(state)
        state = state.map(_updated(model.trees[-1], joint)).persist()
        if sc.getCheckpointDir() and (r + 1) % CHECKPOINT_ROUNDS == 0:
            state.checkpoint()
            state.count()
        for old in held[:-1]:
            old.unpersist()
        held = held[-1:]
    for old in [*held, state]:
        old.unpersist()
    return model


def probabilities(margins: Any) -> Any:
    """Softmax of an array column."""
    top = F.array_max(margins)
    e = F.transform(margins, lambda m: F.exp(m - top))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda t, x: t + x))


__all__ = ["Growth", "DEPTH_WISE", "LEAF_WISE", "BoostedModel", "fit_boosting", "probabilities", "best_split", "Tree"]
