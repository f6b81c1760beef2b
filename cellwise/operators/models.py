"""Distributed model fitting and scoring.

Boosting (M1, M6, M9, M10) is :mod:`cellwise.operators.boosting`, exact trees
(M7) are :mod:`cellwise.operators.trees`, regression forests (M4)
:mod:`cellwise.operators.forest`.  AdaBoost.R2 is a loop of MLlib trees on
weighted resamples, and k-nearest-neighbours an exact join by grid cells or
pivots.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from itertools import accumulate
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellwise.config import GBM_PARAMETERS
from cellwise.functions.expr import hash_u32
from cellwise.operators.boosting import DEPTH_WISE, LEAF_WISE, BoostedModel, Growth, fit_boosting, probabilities
from cellwise.operators.forest import ForestModel, fit_forest
from cellwise.operators.knn import knn_by_pivots, nearest_rows, predictions
from cellwise.operators.trees import ExactTree, fit_exact_tree
from cellwise.session import path_exists

CODE_SUFFIX = "_code"


# ---------------------------------------------------------------------------
# M1-M3: 3-class boosted trees with the ordinal encoding inside the model
# ---------------------------------------------------------------------------

def ordinal_stages(train: DataFrame, cat_cols: Sequence[str]) -> list:
    """E1 + E2 as pipeline stages: sorted categories -> codes 0..k-1, unknown
    and null -> -1 (saved with the model, applied JVM-side, usable in a
    stream, for dictionaries of any size)."""
    texts, index = [f"{c}_text" for c in cat_cols], [f"{c}_index" for c in cat_cols]
    as_text = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"cast(`{c}` AS string) AS `{t}`" for c, t in zip(cat_cols, texts)) + " FROM __THIS__")
    coded = StringIndexer(inputCols=texts, outputCols=index, stringOrderType="alphabetAsc",
                          handleInvalid="keep").fit(as_text.transform(train.select(*cat_cols)))
    # The indexer gives unknown and null values the first code after the last.
    known = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"cast(if(`{i}` >= {len(labels)}, -1, `{i}`) AS int) AS `{c}{CODE_SUFFIX}`"
        for c, i, labels in zip(cat_cols, index, coded.labelsArray)) + " FROM __THIS__")
    return [as_text, coded, known]


def gbm_params(params: Mapping[str, Any]) -> dict[str, Any]:
    """Boosting parameters (learning_rate, n_estimators, max_depth) -> MLlib names."""
    return {"stepSize": float(params.get("learning_rate", 0.1)),
            "maxIter": int(params.get("n_estimators", 20)),
            "maxDepth": int(params.get("max_depth", 5))}


@dataclass
class BoostedClassifier:
    """Ordinal stages and a softmax booster over (codes, numerics)."""

    stages: PipelineModel | None
    booster: BoostedModel

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus the margins and, as pipelines name it, ``prediction``."""
        x = self.stages.transform(df) if self.stages else df
        scored = self.booster.transform(x, "_margins").select(*df.columns, "_margins")
        first = F.array_position(F.col("_margins"), F.array_max("_margins")) - 1
        return scored.withColumn("prediction", first.cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        if self.stages:
            self.stages.write().overwrite().save(f"{path}/stages")
        self.booster.save(spark, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedClassifier:
        stages = f"{path}/stages"
        return cls(PipelineModel.load(stages) if path_exists(spark, stages) else None, BoostedModel.load(spark, path))


def fit_classifier(train: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], label: str,
                   params: Mapping[str, Any] = GBM_PARAMETERS, family: str = "softmax",
                   seed: int = 42, parallelism: int = 4) -> PipelineModel | BoostedClassifier:
    """M1: ordinal codes (fit on train), then numerics -> boosted trees, one
    per class and round, leaf-wise with 31 leaves, at least 20 rows a leaf.
    ``family='gbt'`` is MLlib's one-vs-rest, ``'rf'`` its random forest.

    All rows with a label are fitted on.  A null measure is a missing value
    inside the model, as the original's trees take it; the stand-alone
    assembler (E4) raises instead.  A dictionary may have any size: it is part
    of the saved model.
    """
    codes = [c + CODE_SUFFIX for c in cat_cols]
    stages = ordinal_stages(train, cat_cols) if cat_cols else []
    p = gbm_params(params)
    if family == "softmax":
        coder = Pipeline(stages=stages).fit(train) if stages else None
        x = coder.transform(train) if coder else train
        how = Growth(rounds=p["maxIter"], rate=p["stepSize"], max_depth=p["maxDepth"], max_leaves=31, l2=0.0,
                     min_rows=int(params.get("min_child_samples", 20)), min_hessian=1e-3)
        classes = x.agg(F.max(F.col(label).cast("int"))).first()[0]
        return BoostedClassifier(coder, fit_boosting(x, [*codes, *num_cols], label, how, max(2, (classes or 0) + 1)))
    stages.append(VectorAssembler(inputCols=[*codes, *num_cols], outputCol="features",
                                  handleInvalid="keep"))
    if family == "gbt":
        gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=p["maxIter"],
                            maxDepth=p["maxDepth"], stepSize=p["stepSize"], seed=seed)
        # The binary models are independent jobs: fit them concurrently.
        stages.append(OneVsRest(classifier=gbt, featuresCol="features", labelCol="label",
                                parallelism=parallelism))
    else:
        stages.append(RandomForestClassifier(featuresCol="features", labelCol="label",
                                             maxDepth=p["maxDepth"], numTrees=100, seed=seed))
    data = train.withColumn("label", F.col(label).cast("double")).persist()
    try:
        return Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()


def _ovr_margins(model: PipelineModel, df: DataFrame) -> DataFrame | None:
    """Per-class margins of a one-vs-rest pipeline as ``_margins`` array.

    ``OneVsRestModel.transform`` persists its whole input before scoring;
    applying the binary models directly keeps scoring one pipelined stage
    (and usable on a stream)."""
    from pyspark.ml.classification import OneVsRestModel

    last = model.stages[-1]
    if not isinstance(last, OneVsRestModel):
        return None
    x = PipelineModel(stages=model.stages[:-1]).transform(df) if len(model.stages) > 1 else df
    for i, m in enumerate(last.models):
        bm = m.copy()
        bm.setFeaturesCol(last.getFeaturesCol())
        bm.setRawPredictionCol(f"_raw{i}").setPredictionCol(f"_pred{i}").setProbabilityCol(f"_prob{i}")
        x = bm.transform(x)
    margins = F.array(*[vector_to_array(f"_raw{i}")[1] for i in range(len(last.models))])
    return x.withColumn("_margins", margins)


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """M2: class per row (int): argmax of the per-class margins (first
    maximum, as one-vs-rest does)."""
    x = model.transform(df) if isinstance(model, BoostedClassifier) else _ovr_margins(model, df)
    if x is None:
        scored = model.transform(df)
        return scored.select(*df.columns, F.col("prediction").cast("int").alias(out),
                             *(["probability"] if "probability" in scored.columns else []))
    arg = F.array_position(F.col("_margins"), F.array_max(F.col("_margins"))) - 1
    return x.select(*df.columns, arg.cast("int").alias(out), "_margins")


def predict_proba(model: PipelineModel, df: DataFrame, out: str = "probability") -> DataFrame:
    """M2 + M3: prediction and class probabilities as array<double>.

    Boosted trees: the softmax of the margins.  One-vs-rest GBT margins m:
    p_c = 1/(1+exp(-2 m_c)), normalised over classes.  Other classifiers:
    their probability vector.
    """
    scored = predict(model, df)
    if isinstance(model, BoostedClassifier):
        proba = probabilities(F.col("_margins"))
    elif "probability" in scored.columns:
        proba = vector_to_array("probability")
    else:
        sig = F.transform("_margins", lambda m: F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * m)))
        total = F.aggregate(sig, F.lit(0.0), lambda acc, v: acc + v)
        proba = F.transform(sig, lambda v: v / total)
    return scored.select(*df.columns, "prediction", proba.alias(out))


# ---------------------------------------------------------------------------
# Tree regressors (library defaults mapped to MLlib)
# ---------------------------------------------------------------------------

#: Fewer rows are not worth a task of their own.
ROWS_PER_TASK = 20_000


def _vec(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` dealt over the cores if it lies in fewer tasks than it could fill:
    a table in one small file is one task of every pass over it."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    wanted = min(-(-sum(sizes) // rows_per_task), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(wanted) if wanted > len(sizes) else df


def fit_rf_regressor(df: DataFrame, features: Sequence[str], label: str, num_trees: int = 100,
                     max_depth: int = 30, seed: int = 42, max_bins: int = 255) -> ForestModel:
    """M4: forest of full-feature trees (bagging only, as the library default),
    grown to MLlib's depth limit; bags follow the rows' values, not their
    partitions."""
    return fit_forest(df, features, label, num_trees, max_depth, seed, max_bins)


#: The published defaults of plain gradient boosting: no L2, depth 3, rate 0.1.
PLAIN_BOOSTING = Growth(rate=0.1, max_depth=3, l2=0.0, min_hessian=0.0)


def fit_gbt_regressor(df: DataFrame, features: Sequence[str], label: str, max_iter: int = 100,
                      max_depth: int = 3, step_size: float = 0.1, min_instances: int = 1) -> BoostedModel:
    """M6 (defaults 100 rounds, depth 3, rate 0.1): from the mean, each round's
    tree fits the residuals by least squares."""
    how = replace(PLAIN_BOOSTING, rounds=max_iter, max_depth=max_depth, rate=step_size, min_rows=min_instances)
    return fit_boosting(df, features, label, how)


def fit_tree_regressor(df: DataFrame, features: Sequence[str], label: str, max_depth: int | None = None,
                       max_bins: int | None = None) -> PipelineModel | ExactTree:
    """M7: one tree, by default grown on every cut until none improves it;
    ``max_bins`` takes MLlib's binned tree instead (to its depth cap)."""
    if max_bins is None:
        return fit_exact_tree(df, features, label, max_depth)
    df = spread(df)
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        DecisionTreeRegressor(featuresCol="features", labelCol=label, maxDepth=30 if max_depth is None else max_depth,
                              maxBins=max_bins)]).fit(df)


def fit_xgb_like_regressor(df: DataFrame, features: Sequence[str], label: str, max_iter: int = 100,
                           how: Growth = DEPTH_WISE) -> BoostedModel:
    """M9: second-order boosting by depth (100 rounds, depth 6, rate 0.3, L2 1)."""
    return fit_boosting(df, features, label, replace(how, rounds=max_iter))


def fit_lgbm_like_regressor(df: DataFrame, features: Sequence[str], label: str, max_iter: int = 100,
                            how: Growth = LEAF_WISE) -> BoostedModel:
    """Second-order boosting, best leaf first (100 rounds, 31 leaves, rate
    0.1, at least 2 rows a leaf)."""
    return fit_boosting(df, features, label, replace(how, rounds=max_iter))


# ---------------------------------------------------------------------------
# M5: AdaBoost.R2 (Drucker 1997, linear loss) as a loop of weighted trees
# ---------------------------------------------------------------------------

@dataclass
class AdaBoostR2Model:
    features: list[str]
    trees: list[DecisionTreeRegressionModel] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Weighted median of the trees' predictions (row-local array ops)."""
        x = _vec(df, self.features, "_ab_features")
        for i, t in enumerate(self.trees):
            x = t.copy().setFeaturesCol("_ab_features").setPredictionCol(f"_ab_p{i}").transform(x)
        pairs = F.array(*[F.struct(F.col(f"_ab_p{i}").alias("p"), F.lit(float(w)).alias("w"))
                          for i, w in enumerate(self.weights)])
        srt = F.array_sort(pairs, lambda a, b: F.when(a.p < b.p, -1).when(a.p > b.p, 1).otherwise(0))
        half = F.lit(0.5 * sum(self.weights))
        init = F.struct(F.lit(0.0).alias("acc"), F.lit(None).cast("double").alias("res"))
        med = F.aggregate(
            srt, init,
            lambda s, e: F.struct((s.acc + e.w).alias("acc"),
                                  F.coalesce(s.res, F.when(s.acc + e.w >= half, e.p)).alias("res")),
            lambda s: s.res)
        return x.select(*df.columns, med.alias(out))


def hashed_draws(spark: SparkSession, n: int, seed: int, round_no: int) -> DataFrame:
    """(draw, u): n numbers in [0, 1) from a hash of (seed, round, draw)."""
    return spark.range(n).select(F.col("id").alias("draw"),
                                 (hash_u32(seed, [F.lit(round_no), F.col("id")]) / float(1 << 32)).alias("u"))


def in_order(rows: DataFrame, key_cols: Sequence[str], n: int) -> DataFrame:
    """``rows`` (``n``) written once in the order of ``key_cols``, with their
    place ``_at``: the bucket of the order (upper bits) and the place in it."""
    buckets = max(1, min(-(-n // ROWS_PER_TASK), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    keys = [*key_cols, "_tie"]
    return (rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(buckets, *keys)
            .sortWithinPartitions(*keys).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
            .checkpoint(eager=True))


def resample(rows: DataFrame, draws: DataFrame, n: int, key_cols: Sequence[str] = (), weight: str = "_w") -> DataFrame:
    """``rows`` that are drawn, with how often (``_copies``): draws with
    replacement by weight, each draw the row whose share of the running total
    of weights (in the order of ``key_cols``) holds it.

    Rows of :func:`in_order` come with their place; others are put in order
    first.  The buckets' totals tell a draw its bucket, and inside of a bucket
    rows and draws are sorted together: a row's draws are those from its own
    place in the total to the next row's.
    """
    columns = rows.columns
    if "_at" not in columns:
        rows = in_order(rows, key_cols, n)
    rows = rows.where(F.col(weight) > 0).withColumn("_bucket", F.shiftright("_at", 33))
    sums = sorted(rows.groupBy("_bucket").agg(F.sum(weight)).collect())
    if not sums:
        return rows.select(*columns, F.lit(0).cast("long").alias("_copies")).limit(0)
    ends = [*accumulate(float(w) for _, w in sums)]
    starts = [0.0, *ends[:-1]]
    buckets = F.broadcast(rows.sparkSession.createDataFrame(
        [(float(i), b, t) for i, ((b, _), t) in enumerate(zip(sums, starts))], "_n double, _bucket long, _start double"))
    before = Window.partitionBy("_bucket").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum(weight).over(before), F.lit(0.0))).join(buckets, "_bucket").select(
        *rows.columns, (F.col("_start") + F.col("_before")).alias("_t"), F.lit(0).alias("_hit"))
    hits = draws.select((F.col("u") * F.lit(ends[-1])).alias("_t"), F.lit(1).alias("_hit"))
    hits = (Bucketizer(splits=[-math.inf, *starts[1:], math.inf], inputCol="_t", outputCol="_n").transform(hits)
            if len(sums) > 1 else hits.withColumn("_n", F.lit(0.0)))
    hits = hits.join(buckets, "_n").select("_t", "_hit", "_bucket")
    # From the end of a bucket: the draws behind a row, less those behind the next row.
    back = Window.partitionBy("_bucket").orderBy(F.desc("_t"), F.desc("_hit"), F.desc("_at"))
    both = placed.unionByName(hits, allowMissingColumns=True).withColumn(
        "_behind", F.sum("_hit").over(back.rowsBetween(Window.unboundedPreceding, 0))).where("_hit = 0")
    copies = F.col("_behind") - F.lag("_behind", 1, 0).over(back)
    return both.select(*columns, copies.alias("_copies")).where(F.col("_copies") > 0)


def adaboost_round(x: DataFrame, n: int, seed: int, round_no: int, order: Sequence[str], max_depth: int = 3,
                   max_bins: int = 32) -> tuple[DecisionTreeRegressionModel, DataFrame, DataFrame, float, float, float]:
    """One round over ``x`` (_ab_features, _y, _w and the columns of
    ``order``): the tree, the drawn rows, all rows with the absolute error
    ``_e``, the largest error, the weighted mean error and the weights' sum."""
    sample = resample(x, hashed_draws(x.sparkSession, n, seed, round_no), n, order)
    drawn = sample.select("_ab_features", "_y", F.col("_copies").cast("double").alias("_copies")).persist()
    tree = DecisionTreeRegressor(featuresCol="_ab_features", labelCol="_y", weightCol="_copies", maxDepth=max_depth,
                                 maxBins=max_bins, predictionCol="_p").fit(drawn)
    drawn.unpersist()
    scored = tree.transform(x).withColumn("_e", F.abs(F.col("_p") - F.col("_y")))
    st = scored.agg(F.max("_e").alias("m"), F.sum(F.col("_w") * F.col("_e")).alias("we"), F.sum("_w").alias("w")).first()
    total = float(st["w"])
    return tree, sample, scored, float(st["m"] or 0.0), float(st["we"]) / total, total


def fit_adaboost_regressor(df: DataFrame, features: Sequence[str], label: str,
                           n_estimators: int = 50, learning_rate: float = 1.0, max_depth: int = 3,
                           seed: int = 42, key_cols: Sequence[str] = (), max_bins: int = 32) -> AdaBoostR2Model:
    """M5: each round draws as many rows as there are, with replacement by
    weight, fits a depth-3 tree on them, measures the linear loss over all
    rows with one aggregate, and updates the weights as a column expression.

    Draws are a hash of the round, taken in the order of ``key_cols`` (else of
    features and label), so the result does not depend on the partitioning as
    far as these tell rows apart.  The rows are put in that order once; each
    round's weights are written by a reliable checkpoint.
    """
    order = [*key_cols] or [*features, label]
    marks = [f"_o{i}" for i in range(len(order))]
    x = _vec(df, features, "_ab_features").select(
        "_ab_features", F.col(label).cast("double").alias("_y"), *[F.col(c).alias(m) for c, m in zip(order, marks)],
        F.lit(1.0).alias("_w"))
    n = x.count()
    x = in_order(x, marks, n)
    model = AdaBoostR2Model(list(features))
    for i in range(n_estimators if n else 0):
        tree, _, scored, largest, mean_error, total = adaboost_round(x, n, seed, i, marks, max_depth, max_bins)
        err = mean_error / largest if largest > 0.0 else 0.0
        if err <= 0.0:  # a perfect tree ends the rounds
            model.trees.append(tree)
            model.weights.append(1.0)
            break
        if err >= 0.5:  # no better than chance
            if not model.trees:
                model.trees.append(tree)
                model.weights.append(1.0)
            break
        beta = err / (1.0 - err)
        model.trees.append(tree)
        model.weights.append(learning_rate * math.log(1.0 / beta))
        if i < n_estimators - 1:
            x = scored.select("_ab_features", "_y", "_at", next_weight(beta, largest, total, learning_rate).alias("_w")
                              ).checkpoint(eager=True)
    return model


def next_weight(beta: float, largest: float, total: float, learning_rate: float = 1.0) -> Column:
    """A row's weight after a round: its share, times beta to the closeness of
    its prediction."""
    factor = F.pow(F.lit(beta), (F.lit(1.0) - F.col("_e") / F.lit(largest)) * F.lit(learning_rate))
    return F.col("_w") / F.lit(total) * factor


# ---------------------------------------------------------------------------
# M8: exact k-nearest-neighbour regression by a multi-resolution grid join
# ---------------------------------------------------------------------------

def knn_regress(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                train_id: str, test_id: str, k: int = 5, grid_cols: Sequence[str] | None = None,
                start_fraction: float = 1.0, dense_factor: int = 4) -> DataFrame:
    """M8: mean label of the k nearest training rows (Euclidean; ties by
    training id), for every test row. Returns (test_id, prediction); null for
    a test row with a null or NaN feature.  Training rows with one are no
    neighbours.

    With more than two features (and no ``grid_cols``) the work is done by
    :func:`cellwise.operators.knn.knn_by_pivots`.

    No cross join: training rows are bucketed into grid cells on two
    coordinates (by default the two with the largest spread); each query
    joins the 3x3 cells around its own (an equi join on cell id).  A query is
    final once its k-th squared distance is within w^2 for the cell width w,
    because every nearer row lies in those cells; other queries retry with 2w.
    Widths that no pending query needs are skipped.  To a query far outside
    of the training box the rows along a whole edge are almost equally near,
    so queries outside meet the cells that their distances to the cells' boxes
    leave, in blocks (:func:`cellwise.operators.knn.nearest_rows`).

    Skew: identical training points beyond their k lowest ids are dropped
    first (they can never be selected), so a heavily repeated point is one
    small group; and a query whose cell holds more than ``dense_factor``*k
    training rows starts at a proportionally finer width.
    """
    import itertools

    feats = list(features)
    if len(feats) > 2 and grid_cols is None:
        return knn_by_pivots(train, test, feats, label, train_id, test_id, k)

    def known(prefix: str = "") -> Column:
        ok = F.lit(True)
        for c in feats:
            ok = ok & F.col(prefix + c).isNotNull() & ~F.isnan(prefix + c)
        return ok

    tr = (train.select(F.col(train_id).alias("_tid"), *[F.col(c).cast("double").alias(c) for c in feats],
                       F.col(label).cast("double").alias("_label"))
               .where(known())
               .withColumn("_dup", F.row_number().over(Window.partitionBy(*feats).orderBy("_tid")))
               .where(F.col("_dup") <= k).drop("_dup")).checkpoint(eager=True)
    every = test.select(F.col(test_id).alias("_qid"), *[F.col(c).cast("double").alias(f"q_{c}") for c in feats])
    nothing = every.where(~known("q_")).select("_qid", F.lit(None).cast("double").alias("prediction"))
    qs = every.where(known("q_"))
    if grid_cols:
        g = list(grid_cols)
    else:
        # Grid on the two coordinates with the largest spread: they dominate
        # the distance and prune best (one aggregate over the features).
        sd = tr.agg(*[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(feats)]).first()
        ranked = sorted(range(len(feats)), key=lambda i: -(sd[f"s{i}"] or 0.0))
        g = [feats[i] for i in sorted(ranked[:2])]
    d = len(g)
    st = tr.agg(F.count(F.lit(1)).alias("n"), *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(g)],
                *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(g)]).first()
    n = int(st["n"] or 0)
    if n == 0:
        return every.select(F.col("_qid").alias(test_id), F.lit(None).cast("double").alias("prediction"))
    lows, highs = [float(st[f"lo_{i}"]) for i in range(d)], [float(st[f"hi_{i}"]) for i in range(d)]
    spans = [hi - lo for lo, hi in zip(lows, highs)]
    full = max(spans) or 1.0
    # Width where a cell holds about k rows on average: a disc of that radius
    # holds about pi*k rows, so most queries resolve in the first round.
    vol = 1.0
    for sp in spans:
        vol *= max(sp, full / max(n, 1))
    w0 = max((vol * k / n) ** (1.0 / d) * start_fraction, full * 1e-9)

    def cells(prefix: str, width: float) -> list:
        return [F.floor((F.col(f"{prefix}{c}") - F.lit(lo)) / F.lit(width)).cast("long").alias(f"_c{i}")
                for i, (c, lo) in enumerate(zip(g, lows))]

    inside = F.lit(True)
    for c, lo, hi in zip(g, lows, highs):
        inside = inside & F.col(f"q_{c}").between(lo, hi)
    outside, qs = qs.where(~inside), qs.where(inside)
    # Density: training rows in each query's own cell at w0 -> extra halvings.
    occ = tr.groupBy(*cells("", w0)).agg(F.count(F.lit(1)).alias("_occ"))
    qd = qs.select("*", *cells("q_", w0)).join(occ, [f"_c{i}" for i in range(d)], "left")
    halv = F.when(F.col("_occ") > F.lit(dense_factor * k),
                  F.ceil(F.log2(F.col("_occ") / F.lit(float(dense_factor * k))) / F.lit(float(d))))
    # _level: the cell width is w0 * 2^_level
    pending = qd.select(*qs.columns, (-F.coalesce(halv, F.lit(0))).cast("int").alias("_level")).checkpoint(eager=True)

    neighbours = list(itertools.product(*[(-1, 0, 1)] * d))
    nb = F.explode(F.array(*[F.array(*[F.lit(o) for o in off]) for off in neighbours])).alias("_off")
    dist = None
    for c in feats:
        dd = F.col(f"q_{c}") - F.col(c)
        dist = dd * dd if dist is None else dist + dd * dd
    results = []
    while True:
        level = pending.agg(F.min("_level")).first()[0]
        if level is None:
            break
        width = w0 * 2.0 ** level
        active = pending.where(F.col("_level") == F.lit(level))
        cells_t = tr.select("*", *cells("", width))
        cells_q = (active.select("*", nb, *[c.alias(f"_m{i}") for i, c in enumerate(cells("q_", width))])
                   .select("*", *[(F.col(f"_m{i}") + F.col("_off")[i]).alias(f"_c{i}") for i in range(d)])
                   .drop("_off", *[f"_m{i}" for i in range(d)]))
        cand = cells_q.join(cells_t, [f"_c{i}" for i in range(d)]).select(
            "_qid", "_tid", "_label", dist.alias("_d2"))
        w = Window.partitionBy("_qid").orderBy("_d2", "_tid")
        top = cand.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
        per = top.groupBy("_qid").agg(F.count(F.lit(1)).alias("_n"), F.max("_d2").alias("_kd2"),
                                      F.avg("_label").alias("prediction"))
        # From twice the box on, the cells around a query hold every row.
        done = per if width >= 2 * full else per.where(
            (F.col("_n") == min(k, n)) & (F.col("_kd2") <= F.lit(width * width)))
        done = done.select("_qid", "prediction").checkpoint(eager=True)
        results.append(done)
        pending = (pending.join(done.select("_qid"), "_qid", "left_anti")
                   .withColumn("_level", F.greatest(F.col("_level"), F.lit(level + 1))).checkpoint(eager=True))
    far = F.array(*[F.col(f"q_{c}") for c in feats]).alias("q")
    outside = outside.select(F.col("_qid").alias("qid"), far).checkpoint(eager=True)
    if not outside.isEmpty():
        rows = tr.select(F.col("_tid").alias("tid"), F.array(*feats).alias("x"), F.col("_label").alias("label"))
        results.append(predictions(nearest_rows(rows, outside, len(feats), k), k).toDF("_qid", "prediction"))
    out = nothing
    for res in results:
        out = out.unionByName(res)
    return out.select(F.col("_qid").alias(test_id), "prediction")


# ---------------------------------------------------------------------------
# Fit every regressor, score the test rows, one metric row per model
# ---------------------------------------------------------------------------

#: The original's model names.
REGRESSORS = {
    "RFR": fit_rf_regressor,
    "ABR": fit_adaboost_regressor,
    "GBR": fit_gbt_regressor,
    "DTR": fit_tree_regressor,
    "XGBR": fit_xgb_like_regressor,
    "LGBM": fit_lgbm_like_regressor,
}


def compare_models(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                   id_col: str, models: Sequence[str] | None = None, knn_k: int = 5,
                   params: Mapping[str, Mapping[str, Any]] | None = None) -> DataFrame:
    """(model, r2, mae, mse) for each regressor (and kNN) on the test rows.

    Every model adds its prediction to the same test rows, which are read
    once; one explode to (model, prediction) and one grouped C8 follow.
    ``params`` overrides fit arguments per model name (e.g. fewer rounds)."""
    from cellwise.operators.metrics import regression_metrics

    names = list(models or [*REGRESSORS, "KNN"])
    tr = train.persist()
    scored, marks = test.select(id_col, label, *features), {n: f"_yhat_{n}" for n in names}

    def fit(name: str):
        if name == "KNN":
            return knn_regress(tr, test, features, label, id_col, id_col, k=knn_k)
        return REGRESSORS[name](tr, features, label, **dict((params or {}).get(name, {})))

    # The fits are independent, and most wait for many small jobs.
    with ThreadPoolExecutor(max(1, len(names))) as pool:
        fitted = [pool.submit(inheritable_thread_target(train.sparkSession)(fit), name) for name in names]
    for name, done in zip(names, fitted):
        if name == "KNN":
            scored = scored.join(done.result().withColumnRenamed("prediction", marks[name]), id_col)
        else:
            kept = [F.col(f"`{c}`") for c in scored.columns]
            scored = done.result().transform(scored).select(*kept, F.col("prediction").alias(marks[name]))
    # Every fit has run (kNN rounds are materialised): the scored frame only
    # needs the test rows and the fitted models, so the cached train set goes.
    tr.unpersist()
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).cast("double").alias("yhat")) for n, c in marks.items()]))
    pairs = scored.select(F.col(label).cast("double").alias("_y"), each.alias("_s")).select(
        "_s.model", "_y", F.col("_s.yhat").alias("_yhat"))
    return regression_metrics(pairs, "_y", "_yhat", ["model"])
