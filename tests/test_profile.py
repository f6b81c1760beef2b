import numpy as np
import pytest
import pandas as pd
from pyspark.sql import functions as F

from cellwise.operators import profile as A
from tests.conftest import SF_SMALL


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(size=301), "b": rng.integers(0, 5, size=301).astype(float)})
    pdf.loc[3, "a"] = np.nan
    df = spark.createDataFrame(pdf)
    got = A.describe(df).toPandas().set_index("statistic")
    ref = pdf.describe()
    for c in ("a", "b"):
        for s in ("count", "mean", "std", "min", "25%", "50%", "75%", "max"):
            assert abs(got.loc[s, c] - ref.loc[s, c]) < 1e-9, (c, s)


def test_exact_quantiles_refinement(spark):
    rng = np.random.default_rng(2)
    x = rng.exponential(size=5000).round(3)
    heavy = np.where(np.arange(5000) % 3 == 0, 0.5, x)  # a third of the rows on one value
    df = spark.createDataFrame([(float(v), float(w)) for v, w in zip(x, heavy)], ["x", "h"])
    probs = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    for kw in ({}, {"accuracy": 100}, {"accuracy": 1000}):
        rows = {r["column"]: r for r in A.exact_quantiles(df, ["x", "h"], probs, **kw).collect()}
        for c, data in (("x", x), ("h", heavy)):
            ref = np.quantile(data, probs)
            got = [rows[c][f"q_{i}"] for i in range(len(probs))]
            assert np.allclose(got, ref, atol=1e-12, rtol=0), (c, kw)


def test_null_counts_and_info(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "c")], "x double, s string")
    nulls = {r["column"]: r["nulls"] for r in A.null_counts(df).collect()}
    assert nulls == {"x": 2, "s": 1}
    info = A.column_info(df).collect()
    assert [(r["column"], r["non_null"], r["dtype"]) for r in info] == [("x", 2, "double"), ("s", 2, "string")]
    assert A.shape(df).first()["rows"] == 3


def test_require_rows_and_last_rows(spark):
    import pytest

    with pytest.raises(RuntimeError):
        A.require_rows(spark.range(0), "test_set")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    top = A.last_rows(ev, 5, "ts", ["event_id"]).collect()
    ref = ev.orderBy(F.desc("ts"), F.desc("event_id")).limit(5).collect()
    assert [r.event_id for r in top] == [r.event_id for r in ref]
    plan = A.last_rows(ev, 5, "ts")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_mean_curve_and_class_counts(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0)], ["x", "y"])
    rows = {r["x"]: r for r in A.mean_curve(df, "x", "y").collect()}
    assert rows[1]["mean"] == 3.0 and rows[1]["n"] == 2
    assert abs(rows[1]["ci_high"] - (3.0 + 1.96 * np.sqrt(2) / np.sqrt(2))) < 1e-12
    cc = A.class_counts(df, "x").collect()
    assert all(r["n_classes"] == 2 for r in cc)
    boot = A.mean_curve_bootstrap(df, "x", "y", replicates=30).collect()
    assert len(boot) == 2


def test_scatter_points_keeps_every_row(spark):
    df = spark.range(5000).select(F.col("id").alias("x"), (F.col("id") * 2).alias("y"))
    assert A.scatter_points(df, "x", "y").count() == 5000


def test_describe_without_values(spark):
    df = spark.createDataFrame([], "x double, n int, s string")
    for exact in (True, False):
        got = {r["statistic"]: r for r in A.describe(df, exact=exact).collect()}
        assert got["count"]["x"] == 0.0 and got["count"]["n"] == 0.0
        assert all(got[k]["x"] is None for k in ("mean", "std", "min", "25%", "50%", "75%", "max"))
    half = spark.createDataFrame([(None, 1.0), (None, 3.0)], "x double, y double")
    got = {r["statistic"]: r for r in A.describe(half).collect()}
    assert got["50%"]["y"] == 2.0 and got["50%"]["x"] is None and got["count"]["x"] == 0.0
    assert A.describe(spark.createDataFrame([("a",)], "s string")).columns == ["statistic"]


def test_class_counts_per_group_with_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), (None, 2), (None, 3)], "g string, y int")
    got = {(r["g"], r["y"]): (r["n"], r["n_classes"]) for r in A.class_counts(df, "y", ["g"]).collect()}
    assert got == {("a", 1): (2, 2), ("a", None): (1, 2), (None, 2): (1, 2), (None, 3): (1, 2)}


def test_bootstrap_interval_with_equal_rows(spark):
    """2000 rows of ten values, then each a thousand times as often."""
    df = spark.range(2000).select(F.lit(1).alias("x"), (F.col("id") % 10).cast("double").alias("y"))
    r = A.mean_curve_bootstrap(df, "x", "y", replicates=400).first()
    n = A.mean_curve(df, "x", "y").first()
    assert abs(r["ci_low"] - n["ci_low"]) < 0.06 and abs(r["ci_high"] - n["ci_high"]) < 0.06
    many = spark.range(2_000_000).select(F.lit(1).alias("x"), (F.col("id") % 10).cast("double").alias("y"))
    r = A.mean_curve_bootstrap(many, "x", "y", replicates=400).first()
    n = A.mean_curve(many, "x", "y").first()
    assert abs(r["ci_low"] - n["ci_low"]) < 0.002 and abs(r["ci_high"] - n["ci_high"]) < 0.002


def test_bootstrap_edges(spark):
    assert A.mean_curve_bootstrap(spark.createDataFrame([], "x string, y double"), "x", "y").collect() == []
    rows = [(None, 1.0), (None, 3.0), ("a", None), ("b", 2.0), ("b", 2.0), (None, 1.0)]
    got = {r["x"]: r for r in A.mean_curve_bootstrap(spark.createDataFrame(rows, "x string, y double"), "x", "y").collect()}
    assert set(got) == {None, "b"} and got["b"]["ci_low"] == got["b"]["ci_high"] == 2.0
    assert 1.0 <= got[None]["ci_low"] <= got[None]["ci_high"] <= 3.0


@pytest.mark.parametrize("n", [1, 2, 30, 5000, 3_000_000])
def test_poisson_draws_by_moments(n):
    u = (np.arange(200_000) + 0.5) / 200_000
    k = A.poisson_draws(n, u)
    assert k.min() >= 0 and (np.diff(k) >= 0).all()
    assert abs(k.mean() / n - 1) < 1e-4 and abs(k.var() / n - 1) < 2e-3


def test_describe_approx_within_sketch_error(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=4000)
    df = spark.createDataFrame([(float(v),) for v in x], ["x"])
    got = A.describe(df, ["x"], exact=False, accuracy=1000).toPandas().set_index("statistic")
    srt = np.sort(x)
    for s, p in (("25%", 0.25), ("50%", 0.5), ("75%", 0.75)):
        # the sketch value lies within rank error n/accuracy of the exact one
        lo, hi = srt[int(max(0, (p - 2e-3) * 4000))], srt[int(min(3999, (p + 2e-3) * 4000))]
        assert lo <= got.loc[s, "x"] <= hi
    assert got.loc["count", "x"] == 4000.0


def test_bootstrap_reproducible(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("x"), (F.col("id") * 0.5).alias("y"))
    a = sorted(tuple(r) for r in A.mean_curve_bootstrap(df, "x", "y", replicates=40, seed=7).collect())
    b = sorted(tuple(r) for r in A.mean_curve_bootstrap(df.repartition(5), "x", "y", replicates=40, seed=7).collect())
    assert a == b
    for x, lo, hi in a:
        m = df.where(F.col("x") == x).agg(F.avg("y")).first()[0]
        assert lo <= m <= hi


def test_tabled_draws_equal_the_inverse_function():
    """Draws by leading bits, where the table steps, in its tails and for
    copies so many that a slot holds many steps."""
    rng = np.random.default_rng(2)
    h = np.concatenate([rng.integers(0, 1 << 32, 20_000), [0, 1, (1 << 32) - 1], np.arange(0, 1 << 32, 1 << 20),
                        np.arange(0, 1 << 32, 1 << 20) - 1]).clip(0).astype(np.uint32)
    for n in (1, 2, 3, 17, 60, 360, 40_000, 2_000_000):
        edges = np.ceil(A._poisson_cdf(n)[1][:2000] * 4294967296.0).clip(1, (1 << 32) - 1).astype(np.uint32)
        at = np.concatenate([h, edges, edges - np.uint32(1)])
        assert (A.hashed_poisson(n, at) == A.poisson_draws(n, at / 4294967296.0)).all()


def test_replicate_hashes_are_the_documented_ones():
    def mix(v):
        v ^= v >> 16
        v = v * 2246822507 % (1 << 32)
        v ^= v >> 13
        v = v * 3266489909 % (1 << 32)
        return v ^ v >> 16

    high, low = np.array([0, 7, (1 << 32) - 1]), np.array([5, (1 << 32) - 1, 0])
    got = A.replicate_hashes(high, low, 50)
    assert all(got[b - 1, i] == mix(mix((b * 2654435769 + int(high[i])) % (1 << 32)) ^ int(low[i])) for b in range(1, 51) for i in range(3))
