from pyspark.sql import functions as F

from cellwise.operators.encode import apply_ordinal, fit_ordinal, one_hot


def test_ordinal_fit_apply_unknown(spark):
    tr = spark.createDataFrame([("b", "x"), ("a", "y"), ("b", None)], ["c1", "c2"])
    te = spark.createDataFrame([("a", "x"), ("z", "y"), (None, "q")], ["c1", "c2"])
    d = fit_ordinal(tr, ["c1", "c2"])
    got = {(r["column"], r["category"]): r["code"] for r in d.collect()}
    assert got == {("c1", "a"): 0, ("c1", "b"): 1, ("c2", "x"): 0, ("c2", "y"): 1}
    for mode in ("map", "join"):
        out = apply_ordinal(te, d, ["c1", "c2"], suffix="_code", mode=mode).orderBy(F.col("c2")).collect()
        assert [(r["c1_code"], r["c2_code"]) for r in out] == [(-1, -1), (0, 0), (-1, 1)]
    # train has no -1
    enc = apply_ordinal(tr.where("c2 is not null"), d, ["c1", "c2"], suffix="_code")
    assert enc.where("c1_code = -1 or c2_code = -1").count() == 0


def test_one_hot_drop_first_and_unknown(spark):
    tr = spark.createDataFrame([("HP", 1), ("Dell", 2), ("Asus", 3)], ["brand", "n"])
    te = spark.createDataFrame([("Dell", 5), ("Acer", 6)], ["brand", "n"])
    d = fit_ordinal(tr, ["brand"])
    out = one_hot(te, d, ["brand"])
    assert out.columns == ["one_hot__brand_Dell", "one_hot__brand_HP", "remainder__n"]
    rows = out.collect()
    assert (rows[0][0], rows[0][1]) == (1, 0) and (rows[1][0], rows[1][1]) == (0, 0)


def test_ordinal_codes_match_sorted_order_with_buckets(spark):
    from cellwise.functions.ranges import running_totals

    words = ["", "a", "ab", "abc", "abcdefgh", "abcdefgi", "b", "Z", "é", "ü", "zz", "abcdefg"]
    words += [f"a_prefix_of_twenty_bytes_{i}" for i in range(40)]
    df = spark.createDataFrame([(w,) for w in words], ["c"])
    codes = {r["category"]: r["code"] for r in fit_ordinal(df, ["c"]).collect()}
    assert [w for w, _ in sorted(codes.items(), key=lambda t: t[1])] == sorted(words, key=lambda w: w.encode())
    keyed = df.select(F.lit("c").alias("column"), F.col("c").alias("category"), F.lit(1).alias("_one"))
    got = {r["category"]: r["cum__one"] for r in
           running_totals(keyed, ["column"], ["category"], ["_one"], n_buckets=9).collect()}
    assert got == codes


def test_large_dictionary_forms(spark):
    """60,000 categories: the join form and the vector form take them."""
    from cellwise.operators.encode import apply_ordinal, one_hot_vector

    df = spark.range(60_000).select(F.format_string("category_%08d", F.col("id")).alias("c"), "id")
    d = fit_ordinal(df, ["c"])
    out = apply_ordinal(df, d, ["c"], suffix="_code")
    assert out.where(F.col("c_code") != F.col("id")).count() == 0 and out.count() == 60_000
    v = one_hot_vector(df.where("id % 10000 = 7").unionByName(
        spark.createDataFrame([("unknown", -1)], "c string, id long")), d, "c").collect()
    for r in v:
        assert r["c_vec"].size == 59_999
        assert list(r["c_vec"].indices) == ([] if r["id"] < 0 else [r["id"] - 1])


def test_one_hot_vector_matches_columns(spark):
    from cellwise.operators.encode import one_hot_vector

    tr = spark.createDataFrame([("HP",), ("Dell",), ("Asus",)], ["brand"])
    te = spark.createDataFrame([("Dell",), ("Acer",), ("Asus",), ("HP",), (None,)], ["brand"])
    d = fit_ordinal(tr, ["brand"])
    cols = one_hot(te, d, ["brand"], passthrough=[]).collect()
    vecs = one_hot_vector(te, d, "brand").collect()
    for c, v in zip(cols, vecs):
        assert list(c) == [int(x) for x in v["brand_vec"].toArray()]
