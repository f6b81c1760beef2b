"""Fixtures with the edge rows every operator must take."""

import random

from pyspark.sql import types as T

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(2, 9))) for _ in range(n))


def edge_docs(seed=3, n=60):
    rnd = random.Random(seed)
    rows = [(i, words(rnd, rnd.randrange(1, 200)) + "\nÄé 漢字 😀 " + words(rnd, 12), "en", f"s{i % 3}", None) for i in range(n)]
    t = rows[5][1]
    rows += [(100, t, "en", "s0", 1), (101, t.replace(" ", "\t \n", 3), "en", "s0", 1), (102, None, None, None, None),
             (103, "", "en", None, 0), (104, "   ", "en", "s1", 3), (105, "a", "en", "s1", 1),
             (106, words(rnd, 6000), "en", "s1", None), (107, "x" * 30000, "en", "s1", None),
             (None, t, None, None, None), (None, None, None, None, None), (105, "a", "en", "s1", 1),
             (108, "<|endoftext|> hi <|endoftext|>", "en", "s2", 4), (109, " a", None, None, 2),
             (110, "loop loop " * 400, "en", "s2", 5)]
    return rows


def edge_frame(spark, rows=None):
    """Edge rows with an extra column whose name clashes but for its case."""
    df = spark.createDataFrame(edge_docs() if rows is None else rows, DOC_SCHEMA)
    return df.selectExpr("*", "1 as _digest", "2 as _row", "'x' as KEPT", "3 as shard")


def empty_frame(spark):
    return spark.createDataFrame([], T._parse_datatype_string(DOC_SCHEMA))
