"""The operators' queries over the given tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F  # noqa: F401

from cellwise.llm.common import read_table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.bpe import roundtrip_digests

    return roundtrip_digests(read_table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())


@query
def op7_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.quality import quality_report

    return quality_report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.exact import duplicate_report

    return duplicate_report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


# The white space of the contract, spelled for RE2.
_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"
ORACLE["op1_exact_dedup"] = f"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_NORM} AS t FROM documents) WINDOW g AS (PARTITION BY t)"""


@query
def op3_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.shard import shard_documents

    return shard_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op9_certified_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.packing import pack_documents

    return pack_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())


#: The contract's host/path rules.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
             ("allow", "org/fr/"))


@query
def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.urls import host_path, judge_urls

    pages = read_table(spark, sf_dir, "pages", "page_id", "url")
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    # A page's path ends in the number of the document it shows.
    number = F.regexp_extract(host_path(F.col("url"))[1], r"/(\d+)", 1).try_cast("long")
    labelled = (pages.select("url", number.alias("doc_id")).join(labels, "doc_id")
                .select("url", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")))
    return judge_urls(pages, labelled, URL_RULES)


@query
def op4_consensus_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.html import extract_pages

    return extract_pages(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op6_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.near import class_report

    return class_report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op8_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.suffix import repeated_spans

    return repeated_spans(read_table(spark, sf_dir, "documents", "doc_id", "text")).drop("spans")


@query
def op2_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.passages import passage_report

    return passage_report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.spelling import spelling_variants

    return spelling_variants(read_table(spark, sf_dir, "documents", "doc_id", "text"))


# CRC-32 of a string by its table of 256 remainders, from the polynomial.
_CRC_TABLE = """
bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8)"""
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      regexp_extract_all(hex(encode(s)), '..'), lambda p: ('0x' || p)::BIGINT)),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"""
ORACLE["op11_spelling_variants"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || w AS s, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{7,}}')) AS w FROM documents)
  GROUP BY ALL),
hashed AS (
  SELECT w, n, {_CRC} AS h
  FROM runs, crc),
slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN w[1:(h % length(w))] || w[(h % length(w)) + 2:] ELSE w END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
gaps AS (
  SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top_n,
         arg_min(near, (-near_n, near)) AS top FROM pairs GROUP BY 1),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 10 * w.n THEN top END AS form,
         CASE WHEN top_n >= 10 * w.n THEN top_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
steps AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL SELECT s.word, f.word, f.form FROM steps s JOIN forms f ON f.word = s.next)
SELECT f.word, form, s.at AS root, n, n_near, form_n
FROM forms f JOIN steps s ON s.word = f.word AND s.next IS NULL
"""


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.trie import conversation_trie

    return conversation_trie(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


# Prefixes are compared by roles and texts; subtrees by every node's ancestors.
ORACLE["op13_prefix_trie"] = f"""
WITH RECURSIVE {_CRC_TABLE},
own AS (
  SELECT conv_id AS c, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS s
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
  GROUP BY conv_id),
heads AS (SELECT c, {_CRC} % 9 AS h FROM (SELECT c, c::VARCHAR AS s FROM own), crc),
rebuilt AS (
  SELECT o.c, list_concat(coalesce(b.s[1:h], []), o.s[h + 1:]) AS s
  FROM own o JOIN heads USING (c) LEFT JOIN own b ON b.c = o.c - o.c % 5),
prefixes AS (SELECT c, d, s[1:d] AS p, len(s) = d AS whole FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE whole), '') AS ends,
         CASE WHEN d > 0 THEN strlen(p[d].x) ELSE 0 END AS size
  FROM prefixes GROUP BY p, d),
children AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k ON n.p = k.p),
subtrees AS (
  SELECT p[1:a] AS p, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n - 1) * size)::BIGINT AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM counted) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n AS n_convs, n.n_children, n_leaves,
       saved AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM counted n JOIN subtrees s ON s.p = n.p LEFT JOIN nodes u ON n.d > 0 AND u.p = n.p[1:n.d - 1]
"""


@query
def op12_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellwise.llm.pii import personal_data

    return personal_data(read_table(spark, sf_dir, "documents", "doc_id", "text"))
