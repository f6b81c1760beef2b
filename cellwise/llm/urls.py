"""URL filters by mined association rules (operator 10).

A URL is a set of tokens: scheme, host suffixes and leading labels, path
words, extension, query keys, fragment.  Spark's FP-growth mines the token
combinations of labelled URLs; rules "combination => bad" that pass a support
and a confidence bound, and that no shorter rule already implies, are kept.
Two steps before keep the combinations few without changing what is blocked:
a token that is a rule by itself is in no longer rule, and tokens that all
labelled URLs have together or not at all are mined as one.
An inverted index lists every rule under its rarest token only, so a page
meets just the rules whose rarest token it has.

Given host/path rules come first; the longest fitting one decides.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellwise.llm.common import fresh, stored

BAD = "label=bad"
#: No share of all URLs is asked for, as it would grow with the table.
MIN_SUPPORT = 0.0
MIN_CONFIDENCE = 0.8
#: A rule must rest on this many labelled bad URLs.
MIN_BAD_URLS = 25


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls if none does.

    ``rules`` holds (verdict, 'host/path'): a short configured list, compiled
    into one expression.
    """
    rule = verdict = None
    for v, r in sorted(rules, key=lambda x: -len(x[1])):
        h, slash, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule = F.when(fits, r) if rule is None else rule.when(fits, r)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return (rule, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def url_items(url: Column) -> Column:
    """The distinct tokens of a URL (empty array for null or without ://).

    Numbers carry no meaning across URLs and are left out.
    """
    host, path = host_path(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(
        F.lit("host="), F.array_join(F.slice(labels, n - i + 1, i), ".")))
    # Words of hyphenated labels; a whole label is in the suffixes already.
    words = F.transform(F.regexp_extract_all(host, F.lit(r"((?<=-)[^.\-]+|[^.\-]+(?=-))"), 1),
                        lambda w: F.concat(F.lit("word="), w))
    parts = F.transform(F.regexp_extract_all(path, F.lit(r"([^/._\-0-9]{2,})"), 1),
                        lambda w: F.concat(F.lit("path="), F.lower(w)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.regexp_extract_all(query, F.lit(r"(?:^|&)([^=&]+)"), 1),
                       lambda k: F.concat(F.lit("query="), k))
    scheme = F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))))
    frag = F.when(F.instr(url, "#") > 0, F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    items = F.array_distinct(F.concat(scheme, suffixes, words, parts, keys, frag))
    return F.when((F.instr(url, "://") > 0) & (host != ""), items).otherwise(F.array().cast("array<string>"))


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE, min_bad: int = MIN_BAD_URLS) -> DataFrame:
    """Rules (rule_id, antecedent, choices, confidence, support, anchors) from
    ``labelled`` (items array, bad boolean); empty without bad labels.

    A URL fits a rule if it has a token of each of its ``choices``: the
    antecedent's tokens, each with those that always occur with it.  Any of
    the rarest one's tokens is an anchor.

    The confidence bound alone would keep combinations seen by chance; the
    support bound (a number of bad URLs, and a share of all if given) prunes
    those.  Combinations are mined from the bad URLs and counted over all.  A
    rule that contains a kept rule says nothing new and goes.
    """
    spark = labelled.sparkSession
    known = stored(labelled.where(F.col("bad").isNotNull() & (F.size("items") > 0)).select(
        F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")),
        "url_baskets")
    n, n_bad = known.agg(F.count(F.lit(1)), F.count_if(F.array_contains("items", BAD))).first()
    empty = ("rule_id long, antecedent array<string>, choices array<array<string>>, confidence double, support double, "
             "anchors array<string>")
    least = max(1, min_bad, math.ceil(min_support * n))
    if n_bad < least:
        return spark.createDataFrame([], empty)
    # Every token's URLs, all and bad ones, and a sum of their random marks: of
    # two tokens with equal sums each URL has both or none.
    marked = stored(known.select("items", *[F.floor(F.rand(s) * (1 << 52)).cast("decimal(30,0)").alias(f"m{s}")
                                            for s in (1, 2, 3)]), "url_marked")
    tokens = stored(marked.withColumn("is_bad", F.array_contains("items", BAD)).select(
        F.explode(F.array_remove("items", BAD)).alias("token"), "is_bad", "m1", "m2", "m3").groupBy("token").agg(
            F.count(F.lit(1)).alias("urls"), F.count_if("is_bad").alias("bad_urls"),
            *[F.sum(f"m{s}").alias(f"m{s}") for s in (1, 2, 3)]), "url_tokens")
    frequent = tokens.where(F.col("bad_urls") >= least)
    alone = frequent.where(F.col("bad_urls") / F.col("urls") >= min_confidence)
    group = F.min("token").over(Window.partitionBy("urls", "m1", "m2", "m3"))
    named = stored(frequent.join(alone.select("token"), "token", "left_anti").select("token", group.alias("item")), "url_items")
    numbered = stored(known.select("items", F.monotonically_increasing_id().alias("url")), "url_numbered")
    itemised = (numbered.select("url", F.explode("items").alias("token")).join(named, "token")
                .groupBy("url").agg(F.collect_set("item").alias("mined")))
    bad = (numbered.where(F.array_contains("items", BAD)).select("url").join(itemised, "url").select(F.col("mined").alias("items")))
    # Half a URL less, so that rounding never asks for one more.
    n_named = bad.count()
    counts = tokens.select("token", "urls")
    singles = alone.select(F.array("token").alias("antecedent"), F.col("bad_urls").alias("freq"))
    if n_named >= least:
        model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_named).fit(bad)
        mined = model.freqItemsets.select(F.sort_array("items").alias("antecedent"), "freq")
        singles = singles.unionByName(mined)
    sets = stored(singles, "url_sets")
    anchored = (sets.select("antecedent", "freq", F.explode("antecedent").alias("token"))
                .join(counts, "token").groupBy("antecedent", "freq")
                .agg(F.min_by("token", F.struct("urls", "token")).alias("token")))
    # URLs that differ in numbers only have the same tokens.
    baskets = known.groupBy(F.sort_array("items").alias("items")).agg(F.count(F.lit(1)).alias("urls"))
    held = (baskets.select("items", "urls", F.explode("items").alias("token")).join(anchored, "token")
            .where(F.size(F.array_except("antecedent", "items")) == 0)
            .groupBy("antecedent", "freq").agg(F.sum("urls").alias("urls")))
    rules = stored(held.select("antecedent", (F.col("freq") / F.col("urls")).alias("confidence"),
                               (F.col("freq") / n).alias("support"))
                   .where(F.col("confidence") >= min_confidence), "url_rules")
    # A rule goes if another one's tokens are a proper part of its own.  The
    # smaller one shares its first token, so rules meet by token.
    by_token = rules.select("antecedent", F.explode("antecedent").alias("token"))
    first = rules.select(F.col("antecedent").alias("part"), F.col("antecedent")[0].alias("token"))
    implied = (by_token.join(first, "token")
               .where((F.size("part") < F.size("antecedent"))
                      & (F.size(F.array_except("part", "antecedent")) == 0))
               .select("antecedent").distinct())
    kept = rules.join(implied, "antecedent", "left_anti")
    classes = named.groupBy("item").agg(F.sort_array(F.collect_list("token")).alias("choice"))
    each = (kept.select("antecedent", F.explode("antecedent").alias("item")).join(classes, "item", "left")
            .join(counts.withColumnRenamed("token", "item"), "item")
            .select("antecedent", "urls", "item", F.coalesce("choice", F.array("item")).alias("choice"))
            .groupBy("antecedent").agg(F.collect_list("choice").alias("choices"),
                                       F.min_by("choice", F.struct("urls", "item")).alias("anchors")))
    return kept.join(each, "antecedent").select(
        F.xxhash64("antecedent").alias("rule_id"), "antecedent", "choices", "confidence", "support", "anchors")


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str]] = (),
               id_col: str = "page_id", url_col: str = "url", **mining) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, mined_rule.

    ``labelled`` has url and bad (boolean, null: unlabelled).  A null URL or
    one without :// has empty host and path, fits no rule and is allowed.
    Repeated rows are judged each; an empty table gives an empty result.
    """
    row = fresh(pages, "row")
    url = F.col(f"`{url_col}`").cast("string")
    host, path = host_path(url)
    rule, ruled = rule_for(host, path, rules)
    thin = stored(pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"),
                               rule.alias("rule"), ruled.alias("ruled"), url_items(url).alias("items"),
                               F.monotonically_increasing_id().alias(row)), "url_rows")
    baskets = labelled.select(url_items(F.col("url").cast("string")).alias("items"), "bad")
    index = mine_rules(baskets, **mining).select(
        F.explode("anchors").alias("token"), "antecedent", "choices", "confidence")
    hits = (thin.where(F.col("rule").isNull()).select(row, "items", F.explode("items").alias("token"))
            .join(index, "token")
            .where(F.forall("choices", lambda c: F.arrays_overlap(c, F.col("items"))))
            .groupBy(row).agg(F.max(F.struct("confidence", "antecedent")).alias("hit")))
    judged = thin.join(hits, row, "left")
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("hit").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.array_join(F.col("hit")["antecedent"], " & ").alias("mined_rule"))
