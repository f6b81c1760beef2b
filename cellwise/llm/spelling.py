"""Spelling variants of corpus words by reduced alphabets (operator 11).

Letters are hashed to a few symbols.  Each reduced word generates its one-edit
neighbourhood over those symbols; the neighbourhoods are joined with the
reduced vocabulary, and what meets is verified on the original words.  With
few symbols there are few neighbours to generate, at the price of some pairs
that fail the check.

A pair of near words is generated from one side only: the longer word deletes,
or the word with the smaller symbol at the differing place replaces it (equal
symbols: both reduce to the same word, and the smaller word keeps the pair).
So the deletions and upward replacements of all words are the full
neighbourhoods, each edge once.

Neighbours are 64-bit polynomial hashes computed from prefix sums, never
strings, so a word of a million letters costs its length and not its square.
Two neighbours that share a hash by chance are told apart by the check.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.llm.common import stored
from cellwise.llm.grams import mix

MIN_LENGTH = 7
MIN_COUNT = 2
#: A word is a variant of a near word that is at least so many times as common.
RATIO = 10
#: A run whose hash this divides loses one letter (the contract's misspelling).
SLIP = 31
#: Distinct words a task folds before it passes their counts on.
FOLD = 200_000
#: Symbols (words times letters) of one numpy block.
BLOCK = 100_000
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def words_in(doc_id: int | None, text: str | None, min_length: int = MIN_LENGTH) -> Counter:
    """Counts of a text's words of ``min_length`` code points or more: runs of
    letters, A-Z lower-cased, some with a letter slipped out by their hash."""
    low = (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    runs = Counter(re.findall(f"[a-zÀ-ÿ]{{{min_length},}}", low))
    out: Counter = Counter()
    head = f"{'' if doc_id is None else doc_id}:"
    for run, n in runs.items():
        h = crc32((head + run).encode("utf-8"))
        if h % SLIP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < min_length:
                continue
        out[run] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of whole texts that occur ``min_count`` times or more.
    Tasks fold their words first, so a common word is one row a task."""
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for pdf in batches:
            for doc, text in zip(pdf["doc"], pdf["text"]):
                counts.update(words_in(None if doc is None else int(doc), text, min_length))
                if len(counts) >= FOLD:
                    yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                    counts = Counter()
        if counts:
            yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    # The id as text: a column of numbers with nulls would become floats.
    rows = docs.select(F.col(f"`{id_col}`").cast("string").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return (rows.mapInPandas(fold, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def symbols_for(n_words: int, min_length: int = MIN_LENGTH) -> int:
    """So many symbols that the reduced words of the shortest length are about
    as many as the words: then few words share one.  Only the cost depends on
    it, never the pairs."""
    return min(64, max(4, math.ceil(n_words ** (1 / min_length))))


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _BASE, dtype=np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p, dtype=np.uint64)


def _key(h: np.ndarray, length: int) -> np.ndarray:
    return mix(mix(h + np.uint64(length * 0x632BE59BD9B4E019 % (1 << 64))))


def _blocks(words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Indexes and code points (a row per word) of words of one length."""
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for length, at in by_length.items():
        step = max(1, BLOCK // max(1, length))
        for a in range(0, len(at), step):
            part = at[a:a + step]
            raw = "".join(words[i] for i in part).encode("utf-32-le")
            yield part, np.frombuffer(raw, dtype=np.uint32).reshape(len(part), length)


def reduce_letters(codes: np.ndarray, symbols: int) -> np.ndarray:
    """Symbols 1 to ``symbols`` of code points, by a fixed hash."""
    return (codes.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(12)) % np.uint64(symbols) + np.uint64(1)


def reduced_keys(words: list[str], symbols: int) -> np.ndarray:
    """A 64-bit key of each reduced word."""
    out = np.zeros(len(words), dtype=np.uint64)
    for part, codes in _blocks(words):
        s = reduce_letters(codes, symbols)
        out[part] = _key((s * _powers(s.shape[1])).sum(axis=1, dtype=np.uint64), s.shape[1])
    return out


def neighbour_keys(words: list[str], symbols: int) -> list[np.ndarray]:
    """For each word the key of its reduced word, then, each once, those of all
    reduced words with one symbol less or one symbol replaced by a larger."""
    out: list[np.ndarray] = [np.empty(0, dtype=np.uint64)] * len(words)
    for part, codes in _blocks(words):
        s = reduce_letters(codes, symbols)
        length = s.shape[1]
        powers = _powers(length)
        sums = np.cumsum(s * powers, axis=1, dtype=np.uint64)
        whole = sums[:, -1:]
        before = sums - s * powers
        shorter = before + (whole - sums) * np.uint64(_INVERSE)
        # In a stretch of equal symbols every deletion gives the same word.
        differs = np.ones(s.shape, dtype=bool)
        differs[:, :-1] = s[:, :-1] != s[:, 1:]
        own = _key(whole, length)
        keys = [own, np.where(differs, _key(shorter, length - 1), own)]
        for c in range(2, symbols + 1):
            keys.append(np.where(s < c, _key(whole + (np.uint64(c) - s) * powers, length), own))
        found = np.sort(np.concatenate(keys[1:], axis=1), axis=1)
        new = found != own
        new[:, 1:] &= found[:, 1:] != found[:, :-1]
        for i, first, k, v in zip(part, own, found, new):
            out[i] = np.concatenate([first, k[v]])
    return out


def near_pairs(words: DataFrame, symbols: int) -> DataFrame:
    """(a, a_n, b, b_n): each pair of words (word, n) that differ by exactly
    one inserted, deleted or replaced code point, once."""
    def own(w: pd.Series) -> pd.Series:
        return pd.Series(reduced_keys(w.tolist(), symbols).view("int64"))

    def around(w: pd.Series) -> pd.Series:
        return pd.Series([k.view("int64") for k in neighbour_keys(w.tolist(), symbols)], dtype=object)

    vocabulary = words.select(F.pandas_udf(own, "long")("word").alias("key"),
                              F.col("word").alias("b"), F.col("n").alias("b_n"))
    reach = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"),
                         F.posexplode(F.pandas_udf(around, "array<long>")("word")).alias("at", "key"))
    # Words that reduce to the same word (place 0) meet twice.
    met = reach.withColumn("same", F.col("at") == 0).drop("at").join(vocabulary, "key")
    return met.where((~F.col("same") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)).select(
        "a", "a_n", "b", "b_n")


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each chain of forms, by
    doubling; a form is RATIO times as common, so chains are short."""
    now = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(ahead, "root", "left_semi").isEmpty():
            return now
        now = stored(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "forms")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word of largest n (ties: smallest in code-point
    order) if that is at least ``ratio`` times the word's own, ``root`` the
    last word when forms are followed (the word itself without a form),
    ``n_near`` the number of near words.  Null and empty texts have no words;
    a null id counts as an empty one in the hash of the slips; repeated rows
    count again; other columns are not read.  No words give an empty result.
    """
    words = stored(word_counts(docs, id_col, text_col, min_length, min_count), "words")
    pairs = near_pairs(words, symbols_for(words.count(), min_length))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("s")).select("s.*")
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                     F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    is_form = -F.col("top.less") >= ratio * F.col("n")
    judged = stored(words.join(best, "word", "left").select(
        "word", F.when(is_form, F.col("top.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("top.less")).alias("form_n")), "spelling_forms")
    roots = last_forms(judged.where(F.col("form").isNotNull()))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
