"""Removal of repeated byte strings by distributed prefix doubling (operator 8).

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else in the corpus.  Ranking every suffix would move each byte many
times, so only sampled suffixes are ranked: of every ``length`` bytes, the
``core`` bytes with the lowest fingerprint mark an anchor.  Equal strings have
equal anchors, so nothing is lost.

* Round 0 ranks the anchors by their first bytes; those with a unique rank
  drop out, which is nearly all of a text without repeats.
* Each further round sorts pairs (rank, rank of the bytes at the offset) with
  the offset doubling, reranks, and drops unique anchors, until the rank spans
  the core.
* Past the core the context on both sides decides, as far as a string through
  the anchor can reach.  Anchors with equal contexts are settled at once; the
  others of their rank are compared window by window.

Windows are judged on the input; spans that overlap are joined.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.llm.common import stored, text_or_empty
from cellwise.llm.grams import anchors

LENGTH = 200
#: Bytes of the first rank; the core is this times a power of two.
FIRST = 32
#: Contexts that one comparing task takes (about).
CONTEXTS_PER_TASK = 5_000
#: A rank with more different contexts is compared as rows instead of in a task.
LARGE_RANK = 50_000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))


def core_of(length: int) -> int:
    core = FIRST
    while core * 4 <= length:
        core *= 2
    return core


def _join(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Fingerprint of two neighbouring strings from theirs."""
    z = x * _A + (y ^ (y >> np.uint64(29))) * _B
    z ^= z >> np.uint64(32)
    z *= _C
    z ^= z >> np.uint64(31)
    return z


def _words8(rows: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as one number; along the last axis."""
    n = rows.shape[-1] - 7
    out = np.empty((*rows.shape[:-1], n), dtype=np.uint64)
    for s in range(8):
        k = (rows.shape[-1] - s) // 8
        part = np.ascontiguousarray(rows[..., s:s + 8 * k]).view("<u8")
        out[..., s::8] = part[..., :out[..., s::8].shape[-1]]
    return out


def fingerprints(rows: np.ndarray, upto: int) -> dict[int, np.ndarray]:
    """By size (FIRST and its doubles up to ``upto``): the fingerprint of the
    bytes from each position on, every size from the one before."""
    size, f, out = 8, _words8(rows), {}
    while size < upto:
        f = _join(f[..., :f.shape[-1] - size], f[..., size:])
        size *= 2
        if size >= FIRST:
            out[size] = f
    return out


def _anchor_udf(length: int):
    core = core_of(length)

    def run(texts: pd.Series) -> pd.DataFrame:
        pos, first = [], []
        for t in texts:
            raw = np.frombuffer(t.encode("utf-8", "surrogatepass"), dtype=np.uint8)
            if len(raw) < length:
                pos.append(None)
                first.append(None)
                continue
            f = fingerprints(raw, core)
            at = anchors(f[core], length - core + 1)
            pos.append(at.astype("int32"))
            first.append(f[FIRST][at].view("int64"))
        return pd.DataFrame({"pos": pos, "rank": first})

    return F.pandas_udf(run, "pos array<int>, rank array<long>")


def _pair_udf(length: int):
    """Per candidate anchor: its first rank, the ranks at the growing offsets,
    a fingerprint of its context and how far the text reaches on both sides."""
    core = core_of(length)
    reach = length - core

    def run(texts: pd.Series, positions: pd.Series) -> pd.Series:
        from xxhash import xxh3_64_intdigest

        out = []
        for t, at in zip(texts, positions):
            b = t.encode("utf-8", "surrogatepass")
            found = []
            if len(b) >= length:
                f = fingerprints(np.frombuffer(b, dtype=np.uint8), core)
                signed = {k: v.view("int64") for k, v in f.items()}
                sizes = [k for k in f if k < core]
                for a in sorted(map(int, at)):
                    if a + core > len(b):  # another text's position (equal text key)
                        continue
                    left, right = min(reach, a), min(reach, len(b) - a - core)
                    x = xxh3_64_intdigest(b[a - left:a + core + right], seed=left)
                    found.append({"a": a, "rank": int(signed[FIRST][a]),
                                  "next": [int(signed[k][a + k]) for k in sizes],
                                  "context": x - (1 << 63), "left": left, "right": right})
            out.append(found)
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, "array<struct<a:int,rank:long,next:array<long>,context:long,left:int,right:int>>")


def _context_udf(length: int):
    """The bytes around each wanted anchor, zero-padded to a fixed size."""
    core = core_of(length)
    reach = length - core

    def run(texts: pd.Series, wanted: pd.Series) -> pd.Series:
        out = []
        for t, anchors_ in zip(texts, wanted):
            b = t.encode("utf-8", "surrogatepass")
            found = []
            for w in anchors_:
                a = int(w["a"])
                left, right = min(reach, a), min(reach, len(b) - a - core)
                x = b"\0" * (reach - left) + b[a - left:a + core + right] + b"\0" * (reach - right)
                found.append({"a": a, "rank": w["rank"], "alone": w["alone"], "left": left, "right": right, "x": x})
            out.append(found)
        return pd.Series(out, dtype=object)

    return F.pandas_udf(
        run, "array<struct<a:int,rank:long,alone:boolean,left:int,right:int,x:binary>>")


def _compare(length: int):
    """Of contexts with equal rank: the span that windows equal to another
    context's window cover.  All ranks of a task are compared at once, one
    window offset after the other."""
    core = core_of(length)
    reach = length - core
    parts = [*range(0, length - core, core), length - core]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        n = len(pdf)
        x = np.frombuffer(b"".join(pdf["x"]), dtype=np.uint8).reshape(n, 2 * reach + core)
        f = fingerprints(x, core)[core]
        rank = pdf["rank"].to_numpy().view(np.uint64)
        left, right = pdf["left"].to_numpy(), pdf["right"].to_numpy()
        low, high = np.full(n, reach + 1), np.full(n, -1)
        for s in range(reach + 1):
            ok = np.flatnonzero((left >= reach - s) & (right >= s))
            key = rank[ok]
            for p in parts:
                key = _join(key, f[ok, s + p])
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            twice = np.zeros(len(ok), dtype=bool)
            twice[1:] |= same
            twice[:-1] |= same
            hit = ok[order[twice]]
            low[hit] = np.minimum(low[hit], s)
            high[hit] = s
        a = pdf["a"].to_numpy()
        take = (high >= 0) & pdf["alone"].to_numpy()
        return pd.DataFrame({"row": pdf["row"].to_numpy()[take], "s": (a - reach + low)[take],
                             "e": (a - reach + high + length)[take]})

    return run


def _cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for t, ss in zip(texts, spans):
        b = t.encode("utf-8", "surrogatepass")
        merged: list[list[int]] = []
        for s, e in sorted((x["s"], x["e"]) for x in (ss if ss is not None else [])):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        kept, at = [], 0
        for s, e in merged:
            kept.append(b[at:s])
            at = e
        kept.append(b[at:])
        out.append((len(b), sum(e - s for s, e in merged), len(merged), sha256(b"".join(kept)).hexdigest(),
                    [{"s": s, "e": e} for s, e in merged]))
    return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def _twice(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` that occur more than once."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(col)


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   large_rank: int = LARGE_RANK) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans
    (array of (s, e), maximal removed byte runs).

    Null text counts as empty; texts shorter than ``length`` lose nothing.
    Repeated rows are documents of their own and so repeat each other.  An
    empty table gives an empty result; extra columns are not read.
    """
    core = core_of(length)
    reach = length - core
    text = text_or_empty(text_col)
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))

    # Round 0.  The key names a text; should two texts share it, each gets the
    # other's anchors too, and those drop out in the next round.
    marks = stored(base.where(F.octet_length("text") >= length)
                   .select("key", _anchor_udf(length)("text").alias("m")).select("key", "m.*"), "anchors")
    each = marks.select("key", F.explode(F.arrays_zip("pos", "rank")).alias("m")).select("key", "m.pos", "m.rank")
    repeated = stored(_twice(each, "rank"), "ranks_0")
    wanted = stored(each.join(repeated, "rank").groupBy("key").agg(F.collect_set("pos").alias("positions")),
                    "anchors_0")
    texts = stored(base.join(wanted, "key").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text",
                                                   "positions"), "texts_0")

    # Doubling rounds over (rank, rank at the offset) pairs.
    now = texts.select("row", F.explode(_pair_udf(length)("text", "positions")).alias("p")).select("row", "p.*")
    now = stored(now, "pairs")
    offset, k = FIRST, 0
    while offset < core:
        now = now.withColumn("rank", F.xxhash64("rank", F.col("next")[k]))
        # Both sides of the join are tables: Spark can split a rank that a
        # third of all anchors share.
        again = stored(_twice(now, "rank"), f"again_{k + 1}")
        now = stored(now.join(again, "rank"), f"ranks_{k + 1}")
        offset, k = 2 * offset, k + 1

    # Equal contexts settle each other; the rest is compared within its rank.
    member = F.struct("row", "a")
    kinds = stored(now.groupBy("rank", "context").agg(F.count(F.lit(1)).alias("n"), F.min(member).alias("one")),
                   "contexts")
    settled = (now.join(kinds.where("n > 1").select("rank", "context"), ["rank", "context"])
               .where(F.col("left") + core + F.col("right") >= length)
               .select("row", (F.col("a") - F.col("left")).alias("s"), (F.col("a") + core + F.col("right")).alias("e")))
    mixed = (kinds.groupBy("rank").agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
             .where("kinds > 1 and single > 0").select("rank", "kinds"))
    ask = kinds.join(mixed, "rank").select(
        F.col("one.row").alias("row"), F.struct(F.col("one.a").alias("a"), "rank", (F.col("n") == 1).alias("alone"),
                                                ).alias("w"))
    asked = ask.groupBy("row").agg(F.collect_list("w").alias("wanted"))
    contexts = stored(texts.select("row", "text").join(asked, "row")
                      .select("row", F.explode(_context_udf(length)("text", "wanted")).alias("c"))
                      .select("row", "c.*"), "context_bytes")
    sizes = contexts.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
    large = stored(sizes.where(F.col("n") > large_rank).select("rank"), "large_ranks")
    small = contexts.join(large, "rank", "left_anti")
    shares = max(1, -(-contexts.count() // CONTEXTS_PER_TASK))
    span = "row long, s int, e int"
    compared = small.groupBy(F.pmod(F.xxhash64("rank"), F.lit(shares)).alias("share")).applyInPandas(
        _compare(length), span)
    spans = settled.unionByName(compared)
    if not large.isEmpty():
        # A rank with very many contexts: its windows as rows, folded map-side.
        window = (contexts.join(large, "rank")
                  .select("row", "a", "rank", "alone", "left", "right", "x", F.explode(F.sequence(F.lit(0), F.lit(reach))).alias("o"))
                  .where((F.col("left") >= reach - F.col("o")) & (F.col("right") >= F.col("o")))
                  .select("row", "a", "rank", "alone", "o",
                          F.md5(F.substr("x", F.col("o") + 1, F.lit(length))).alias("w")))
        many = window.groupBy("rank", "o", "w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        spans = spans.unionByName(
            window.where("alone").join(many, ["rank", "o", "w"])
            .groupBy("row", "a").agg(F.min("o").alias("low"), F.max("o").alias("high"))
            .select("row", (F.col("a") - reach + F.col("low")).alias("s"),
                    (F.col("a") - reach + F.col("high") + length).alias("e")))
    per_row = spans.groupBy("row").agg(F.collect_set(F.struct("s", "e")).alias("spans"))

    cut = F.pandas_udf(_cut, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                             "spans array<struct<s:int,e:int>>")
    touched = (texts.select("row", "doc_id", "text").join(per_row, "row", "left")
               .select("doc_id", cut("text", "spans").alias("c")).select("doc_id", "c.*"))
    none = F.array().cast("array<struct<s:int,e:int>>")
    whole = base.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"),
                        F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
    untouched = whole.join(wanted.select("key"), "key", "left_anti").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        "kept_sha256", none.alias("spans"))
    return touched.unionByName(untouched)
