"""Best-fit packing with certified bounds (operator 9).

Documents become pieces of at most ``capacity`` tokens; a full piece is a
sequence of its own.  The others are dealt to partitions of bounded size, and
each partition packs its pieces by best-fit decreasing.  A dual feasible
function maps sizes so that any packing's bins hold a sum of at most one;
the rounded-up sum is therefore a lower bound on the bins, and a partition
that reaches it is certified optimal.  Partitions with a gap put the pieces
of their unfilled bins in common, are dealt anew and rerun, as long as that
saves bins; afterwards the emptiest bins of all partitions are packed together
in the same way.  :func:`certificate` reports the bins and the bound of a
whole result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.llm.bpe import library_id_bytes
from cellwise.llm.common import stored

CAPACITY = 1024
END_ID = 2
#: Pieces that one packing task gets (about).
PIECES_PER_PART = 20_000
_PIECE = "array<struct<piece:int,start:long,length:long,ids_crc32:long>>"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first is shorter."""
    head = n % capacity or capacity
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, row."""
    from zlib import crc32

    def run(texts: pd.Series) -> pd.Series:
        tail = end_id.to_bytes(4, "little")
        out = []
        for t in texts:
            ids = library_id_bytes(t or "", path) + tail
            out.append([{"piece": k, "start": s, "length": n, "ids_crc32": crc32(ids[4 * s:4 * (s + n)])}
                        for k, (s, n) in enumerate(cut(len(ids) // 4, capacity))])
        return pd.Series(out, dtype=object)

    udf = F.pandas_udf(run, _PIECE)
    return (docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                        F.explode(udf(F.col(f"`{text_col}`").cast("string"))).alias("_p"))
            .select("doc_id", "_p.*", F.monotonically_increasing_id().alias("row")))


def lower_bound(counts: np.ndarray) -> int:
    """Bins that any packing needs; ``counts[s]`` pieces have size s.

    Two families of dual feasible functions: rounding to k-ths, and cutting
    small sizes while large ones fill a bin.
    """
    cap = len(counts) - 1
    sizes = np.arange(cap + 1)
    total = int(counts @ sizes)
    best = -(-total // cap)
    for k in range(1, 101):
        scaled = (k + 1) * sizes
        whole = scaled % cap == 0
        # f(x) = x at multiples of 1/(k+1), else floor((k+1)x)/k; over k*cap
        value = np.where(whole, sizes * k, scaled // cap * cap)
        best = max(best, -(-int(counts @ value) // (k * cap)))
    large = np.cumsum(counts[::-1])[::-1]           # pieces of size >= s
    mass = np.concatenate([[0], np.cumsum(counts * sizes)])
    for eps in range(1, cap // 2 + 1):
        above = int(large[cap - eps + 1]) if cap - eps + 1 <= cap else 0
        middle = int(mass[cap - eps + 1] - mass[eps])
        best = max(best, -(-(above * cap + middle) // cap))
    return int(best)


def best_fit(sizes: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: bin and offset of each piece, and the bins' fill."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(cap + 1)]  # by free space
    free = 0  # bit r is set where a bin with r free tokens is open
    fill: list[int] = []
    for i, s in zip(order.tolist(), sizes[order].tolist()):
        fitting = free >> s
        if fitting:
            r = s + (fitting & -fitting).bit_length() - 1
            b = open_bins[r].pop()
            if not open_bins[r]:
                free &= ~(1 << r)
        else:
            r, b = cap, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += s
        if r > s:
            open_bins[r - s].append(b)
            free |= 1 << (r - s)
    return bins, offsets, fill


def _pack(rows: DataFrame, cap: int, round_no: int, seed: int, n_parts: int) -> DataFrame:
    """Deal ``rows`` to parts and pack each; the fate of every row is stored."""
    cols = rows.columns
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(F.col("row"), F.lit(seed)), F.lit(n_parts)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["length"].to_numpy()
        bins, offsets, fill = best_fit(sizes, cap)
        bound = lower_bound(np.bincount(sizes, minlength=cap + 1))
        fills = np.array(fill)
        emptiest = int(fills.argmin())
        return pdf.assign(bin=bins, offset=offsets, fill=fills[bins], gap=len(fill) - bound,
                          emptiest=bins == emptiest)

    schema = rows.select(*cols).schema.simpleString()[7:-1] + \
        ",part:bigint,bin:bigint,offset:bigint,fill:bigint,gap:bigint,emptiest:boolean"
    packed = stored(dealt.groupBy("part").applyInPandas(run, schema), "packing_round")
    # 2^16 rounds, 2^27 parts, 2^20 bins a part
    number = (F.lit(round_no) * F.lit(1 << 47) + F.col("part") * F.lit(1 << 20) + F.col("bin"))
    return packed.withColumn("sequence_id", number)


def pack_pieces(rows: DataFrame, capacity: int = CAPACITY, per_part: int = PIECES_PER_PART) -> DataFrame:
    """``rows`` (with ``row``, unique, and ``length`` in 1..capacity) plus
    sequence_id and offset.  Rows are read twice: pass a stored frame."""
    cols = [c for c in rows.columns if c not in ("sequence_id", "offset")]
    out_cols = [*cols, "sequence_id", "offset"]
    done = [rows.where(F.col("length") == capacity).select(
        *cols, (F.lit(1 << 62) + F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest = rows.where(F.col("length") < capacity).select(*cols)
    packed, k, tails = _pack(rest, capacity, 0, 0, max(1, -(-rest.count() // per_part))), 0, []
    while True:
        # Certified parts are settled but for their emptiest bin; of the others
        # the full bins are settled and the rest is exchanged.
        loose = (F.col("gap") > 0) & (F.col("fill") < capacity)
        last = (F.col("gap") <= 0) & F.col("emptiest") & (F.col("fill") < capacity)
        done.append(packed.where(~loose & ~last).select(*out_cols))
        tails.append(packed.where(last).select(*cols))
        pool = packed.where(loose)
        n, with_gap, bins = pool.agg(F.count(F.lit(1)), F.countDistinct("part"), F.countDistinct("sequence_id")).first()
        if not n:
            break
        # Fewer parts than before, so that other pieces meet.
        k, parts = k + 1, max(1, min(-(-n // per_part), with_gap - 1))
        again = _pack(pool.select(*cols), capacity, k, k, parts)
        if again.select("sequence_id").distinct().count() >= bins:
            done.append(pool.select(*out_cols))
            break
        packed = again
    tails = reduce(DataFrame.unionByName, tails)
    n = tails.count()
    if n:
        done.append(_pack(tails, capacity, k + 1, k + 1, -(-n // per_part)).select(*out_cols))
    return reduce(DataFrame.unionByName, done)


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: the sequences of a packing (length, sequence_id), a lower
    bound on those of any packing, and whether they are equal."""
    # At most ``capacity`` rows.
    sizes = packed.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in sizes:
        counts[r["length"]] = r["n"]
    bound = F.lit(lower_bound(counts)).cast("long")
    return packed.agg(F.countDistinct("sequence_id").alias("sequences")).select(
        "sequences", bound.alias("bound"), (F.col("sequences") == bound).alias("certified"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty: one piece that holds the end token alone.
    Repeated rows are packed each; an empty table gives an empty result.
    """
    rows = stored(pieces(docs, path, capacity, end_id, id_col, text_col), "pieces")
    return pack_pieces(rows, capacity).drop("row")
