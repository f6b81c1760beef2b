"""Sharding by vector bin packing (operator 3).

Each shard should get the same share of bytes, tokens and rows.  Equal texts
form a group that stays together.  Groups are placed one by one, large ones
first, on the shard where the dot product of the group's vector with the
shard's residual capacity is highest.

The placing is sequential, so it runs on a bounded table: groups under a
1/K share of the corpus in every dimension are pooled by hash into K cells,
larger groups (fewer than 3K) stand alone.  A group larger than a whole shard
cannot be balanced in one piece; only such a group is spread over shards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwise.llm.common import stored, text_or_empty

#: Cells per shard; K = cells per shard * shards.
CELLS_PER_SHARD = 256
WORD = r"[^\x20\x09-\x0D]+"


def place(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each item; vectors are shares of the whole, one row an item."""
    residual = np.full((n_shards, vectors.shape[1]), 1.0 / n_shards)
    shard = np.zeros(len(vectors), dtype=int)
    for i in np.lexsort((np.arange(len(vectors)), -vectors.sum(axis=1))):
        shard[i] = int(np.argmax(residual @ vectors[i]))
        residual[shard[i]] -= vectors[i]
    return shard


def shard_documents(docs: DataFrame, n_shards: int = 8, cells_per_shard: int = CELLS_PER_SHARD,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, size, text_crc32, n_tokens, law ('bytes'), shard, slot,
    grown_shard (null under this law).

    size = UTF-8 bytes + 1; null text has size 1 and counts as empty.  Slots
    are gapless from 0 within a shard.  Repeated rows take a slot each; an
    empty table gives an empty result; further columns are not read.
    """
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    thin = stored(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
        F.xxhash64(text).alias("group"), F.monotonically_increasing_id().alias("row")), "shard_rows")
    k = n_shards * cells_per_shard
    dims = [F.sum("size").alias("bytes"), F.sum("n_tokens").alias("tokens"),
            F.count(F.lit(1)).alias("rows")]
    whole = thin.agg(*dims).first()
    total = np.array([whole["bytes"] or 1, whole["tokens"] or 1, whole["rows"] or 1], dtype=float)
    share = F.greatest(*[F.col(c) / F.lit(t) for c, t in zip(("bytes", "tokens", "rows"), total)])
    # Each large group holds over 1/k of some dimension: fewer than 3k rows.
    large = (thin.groupBy("group").agg(*dims).withColumn("share", share)
             .where(F.col("share") > 1.0 / k).orderBy("group").collect())
    schema = "group long, cell0 long, pieces long"
    table, item_of, at = [], {c: c for c in range(k)}, k
    for g in large:
        pieces = int(np.ceil(g["share"] * k))
        table.append((g["group"], at, pieces))
        together = g["share"] <= 1.0 / n_shards
        item_of |= {at + p: at if together else at + p for p in range(pieces)}
        at += pieces
    # fewer than 3k large groups and fewer than 6k of their pieces
    cells = (thin.join(F.broadcast(spark.createDataFrame(table, schema)), "group", "left")
             .withColumn("cell", F.coalesce(F.col("cell0") + F.pmod(F.xxhash64("row"), "pieces"),
                                            F.pmod(F.col("group"), F.lit(k)))))
    sums = sorted(cells.groupBy("cell").agg(*dims).collect())  # at most k + 6k rows
    items: dict[int, np.ndarray] = {}
    for cell, *vector in sums:
        item = item_of[cell]
        items[item] = items.get(item, 0) + np.array([x or 0 for x in vector], dtype=float)
    order = sorted(items)
    shards = dict(zip(order, place(np.array([items[i] / total for i in order]).reshape(-1, 3), n_shards)))
    filled = [0] * n_shards
    placed = []
    for cell, _, _, rows in sums:
        s = int(shards[item_of[cell]])
        placed.append((cell, s, filled[s]))
        filled[s] += rows
    places = spark.createDataFrame(placed, "cell long, shard int, slot0 long")
    # The number inside a cell: a cell holds at most about 1/k of the rows.
    inside = F.expr("row_number() over (partition by cell order by doc_id, row) - 1")
    return (cells.withColumn("inside", inside).join(F.broadcast(places), "cell")
            .select("doc_id", "size", "text_crc32", "n_tokens", F.lit("bytes").alias("law"), "shard",
                    (F.col("slot0") + F.col("inside")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
