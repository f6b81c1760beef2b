"""Word 5-gram Jaccard join by chosen paths (operator 6).

Texts with the same words are one node.  A node's set holds the hashes of its
5-word shingles; a signature keeps, for each of many random orders, the set's
first token.  A run splits the nodes on one sampled token; a bucket that is
still large is split again on tokens sampled for its path, and so on (the
chosen-path tree), while small buckets are compared by brute force.  Runs are
repeated until a pair at the threshold is met with the target probability.

What the buckets yield is only a candidate graph with a few links per node.
Its components are then compared exactly: every pair within a component, in
blocks that are tasks of their own, so a component that holds a third of all
rows is spread.  Links are counted, never listed, and the exact links'
components are the classes.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.llm.common import fresh, stored
from cellwise.llm.components import components
from cellwise.llm.grams import gram_hashes, words_of

WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.9999
#: Random orders in a signature.
ORDERS = 128
#: Signatures agree at least so far if the sets are THRESHOLD alike: five
#: standard deviations below the mean.
SIMILAR = THRESHOLD - 5 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / ORDERS)
#: Nodes of a bucket that is compared by brute force.
SMALL_BUCKET = 4096
BRANCHES = 2
#: Nodes (about) of small buckets that one brute-force task gets.
NODES_PER_TASK = 10_000
#: Levels of the tree; nodes that still share a large bucket there agree on
#: this many sampled tokens and are handed to the exact comparison together.
MAX_DEPTH = 10
#: Nodes of a block of the exact comparison.
BLOCK = 4096
#: Shingles (about) that one task of the exact comparison takes of small components.
TASK_SHINGLES = 2_000_000
_ODD = np.random.default_rng(20240901).integers(0, 2**63, ORDERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles."""
    return np.unique(gram_hashes(words_of(text), k))


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(ORDERS, 0xFFFFFFFF, dtype=np.uint64)
    for a in range(0, len(shingles), 2048):
        low = np.minimum(low, ((shingles[a:a + 2048, None] * _ODD) >> np.uint64(32)).min(axis=0))
    return low.astype("<u4")


def runs_needed(target: float = TARGET_RECALL, threshold: float = THRESHOLD, branches: int = BRANCHES,
                depth: int = MAX_DEPTH) -> int:
    """Runs after which a pair at the threshold has met with probability
    ``target``, whatever the depth of its buckets."""
    meet = 1.0
    for _ in range(depth):
        meet = 1 - (1 - threshold * meet) ** branches
    return math.ceil(math.log(1 - target) / math.log(1 - threshold * meet))


def _sketches(texts: pd.Series) -> pd.DataFrame:
    out = []
    for t in texts:
        s = shingle_set(t)
        out.append((blake2b(b" ".join(words_of(t)), digest_size=16).digest(), len(s), signature(s).tobytes()))
    return pd.DataFrame(out, columns=["words", "n", "sig"])


def _coordinate(sig: Column, k: Column) -> Column:
    """Bytes of one signature value (4 bytes each)."""
    return F.substr(sig, k * 4 + 1, F.lit(4))


def _alike(sigs: list[bytes]) -> np.ndarray:
    """Local root of each node: the components of pairs with like signatures."""
    m = np.frombuffer(b"".join(sigs), dtype="<u4").reshape(len(sigs), ORDERS)
    need = math.ceil(SIMILAR * ORDERS)
    return _local_roots(len(sigs), lambda i: np.count_nonzero(m[i + 1:] == m[i], axis=1) >= need)


def _local_roots(n: int, later_links) -> np.ndarray:
    root = np.arange(n)

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(n - 1):
        for j in np.flatnonzero(later_links(i)).tolist():
            a, b = find(i), find(i + 1 + j)
            if a != b:
                root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)])


def _bucket_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Star links (a, b) of the buckets of one task's share."""
    a, b = [], []
    for _, g in pdf.sort_values("node").groupby("bucket", sort=False):
        nodes = g["node"].to_numpy()
        roots = _alike(list(g["sig"]))
        far = roots != np.arange(len(roots))
        a.append(nodes[far])
        b.append(nodes[roots[far]])
    return pd.DataFrame({"a": np.concatenate(a or [[]]).astype("int64"), "b": np.concatenate(b or [[]]).astype("int64")})


def candidate_links(nodes: DataFrame, runs: int, small: int = SMALL_BUCKET, branches: int = BRANCHES,
                    max_depth: int = MAX_DEPTH) -> DataFrame:
    """Links (a, b) between nodes (node, sig) that likely pass the threshold,
    a few per node; from the chosen-path tree of each run."""
    thin = nodes.select("node", "sig")
    # level 0: run r splits on token r
    now = thin.select("node", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)),
        lambda r: F.xxhash64(r, _coordinate(F.col("sig"), r)))).alias("bucket"))
    links = None
    for level in range(max_depth + 1):
        now = stored(now, "path_level")
        sizes = stored(now.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "path_sizes")
        held = now.join(sizes, "bucket")
        if level == max_depth:
            # These agree on every sampled token: compare them exactly.
            first = now.groupBy("bucket").agg(F.min("node").alias("b"))
            large = (held.where(F.col("n") > small).join(first, "bucket")
                     .select(F.col("node").alias("a"), "b"))
        is_small = F.col("n") <= small
        n_leaf, n_large = sizes.agg(F.sum(F.when(is_small, F.col("n"))), F.count_if(~is_small)).first()
        # Many buckets share a task; a bucket never exceeds `small` nodes.
        shares = max(1, -(-(n_leaf or 0) // NODES_PER_TASK))
        # Signatures are the large side at any scale: one plan for all sizes.
        leaf = (held.where(is_small).select("node", "bucket").hint("merge").join(thin, "node")
                .select("bucket", "node", "sig"))
        found = leaf.groupBy(F.pmod(F.xxhash64("bucket"), F.lit(shares)).alias("share")).applyInPandas(
            _bucket_links, "a long, b long")
        links = found if links is None else links.unionByName(found)
        if not n_large:
            break
        if level == max_depth:
            links = links.unionByName(large)
            break
        split = (held.where(F.col("n") > small).join(thin, "node")
                 .select("node", "sig", "bucket", F.explode(F.sequence(F.lit(1), F.lit(branches))).alias("j")))
        token = F.pmod(F.xxhash64("bucket", "j"), F.lit(ORDERS)).cast("int")
        now = split.select("node", F.xxhash64("bucket", "j", _coordinate(F.col("sig"), token)).alias("bucket"))
    return links


def _exact(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Exact links inside one group: per node its number of links and the
    first node (by ``rank``) of its linked ones.  ``side`` 0 and 1 are the two
    blocks of a pair (only pairs across count); side 2 is a whole set."""
    nodes, counts, hangs = [], [], []
    for _, g in pdf.sort_values(["side", "no_id", "id", "node"], kind="stable").groupby("root", sort=False):
        sets = [np.frombuffer(x, dtype="<u8") for x in g["shingles"]]
        side = g["side"].to_numpy()
        node = g["node"].to_numpy()
        size = np.array([len(s) for s in sets])
        _, tokens = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        mark = np.zeros(tokens.max() + 1, dtype=bool)
        links = np.zeros(len(sets), dtype=np.int64)

        def later(i):
            if side[i] == 1:
                return np.zeros(len(sets) - i - 1, dtype=bool)
            own = tokens[starts[i]:starts[i] + size[i]]
            mark[own] = True
            at = starts[i] + size[i]
            shared = np.add.reduceat(mark[tokens[at:]], starts[i + 1:] - at, dtype=np.int64)
            mark[own] = False
            ok = shared >= threshold * (size[i] + size[i + 1:] - shared) - 1e-9
            if side[i] == 0:
                ok &= side[i + 1:] == 1
            links[i] += np.count_nonzero(ok)
            links[i + 1:] += ok
            return ok

        roots = _local_roots(len(sets), later)
        nodes.append(node)
        counts.append(links)
        hangs.append(node[roots])
    return pd.DataFrame({"node": np.concatenate(nodes), "n": np.concatenate(counts), "hang": np.concatenate(hangs)})


def _shingle_bytes(texts: pd.Series) -> pd.Series:
    return pd.Series([shingle_set(t).tobytes() for t in texts],
                     dtype=object)


def _judged(numbered: DataFrame, row: str, id_col: str, text_col: str, threshold: float, target_recall: float,
            small: int, block: int, max_depth: int) -> DataFrame:
    """(row, id, class_id, class_row, n_links, n_copies) per row of ``numbered``."""
    sketch = F.pandas_udf(_sketches, "words binary, n int, sig binary")
    # Order of the rows: by id, nulls last, then by row.
    rank = F.struct(F.col(f"`{id_col}`").isNull().alias("no_id"), F.col(f"`{id_col}`").cast("long").alias("id"),
                    F.col(row).alias("row"))
    rows = stored(numbered.select(rank.alias("rank"), sketch(F.col(f"`{text_col}`").cast("string")).alias("s"))
                  .select("rank", "s.*"), "near_sketches")
    texts_once = stored(rows.where("n > 0").groupBy("words").agg(
        F.min("rank").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig"))
        .select(F.col("first")["row"].alias("node"), "first", "words", "copies", "sig"), "near_nodes")
    runs = runs_needed(target_recall, threshold)
    links = candidate_links(texts_once, runs, small, max_depth=max_depth)
    member = stored(components(links, "near_candidates"), "near_members")

    # Exact comparison inside the candidate components, block by block.
    comp_size = member.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    texts = numbered.select(F.col(row).alias("node"), F.col(f"`{id_col}`").cast("long").alias("id"),
                            F.col(f"`{text_col}`").cast("string").alias("text"))
    # The texts are the large side at any scale: one plan for all sizes.
    sets = stored(member.join(comp_size, "root").hint("merge").join(texts, "node")
                  .select("node", "root", "size", "id",
                          F.pandas_udf(_shingle_bytes, "binary")("text").alias("shingles")), "near_sets")
    n_blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    cells = F.when(n_blocks == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(2).alias("side")))
                   ).otherwise(F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda x: F.struct(
                       F.least(x, F.col("mine")).alias("i"), F.greatest(x, F.col("mine")).alias("j"),
                       F.when(x == F.col("mine"), F.lit(2)).when(F.col("mine") < x, F.lit(0)).otherwise(F.lit(1))
                       .alias("side"))))
    total, largest = sets.agg(F.sum(F.octet_length("shingles")), F.max("size")).first()
    shares = max(1, -(-(total or 0) // (8 * TASK_SHINGLES)))
    placed = (sets.withColumn("mine", F.pmod(F.xxhash64("node"), n_blocks).cast("int"))
              .select("node", "root", "size", "id", "shingles", F.explode(cells).alias("cell"))
              .select("node", "root", "shingles", F.col("id").isNull().alias("no_id"), "id",
                      F.col("cell.side").alias("side"),
                      F.when(n_blocks == 1, F.pmod(F.xxhash64("root"), F.lit(shares)))
                      .otherwise(F.col("root")).alias("share"), "cell.i", "cell.j", (n_blocks == 1).alias("whole")))
    exact = placed.groupBy("share", "i", "j", "whole").applyInPandas(
        lambda pdf: _exact(pdf, threshold), "node long, n long, hang long")
    if (largest or 0) <= block:
        # Every component was one block, so its local roots are the classes.
        found = exact.select("node", F.col("hang").alias("lead"), F.col("n").alias("links"))
    else:
        exact = stored(exact, "near_exact")
        first = texts_once.select("node", "first")
        classes = components(exact.select(F.col("node").alias("a"), F.col("hang").alias("b")), "near_links")
        lead = (classes.join(first, "node").groupBy("root").agg(F.min("first").alias("first"))
                .select("root", F.col("first")["row"].alias("lead")))
        found = (exact.groupBy("node").agg(F.sum("n").alias("links"))
                 .join(classes.join(lead, "root").select("node", "lead"), "node", "left")
                 .select("node", F.coalesce("lead", "node").alias("lead"), "links"))
    # The class takes its id from the row that leads it.
    found = stored(found, "near_classes")
    ids = texts_once.select(F.col("node").alias("lead"), F.col("first")["id"].alias("class_id"))
    found = found.join(ids, "lead")
    nodes = texts_once.select("node", F.col("first")["id"].alias("own_id"), "words", "copies").join(
        found, "node", "left").select(
        "words", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("lead", "node").alias("lead"),
        F.when(F.col("lead").isNull(), F.col("own_id")).otherwise(F.col("class_id")).alias("class_id"))
    some = F.col("n") > 0
    return rows.join(nodes, "words", "left").select(
        F.col("rank")["row"].alias("row"), F.col("rank")["id"].alias("id"),
        F.when(some, F.col("class_id")).otherwise(F.col("rank")["id"]).alias("class_id"),
        F.when(some, F.col("lead")).otherwise(F.col("rank")["row"]).alias("class_row"),
        F.when(some, F.col("links")).otherwise(F.lit(0)).alias("n_links"),
        F.when(some, F.col("copies")).otherwise(F.lit(1)).alias("n_copies"))


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number each, written once so that it never changes."""
    row = fresh(docs, "row")
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "near_rows"), row


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 target_recall: float = TARGET_RECALL, small: int = SMALL_BUCKET, block: int = BLOCK,
                 max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its class),
    n_links (other texts that pass the threshold; copies of a text count
    once), n_copies (rows with the same words) and class_first (this row
    represents its class).

    Sets are compared over words as written; a text of one to four words is a
    single shingle.  Null and empty texts have no set: each is a class of its
    own without links.  Null ids come last.  An empty table gives an empty
    result; extra columns are not read.
    """
    numbered, row = _numbered(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")))
    found = _judged(numbered, row, "doc_id", "text", threshold, target_recall, small, block, max_depth)
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links", "n_copies",
                        (F.col("class_row") == F.col("row")).alias("class_first"))


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL,
                       small: int = SMALL_BUCKET, block: int = BLOCK, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The rows of ``docs`` that represent their class, columns unchanged."""
    numbered, row = _numbered(docs)
    found = _judged(numbered, row, id_col, text_col, threshold, target_recall, small, block, max_depth)
    # Rows that go are the smaller list.
    gone = found.where("class_row <> row").select(F.col("row").alias(row))
    return numbered.join(gone, row, "left_anti").select(*docs.columns)


class_report = near_classes
