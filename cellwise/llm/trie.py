"""Prefix trie of conversations on adaptive radix trees (operator 13).

A turn's id is 16 bytes, the first half of a SHA-256 of its role and text, so
a conversation is a byte key: its turns' ids one after the other, big-endian
and of fixed width.  Equal keys are folded, the keys are cut into ranges of
bounded bytes in key order, and each range is inserted into an adaptive radix
tree: nodes grow from 4 to 16, 48 and 256 children, single-child stretches are
compressed into a path.  Only byte depths that are whole turns are nodes of
the result.

A prefix can lie in several ranges (the path of a range's first or last key).
Each range counts a prefix's own share of members, leaves, children and saved
bytes, and what belongs to the prefix once (being a node, a child, a leaf) is
counted by the first range that has it: every range also gets the last key of
the range before and the first one of the range after.  So all counts add up,
no range or prefix is too frequent to split, and texts are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwise.functions.ranges import running_totals
from cellwise.llm.common import stored, text_or_empty

#: Bytes of a turn's id.
WIDTH = 16
#: Key bytes of a range (the last key may go over).
RANGE_BYTES = 2 << 20
#: Conversation ids are hashed from pieces of so many ids.
PIECE = 10_000
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


class Node4:
    """Up to ``SIZE`` children in byte order, found by looking through them."""

    SIZE = 4
    __slots__ = ("labels", "below")

    def __init__(self, labels: bytes = b"", below: list | None = None):
        self.labels, self.below = labels, below or []

    def get(self, b: int):
        i = self.labels.find(b)
        return self.below[i] if i >= 0 else None

    def put(self, b: int, child) -> bool:
        """Add or replace a child; False if the node is full."""
        i = self.labels.find(b)
        if i >= 0:
            self.below[i] = child
            return True
        if len(self.labels) >= self.SIZE:
            return False
        i = sum(x < b for x in self.labels)
        self.labels = self.labels[:i] + bytes([b]) + self.labels[i:]
        self.below.insert(i, child)
        return True

    def items(self) -> Iterator[tuple[int, object]]:
        return zip(self.labels, self.below)


class Node16(Node4):
    SIZE = 16
    __slots__ = ()


class Node48:
    """A byte-indexed table of slots; up to 48 children in order of arrival."""

    SIZE = 48
    __slots__ = ("slot", "below")

    def __init__(self):
        self.slot, self.below = bytearray(b"\xff" * 256), []

    def get(self, b: int):
        i = self.slot[b]
        return self.below[i] if i != 0xFF else None

    def put(self, b: int, child) -> bool:
        i = self.slot[b]
        if i != 0xFF:
            self.below[i] = child
            return True
        if len(self.below) >= self.SIZE:
            return False
        self.slot[b] = len(self.below)
        self.below.append(child)
        return True

    def items(self) -> Iterator[tuple[int, object]]:
        return ((b, self.below[i]) for b, i in enumerate(self.slot) if i != 0xFF)


class Node256:
    """A child for every byte."""

    SIZE = 256
    __slots__ = ("below",)

    def __init__(self):
        self.below: list = [None] * 256

    def get(self, b: int):
        return self.below[b]

    def put(self, b: int, child) -> bool:
        self.below[b] = child
        return True

    def items(self) -> Iterator[tuple[int, object]]:
        return ((b, c) for b, c in enumerate(self.below) if c is not None)


LAYOUTS = (Node4, Node16, Node48, Node256)


class Branch:
    """A compressed path of bytes, the value of the key that ends after it
    (None: no key does), and the children in the smallest layout that fits."""

    __slots__ = ("path", "value", "node")

    def __init__(self, path: bytes, value=None):
        self.path, self.value, self.node = path, value, Node4()

    def put(self, b: int, child: Branch) -> None:
        if not self.node.put(b, child):
            larger = LAYOUTS[LAYOUTS.index(type(self.node)) + 1]()
            for label, old in self.node.items():
                larger.put(label, old)
            larger.put(b, child)
            self.node = larger


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class RadixTree:
    """Adaptive radix tree from byte keys to values (not None)."""

    def __init__(self):
        self.root = Branch(b"")

    def insert(self, key: bytes, value) -> None:
        here, above, label = self.root, None, 0
        while True:
            n = _shared(here.path, key)
            if n < len(here.path):  # split the path
                upper = Branch(here.path[:n])
                upper.put(here.path[n], here)
                here.path = here.path[n + 1:]
                if above is None:
                    self.root = upper
                else:
                    above.put(label, upper)
                here = upper
            key = key[n:]
            if not key:
                here.value = value
                return
            below = here.node.get(key[0])
            if below is None:
                here.put(key[0], Branch(key[1:], value))
                return
            above, label, here, key = here, key[0], below, key[1:]

    def walk(self) -> Iterator[tuple[int, bytes, object]]:
        """(byte depth of the end, bytes since the branch above, value) of
        every branch, each before its children and these in byte order."""
        todo = [(0, b"", self.root)]
        while todo:
            depth, label, branch = todo.pop()
            depth += len(label) + len(branch.path)
            yield depth, label + branch.path, branch.value
            todo.extend((depth, bytes([b]), child) for b, child in sorted(branch.node.items(), reverse=True))


class _Open:
    """A prefix whose subtree is being walked; ``owned``: no earlier range has
    it, ``goes_on``: the next range does."""

    __slots__ = ("digest", "parent", "depth", "size", "owned", "goes_on", "state",
                 "n", "low", "children", "leaves", "saved", "inner", "ends")

    def __init__(self, state, parent: bytes | None, depth: int, size: int, owned: bool, goes_on: bool):
        self.state, self.digest, self.parent = state, state.digest(), parent
        self.depth, self.size, self.owned, self.goes_on = depth, size, owned, goes_on
        self.n = self.children = self.leaves = self.saved = 0
        self.low: int | None = None
        self.inner = self.ends = False


def range_nodes(keys: list[bytes], sizes: list, counts: list[int], lows: list[int],
                before: bytes | None = None, after: bytes | None = None) -> Iterator[tuple]:
    """One range's share in each of its prefixes: (digest, parent's digest,
    depth, n_convs, conv_id, n_children, n_leaves, saved bytes), the last two
    over the subtree.

    ``keys`` are distinct and follow ``before``; ``sizes`` has the text bytes
    of each key's turns, ``counts`` and ``lows`` the number and the smallest
    of its conversations.  What ``before`` starts with is owned there; a key
    that ``after`` goes on from is no leaf.
    """
    tree, bytes_of = RadixTree(), {}
    for i, key in enumerate(keys):
        tree.insert(key, i)
        for t, size in enumerate(sizes[i]):
            bytes_of[key[t * WIDTH:(t + 1) * WIDTH]] = int(size)
    opened: list[_Open] = []
    prefix = bytearray()

    def close() -> tuple:
        u = opened.pop()
        if u.ends and not u.inner and not u.goes_on:
            u.leaves = 1
        u.saved += (u.n - u.owned) * u.size
        if opened:
            up = opened[-1]
            up.n, up.leaves, up.saved = up.n + u.n, up.leaves + u.leaves, up.saved + u.saved
            up.low = u.low if up.low is None else min(up.low, u.low)
            up.children, up.inner = up.children + u.owned, True
        return u.digest, u.parent, u.depth, u.n, u.low, u.children, u.leaves, u.saved

    opened.append(_Open(hashlib.sha256(), None, 0, 0, before is None, after is not None))
    for depth, added, value in tree.walk():
        start = depth - len(added)
        while opened[-1].depth * WIDTH > start:
            yield close()
        prefix[start:] = added
        for d in range(start // WIDTH + 1, depth // WIDTH + 1):
            at = slice((d - 1) * WIDTH, d * WIDTH)
            turn, up = bytes(prefix[at]), opened[-1]
            state = up.state.copy()
            state.update(turn)
            opened.append(_Open(state, up.digest, d, bytes_of[turn], up.owned or before[at] != turn,
                                up.goes_on and after[at] == turn))
        if value is not None:
            top = opened[-1]
            top.n, top.ends = top.n + counts[value], True
            top.low = lows[value] if top.low is None else min(top.low, lows[value])
    while opened:
        yield close()


def turn_id(role: Column, text: Column) -> Column:
    """WIDTH bytes that name a turn's role and text."""
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(named, 256), 1, 2 * WIDTH))


def turn_lists(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv_id, turns): each conversation's (id, size) in turn order, null
    first, equal turn numbers by id."""
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    rows = conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").isNotNull().alias("numbered"),
        F.col(f"`{turn_col}`").alias("turn"), turn_id(role, text).alias("id"), F.octet_length(text).alias("size"))
    return (rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("numbered", "turn", "id", "size"))).alias("t"))
            .select("conv_id", F.transform("t", lambda x: F.struct(x["id"], x["size"])).alias("turns")))


def rebuilt(lists: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation c on the first h turns of conversation c - c %
    family; h = crc32(decimal c) % heads, and c's own first h turns go."""
    own = F.col("conv_id")
    starts = (lists.where(own % family == 0).select(own.alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
              .select("base", "head", F.explode(F.sequence(F.col("base") - (family - 1), F.col("base") + (family - 1))).alias("conv_id"))
              .where(own - own % family == F.col("base")).select("conv_id", "head"))
    h = (F.crc32(own.cast("string").cast("binary")) % heads).cast("int")
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    return lists.join(starts, "conv_id", "left").select(
        "conv_id", F.concat(head, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def keyed(lists: DataFrame) -> DataFrame:
    """(conv_id, digest, key, sizes) of turn lists."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), ""))
    return lists.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes")).select(
        "conv_id", F.unhex(F.sha2("key", 256)).alias("digest"), "key", "sizes")


def end_hashes(named: DataFrame) -> DataFrame:
    """(digest, ends_sha256): SHA-256 of each key's conversation ids, ascending
    and joined by commas.  Ids are joined in pieces of at most PIECE; a digest's
    pieces stream through one task in order, none held longer than a batch."""
    pieces = (named.groupBy("digest", F.floor(F.col("conv_id") / F.lit(PIECE)).alias("piece"))
              .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
              .select("digest", "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = state = None
        for pdf in batches:
            done = []
            for d, ids in zip(pdf["digest"], pdf["ids"]):
                if d == digest:
                    state.update(b"," + ids.encode())
                else:
                    if state is not None:
                        done.append((digest, state.hexdigest()))
                    digest, state = d, hashlib.sha256(ids.encode())
            if done:
                yield pd.DataFrame(done, columns=["digest", "ends_sha256"])
        if state is not None:
            yield pd.DataFrame([(digest, state.hexdigest())], columns=["digest", "ends_sha256"])

    return (pieces.repartition("digest").sortWithinPartitions("digest", "piece")
            .mapInPandas(run, "digest binary, ends_sha256 string"))


def prefix_nodes(named: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(digest, parent, depth, conv_id, n_convs, n_children, n_leaves,
    saved_tokens) of every prefix of the keys (conv_id, digest, key, sizes)."""
    folded = named.groupBy("digest").agg(F.first("key").alias("key"), F.first("sizes").alias("sizes"),
                                         F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"))
    wide = folded.select("key", "sizes", "n", "low", (F.octet_length("key") + WIDTH).cast("long").alias("w"))
    placed = stored(running_totals(wide, [], ["key"], ["w"]), "trie_keys")
    number = F.floor(F.col("cum_w") / F.lit(range_bytes))
    ranged = placed.withColumn("range", number)
    # The key after a range's last one begins where that one ends; the end of
    # all keys may lie in the last range.
    edges = stored(ranged.groupBy("range").agg(F.min("key").alias("low"), F.max("key").alias("high"),
                                               F.floor(F.max(F.col("cum_w") + F.col("w")) / F.lit(range_bytes)).alias("next")), "trie_edges")
    inner = edges.where(F.col("next") > F.col("range"))
    left = inner.select(F.col("next").alias("range"), F.col("high").alias("key"), F.lit(-1).alias("side")).join(
        edges.select("range"), "range", "left_semi")
    right = inner.select("range", "next").join(edges.select(F.col("range").alias("next"), F.col("low").alias("key")), "next").select(
        "range", "key", F.lit(1).alias("side"))
    rows = ranged.select("range", "key", F.lit(0).alias("side"), "sizes", "n", "low").unionByName(
        left.unionByName(right), allowMissingColumns=True)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        edge = {int(s): k for s, k in zip(pdf["side"], pdf["key"]) if s}
        own = pdf[pdf["side"] == 0]
        nodes = range_nodes(list(own["key"]), list(own["sizes"]), [int(x) for x in own["n"]],
                            [int(x) for x in own["low"]], edge.get(-1), edge.get(1))
        return pd.DataFrame(list(nodes), columns=["digest", "parent", "depth", "n", "low", "children", "leaves", "saved"])

    shares = rows.groupBy("range").applyInPandas(
        build, "digest binary, parent binary, depth long, n long, low long, children long, leaves long, saved long")
    return shares.groupBy("digest", "parent", "depth").agg(
        F.min("low").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("children").alias("n_children"),
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text", rebuild: bool = True,
                      range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per prefix: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256; ``rebuild=False`` takes the
    conversations as they are.

    Turns go by number, null first; equal numbers by a hash of role and text;
    a repeated row is a turn again.  Null role or text is empty.  Rows without
    a conversation id belong to none and are left out.  A conversation may
    have no turns left when rebuilt: it ends at the root.  An empty table
    gives an empty result.  One task holds the ids of one conversation (16
    bytes a turn) and the keys of one range.
    """
    lists = turn_lists(conversations, conv_col, turn_col, role_col, text_col)
    named = stored(keyed(rebuilt(stored(lists, "turn_lists")) if rebuild else lists), "conversation_keys")
    nodes = stored(prefix_nodes(named, range_bytes), "prefix_nodes")
    parents = nodes.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(parents, "parent", "left").join(end_hashes(named.select("digest", "conv_id")), "digest", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256")))
