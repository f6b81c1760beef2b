import random
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import pytest

from cellwise.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """conv_id -> turns, by the contract."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, x = role or "", text or ""
            own[c].append((turn is not None, turn or 0, sha256(f"{len(r)}:{r}{x}".encode()).digest()[:16], r, x))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, cs in members.items():
        own = (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += own
            leaves[p[:d]] += p not in kids
    return Counter((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], leaves[p], saved[p],
                    sha256(",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(p)).encode()).hexdigest())
                   for p, cs in members.items())


def conversations(seed=2, n=160):
    rnd = random.Random(seed)
    texts = ["hi", "héllo 😀", "", None, "more", "x" * 5000]
    rows = []
    for c in rnd.sample(range(-40, 400), n):
        for t in range(rnd.choice([1, 1, 2, 3, 5, 9, 12])):
            rows.append((c, t if rnd.random() < .95 else None, rnd.choice(["user", "assistant", None]),
                         "same" if rnd.random() < .5 else rnd.choice(texts)))
    rows += [(c, t, "user", "copy") for c in range(1000, 1300) for t in range(9)]
    rows += [rows[0], (None, 1, "user", "lost"), (5000, None, None, None), (5000, 7, "user", "a"), (5000, 7, "user", "b")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("range_bytes", [2 << 20, 100, 1500])
def test_matches_brute_force(spark, range_bytes):
    """Ranges of a key or two give the same nodes as one range."""
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as DIGEST", "2 as low", "'x' as key")
    got = Counter(tuple(r) for r in trie.conversation_trie(df, range_bytes=range_bytes).collect())
    assert got == brute(rebuilt(rows))


def test_plain_conversations_and_empty_table(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "a"), (3, 0, "u", "sera"), (4, 0, "user", "a")]
    got = Counter(tuple(r) for r in trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), rebuild=False).collect())
    assert got == brute({1: [("user", "a"), ("user", "b")], 2: [("user", "a")], 3: [("u", "sera")], 4: [("user", "a")]})
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_conversation(spark):
    rows = [(5, t, "user", str(t)) for t in range(3000)] + [(10, t, "user", str(t)) for t in range(2000)]
    got = Counter(tuple(r) for r in trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), range_bytes=8000).collect())
    assert got[(5, 3000, 5, 1, 0, 1, 0, sha256(b"5").hexdigest())] == 1
    assert len(got) == 3001 and sum(n for *_, n in got.items()) == 3001


@pytest.mark.parametrize("seed", range(4))
def test_radix_tree_holds_its_keys(seed):
    """Every layout, splits of paths, and keys that are prefixes of others."""
    rnd = random.Random(seed)
    keys = {bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(0, 12))) for _ in range(300)}
    keys |= {bytes([b]) + bytes([c]) * 3 for b in range(rnd.choice([3, 16, 40, 256])) for c in range(rnd.choice([2, 17, 60]))}
    order = list(keys)
    rnd.shuffle(order)
    tree = trie.RadixTree()
    for i, k in enumerate(order):
        tree.insert(k, i)
    found, prefix = {}, bytearray()
    for depth, added, value in tree.walk():
        prefix[depth - len(added):] = added
        if value is not None:
            found[bytes(prefix)] = value
    assert list(found) == sorted(keys) and all(order[v] == k for k, v in found.items())
