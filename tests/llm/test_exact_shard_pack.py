import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellwise.llm import exact, packing, shard
from cellwise.llm.queries import tokenizer_path
from tests.llm.util import DOC_SCHEMA, edge_docs, edge_frame, empty_frame


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def check_groups(rows, got, digest=lambda t: hashlib.sha256(t.encode()).hexdigest()):
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    want = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        first = True
        for i in sorted(ids, key=lambda x: (x is None, x or 0)):
            want[(i, keep, len(ids), first, digest(t))] += 1
            first = False
    assert Counter(tuple(r) for r in got) == want


def test_exact_report_with_edge_rows(spark):
    rows = edge_docs()
    check_groups(rows, exact.duplicate_report(edge_frame(spark)).collect())


def test_exact_many_batches(spark):
    rows = edge_docs()
    df = spark.createDataFrame(rows, DOC_SCHEMA).repartition(7)
    found, name = exact.duplicate_groups(df, files_per_batch=2)
    got = found.select("doc_id", *[name[k] for k in ("keep_id", "group_size", "kept", "digest")]).collect()
    check_groups(rows, got)


def test_exact_colliding_digests_fall_back_to_bytes(spark):
    rows = edge_docs()
    weak = lambda c: F.substring(exact.sha256(c), 1, 1)
    found, name = exact.duplicate_groups(spark.createDataFrame(rows, DOC_SCHEMA), digest=weak)
    got = found.select("doc_id", *[name[k] for k in ("keep_id", "group_size", "kept", "digest")]).collect()
    check_groups(rows, got, lambda t: hashlib.sha256(t.encode()).hexdigest()[0])


def test_exact_filter_keeps_columns_and_empty(spark):
    df = edge_frame(spark)
    out = exact.drop_exact_duplicates(df)
    assert out.columns == df.columns
    assert out.count() == len({norm(r[1]) for r in edge_docs()})
    e = exact.drop_exact_duplicates(empty_frame(spark))
    assert e.count() == 0 and e.columns == empty_frame(spark).columns
    assert exact.duplicate_report(empty_frame(spark)).count() == 0


def test_exact_plan_is_native(spark):
    from tests.conftest import plan_text
    assert not re.search("Python|Pandas|Arrow", plan_text(exact.duplicate_report(edge_frame(spark))))


def check_shards(rows, got, n):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t, *_ in rows)
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < n
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_edge_rows(spark):
    rows = edge_docs()
    got = shard.shard_documents(edge_frame(spark).drop("shard"), 4).collect()
    check_shards(rows, got, 4)
    where = defaultdict(set)
    for r in got:
        where[(r["size"], r["text_crc32"])].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())
    assert shard.shard_documents(empty_frame(spark)).count() == 0


def test_shards_balance_with_a_hot_group(spark):
    rows = [(i, "hot text " * 20 if i % 3 == 0 else f"text {i} " * (i % 40 + 1), "en", "s", 0) for i in range(3000)]
    got = shard.shard_documents(spark.createDataFrame(rows, DOC_SCHEMA), 8).collect()
    check_shards(rows, got, 8)
    by = defaultdict(lambda: np.zeros(3))
    for r in got:
        by[r["shard"]] += (r["size"], r["n_tokens"], 1)
    load = np.array([by[s] for s in range(8)])
    assert (load.max(0) / load.mean(0) < 1.03).all() and (load.min(0) / load.mean(0) > 0.97).all()


def check_packing(rows, got, ids_of):
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
    want = Counter()
    for i, t, *_ in rows:
        ids = np.array([*ids_of(t or ""), 2], dtype="<u4")
        head = len(ids) % 1024 or 1024
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, k, a, b - a, crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    seqs = defaultdict(list)
    for r in got:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    return len(seqs)


def test_packing_edge_rows(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    rows = edge_docs()
    got = packing.pack_documents(edge_frame(spark), tokenizer_path()).collect()
    n = check_packing(rows, got, lambda x: t.encode(x, add_special_tokens=False).ids)
    total = sum(r["length"] for r in got)
    assert n <= -(-total // 1024) + 1
    assert packing.pack_documents(empty_frame(spark), tokenizer_path()).count() == 0


def test_parts_exchange_until_certified(spark):
    rnd = np.random.default_rng(5)
    sizes = rnd.integers(250, 700, 4000)
    rows = spark.createDataFrame([(int(i), int(s)) for i, s in enumerate(sizes)], "row long, length long")
    got = packing.pack_pieces(rows, 1024, per_part=300).collect()
    assert Counter((r["row"], r["length"]) for r in got) == Counter((int(i), int(s)) for i, s in enumerate(sizes))
    fill = Counter()
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 1024
    bound = packing.lower_bound(np.bincount(sizes, minlength=1025))
    _, _, alone = packing.best_fit(sizes, 1024)
    assert bound <= len(fill) <= len(alone) * 1.02
    packed = spark.createDataFrame([(r["length"], r["sequence_id"]) for r in got], "length long, sequence_id long")
    report = packing.certificate(packed).first()
    assert tuple(report) == (len(fill), bound, len(fill) == bound)
    even = packed.limit(0).unionByName(spark.createDataFrame([(512, i // 2) for i in range(40)], "length long, sequence_id long"))
    assert tuple(packing.certificate(even).first()) == (20, 20, True)
    assert tuple(packing.certificate(packed.limit(0)).first()) == (0, 0, True)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10), min_size=1, max_size=7))
def test_bound_never_exceeds_the_optimum(sizes):
    def optimum(left, bins):
        if not left:
            return len(bins)
        best = len(bins) + len(left)
        for k in range(len(bins) + 1):
            if k == len(bins):
                best = min(best, optimum(left[1:], [*bins, left[0]]))
            elif bins[k] + left[0] <= 10:
                best = min(best, optimum(left[1:], [*bins[:k], bins[k] + left[0], *bins[k + 1:]]))
        return best

    a = np.array(sizes)
    _, _, fill = packing.best_fit(a, 10)
    assert packing.lower_bound(np.bincount(a, minlength=11)) <= optimum(sorted(sizes, reverse=True), []) <= len(fill)
    assert sum(fill) == sum(sizes) and max(fill) <= 10


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 2048, 5000])
def test_cut(n):
    c = packing.cut(n, 1024)
    assert sum(x for _, x in c) == n and all(x == 1024 for _, x in c[1:]) and 0 < c[0][1] <= 1024


@pytest.mark.parametrize("seed", range(5))
def test_place_is_the_plain_greedy(seed):
    """Item by item, the largest first, the shard of highest dot product."""
    rnd = random.Random(seed)
    vectors = [[rnd.choice([1, 2, 3, 50]) / 400 for _ in range(3)] for _ in range(60)]
    left = [[0.25] * 3 for _ in range(4)]
    want = [0] * len(vectors)
    for i in sorted(range(len(vectors)), key=lambda i: (-np.array(vectors[i]).sum(), i)):
        fit = [np.array(r) @ np.array(vectors[i]) for r in left]
        want[i] = fit.index(max(fit))
        left[want[i]] = [a - b for a, b in zip(left[want[i]], vectors[i])]
    got = shard.place(np.array(vectors), 4).tolist()
    totals = [np.array([v for v, s in zip(vectors, way) if s == k]).sum(axis=0) for way in (got, want) for k in range(4)]
    assert got == want or np.allclose(sorted(map(tuple, totals[:4])), sorted(map(tuple, totals[4:])))


def test_shards_of_small_tables_by_hand(spark):
    """Every text a group of its own cell or item: bytes, tokens and rows of
    the shards are those of the plain greedy placing of whole groups."""
    rows = [(i, "w" * (10 + 7 * (i % 5)) + " x" * (i % 3), "en", "s", 0) for i in range(30)]
    got = shard.shard_documents(spark.createDataFrame(rows, DOC_SCHEMA), 2, cells_per_shard=1).collect()
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t, []).append(i)
    where = {}
    for r in got:
        where.setdefault(rows[r["doc_id"]][1], set()).add(r["shard"])
    assert set(where) == set(groups) and all(len(s) == 1 for s in where.values())
    for s in range(2):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
