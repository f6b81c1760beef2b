import random
from collections import Counter

import numpy as np
import pytest

from cellwise.llm import near
from cellwise.llm.components import components
from tests.llm.util import edge_docs, edge_frame, empty_frame, words


def shingles(t):
    w = (t or "").encode().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """(id, class id, links, copies) per row, ids unique or null."""
    sets = [shingles(r[1]) for r in rows]
    seqs = [tuple((r[1] or "").encode().split()) for r in rows]
    key = [(r[0] is None, r[0] or 0, k) for k, r in enumerate(rows)]
    texts = {}
    for k, s in enumerate(seqs):
        if s:
            texts.setdefault(s, []).append(k)
    reps = list(texts)
    parent = {s: s for s in reps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for a in range(len(reps)):
        for b in range(a):
            x, y = sets[texts[reps[a]][0]], sets[texts[reps[b]][0]]
            n = len(x & y)
            if n and n >= 0.8 * (len(x) + len(y) - n) - 1e-9:
                links[reps[a]] += 1
                links[reps[b]] += 1
                parent[find(reps[a])] = find(reps[b])
    groups = {}
    for s in reps:
        groups.setdefault(find(s), []).extend(texts[s])
    out = Counter()
    for k, r in enumerate(rows):
        if not seqs[k]:
            out[(r[0], r[0], 0, 1)] += 1
        else:
            lead = min(groups[find(seqs[k])], key=key.__getitem__)
            out[(r[0], rows[lead][0], links[seqs[k]], len(texts[seqs[k]]))] += 1
    return out


def corpus(seed=5, families=12, size=14):
    rnd = random.Random(seed)
    rows, i = edge_docs(), 1000
    common = words(rnd, 30)
    for f in range(families):
        base = words(rnd, rnd.randrange(60, 260)).split()
        for _ in range(size):
            w = list(base)
            for _ in range(rnd.randrange(0, 7)):
                w[rnd.randrange(len(w))] = words(rnd, 1)
            t = " ".join(w) if rnd.random() < .6 else common + " " + " ".join(w)
            rows.append((i, t, "en", "s", 0))
            i += 1
    return rows


def result(df):
    got = df.collect()
    return got, Counter((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in got)


@pytest.mark.parametrize("small,block,depth", [(1024, 1024, 10), (4, 3, 3)])
def test_classes_match_brute_force(spark, small, block, depth):
    rows = corpus()
    got, have = result(near.class_report(edge_frame(spark, rows), small=small, block=block, max_depth=depth))
    assert have == brute(rows)
    classes = Counter(r["class_id"] for r in got if r["class_id"] is not None)
    firsts = Counter(r["class_id"] for r in got if r["class_first"] and r["class_id"] is not None)
    assert set(firsts) == set(classes)


def test_hot_near_group(spark):
    rnd = random.Random(8)
    base = words(rnd, 120).split()
    rows = []
    for i in range(240):
        if i % 3 == 0:
            w = list(base)
            for _ in range(rnd.randrange(0, 6)):
                w[rnd.randrange(len(w))] = words(rnd, 1)
            rows.append((i, " ".join(w), "en", "s", 0))
        else:
            rows.append((i, words(rnd, 80), "en", "s", 0))
    _, have = result(near.class_report(edge_frame(spark, rows), small=16, block=20, max_depth=4))
    assert have == brute(rows)


def test_stage_and_empty(spark):
    rows = corpus(families=3, size=5)
    df = edge_frame(spark, rows)
    kept = near.keep_one_per_class(df)
    assert kept.columns == df.columns
    assert kept.count() == sum(1 for r in near.class_report(df).collect() if r["class_first"])
    assert near.class_report(empty_frame(spark)).count() == 0


def test_recall_of_candidates(spark):
    """Pairs at the threshold meet in at least one run."""
    assert near.runs_needed(0.99) < near.runs_needed(0.9999)
    rnd = np.random.default_rng(3)
    pairs, rows = 300, []
    for p in range(pairs):
        common = rnd.integers(0, 2**63, 80, dtype=np.uint64)
        for k in range(2):
            own = rnd.integers(0, 2**63, 10, dtype=np.uint64)
            rows.append((2 * p + k, bytearray(near.signature(np.concatenate([common, own])).tobytes())))
    nodes = spark.createDataFrame(rows, "node long, sig binary")
    got = {(min(r), max(r)) for r in near.candidate_links(nodes, near.runs_needed()).distinct().collect()}
    assert sum((2 * p, 2 * p + 1) in got for p in range(pairs)) >= 0.99 * pairs


def test_components(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rnd.randrange(100, 300), rnd.randrange(100, 300)) for _ in range(120)] + [(7, 7), (900, 901)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
