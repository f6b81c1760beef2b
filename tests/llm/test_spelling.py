import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from cellwise.llm import spelling
from tests.llm.util import DOC_SCHEMA, edge_frame, empty_frame


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def letters(text):
    run = ""
    for c in (text or "") + " ":
        if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
            run += c.lower() if c.isascii() else c
        elif run:
            yield run
            run = ""


def brute(rows):
    n = Counter()
    for r in rows:
        for run in letters(r[1]):
            h = crc32(f"{'' if r[0] is None else r[0]}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 2}
    around = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, vs in around.items():
        top = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top is not None and n[top] >= 10 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(around[w]), n[form[w]] if form[w] else None))
    return out


def typo(rnd, w):
    i = rnd.randrange(len(w))
    return rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice("abé") + w[i:], w[:i] + rnd.choice("abé") + w[i + 1:]])


def corpus(seed=1):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcÉéÿ") for _ in range(rnd.randrange(6, 11))) for _ in range(25)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(60):
            w = rnd.choice(base[:3]) if rnd.random() < .6 else rnd.choice(base)
            for _ in range(rnd.choice([0, 0, 0, 0, 0, 1, 1, 2])):
                w = typo(rnd, w)
            words.append(rnd.choice([w, w.upper(), w.title()]))
        rows.append((i if i % 9 else None, rnd.choice([" ", "1", "_", "\n"]).join(words), "en", "s", 0))
    rows += [rows[3], (900, None, None, None, None), (901, "", None, None, None), (902, "short 漢字漢字漢字漢字", None, None, None)]
    return rows


def test_matches_brute_force(spark):
    rows = corpus()
    got = spelling.spelling_variants(edge_frame(spark, rows)).collect()
    want = brute(rows)
    assert any(f and r != f for _, f, r, *_ in want)  # a chain of forms
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_edge_rows_and_long_words(spark):
    long = "q" * 60_000
    rows = [(1, f"{long} {long}", "en", "s", 0), (2, f"{long}r {long}r", "en", "s", 0), (3, long + "r", "en", "s", 0)]
    got = {r["n"]: r for r in spelling.spelling_variants(spark.createDataFrame(rows, DOC_SCHEMA)).collect()}
    assert sum(r["n_near"] for r in got.values()) == 2 and all(len(r["word"]) >= 59_999 for r in got.values())
    assert spelling.spelling_variants(empty_frame(spark)).collect() == []
    assert spelling.spelling_variants(edge_frame(spark)).count() >= 0


@pytest.mark.parametrize("symbols", [2, 5, 30])
def test_every_near_pair_is_generated(symbols):
    rnd = random.Random(symbols)
    words = sorted({"".join(rnd.choice("abcd") for _ in range(rnd.randrange(7, 9))) for _ in range(300)})
    words += sorted({typo(rnd, w) for w in words} - set(words))
    own, reach = spelling.reduced_keys(words, symbols), spelling.neighbour_keys(words, symbols)
    assert all(len(np.unique(r)) == len(r) and r[0] == k for r, k in zip(reach, own))
    met = Counter()
    for i, keys in enumerate(reach):
        for j in np.flatnonzero(np.isin(own, keys)):
            if i != j and (own[i] != own[j] or i < j):
                met[frozenset((i, int(j)))] += 1
    wanted = {frozenset((i, j)) for i in range(len(words)) for j in range(i) if near(words[i], words[j])}
    assert wanted and all(met[p] == 1 for p in wanted)
