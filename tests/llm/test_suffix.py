import random
from collections import Counter
from hashlib import sha256

import pytest

from cellwise.llm import suffix
from tests.llm.util import edge_docs, edge_frame, empty_frame, words


def brute(rows, length):
    raw = [(r[1] or "").encode() for r in rows]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = Counter()
    for r, b in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[(r[0], len(b), sum(gone), runs, sha256(kept).hexdigest())] += 1
    return out


def corpus(seed=4):
    rnd = random.Random(seed)
    shared = [words(rnd, 90) for _ in range(4)]
    rows = [r for r in edge_docs(n=30) if r[0] != 107] + [(107, "y" * 900 + "z" + "y" * 700, "en", "s", 0)]
    for i in range(200, 330):
        parts = [words(rnd, rnd.randrange(1, 60))]
        for _ in range(rnd.randrange(0, 3)):
            s = rnd.choice(shared)
            a = rnd.randrange(0, len(s) // 2)
            parts += [s[a:a + rnd.randrange(150, len(s))], words(rnd, rnd.randrange(1, 40))]
        t = rnd.choice([" ", "", "\n"]).join(parts)
        if rnd.random() < .2:  # a near copy of an earlier text
            t = list(rows[-1][1])
            for _ in range(3):
                t[rnd.randrange(len(t))] = rnd.choice("éxyz")
            t = "".join(t)
        rows.append((i, t, "en", "s", 0))
    # exactly at and one short of the length
    u = words(rnd, 100)
    rows += [(400, "A" + u[:200] + "B", None, None, None), (401, "C" + u[:200] + "D", None, None, None),
             (402, u[250:449] + "1", None, None, None), (403, u[250:449] + "2", None, None, None)]
    return rows


@pytest.mark.parametrize("large", [50_000, 2])
def test_spans_match_brute_force(spark, large):
    rows = corpus()
    got = suffix.repeated_spans(edge_frame(spark, rows), large_rank=large).collect()
    assert Counter(tuple(r)[:5] for r in got) == brute(rows, 200)
    for r in got:
        assert sum(s["e"] - s["s"] for s in r["spans"]) == r["n_removed"] and len(r["spans"]) == r["n_spans"]


def test_other_lengths_take_more_rounds(spark):
    rows = corpus(9)
    assert suffix.core_of(200) == 64 and suffix.core_of(600) == 256
    got = suffix.repeated_spans(edge_frame(spark, rows), length=600).collect()
    assert Counter(tuple(r)[:5] for r in got) == brute(rows, 600)


def test_empty(spark):
    assert suffix.repeated_spans(empty_frame(spark)).count() == 0
    rows = [(1, None, None, None, None), (2, "", None, None, None), (3, "short", None, None, None)]
    got = suffix.repeated_spans(edge_frame(spark, rows)).collect()
    assert Counter(tuple(r)[:5] for r in got) == brute(rows, 200)
