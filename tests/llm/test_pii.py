import random
import re
from collections import Counter
from hashlib import sha256

import pytest

from cellwise.llm import pii
from tests.llm.util import DOC_SCHEMA, edge_docs, edge_frame, empty_frame, words

RULES = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def passes(kind, s):
    digits = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else sum(map(int, str(2 * d))) for i, d in enumerate(digits[::-1]))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    """The contract's rules as written."""
    out = []
    for k, (kind, rule) in enumerate(RULES):
        out += [(m.start(), k, m.end()) for m in re.finditer(rule, text or "") if passes(kind, m.group())]
    return [(s, e, RULES[k][0]) for s, k, e in sorted(out)]


def card(rnd, n=16):
    body = "".join(rnd.choice("0123456789") for _ in range(n - 1))
    return next(body + c for c in "0123456789" if passes("card", body + c))


def phone(rnd):
    return f"+1 ({rnd.randrange(100, 999)}) 555-{rnd.randrange(10000):04d}"


def ip(rnd):
    return ".".join(str(rnd.randrange(256)) for _ in range(4))


@pytest.mark.parametrize("seed", range(6))
def test_base_rules_as_written(seed):
    rnd = random.Random(seed)
    bits = ["@", "a@b.c", ".", "..", "-", " ", "+", "(", "1.2.3.4", "256.1.1.1", "1" * 14, "0", "7.", "x%", "\n", "é", "a.b@c-d.e.f"]
    for _ in range(300):
        t = "".join(rnd.choice(bits + [card(rnd), phone(rnd), ip(rnd)]) for _ in range(rnd.randrange(1, 30)))
        assert pii.base_spans(t) == plain(t), t


def test_base_rules_read_long_runs_once():
    for t in ("1" * 2_000_000, "a" * 2_000_000, "1." * 500_000, "a@" * 300_000, "+1 " * 400_000, "@" * 1_000_000,
              "x" * 1_000_000 + "@" + "y" * 1_000_000, " " * 2_000_000, "1 " * 400_000):
        base = pii.base_spans(t)
        if len(t) <= 1_000_000:
            pii.instances(t, base)


def corpus(seed=5, n=400):
    """Seeds in clear context, and identifiers that their neighbours hide."""
    rnd = random.Random(seed)
    rows, hidden, decoys = [], [], []
    for i in range(n):
        parts = [words(rnd, rnd.randrange(3, 30))]
        for _ in range(rnd.randrange(0, 4)):
            parts += [rnd.choice([card, phone, ip])(rnd), words(rnd, rnd.randrange(1, 8))]
        if i % 2 == 0:  # order numbers of their own form, nearly never cards
            parts += ["order no " + "".join(rnd.choice("0123456789") for _ in range(15)), words(rnd, 3)]
        if i % 5 == 0:
            parts += ["dial now", phone(rnd), words(rnd, 4)]
        text = " ".join(parts)
        if i % 8 == 0:
            at = len(text) + 1
            a, b = (card(rnd), ip(rnd)) if i % 16 else (phone(rnd), card(rnd))
            text += f" {a} {b} {words(rnd, 5)}"
            for kind, s, e in (("card" if i % 16 else "phone", at, at + len(a)),
                               ("ip" if i % 16 else "card", at + len(a) + 1, at + len(a) + 1 + len(b))):
                if (s, e, kind) not in plain(text):
                    hidden.append((i, s, e, kind))
        if i % 40 == 3:  # an unseen form in a context that only phones have
            at = len(text) + 10
            text += f" dial now 555-{rnd.randrange(10000):04d} {words(rnd, 4)}"
            hidden.append((i, at, at + 8, "phone"))
        if i % 10 == 7:
            text += f" room {rnd.randrange(1000)} ref 20{rnd.randrange(10, 99)}-{rnd.randrange(10, 99)}"
        rows.append((i, text, "en", "s", 0))
    return rows, hidden


def test_hidden_identifiers_are_found(spark):
    rows, hidden = corpus()
    got = {r["doc_id"]: r for r in pii.personal_data(spark.createDataFrame(rows, DOC_SCHEMA)).collect()}
    found = set()
    for i, text, *_ in rows:
        base = plain(text)
        named = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
        r = got[i]
        assert r["base_sha256"] == sha256(named.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[2] == k for x in base) for k in pii.KINDS]
        spans = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in r["spans"].split(",") if x)]
        assert set(base) <= set(spans) and len(spans) == len(base) + r["n_added"]
        assert spans == sorted(spans, key=lambda x: (x[0], pii.KINDS.index(x[2])))
        found |= {(i, *x) for x in spans if x not in base}
    assert len(hidden) > 40
    assert len(found & set(hidden)) >= 0.9 * len(hidden)
    assert len(found - set(hidden)) <= 0.05 * len(found)


def test_trust_grows_by_rounds(spark):
    """A pattern that has too few seeds is trusted once another one has made
    its instances known."""
    rows = [(f"v{i}", "phone" if i < 60 else None, None, False, ["words call _"] + (["words dial _"] if i >= 40 else []))
            for i in range(64)]
    rows += [(f"w{i}", None, None, False, ["words dial _", "words ring _"]) for i in range(3)]
    rows += [(f"x{i}", None, None, False, ["words the _"]) for i in range(50)]
    found = spark.createDataFrame(rows, "value string, base string, kind string, passes boolean, patterns array<string>")
    patterns, known = pii.trusted_patterns(found, 0.6)
    assert {r["pattern"] for r in patterns.collect()} == {"words call _", "words dial _"}
    values = {r["value"] for r in known.collect()}
    assert {"v63", "w0", "w2"} <= values and "x1" not in values


def test_edge_rows(spark):
    rows = edge_docs() + [(200, "9" * 40_000 + " " + "1 " * 3000, "en", "s", 0), (201, "@" * 500, None, None, None)]
    got = Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"], r["spans"])
                  for r in pii.personal_data(edge_frame(spark, rows)).collect())
    want = Counter()
    for i, text, *_ in rows:
        named = ",".join(f"{k}:{s}:{e}" for s, e, k in plain(text))
        want[(i, *[sum(x[2] == k for x in plain(text)) for k in pii.KINDS], sha256(named.encode()).hexdigest(), named)] += 1
    assert got == want
    assert pii.personal_data(empty_frame(spark)).collect() == []
