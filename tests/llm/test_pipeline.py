"""The pipeline stage by stage against brute force, and as a whole."""

import random
import re

import pytest

import corpus_pipeline as C
from cellwise.llm import quality
from tests.conftest import SF_SMALL
from tests.llm.test_near import shingles
from tests.llm.util import DOC_SCHEMA, words


def corpus(seed=11):
    """Prose with exact copies, near copies, shared passages and junk."""
    rnd = random.Random(seed)
    prose = lambda n: " ".join(rnd.choice(["the", "of", "and"]) if rnd.random() < .3 else words(rnd, 1) for _ in range(n))
    shared = [prose(70), prose(120)]
    rows = []
    for i in range(120):
        kind = rnd.choice(["plain"] * 5 + ["copy", "near", "passage", "junk", "short"])
        if kind == "copy" and rows:
            t = rnd.choice(rows)[1].replace(" ", "  ", 3)
        elif kind == "near" and rows:
            w = rnd.choice(rows)[1].split()
            if len(w) > 40:
                w[rnd.randrange(len(w))] = "changed"
            t = " ".join(w)
        elif kind == "passage":
            t = prose(60) + "\n" + rnd.choice(shared) + "\n" + prose(60)
        elif kind == "junk":
            t = "buy now " * 200
        elif kind == "short":
            t = "too short"
        else:
            t = prose(rnd.randrange(50, 300))
        rows.append((i, t, "en", "s", len(t)))
    return rows


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's rows, written and read again as a run does."""
    docs, out = spark.createDataFrame(corpus(), DOC_SCHEMA), []
    for name, stage in C.STAGES:
        path = str(tmp_path_factory.mktemp("p") / name)
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((docs.columns, {r[0]: r for r in docs.collect()} if name != "packing" else docs.collect()))
    return out


def test_stage_list():
    assert [n for n, _ in C.STAGES] == ["quality", "exact_dedup", "near_dedup", "passage_dedup", "packing"]


def test_quality_stage(stages):
    import zstandard

    c = zstandard.ZstdCompressor(level=quality.LEVEL)
    cols, kept = stages[0]
    assert cols == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {i: r["text"] for i, r in kept.items()} == {
        i: t for i, t, *_ in corpus() if quality.measure(t, c)[6]}
    assert 0 < len(kept) < 120


def test_exact_stage(stages):
    first = {}
    for i, r in sorted(stages[0][1].items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), i)
    assert set(stages[1][1]) == set(first.values()) and stages[1][0] == stages[0][0]


def test_near_stage(stages):
    docs = {i: shingles(r["text"]) for i, r in stages[1][1].items()}
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for a in ids:
        for b in ids:
            if a < b and (n := len(docs[a] & docs[b])) and n >= 0.8 * (len(docs[a]) + len(docs[b]) - n):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert set(stages[2][1]) == {find(i) for i in ids} and len(stages[2][1]) < len(ids)


def test_passage_stage(stages):
    before, after = stages[2][1], stages[3][1]
    assert set(before) == set(after)
    seen, cut = set(), 0
    for i in sorted(after):
        w = after[i]["text"].split()
        grams = {tuple(w[k:k + 50]) for k in range(len(w) - 49)}
        assert not grams & seen  # no run of 50 words is left twice
        seen |= grams
        cut += after[i]["text"] != before[i]["text"]
        assert after[i]["n_chars"] == len(after[i]["text"])
        if not cut:
            assert after[i]["text"] == before[i]["text"]
    assert cut


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    from cellwise.llm.queries import tokenizer_path
    from tests.llm.test_exact_shard_pack import check_packing

    t = Tokenizer.from_file(tokenizer_path())
    rows = [(i, r["text"]) for i, r in stages[3][1].items()]
    n = check_packing(rows, stages[4][1], lambda x: t.encode(x, add_special_tokens=False).ids)
    total = sum(r["length"] for r in stages[4][1])
    assert n <= -(-total // 1024) + 1


def test_run_and_registration(spark):
    import __spark_entry__ as E

    q = E.queries()
    assert "pipeline" in q
    ops = {re.match(r"op(\d+)_", k)[1] for k in q if re.match(r"op\d+_", k)}
    assert ops == {str(n) for n in range(1, 11)}
    assert q["pipeline"](spark, SF_SMALL).count() > 0


def test_empty_documents(spark):
    docs = spark.createDataFrame([], DOC_SCHEMA)
    for name, stage in C.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns
    assert C.STAGES[-1][1](spark, docs, SF_SMALL).count() == 0
