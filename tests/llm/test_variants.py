"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from procrisk.llm import queries, variants

LOWER = {c: c + 32 for c in range(65, 91)}


def counted(rows):
    words = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            k = h % len(run)
            words[run[:k] + run[k + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def brute(words):
    gaps = {}
    for w in words:
        for k in range(len(w)):
            gaps.setdefault((k, w[:k] + w[k + 1 :]), set()).add(w)  # replaced
    near = {w: set() for w in words}
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    for w in words:  # deleted
        for k in range(len(w)):
            short = w[:k] + w[k + 1 :]
            if short in words:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def found(df):
    rows = df.collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def crowd():
    rng = random.Random(4)
    base = ["".join(rng.choice("aeinrst") for _ in range(rng.randrange(7, 10))) for _ in range(60)]
    base += ["é" * 8, "ÿ×÷àéèü", "x" * 70, "x" * 69 + "y", "x" * 69, "x" * 40 + "ab" * 20]
    rows = []
    for doc in range(300):
        words = []
        for _ in range(25):
            w = rng.choice(base) if rng.random() < 0.6 else base[0]
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + "e" + w[k + 1 :], w[:k] + "q" + w[k:]])
            words.append(w.title() if rng.random() < 0.1 else w)
        rows.append((doc, " ".join(words)))
    return rows


@pytest.mark.parametrize("limit", [3, 40, None])
def test_against_brute_force(spark, crowd, limit):
    want = brute(counted(crowd))
    assert any(v[0] and v[1] != v[0] for v in want.values())
    docs = spark.createDataFrame(crowd, "doc_id long, text string").repartition(3)
    assert found(variants.spelling_variants(docs, limit=limit)) == want


def test_query_on_the_given_table(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert found(queries.op13_spelling_variants(spark, small)) == brute(counted(rows))


def test_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(variants.spelling_variants(odd)) == brute(counted(rows))
    assert variants.spelling_variants(none).count() == 0


def test_many_searches_of_one_shard(spark, crowd, monkeypatch):
    docs = spark.createDataFrame(crowd, "doc_id long, text string")
    monkeypatch.setattr(variants, "TASK_SEARCHES", 20)
    assert found(variants.spelling_variants(docs, limit=50)) == brute(counted(crowd))


def test_search_in_blocks(monkeypatch):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abc") for _ in range(7)) for _ in range(600)})
    raw = [w.encode() for w in words]
    want = {(i, j) for i, a in enumerate(raw) for j, b in enumerate(raw) if variants.one_apart(a, b)}
    monkeypatch.setattr(variants, "STATES", 50)
    monkeypatch.setattr(variants, "PAIRS", 64)
    one = np.ones(len(raw), dtype=np.int64)
    q, s = variants.near_words(raw, raw, one, one, 0)
    assert set(zip(q.tolist(), s.tolist(), strict=True)) == want and len(q) == len(want)
    assert not variants.one_apart(b"abc", b"abc") and variants.one_apart(b"abc", b"abcd")
    assert not variants.one_apart(b"abc", b"bcad") and not variants.one_apart(b"ab", b"abcd")
