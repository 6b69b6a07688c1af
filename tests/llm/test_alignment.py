"""Alignment of two tokenisers against plain loops over the libraries' own tokens."""

import bisect
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from procrisk.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def brute(rows):
    a_file, b_file, letters = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), byte_letters()
    a_file.encode_special_tokens = True
    linked, counts = [], Counter()
    for doc, text in rows:
        found = ([], [], [], [])
        if text:
            a = a_file.encode(" " + text, add_special_tokens=False)
            a_raw = [bytes(letters[c] for c in t) for t in a.tokens]
            b = b_file.encode(text)
            b_raw = []
            for k in b:
                p = b_file.id_to_piece(k)
                b_raw.append(bytes([int(p[3:5], 16)]) if b_file.is_byte(k) else p.replace("▁", " ").encode())
            if b"".join(a_raw) == b"".join(b_raw) == b" " + text.encode():
                a_end, b_end = np.cumsum(list(map(len, a_raw))), np.cumsum(list(map(len, b_raw)))
                cuts = sorted(set(a_end.tolist()) & set(b_end.tolist()))
                groups = [([], []) for _ in cuts]
                for side, (ids, ends) in enumerate(((a.ids, a_end), (b, b_end))):
                    for x, e in zip(ids, ends, strict=True):
                        groups[bisect.bisect_left(cuts, e)][side].append(x)
                links, j = [], 0
                for x, e, n in zip(a.ids, a_end, map(len, a_raw), strict=True):
                    while j < len(b) and b_end[j] <= e - n:
                        j += 1
                    k = j
                    while k < len(b) and b_end[k] - len(b_raw[k]) < e:
                        links.append((x, b[k]))
                        k += 1
                found = (a.ids, b, groups, links)
        linked.append((doc, found))
        counts.update(found[3])
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    out = []
    for doc, (a, b, groups, links) in linked:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, len(a), len(b), len(groups), len(links),
                    sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=str)


def told(df):
    return sorted((tuple(r)[:8] for r in df.collect()), key=str)


ODD = [
    (1, "<|endoftext|> <s> </s> <unk> <0x41> ▁ plain"), (2, "two  spaces\n\n and\ttabs   "),
    (3, "日本語 😀 Ärger é ﬁ Ⅷ"), (4, " "), (5, "\n"), (6, "a"), (7, "\x00\x01 ​"), (2**60 + 1, "big id"),
    (8, "x" * 70_000), (9, "<|endoftext|>" * 3), (10, "don't I'll 1234567 $%& ... !!!"),
]


def test_query_on_the_given_table(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert told(queries.op12_token_alignment(spark, small)) == brute(rows)


@pytest.mark.parametrize("block", [40, 1 << 19])
def test_odd_rows(spark, odd, none, block, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK", block)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()] + ODD
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(ODD, "doc_id long, text string"))
    assert told(alignment.alignments(docs, A, B)) == brute(rows)
    assert alignment.alignments(none, A, B).count() == 0


def test_counts_too_large_to_broadcast(spark, small, monkeypatch):
    monkeypatch.setattr("procrisk.llm.common.BROADCAST_BYTES", 0)
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(40)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert told(alignment.alignments(docs, A, B)) == brute(rows)


def test_positions_of_links():
    both = alignment.Aligner(A, B)
    texts = ["Unbelievable Donaudampfschiff 日本語", None, "", "colourful words, 12345"]
    rows = list(both.rows(texts, {"a_ids", "links", "shared", "groups"}))
    for text, row in zip(texts, rows, strict=True):
        a, b = both.tokens(text)
        assert row["a_ids"].tolist() == a.tolist() and row["b_ids"].tolist() == b.tolist()
        a_end, b_end = np.cumsum(both.a.sizes[a]), np.cumsum(both.b.sizes[b])
        spans = [[set(range(e - n, e)) for e, n in zip(end, size, strict=True)]
                 for end, size in ((a_end, both.a.sizes[a]), (b_end, both.b.sizes[b]))]
        want = [(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x & y]
        assert list(zip(row["link_a"], row["link_b"], strict=True)) == want
        at = sorted(set(a_end.tolist()) & set(b_end.tolist()))
        group = [[np.searchsorted(at, e) for e in end] for end in (a_end, b_end)]
        want = [(i, j) for i, x in enumerate(group[0]) for j, y in enumerate(group[1]) if x == y]
        assert list(zip(row["shared_a"], row["shared_b"], strict=True)) == want
        assert row["n_shared"] == len(want) and row["n_groups"] == len(at)


def test_product_against_numpy():
    rng = np.random.default_rng(1)
    for _ in range(20):
        h, m, w = rng.integers(1, 9, 3)
        x, y = rng.random((h, m)) < 0.4, rng.random((m, w)) < 0.4
        a, b = (alignment.Csr.of(*np.nonzero(z), *z.shape) for z in (x, y))
        got, values = alignment.product(a, b)
        dense = np.zeros((h, w), dtype=int)
        dense[got.rows, got.col] = values
        assert (dense == x.astype(int) @ y.astype(int)).all()
        turned = a.transposed()
        assert sorted(zip(turned.rows, turned.col, strict=True)) == sorted(zip(a.col, a.rows, strict=True))


def test_ranks_give_the_ids_of_the_file(spark, small):
    side, file = alignment.ByteLevel(A), Tokenizer.from_file(A)
    file.encode_special_tokens = True
    texts = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()] + [t for _, t in ODD]
    for text in texts:
        assert side.encode(text).tolist() == file.encode(" " + text, add_special_tokens=False).ids
