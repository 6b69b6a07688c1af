"""Ids beyond 2^53 beside a null id: every operator gives them back as they are."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from procrisk.llm import (
    alignment, chat, pieces, quality, queries, secrets, setsketch, substring, suffix, tiling, tokenfiles,
    toxicity,
)

BIG = [2**53 + 1, 2**53 + 3, 2**62 + 1]
TEXT = "one two three four five six seven eight nine ten eleven twelve " * 4


@pytest.fixture(scope="module")
def big(spark):
    rows = [(k, f"{TEXT} text number {k} word{k} other{k}" * (1 + n)) for n, k in enumerate(BIG)]
    rows += [(None, "a row without id, one two three four"), (None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame([(*r, "en", "a", 1) for r in rows], schema).coalesce(1)


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.select(column).collect()), key=lambda k: (k is None, k))


WANT = [*BIG, None, None]


def test_operators_that_give_all_rows(spark, big):
    model = toxicity.train(big, spark.createDataFrame([(BIG[0], 1, 1)], "doc_id long, quality int, toxic int"))
    vocabulary = queries.vocabulary("byte_bpe_50k.json")
    load = pieces.load_pieces(queries.vocabulary("piece_bpe_32k.model"))
    written = tokenfiles.write_tokens(big, vocabulary)
    for found in (
        suffix.dedup(big), substring.dedup(big), pieces.encode(big, load), pieces.encode_checked(big, load),
        toxicity.score(big, model), tokenfiles.read_tokens(spark, written),
        setsketch.near_duplicates(big), quality.judge(big), secrets.scan(big),
        alignment.alignments(big, vocabulary, queries.vocabulary("piece_bpe_32k.model")),
    ):
        assert ids(found) == WANT
    assert ids(tokenfiles.read_tokens(spark, written, doc_ids=[BIG[1]])) == [BIG[1]]


def test_components_of_big_ids(spark):
    rows = [(k, TEXT) for k in BIG] + [(None, TEXT), (2**53, "something else"), (2**53 + 2, "another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: r["component_id"] for r in setsketch.near_duplicates(docs).collect()}
    assert found == {**dict.fromkeys(BIG, BIG[0]), None: None, 2**53: 2**53, 2**53 + 2: 2**53 + 2}


def test_contaminated_ids(spark, big):
    items = [(2**60 + 1, TEXT), (None, TEXT), (2**60 + 3, "alpha beta gamma delta epsilon zeta")]
    found = tiling.contaminations(big, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(k, i) for k in BIG for i in (2**60 + 1, None)}


def test_conversations(spark):
    rows = [(k, 1, "user", "x") for k in (*BIG, None)]
    formatted = chat.format_conversations(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    )
    assert ids(chat.read_back(formatted), "conv_id") == [*BIG, None]


def test_pipeline_keeps_ids_and_a_column_named_decoded(spark, big, small):
    docs = big.withColumn("decoded", F.lit("own"))
    out = corpus_pipeline.encoding(spark, docs, small)
    assert out.columns == [*docs.columns, "piece_ids", "round_trip"]
    assert ids(out) == WANT and {r["decoded"] for r in out.collect()} == {"own"}
    assert all(r["round_trip"] for r in out.collect())
    kept = setsketch.keep_first(big)
    assert ids(kept) == WANT


def test_which_of_rows_equal_in_id_and_text_stays(spark):
    rows = [(1, TEXT, s) for s in "abcdef"] + [(2, "other words in this text", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = {tuple(sorted((r["doc_id"], r["source"]) for r in setsketch.keep_first(docs.repartition(k)).collect()))
            for k in (1, 3, 5)}
    assert len(left) == 1 and len(left.pop()) == 2
