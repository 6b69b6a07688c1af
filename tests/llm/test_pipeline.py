"""The whole pipeline against its stages done by hand."""


import corpus_pipeline
from procrisk.llm import pieces, quality, queries, tiling

from test_operators import _base_spans, _components, _measured

SMALL = "/root/testdata/sf0.001"


def test_pipeline(spark):
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    judged = {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}
    good = {k: t for k, t in texts.items() if judged[k]}
    assert all(not _measured(t)[5] for t in good.values())
    first = {k: good[k] for k, (_, _, kept) in _components(sorted(good.items())).items() if kept}
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {
        k: t for k, t in first.items()
        if not any(_held(t, item) for item in items)
    }
    assert set(out) == set(clean)
    for k, r in out.items():
        spans = _base_spans(clean[k])
        assert (r["text"] == clean[k]) == (not spans) and not _base_spans(r["text"])
        assert r["round_trip"] == ("▁" not in r["text"])
    model = pieces.load_pieces(queries.vocabulary("piece_bpe_32k.model"))
    assert all(r["piece_ids"] == model.encode(r["text"]).tolist() for r in list(out.values())[:10])


def _held(text, item):
    """Brute force: tiles of the whole text cover three quarters of the item's words."""
    a, first = tiling.words([text, item])
    found = tiling.tiles(a[: first[1]], a[first[1] :])
    n = len(a) - first[1]
    return sum(size for size, _, _ in found) * 100 >= n * tiling.PERCENT


def test_stages_keep_columns_of_odd_rows(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars", "runs", "id")
    for name, step in corpus_pipeline.STAGES:
        after = step(spark, docs, SMALL)
        if name != "encoding":
            assert after.columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "decontamination", "secret_scan", "encoding",
    ]
