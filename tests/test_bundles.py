"""Documents stored many to a file: the same rows, and files that do not grow with them."""

import json

import pytest

from procrisk.plans import catalog
from procrisk.schemas import raw_schema
from procrisk.sources import documents
from procrisk.streaming.landing import land_new_objects


def bundles(spark, rows, path):
    return documents.write_bundles(spark.createDataFrame(rows, documents.BUNDLE), str(path))


@pytest.mark.parametrize(
    ("name", "key", "table"),
    [("page_scan", "page_id", "pages"), ("object_scan", "s_suppkey", "supplier"),
     ("incremental_landing", "s_suppkey", "supplier")],
)
def test_files_do_not_grow_with_the_documents(spark, tmp_path, monkeypatch, name, key, table):
    if table == "pages":
        rows = [(k, f"a\n\n{k}") for k in range(40)] + [(None, "x")]
        spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
        want = sorted([(k, 3, sum(len(h) for _, h in rows)) for k in range(40)] + [(-1, 1, sum(len(h) for _, h in rows))])
    else:
        rows = [(k, f"n{k}", k % 25, k / 2) for k in range(40)] + [(None, None, 1, None), (3, "n3", 3, 1.5)]
        spark.createDataFrame(rows, catalog._SUPPLIER).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
        want = sorted(rows, key=str)
    monkeypatch.setattr(catalog, "fresh_path", lambda spark, name: f"{tmp_path}/{name}-made")
    got = [tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).collect()]
    if table == "pages":
        assert sorted((-1 if p is None else p, n, total) for p, n, total in got) == want
    else:
        assert sorted(got, key=str) == want
    stored = [p for made in tmp_path.glob("*-made") for p in made.rglob("part-*")]
    assert 0 < len(stored) <= 12


def test_pages_and_rejects_of_bundles(spark, tmp_path):
    page = json.dumps({"content": [{"id": 1}, {"id": 2}], "totalPages": 3, "totalElements": 5}, indent=2)
    path = bundles(spark, [("in/10.json", page), ("in/2.json", page), ("in/3.json", "broken")], tmp_path / "p")
    pages = documents.read_pages(spark, path, bundled=True).orderBy("page")
    assert [(r["page"], r["records"], r["totalElements"]) for r in pages.collect()] == [(2, 2, 5), (10, 2, 5)]
    _, bad = documents.read_objects(spark, path, raw_schema("Plan"), bundled=True)
    assert [tuple(r) for r in bad.collect()] == [("in/3.json", "broken")]
    good, bad = documents.read_objects(spark, str(tmp_path / "no"), raw_schema("Plan"), bundled=True)
    assert good.count() == bad.count() == 0


def test_landing_takes_each_bundle_once(spark, tmp_path):
    where = [str(tmp_path / p) for p in ("in", "out", "progress")]
    land = lambda: land_new_objects(spark, where[0], raw_schema("OrderDetail"), *where[1:], bundled=True)
    bundles(spark, [("1.json", json.dumps({"externalId": "7"}, indent=2)), ("2.json", "broken")], where[0])
    assert [r["externalId"] for r in land().collect()] == ["7"]
    bundles(spark, [("3.json", '[{"externalId": "8"}, {"externalId": "9"}]')], where[0])
    assert sorted(r["externalId"] for r in land().collect()) == ["7", "8", "9"]
    assert sorted(r["externalId"] for r in land().collect()) == ["7", "8", "9"]
    lost = spark.read.parquet(f"{where[1]}_rejects").collect()
    assert [r["source_file"] for r in lost] == ["2.json"]
