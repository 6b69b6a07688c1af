"""Raw documents to final table, and every query against its SQL."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from procrisk.operators import reports
from procrisk.plans import catalog, testviews, workflow
from procrisk.sources import tables
from tools.check import compare, connect


def test_raw_to_final(spark, tmp_path):
    raw = tmp_path / "raw"
    for i in range(30):
        lot = {"externalId": str(i), "externalPlanId": str(i % 5), "amount": 100 + i, "titleRu": f"t{i % 3}",
               "methodTrade": {"id": 6 if i % 4 == 0 else 1}, "startDate": f"2024-01-{1 + i % 28:02d}T00:00:00"}
        contract = {"externalId": str(i), "providerbin": f"p{i % 4}", "customerbin": f"c{i % 2}",
                    "sum": 90 + i * i, "paidSum": 80 + i, "acceptdate": "2024-03-01T00:00:00"}
        for entity, record in (("_Lot", lot), ("OrderDetail", contract), ("Plan", {"externalId": str(i), "sum": i})):
            (raw / entity).mkdir(parents=True, exist_ok=True)
            (raw / entity / f"{i}.json").write_text(json.dumps(record, indent=2))
    folder = str(tmp_path / "out")
    assert [r["records"] for r in workflow.build_bronze(spark, str(raw), folder).collect()] == [30] * 3
    joined = workflow.build_procurements(spark, folder, folder)
    assert joined.count() == 30 and len(joined.columns) == 20
    workflow.build_featured(spark, folder)
    final, fitted = workflow.build_final(spark, folder, ["lot_id"], trees=10)
    assert final.count() == 30 and "combined_risk_score" in final.columns
    assert tables.best_available(spark, folder)[1] == "procurements_final"
    assert len(fitted.preparation.features) == 10


def test_entry(spark):
    found = entry.entry(spark)
    assert found.count() == 1_473 and "color" in found.columns


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_date_ranges_read_some_years_only(spark, tmp_path):
    rows = [(f"{y}-03-01 00:00:00", y) for y in (2019, 2020, 2021, 2022)]
    df = spark.createDataFrame(rows, "t string, year int")
    df = df.select(F.col("t").cast("timestamp_ntz").alias("lot_start_date"), "year")
    path = tables.write_parquet(df, f"{tmp_path}/by_year.parquet", partition_by=["year"])
    some = reports.in_date_range(spark.read.parquet(path), dt.date(2020, 1, 1), dt.date(2021, 3, 1))
    assert sorted(r["year"] for r in some.collect()) == [2020, 2021]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, small, name):
    got = catalog.QUERIES[name](spark, small).toPandas()
    assert len(got)
    assert compare(got, duck.execute(catalog.SQL[name]).df()) is None


def test_joined_counts(spark, small):
    joined = testviews.joined(spark, small)
    row = joined.selectExpr(
        "count(*) rows", "count_if(lot_amount is null) no_lot", "count_if(plan_price is null) no_plan",
        "sum(single_bidder_flag) single",
    ).first()
    assert tuple(row) == (1_473, 147, 243, 558)
