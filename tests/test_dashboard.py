"""Reports from one aggregation, and joins of stored buckets."""

import uuid

import pytest
from pyspark.sql import functions as F

from procrisk.operators import dashboard, joins, reports
from procrisk.plans import testviews
from procrisk.sources import tables


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def odd(spark):
    data = [
        ("c1", "p1", 10.0, "2024-01-05", "High", 1, 0),
        ("c1", "p1", None, "2024-01-06", "Low", 0, 1),
        ("c1", None, float("nan"), "2024-02-01", "High", 1, 1),
        ("c2", "p1", 1e30, "2024-02-02", None, 0, None),
        (None, "p2", 2.5, None, "Medium", None, 1),
        (None, None, 0.004, "2024-03-01", "Low", 0, 0),
    ] * 3
    df = spark.createDataFrame(
        data, "customer_bin string, provider_bin string, contract_sum double, day string, "
        "risk_category string, a_flag int, b_flag int",
    )
    return df.withColumn("lot_start_date", F.to_timestamp_ntz("day")).drop("day").repartition(3)


@pytest.mark.parametrize("name", list(dashboard.REPORTS))
def test_reports_equal_those_of_the_table(spark, odd, small, name):
    for df in (odd, testviews.featured(spark, small), odd.limit(0)):
        sums = dashboard.report_sums(df)
        assert rows(dashboard.REPORTS[name](sums)) == rows(getattr(reports, name)(df))


def test_the_table_is_scanned_once(spark, small):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = testviews.featured(spark, small)
    total = df.count()
    watched = df.mapInPandas(count, df.schema)
    sums = dashboard.report_sums(watched)
    assert seen.value == total
    dashboard.all_reports(sums).collect()
    assert seen.value == total


def test_buckets_meet_without_a_shuffle(spark, small, tmp_path):
    mark = uuid.uuid4().hex
    contracts, lots = (
        tables.write_buckets(view(spark, small), f"{name}_{mark}", f"{tmp_path}/{name}", "lot_id", 4)
        for name, view in (("contracts", testviews.contracts), ("lots", testviews.lots))
    )
    plans = testviews.plans(spark, small)
    joined = joins.join_bucketed(contracts, lots, plans)
    # Exchanges only bring the result and the plans together, or broadcast the plans.
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = contracts.where("lot_id IS NOT NULL").join(lots.where("lot_id IS NOT NULL"), "lot_id", "left")
        plan = known._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = joins.join_contracts(testviews.contracts(spark, small), testviews.lots(spark, small), plans)
        assert rows(joined) == rows(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(list((tmp_path / "lots").glob("*.parquet"))) <= 4


def test_flags_to_choose_from(odd):
    found = {r["flag"]: (r["title"], r["contracts"]) for r in reports.facet_flag_counts(odd).collect()}
    assert found == {"a_flag": ("A", 6), "b_flag": ("B", 9)}
