"""Detectors on hand-made edge rows, and properties on the test tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from procrisk import fixed
from procrisk.functions import risk
from procrisk.operators import features as fe

DAY = dt.datetime(2024, 1, 1)
WIDE = [{}, {"broadcast_bytes": -1}]


def price_z(spark, rows, **options):
    df = spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(rows)], "i int, title_ru string, contract_sum double")
    return [r["price_z"] for r in fe.with_price_z(df, **options).orderBy("i").collect()]


@pytest.mark.parametrize("options", WIDE)
def test_price_z(spark, options):
    assert price_z(spark, [("a", 10.0), ("a", 20.0), ("a", 30.0)], **options) == pytest.approx([-0.6745, 0, 0.6745])
    assert price_z(spark, [("a", 5.0)] * 3 + [("a", 100.0)], **options) == [0] * 4
    assert price_z(spark, [("a", 1.0), ("a", 9.0)], **options) == [0, 0]
    assert price_z(spark, [("a", 1.0), ("a", 9.0), ("a", None)], **options) == [0, 0, 0]
    assert price_z(spark, [(None, 1.0), (None, 5.0), (None, 9.0)], **options) == [0, 0, 0]


def test_price_flag_is_strict(spark):
    df = spark.createDataFrame([(3.0,), (3.1,), (-9.0,)], "price_z double")
    assert [r["price_flag"] for r in fe.with_price_flag(df).collect()] == [0, 1, 0]


def test_single_source(spark):
    df = spark.createDataFrame(
        [(6, 1, 5), (1, 6, 5), (None, 6, 5), (None, None, 5), (1, 1, 1)],
        "order_method_id int, lot_method_id int, bidders int",
    )
    assert [r["single_flag"] for r in fe.with_single_flag(df).collect()] == [1, 1, 1, 0, 0]
    assert [r["single_flag"] for r in fe.with_single_flag(df, bidders_col="bidders").collect()] == [1, 1, 1, 0, 1]


def repeat(spark, providers, **options):
    df = spark.createDataFrame(
        [(i, "c", p) for i, p in enumerate(providers)], "i int, customer_bin string, provider_bin string"
    )
    return [r["repeat_flag"] for r in fe.with_repeat_flag(df, **options).orderBy("i").collect()]


@pytest.mark.parametrize("options", WIDE)
def test_repeat_winner(spark, options):
    assert repeat(spark, "AAABB", **options) == [0] * 5
    assert repeat(spark, ["A", "A", "A", "A", None], **options) == [1, 1, 1, 1, 0]
    assert repeat(spark, "AAAA", **options) == [0] * 4
    assert repeat(spark, "AAAAB", min_on="pair", **options) == [0] * 5
    assert repeat(spark, "AAAAAB", min_on="pair", **options) == [1] * 5 + [0]
    assert repeat(spark, [None] * 6, **options) == [0] * 6
    assert repeat(spark, "AABBC", min_share=0.3, **options) == [1, 1, 1, 1, 0]


def test_repeat_ignores_missing_customer(spark):
    df = spark.createDataFrame([(None, "A")] * 8, "customer_bin string, provider_bin string")
    assert fe.with_repeat_flag(df).agg(F.sum("repeat_flag")).first()[0] == 0


def split(spark, days, amount=100_000.0, sliding=False, **options):
    rows = [(i, "c", "t", amount, None if d is None else DAY + dt.timedelta(days=d)) for i, d in enumerate(days)]
    df = spark.createDataFrame(
        rows, "i int, customer_bin string, title_ru string, contract_sum double, lot_start_date timestamp_ntz"
    )
    detect = fe.with_sliding_split_flag if sliding else fe.with_split_flag
    return [r["split_flag"] for r in detect(df, **options).orderBy("i").collect()]


@pytest.mark.parametrize("options", WIDE)
def test_split(spark, options):
    assert split(spark, [0, 15, 30], **options) == [1, 1, 1]
    assert split(spark, [0, 15, 31], **options) == [0, 0, 0]
    assert split(spark, [0, 10, 20, 400], **options) == [0] * 4
    assert split(spark, [0, 10, 20, None], **options) == [1] * 4
    assert split(spark, [0, 10], **options) == [0, 0]
    assert split(spark, [0, 15, 30], amount=100_000.01, **options) == [0] * 3


@pytest.mark.parametrize("options", WIDE)
def test_sliding_split(spark, options):
    assert split(spark, [0, 15, 30], sliding=True, **options) == [1, 1, 1]
    assert split(spark, [0, 15, 31], sliding=True, **options) == [0, 0, 0]
    assert split(spark, [0, 10, 20, 400], sliding=True, **options) == [1, 1, 1, 0]
    assert split(spark, [0, 10, 20, None], sliding=True, **options) == [1, 1, 1, 0]
    assert split(spark, [0, 0, 0], sliding=True, min_rows=1, **options) == [1, 1, 1]


def test_sliding_split_equals_brute_force(spark):
    rng = random.Random(5)
    rows, width = [], dt.timedelta(days=30)
    for i in range(1_500):
        group = 0 if i % 3 == 0 else rng.randrange(1, 60)
        dense = rng.random() < 0.2
        day = rng.randrange(100, 104) if dense else rng.randrange(3_000)
        rows.append((i, f"c{group}", f"t{rng.randrange(2)}", float(rng.choice([1, 1, 1, 900])), DAY + dt.timedelta(days=day, seconds=rng.randrange(3) * 40_000)))
    schema = "i int, customer_bin string, title_ru string, contract_sum double, lot_start_date timestamp_ntz"
    df = spark.createDataFrame(rows, schema).repartition(4)
    for min_rows in (2, 3, 4):
        got = {
            r["i"]: r["split_flag"]
            for r in fe.with_sliding_split_flag(df, limit=10, days=30, min_rows=min_rows).collect()
        }
        for i, c, t, amount, at in rows:
            peers = sorted(r[4] for r in rows if r[1] == c and r[2] == t and r[3] <= 10)
            want = amount <= 10 and any(
                sum(s <= p <= s + width for p in peers) >= min_rows for s in peers if s <= at <= s + width
            )
            assert got[i] == int(want), (i, min_rows)


def test_span_rows_are_among_sliding_rows(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet")
    columns = ("user_id", "event_type", "value", "ts")
    limits = {"limit": 10, "days": 14}
    both = fe.with_split_flag(events, *columns, **limits).join(
        fe.with_sliding_split_flag(events, *columns, out="sliding", **limits).select("event_id", "sliding"), "event_id"
    )
    assert both.count() == events.count()
    assert both.where("split_flag = 1 and sliding = 0").isEmpty()
    assert both.agg(F.sum("split_flag")).first()[0] == 33


def test_underpaid(spark):
    df = spark.createDataFrame([(89.0, 100.0), (90.0, 100.0), (None, 100.0), (-1.0, 0.0)], "paid_sum double, contract_sum double")
    assert [r["underpaid_flag"] for r in fe.with_underpaid_flag(df).collect()] == [1, 0, 0, 0]
    raw = df.select(risk.paid_less("paid_sum", "contract_sum").alias("f"))
    assert [r["f"] for r in raw.collect()] == [1, 0, 0, 1]


def test_score_and_categories(spark):
    flags = spark.createDataFrame([(1, 1, 1, 1, 1), (0, 0, 0, 0, 0), (None, 1, None, 1, 0)], ", ".join(f"{f} int" for f in fixed.RISK_FLAGS))
    assert [r["risk_score"] for r in fe.with_risk_score(flags).collect()] == [7.0, 0.0, 2.5]
    scores = spark.createDataFrame([(1.0,), (1.5,), (3.0,), (3.5,), (0.0,), (None,)], "s double")
    shown = scores.select(risk.category("s").alias("c"), risk.traffic_light("s").alias("t")).collect()
    assert [r["c"] for r in shown] == ["Low", "Medium", "Medium", "High", "Low", None]
    assert [r["t"] for r in shown][:5] == ["yellow", "yellow", "red", "red", "green"]
    ranked = scores.select(risk.category("s").alias("c")).select(risk.category_rank("c").alias("r"))
    assert [r["r"] for r in ranked.collect()][:5] == [0, 1, 1, 2, 0]


def test_composite_key(spark):
    df = spark.createDataFrame(
        [(None, "a", "b", 2.5), ("7", "a", "b", 2.5), (None, None, None, None)],
        "lot_id string, lot_number string, customer_bin string, contract_sum double",
    )
    keys = [r["composite_key"] for r in fe.with_composite_key(df, "lot_number").collect()]
    assert keys[0] == "24626bfae1695bb4" and keys[1] == "" and keys[2] == ""


def test_dates(spark):
    rows = [
        (dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 2, 11)),
        (dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 1, 11)),
        (None, dt.datetime(2024, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "lot_start_date timestamp_ntz, accept_date timestamp_ntz")
    out = fe.with_processing_days(fe.with_calendar(df)).collect()
    assert [r["processing_days"] for r in out] == [0, -1, None]
    assert (out[0]["day_of_week"], out[0]["quarter"], out[0]["fiscal_year"]) == (0, 1, 2024)


def test_features_keep_rows_and_do_not_depend_on_order(spark, small):
    from procrisk.plans import testviews

    joined = testviews.joined(spark, small)
    first = fe.engineer_features(joined, **testviews.SPLIT)
    second = fe.engineer_features(joined.repartition(7, F.rand(3)), **testviews.SPLIT)
    columns = ["lot_id", "price_z", "risk_score", *fixed.RISK_FLAGS]
    a, b = (sorted(map(tuple, d.select(*columns).collect())) for d in (first, second))
    assert a == b and len(a) == 1_473
    totals = {f: sum(r[3 + i] for r in a) for i, f in enumerate(fixed.RISK_FLAGS)}
    assert totals == {"price_flag": 11, "single_flag": 558, "repeat_flag": 106, "split_flag": 3, "underpaid_flag": totals["underpaid_flag"]}
    assert all(0 <= r[2] <= 7 and set(r[3:]) <= {0, 1} for r in a)
