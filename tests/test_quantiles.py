"""Exact quantiles against NumPy, on the direct and on the narrowing path."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from procrisk.operators import quantiles
from procrisk.operators.quantiles import column_quantiles, group_median_mad, group_quantile
from procrisk.session import stage


def mad(values):
    return float(np.median(np.abs(values - np.median(values))))


GROUPS = {
    "mixed": [-5.0, -5.0, 0.0, 0.0, 3.5, 1e-300, -1e-300, 1e300, 7.25, -2.5],
    "close": [1.0 + i * 1e-12 for i in range(40)],
    "same": [4.2] * 25,
    "two": [1.0, 1e12],
    "one": [-3.0],
    "cents": [round(0.01 * ((i * 37) % 1009), 2) for i in range(500)],
    "huge": [float("inf"), 1.7e308, -1.7e308, float("-inf"), 2.0],
}


@pytest.fixture(scope="module")
def table(spark):
    rows = [(g, v) for g, values in GROUPS.items() for v in values]
    rows += [("cents", None), ("cents", float("nan")), (None, 1.0)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5)


@pytest.mark.parametrize("hot_rows", [0, 30, 1_000_000])
@pytest.mark.parametrize("q", [0.0, 0.05, 0.5])
def test_group_quantile(table, hot_rows, q):
    got = {r["g"]: r for r in group_quantile(table, ["g"], "v", q, hot_rows=hot_rows).collect()}
    assert set(got) == set(GROUPS)
    for g, values in GROUPS.items():
        assert got[g]["n"] == len(values)
        if g == "huge":
            ends = {0.0: float("-inf"), 0.5: 2.0}
            assert q not in ends or got[g]["quantile"] == ends[q]
        else:
            assert got[g]["quantile"] == pytest.approx(float(np.quantile(values, q)), rel=1e-12), g


@pytest.mark.parametrize("hot_rows", [0, 30, 1_000_000])
def test_median_and_mad(table, hot_rows):
    got = {r["g"]: r for r in group_median_mad(table, ["g"], "v", hot_rows=hot_rows).collect()}
    for g in ("mixed", "close", "same", "two", "one", "cents"):
        values = np.array(GROUPS[g])
        assert got[g]["median"] == pytest.approx(float(np.median(values)), rel=1e-12)
        assert got[g]["mad"] == pytest.approx(mad(values), rel=1e-9, abs=1e-300)


@pytest.mark.parametrize("hot_rows", [0, 1_000_000])
def test_columns(spark, hot_rows):
    rng = np.random.default_rng(3)
    data = [(float(a), float(b)) for a, b in rng.normal(size=(300, 2))] + [(None, 1.0)]
    df = spark.createDataFrame(data, "a double, b double")
    got = {r["feature"]: r["quantile"] for r in column_quantiles(df, ["a", "b"], 0.05, hot_rows=hot_rows).collect()}
    for i, name in enumerate("ab"):
        values = [row[i] for row in data if row[i] is not None]
        assert got[name] == pytest.approx(float(np.quantile(values, 0.05)), rel=1e-12)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_any_values(spark, values):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    row = group_quantile(df, ["g"], "v", 0.5, hot_rows=0).first()
    assert row["quantile"] == pytest.approx(float(np.median(values)), rel=1e-9, abs=1e-300)


def test_narrowing_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SLICES", 4)
    rng = np.random.default_rng(5)
    values = {g: rng.lognormal(size=n).round(3) for g, n in (("a", 3_000), ("b", 900))}
    rows = [(g, float(v)) for g, all_values in values.items() for v in all_values]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    for q in (0.01, 0.5, 0.99):
        got = {r["g"]: r["quantile"] for r in group_quantile(df, ["g"], "v", q, hot_rows=5).collect()}
        assert got == {g: pytest.approx(float(np.quantile(v, q)), rel=1e-12) for g, v in values.items()}


def scans(spark, path, run):
    """File scans of ``path`` in all plans that ``run`` executes, by the files' last access."""
    source = spark.read.parquet(path)
    counter = spark.sparkContext.accumulator(0)

    def count(batches):
        counter.add(1)
        yield from batches

    run(source.coalesce(1).mapInArrow(count, source.schema))
    return counter.value


def test_two_scans_for_any_columns(spark):
    rng = np.random.default_rng(6)
    data = [tuple(map(float, row)) for row in rng.normal(size=(5_000, 6))]
    names = list("abcdef")
    path_of = stage(spark.createDataFrame(data, ", ".join(f"{c} double" for c in names)), "scans")
    path = path_of.inputFiles()[0].rsplit("/", 1)[0]
    found = {}

    def run(df):
        rows = column_quantiles(df, names, 0.3, hot_rows=10, accuracy=200).collect()
        found.update({r["feature"]: r["quantile"] for r in rows})

    assert scans(spark, path, run) <= 2
    for c, values in zip(names, zip(*data, strict=True), strict=True):
        assert found[c] == pytest.approx(float(np.quantile(values, 0.3)), rel=1e-12)


def test_a_missed_bracket_is_opened(spark, monkeypatch):
    real = quantiles._bracketed
    calls = []

    def wrong(clean, brackets):
        calls.append(brackets)
        if len(calls) == 1:
            brackets = {c: (1e9, 2e9) for c in brackets}
        return real(clean, brackets)

    monkeypatch.setattr(quantiles, "_bracketed", wrong)
    df = spark.createDataFrame([(float(k),) for k in range(101)], "v double")
    assert column_quantiles(df, ["v"], 0.5).first()["quantile"] == 50.0
    assert len(calls) == 2


def test_sketched_median_and_mad(spark):
    rng = np.random.default_rng(7)
    values = {g: rng.lognormal(size=n) for g, n in (("a", 30_000), ("b", 40))}
    rows = [(g, float(v)) for g, all_values in values.items() for v in all_values]
    df = spark.createDataFrame([*rows, ("a", None), (None, 1.0), ("b", float("nan"))], "g string, v double")
    got = {r["g"]: r for r in quantiles.sketch_median_mad(df.repartition(5), ["g"], "v").collect()}
    assert set(got) == set(values)
    error = 2 * quantiles.sketch_error()
    for g, v in values.items():
        assert got[g]["n"] == len(v)
        for x, of in ((got[g]["median"], v), (got[g]["mad"], np.abs(v - got[g]["median"]))):
            assert (of < x).mean() - error <= 0.5 <= (of <= x).mean() + error


def test_distances_of_large_groups_are_not_shuffled(spark, monkeypatch):
    """Only the values of the kept slices are grouped; equal and equally far values count."""
    rows = spark.range(0, 40_000, 1, 4).select(
        (F.col("id") % 2).alias("g"), F.when(F.col("id") < 300, 1e20).otherwise(F.col("id") / 7).alias("v")
    )
    stored, real = {}, quantiles.stage

    def watched(df, name):
        out = real(df, name)
        stored.setdefault(name, []).append((df._jdf.queryExecution().optimizedPlan().toString(), out.count()))
        return out

    monkeypatch.setattr(quantiles, "stage", watched)
    got = {r["g"]: (r["n"], r["median"], r["mad"]) for r in quantiles.group_median_mad(rows, ["g"], "v", hot_rows=500).collect()}
    for g in (0, 1):
        v = np.array([1e20 if k < 300 else k / 7 for k in range(g, 40_000, 2)])
        median = np.median(v)
        assert got[g] == pytest.approx((len(v), median, np.median(np.abs(v - median))))
    # The cuts of the distances come from one aggregation by group, not one by value before.
    assert all(plan.count("Aggregate [") == 1 for plan, _ in stored["value-slices"])
    # Values that all become one distance end the narrowing.
    far = spark.range(3_000).select(F.lit(1).alias("g"), F.when(F.col("id") < 1_400, F.col("id")).otherwise(1e20 + 1e6 * F.col("id")).alias("v"))
    (row,) = quantiles.group_median_mad(far, ["g"], "v", hot_rows=200).collect()
    v = np.array([k if k < 1_400 else 1e20 + 1e6 * k for k in range(3_000)])
    assert row["median"] == np.median(v) and row["mad"] == np.median(np.abs(v - np.median(v)))
