"""The spread and salted paths give the rows of a plain join."""

import random

import pytest
from pyspark.sql import functions as F

from procrisk.operators.skew import attach, skew_join
from procrisk.session import stage


def rows_of(df):
    return sorted(map(str, (tuple(sorted(r.asDict().items())) for r in df.collect())))


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(1)
    # Key 0 owns a third of the left rows, and a fifth of the rows have no key.
    left = [(0 if i % 3 == 0 else None if i % 5 == 0 else rng.randrange(40), i) for i in range(600)]
    left += [(0, 7)] * 50  # copies of one row
    right = [(k, f"r{k}") for k in range(0, 40, 2)] + [(0, "again"), (None, "none")] + [(4, "copy")] * 30
    return (
        spark.createDataFrame(left, "k int, a int").repartition(4),
        spark.createDataFrame(right, "k int, b string").repartition(3),
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [None, 1, 10, 1_000_000])
def test_equals_plain_join(sides, how, hot_rows):
    left, right = sides
    got = skew_join(left, right, ["k"], how, hot_rows=hot_rows)
    assert rows_of(got) == rows_of(left.join(right, ["k"], how))


def test_two_keys(spark):
    left = spark.createDataFrame(
        [(i % 2, None if i % 7 == 0 else i % 3, i) for i in range(200)], "a int, b int, v int"
    )
    right = spark.createDataFrame([(0, 0, "x"), (1, 2, "y"), (1, None, "z")], "a int, b int, w string")
    got = skew_join(left, right, ["a", "b"], "left", hot_rows=5)
    assert rows_of(got) == rows_of(left.join(right, ["a", "b"], "left"))


def test_keys_hot_on_both_sides_are_salted(sides):
    left, right = sides
    wide = skew_join(left, right, ["k"], "left", hot_rows=1)
    plan = wide._jdf.queryExecution().toString()
    assert "__left_fan_salt" in plan and "CartesianProduct" not in plan


def test_plain_join_runs_no_job_beforehand(spark, sides):
    left, right = sides
    spark.sparkContext.setJobGroup("planning", "skew join without counting")
    skew_join(left, right, ["k"], "left")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_left_key_is_split_while_running(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(60_000, numPartitions=8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("a"),
        )
        right = spark.range(5_000).select(F.col("id").alias("k"), F.lit("r").alias("b"))
        joined = skew_join(left, right, ["k"], "left")
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_attach_both_ways(spark, sides):
    left, _ = sides
    groups = stage(left.groupBy("k").agg(F.count("*").alias("n")).dropna(), "groups")
    small = attach(left, groups, ["k"])
    large = attach(left, groups, ["k"], broadcast_bytes=-1)
    assert rows_of(small) == rows_of(large)
    assert small.count() == left.count()
