"""Anomaly model: shares, outliers, determinism, storage, scaling."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from procrisk.operators import iforest, model
from procrisk.operators.features import with_calendar


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(2_000, 2)))]
    rows += [(2_000 + i, 12.0 + i, -15.0) for i in range(5)]
    return spark.createDataFrame(rows, "id long, x double, y double")


@pytest.fixture(scope="module")
def fitted(cloud):
    return model.train(cloud, ["id"], ["x", "y"], trees=50)


def scores(df):
    return {r["id"]: r["anomaly_score"] for r in df.collect()}


def test_share_and_outliers(cloud, fitted):
    scored = model.score_rows(cloud, fitted)
    share = scored.agg(F.avg("is_anomaly")).first()[0]
    assert abs(share - 0.05) < 0.005
    found = scores(scored)
    assert set(sorted(found, key=found.get)[:5]) == set(range(2_000, 2_005))


def test_same_seed_same_scores(cloud, fitted):
    again = model.train(cloud.repartition(7, "y").sortWithinPartitions("x"), ["id"], ["x", "y"], trees=50)
    a, b = scores(model.score_rows(cloud, fitted)), scores(model.score_rows(cloud.repartition(3), again))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_trees(cloud, fitted):
    nodes = fitted.forest.nodes
    roots = nodes[nodes["node_id"] == 0]
    assert len(roots) == 50 and (roots["size"] == 256).all()
    assert nodes["depth"].max() <= 8
    inner = nodes[nodes["feature"] >= 0]
    sizes = nodes.set_index(["tree_id", "node_id"])["size"]
    left = [sizes[(r.tree_id, r.left_id)] for r in inner.itertuples()]
    right = [sizes[(r.tree_id, r.right_id)] for r in inner.itertuples()]
    assert (np.array(left) + np.array(right) == inner["size"].to_numpy()).all()
    assert min(left) > 0 and min(right) > 0


def test_score_equals_walk_by_hand(cloud, fitted):
    forest = fitted.forest
    p = fitted.preparation
    row = cloud.where("id = 17").first()
    x = [(row[f] - p.means[f]) / p.deviations[f] for f in p.features]
    total = 0.0
    for _, tree in forest.nodes.groupby("tree_id"):
        tree = tree.set_index("node_id")
        at = 0
        while tree.loc[at, "feature"] >= 0:
            node = tree.loc[at]
            at = int(node["left_id"] if x[int(node["feature"])] <= node["threshold"] else node["right_id"])
        total += tree.loc[at, "depth"] + iforest.expected_path(tree.loc[at, "size"])
    want = -(2 ** (-total / forest.trees / iforest.expected_path(256))) - forest.offset
    got = model.score_rows(cloud.where("id = 17"), fitted).first()["anomaly_score"]
    assert got == pytest.approx(want, abs=1e-12)


def test_few_rows_and_duplicate_keys(spark):
    df = spark.createDataFrame([(i % 20, float(i % 20)) for i in range(60)], "id int, x double")
    fitted = model.train(df, ["id"], ["x"], trees=10)
    assert fitted.forest.sample_size == 20
    constant = spark.createDataFrame([(i, 1.0) for i in range(10)], "id int, x double")
    assert model.train(constant, ["id"], ["x"], trees=5).forest.trees == 5


def test_save_and_load(spark, cloud, fitted, tmp_path):
    path = str(tmp_path / "model")
    assert model.load_model(spark, path) is None
    model.save_model(spark, fitted, path)
    loaded = model.load_model(spark, path)
    a, b = scores(model.score_rows(cloud, fitted)), scores(model.score_rows(cloud, loaded))
    assert a == b


def test_missing_values(spark, cloud, fitted):
    odd = spark.createDataFrame(
        [(1, None, 1.0), (2, float("inf"), 1.0), (3, float("nan"), 1.0)], "id long, x double, y double"
    )
    found = scores(model.score_rows(odd, fitted))
    assert found[1] == found[2] == found[3]
    scored = model.score_rows(odd.withColumn("x", F.lit(None).cast("double")), fitted, impute_from="batch")
    assert scored.count() == 3


def test_features(spark):
    df = with_calendar(spark.sql("select timestamp_ntz'2024-05-01' lot_start_date, 1.0d contract_sum"))
    assert model.select_features(df) == ["contract_sum", "year", "month", "quarter"]
    with pytest.raises(ValueError):
        model.select_features(df, ["unknown"])


def test_min_max_and_blend(spark):
    df = spark.createDataFrame([(5.0, 2.0), (5.0, 0.0)], "anomaly_score double, risk_score double")
    out = model.with_combined_score(model.with_min_max(df)).collect()
    assert [r["anomaly_score_normalized"] for r in out] == [0.5, 0.5]
    assert [r["combined_risk_score"] for r in out] == pytest.approx([2.2, 1.0])
    alone = model.with_combined_score(model.with_min_max(df.drop("risk_score"))).first()
    assert alone["combined_risk_score"] == 2.5


def test_predict_columns(cloud, fitted):
    out = model.predict(cloud.withColumn("risk_score", F.lit(1.0)), fitted)
    assert out.columns[-4:] == ["anomaly_score", "is_anomaly", "anomaly_score_normalized", "combined_risk_score"]
    low, high = out.agg(F.min("anomaly_score_normalized"), F.max("anomaly_score_normalized")).first()
    assert (low, high) == (0.0, 1.0) and out.count() == 2_005


def test_evaluation(spark):
    df = spark.createDataFrame(
        [(1, 0, 1), (0, 0, 1), (0, 1, 0), (0, 0, 0)], "price_flag int, split_flag int, is_anomaly int"
    )
    row = model.evaluate(df).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["accuracy"], row["support"]) == (0.5, 0.5, 0.5, 0.5, 2)
    assert model.evaluate(df.select("is_anomaly")).isEmpty()
    assert model.evaluate(df.drop("is_anomaly")).isEmpty()
    none = model.evaluate(df.withColumn("is_anomaly", F.lit(0))).first()
    assert none["precision"] == 0 and none["f1_score"] == 0


def test_repeated_keys_are_drawn_apart(spark):
    rng = np.random.default_rng(4)
    rows = [(i % 10 if i % 7 else None, float(a)) for i, a in enumerate(rng.normal(size=1_000))]
    df = spark.createDataFrame(rows, "id long, x double")
    samples = iforest.tree_samples(df, ["x"], ["id"], 1_000, trees=5, max_samples=64)
    assert {r["tree_id"]: r["count"] for r in samples.groupBy("tree_id").count().collect()} == dict.fromkeys(range(5), 64)
