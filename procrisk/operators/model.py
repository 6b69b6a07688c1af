"""Anomaly model: preparation, training, scoring, evaluation and storage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from procrisk import fixed
from procrisk.functions import risk
from procrisk.functions.logic import any_of
from procrisk.operators.iforest import NODE_SCHEMA, Forest, decision, fit_forest
from procrisk.operators.quantiles import column_quantiles
from procrisk.session import stage


@dataclass(frozen=True)
class Preparation:
    """Median, mean and population deviation of every model feature."""

    features: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    deviations: dict[str, float]


@dataclass(frozen=True)
class AnomalyModel:
    """What scoring needs: the preparation and the forest over the prepared features."""

    preparation: Preparation
    forest: Forest


def select_features(df: DataFrame, candidates: list[str] | None = None) -> list[str]:
    """The candidate features the table has; raises when it has none."""
    present = [c for c in candidates or fixed.MODEL_FEATURES if c in df.columns]
    if not present:
        raise ValueError("no suitable features found")
    return present


def finite(column: str) -> Column:
    """Column as double; NaN and infinities as NULL."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def medians_of(df: DataFrame, features: list[str]) -> dict[str, float]:
    """Exact median of the finite values of each feature, 0 for a feature without any."""
    clean = df.select(*[finite(f).alias(f) for f in features])
    rows = column_quantiles(clean, features, 0.5).collect()  # one row per feature
    found = {row["feature"]: row["quantile"] for row in rows}
    return {f: found.get(f, 0.0) for f in features}


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Missing and infinite values replaced by the medians."""
    return df.withColumns(
        {f: F.coalesce(finite(f), F.lit(float(m))) for f, m in medians.items()}
    )


def prepare(df: DataFrame, features: list[str]) -> tuple[Preparation, int]:
    """Statistics for ``standardise``, and the number of rows."""
    medians = medians_of(df, features)
    filled = impute(df, medians)
    row = filled.agg(
        F.count("*").alias("__n"),
        *[F.avg(f).alias(f"mean_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"std_{f}") for f in features],
    ).first()
    means = {f: row[f"mean_{f}"] or 0.0 for f in features}
    deviations = {f: row[f"std_{f}"] or 1.0 for f in features}
    return Preparation(features, medians, means, deviations), row["__n"]


def standardise(df: DataFrame, preparation: Preparation, prefix: str = "") -> DataFrame:
    """(x - mean) / population deviation of the imputed features, as ``prefix + name``."""
    p = preparation
    return df.withColumns(
        {
            prefix + f: (F.coalesce(finite(f), F.lit(p.medians[f])) - F.lit(p.means[f]))
            / F.lit(p.deviations[f])
            for f in p.features
        }
    )


_PREFIX = "__std_"


def train(
    df: DataFrame,
    key: list[str],
    features: list[str] | None = None,
    *,
    contamination: float = fixed.CONTAMINATION,
    seed: int = fixed.SEED,
    trees: int = fixed.TREES,
    max_samples: int = fixed.MAX_SAMPLES,
    exact_offset: bool = True,
) -> AnomalyModel:
    """Fits preparation and forest. ``key`` must identify a row. Rows are drawn by their raw
    values, so the same seed gives the same forest under any partitioning."""
    preparation, rows = prepare(df, select_features(df, features))
    scaled = standardise(df, preparation, _PREFIX)
    names = [_PREFIX + f for f in preparation.features]
    forest = fit_forest(
        scaled.select(*dict.fromkeys([*key, *preparation.features, *names])), names, key, rows=rows,
        trees=trees, max_samples=max_samples, contamination=contamination, seed=seed,
        exact_offset=exact_offset, draw_by=preparation.features,
    )
    return AnomalyModel(preparation, forest)


def score_rows(df: DataFrame, model: AnomalyModel, impute_from: str = "training") -> DataFrame:
    """Adds ``anomaly_score`` and ``is_anomaly`` (1 below zero).

    ``impute_from="batch"`` fills gaps with the medians of ``df`` instead of the stored.
    """
    preparation = model.preparation
    if impute_from == "batch":
        preparation = Preparation(
            preparation.features, medians_of(df, preparation.features),
            preparation.means, preparation.deviations,
        )
    scored = decision(standardise(df, preparation, _PREFIX), model.forest)
    return with_anomaly_label(scored).select(*df.columns, "anomaly_score", "is_anomaly")


def with_anomaly_label(df: DataFrame, score: str = "anomaly_score") -> DataFrame:
    """1 where the score is below zero, the place of the contamination quantile."""
    return df.withColumn("is_anomaly", risk.flag(F.col(score) < 0))


def label_by_quantile(
    df: DataFrame, score: str, contamination: float = fixed.CONTAMINATION, out: str = "is_anomaly"
) -> DataFrame:
    """1 for rows whose score is below its exact ``contamination`` quantile."""
    limit = column_quantiles(df, [score], contamination).first()
    return df.withColumn(out, risk.flag(F.col(score) < F.lit(limit["quantile"] if limit else None)))


def with_min_max(
    df: DataFrame, score: str = "anomaly_score", out: str = "anomaly_score_normalized"
) -> DataFrame:
    """Score scaled to 0..1; 0.5 when all scores are equal."""
    ends = df.agg(F.struct(F.min(score).alias("low"), F.max(score).alias("high"))).scalar()
    low, high = ends["low"], ends["high"]
    scaled = F.when(high > low, (F.col(score) - low) / (high - low)).otherwise(F.lit(0.5))
    return df.withColumn(out, scaled)


def with_combined_score(
    df: DataFrame,
    normalized: str = "anomaly_score_normalized",
    out: str = "combined_risk_score",
    inverted: bool = False,
) -> DataFrame:
    """Rule score and scaled anomaly score blended 60 : 40.

    High scores are normal rows, so the plain blend raises the risk of normal rows;
    ``inverted`` blends 1 - score instead.
    """
    share = 1 - F.col(normalized) if inverted else F.col(normalized)
    part = share * F.lit(fixed.ANOMALY_SCALE)
    if "risk_score" in df.columns:
        part = F.lit(fixed.RULE_SHARE) * F.col("risk_score") + F.lit(fixed.ANOMALY_SHARE) * part
    return df.withColumn(out, part)


def predict(
    df: DataFrame, model: AnomalyModel, impute_from: str = "training", inverted: bool = False
) -> DataFrame:
    """Adds score, label, scaled score and combined score.

    The scored rows are staged, because scaling needs their range before any row.
    """
    scored = stage(score_rows(df, model, impute_from), "scored")
    return with_combined_score(with_min_max(scored), inverted=inverted)


def score_summary(
    df: DataFrame,
    features: int,
    score: str = "anomaly_score",
    label: str = "is_anomaly",
    contamination: float = fixed.CONTAMINATION,
) -> DataFrame:
    """One row of training statistics."""
    return df.agg(
        F.count("*").alias("total_samples"),
        F.lit(features).cast("long").alias("features_used"),
        F.sum(label).alias("anomalies_detected"),
        F.round(F.try_divide(F.sum(label).cast("double"), F.count("*")), 6).alias("anomaly_rate"),
        F.lit(contamination).alias("contamination_target"),
        F.round(F.min(score), 6).alias("score_min"),
        F.round(F.max(score), 6).alias("score_max"),
        F.round(F.avg(score), 6).alias("score_mean"),
        F.round(F.stddev_pop(score), 6).alias("score_std"),
    )


def final_counts(
    df: DataFrame, label: str = "is_anomaly", combined: str = "combined_risk_score"
) -> DataFrame:
    """One row: anomalies, and rows of high combined risk."""
    return df.agg(
        F.sum(label).alias("final_anomalies"),
        F.count_if(F.col(combined) >= fixed.HIGH_FROM).alias("high_risk_combined"),
    )


def evaluate(
    df: DataFrame, flags: list[str] | None = None, label: str = "is_anomaly"
) -> DataFrame:
    """Any flag against the label, for class 1; no rows when there are no flags."""
    present = [f for f in flags or fixed.RISK_FLAGS if f in df.columns]
    spark = df.sparkSession
    schema = "precision double, recall double, f1_score double, accuracy double, support long"
    if not present or label not in df.columns:
        return spark.createDataFrame([], schema)
    truth = any_of([F.coalesce(F.col(f), F.lit(0)) > 0 for f in present])
    found = F.col(label) == 1
    counts = df.agg(
        F.count("*").alias("n"),
        F.count_if(truth & found).alias("tp"),
        F.count_if(truth).alias("support"),
        F.count_if(found).alias("found"),
        F.count_if(truth == found).alias("right"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.round(F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0)), 6)

    return counts.select(
        share(F.col("tp"), F.col("found")).alias("precision"),
        share(F.col("tp"), F.col("support")).alias("recall"),
        share(2 * F.col("tp"), F.col("found") + F.col("support")).alias("f1_score"),
        share(F.col("right"), F.col("n")).alias("accuracy"),
        "support",
    )


def save_model(spark: SparkSession, model: AnomalyModel, path: str) -> dict[str, str]:
    """Stores nodes, feature statistics and parameters; returns their paths."""
    p, forest = model.preparation, model.forest
    features = [
        (i, f, float(p.medians[f]), float(p.means[f]), float(p.deviations[f]))
        for i, f in enumerate(p.features)
    ]
    tables = {
        "nodes": spark.createDataFrame(forest.nodes, NODE_SCHEMA),
        "features": spark.createDataFrame(
            features, "position int, feature string, median double, mean double, deviation double"
        ),
        "parameters": spark.createDataFrame(
            [(forest.sample_size, forest.offset)], "sample_size int, offset double"
        ),
    }
    for name, table in tables.items():
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
    return {name: f"{path}/{name}" for name in tables}


def load_model(spark: SparkSession, path: str) -> AnomalyModel | None:
    """The stored model, or None when it cannot be read."""
    try:
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes").toPandas()
        features = spark.read.parquet(f"{path}/features").orderBy("position").collect()
        parameters = spark.read.parquet(f"{path}/parameters").first()
    except AnalysisException:
        return None
    if nodes.empty or not features or parameters is None:
        return None
    names = [row["feature"] for row in features]
    preparation = Preparation(
        names,
        {row["feature"]: row["median"] for row in features},
        {row["feature"]: row["mean"] for row in features},
        {row["feature"]: row["deviation"] for row in features},
    )
    nodes = nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    forest = Forest(
        nodes, [_PREFIX + n for n in names], parameters["sample_size"], parameters["offset"]
    )
    return AnomalyModel(preparation, forest)
