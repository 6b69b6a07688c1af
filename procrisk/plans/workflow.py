"""Raw documents -> bronze -> joined -> featured -> final, each a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procrisk import fixed
from procrisk.operators.features import engineer_features
from procrisk.operators.joins import join_bucketed, procurements, with_join_columns
from procrisk.operators.model import AnomalyModel, predict, save_model, train
from procrisk.operators.normalise import normalise_all
from procrisk.operators.quality import data_quality, quality_rules
from procrisk.sources.tables import read_parquet, require_inputs, write_buckets, write_parquet


def build_bronze(spark: SparkSession, raw: str, folder: str, whole_files: bool = True) -> DataFrame:
    """Normalises every entity; the result reports each."""
    return normalise_all(spark, raw, folder, whole_files=whole_files)


def build_procurements(spark: SparkSession, bronze: str, folder: str) -> DataFrame:
    """Joins the bronze tables; raises before any work when one is absent."""
    paths = [f"{bronze}/{entity}.parquet" for entity in ("OrderDetail", "_Lot", "Plan")]
    require_inputs(spark, paths)
    contracts, lots, plans = (spark.read.parquet(p) for p in paths)
    path = write_parquet(procurements(contracts, lots, plans), f"{folder}/procurements.parquet")
    return spark.read.parquet(path)


def build_bucketed(
    spark: SparkSession, bronze: str, folder: str, buckets: int, prefix: str = "bronze"
) -> DataFrame:
    """Stores contracts and lots of the bronze tables in buckets by lot id, as tables named
    by ``prefix``, and returns their join with the plans. For joins that are repeated."""
    paths = [f"{bronze}/{entity}.parquet" for entity in ("OrderDetail", "_Lot", "Plan")]
    require_inputs(spark, paths)
    contracts, lots, plans = (spark.read.parquet(p) for p in paths)
    contracts, lots = (
        write_buckets(df, f"{prefix}_{name}", f"{folder}/{name}.buckets", "lot_id", buckets)
        for name, df in (("contracts", contracts), ("lots", lots))
    )
    return with_join_columns(join_bucketed(contracts, lots, plans))


def check_procurements(df: DataFrame) -> tuple[bool, DataFrame]:
    """Whether no rule of severity error fails, and the rules with their outcome."""
    rules = quality_rules(data_quality(df))
    failed = rules.where(~F.col("passed") & (F.col("severity") == "error"))
    return failed.isEmpty(), rules


def build_featured(spark: SparkSession, folder: str, **limits) -> DataFrame:
    """Adds the features to the stored join and stores the result by years."""
    joined = read_parquet(spark, f"{folder}/procurements.parquet")
    path = f"{folder}/procurements_featured.parquet"
    return spark.read.parquet(write_parquet(engineer_features(joined, **limits), path, partition_by=["year"]))


def build_final(
    spark: SparkSession, folder: str, key: list[str], **options
) -> tuple[DataFrame, AnomalyModel]:
    """Trains the model, stores it, and stores the scored table."""
    featured = read_parquet(spark, f"{folder}/procurements_featured.parquet")
    model = train(featured, key, fixed.MODEL_FEATURES, **options)
    save_model(spark, model, f"{folder}/model")
    scored = predict(featured, model)
    path = write_parquet(scored, f"{folder}/procurements_final.parquet", partition_by=["year"])
    return spark.read.parquet(path), model
