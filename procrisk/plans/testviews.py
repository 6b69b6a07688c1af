"""Order tables seen as procurement data: contracts, lots and plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procrisk.operators.features import engineer_features
from procrisk.operators.joins import procurements
from procrisk.operators.reports import with_category
from procrisk.session import stage

# Split limits that fit these amounts and dates.
SPLIT = {"split_limit": 250_000, "split_days": 365}

_stored: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the test tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def contracts(spark: SparkSession, folder: str) -> DataFrame:
    """One contract per order with lines."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = table(spark, folder, "lineitem")
    # In decimals throughout: a product rounded from doubles depends on the engine.
    paid = F.col("l_extendedprice").cast("decimal(18,2)") * (1 - 2 * F.col("l_discount").cast("decimal(4,2)"))
    # Lines are summed per order before the join: a third of all lines in one order
    # is one partial sum per task, and the join meets unique keys.
    sums = lines.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("contract_sum"),
        F.sum(paid).cast("double").alias("paid_sum"),
        F.max("l_shipdate").alias("accept_date"),
        F.max("l_linenumber").alias("order_method_id"),
    )
    return sums.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").cast("string").alias("lot_id"),
        F.col("o_orderstatus").alias("provider_bin"),
        F.col("o_custkey").cast("string").alias("customer_bin"),
        "contract_sum",
        "paid_sum",
        "accept_date",
        "order_method_id",
    )


def lots(spark: SparkSession, folder: str) -> DataFrame:
    """One lot per order; every tenth has lost its id, so its contract finds no lot."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        F.when(key % 10 != 0, key.cast("string")).alias("lot_id"),
        F.col("o_custkey").cast("string").alias("plan_id"),
        F.concat(F.lit("T"), F.col("o_custkey")).alias("tender_id"),
        F.col("o_totalprice").alias("lot_amount"),
        F.col("o_orderpriority").alias("title_ru"),
        (F.substring("o_orderpriority", 1, 1).cast("int") + 1).alias("lot_method_id"),
        F.col("o_orderdate").alias("lot_start_date"),
    )


def plans(spark: SparkSession, folder: str) -> DataFrame:
    """One plan per customer in credit."""
    return table(spark, folder, "customer").where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").cast("string").alias("plan_id"),
        F.col("c_acctbal").alias("plan_price"),
        F.col("c_nationkey").alias("plan_method_id"),
        F.col("c_nationkey").cast("string").alias("plan_customer_bin"),
    )


def joined(spark: SparkSession, folder: str, **options) -> DataFrame:
    """The joined fact table."""
    return procurements(
        contracts(spark, folder), lots(spark, folder), plans(spark, folder), **options
    )


def build_featured(spark: SparkSession, folder: str) -> DataFrame:
    """The featured table with categories, from the stored join."""
    return with_category(engineer_features(stage(joined(spark, folder), "joined"), **SPLIT))


def stored(spark: SparkSession, folder: str, name: str, build) -> DataFrame:
    """A table built and stored once per session, as reports read stored tables."""
    at = (spark.sparkContext.applicationId, folder, name)
    if at not in _stored:
        _stored[at] = stage(build(spark, folder), name)
    return _stored[at]


def fact(spark: SparkSession, folder: str) -> DataFrame:
    """The stored join."""
    return stored(spark, folder, "joined", joined)


def featured(spark: SparkSession, folder: str) -> DataFrame:
    """The stored featured table."""
    return stored(spark, folder, "featured", build_featured)
