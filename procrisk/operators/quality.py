"""Statistics, quality checks and party views of the joined table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procrisk import fixed
from procrisk.functions.types import money


def join_statistics(df: DataFrame, date_col: str = "lot_start_date") -> DataFrame:
    """One row: records, columns, first and last date."""
    return df.agg(
        F.count("*").alias("records"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.min(date_col).alias("start_date"),
        F.max(date_col).alias("end_date"),
    )


def stored_size(spark, path: str) -> DataFrame:
    """One row: files and bytes stored under ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def data_quality(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: NULL counts, distinct parties and the mean contract value.

    Distinct parties are counted exactly by default; ``approximate`` uses sketches,
    which need no shuffle of the party ids.
    """
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    return df.agg(
        F.count("*").alias("records"),
        F.count_if(F.col("lot_id").isNull()).alias("null_lot_ids"),
        F.count_if(F.col("contract_sum").isNull()).alias("null_contract_sums"),
        F.count_if(F.col("provider_bin").isNull()).alias("null_provider_bins"),
        distinct("customer_bin").alias("unique_customers"),
        distinct("provider_bin").alias("unique_providers"),
        mean_money("contract_sum").alias("avg_contract_value"),
    )


def quality_rules(quality: DataFrame) -> DataFrame:
    """The row of ``data_quality`` against the rules: rule, value, limit, severity, passed."""
    rules = [
        ("has_records", "records", F.lit(1.0), "error", "min"),
        ("null_lot_ids", "null_lot_ids", F.col("records") * fixed.MAX_NULL_LOT_SHARE, "warning", "max"),
        (
            "null_provider_bins", "null_provider_bins",
            F.col("records") * fixed.MAX_NULL_PROVIDER_SHARE, "warning", "max",
        ),
        ("unique_customers", "unique_customers", F.lit(float(fixed.MIN_CUSTOMERS)), "warning", "min"),
    ]
    checks = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.col(value).cast("double").alias("value"),
            limit.cast("double").alias("limit_value"),
            F.lit(severity).alias("severity"),
            (F.col(value) >= limit if kind == "min" else F.col(value) <= limit).alias("passed"),
        )
        for rule, value, limit, severity, kind in rules
    ]
    return quality.select(F.inline(F.array(*checks)))


def customer_view(df: DataFrame) -> DataFrame:
    """Per customer: contracts, value, mean, distinct providers, mean payment ratio."""
    return _party_view(
        df, "customer_bin", "provider_bin", "unique_providers",
        F.round(F.avg("payment_ratio"), 6).alias("avg_payment_ratio"),
    )


def provider_view(df: DataFrame) -> DataFrame:
    """Per provider: contracts, value, mean, distinct customers, single-source wins."""
    return _party_view(
        df, "provider_bin", "customer_bin", "unique_customers",
        F.sum("single_bidder_flag").alias("single_bidder_wins"),
    )


def create_views(df: DataFrame) -> list[str]:
    """Registers both party views in the session and returns their names."""
    views = {"customer_analysis": customer_view(df), "provider_analysis": provider_view(df)}
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)


def total_money(column: str):
    """Sum through exact decimals, as double. Values that no such decimal can hold are
    added as doubles; NaN counts as missing."""
    value = F.col(column)
    beyond = F.sum(F.when(money(value).isNull() & ~F.isnan(value.cast("double")), value.cast("double")))
    exact = F.sum(money(value)).cast("double")
    return F.coalesce(exact + beyond, exact, beyond)


def mean_money(column: str, digits: int = 6):
    """Mean through an exact decimal sum, as double; NaN counts as missing."""
    held = F.count(F.when(~F.isnan(F.col(column).cast("double")), F.col(column)))
    mean = F.try_divide(total_money(column), held)
    return F.round(mean, digits)


def _party_view(df: DataFrame, party: str, partner: str, partners: str, extra) -> DataFrame:
    # One distinct aggregate: Spark first reduces to (party, partner), so even a party
    # with very many rows reaches the last step as one partial row per task.
    return (
        df.where(F.col(party).isNotNull())
        .groupBy(party)
        .agg(
            F.count("*").alias("total_contracts"),
            total_money("contract_sum").alias("total_value"),
            mean_money("contract_sum").alias("avg_contract_value"),
            F.countDistinct(partner).alias(partners),
            extra,
        )
    )
