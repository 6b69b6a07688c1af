"""Filters, aggregates and tables of the risk report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procrisk import fixed
from procrisk.functions import risk, text
from procrisk.functions.logic import any_of
from procrisk.operators.quality import mean_money, total_money
from procrisk.sources.tables import write_csv

# Longest customer list written into the filter itself; a longer one is joined.
_LIST_LIMIT = 1_000


@dataclass(frozen=True)
class Filters:
    """What a report is restricted to. An empty part does not restrict."""

    date_range: tuple[dt.date, dt.date] | None = None
    categories: list[str] = field(default_factory=list)
    value_range: tuple[float, float] | None = None
    customers: list[str] = field(default_factory=list)
    flags: list[str] = field(default_factory=list)


def score_column(df: DataFrame) -> str | None:
    """The combined score if there is one, else the rule score."""
    return next((c for c in ("combined_risk_score", "risk_score") if c in df.columns), None)


def flag_columns(df: DataFrame) -> list[str]:
    """Columns named as flags, in table order."""
    return [c for c in df.columns if c.endswith("_flag")]


def with_category(df: DataFrame) -> DataFrame:
    """Risk category of the best score; a table without scores gets a score of 0."""
    if score_column(df) is None:
        df = df.withColumn("risk_score", F.lit(0))
    return df.withColumn("risk_category", risk.category(score_column(df)))


def with_traffic_light(df: DataFrame, score: str | None = None) -> DataFrame:
    """Colour of the score: green, yellow from 1, red from 3."""
    return df.withColumn("color", risk.traffic_light(score or score_column(df)))


def facet_ranges(df: DataFrame) -> DataFrame:
    """One row: first and last date, smallest and largest value."""
    return df.agg(
        F.min("lot_start_date").alias("date_min"),
        F.max("lot_start_date").alias("date_max"),
        F.min("contract_sum").alias("value_min"),
        F.max("contract_sum").alias("value_max"),
    )


def facet_customers(df: DataFrame, limit: int = fixed.FACET_CUSTOMERS) -> DataFrame:
    """The first customers in order."""
    known = df.select("customer_bin").where(F.col("customer_bin").isNotNull())
    return known.distinct().orderBy("customer_bin").limit(limit)


def facet_flags(df: DataFrame) -> DataFrame:
    """Flag columns and their titles."""
    names = df.sparkSession.createDataFrame([(f,) for f in flag_columns(df)], "flag string")
    return names.withColumn("title", text.flag_title("flag"))


def facet_flag_counts(df: DataFrame) -> DataFrame:
    """The list of flags to choose from, each with the contracts that carry it."""
    flags = flag_columns(df)
    counted = df.agg(*[F.count_if(F.col(f) == 1).alias(f) for f in flags])
    return facet_flags(df).join(counted.unpivot([], flags, "flag", "contracts"), "flag")


def in_date_range(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Start dates from ``start`` to midnight of ``end``, both included."""
    # Literals of the column's own type, so that the filter reaches the scan.
    low, high = (F.lit(str(d)).cast("timestamp_ntz") for d in (start, end))
    rows = df.where(F.col("lot_start_date").between(low, high))
    if "year" not in df.columns:
        return rows
    # The year of the same date: a table stored by years is read in part.
    return rows.where(F.col("year").between(start.year, end.year))


def in_categories(df: DataFrame, categories: list[str]) -> DataFrame:
    """Rows of the categories; an empty list keeps all."""
    return df.where(F.col("risk_category").isin(list(categories))) if categories else df


def in_value_range(df: DataFrame, low: float, high: float) -> DataFrame:
    """Contract sums in the closed range."""
    return df.where(F.col("contract_sum").between(low, high))


def of_customers(df: DataFrame, customers: list[str]) -> DataFrame:
    """Rows of the customers; an empty list keeps all."""
    if not customers:
        return df
    if len(customers) <= _LIST_LIMIT:
        return df.where(F.col("customer_bin").isin(list(customers)))
    wanted = df.sparkSession.createDataFrame([(c,) for c in set(customers)], "customer_bin string")
    return df.join(wanted, "customer_bin", "left_semi")


def with_any_flag(df: DataFrame, flags: list[str]) -> DataFrame:
    """Rows that carry one of the flags the table has; no such flag keeps all."""
    present = [f for f in flags if f in df.columns]
    return df.where(any_of([F.col(f) == 1 for f in present])) if present else df


def apply_filters(df: DataFrame, filters: Filters) -> DataFrame:
    """All restrictions together."""
    if filters.date_range:
        df = in_date_range(df, *filters.date_range)
    df = in_categories(df, filters.categories)
    if filters.value_range:
        df = in_value_range(df, *filters.value_range)
    return with_any_flag(of_customers(df, filters.customers), filters.flags)


def summary_metrics(df: DataFrame) -> DataFrame:
    """One row: contracts, value, high-risk contracts and share, customers."""
    high = F.count_if(F.col("risk_category") == "High")
    return df.agg(
        F.count("*").alias("total_contracts"),
        F.coalesce(total_money("contract_sum"), F.lit(0.0)).alias("total_value"),
        high.alias("high_risk"),
        F.round(F.try_divide(high * 100.0, F.count("*")), 6).alias("high_risk_percent"),
        F.countDistinct("customer_bin").alias("unique_customers"),
    )


def category_distribution(df: DataFrame) -> DataFrame:
    """Contracts per category; a category without any is 0."""
    counted = df.agg(
        *[F.count_if(F.col("risk_category") == c).alias(c) for c in fixed.CATEGORIES]
    )
    return counted.unpivot([], fixed.CATEGORIES, "risk_category", "contracts")


def monthly_trend(df: DataFrame) -> DataFrame:
    """Months by category, absent combinations 0."""
    known = df.where(F.col("lot_start_date").isNotNull() & F.col("risk_category").isNotNull())
    return (
        known.groupBy(F.date_format("lot_start_date", "yyyy-MM").alias("month"))
        .pivot("risk_category", fixed.CATEGORIES)
        .count()
        .fillna(0, fixed.CATEGORIES)
        .orderBy("month")
    )


def flag_frequency(df: DataFrame, flags: list[str] | None = None) -> DataFrame:
    """Rows per flag, rarest first, with the display title."""
    flags = flags or flag_columns(df)
    sums = df.agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in flags])
    return (
        sums.unpivot([], flags, "flag", "flagged")
        .withColumn("title", text.flag_title("flag"))
        .orderBy("flagged", "flag")
    )


def risk_table(df: DataFrame, flags: list[str] | None = None) -> DataFrame:
    """Columns to show of the contracts of high or medium risk; the first rows only
    when the table has no categories."""
    score = score_column(df)
    columns = [c for c in fixed.TABLE_COLUMNS if c in df.columns] + ([score] if score else [])
    columns += flag_columns(df) if flags is None else flags
    if "risk_category" not in df.columns:
        return df.select(*columns).orderBy(*columns).limit(fixed.TABLE_ROWS)
    return df.where(F.col("risk_category").isin("High", "Medium")).select(*columns)


def with_formatted_sums(df: DataFrame) -> DataFrame:
    """Numeric columns named as sums as text with thousands separators."""
    sums = [
        f.name
        for f in df.schema
        if "sum" in f.name.lower() and isinstance(f.dataType, (T.DoubleType, T.LongType))
    ]
    return df.withColumns({c: text.thousands(c) for c in sums})


def with_row_colour(df: DataFrame, out: str = "row_style") -> DataFrame:
    """Background of a row by its category."""
    return df.withColumn(out, text.row_colour("risk_category"))


def export_high_risk(df: DataFrame, folder: str, day: dt.date) -> str:
    """Stores the formatted risk table as CSV under a date-stamped name."""
    path = f"{folder}/high_risk_contracts_{day:%Y%m%d}.csv"
    return write_csv(with_formatted_sums(risk_table(df)), path)


def top_customers(df: DataFrame, limit: int = fixed.TOP_PARTIES) -> DataFrame:
    """Customers by contract value."""
    return _top(df, "customer_bin", [], limit)


def top_providers(df: DataFrame, limit: int = fixed.TOP_PARTIES) -> DataFrame:
    """Providers by contract value, with their distinct customers."""
    return _top(
        df, "provider_bin", [F.countDistinct("customer_bin").alias("unique_customers")], limit
    )


def market_share(df: DataFrame, limit: int = fixed.TOP_SHARES) -> DataFrame:
    """Providers with most contracts and their percentage of all contracts."""
    total = df.agg(F.count("*")).scalar()
    counted = (
        df.where(F.col("provider_bin").isNotNull())
        .groupBy("provider_bin")
        .agg(F.count("*").alias("contracts"))
        .orderBy(F.desc("contracts"), "provider_bin")
        .limit(limit)
    )
    share = F.round(F.col("contracts") * 1000.0 / total) / 10
    return counted.withColumn("share_percent", share)


def _top(df: DataFrame, party: str, extra: list, limit: int) -> DataFrame:
    return (
        df.where(F.col(party).isNotNull())
        .groupBy(party)
        .agg(
            F.coalesce(total_money("contract_sum"), F.lit(0.0)).alias("total_value"),
            F.count("contract_sum").alias("contract_count"),
            mean_money("contract_sum", 2).alias("avg_value"),
            F.count_if(F.col("risk_category") == "High").alias("high_risk_count"),
            *extra,
        )
        .orderBy(F.desc("total_value"), party)
        .limit(limit)
    )
