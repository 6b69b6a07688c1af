"""All figures of the risk report from one aggregation of the featured table.

``report_sums`` scans the table once. Its rows are sums of three levels: month and category,
customer, and provider with customer. The counts, sums and distinct customers of every
report follow from these, so no report reads the table again, however many are shown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procrisk import fixed
from procrisk.functions import text
from procrisk.functions.types import money
from procrisk.operators.reports import flag_columns
from procrisk.session import stage

TIME, CUSTOMER, PAIR = "time", "customer", "pair"
_KEYS = ["month", "risk_category", "customer_bin", "provider_bin"]


def report_sums(df: DataFrame, flags: list[str] | None = None) -> DataFrame:
    """The stored sums: ``level``, its keys, contracts, exact value and what decimals cannot
    hold, sums that are there, contracts of high risk, and rows per flag."""
    flags = flag_columns(df) if flags is None else flags
    month, category, customer, provider = _KEYS
    value = F.col("contract_sum").cast("double")
    real = ~F.isnan(value)
    rows = df.select(
        F.date_format("lot_start_date", "yyyy-MM").alias(month),
        category,
        customer,
        provider,
        F.when(real, money(value)).alias("__exact"),
        F.when(real & money(value).isNull(), value).alias("__beyond"),
        F.col("contract_sum").isNotNull().cast("int").alias("__priced"),
        F.when(real & value.isNotNull(), 1).alias("__held"),
        (F.col(category) == "High").cast("int").alias("__high"),
        *flags,
    )
    sets = [[month, category], [customer], [provider, customer]]
    level = (
        F.when(F.grouping(customer) == 1, TIME).when(F.grouping(provider) == 1, CUSTOMER).otherwise(PAIR)
    )
    sums = rows.groupingSets([[F.col(k) for k in keys] for keys in sets], *_KEYS).agg(
        level.alias("level"),
        F.count(F.lit(1)).alias("contracts"),
        *[F.sum(f"__{c}").alias(c) for c in ("exact", "beyond", "priced", "held", "high")],
        *[F.sum(f).alias(f) for f in flags],
    )
    return stage(sums.repartition("level"), "report-sums")


def _of(sums: DataFrame, level: str) -> DataFrame:
    return sums.where(F.col("level") == level)


def _value() -> Column:
    exact, beyond = F.sum("exact").cast("double"), F.sum("beyond")
    return F.coalesce(exact + beyond, exact, beyond, F.lit(0.0))


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("long")


def summary_metrics(sums: DataFrame) -> DataFrame:
    """One row: contracts, value, high-risk contracts and share, customers."""
    customers = _of(sums, CUSTOMER).agg(F.count("customer_bin")).scalar()
    high, contracts = _total("high"), _total("contracts")
    return _of(sums, TIME).agg(
        contracts.alias("total_contracts"),
        _value().alias("total_value"),
        high.alias("high_risk"),
        F.round(F.try_divide(high * 100.0, contracts), 6).alias("high_risk_percent"),
    ).withColumn("unique_customers", customers)


def category_distribution(sums: DataFrame) -> DataFrame:
    """Contracts per category; a category without any is 0."""
    counted = _of(sums, TIME).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("risk_category") == c, F.col("contracts"))), F.lit(0)).alias(c)
            for c in fixed.CATEGORIES
        ]
    )
    return counted.unpivot([], fixed.CATEGORIES, "risk_category", "contracts")


def monthly_trend(sums: DataFrame) -> DataFrame:
    """Months by category, absent combinations 0."""
    known = _of(sums, TIME).where(F.col("month").isNotNull() & F.col("risk_category").isNotNull())
    trend = known.groupBy("month").pivot("risk_category", fixed.CATEGORIES).sum("contracts")
    return trend.fillna(0, fixed.CATEGORIES).orderBy("month")


def flag_frequency(sums: DataFrame) -> DataFrame:
    """Rows per flag, rarest first, with the display title."""
    flags = flag_columns(sums)
    counted = _of(sums, TIME).agg(*[_total(f).alias(f) for f in flags])
    return (
        counted.unpivot([], flags, "flag", "flagged")
        .withColumn("title", text.flag_title("flag"))
        .orderBy("flagged", "flag")
    )


def top_customers(sums: DataFrame, limit: int = fixed.TOP_PARTIES) -> DataFrame:
    """Customers by contract value."""
    return _top(_of(sums, CUSTOMER), "customer_bin", [], limit)


def top_providers(sums: DataFrame, limit: int = fixed.TOP_PARTIES) -> DataFrame:
    """Providers by contract value, with their distinct customers."""
    customers = F.count("customer_bin").alias("unique_customers")  # a row per pair
    return _top(_of(sums, PAIR), "provider_bin", [customers], limit)


def market_share(sums: DataFrame, limit: int = fixed.TOP_SHARES) -> DataFrame:
    """Providers with most contracts and their percentage of all contracts."""
    total = _of(sums, TIME).agg(F.sum("contracts")).scalar()
    counted = (
        _of(sums, PAIR).where(F.col("provider_bin").isNotNull())
        .groupBy("provider_bin")
        .agg(F.sum("contracts").alias("contracts"))
        .orderBy(F.desc("contracts"), "provider_bin")
        .limit(limit)
    )
    return counted.withColumn("share_percent", F.round(F.col("contracts") * 1000.0 / total) / 10)


#: The seven reports by name; each takes the sums.
REPORTS = {
    f.__name__: f
    for f in (
        summary_metrics, category_distribution, monthly_trend, flag_frequency, top_customers,
        top_providers, market_share,
    )
}


def all_reports(sums: DataFrame) -> DataFrame:
    """Every report in one table: its name, the row's key, the measure and its value."""
    keys = {
        "category_distribution": "risk_category", "monthly_trend": "month", "flag_frequency": "flag",
        "top_customers": "customer_bin", "top_providers": "provider_bin", "market_share": "provider_bin",
    }
    parts = []
    for name, report in REPORTS.items():
        found, key = report(sums), keys.get(name)
        measures = [c for c in found.columns if c not in (key, "title")]
        shown = F.col(key) if key else F.lit("")
        wide = found.select(shown.alias("key"), *[F.col(c).cast("double").alias(c) for c in measures])
        parts.append(wide.unpivot("key", measures, "measure", "value").withColumn("report", F.lit(name)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _top(rows: DataFrame, party: str, extra: list[Column], limit: int) -> DataFrame:
    return (
        rows.where(F.col(party).isNotNull())
        .groupBy(party)
        .agg(
            _value().alias("total_value"),
            _total("priced").alias("contract_count"),
            F.round(F.try_divide(_value(), F.sum("held")), 2).alias("avg_value"),
            _total("high").alias("high_risk_count"),
            *extra,
        )
        .orderBy(F.desc("total_value"), party)
        .limit(limit)
    )
