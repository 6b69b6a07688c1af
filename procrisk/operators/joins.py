"""Contract -> lot -> plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procrisk import fixed
from procrisk.functions import risk
from procrisk.operators.skew import skew_join
from procrisk.schemas import flat_type


def with_columns_present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds each absent column as a typed NULL."""
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast(flat_type(c)) for c in absent})


def join_contracts(
    contracts: DataFrame,
    lots: DataFrame,
    plans: DataFrame,
    *,
    how: str = "left",
    key: str = "lot_id",
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per contract, matching lot and matching plan: 16 columns.

    Contracts without a key are dropped. ``how="inner"`` keeps complete chains only.
    Plans are joined to lots first, which gives the same rows. Keys are strings since
    typing, so no cast hides them. ``hot_rows``: see ``skew_join``.
    """
    contracts = with_columns_present(contracts, fixed.CONTRACT_COLUMNS)
    lots = with_columns_present(lots, fixed.LOT_COLUMNS)
    plans = with_columns_present(plans, fixed.PLAN_COLUMNS)
    keys = list(dict.fromkeys([key, "lot_id"]))
    lots = lots.select(key, *fixed.LOT_COLUMNS).where(F.col(key).isNotNull())
    plans = plans.select("plan_id", *fixed.PLAN_COLUMNS)
    planned = skew_join(lots, plans, ["plan_id"], how, hot_rows=hot_rows)
    contracts = contracts.select(*dict.fromkeys(keys + fixed.CONTRACT_COLUMNS))
    contracts = contracts.where(F.col(key).isNotNull())
    joined = skew_join(contracts, planned, [key], how, hot_rows=hot_rows)
    return joined.select(*fixed.CONTRACT_COLUMNS, *fixed.LOT_COLUMNS, *fixed.PLAN_COLUMNS)


def join_bucketed(contracts: DataFrame, lots: DataFrame, plans: DataFrame) -> DataFrame:
    """As ``join_contracts`` for tables stored in buckets by lot id
    (``sources.tables.write_buckets``): contracts and lots meet without a shuffle, and the
    result is joined to the plans last. Buckets are never split, so this is for lot ids that
    none owns a large part of the rows of; ``join_contracts`` takes any.
    """
    contracts = with_columns_present(contracts, fixed.CONTRACT_COLUMNS)
    lots = with_columns_present(lots, fixed.LOT_COLUMNS)
    plans = with_columns_present(plans, fixed.PLAN_COLUMNS).select("plan_id", *fixed.PLAN_COLUMNS)
    known = contracts.select(*fixed.CONTRACT_COLUMNS).where(F.col("lot_id").isNotNull())
    lots = lots.select("lot_id", *fixed.LOT_COLUMNS).where(F.col("lot_id").isNotNull())
    joined = skew_join(known.join(lots, "lot_id", "left"), plans, ["plan_id"])
    return joined.select(*fixed.CONTRACT_COLUMNS, *fixed.LOT_COLUMNS, *fixed.PLAN_COLUMNS)


def with_join_columns(joined: DataFrame) -> DataFrame:
    """Price and payment ratio, and the two flags set at join time."""
    return joined.withColumns(
        {
            "price_ratio": risk.ratio("contract_sum", "lot_amount"),
            "payment_ratio": risk.ratio("paid_sum", "contract_sum"),
            "single_bidder_flag": risk.single_source(["order_method_id", "lot_method_id"]),
            "underpaid_flag": risk.paid_less("paid_sum", "contract_sum"),
        }
    )


def procurements(contracts: DataFrame, lots: DataFrame, plans: DataFrame, **options) -> DataFrame:
    """The joined fact table: 20 columns."""
    return with_join_columns(join_contracts(contracts, lots, plans, **options))


def with_fallback_key(
    df: DataFrame, lot_number: str | None, customer: str, amount: str, out: str = "join_key"
) -> DataFrame:
    """``out``: the lot id, or the composite key where there is none."""
    return df.withColumn(out, F.coalesce("lot_id", risk.composite_key(lot_number, customer, amount)))


def normalise_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Join keys as strings."""
    return df.withColumns({key: F.col(key).cast("string") for key in keys})
