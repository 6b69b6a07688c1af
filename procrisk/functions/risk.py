"""Ratios, flags, scores and categories of one contract row."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from procrisk import fixed
from procrisk.functions.logic import any_of
from procrisk.functions.time import DAY, micros_between, start_of_slice


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def ratio(part: str, whole: str) -> Column:
    """``part / whole``, NULL when either is NULL or the whole is 0."""
    return F.try_divide(F.col(part), F.col(whole))


def single_source(
    method_cols: list[str],
    bidders_col: str | None = None,
    method: int = fixed.SINGLE_SOURCE_METHOD,
) -> Column:
    """A method column names single-source procurement, or there was one bidder."""
    tests = [F.col(c) == method for c in method_cols]
    if bidders_col:
        tests.append(F.col(bidders_col) == 1)
    return flag(any_of([F.coalesce(t, F.lit(False)) for t in tests]))


def paid_less(paid: str, amount: str, share: float = fixed.PAID_SHARE_LIMIT) -> Column:
    """Paid below ``share`` of the contract sum, whatever the sign of the sum."""
    return flag(F.col(paid) < F.lit(share) * F.col(amount))


def underpaid(paid: str, amount: str, share: float = fixed.PAID_SHARE_LIMIT) -> Column:
    """``paid_less`` for positive contract sums only."""
    return flag((F.col(amount) > 0) & (F.col(paid) < F.lit(share) * F.col(amount)))


def weighted_score(weights: dict[str, float]) -> Column:
    """Weighted sum of flags; a NULL flag counts 0."""
    return reduce(add, [F.coalesce(F.col(f), F.lit(0)) * F.lit(w) for f, w in weights.items()])


def category(score: str) -> Column:
    """Low up to 1, Medium above 1 up to 3, High above 3; NULL stays NULL."""
    low, medium, high = fixed.CATEGORIES
    return (
        F.when(F.col(score) <= fixed.MEDIUM_FROM, low)
        .when(F.col(score) <= fixed.HIGH_FROM, medium)
        .when(F.col(score).isNotNull(), high)
    )


def category_rank(column: str) -> Column:
    """Order of a category: 0 Low, 1 Medium, 2 High."""
    return (F.array_position(F.lit(fixed.CATEGORIES), F.col(column)) - 1).cast("int")


def traffic_light(score: str) -> Column:
    """red from 3, yellow from 1, green otherwise."""
    return (
        F.when(F.col(score) >= fixed.HIGH_FROM, "red")
        .when(F.col(score) >= fixed.MEDIUM_FROM, "yellow")
        .otherwise("green")
    )


def composite_key(lot_number: str | None, customer: str, amount: str) -> Column:
    """Fallback identity of a row without a lot id: the first 16 hex digits of the
    SHA-256 of number, customer and whole amount (half to even). NULL without customer
    or amount, or all such rows would be one."""
    whole = F.bround(F.col(amount), 0).try_cast("bigint").cast("string")
    number = F.coalesce(F.col(lot_number), F.lit("")) if lot_number else F.lit("")
    key = F.substring(F.sha2(F.concat_ws("|", number, F.col(customer), whole), 256), 1, 16)
    return F.when(F.col(customer).isNotNull() & whole.isNotNull(), key)


def whole_days(start: str, end: str) -> Column:
    """Whole days from start to end, rounded down; NULL when either is NULL."""
    micros = micros_between(F.col(start), F.col(end))
    return F.round(start_of_slice(micros, DAY) / DAY).cast("int")
