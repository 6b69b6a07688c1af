"""Joins and group look-ups that hold when one key owns a large part of the rows.

A key that is frequent on one side is left to adaptive execution, which splits its
partition while the join runs. Rows without a key match nothing and are spread over all
partitions. Only a key frequent on both sides may need more, because an outer join splits
its left side alone; callers that expect such keys say from how many rows on.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procrisk.functions.logic import any_of
from procrisk.session import stage

# Largest group table that is broadcast, by the measured size of its values.
BROADCAST_BYTES = 32 << 20

_SPREAD, _LEFT, _RIGHT = "__spread", "__left_fan", "__right_fan"


def running_total(value: str, within: list[str], order: list[str]) -> Column:
    """Running sum over rows in key order, current row included."""
    window = Window.partitionBy(*within).orderBy(*order)
    return F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def attach(
    df: DataFrame,
    groups: DataFrame,
    on: list[str],
    how: str = "left",
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``df`` joined with ``groups``, a staged table with one row per key.

    Groups of up to ``broadcast_bytes`` are broadcast and ``df`` is not shuffled at
    all; more go through ``skew_join``.
    """
    if size_of(groups) <= broadcast_bytes:
        return df.join(F.broadcast(groups), on, how)
    return skew_join(df, groups, on, how)


def size_of(df: DataFrame) -> int:
    """Bytes of the values of a stored table, from one scan."""
    widths = [_width(field) for field in df.schema]
    return df.agg(F.sum(reduce(add, widths))).first()[0] or 0


def _width(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(F.size(value), F.lit(0)) * 8 + 16
    return F.lit(8)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    *,
    hot_rows: int | None = None,
) -> DataFrame:
    """Equi-join (``left``, ``inner``, ``left_semi``, ``left_anti``) with hot keys.

    Without ``hot_rows`` nothing is counted beforehand. With it, keys of more rows than
    that on both sides are found by counting both, stored, and joined apart: each side is
    dealt to salts and repeated for those of the other.
    """
    if how in ("left_semi", "left_anti"):
        return _spread(left, right.select(*on).distinct(), on, how)
    if hot_rows is None:
        return _spread(left, right, on, how)
    hot = stage(_hot(left, right, on, hot_rows), "hot-keys")
    if hot.isEmpty():
        return _spread(left, right, on, how)
    keys = hot.select(*on)
    rest = _spread(
        attach(left, keys, on, "left_anti"), attach(right, keys, on, "left_anti"), on, how
    )
    # These keys have rows on both sides, so an inner join loses none.
    a = _dealt(attach(left, hot, on, "inner"), _LEFT, _RIGHT)
    b = _dealt(attach(right, hot, on, "inner"), _RIGHT, _LEFT)
    salts = [f"{_LEFT}_salt", f"{_RIGHT}_salt"]
    heavy = a.join(b, [*on, *salts], "inner").drop(*salts)
    return rest.unionByName(heavy)


def _spread(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """The join, with rows of no key dealt to all partitions by their other values."""
    if how == "inner" or not any(left.schema[key].nullable for key in on):
        return left.join(right, on, how)
    no_key = any_of([F.col(key).isNull() for key in on])
    left = left.withColumn(_SPREAD, F.when(no_key, _row_hash(left)).otherwise(F.lit(0)))
    right = right.dropna(subset=on).withColumn(_SPREAD, F.lit(0).cast("long"))
    return left.join(right, [*on, _SPREAD], how).drop(_SPREAD)


def _hot(left: DataFrame, right: DataFrame, on: list[str], hot_rows: int) -> DataFrame:
    """Keys of more than ``hot_rows`` rows on both sides, and the salts each side gets."""

    def heavy(df: DataFrame, fan: str) -> DataFrame:
        sizes = df.dropna(subset=on).groupBy(*on).agg(F.count("*").alias("__rows"))
        found = sizes.where(F.col("__rows") > hot_rows)
        return found.select(*on, F.ceil(F.col("__rows") / hot_rows).cast("int").alias(fan))

    return heavy(left, _LEFT).join(heavy(right, _RIGHT), on)


def _dealt(df: DataFrame, own: str, other: str) -> DataFrame:
    """Each row to one salt of its own side, repeated for every salt of the other. A row's
    salt depends on its values and input partition alone, so a repeated task repeats it."""
    salt = F.pmod(F.xxhash64(_row_hash(df), F.spark_partition_id()), F.col(own)).cast("int")
    return (
        df.withColumn(f"{own}_salt", salt)
        .withColumn(f"{other}_salt", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        .drop(own, other)
    )


def _row_hash(df: DataFrame) -> Column:
    hashed = [
        F.col(f"`{field.name}`")
        for field in df.schema
        if not isinstance(field.dataType, (T.MapType, T.VariantType))
    ]
    return F.xxhash64(*hashed)
