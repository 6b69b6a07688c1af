"""Quantiles per group: exact for groups of any size, or from mergeable sketches.

``group_quantile`` and ``group_median_mad`` reduce the rows to counted values in one scan and
store these. Groups of up to ``hot_rows`` different values use the built-in exact percentile.
Larger ones are narrowed together: a sketch of a group's values cuts it into slices, one
aggregation counts the rows of each, and only the slices that hold the wanted ranks are kept
and stored, until they are small. Every round leaves about a thirtieth, reads what the round
before stored, and shuffles slice counts only.

``column_quantiles`` brackets the rank of every column by a quantile sketch in one scan of
the source; a second one counts the rows below each bracket and keeps its values. A sketch
that misses its rank is seen by the counts, and that column's bracket is opened wide.

``sketch_median_mad`` stores a mergeable sketch per group instead, with a stated rank error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from procrisk.operators.skew import BROADCAST_BYTES, attach, running_total, size_of
from procrisk.session import stage

# Largest number of different values of a group that one task may hold.
HOT_ROWS = 250_000
# Slices of a round, and the accuracy of the sketches that cut them or bracket a rank.
SLICES, ACCURACY = 64, 10_000
# Size of a stored sketch, and its rank error as a share of the group's rows.
SKETCH_K = 800

_VALUE, _COUNT, _ROWS = "__value", "__count", "__rows"
_LOW, _HIGH, _UPTO, _SLICE = "__low_rank", "__high_rank", "__upto", "__slice"
_FIRST, _LAST = "__first", "__last"


def group_quantile(
    df: DataFrame,
    keys: list[str],
    value: str,
    q: float = 0.5,
    *,
    name: str = "quantile",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``keys``, ``n`` (values that are not NULL or NaN) and the linear ``q`` quantile."""
    points = stage(_points(df, keys, value), "group-values")
    hot = _hot(points, keys, hot_rows)

    def direct(part: DataFrame) -> DataFrame:
        return part.groupBy(*keys).agg(
            F.sum(_COUNT).alias("n"), F.percentile(_VALUE, q, F.col(_COUNT)).alias(name)
        )

    if hot is None:
        return direct(points)
    groups = hot.groups
    many = _narrow(_of(points, groups, keys), groups, keys, q, hot_rows, hot.held).select(
        *keys, F.col(_ROWS).alias("n"), F.col(_VALUE).alias(name)
    )
    return direct(_not_of(points, groups, keys)).unionByName(many)


def group_median_mad(
    df: DataFrame,
    keys: list[str],
    value: str,
    *,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``keys``, ``n``, ``median`` and ``mad`` (median absolute deviation) per group."""
    points = stage(_points(df, keys, value), "group-values")
    hot = _hot(points, keys, hot_rows)

    def direct(part: DataFrame) -> DataFrame:
        # Window and aggregation share their partitioning: one shuffle for both.
        return (
            part.withColumn(
                "median",
                F.percentile(_VALUE, 0.5, F.col(_COUNT)).over(Window.partitionBy(*keys)),
            )
            .withColumn("__off", F.abs(F.col(_VALUE) - F.col("median")))
            .groupBy(*keys)
            .agg(
                F.sum(_COUNT).alias("n"),
                F.min("median").alias("median"),
                F.percentile("__off", 0.5, F.col(_COUNT)).alias("mad"),
            )
        )

    if hot is None:
        return direct(points)
    groups, held = hot.groups, hot.held
    large = _of(points, groups, keys)
    centre = stage(
        _narrow(large, groups, keys, 0.5, hot_rows, held).select(*keys, F.col(_VALUE).alias("median")),
        "hot-medians",
    )
    centre = F.broadcast(centre) if held <= BROADCAST_BYTES else centre
    off = large.join(centre, keys).withColumn(_VALUE, F.abs(F.col(_VALUE) - F.col("median")))
    # Two values may be equally far: the first round of narrowing, not all rows, adds them up.
    spread = _narrow(off, groups, keys, 0.5, hot_rows, held).withColumnsRenamed({_ROWS: "n", _VALUE: "mad"})
    many = spread.join(centre, keys).select(*keys, "n", "median", "mad")
    return direct(_not_of(points, groups, keys)).unionByName(many)


def column_quantiles(
    df: DataFrame,
    columns: list[str],
    q: float = 0.5,
    *,
    name: str = "quantile",
    hot_rows: int = HOT_ROWS,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per column with values: ``feature``, ``n`` and its quantile over the whole
    table, in two scans of ``df`` for any number of columns."""
    clean = df.select(*[_clean(c).alias(c) for c in columns])
    ends = F.array(*[F.lit(min(max(q + side * 2 / accuracy, 0.0), 1.0)) for side in (-1, 1)])
    sketched = clean.agg(
        *[
            F.struct(F.count(c).alias("n"), F.percentile_approx(c, ends, accuracy).alias("ends")).alias(c)
            for c in columns
        ]
    ).first()
    rows = {c: sketched[c]["n"] for c in columns if sketched[c]["n"]}
    if not rows:
        return df.sparkSession.createDataFrame([], f"feature string, n long, {name} double")
    brackets = {c: tuple(sketched[c]["ends"]) for c in rows}
    ranks = {c: _ranks(n, q) for c, n in rows.items()}
    inside, below = _bracketed(clean, brackets)
    missed = [
        c for c in rows
        if not below[c][0] <= ranks[c][0] or not ranks[c][1] < below[c][0] + below[c][1]
    ]
    if missed:
        wide = (-float("inf"), float("inf"))
        inside, below = _bracketed(clean, brackets | dict.fromkeys(missed, wide))
    spark = df.sparkSession
    wanted = spark.createDataFrame(
        [(c, rows[c], ranks[c][0] - below[c][0], ranks[c][1] - below[c][0], ranks[c][2]) for c in rows],
        f"feature string, n long, {_LOW} long, {_HIGH} long, __share double",
    )
    largest = max(values for *_, values in below.values())
    found = _pick(inside, wanted.select("feature", _LOW, _HIGH), ["feature"], hot_rows, largest, True)
    return found.join(F.broadcast(wanted), "feature").select(
        "feature", "n", _between(F.col("__share")).alias(name)
    )


def sketch_median_mad(
    df: DataFrame, keys: list[str], value: str, *, k: int = SKETCH_K, **options
) -> DataFrame:
    """As ``group_median_mad``, but from a sketch per group and a second one of the distances
    from its median. Both are values of the data whose ranks are off by at most
    ``sketch_error(k)`` of the group's rows, in all but one case of a hundred."""
    usable = df.select(*keys, _clean(value).alias(_VALUE)).dropna()
    first = stage(
        usable.groupBy(*keys).agg(F.kll_sketch_agg_double(_VALUE, F.lit(k)).alias("sketch")),
        "value-sketches",
    )
    centre = stage(
        first.select(
            *keys,
            F.kll_sketch_get_n_double("sketch").alias("n"),
            F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("median"),
        ),
        "sketched-medians",
    )
    off = attach(usable, centre, keys, "inner", **options)
    off = off.withColumn(_VALUE, F.abs(F.col(_VALUE) - F.col("median")))
    second = off.groupBy(*keys).agg(
        F.first("n").alias("n"),
        F.first("median").alias("median"),
        F.kll_sketch_agg_double(_VALUE, F.lit(k)).alias("sketch"),
    )
    mad = F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("mad")
    return second.select(*keys, "n", "median", mad)


def sketch_error(k: int = SKETCH_K) -> float:
    """Rank error of a sketch of size ``k`` (published fit of the KLL sketch, 99 of 100)."""
    return 2.296 / k**0.9021


def _ranks(n: int, q: float) -> tuple[int, int, float]:
    """The two ranks (from 0) between which the quantile lies, and the share of the second."""
    place = (n - 1) * q
    low = int(place)
    return low, min(low + (place > low), n - 1), place - low


def _clean(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _points(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    rows = df.select(*keys, _clean(value).alias(_VALUE)).dropna()
    return rows.groupBy(*keys, _VALUE).agg(F.count("*").alias(_COUNT))


@dataclass(frozen=True)
class _Hot:
    """Large groups with their rows, a stored table marked for broadcast while it is small, and
    the bytes of a table with ``SLICES`` numbers for each."""

    groups: DataFrame
    held: int


def _hot(points: DataFrame, keys: list[str], hot_rows: int) -> _Hot | None:
    """All groups of more than ``hot_rows`` values, with their rows, stored; None without any."""
    sizes = points.groupBy(*keys).agg(F.sum(_COUNT).alias(_ROWS), F.count("*").alias("__values"))
    found = stage(sizes.where(F.col("__values") > hot_rows).drop("__values"), "large-groups")
    held = size_of(found) * SLICES  # as large as the widest table of a row per group
    if not held:
        return None
    return _Hot(F.broadcast(found) if held <= BROADCAST_BYTES else found, held)


def _of(points: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    return points.join(hot.select(*keys), keys)


def _not_of(points: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    return points.join(hot.select(*keys), keys, "left_anti")


def _narrow(
    points: DataFrame, hot: DataFrame, keys: list[str], q: float, hot_rows: int, groups_bytes: int
) -> DataFrame:
    """``keys``, rows and ``q`` quantile of each group in ``hot``, from its counted values."""
    place = (F.col(_ROWS) - 1) * F.lit(q)
    ranked = hot.select(*keys, F.floor(place).alias(_LOW), F.ceil(place).alias(_HIGH))
    small = groups_bytes <= BROADCAST_BYTES
    found = _pick(points, ranked, keys, hot_rows, hot_rows + 3, small)
    return found.join(hot, keys).select(*keys, _ROWS, _between(place - F.floor(place)).alias(_VALUE))


def _between(share: Column) -> Column:
    """Linear interpolation of the values at both ranks."""
    low, high = F.col(_FIRST), F.col(_LAST)
    return F.when(low == high, low).otherwise((1 - share) * low + share * high)


def _pick(
    points: DataFrame, ranked: DataFrame, keys: list[str], hot_rows: int, largest: int, small: bool
) -> DataFrame:
    """``keys`` and the values at the two ranks of each group in ``ranked``, from counted
    points, which may name a value of a group again. ``largest`` is the most points of a group,
    ``small`` whether a table of some numbers per group may be broadcast."""
    part = points.select(*keys, _VALUE, _COUNT)
    cuts = F.array(*[F.lit(k / SLICES) for k in range(1, SLICES)])

    def by_group(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if small else table

    while largest > max(hot_rows, 2):
        sketched = part.groupBy(*keys).agg(F.percentile_approx(_VALUE, cuts, 1_000).alias("__cuts"))
        below = F.filter("__cuts", lambda cut: cut < F.col(_VALUE))
        sliced = part.join(by_group(stage(sketched, "value-slices")), keys)
        sliced = sliced.withColumn(_SLICE, F.size(below))
        counts = (
            sliced.groupBy(*keys, _SLICE)
            .agg(F.sum(_COUNT).alias(_COUNT), F.count("*").alias("__values"))
            .withColumn(_UPTO, running_total(_COUNT, keys, [_SLICE]))
            .join(by_group(ranked), keys)
        )
        before = F.col(_UPTO) - F.col(_COUNT)
        kept = counts.where((F.col(_HIGH) >= before) & (F.col(_LOW) < F.col(_UPTO)))
        kept = stage(
            kept.groupBy(*keys).agg(
                F.min(_SLICE).alias("__from"), F.max(_SLICE).alias("__to"),
                F.min(F.col(_LOW)).alias(_LOW), F.min(F.col(_HIGH)).alias(_HIGH),
                F.min(before).alias("__before"), F.sum("__values").alias("__values"),
            ),
            "kept-slices",
        )
        inner = sliced.join(by_group(kept.select(*keys, "__from", "__to")), keys).where(
            F.col(_SLICE).between(F.col("__from"), F.col("__to"))
        )
        part = stage(inner.groupBy(*keys, _VALUE).agg(F.sum(_COUNT).alias(_COUNT)), "kept-values")
        ranked = kept.select(
            *keys,
            (F.col(_LOW) - F.col("__before")).alias(_LOW),
            (F.col(_HIGH) - F.col("__before")).alias(_HIGH),
        )
        largest = kept.agg(F.max("__values")).first()[0] or 0
    placed = part.withColumn(_UPTO, running_total(_COUNT, keys, [_VALUE])).join(by_group(ranked), keys)
    return placed.groupBy(*keys).agg(
        F.min(F.when(F.col(_UPTO) > F.col(_LOW), F.col(_VALUE))).alias(_FIRST),
        F.min(F.when(F.col(_UPTO) > F.col(_HIGH), F.col(_VALUE))).alias(_LAST),
    )


def _bracketed(
    clean: DataFrame, brackets: dict[str, tuple[float, float]]
) -> tuple[DataFrame, dict[str, tuple[int, int, int]]]:
    """The counted values inside each column's bracket, and per column the rows below and
    inside it and the different values inside, in one scan."""
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            (F.col(c) < low).alias("below"),
            F.when(F.col(c) >= low, F.col(c)).alias(_VALUE),
            (F.col(c) <= high).alias("near"),
        )
        for c, (low, high) in brackets.items()
    ]
    counted = stage(
        clean.select(F.inline(F.array(*cells))).where("near")
        .groupBy("feature", "below", _VALUE).agg(F.count("*").alias(_COUNT)),
        "bracket-values",
    )
    sums = counted.groupBy("feature").agg(
        F.coalesce(F.sum(F.when(F.col("below"), F.col(_COUNT))), F.lit(0)).alias("b"),
        F.coalesce(F.sum(F.when(~F.col("below"), F.col(_COUNT))), F.lit(0)).alias("i"),
        F.count_if(~F.col("below")).alias("v"),
    )
    found = {r["feature"]: (r["b"], r["i"], r["v"]) for r in sums.collect()}  # one row per column
    return counted.where(~F.col("below")).drop("below"), {c: found.get(c, (0, 0, 0)) for c in brackets}
