"""Red flags, risk score and calendar features of contracts.

Detectors that compare a row with its group work in two steps: a statistics table with
one row per group, from partial aggregates, written to the shared folder; then a
look-up per row (``skew.attach``). Neither step holds the rows of a group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from procrisk import fixed
from procrisk.functions import risk
from procrisk.functions.logic import all_of
from procrisk.functions.time import DAY, micros_between, micros_of, start_of_slice
from procrisk.operators.quantiles import HOT_ROWS, SKETCH_K, group_median_mad, sketch_median_mad
from procrisk.operators.skew import BROADCAST_BYTES, attach, skew_join
from procrisk.session import at_once, stage


def with_calendar(df: DataFrame, date_col: str = "lot_start_date") -> DataFrame:
    """Year, month, quarter, weekday (Monday is 0) and fiscal year (the calendar year)."""
    date = F.col(date_col)
    return df.withColumns(
        {
            "year": F.year(date),
            "month": F.month(date),
            "quarter": F.quarter(date),
            "day_of_week": F.weekday(date),
            "fiscal_year": F.year(date),
        }
    )


def with_processing_days(
    df: DataFrame, start: str = "lot_start_date", end: str = "accept_date"
) -> DataFrame:
    """Whole days from lot start to acceptance."""
    return df.withColumn("processing_days", risk.whole_days(start, end))


def price_statistics(
    df: DataFrame,
    title: str = "title_ru",
    price: str = "contract_sum",
    *,
    exact: bool = True,
    hot_rows: int = HOT_ROWS,
    sketch_k: int = SKETCH_K,
) -> DataFrame:
    """Titles with a usable robust scale: ``title``, ``n``, ``median``, ``mad``.

    ``exact=False`` takes them from mergeable sketches of ``sketch_k`` values per title, with
    a rank error of ``quantiles.sketch_error(sketch_k)``.
    """
    if exact:
        stats = group_median_mad(df, [title], price, hot_rows=hot_rows)
    else:
        stats = sketch_median_mad(df, [title], price, k=sketch_k)
    usable = (F.col("n") >= fixed.MIN_PRICES) & (F.col("mad") > 0)
    return stage(stats.where(usable), "price-statistics")


def with_price_z(
    df: DataFrame,
    title: str = "title_ru",
    price: str = "contract_sum",
    stats: DataFrame | None = None,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Robust z-score of the price among rows of the same title, 0 where there is none."""
    if stats is None:
        stats = price_statistics(df, title, price)
    centre = stats.select(title, F.col("median").alias("__median"), F.col("mad").alias("__mad"))
    z = F.lit(fixed.MAD_SCALE) * (F.col(price) - F.col("__median")) / F.col("__mad")
    return (
        attach(df, centre, [title], broadcast_bytes=broadcast_bytes)
        .withColumn("price_z", F.coalesce(z, F.lit(0.0)))
        .drop("__median", "__mad")
    )


def with_price_flag(df: DataFrame, limit: float = fixed.PRICE_Z_LIMIT) -> DataFrame:
    """``price_z`` above the limit."""
    return df.withColumn("price_flag", risk.flag(F.col("price_z") > limit))


def with_single_flag(
    df: DataFrame,
    method_cols: tuple[str, ...] = ("order_method_id", "lot_method_id"),
    bidders_col: str | None = None,
) -> DataFrame:
    """Single-source procurement by method; optionally also one bidder."""
    return df.withColumn("single_flag", risk.single_source(list(method_cols), bidders_col))


def repeat_pairs(
    df: DataFrame,
    customer: str = "customer_bin",
    provider: str = "provider_bin",
    *,
    min_contracts: int = fixed.MIN_CONTRACTS,
    min_share: float = fixed.WIN_SHARE_LIMIT,
    min_on: str = "customer",
) -> DataFrame:
    """(customer, provider) pairs in which the provider wins too large a share.

    ``min_on`` says whose rows must reach ``min_contracts``: the customer's (rows
    without a provider included) or the pair's.
    """
    pairs = df.where(F.col(customer).isNotNull()).groupBy(customer, provider).agg(
        F.count("*").alias("__wins")
    )
    if min_share >= 0.5:
        # Only the largest pair of a customer can exceed half: no join needed.
        named = F.col(provider).isNotNull()
        best = F.max(F.when(named, F.struct("__wins", provider))).alias("__best")
        pairs = (
            pairs.groupBy(customer)
            .agg(F.sum("__wins").alias("__total"), best)
            .select(customer, "__total", "__best.*")
        )
    else:
        pairs = stage(pairs, "pairs")
        totals = pairs.groupBy(customer).agg(F.sum("__wins").alias("__total"))
        pairs = skew_join(pairs, totals, [customer], "inner")
    counted = F.col("__total") if min_on == "customer" else F.col("__wins")
    suspicious = (counted >= min_contracts) & (F.col("__wins") / F.col("__total") > min_share)
    named = F.col(provider).isNotNull()
    return stage(pairs.where(named & suspicious).select(customer, provider), "repeat-pairs")


def with_repeat_flag(
    df: DataFrame,
    customer: str = "customer_bin",
    provider: str = "provider_bin",
    pairs: DataFrame | None = None,
    *,
    min_contracts: int = fixed.MIN_CONTRACTS,
    min_share: float = fixed.WIN_SHARE_LIMIT,
    min_on: str = "customer",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of a provider that wins most contracts of the customer."""
    if pairs is None:
        pairs = repeat_pairs(
            df, customer, provider, min_contracts=min_contracts, min_share=min_share, min_on=min_on
        )
    keys = [customer, provider]
    return _with_membership(df, pairs, keys, "repeat_flag", F.lit(True), broadcast_bytes)


def split_groups(
    df: DataFrame,
    customer: str = "customer_bin",
    title: str = "title_ru",
    amount: str = "contract_sum",
    date: str = "lot_start_date",
    *,
    limit: float = fixed.SMALL_CONTRACT,
    min_rows: int = fixed.SPLIT_MIN_ROWS,
    days: float = fixed.SPLIT_DAYS,
) -> DataFrame:
    """(customer, title) groups whose small contracts all start within ``days``."""
    span = micros_between(F.col("__first"), F.col("__last"))
    groups = (
        _small(df, customer, title, amount, limit)
        .groupBy(customer, title)
        .agg(
            F.count(date).alias("__dated"),
            F.min(date).alias("__first"),
            F.max(date).alias("__last"),
        )
        .where((F.col("__dated") >= min_rows) & (span <= int(days * DAY)))
    )
    return stage(groups.select(customer, title), "split-groups")


def with_split_flag(
    df: DataFrame,
    customer: str = "customer_bin",
    title: str = "title_ru",
    amount: str = "contract_sum",
    date: str = "lot_start_date",
    groups: DataFrame | None = None,
    *,
    limit: float = fixed.SMALL_CONTRACT,
    min_rows: int = fixed.SPLIT_MIN_ROWS,
    days: float = fixed.SPLIT_DAYS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Small contracts of such a group, undated ones included."""
    if groups is None:
        groups = split_groups(
            df, customer, title, amount, date, limit=limit, min_rows=min_rows, days=days
        )
    is_small = F.col(amount) <= limit
    return _with_membership(df, groups, [customer, title], "split_flag", is_small, broadcast_bytes)


def sliding_split_slices(
    df: DataFrame,
    customer: str = "customer_bin",
    title: str = "title_ru",
    amount: str = "contract_sum",
    date: str = "lot_start_date",
    *,
    limit: float = fixed.SMALL_CONTRACT,
    min_rows: int = fixed.SPLIT_MIN_ROWS,
    days: float = fixed.SPLIT_DAYS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Where some ``min_rows`` small contracts start within any ``days``.

    Time is cut into slices as long as the window, and counted per slice. A slice with
    ``min_rows`` contracts is flagged as a whole (``__full``). Another is judged only if
    it and its two neighbours have ``min_rows`` together, and then it is enough to know
    the ``min_rows - 1`` latest contracts of the slice before and the earliest of the
    one after, because a window over a border reaches no further. So the rows compared
    in order are at most ``2 * (min_rows - 1)`` per slice, however many contracts a
    customer has. Returns group, slice, ``__full`` and the flagged moments of the rest.
    """
    keys, width, edge = [customer, title], int(days * DAY), min_rows - 1
    slice_keys = [*keys, "__slice"]
    moments = (
        _small(df, customer, title, amount, limit)
        .where(F.col(date).isNotNull())
        .select(*keys, micros_of(F.col(date)).alias("__at"))
        .withColumn("__slice", start_of_slice(F.col("__at"), width))
    )
    slices = moments.groupBy(*slice_keys).agg(F.count("*").alias("__n"))
    slices = stage(_slices_to_judge(slices, keys, width, min_rows), "slice-counts")
    full = slices.where(F.col("__n") >= min_rows).select(
        *slice_keys, F.lit(True).alias("__full"), F.lit(None).cast("array<bigint>").alias("__moments")
    )
    if edge < 1:
        return stage(full, "split-slices")
    needed = slices.where("__needed").select(*slice_keys, "__n")
    near = attach(moments, needed, slice_keys, "inner", broadcast_bytes=broadcast_bytes)
    sparse = near.where(F.col("__n") < min_rows).withColumn("__end", F.lit(0))
    crowded = near.where(F.col("__n") >= min_rows)
    # Spark cuts both rankings to their first rows before the shuffle.
    in_slice = Window.partitionBy(*slice_keys)
    first, last = (
        crowded.withColumn("__rank", F.row_number().over(in_slice.orderBy(order)))
        .where(F.col("__rank") <= edge)
        .drop("__rank")
        .withColumn("__end", F.lit(end))
        for end, order in ((1, F.col("__at").asc()), (2, F.col("__at").desc()))
    )
    # A contract may be among the first and the last of its slice: keep one copy.
    copies = [F.count_if(F.col("__end") == end) for end in (0, 1, 2)]
    edges = (
        sparse.unionByName(first)
        .unionByName(last)
        .groupBy(*slice_keys, "__at")
        .agg(F.greatest(*copies).alias("__copies"), (copies[0] > 0).alias("__sparse"))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    )
    in_order = Window.partitionBy(*keys).orderBy("__at", "__copy")
    spans = [
        F.lead("__at", after).over(in_order) - F.lag("__at", edge - after).over(in_order)
        for after in range(edge + 1)
    ]
    close = F.lit(False)
    for span in spans:
        close = close | F.coalesce(span <= width, F.lit(False))
    flagged = (
        edges.withColumn("__close", close)
        .where("__close and __sparse")
        .groupBy(*slice_keys)
        .agg(F.collect_set("__at").alias("__moments"))
        .select(*slice_keys, F.lit(False).alias("__full"), "__moments")
    )
    return stage(full.unionByName(flagged), "split-slices")


def with_sliding_split_flag(
    df: DataFrame,
    customer: str = "customer_bin",
    title: str = "title_ru",
    amount: str = "contract_sum",
    date: str = "lot_start_date",
    *,
    limit: float = fixed.SMALL_CONTRACT,
    min_rows: int = fixed.SPLIT_MIN_ROWS,
    days: float = fixed.SPLIT_DAYS,
    out: str = "split_flag",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Small contracts that lie in a window of ``days`` with at least ``min_rows``."""
    slices = sliding_split_slices(
        df, customer, title, amount, date, limit=limit, min_rows=min_rows, days=days,
        broadcast_bytes=broadcast_bytes,
    )
    width = int(days * DAY)
    sliced = df.withColumn("__slice", start_of_slice(micros_of(F.col(date)), width))
    hit = F.col("__full") | F.array_contains("__moments", micros_of(F.col(date)))
    return (
        attach(sliced, slices, [customer, title, "__slice"], broadcast_bytes=broadcast_bytes)
        .withColumn(out, risk.flag((F.col(amount) <= limit) & hit))
        .select(*df.columns, out)
    )


def with_underpaid_flag(
    df: DataFrame, paid: str = "paid_sum", amount: str = "contract_sum"
) -> DataFrame:
    """Paid less than 90 % of a positive contract sum."""
    return df.withColumn("underpaid_flag", risk.underpaid(paid, amount))


def with_risk_score(df: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Weighted sum of the flags."""
    return df.withColumn("risk_score", risk.weighted_score(weights or fixed.RISK_WEIGHTS))


def with_composite_key(
    df: DataFrame,
    lot_number: str | None = None,
    customer: str = "customer_bin",
    amount: str = "contract_sum",
) -> DataFrame:
    """Fallback key of rows without a lot id; empty text for the others."""
    key = F.when(F.col("lot_id").isNull(), risk.composite_key(lot_number, customer, amount))
    return df.withColumn("composite_key", F.coalesce(key, F.lit("")))


def engineer_features(
    df: DataFrame,
    *,
    split_limit: float = fixed.SMALL_CONTRACT,
    split_days: float = fixed.SPLIT_DAYS,
) -> DataFrame:
    """All features of the joined table, in the order of the featured table.

    Pass a stored table: it is read once per statistics table, which are built at the same
    time, and once for the rows.
    """
    split = {"limit": split_limit, "days": split_days}
    built = at_once(
        {
            "prices": lambda: price_statistics(df),
            "pairs": lambda: repeat_pairs(df),
            "groups": lambda: split_groups(df, **split),
        }
    )
    for result in built.values():
        if isinstance(result, Exception):
            raise result
    stats, pairs, groups = built.values()
    df = with_processing_days(with_calendar(df))
    df = with_price_flag(with_price_z(df, stats=stats))
    df = with_single_flag(df)
    df = with_repeat_flag(df, pairs=pairs)
    df = with_split_flag(df, groups=groups, limit=split_limit, days=split_days)
    df = with_composite_key(with_risk_score(with_underpaid_flag(df)))
    return df


def flag_shares(df: DataFrame, flags: list[str]) -> DataFrame:
    """Per flag: rows that carry it and their percentage."""
    sums = df.agg(F.count("*").alias("__n"), *[F.sum(f).alias(f) for f in flags])
    return sums.unpivot("__n", flags, "flag", "flagged").select(
        "flag",
        F.coalesce("flagged", F.lit(0)).alias("flagged"),
        F.round(F.try_divide(F.col("flagged") * 100.0, F.col("__n")), 6).alias("percent"),
    )


def risk_distribution(df: DataFrame, score: str = "risk_score") -> DataFrame:
    """Rows below 1, from 1 to below 3, from 3; and the total of every indicator."""
    value = F.col(score)
    return df.agg(
        F.count_if(value < fixed.MEDIUM_FROM).alias("low_risk"),
        F.count_if((value >= fixed.MEDIUM_FROM) & (value < fixed.HIGH_FROM)).alias("medium_risk"),
        F.count_if(value >= fixed.HIGH_FROM).alias("high_risk"),
        F.sum("price_flag").alias("price_inflation"),
        F.sum("single_flag").alias("single_bidder"),
        F.sum("repeat_flag").alias("repeated_winners"),
        F.sum("split_flag").alias("contract_splitting"),
        F.sum("underpaid_flag").alias("underpayment"),
    )


def score_statistics(df: DataFrame, scores: tuple[str, ...] = ("price_z", "risk_score")) -> DataFrame:
    """Mean, sample deviation and maximum of the scores, one row per score."""
    parts = [
        F.struct(
            F.lit(s).alias("score"),
            F.round(F.avg(s), 6).alias("mean"),
            F.round(F.stddev_samp(s), 6).alias("std"),
            F.round(F.max(s), 6).alias("max"),
        )
        for s in scores
    ]
    return df.agg(F.array(*parts).alias("__rows")).select(F.inline("__rows"))


def _slices_to_judge(slices: DataFrame, keys: list[str], width: int, min_rows: int) -> DataFrame:
    """Full slices, and those whose contracts are ``__needed`` to judge a sparse slice.

    Ordered per group over its slices, not its contracts.
    """
    in_time = Window.partitionBy(*keys).orderBy("__slice")

    def beside(value: Column, nothing) -> list[Column]:
        """The value in the adjoining slices before and after, if those exist."""
        return [
            F.when(
                F.abs(move("__slice", 1).over(in_time) - F.col("__slice")) == width,
                move(value, 1).over(in_time),
            ).otherwise(F.lit(nothing))
            for move in (F.lag, F.lead)
        ]

    before, after = beside(F.col("__n"), 0)
    counted = slices.withColumn("__around", before + F.col("__n") + after)
    judged = (F.col("__n") < min_rows) & (F.col("__around") >= min_rows)
    marked = counted.withColumn("__judged", judged)
    before, after = beside(F.col("__judged"), False)
    needed = marked.withColumn("__needed", F.col("__judged") | before | after)
    return needed.where((F.col("__n") >= min_rows) | F.col("__needed")).select(
        *keys, "__slice", "__n", "__needed"
    )


def _small(df: DataFrame, customer: str, title: str, amount: str, limit: float) -> DataFrame:
    return df.where(
        all_of([F.col(amount) <= limit, F.col(customer).isNotNull(), F.col(title).isNotNull()])
    )


def _with_membership(
    df: DataFrame, members: DataFrame, on: list[str], out: str, condition: Column, broadcast_bytes: int
) -> DataFrame:
    """``out``: 1 where the row's key is a member and the condition holds."""
    marked = members.withColumn("__member", F.lit(True))
    return (
        attach(df, marked, on, broadcast_bytes=broadcast_bytes)
        .withColumn(out, risk.flag(F.col("__member") & condition))
        .drop("__member")
    )
