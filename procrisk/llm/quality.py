"""Quality rules with thresholds that adapt to the language and source of a text.

Every step is a DataFrame expression. One pass measures each text; the measures, not the
texts, are stored. Each measure is summarised per language and source by a quantile sketch:
a histogram whose buckets keep the six leading bits of a value, so that a quantile is off by
1/32 at most, a group holds a few hundred buckets whatever its size, and sketches of groups
merge by adding counts. A group of few texts uses the merged sketch of its language, and
that of all texts if the language has few. The thresholds are then joined to the measures.

Defined cases: a null text has no words and fails the base rule; null languages and
sources count as ``''``; repeated rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from procrisk.llm.common import SPACES, beside, narrow, row_key, text_of, without, words_of
from procrisk.session import stage

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEATED = 30

#: Texts a group needs for thresholds of its own.
MIN_GROUP = 30
#: Quartiles are taken at these percentages.
LOW, MIDDLE, HIGH = 25, 50, 75


@dataclass(frozen=True)
class Rule:
    """Reject a text whose ``measure`` (a column, in millionths or thousandths) lies beyond
    the median by more than ``spreads`` times the larger of the distances of median and
    quartiles, and by ``slack`` at least. The quartile on the fence's own side lets a source
    of which a quarter differs keep these texts; less than a quarter of bad ones cannot move
    it."""

    measure: str
    upper: bool
    slack: int
    spreads: int


RULES = (
    Rule("symbol_ratio", True, 40_000, 6),
    Rule("line_ratio", True, 400_000, 6),
    Rule("word_length", True, 2_500, 6),
    Rule("word_length", False, 2_500, 6),
)


def _repeated(words: Column, window: int) -> Column:
    """Words inside windows that occur twice or more, from an array of words.

    Windows are told apart by 64-bit hashes within one text. Only texts with a repeated
    hash sort their windows; a position counts up to the next repeated one, the window's
    length at most.
    """
    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - (window - 1)),
        lambda i: F.xxhash64(F.slice(words, i, window)),
    )
    return F.when(F.size(words) >= window, hashes)


def measures(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Counts of each text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, and the measures of ``RULES``."""
    text = text_of()
    with_word = F.filter(
        F.split(F.col("text"), "\n"), lambda line: F.translate(line, SPACES, "") != ""
    )
    rows = narrow(docs, "doc_id", "text", "lang", "source").select(
        "doc_id",
        text.alias("text"),
        row_key().alias("text_key"),
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
    )
    rows = rows.select(
        "doc_id",
        "text_key",
        "lang",
        "source",
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, "")))
        .cast("long")
        .alias("n_symbols"),
        with_word.alias("_lines"),
        words_of(F.col("text")).alias("_words"),
    )
    rows = rows.select(
        "doc_id",
        "text_key",
        "lang",
        "source",
        "word_chars",
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("_words"), window).alias("_hashes"),
    )
    doubled = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    ranked = F.sort_array(
        F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    rows = rows.withColumn("_ranked", F.when(doubled, ranked)).drop("_hashes")
    ranked = F.col("_ranked")
    twice = F.filter(
        ranked,
        lambda p, i: (p["h"] == F.get(ranked, i - 1)["h"])
        | (p["h"] == F.get(ranked, i + 1)["h"]),
    )
    rows = rows.withColumn(
        "_starts", F.sort_array(F.transform(twice, lambda p: p["i"]))
    ).drop("_ranked")
    starts = F.col("_starts")
    covered = F.aggregate(
        F.transform(
            starts,
            lambda s, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1) - s, F.lit(window))),
        ),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "_starts"
    )
    n_words = F.col("n_words")

    def per(part: str, whole: str, unit: int) -> Column:
        return F.expr(f"{part} * {unit} div greatest({whole}, 1)")

    return rows.select(
        "doc_id",
        "text_key",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (
            (n_words < MIN_WORDS) | (F.col("n_repeat_words") * 100 > n_words * MAX_REPEATED)
        ).alias("base_failed"),
        per("n_symbols", "word_chars", 1_000_000).alias("symbol_ratio"),
        per("n_dup_lines", "_n_lines", 1_000_000).alias("line_ratio"),
        per("word_chars", "n_words", 1_000).alias("word_length"),
    )


def sketch(measured: DataFrame, by: tuple[str, ...], names: tuple[str, ...]) -> DataFrame:
    """Quantile sketches of the columns ``names`` per group: one row (measure, bucket, n)
    for each filled bucket. Partial sums precede the shuffle, so a hot group costs no more
    than its buckets. Texts that failed the base rule say nothing about good ones."""
    pairs = F.array(*(F.struct(F.lit(n).alias("measure"), F.col(n).alias("v")) for n in names))
    rows = measured.where(~F.col("base_failed")).select(*by, F.inline(pairs))
    bits = F.greatest(F.length(F.bin("v")) - 6, F.lit(0)).cast("int")
    bucket = F.call_function("shiftleft", F.call_function("shiftright", F.col("v"), bits), bits)
    return rows.groupBy(*by, "measure", bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


def merged(sketches: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones."""
    return sketches.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Rows (group, measure, n, low, middle, high). A window holds the buckets of a group,
    at most a few hundred."""
    group = Window.partitionBy(*by, "measure")
    seen = sketches.select(
        *by,
        "measure",
        "bucket",
        F.sum("n").over(group.orderBy("bucket")).alias("upto"),
        F.sum("n").over(group).alias("n"),
    )

    def at(percent: int) -> Column:
        return F.min(F.when(F.col("upto") * 100 >= F.col("n") * percent, F.col("bucket")))

    return seen.groupBy(*by, "measure").agg(
        F.max("n").alias("n"),
        at(LOW).alias("low"),
        at(MIDDLE).alias("middle"),
        at(HIGH).alias("high"),
    )


def _fence(rule: Rule) -> Column:
    spread = F.greatest(F.col("middle") - F.col("low"), F.col("high") - F.col("middle"))
    reach = F.greatest(F.lit(rule.slack), spread * rule.spreads)
    return F.col("middle") + reach if rule.upper else F.col("middle") - reach


def thresholds(
    measured: DataFrame, rules: tuple[Rule, ...] = RULES, min_group: int = MIN_GROUP
) -> DataFrame:
    """One row for each language and source with its fence for every rule (``fence_0`` …)."""
    names = tuple(dict.fromkeys(r.measure for r in rules))
    fine = stage(sketch(measured, ("lang", "source"), names), "quality-sketch")
    per_lang = merged(fine, ("lang",))
    found = [
        quartiles(fine, ("lang", "source")),
        quartiles(per_lang, ("lang",)),
        quartiles(merged(per_lang, ()), ()),
    ]
    found = [
        f.select(
            *[c for c in ("lang", "source") if c in f.columns],
            "measure",
            *(F.when(F.col("n") >= n, _fence(r)).alias(f"f{level}_{k}") for k, r in enumerate(rules)),
        )
        for level, (f, n) in enumerate(zip(found, (min_group, min_group, 1), strict=True))
    ]
    all_three = (
        found[0].join(found[1], ["lang", "measure"], "left").join(found[2], ["measure"], "left")
    )
    return all_three.groupBy("lang", "source").agg(
        *(
            F.max(
                F.when(
                    F.col("measure") == r.measure,
                    F.coalesce(*(F.col(f"f{level}_{k}") for level in range(3))),
                )
            ).alias(f"fence_{k}")
            for k, r in enumerate(rules)
        )
    )


def judge(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_group: int = MIN_GROUP
) -> DataFrame:
    """One row for each row of ``docs``: its measures, base_failed and kept. A text is kept
    if it passes the base rule and lies within every fence of its group."""
    measured = stage(measures(docs), "quality-measures")
    fences = beside(stage(thresholds(measured, rules, min_group), "quality-fences"), 128)
    beyond = F.lit(False)
    for k, r in enumerate(rules):
        value, fence = F.col(r.measure), F.col(f"fence_{k}")
        beyond = beyond | F.coalesce(value > fence if r.upper else value < fence, F.lit(False))
    return (
        measured.join(fences, ["lang", "source"], "left")
        .withColumn("kept", ~F.col("base_failed") & ~beyond)
        .drop(*(f"fence_{k}" for k in range(len(rules))))
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected rows, all columns kept."""
    rejected = judge(docs).where(~F.col("kept")).select("doc_id", "text_key").distinct()
    return without(docs, rejected, "quality-rejected")
