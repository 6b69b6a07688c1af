"""URL filter: explicit rules first, then a logistic regression on hashed character n-grams.

The model reads host and path only. It is trained on a small labelled table (url, label),
by default the one of ``labelled_urls``; of a large one a bounded sample is drawn by hash.
Scoring is one pass over the urls.

Defined cases: a null url, or one without ``://``, has empty host and path; the model then
sees its bias alone; repeated rows get the same verdict; an empty table gives no rows; with
labels of one class only, or none, the model allows everything.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procrisk.llm.labelled_urls import labelled_urls


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed rules, by host and path prefix.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

#: Labelled urls used for fitting, at most; more are sampled by hash.
MAX_LABELLED = 20_000
#: Hash buckets of n-grams, and their lengths.
FEATURES = 1 << 14
GRAMS = (3, 4)
THRESHOLD = 0.5


def _lowered(host: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower())


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    scheme = F.instr(url, "://")
    rest = F.when(scheme > 0, F.substring(url, scheme + 3, F.length(url)))
    return (
        F.coalesce(_lowered(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.lit("")),
        F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit("")),
    )


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; nulls where none does. Of rules of
    equal length the first counts."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.name)):  # the last that fits stays
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.name)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _grams(text: Column, mark: str) -> Column:
    """Character n-grams with their lengths' mark; the text is framed by ``^`` and ``$``."""
    framed = F.concat(F.lit("^"), text, F.lit("$"))

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(framed) - (n - 1), F.lit(1)))
        return F.transform(
            starts, lambda i: F.concat(F.lit(f"{mark}{n}:"), framed.substr(i, F.lit(n)))
        )

    return F.concat(*map(of_length, GRAMS))


def _featured(rows: DataFrame) -> DataFrame:
    """``rows`` (host, path) with the vector column ``_features``. Grams of a path that are
    numbers only carry no meaning of their own; digits are folded to one."""
    path = F.regexp_replace("path", "[0-9]+", "0")
    rows = rows.withColumn(
        "_grams", F.concat(_grams(F.col("host"), "h"), _grams(path, "p"))
    )
    return (
        HashingTF(numFeatures=FEATURES, binary=True, inputCol="_grams", outputCol="_features")
        .transform(rows)
        .drop("_grams")
    )


def fit(labelled: DataFrame, max_labelled: int = MAX_LABELLED) -> LogisticRegressionModel | None:
    """Model from rows (url, label), label 1 for block. Copies count once; of more than
    ``max_labelled`` urls about that many are drawn by hash. None with labels of fewer than
    two classes."""
    rows = labelled.where("label IS NOT NULL").select("url", "label").distinct()
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    host, path = split_url(F.col("url"))
    total = sum(counts.values())
    if total > max_labelled:
        share = int(max_labelled / total * (1 << 32))
        rows = rows.where(F.pmod(F.xxhash64("url"), F.lit(1 << 32)) < share)
    rows = rows.select(host.alias("host"), path.alias("path"), F.col("label").cast("double"))
    return LogisticRegression(
        featuresCol="_features",
        labelCol="label",
        regParam=0.002,
        maxIter=60,
        standardization=False,
    ).fit(_featured(rows))


def verdicts(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    labelled: DataFrame | None = None,
    max_labelled: int = MAX_LABELLED,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """page_id, host, path, rule, verdict and ``score``, the model's probability of block."""
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "_ruled": verdict})
    if labelled is None:
        labelled = labelled_urls(pages.sparkSession)
    model = fit(labelled, max_labelled)
    if model is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        model.setProbabilityCol("_probability").setRawPredictionCol("").setPredictionCol("")
        scored = model.transform(_featured(rows))
        scored = scored.withColumn("score", vector_to_array("_probability")[1])
    guessed = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("_ruled", guessed).alias("verdict"),
        "score",
    )
