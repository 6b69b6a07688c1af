"""The corpus pipeline: quality, near copies, benchmark passages, secrets, encoding.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and
returns a table that is written and read again before the next one starts. All but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from procrisk.llm import pieces, quality, secrets, setsketch, tiling
from procrisk.llm.common import reachable
from procrisk.llm.queries import vocabulary
from procrisk.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the thresholds of their language and source."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    reachable(spark)
    return setsketch.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    reachable(spark)
    return tiling.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their ``piece_ids``, and ``round_trip``, whether these decode to the
    text; columns of these two names are replaced."""
    reachable(spark)
    model = pieces.load_pieces(vocabulary("piece_bpe_32k.model"))
    return pieces.encode_checked(docs, model)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("encoding", encoding),
]

#: Tiling and Viterbi search are out of SQL's reach; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
