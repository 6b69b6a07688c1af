"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from procrisk.session import stage

#: The six ASCII separators; a word is a run of anything else.
SPACES = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"

#: A side of a join is broadcast only if it was written and measured below this.
BROADCAST_BYTES = 48 << 20


def reachable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package wherever the driver was
    started; on a cluster it is installed on the executors."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    held = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in held.split(os.pathsep):
        joined = os.pathsep.join(p for p in (root, held) if p)
        spark.sparkContext.environment["PYTHONPATH"] = joined


def text_of(column: Column | str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """Words in order; an empty or blank text has none."""
    return F.array_remove(F.split(text, SPLIT), "")


def narrow(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the columns an operator reads, so that further ones cannot clash with its own."""
    return docs.select(*columns)


def with_whole_ids(rows: DataFrame) -> DataFrame:
    """``rows`` whose doc_id travels to Python without nulls, which pandas would turn into
    floats that round large ids; ``_known`` tells which ones there are."""
    kind = rows.schema["doc_id"].dataType
    return rows.withColumn("_known", F.col("doc_id").isNotNull()).withColumn(
        "doc_id", F.coalesce("doc_id", F.lit(0).cast(kind))
    )


def with_null_ids(rows: DataFrame) -> DataFrame:
    """``rows`` as they were before ``with_whole_ids``."""
    return rows.withColumn("doc_id", F.when(F.col("_known"), F.col("doc_id"))).drop("_known")


def beside(side: DataFrame, width: int, blob: str | None = None) -> DataFrame:
    """``side`` (a stored table), marked for broadcast if all of it is small.

    Its rows times ``width`` bytes, plus the bytes of ``blob``, are measured; a larger
    table is left to a shuffled join, which adaptive execution splits where it is skewed.
    """
    sizes = [F.count(F.lit(1)).alias("n")]
    if blob:
        sizes.append(F.sum(F.length(blob)).alias("b"))
    row = side.agg(*sizes).first()
    held = row["n"] * width + ((row["b"] or 0) if blob else 0)
    return F.broadcast(side) if held <= BROADCAST_BYTES else side


def join_dealt(
    rows: DataFrame, side: DataFrame, key: str, by: str, counted: DataFrame | None = None, hot_rows: int = 500
) -> DataFrame:
    """``rows`` joined with ``side`` (one row per key) on ``key``. The rows of a key that has
    more than ``hot_rows`` are dealt by the hash of ``by`` to as many tasks, each with its copy
    of the key's side. Keys are counted in ``counted``, a stored table, or in ``rows``."""
    counts = (rows if counted is None else counted).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    fans = counts.where(F.col("n") > hot_rows).select(key, F.ceil(F.col("n") / hot_rows).cast("int").alias("_fan"))
    fans = stage(fans, "hot-keys")
    if fans.isEmpty():
        return rows.join(side, key)
    fans = beside(fans, 16)
    fan = F.coalesce("_fan", F.lit(1))
    dealt = rows.join(fans, key, "left").withColumn("_salt", F.pmod(F.xxhash64(by), fan).cast("int"))
    copied = side.join(fans, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), fan - 1)))
    return dealt.drop("_fan").join(copied.drop("_fan"), [key, "_salt"]).drop("_salt")


def row_key(text: str = "text") -> Column:
    """Tells rows of one doc_id with different texts apart."""
    return F.xxhash64(text_of(text))


def without(docs: DataFrame, rejected: DataFrame, name: str) -> DataFrame:
    """``docs`` without the rows named by ``rejected`` (doc_id, text_key); all columns stay."""
    gone = stage(
        rejected.select(F.col("doc_id").alias("_gone_id"), F.col("text_key").alias("_gone_key")),
        name,
    )
    gone = beside(gone, 64)
    same = docs["doc_id"].eqNullSafe(gone["_gone_id"]) & (row_key() == gone["_gone_key"])
    return docs.join(gone, same, "left_anti")
