"""Scans of JSON objects and list pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procrisk.schemas import page_schema
from procrisk.sources.tables import exists

SOURCE = "source_file"
TEXT = "raw_text"


#: Columns of bundled documents: the path of the file that each was, and its whole text.
BUNDLE = f"{SOURCE} string, {TEXT} string"


def write_bundles(texts: DataFrame, path: str) -> str:
    """Appends whole documents, ``source_file`` and ``raw_text``, to the bundles in ``path``.

    A bundle is a Parquet file of many documents: a file of its own for each costs a listing
    entry, an opening and a commit however short it is.
    """
    texts.select(SOURCE, TEXT).write.mode("append").option("compression", "zstd").parquet(path)
    return path


def read_texts(
    spark: SparkSession, path: str, whole_files: bool = True, bundled: bool = False
) -> DataFrame:
    """``source_file`` and ``raw_text`` of every JSON document under ``path``.

    One document per file, as the pretty-printed objects are stored, with
    ``whole_files=False`` one per line, or with ``bundled`` as ``write_bundles`` stores them.
    An absent folder has no documents.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], BUNDLE)
    reader = spark.read.option("recursiveFileLookup", True)
    if bundled:
        return reader.schema(BUNDLE).parquet(path)
    texts = reader.text(path, wholetext=whole_files)
    return texts.select(F.col("_metadata.file_path").alias(SOURCE), F.col("value").alias(TEXT))


def parse(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Adds ``records``: the objects of each document, NULL when it is not valid JSON.

    A document may be one object or an array of objects.
    """
    return texts.withColumn("records", F.from_json(TEXT, T.ArrayType(schema)))


def read_objects(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    whole_files: bool = True,
    bundled: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Objects under ``path``, and the documents that could not be read."""
    parsed = parse(read_texts(spark, path, whole_files, bundled), schema)
    return records_of(parsed), rejects_of(parsed)


def records_of(parsed: DataFrame) -> DataFrame:
    """One row per object."""
    return parsed.select(F.inline("records"))


def rejects_of(parsed: DataFrame) -> DataFrame:
    """Documents that are not valid JSON: file and text."""
    return parsed.where(F.col("records").isNull()).select(SOURCE, TEXT)


def read_pages(
    spark: SparkSession,
    path: str,
    record: T.DataType | None = None,
    number: str = r"([0-9]+)\.json$",
    bundled: bool = False,
) -> DataFrame:
    """List pages, unreadable ones left out; ``page`` gives their order.

    ``number`` finds the page number in the file path. Columns: ``page``, ``content``,
    ``totalPages``, ``totalElements`` and ``records``, the length of the content.
    """
    schema = page_schema(record)
    parsed = parse(read_texts(spark, path, bundled=bundled), schema)
    return (
        parsed.where(F.col("records").isNotNull())
        .select(page_number(number).alias("page"), F.inline("records"))
        .withColumn("records", F.coalesce(F.size("content"), F.lit(0)))
    )


def page_number(pattern: str) -> Column:
    """Page number within the source path, compared as a number: 2 comes before 10."""
    return F.regexp_extract(F.col(SOURCE), pattern, 1).try_cast("long")
