"""Parquet and CSV tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Stored results, best first.
BEST_FIRST = ["procurements_final", "procurements_featured", "procurements"]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored under ``path``, on any file system Spark reads."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).exists(target)


def require_inputs(spark: SparkSession, paths: list[str]) -> None:
    """Raises one error that names every absent input."""
    absent = [path for path in paths if not exists(spark, path)]
    if absent:
        raise FileNotFoundError(f"missing inputs: {', '.join(absent)}")


def write_parquet(
    df: DataFrame, path: str, compression: str = "zstd", partition_by: list[str] | None = None
) -> str:
    """Stores ``df`` as Parquet. ``partition_by`` a period to prune date ranges."""
    df.write.mode("overwrite").option("compression", compression).parquet(
        path, partitionBy=partition_by
    )
    return path


def write_buckets(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Stores ``df`` as the table ``name`` under ``path``, dealt to ``buckets`` files by the
    hash of ``key`` and sorted by it, and returns the table. Tables of equal buckets are
    joined on the key without a shuffle."""
    dealt = df.repartition(buckets, key)  # the same hash, so each task writes one bucket
    writer = dealt.write.mode("overwrite").option("compression", "zstd").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str) -> str:
    """Stores ``df`` as UTF-8 CSV with a header; quotes are escaped by doubling."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    # The defaults would trim text.
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet table; raises when absent."""
    require_inputs(spark, [path])
    return spark.read.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """CSV table with a header; an empty field is NULL. Without a schema the types are
    inferred by a scan. Files whose fields hold no line breaks can be split among tasks:
    read them with ``multiline=False``."""
    require_inputs(spark, [path])
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def best_available(
    spark: SparkSession, folder: str, names: list[str] | None = None
) -> tuple[DataFrame, str]:
    """The first of the stored results that loads, and its name."""
    for name in names or BEST_FIRST:
        path = f"{folder}/{name}.parquet"
        if not exists(spark, path):
            continue
        try:
            return spark.read.parquet(path), name
        except AnalysisException:
            continue
    raise FileNotFoundError(f"no dataset under {folder}")
