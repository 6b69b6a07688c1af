"""Files that arrived since the last run, appended to a bronze table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from procrisk.sources.documents import BUNDLE, SOURCE, TEXT, parse, records_of, rejects_of

BATCH = "batch"


def land_new_objects(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    sink: str,
    progress: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files: int = 100_000,
    rejects: str | None = None,
    bundled: bool = False,
) -> DataFrame:
    """Appends the objects of files not yet seen to ``sink`` and returns the table.

    The checkpoint ``progress`` remembers the files. Each batch reads and parses its files
    once and writes its records to ``sink`` and its unreadable documents to ``rejects``
    (``<sink>_rejects``), both in a folder ``batch=...`` named by the batch. A batch that is
    repeated after a failure overwrites its own folders, so each file is taken once, however
    far the first attempt came. ``transform`` maps the records first.

    The checkpoint lists every file, and every batch plans its own: a source of very many
    short objects should arrive ``bundled``, as ``documents.write_bundles`` stores them.
    """
    rejects = rejects or f"{sink}_rejects"
    transform = transform or (lambda records: records)
    # Batches of another checkpoint that feeds the same table have folders of their own.
    mark = hashlib.sha256(progress.encode()).hexdigest()[:8]

    def land(texts: DataFrame, number: int) -> None:
        parsed = parse(texts, schema).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            folder = f"{BATCH}={mark}-{number}"
            _write(transform(records_of(parsed)), f"{sink}/{folder}")
            _write(rejects_of(parsed), f"{rejects}/{folder}")
        finally:
            parsed.unpersist()

    reader = spark.readStream.option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", True)
    if bundled:
        arrived = reader.schema(BUNDLE).parquet(source)
    else:
        arrived = reader.text(source, wholetext=True).select(
            F.col("_metadata.file_path").alias(SOURCE), F.col("value").alias(TEXT)
        )
    query = (
        arrived.writeStream.foreachBatch(land)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    columns = transform(spark.createDataFrame([], schema)).schema
    return spark.read.schema(columns).option("recursiveFileLookup", True).parquet(sink)


def _write(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)
