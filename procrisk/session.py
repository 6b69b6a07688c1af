"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def local_session(cpus: str = "*", partitions: int = 8, **settings: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("procrisk")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine: on a cluster the
    other executors could not read it, nor would it survive the loss of one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="procrisk-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint, but the copy is columnar, so later
    passes read only the columns they use and push their filters down.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(jobs: dict[str, Callable[[], Any]]) -> dict[str, Any]:
    """Runs independent jobs from threads that inherit this one's Spark properties, so that
    the tail of one overlaps with the others. Gives each job's result or its exception."""

    def run(job: Callable[[], Any]) -> Any:
        try:
            return job()
        except Exception as error:  # noqa: BLE001 - the caller decides what stops it
            return error

    with ThreadPoolExecutor(max(len(jobs), 1)) as threads:
        heir = inheritable_thread_target(SparkSession.getActiveSession())(run)
        started = {name: threads.submit(heir, job) for name, job in jobs.items()}
        return {name: future.result() for name, future in started.items()}
