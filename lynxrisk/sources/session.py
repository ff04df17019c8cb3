"""The Spark session and the shared folder for cut lineage."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", memory: str | None = None) -> SparkSession:
    """A session for tests and local runs. On a cluster, use the one spark-submit gives."""
    partitions = "8" if cpus == "*" else str(cpus)
    memory = memory or os.environ.get("SPARK_DRIVER_MEMORY", "12g")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lynxrisk")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only in local mode."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="lynxrisk-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def use_utc(spark: SparkSession) -> None:
    """Dates, hours and hashes are those of UTC, in the batch job and in streams alike."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


#: Tables that ``settle`` has written in this process and that are not yet deleted.
_SETTLED: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what is settled inside the block when it ends; results must have been written elsewhere by then."""
    known = len(_SETTLED)
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        while len(_SETTLED) > known:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_SETTLED.pop())
            path.getFileSystem(hadoop).delete(path, True)


#: A settled table whose size is known beforehand has a file for each so many rows.
FILE_ROWS = 8192


def settle(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write the rows once to the shared folder and go on from there.

    For results that several later steps read: none of them runs the plan again, all see the
    same rows, and a lost executor costs a read. Parquet, so that readers fetch only the
    columns they need and Spark knows the size when it plans their joins.

    ``rows``: about how many rows there are at most, if that is known. Files, and tasks of the last stage, are then one for each
    ``FILE_ROWS`` of them at most, so that a small table isn't written in as many files as a shuffle has partitions. For results of a
    grouping or join of such a size: stages before the last keep their tasks.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(1, math.ceil(rows / FILE_ROWS)))
    path = f"{shared_folder(spark)}/lynxrisk-{uuid.uuid4().hex}"
    _SETTLED.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
