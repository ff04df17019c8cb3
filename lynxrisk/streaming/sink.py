"""A sink of micro-batches that may be run again: a batch replaces what it wrote before, and readers see whole batches only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def batch_writer(out: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch``: writes a batch to the folder of its number, in place of an earlier try.

    A stream gives a batch that failed the same number and the same rows again, so the rows of each batch are there once, however often it was tried. An empty
    batch replaces too. The mark of a finished write is set last by the committer.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{out}/batch_id={number}")

    return write


def write_batches(stream: DataFrame, out: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Write all that is new since the last call."""
    return (
        stream.writeStream.foreachBatch(batch_writer(out, partition_by))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_batches(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The rows of all finished batches; a batch that is being written, or whose write was broken off, isn't there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    marks = hadoop.Path(f"{out}/batch_id=*/_SUCCESS")
    found = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marks)
    folders = [f.getPath().getParent().toString() for f in found or []]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", out).parquet(*folders).select(*schema.names)
