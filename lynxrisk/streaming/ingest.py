"""Event feeds as file streams: new files are resolved and conformed as they arrive.

The plan is the batch one: the register is a static table joined to the stream, and the file
sink commits each micro-batch once. A changed register needs a batch run for the old rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lynxrisk.config import RunContext
from lynxrisk.plans import silver as S
from lynxrisk.sources.schemas import BRONZE
from lynxrisk.sources.session import use_utc
from lynxrisk.sources.tables import CORRUPT
from lynxrisk.streaming.sink import write_batches


def read_feed_stream(
    spark: SparkSession, name: str, folder: str, files_per_batch: int = 1000, corrupt: bool = False
) -> DataFrame:
    """The files of a feed in a folder, as a stream with the declared schema; ``corrupt`` as in ``read_bronze``."""
    schema = BRONZE[name] + (f", {CORRUPT} string" if corrupt else "")
    return (
        spark.readStream.schema(schema)
        .options(header=True, escape='"', columnNameOfCorruptRecord=CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def stream_feed(
    spark: SparkSession, domain: str, folder: str, register: DataFrame, out: str, checkpoint: str, ctx: RunContext
) -> StreamingQuery:
    """Conform all files that are new since the last call, partitioned by resolution status.

    ``resolved_part`` and ``dead_part`` of the silver plans read the result.
    """
    use_utc(spark)
    feed = S.FEEDS[domain]
    tagged = S.tag_feed(feed, read_feed_stream(spark, f"{domain}_events", folder), register)
    return (
        S.conform_all(feed, tagged, ctx)
        .writeStream.format("parquet")
        .partitionBy("identity_resolution_status")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_feed_batches(
    spark: SparkSession, domain: str, folder: str, register: DataFrame, out: str, checkpoint: str, ctx: RunContext, files_per_batch: int = 1000
) -> StreamingQuery:
    """The same with malformed lines among the dead letters, one folder for each batch, replaced if the batch is run again.

    Read the result with ``sink.read_batches``; ``resolved_part`` and ``dead_part`` take it apart.
    """
    use_utc(spark)
    feed = S.FEEDS[domain]
    events = read_feed_stream(spark, f"{domain}_events", folder, files_per_batch, corrupt=True)
    return write_batches(S.conform_all(feed, S.tag_feed(feed, events, register), ctx), out, checkpoint, ["identity_resolution_status"])
