"""Operators with state on streams of conformed records. State is bounded by the watermark: how late a record may be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lynxrisk.operators.rolling import Frame

TIME, HASH = "event_timestamp", "record_hash"


def unique_records(records: DataFrame, late: str, by: str = HASH, time: str = TIME) -> DataFrame:
    """The first record of each hash, across batches and restarts.

    A repeat is recognised until the watermark (``late`` behind the latest time) has passed the first one's time by ``late``; state holds hashes for as long.
    Records behind the watermark are dropped and counted by the query (see ``late_rows``). Records without a time or a
    hash can't be held against others: take them out before.
    """
    return records.withWatermark(time, late).dropDuplicatesWithinWatermark([by])


def hopping_totals(
    records: DataFrame, frames: dict[str, Frame], late: str | None, key: str = "employee_id", time: str = TIME, width: int = 7
) -> DataFrame:
    """Per key and window of ``width`` days, each a day after the other: window_end_date and the frames' totals.

    The streaming form of ``rolling.rolling_features`` for frames as wide as the window: measures are columns of the records. A window
    is given out once, when the watermark has passed its end, so its rows never change. State is one row for each key and open window. ``late`` is None
    for records that have a watermark already.
    """
    source = records.withWatermark(time, late) if late else records
    grouped = source.groupBy(F.window(time, f"{width} days", "1 day").alias("w"), F.col(key).alias(key))
    return grouped.agg(*[_total(f, width).alias(name) for name, f in frames.items()]).select(
        key, F.date_sub(F.to_date("w.end"), 1).alias("window_end_date"), *frames
    )


def _total(frame: Frame, width: int) -> Column:
    if (frame.first, frame.last) != (1 - width, 0):
        raise ValueError(f"a stream's frame is its whole window, not days {frame.first} to {frame.last}")
    return getattr(F, frame.how)(frame.measure)


def late_rows(query: StreamingQuery) -> int:
    """How many rows the query's operators have dropped as too late, by the progress it still keeps."""
    return sum(state.numRowsDroppedByWatermark for progress in query.recentProgress for state in progress.stateOperators)
