"""Rolling calendar windows: one value per key and window end date, without a loop."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.config import RiskConfig
from lynxrisk.functions.expr import day_number
from lynxrisk.operators.ordering import spread


def calendar(cfg: RiskConfig) -> Column:
    """All window end dates of the timeline, as an array."""
    return F.sequence(F.lit(cfg.first_window_end), F.lit(cfg.last_window_end), F.expr("INTERVAL 1 DAY"))


def data_calendar(df: DataFrame, day: str, width: int = 7) -> Column:
    """The same from the first and last day found in the data (two scalar subqueries)."""
    first = df.agg(F.min(day)).scalar()
    last = df.agg(F.max(day)).scalar()
    return F.sequence(F.date_add(first, width - 1), last, F.expr("INTERVAL 1 DAY"))


def window_calendar(spark, start: dt.date, days: int, width: int = 7) -> DataFrame:
    """The window end dates as rows."""
    cfg = RiskConfig(timeline_start=start, timeline_days=days, window_days=width)
    return spark.range(1).select(F.explode(calendar(cfg)).alias("window_end_date"))


@dataclass(frozen=True)
class Frame:
    """An aggregate (``sum``, ``max``, ``min``, ``count``) of a daily measure.

    ``first`` and ``last`` are days relative to the window end date, both inside.
    """

    measure: str
    first: int = -6
    last: int = 0
    how: str = "sum"


def rolling_features(
    daily: DataFrame,
    key: str,
    day: str,
    frames: dict[str, Frame],
    ends: Column,
    present: str,
    width: int = 7,
) -> DataFrame:
    """Rolling aggregates of a daily table, for every key and end date with data in the window.

    ``daily`` has one row per key and day, which bounds a key to the length of the timeline
    whatever its number of events. Window ends are added as rows without measures, so that a
    RANGE frame over the day number sees exactly the wanted days; an empty frame gives NULL.
    ``present`` is a measure that is not NULL on every daily row.
    """
    measures = sorted({f.measure for f in frames.values()} | {present})
    rows = daily.select(key, F.col(day).alias("window_end_date"), *measures, F.lit(False).alias("_end"))
    anchors = (
        daily.select(key)
        .distinct()
        .select(key, F.explode(ends).alias("window_end_date"), F.lit(True).alias("_end"))
    )
    both = rows.unionByName(anchors, allowMissingColumns=True).withColumn(
        "_day", day_number(F.col("window_end_date"))
    )
    # an employee has about as many days as window ends, at most
    both = spread(both, 2 * anchors.count(), [key])
    base = Window.partitionBy(key).orderBy("_day")
    columns = [
        getattr(F, f.how)(f.measure).over(base.rangeBetween(f.first, f.last)).alias(name)
        for name, f in frames.items()
    ]
    seen = F.count(present).over(base.rangeBetween(1 - width, 0)).alias("_seen")
    windows = both.select(key, "window_end_date", "_end", seen, *columns)
    return windows.filter(F.col("_end") & (F.col("_seen") > 0)).drop("_end", "_seen")
