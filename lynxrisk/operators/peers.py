"""A value against the mean and spread of its peer group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_peer_stats(df: DataFrame, values: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Adds ``_mean_v`` and ``_std_v`` of each value over the group.

    Grouped (with map-side combine) and joined back rather than a window, so that no task has
    to hold a peer group. Rows with a NULL group get NULL.
    """
    stats = df.groupBy(*by).agg(
        *[F.avg(v).alias(f"_mean_{v}") for v in values],
        *[F.stddev_samp(v).alias(f"_std_{v}") for v in values],
    )
    return df.join(stats, list(by), "left")


def z_of(value: str) -> Column:
    """z-score from the columns of ``with_peer_stats``; 0 for one member or no spread."""
    spread = F.col(f"_std_{value}")
    z = (F.col(value) - F.col(f"_mean_{value}")) / F.nullif(spread, F.lit(0.0))
    return F.when(F.col(f"_mean_{value}").isNotNull(), F.coalesce(z, F.lit(0.0)))


def gap_of(value: str) -> Column:
    """Distance from the group mean; 0 where either is missing."""
    return F.coalesce(F.col(value) - F.col(f"_mean_{value}"), F.lit(0.0))


def safe_zscore(df: DataFrame, value: str, by: Sequence[str], out: str) -> DataFrame:
    return _add(df, value, by, out, z_of)


def peer_gap(df: DataFrame, value: str, by: Sequence[str], out: str) -> DataFrame:
    return _add(df, value, by, out, gap_of)


def _add(df: DataFrame, value: str, by: Sequence[str], out: str, rule) -> DataFrame:
    joined = with_peer_stats(df, [value], by).withColumn(out, rule(value))
    return joined.drop(f"_mean_{value}", f"_std_{value}")
