"""Scaling of feature columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lynxrisk.config import Scale
from lynxrisk.functions.expr import clip
from lynxrisk.operators.ranking import exact_quantiles


def winsorized_unit(col: str, low: float | None, high: float | None) -> Column:
    """Clip to [low, high], then to 0..1. After the clip the minimum and maximum ARE the bounds.

    A flat column, and one without any value (no bounds), gives 0.
    """
    if low is None or high is None or high == low:
        return F.lit(0.0)
    return (clip(F.col(col).cast("double"), low, high) - F.lit(low)) / F.lit(high - low)


def winsorize_minmax(
    df: DataFrame, cols: list[str], probs: tuple[float, float] = (0.01, 0.99), scale: Scale = Scale()
) -> dict[str, Column]:
    """The normalised form of each column, from quantiles over the whole table."""
    bounds = exact_quantiles(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), cols, probs, scale)
    return {c: winsorized_unit(c, *bounds[c]) for c in cols}
