"""Small column helpers shared by the operators and plans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lynxrisk.config import DAY_HOURS


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Case-insensitive substring test against several words; NULL text gives NULL."""
    low = F.lower(text)
    return reduce(lambda a, b: a | b, [low.contains(word.lower()) for word in words])


def first_match(cases: Sequence[tuple[Column, object]], default: object) -> Column:
    """Value of the first condition that is true, else the default."""
    out = None
    for condition, value in cases:
        out = F.when(condition, F.lit(value)) if out is None else out.when(condition, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def lookup(key: Column, values: dict[str, float], default: float) -> Column:
    """A small fixed table as a CASE expression."""
    return first_match([(key == name, float(v)) for name, v in values.items()], float(default))


def clip(x: Column, low: float | Column, high: float | Column) -> Column:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.greatest(as_column(low), F.least(as_column(high), x))


def at_most(x: Column, high: float) -> Column:
    """Upper bound that, unlike ``least``, keeps NULL."""
    return F.when(x > high, F.lit(high)).otherwise(x)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL, not an error, on a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0))


def count_true(flag: Column) -> Column:
    return F.count_if(flag)


def different_values(df: DataFrame, col: str) -> Column:
    """How many values a column has, as a scalar subquery of its own grouping.

    Several ``countDistinct`` of a table become one aggregation, also as subqueries, and that multiplies every row before the shuffle.
    """
    return df.select(col).distinct().agg(F.count(col)).scalar()


def any_true(flag: Column) -> Column:
    return F.coalesce(F.bool_or(flag), F.lit(False))


def fixed(x: Column, digits: int) -> Column:
    """Text of a number with exactly that many digits, rounded half away from zero.

    The inner rounding drops the noise of binary sums: 0.0125 must round up however it came about.
    """
    return F.round(F.round(x, 12), digits).cast(f"decimal(38,{digits})").cast("string")


def filled(template: str, *values: Column) -> Column:
    """A text with its %s replaced by the values; a NULL value makes the whole NULL."""
    first, *others = template.split("%s")
    pieces = [F.lit(first)]
    for value, text in zip(values, others, strict=True):
        pieces += [value, F.lit(text)]
    return F.concat(*pieces)


# --- identifiers -----------------------------------------------------------


def piped(parts: Sequence[Column]) -> Column:
    """Parts joined by '|'; a NULL part makes the whole NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("|"))
        pieces.append(part)
    return F.concat(*pieces)


def record_hash(parts: Sequence[Column]) -> Column:
    return F.md5(piped(parts))


def stamp(ts: Column) -> Column:
    """A timestamp as text in one fixed format, whatever the session prints."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def id_spread(identifier: Column, n: int) -> Column:
    """A stable number 0..n-1 derived from an id."""
    return F.pmod(F.conv(F.substring(F.md5(identifier), 1, 8), 16, 10).cast("long"), F.lit(n))


# --- dates -----------------------------------------------------------------


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", day))


def day_number(day: Column) -> Column:
    return F.unix_date(day)


def after_hours(ts: Column) -> Column:
    return ~F.hour(ts).between(*DAY_HOURS)


def on_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


# --- geometry --------------------------------------------------------------

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance."""
    half_chord = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(at_most(half_chord, 1.0)))
