"""Order-dependent operators that hold when one key owns a large share of the rows.

A plain ``Window.partitionBy(key).orderBy(...)`` puts each key into one task. That is the best
plan while every key is small, so the largest key is counted first (a map-side combined count
of the key columns alone). Beyond ``Scale.window_rows`` the rows are range-partitioned on
(key, order) instead, which cuts a large key at any point, and the pieces are put together by
offsets that are tiny: one row per key and slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.config import Scale
from lynxrisk.sources.session import settle

SLICE = "_slice"
CHUNK = "_chunk"
BORROWED = "_borrowed"


def spread(df: DataFrame, rows: int, keys: Sequence[str], scale: Scale = Scale()) -> DataFrame:
    """The rows dealt by the keys over so many partitions that a task holds about ``Scale.task_rows`` of them.

    For a sort, window or grouping by these keys (or more) that follows: its tasks then don't grow with the table. Unchanged
    if the session's partitions are enough; ``rows`` is how many rows there are, or about.
    """
    parts = ceil(rows / scale.task_rows)
    return df if parts <= session_parts(df) else df.repartition(parts, *keys)


def session_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the biggest key, and of all."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    largest, total = sizes.agg(F.max("_rows"), F.sum("_rows")).first()
    return largest or 0, total or 0


def sorted_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int, rows: int, scale: Scale = Scale()) -> DataFrame:
    """Rows cut into ranges of (key, order), with the number of the range in ``_slice``.

    About ``pieces`` ranges, and enough that none has many more than ``Scale.task_rows`` of the ``rows``. Beyond four for each of the session's
    partitions, smaller ranges would only cost tasks. The slice number is written out with the rows, so it cannot
    change when a lost task is run again.
    """
    parts = session_parts(df)
    ranged = df.repartitionByRange(max(parts, min(pieces, 4 * parts), ceil(rows / scale.task_rows)), *keys, *order)
    return settle(ranged.withColumn(SLICE, F.spark_partition_id()))


def _slice_offsets(slices: DataFrame, keys: Sequence[str], total: Column, out: str) -> DataFrame:
    """Per key and slice: the total of all earlier slices of that key."""
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = slices.groupBy(*keys, SLICE).agg(total.alias("_total"))
    return totals.select(*keys, SLICE, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias(out))


def _add_offsets(local: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    on = [local[SLICE] == offsets[SLICE]] + [local[k].eqNullSafe(offsets[k]) for k in keys]
    return local.join(offsets, on, "left").drop(offsets[SLICE], *[offsets[k] for k in keys])


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, pieces: int = 1, rows: int = 0) -> DataFrame:
    """1-based position of every row within its key; ``order`` must be total. ``rows``: how many there are, if known."""
    slices = sorted_slices(df, keys, order, pieces, rows)
    here = Window.partitionBy(*keys, SLICE).orderBy(*order)
    local = spread(slices, rows, [*keys, SLICE]).withColumn("_here", F.row_number().over(here).cast("long"))
    offsets = _slice_offsets(slices, keys, F.count(F.lit(1)), "_offset")
    numbered = _add_offsets(local, offsets, keys)
    return numbered.withColumn(out, F.col("_here") + F.col("_offset")).drop("_here", "_offset", SLICE)


def running_sum(
    df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], out: str, scale: Scale = Scale()
) -> DataFrame:
    """Sum of all rows of the key up to and including this one. The rows are written first, so they are made once."""
    df = settle(df)
    largest, rows = group_sizes(df, keys)
    if largest <= scale.window_rows:
        upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return spread(df, rows, keys).withColumn(out, F.sum(value).over(upto))
    slices = sorted_slices(df, keys, order, ceil(largest / scale.chunk_rows), rows)
    here = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = spread(slices, rows, [*keys, SLICE]).withColumn("_here", F.sum(value).over(here))
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = slices.groupBy(*keys, SLICE).agg(F.sum(value).alias("_total"))
    # a slice without any value has the total NULL, and so has a key before its first value
    offsets = totals.select(*keys, SLICE, F.sum("_total").over(earlier).alias("_offset"))
    added = F.coalesce(F.col("_here") + F.col("_offset"), "_here", "_offset")
    return _add_offsets(local, offsets, keys).withColumn(out, added).drop("_here", "_offset", SLICE)


def frame_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int = 0,
    after: int = 0,
    scale: Scale = Scale(),
) -> DataFrame:
    """Make frames of ``before`` and ``after`` rows computable piece by piece.

    Adds ``_chunk`` (put it into the window's partition) and ``_borrowed`` (drop these rows
    after the window): each piece of a large key also holds the few rows that frames at its
    edge reach in the neighbouring piece. The rows are written first, so they are made once.
    """
    df = settle(df)
    largest, rows = group_sizes(df, keys)
    if largest <= scale.window_rows:
        return spread(df, rows, keys).withColumn(CHUNK, F.lit(0).cast("long")).withColumn(BORROWED, F.lit(False))
    size = max(scale.chunk_rows, before, after, 1)
    numbered = row_index(df, keys, order, "_index", ceil(largest / size), rows)
    zero_based = F.col("_index") - 1
    home = F.floor(zero_based / size).cast("long")
    place = zero_based % size
    targets = F.filter(
        F.array(
            home,
            F.when(place >= size - before, home + 1),
            F.when((place < after) & (home > 0), home - 1),
        ),
        lambda c: c.isNotNull(),
    )
    copies = spread(numbered.withColumn("_home", home).withColumn(CHUNK, F.explode(targets)), rows, [*keys, CHUNK])
    return copies.withColumn(BORROWED, F.col(CHUNK) != F.col("_home")).drop("_home", "_index")


def sliding(
    df: DataFrame,
    columns: dict[str, Column],
    keys: Sequence[str],
    order: Sequence[str],
    preceding: int,
    scale: Scale = Scale(),
) -> DataFrame:
    """Aggregates over this row and the ``preceding`` rows before it."""
    pieces = frame_chunks(df, keys, order, before=preceding, scale=scale)
    frame = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(-preceding, 0)
    out = pieces.select("*", *[agg.over(frame).alias(name) for name, agg in columns.items()])
    return out.filter(~F.col(BORROWED)).drop(CHUNK, BORROWED)


def sliding_days(
    df: DataFrame, frames: dict[str, tuple[str, str]], keys: Sequence[str], day: str, preceding: int
) -> DataFrame:
    """Adds aggregates over all rows of the key from ``preceding`` days before this row's day up to that day.

    ``frames``: name -> (how, column), with how one of sum, count, min, max and avg. All rows of a day share their frame, so a key is
    first brought to one row a day, which combines before the shuffle, and frames run over days: a key is at most as long as the
    timeline, however many rows it has or one of its days has. Rows with a NULL key are one key; those with a NULL day are each
    other's frame, as in SQL. Columns of ``df`` are kept as they are; ``day`` is a date.
    """
    partial = {"sum": [F.sum], "count": [F.count], "min": [F.min], "max": [F.max], "avg": [F.sum, F.count]}
    needed = sorted({(f.__name__, c) for how, c in frames.values() for f in partial[how]})
    place = {measure: f"_m{i}" for i, measure in enumerate(needed)}
    daily = df.groupBy(*keys, F.col(day).alias("_date")).agg(*[getattr(F, how)(c).alias(place[how, c]) for how, c in needed])
    days = Window.partitionBy(*keys).orderBy(F.unix_date("_date")).rangeBetween(-preceding, 0)

    def over(how: str, column: str) -> Column:
        if how == "avg":
            return over("sum", column) / over("count", column)
        total = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[how]
        return total(place[how, column]).over(days)

    rolled = daily.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_date", *[over(*frame).alias(name) for name, frame in frames.items()])
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col(day).eqNullSafe(F.col("_date"))]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in frames]
    return df.select(*kept).join(rolled, on).select(*kept, *frames)
