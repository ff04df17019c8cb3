"""Ranks and quantiles over a whole table, without a one-task window."""

from __future__ import annotations

from dataclasses import dataclass
from math import floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.config import Scale
from lynxrisk.functions.expr import first_match
from lynxrisk.operators.ordering import SLICE, sorted_slices, spread
from lynxrisk.sources.session import settle

#: A value of more than one in so many rows is frequent; there are fewer than this.
HOT = 2000


def with_ranks(df: DataFrame, col: str) -> DataFrame:
    """All rows, with how many rows have a lower value (``_below``), the same (``_ties``), and any (``_n``).

    The rows are written first, so they are made once. Ranks are those of the different values, each with its count, which combines before the
    shuffle: however often a value occurs, it is one row there. A value that more than one in ``HOT`` rows has comes back to its rows by broadcast, so these
    rows don't move; the others are joined by value, where no value owns many rows of a task. NULL has no rank; NaN is above every number, as in SQL.
    """
    rows = settle(df)
    counts = settle(rows.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("_value")).agg(F.count(F.lit(1)).alias("_ties")))
    values = settle(_ranked_values(counts))
    is_hot = F.col("_ties") * HOT > F.col("_n")
    hot, rest = values.filter(is_hot), values.filter(~is_hot)
    same = F.col(col) == F.col("_value")
    names = [F.col(f"`{c}`") for c in df.columns]
    told = ["_below", "_ties", "_n"]
    found = rows.join(F.broadcast(hot), same).select(*names, *told)
    many = rest.agg(F.sum("_ties")).first()[0]
    if many:
        cold = rows.filter(F.col(col).isNotNull()).join(F.broadcast(hot.select("_value")), same, "left_anti")
        found = found.unionByName(spread(cold, many, [col]).join(rest, same).select(*names, *told))
    return found.unionByName(rows.filter(F.col(col).isNull()).select(*names, *[F.lit(None).cast("long").alias(c) for c in told]))


def _ranked_values(counts: DataFrame) -> DataFrame:
    """(_value, _ties, _below, _n) of written (_value, _ties): the values are cut into ranges, and what lies before a range is added."""
    n = counts.count()
    slices = sorted_slices(counts, [], ["_value"], 1, n)
    sizes = slices.groupBy(SLICE).agg(F.sum("_ties").alias("_rows"))
    # one row for each range from here to the end of the offsets
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(sizes.select(
        F.col(SLICE).alias("_s"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"), F.sum("_rows").over(Window.partitionBy()).alias("_n")
    ))
    lower = F.coalesce(F.sum("_ties").over(Window.partitionBy(SLICE).orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = spread(slices, n, [SLICE]).select("*", lower.alias("_lower")).join(F.broadcast(offsets), F.col(SLICE) == F.col("_s"))
    return ranked.select("_value", "_ties", (F.col("_offset") + F.col("_lower")).alias("_below"), "_n")


def percentile_rank_avg(df: DataFrame, col: str, out: str) -> DataFrame:
    """Percentile 0..100 of the average rank; ties share their mean rank."""
    mean_rank = F.col("_below") + (F.col("_ties") + 1) / 2
    ranked = with_ranks(df, col)
    return ranked.withColumn(out, mean_rank / F.col("_n") * 100).drop("_below", "_ties", "_n")


def percent_rank(df: DataFrame, col: str, out: str) -> DataFrame:
    """(rank - 1) / (rows - 1), the SQL PERCENT_RANK over the whole table."""
    share = F.when(F.col("_n") > 1, F.col("_below") / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    ranked = with_ranks(df, col)
    return ranked.withColumn(out, F.when(F.col(col).isNotNull(), share)).drop("_below", "_ties", "_n")


def percentile_tier(percentile: str, cuts: tuple[float, float] = (75.0, 95.0)):
    """Right-closed bins: up to the first cut LOW, up to the second MEDIUM, then HIGH."""
    p = F.round(F.col(percentile), 9)
    return first_match([(p > cuts[1], "HIGH"), (p > cuts[0], "MEDIUM")], "LOW")


def percent_rank_tier(share: str, cuts: tuple[float, float] = (0.75, 0.95)):
    """Left-closed bins on PERCENT_RANK."""
    p = F.round(F.col(share), 9)
    return first_match([(p >= cuts[1], "HIGH"), (p >= cuts[0], "MEDIUM")], "LOW")


@dataclass
class _Target:
    """One order statistic being searched: value number ``index`` (0-based) of a column."""

    col: str
    index: int
    low: float | None = None  # the answer is >= low; ``below`` rows are < the open interval
    high: float | None = None
    below: int = 0
    inside: int = 0
    answer: float | None = None

    def interior(self):
        x = F.col(self.col)
        test = x.isNotNull()
        if self.low is not None:
            test = test & (x > self.low)
        if self.high is not None:
            test = test & (x < self.high)
        return test


def _narrow(df: DataFrame, targets: list[_Target], accuracy: int) -> None:
    """One step for all targets: bracket each by approximate quantiles, then count exactly.

    Targets that are still in the same interval share its sketch, and those with the same bracket its counts.
    """
    groups: dict[tuple, list[_Target]] = {}
    for t in targets:
        groups.setdefault((t.col, t.low, t.high), []).append(t)
    shares = {}
    for key, group in groups.items():
        for t in group:
            at, margin = (t.index - t.below) / max(t.inside - 1, 1), 2.0 / accuracy
            shares.setdefault(key, []).extend([max(at - margin, 0.0), min(at + margin, 1.0)])
    sketches = [
        F.percentile_approx(F.when(group[0].interior(), F.col(group[0].col)), F.array(*[F.lit(p) for p in shares[key]]), accuracy).alias(f"g{i}")
        for i, (key, group) in enumerate(groups.items())
    ]
    found = df.agg(*sketches).first()
    brackets = {}
    for quantiles, group in zip(found, groups.values(), strict=True):
        for j, t in enumerate(group):
            brackets.setdefault((t.col, t.low, t.high, quantiles[2 * j], quantiles[2 * j + 1]), []).append(t)
    counts = []
    for i, ((*_, low, high), group) in enumerate(brackets.items()):
        x = F.when(group[0].interior(), F.col(group[0].col))
        counts += [
            F.count_if(x < low).alias(f"lt{i}"),
            F.count_if(x == low).alias(f"lo{i}"),
            F.count_if((x > low) & (x < high)).alias(f"in{i}"),
            F.count_if(x == high).alias(f"hi{i}"),
        ]
    exact = df.agg(*counts).first()
    for i, ((*_, low, high), group) in enumerate(brackets.items()):
        for t in group:
            below = t.below + exact[f"lt{i}"]
            upto_low = below + exact[f"lo{i}"]
            inside = exact[f"in{i}"]
            upto_high = upto_low + inside + (exact[f"hi{i}"] if high > low else 0)
            if below <= t.index < upto_low:
                t.answer = low
            elif upto_low <= t.index < upto_low + inside:
                t.low, t.high, t.below, t.inside = low, high, upto_low, inside
            elif upto_low + inside <= t.index < upto_high:
                t.answer = high
            elif t.index < below:
                t.high, t.inside = low, exact[f"lt{i}"]
            else:
                t.low, t.inside = high, t.below + t.inside - upto_high
                t.below = upto_high


def exact_quantiles(
    df: DataFrame, cols: list[str], probs: tuple[float, ...], scale: Scale = Scale(), accuracy: int = 10_000
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of whole columns, exact at any size.

    Small tables use the built-in ``percentile``, which keeps all distinct values in one
    task. Larger ones are narrowed: approximate quantiles bracket each wanted order
    statistic, exact counts say where it lies, and only the few values strictly inside the
    bracket go on. The driver sees a handful of numbers per column. A column without any value has
    quantiles None.
    """
    sizes = df.agg(*[F.count(c).alias(c) for c in cols]).first()
    if max(sizes) <= scale.percentile_rows:
        row = df.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in cols]).first()
        return {c: list(row[c] or [None] * len(probs)) for c in cols}

    wanted: dict[tuple[str, int], _Target] = {}
    filled = [c for c in cols if sizes[c]]
    for c in filled:
        for p in probs:
            at = p * (sizes[c] - 1)
            for index in {floor(at), min(floor(at) + 1, sizes[c] - 1)}:
                wanted[c, index] = _Target(c, index, inside=sizes[c])
    while True:
        large = [t for t in wanted.values() if t.answer is None and t.inside > scale.quantile_rest]
        if not large:
            break
        _narrow(df, large, accuracy)
    rest = [t for t in wanted.values() if t.answer is None]
    if rest:
        # at most ``quantile_rest`` values per target are left
        lists = df.agg(
            *[F.sort_array(F.collect_list(F.when(t.interior(), F.col(t.col))))[t.index - t.below] for t in rest]
        ).first()
        for t, value in zip(rest, lists):
            t.answer = value

    def interpolate(c: str, p: float) -> float:
        at = p * (sizes[c] - 1)
        i = floor(at)
        a = wanted[c, i].answer
        b = wanted[c, min(i + 1, sizes[c] - 1)].answer
        return a + (b - a) * (at - i)

    return {c: [interpolate(c, p) if sizes[c] else None for p in probs] for c in cols}
