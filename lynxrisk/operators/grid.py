"""Bringing partial tables together on common keys with a single shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lynxrisk.config import Scale
from lynxrisk.operators.ordering import session_parts, spread


def dense_grid(people: DataFrame, ends: Column, key: str = "employee_id", scale: Scale = Scale()) -> DataFrame:
    """Every key with every window end date. The keys are dealt out first: a file of them that one task reads makes many times its rows."""
    grid = lambda keys: keys.select(key, F.explode(ends).alias("window_end_date"))
    keys = people.select(key)
    parts = max(session_parts(keys), ceil(grid(keys).count() / scale.task_rows))
    return grid(keys.repartition(parts, key))


def gather(parts: Sequence[DataFrame], keys: Sequence[str], grid: DataFrame | None = None, rows: int = 0) -> DataFrame:
    """Full outer join of tables that are unique on ``keys``, as one union and one grouping; ``rows``: how many they have together, if known.

    With a ``grid`` only its keys are kept, as in left joins onto it. A chain of joins would
    shuffle the growing result again at each step; here every row moves once.
    """
    tables = list(parts) if grid is None else [*parts, grid.withColumn("_on_grid", F.lit(True))]
    columns = [c for t in tables for c in t.columns if c not in keys]
    if len(columns) != len(set(columns)):
        raise ValueError("the tables must not share columns besides the keys")
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    merged = spread(union, rows, keys).groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])
    return merged if grid is None else merged.filter("_on_grid").drop("_on_grid")


def enrich(df: DataFrame, updates: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """UPDATE ... FROM: matched rows take the new values (also NULL ones), others keep theirs."""
    new = updates.select(*keys, F.lit(True).alias("_matched"), *[F.col(c).alias(f"_new_{c}") for c in cols])
    joined = df.join(new, list(keys), "left")
    out = [
        F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ]
    added = [F.col(f"_new_{c}").alias(c) for c in cols if c not in df.columns]
    return joined.select(*out, *added)


def first_row_per(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per key: the one that is greatest in ``order``. A grouped maximum, not a window."""
    best = F.max(F.struct(*order, *[F.col(c).alias(f"_{c}") for c in cols])).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_best._{c}").alias(c) for c in cols])
