"""Impossible travel: two places on one day that are farther apart than a limit.

The farthest pair of a day is not searched among all pairs. The extents of its points along a
few directions bound it from both sides, in one grouped pass; that settles a day unless its
points fill an area close to the limit. For such days a second pass along directions of the
plane at their middle leaves a range of one per cent open. In what is still left only points
that can end a farthest pair are kept: first the northernmost and southernmost of each meridian, then the corners of
the convex hulls of pieces. What is left is compared block by block.
"""

from __future__ import annotations

import sys
from functools import reduce
from math import cos, pi, sin, sqrt

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lynxrisk.functions.expr import EARTH_KM, at_most, haversine_km
from lynxrisk.sources.session import settle

# how many points of one group a task reduces at once, and how many corners a task compares with as many others
PIECE_POINTS = 50_000
BLOCK_POINTS = 4_000

# up to this size a group is compared pair by pair within its row
FEW_POINTS = 100

# the axes, face diagonals and body diagonals of a cube
DIRECTIONS = [
    (1, 0, 0), (0, 1, 0), (0, 0, 1),
    (1, 1, 0), (1, -1, 0), (1, 0, 1), (1, 0, -1), (0, 1, 1), (0, 1, -1),
    (1, 1, 1), (1, 1, -1), (1, -1, 1), (-1, 1, 1),
]
# every line in space makes an angle with one of them whose cosine is at least 1 / 1.1281
NEAREST_DIRECTION = 0.886

# directions in the plane at the middle of a group, for days that the first bounds leave open
FLAT_DIRECTIONS = 16

# the two small functions below travel with the task, so workers need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _unit(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    la, lo = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], axis=1)


def hull_corners(pdf: pd.DataFrame) -> pd.DataFrame:
    """Corners of the convex hull on the sphere; the points must lie well within a hemisphere.

    In the projection from the centre of the earth great circles are straight lines, so this
    is the hull in the plane.
    """
    if len(pdf) < 4:
        return pdf
    xyz = _unit(pdf["_lat"].to_numpy(), pdf["_lon"].to_numpy())
    up = xyz.mean(axis=0)
    up /= np.linalg.norm(up)
    east = np.cross(up, np.eye(3)[np.argmin(np.abs(up))])
    east /= np.linalg.norm(east)
    height = xyz @ up
    u, v = (xyz @ east) / height, (xyz @ np.cross(up, east)) / height
    order = np.lexsort((v, u))

    def half(indices) -> list[int]:
        chain: list[int] = []
        for i in indices:
            while len(chain) > 1:
                o, a = chain[-2], chain[-1]
                if (u[a] - u[o]) * (v[i] - v[o]) - (v[a] - v[o]) * (u[i] - u[o]) > 0:
                    break
                chain.pop()
            chain.append(i)
        return chain

    corners = sorted(set(half(order)) | set(half(order[::-1])))
    return pdf.iloc[corners]


def any_pair_beyond(points: np.ndarray, others: np.ndarray, km: float) -> bool:
    """Whether a point and one of the others (unit vectors) are farther apart than ``km``; chords are as good as arcs."""
    limit = (2 * np.sin(min(km / EARTH_KM, np.pi) / 2)) ** 2
    for start in range(0, len(points), 512):
        part = points[start : start + 512]
        # summed by component: exact for near points, where a scalar product would cancel
        if (sum((part[:, None, i] - others[None, :, i]) ** 2 for i in range(3)) > limit).any():
            return True
    return False


def _on_sphere(located: DataFrame, *kept: str) -> DataFrame:
    """The points as unit vectors ``_x``, ``_y``, ``_z``."""
    la, lo = F.radians("_lat"), F.radians("_lon")
    return located.select(
        *kept, (F.cos(la) * F.cos(lo)).alias("_x"), (F.cos(la) * F.sin(lo)).alias("_y"), F.sin(la).alias("_z")
    )


def _widths(located: DataFrame, keys: list[str]) -> DataFrame:
    """Per group: the extent of its points along 13 directions, as chords of the unit sphere,
    and the middle of its box.

    Only minima and maxima of numbers, which every map task folds into one row per group.
    """
    along = {
        f"_d{i}": sum((F.col(f"_{axis}") * step for axis, step in zip("xyz", d) if step), F.lit(0.0)) / sqrt(sum(map(abs, d)))
        for i, d in enumerate(DIRECTIONS)
    }
    # one point without a latitude or longitude has NULL in both terms that need it
    complete = F.col("_x").isNotNull() & F.col("_z").isNotNull()
    inside = {name: F.when(complete, v) for name, v in along.items()}
    extents = [(F.max(v) - F.min(v)).alias(name) for name, v in inside.items()]
    middle = [((F.max(inside[f"_d{i}"]) + F.min(inside[f"_d{i}"])) / 2).alias(f"_c{axis}") for i, axis in enumerate("xyz")]
    return _on_sphere(located, *keys).groupBy(*keys).agg(F.count_if(complete).alias("_n"), *extents, *middle)


def _flat_widths(located: DataFrame, keys: list[str]) -> DataFrame:
    """The widest extent along ``FLAT_DIRECTIONS`` directions of the plane that touches the
    sphere at the middle of the group."""
    c = {axis: F.col(f"_c{axis}") for axis in "xyz"}
    length = F.sqrt(c["x"] * c["x"] + c["y"] * c["y"] + c["z"] * c["z"])
    c = {axis: v / length for axis, v in c.items()}
    # east of the middle; at a pole any direction serves
    flat = F.sqrt(c["x"] * c["x"] + c["y"] * c["y"])
    polar = flat < 1e-9
    ex = F.when(polar, F.lit(1.0)).otherwise(-c["y"] / flat)
    ey = F.when(polar, F.lit(0.0)).otherwise(c["x"] / flat)
    east = F.col("_x") * F.col("_ex") + F.col("_y") * F.col("_ey")
    north = (
        F.col("_z") * (F.col("_mx") * F.col("_ey") - F.col("_my") * F.col("_ex"))
        + F.col("_mz") * (F.col("_y") * F.col("_ex") - F.col("_x") * F.col("_ey"))
    )
    framed = _on_sphere(located, *keys, "_n", *[v.alias(f"_m{a}") for a, v in c.items()], ex.alias("_ex"), ey.alias("_ey"))
    plane = framed.select(*keys, "_n", east.alias("_u"), north.alias("_v"))
    turns = [pi * i / FLAT_DIRECTIONS for i in range(FLAT_DIRECTIONS)]
    along = [F.col("_u") * cos(t) + F.col("_v") * sin(t) for t in turns]
    return plane.groupBy(*keys).agg(
        F.max("_n").alias("_n"), *[(F.max(v) - F.min(v)).alias(f"_w{i}") for i, v in enumerate(along)]
    ).select(*keys, "_n", F.greatest(*[f"_w{i}" for i in range(FLAT_DIRECTIONS)]).alias("_widest"))


def _arc_km(chord: Column) -> Column:
    return F.asin(at_most(chord / 2, 1.0)) * (2 * EARTH_KM)


def _verdict(df: DataFrame, least: Column, most: Column, km: float, *kept: str) -> DataFrame:
    """``_far`` from a lower bound of the diameter, ``_near`` from an upper one; a margin of a
    millimetre covers rounding in the two."""
    return df.select(
        *kept,
        F.coalesce(_arc_km(least) > km + 1e-6, F.lit(False)).alias("_far"),
        F.coalesce(_arc_km(most) <= km - 1e-6, F.lit(True)).alias("_near"),
    )


def impossible_travel(
    points: DataFrame, key: str, day: str, lat: str, lon: str, km: float = 500.0, out: str = "impossible"
) -> DataFrame:
    """One row per key and day with points: is any pair farther apart than ``km``?"""
    keys = [key, day]
    middle = ["_cx", "_cy", "_cz"]
    located = points.select(
        *keys, F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon")
    )
    widest = F.greatest(*[F.col(f"_d{i}") for i in range(len(DIRECTIONS))])
    box = F.sqrt(sum(F.col(f"_d{i}") * F.col(f"_d{i}") for i in range(3)))
    most = F.least(box, widest / NEAREST_DIRECTION)
    days = settle(_verdict(_widths(located, keys), widest, most, km, *keys, "_n", *middle))
    undecided = ~F.col("_far") & ~F.col("_near")
    open_days = days.filter(undecided)
    if open_days.isEmpty():
        return days.select(*keys, F.col("_far").alias(out))

    complete = located.filter(F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
    rest = settle(complete.join(open_days.select(*keys, "_n", *middle), keys))
    # an open day lies within this angle of its middle; a chord of it makes at most the same
    # angle with the plane there
    reach = km / EARTH_KM
    cover = cos(reach) * cos(pi / (2 * FLAT_DIRECTIONS)) if reach < 0.5 else 0.0
    flat = _flat_widths(rest, keys)
    upper = F.col("_widest") / cover if cover else F.lit(2.0)
    finer = settle(_verdict(flat, F.col("_widest"), upper, km, *keys, "_n"))
    decided = [finer.filter("_far").select(*keys, F.lit(True).alias("_pair"))]
    for size, decide in ((F.col("_n") <= FEW_POINTS, _decide_few), (F.col("_n") > FEW_POINTS, _decide_many)):
        part = finer.filter(undecided & size).select(*keys)
        if not part.isEmpty():
            decided.append(decide(rest.join(part, keys, "left_semi"), keys, km))
    pairs = reduce(DataFrame.unionByName, decided)
    return days.join(pairs, keys, "left").select(
        *keys, (F.col("_far") | F.coalesce("_pair", F.lit(False))).alias(out)
    )


def _decide_few(points: DataFrame, keys: list[str], km: float) -> DataFrame:
    """Groups of at most ``FEW_POINTS`` points: every point against every other, in place."""
    beyond = lambda a, b: haversine_km(a["_lat"], a["_lon"], b["_lat"], b["_lon"]) > km
    pair = F.exists("_points", lambda a: F.exists("_points", lambda b: beyond(a, b)))
    return (
        points.groupBy(*keys)
        .agg(F.collect_list(F.struct("_lat", "_lon")).alias("_points"))
        .select(*keys, pair.alias("_pair"))
    )


def _decide_many(points: DataFrame, keys: list[str], km: float) -> DataFrame:
    """Larger groups: pieces are reduced to the corners of their hulls, and corners are compared block by block.

    The farthest pair of a group are corners of the hulls of their pieces, however it is cut. A task holds one piece, or
    two blocks of corners; each pair of blocks is a group of its own, so a day whose points are all corners
    (a ring) is spread over many tasks.
    """
    corners = (
        points.groupBy(*keys, "_lon")
        .agg(F.max("_n").alias("_n"), F.array_distinct(F.array(F.min("_lat"), F.max("_lat"))).alias("_ends"))
        .select(*keys, "_n", "_lon", F.explode("_ends").alias("_lat"))
    )
    schema = ", ".join(f"{k} {points.schema[k].dataType.simpleString()}" for k in keys)
    columns = [*keys, "_lon", "_lat"]
    piece = F.pmod(F.xxhash64("_lon"), F.ceil(F.col("_n") / PIECE_POINTS))
    corners = settle(
        corners.groupBy(*keys, piece.alias("_piece")).applyInPandas(
            lambda pdf: hull_corners(pdf)[columns], f"{schema}, _lon double, _lat double"
        )
    )
    sizes = corners.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK_POINTS).alias("_blocks"))
    cut = corners.join(sizes, keys).withColumn("_block", F.pmod(F.xxhash64("_lat", "_lon"), F.col("_blocks")))
    met = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    pairs = met.withColumn("_a", F.least("_block", "_other")).withColumn("_b", F.greatest("_block", "_other"))

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        xyz = _unit(pdf["_lat"].to_numpy(), pdf["_lon"].to_numpy())
        first = (pdf["_block"] == pdf["_a"]).to_numpy()
        others = xyz if pdf["_a"].iloc[0] == pdf["_b"].iloc[0] else xyz[~first]
        return pdf[keys].head(1).assign(_pair=any_pair_beyond(xyz[first], others, km))

    compared = pairs.groupBy(*keys, "_a", "_b").applyInPandas(decide, f"{schema}, _pair boolean")
    return compared.groupBy(*keys).agg(F.bool_or("_pair").alias("_pair"))
