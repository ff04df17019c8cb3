"""Exact top-k search over binary codes by incremental multi-index hashing.

A code of 64 bits has four segments of 16. If two codes differ in at most 4r + a bits (a < 4), then they differ in at most r bits in
one of the first a + 1 segments, or in fewer than r bits in one of the others. So the search radius of one segment after the other
grows by one; after each step all codes up to a known distance have been met and verified, and a query ends as soon as its k-th
verified distance is covered.

Rows are cut into blocks by a hash; each block is an index of bounded size that one task builds. Queries are a stated set (rows whose
id is divisible by 50 by default), cut into blocks too; each pair of blocks is one task's work, and gives k rows for each query, which
are merged. Blocks meet by shuffle, so neither side has to fit anywhere whole.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.llm.common import settle

BITS, SEGMENTS = 64, 4
WIDTH = BITS // SEGMENTS
INDEX_ROWS, QUERY_ROWS = 1 << 16, 1 << 11
_FLIPS: dict[int, np.ndarray] = {}


def flips(radius: int) -> np.ndarray:
    """All 16-bit masks with so many bits set."""
    if radius not in _FLIPS:
        _FLIPS[radius] = np.array([sum(1 << b for b in c) for c in combinations(range(WIDTH), radius)], dtype=np.int64)
    return _FLIPS[radius]


class Index:
    """Tables of one block of codes: for each segment, rows ordered by its value, and where each value starts."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        self.codes, self.ids = codes, ids
        self.tables = []
        for j in range(SEGMENTS):
            value = ((codes >> np.uint64(j * WIDTH)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << WIDTH))])
            self.tables.append((np.argsort(value, kind="stable"), starts))

    def search(self, code: np.uint64, k: int, without: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest rows by distance, then id; rows with the id ``without`` don't count."""
        met = np.zeros(len(self.codes), dtype=bool)
        at_distance = np.zeros(BITS + 1, dtype=np.int64)
        rows, distances = [], []
        found = 0
        for step in range(SEGMENTS * (WIDTH + 1)):
            radius, j = divmod(step, SEGMENTS)
            order, starts = self.tables[j]
            probes = (int(code) >> j * WIDTH & (1 << WIDTH) - 1) ^ flips(radius)
            first, size = starts[probes], starts[probes + 1] - starts[probes]
            hit = size > 0
            first, size = first[hit], size[hit]
            if len(first):
                places = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                new = order[places]
                new = new[~met[new]]
                met[new] = True
                found += len(new)
                new = new[self.ids[new] != without]
                distance = np.bitwise_count(self.codes[new] ^ code)
                at_distance += np.bincount(distance, minlength=BITS + 1)
                rows.append(new)
                distances.append(distance)
            if at_distance[: step + 1].sum() >= k or found == len(self.codes):
                break
        if not rows:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
        row, distance = np.concatenate(rows), np.concatenate(distances)
        best = np.lexsort((self.ids[row], distance))[:k]
        return self.ids[row[best]], distance[best]


def sign_code(vector: Column) -> Column:
    """64 bits of a vector of 64 numbers: bit i is set if component i is above zero. Null for null and other lengths.

    A null or NaN component counts as not above zero.
    """
    bit = lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0))
    code = F.aggregate(F.transform(vector, bit), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when(F.size(vector) == BITS, code)


def nearest(codes: DataFrame, queries: DataFrame, k: int = 10, index_rows: int = INDEX_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, id, distance): for each query the k nearest codes, by Hamming distance, then id; rank from 1.

    ``codes`` and ``queries`` have columns id (long) and code (long). Rows without an id or a code are neither found nor asked for. A row is not its
    own neighbour: rows with the query's id are left out. With fewer than k other rows, all are returned. An id that is there twice is
    found twice; a repeated query is asked once for each different code.
    """
    codes = settle(codes.filter("id IS NOT NULL AND code IS NOT NULL").select("id", "code"))
    queries = settle(queries.filter("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct())
    blocks = max(1, math.ceil(codes.count() / index_rows))
    groups = max(1, math.ceil(queries.count() / query_rows))
    block = F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(blocks))
    group = F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(groups))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = codes.select("id", "code", block.cast("int").alias("block"), every(groups).alias("group"))
    right = queries.select("id", "code", every(blocks).alias("block"), group.cast("int").alias("group"))

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(asked):
            index = Index(rows["code"].to_numpy().view(np.uint64), rows["id"].to_numpy())
            for own, code in zip(asked["id"].to_numpy(), asked["code"].to_numpy().view(np.uint64), strict=True):
                ids, distances = index.search(code, k, own)
                out.append(pd.DataFrame({"query_id": own, "query_code": np.int64(code.view(np.int64)), "id": ids, "distance": distances.astype(np.int32)}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "query_code": [], "id": [], "distance": []}).astype("int64")

    found = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInPandas(search, "query_id long, query_code long, id long, distance int")
    order = Window.partitionBy("query_id", "query_code").orderBy("distance", "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "distance")
