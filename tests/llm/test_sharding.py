import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lynxrisk.llm import sharding

from .helpers import clashing, docs


def exact(total, marked, drawn):
    low, high = max(0, drawn - (total - marked)), min(marked, drawn)
    return {x: math.comb(marked, x) * math.comb(total - marked, drawn - x) / math.comb(total, drawn) for x in range(low, high + 1)}


@pytest.mark.parametrize("total, marked, drawn", [(10, 4, 3), (10, 9, 8), (50, 25, 20), (7, 7, 3), (7, 0, 3), (200, 3, 150), (1000, 400, 100)])
def test_variates_have_the_exact_distribution(spark, total, marked, drawn):
    n = 20_000
    table = spark.range(n).selectExpr(f"{total}L AS t", f"{marked}L AS k", f"{drawn}L AS d", f"(id + 0.5D) / {n} AS u")
    got = Counter(r[0] for r in table.selectExpr(sharding.hypergeometric("t", "k", "d", "u")).collect())
    want = exact(total, marked, drawn)
    assert set(got) <= set(want)
    assert all(abs(got[x] / n - p) <= 2 / n for x, p in want.items())


def test_log_factorial(spark):
    for x in (0, 1, 2, 9, 10, 170, 10**6):
        assert spark.range(1).selectExpr(sharding.log_factorial(f"{x}D")).first()[0] == pytest.approx(math.lgamma(x + 1), abs=1e-9 * max(1, x))


@pytest.mark.parametrize("sizes, shards", [([5, 0, 7, 30, 1, 2, 9], [18, 18, 18]), ([100], [50, 50]), ([3, 4], [7]), ([0], [0, 0]), ([1] * 40, [10] * 4)])
def test_matrix_has_its_margins(spark, sizes, shards):
    table = spark.createDataFrame(list(enumerate(sizes)), "block long, n long")
    rows = sorted(sharding.communication_matrix(table, shards, 1).collect())
    assert [r.block for r in rows] == list(range(len(sizes)))
    matrix = np.array([r.counts for r in rows])
    assert (matrix >= 0).all() and matrix.sum(axis=1).tolist() == sizes and matrix.sum(axis=0).tolist() == shards


def test_matrix_follows_the_law_of_a_permutation(spark):
    sizes, shards, n = [6, 4, 5], [5, 5, 5], 300
    table = spark.createDataFrame(list(enumerate(sizes)), "block long, n long")
    drawn = np.array([[r.counts for r in sorted(sharding.communication_matrix(table, shards, s).collect())] for s in range(n // 10)])
    assert abs(drawn.mean(axis=0) - np.outer(sizes, shards) / 15).max() < 0.8


def placed(spark, table, **options):
    return sharding.shuffle_to_shards(table, **options)


def check(rows, n, shards):
    per_shard = Counter(r.shard for r in rows)
    sizes = [per_shard.get(j, 0) for j in range(shards)]
    assert len(rows) == n and sum(sizes) == n and max(sizes) - min(sizes) <= 1
    for j in range(shards):
        assert sorted(r.slot for r in rows if r.shard == j) == list(range(sizes[j]))


@pytest.mark.parametrize("block_rows", [50_000, 60, 11])
def test_exact_sizes_and_every_row_once(spark, block_rows):
    table = docs(spark, [(i, f"text {i % 400}") for i in range(1003)]).repartition(5)
    rows = placed(spark, table, shards=7, block_rows=block_rows).collect()
    check(rows, 1003, 7)
    assert sorted(r.doc_id for r in rows) == list(range(1003))
    again = placed(spark, table.repartition(2), shards=7, block_rows=block_rows).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in rows) == sorted((r.doc_id, r.shard, r.slot) for r in again)


def test_shuffle_is_uniform(spark):
    """Neighbouring ids land in all shards and places alike (chi-squared over several seeds)."""
    n, shards = 240, 4
    table = docs(spark, [(i, "x") for i in range(n)])
    counts = np.zeros((4, shards))
    slots = []
    for seed in range(0, 50, 5):
        for r in placed(spark, table, shards=shards, seed=seed, block_rows=40).collect():
            counts[r.doc_id * 4 // n, r.shard] += 1
            slots.append((r.doc_id, r.slot))
    expected = n * 10 / 16
    assert ((counts - expected) ** 2 / expected).sum() < 30  # 9 degrees of freedom, p < 0.0005
    assert abs(np.corrcoef(np.array(slots).T)[0, 1]) < 0.08


def test_edges(spark):
    rows = [(1, None), (None, None), (None, "x"), (2, ""), (3, "same"), (3, "same"), (4, "long " * 50_000)]
    table = clashing(docs(spark, rows))
    got = placed(spark, table, shards=3)
    assert got.columns == [c for c in table.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    check(got.collect(), len(rows), 3)
    back = got.select("doc_id", "text", "source")
    assert back.exceptAll(table.select("doc_id", "text", "source")).count() == 0
    assert placed(spark, docs(spark, []), shards=3).count() == 0
    check(placed(spark, docs(spark, [(1, "one")]), shards=40).collect(), 1, 40)


def test_one_third_equal_rows(spark):
    table = docs(spark, [(i if i % 3 else 0, "t" if i % 3 == 0 else f"{i}") for i in range(600)])
    check(placed(spark, table, shards=5, block_rows=50).collect(), 600, 5)


def test_no_python_in_the_plan(spark):
    plan = placed(spark, docs(spark, [(1, "a")]), shards=2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and F
