import random

import pytest
from pyspark.sql import functions as F

from lynxrisk.config import Scale
from lynxrisk.operators import ordering as O
from lynxrisk.operators import ranking as R
from tests.conftest import TINY


@pytest.fixture(scope="module")
def rows():
    """A third of the rows belong to one key; times repeat."""
    rng = random.Random(5)
    return [(0 if rng.random() < 0.34 else rng.randrange(1, 40), rng.randrange(100), n, rng.randrange(50)) for n in range(1500)]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "k int, t int, id int, v int")


def by_key(rows):
    keys = {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        keys.setdefault(k, []).append((i, v))
    return keys


@pytest.mark.parametrize("scale", [Scale(), TINY])
def test_running_sum(table, rows, scale):
    expect = {}
    for members in by_key(rows).values():
        total = 0
        for i, v in members:
            total += v
            expect[i] = total
    got = O.running_sum(table, "v", ["k"], ["t", "id"], "s", scale)
    assert {r.id: r.s for r in got.collect()} == expect


@pytest.mark.parametrize("scale", [Scale(), TINY])
def test_sliding_frame(table, rows, scale):
    expect = {}
    for members in by_key(rows).values():
        for n, (i, _) in enumerate(members):
            expect[i] = sum(v for _, v in members[max(0, n - 29): n + 1])
    got = O.sliding(table, {"s": F.sum("v")}, ["k"], ["t", "id"], 29, scale)
    assert {r.id: r.s for r in got.collect()} == expect
    assert got.count() == len(rows)


def test_row_index(table, rows):
    expect = {i: n + 1 for members in by_key(rows).values() for n, (i, _) in enumerate(members)}
    got = O.row_index(table, ["k"], ["t", "id"], "n")
    assert {r.id: r.n for r in got.collect()} == expect


def test_running_sum_with_nulls_and_null_keys(spark):
    rows = [(None, n, float(n)) for n in range(9)] + [(1, n, None if n % 2 else 1.0) for n in range(9)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    plain = O.running_sum(df, "v", ["k"], ["t"], "s")
    cut = O.running_sum(df, "v", ["k"], ["t"], "s", TINY)
    assert plain.exceptAll(cut.select(plain.columns)).count() == 0


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(6)
    values = [0.0 if rng.random() < 0.35 else round(rng.gauss(0, 1), 2) for _ in range(1500)]
    return values, spark.createDataFrame(list(enumerate(values)), "id int, x double")


def test_average_rank(scores):
    values, df = scores
    n = len(values)
    expect = {i: (sum(w < v for w in values) + (sum(w == v for w in values) + 1) / 2) / n * 100 for i, v in enumerate(values)}
    for r in R.percentile_rank_avg(df, "x", "p").collect():
        assert r.p == pytest.approx(expect[r.id], abs=1e-9)


def test_percent_rank(scores):
    values, df = scores
    for r in R.percent_rank(df, "x", "p").collect():
        assert r.p == pytest.approx(sum(w < values[r.id] for w in values) / (len(values) - 1), abs=1e-12)


def test_ranks_of_few_rows(spark):
    one = spark.createDataFrame([(1, 5.0)], "id int, x double")
    assert R.percentile_rank_avg(one, "x", "p").first().p == 100.0
    assert R.percent_rank(one, "x", "p").first().p == 0.0
    nulls = spark.createDataFrame([(1, None), (2, 1.0)], "id int, x double")
    assert {r.id: r.p for r in R.percentile_rank_avg(nulls, "x", "p").collect()} == {1: None, 2: 100.0}


def test_ranks_of_one_frequent_value_and_nan(spark):
    values = [1.0] * 990 + [0.5, 2.0, 2.0, 3.0, float("nan"), float("nan")]
    df = spark.createDataFrame(list(enumerate(values)), "id int, x double")
    n = len(values)
    key = lambda v: float("inf") if v != v else v
    for r in R.percentile_rank_avg(df, "x", "p").collect():
        v = key(values[r.id])
        below, ties = sum(key(w) < v for w in values), sum(key(w) == v for w in values)
        assert r.p == pytest.approx((below + (ties + 1) / 2) / n * 100)
    plan = R.percent_rank(df, "x", "p")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert R.percentile_rank_avg(df.limit(0), "x", "p").count() == 0


def test_running_sum_of_zeros_then_nulls(spark):
    df = spark.createDataFrame([(1, n, 0.0 if n < 30 else None) for n in range(60)] + [(2, n, None) for n in range(40)], "k int, t int, v double")
    plain = O.running_sum(df, "v", ["k"], ["t"], "s")
    cut = O.running_sum(df, "v", ["k"], ["t"], "s", TINY).select(plain.columns)
    assert plain.exceptAll(cut).count() == 0 and cut.exceptAll(plain).count() == 0
    assert cut.filter("s IS NULL").count() == 40


def test_tier_rules(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 2.0), (4, 3.0)], "id int, x double")
    ranked = R.percentile_rank_avg(df, "x", "p").withColumn("tier", R.percentile_tier("p"))
    assert [(r.p, r.tier) for r in ranked.orderBy("id").collect()] == [
        (37.5, "LOW"), (37.5, "LOW"), (75.0, "LOW"), (100.0, "HIGH")
    ]
    shares = R.percent_rank(df, "x", "p").withColumn("tier", R.percent_rank_tier("p"))
    assert [r.tier for r in shares.orderBy("id").collect()] == ["LOW", "LOW", "LOW", "HIGH"]


@pytest.mark.parametrize("accuracy", [20, 100])
def test_exact_quantiles(scores, accuracy):
    values, df = scores
    probs = (0.01, 0.25, 0.33, 0.5, 0.99, 1.0)
    expect = []
    ordered = sorted(values)
    for p in probs:
        at = p * (len(ordered) - 1)
        i = int(at)
        j = min(i + 1, len(ordered) - 1)
        expect.append(ordered[i] + (ordered[j] - ordered[i]) * (at - i))
    assert R.exact_quantiles(df, ["x"], probs, TINY, accuracy)["x"] == pytest.approx(expect, abs=1e-12)
    assert R.exact_quantiles(df, ["x"], probs)["x"] == pytest.approx(expect, abs=1e-12)


def test_exact_quantiles_of_a_constant(spark):
    df = spark.range(50).select(F.lit(2.0).alias("x"))
    assert R.exact_quantiles(df, ["x"], (0.01, 0.99), TINY, 20) == {"x": [2.0, 2.0]}
