"""Tasks of sorts, windows and groupings hold a bounded number of rows, whatever the size of the table."""

import contextlib
import io
import math
import random

from pyspark.sql import functions as F

from lynxrisk.config import Scale
from lynxrisk.operators.grid import dense_grid, gather
from lynxrisk.operators.ordering import SLICE, sorted_slices, spread
from lynxrisk.operators.point_in_time import _sweep, changes_of
from lynxrisk.operators.ranking import with_ranks
from lynxrisk.plans.reports import gold_stats
from tests.conftest import day


def test_rows_of_a_task(spark):
    df = spark.range(1000)
    assert spread(df, 1000, ["id"], Scale(task_rows=20)).rdd.getNumPartitions() == 50
    assert spread(df, 100, ["id"], Scale(task_rows=20)) is df
    parts = [df.withColumn("a", F.lit(1)), df.withColumn("b", F.lit(2))]
    joined = gather(parts, ["id"], rows=10_000_000)
    assert joined.rdd.getNumPartitions() == 40 and joined.filter("a = 1 AND b = 2").count() == 1000


def test_ranges_are_not_tiny(spark):
    slices = sorted_slices(spark.range(2000), [], ["id"], 1000, 2000)
    assert 8 <= slices.select(SLICE).distinct().count() <= 32


def test_grid_of_one_file_is_dealt_out(spark):
    ends = F.sequence(F.lit(day(1)), F.lit(day(5)))
    grid = dense_grid(spark.range(100).select(F.col("id").alias("employee_id")).coalesce(1), ends, scale=Scale(task_rows=25))
    assert grid.count() == 500 and grid.rdd.getNumPartitions() == 20


def test_ranks_of_frequent_and_rare_values(spark):
    rng = random.Random(5)
    values = [1.5] * 4000 + [-0.0] * 30 + [0.0] * 40 + [float("nan")] * 3 + [None] * 5 + [rng.choice([rng.random(), 0.25]) for _ in range(2000)]
    rng.shuffle(values)
    got = with_ranks(spark.createDataFrame(list(enumerate(values)), "i int, x double").repartition(5), "x").collect()
    assert len(got) == len(values)
    order = sorted((math.inf if v != v else v) for v in values if v is not None)
    first, ties = {}, {}
    for at, v in enumerate(order):
        first.setdefault(v, at)
        ties[v] = ties.get(v, 0) + 1
    for r in got:
        key = values[r.i] if values[r.i] is None or values[r.i] == values[r.i] else math.inf
        want = (None, None, None) if key is None else (first[key], ties[key], len(order))
        assert (r._below, r._ties, r._n) == want


def test_periods_of_a_key_go_on_over_batches(spark):
    rng = random.Random(3)
    rows = [(k, f"E{rng.randrange(4)}", day(s), day(s + rng.randrange(5))) for k in range(30) for s in rng.sample(range(1, 40), 7)]
    register = spark.createDataFrame(rows, "k int, who string, s date, t date")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 3)
    try:
        changes = changes_of(register, "k", "s", "t", "who")
        got = sorted((r._key, r._day, r.who) for r in changes.collect())
    finally:
        spark.conf.set(name, before)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        changes.explain()
    assert "MapInPandas" in text.getvalue() and "FlatMapGroups" not in text.getvalue()  # no group for each key
    number = lambda d: (d - day(1)).days + (day(1).toordinal() - 719163)
    want = []
    for k in range(30):
        periods = {(number(s), number(t)): max(w for _, w, a, b in rows if (_, a, b) == (k, s, t)) for q, _, s, t in rows if q == k}
        want += [(k, *change) for change in _sweep([(s, t, w) for (s, t), w in periods.items()])]
    assert got == sorted(want, key=lambda c: (c[0], c[1]))


def test_distinct_counts_do_not_multiply_rows(spark):
    gold = spark.createDataFrame([("a", day(1), "r", day(1)), ("a", day(2), "r", day(1)), (None, day(2), "r", day(1))],
                                 "employee_id string, window_end_date date, model_run_id string, scored_at date")
    stats = gold_stats(gold)
    assert stats.first()[:4] == (3, 1, 2, "r")
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        stats.explain()
    assert "Expand" not in text.getvalue()
