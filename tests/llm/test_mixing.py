import math
import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lynxrisk.llm import mixing

from .helpers import clashing, docs, words


def slow_targets(sizes, weights=(1, 2, 3), most=3.0):
    """Fill by weight, cap, and share the excess anew until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 40}, {"a": 1, "b": 1, "c": 98}, {"x": 7}, {"é": 3, "z": 0, "Z": 900, "b": 2, "c": 1, "d": 500}, {"a": 0}])
def test_targets_against_filling_by_hand(spark, sizes):
    table = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(table).collect()}
    want = slow_targets(sizes)
    assert got == {s: pytest.approx(want[s]) for s in sizes}


@pytest.mark.parametrize("ratio", [0.05, 0.3, 0.9])
def test_flight_keeps_totals_and_landing_keeps_expectations(ratio):
    rng = np.random.default_rng(6)
    tokens = np.append(sorted(rng.integers(1, 500, 58).astype(float), reverse=True), [0.0, 0.0])
    tokens[0] = 4000.0
    runs, moved = 2000, np.zeros(60)
    for _ in range(runs):
        p = np.full(60, ratio)
        mixing.flight(p, tokens, np.ones(60), rng.random)
        assert ((p > 0) & (p < 1)).sum() <= 2
        assert p @ tokens == pytest.approx(ratio * tokens.sum()) and p.sum() == pytest.approx(ratio * 60)
        mixing.land(p, tokens, rng.random)
        assert set(p) <= {0.0, 1.0}
        moved += p
    assert abs(moved / runs - ratio).max() < 4.5 * math.sqrt(ratio * (1 - ratio) / runs)


@pytest.mark.parametrize("sizes", [[5.0] * 40, [0.0] * 40, [9.0] + [0.0] * 30, [7.0, 7.0], [3.0], [], [1e6] + [1.0] * 50, [4.0, 2.0, 1.0], [8.0] + [2.0] * 9])
def test_flights_of_equal_empty_and_few_sizes(sizes):
    rng = np.random.default_rng(9)
    tokens, rows = np.array(sizes), rng.integers(1, 4, len(sizes)).astype(float)
    moved = np.zeros(len(sizes))
    for _ in range(800):
        p = np.full(len(sizes), 0.4)
        mixing.flight(p, tokens, rows, rng.random)
        assert ((p > 0) & (p < 1)).sum() <= 2
        assert p @ tokens == pytest.approx(0.4 * tokens.sum(), abs=1e-6) and p @ rows == pytest.approx(0.4 * rows.sum())
        mixing.land(p, tokens, rng.random)
        moved += p
    assert len(sizes) == 0 or abs(moved / 800 - 0.4).max() < 0.08


def test_every_document_has_its_ratio_over_seeds():
    rng = np.random.default_rng(7)
    tokens = rng.lognormal(5, 1, 300).round()
    rows = pd.DataFrame({"unit": rng.integers(-(2**62), 2**62, 300), "unit_too": 0, "tokens": tokens, "n": 1.0, "probability": 0.37})
    copies, off = np.zeros(300), []
    for seed in range(200):
        done = mixing._decide(rows, seed, last=True).set_index("unit").loc[rows["unit"]]
        copies += done["probability"].to_numpy()
        off.append(abs(done["probability"].to_numpy() @ tokens - 0.37 * tokens.sum()))
    assert abs(copies / 200 - 0.37).max() < 4.5 * math.sqrt(0.37 * 0.63 / 200)
    assert abs(copies[tokens.argmax()] / 200 - 0.37) < 0.12
    assert np.mean(off) < np.quantile(tokens, 0.2)


def random_docs(n=3000, seed=8):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        size = rng.choice([0, 1, 5, 20, 60, 150])
        out.append((i, f"d{i} " * size, "en", rng.choice(["a", "a", "a", "b", "c", "d", None])))
    return out


@pytest.mark.parametrize("block_rows", [8192, 2048, 500, 250])
def test_mix_comes_near_its_targets(spark, block_rows):
    rows = random_docs()
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(words(t))
    got = mixing.mix(docs(spark, rows), block_rows=block_rows).collect()
    want, taken, count, n = slow_targets(dict(sizes)), defaultdict(int), defaultdict(int), defaultdict(int)
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    for r in got:
        assert r.size == len(words(rows[r.doc_id][1])) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        ratio = r.target / r.source_size
        assert r.copies in (math.floor(ratio), math.floor(ratio) + 1) and r.copies <= 3
        taken[r.source] += r.size * r.copies
        count[r.source] += r.copies
        n[r.source] += 1
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 10
        assert abs(count[s] - n[s] * want[s] / sizes[s]) <= 12


def test_reruns_and_layouts_agree(spark):
    rows = random_docs(800)
    first = mixing.mix(docs(spark, rows), block_rows=250).select("doc_id", "copies")
    again = mixing.mix(docs(spark, rows[::-1]).repartition(7), block_rows=250).select("doc_id", "copies")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_take_repeats_rows(spark):
    table = clashing(docs(spark, random_docs(300)))
    mixed = {r.doc_id: r.copies for r in mixing.mix(docs(spark, random_docs(300))).collect()}
    taken = mixing.take(table)
    assert taken.columns == table.columns
    assert {r.doc_id: r.n for r in taken.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == {d: c for d, c in mixed.items() if c}


def test_edges(spark):
    rows = [(1, None, "en", "a"), (None, "b c d", "en", None), (2, "x " * 100_000, "en", "b"), (3, "same row", "en", "b"), (3, "same row", "en", "b"), (4, "", "en", "empty")]
    got = mixing.mix(clashing(docs(spark, rows))).collect()
    assert sorted((r.doc_id or -1, r.size, r.source_size) for r in got) == [(-1, 3, 3), (1, 0, 0), (2, 100_000, 100_004), (3, 2, 100_004), (3, 2, 100_004), (4, 0, 0)]
    assert all(r.copies == 0 for r in got if not r.source_size)
    assert len({r.copies for r in got if r.doc_id == 3}) == 1
    assert mixing.mix(docs(spark, [])).count() == 0
