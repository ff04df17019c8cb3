import random

from lynxrisk.llm import hamming_search as search


def brute(rows, asked, k):
    out = set()
    for q, code in set(asked):
        found = sorted((bin((code ^ c) % 2**64).count("1"), i) for i, c in rows if i != q)
        out |= {(q, n + 1, i, d) for n, (d, i) in enumerate(found[:k])}
    return out


def run(spark, rows, asked, k, **options):
    codes, queries = (spark.createDataFrame(x, "id long, code long") for x in (rows, asked))
    return {tuple(r) for r in search.nearest(codes, queries, k, **options).collect()}


def test_against_brute_force_in_blocks(spark):
    rng = random.Random(7)
    rows = [(i, rng.getrandbits(64) - 2**63) for i in range(300)]
    rows += [(300 + i, rows[i % 20][1] ^ (1 << rng.randrange(60))) for i in range(100)]
    rows += [(400 + i, rows[0][1]) for i in range(30)]  # ties
    asked = [r for r in rows if r[0] % 17 == 0]
    want = brute(rows, asked, 10)
    assert run(spark, rows, asked, 10) == want
    assert run(spark, rows, asked, 10, index_rows=60, query_rows=5) == want


def test_radius_covers_what_it_must():
    import numpy as np

    rng = np.random.default_rng(3)
    codes = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    index = search.Index(codes, np.arange(2000))
    for i in range(0, 2000, 100):
        ids, distances = index.search(codes[i], 5, i)
        far = np.bitwise_count(codes ^ codes[i]).astype(int)
        far[i] = 99
        assert distances.tolist() == sorted(far)[:5]


def test_edges(spark):
    rows = [(1, 5), (1, 5), (2, 5), (3, None), (None, 5), (4, -1)]
    assert run(spark, rows, [(1, 5), (1, 5), (None, 5), (9, None)], 10) == {(1, 1, 2, 0), (1, 2, 4, 62)}
    assert run(spark, [], [(1, 5)], 10) == set()
    assert run(spark, rows, [], 10) == set()


def test_sign_code(spark):
    vectors = [[1.0] * 64, [-1.0] * 64, [0.0] * 63 + [2.0], [None, float("nan")] + [1.0] + [0.0] * 61, [1.0], None]
    table = spark.createDataFrame([(v,) for v in vectors], "v array<float>")
    got = [r[0] for r in table.select(search.sign_code(table.v)).collect()]
    assert got == [-1, 0, -(2**63), 4, None, None]
