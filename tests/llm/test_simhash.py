import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from lynxrisk.llm import simhash
from lynxrisk.llm.components import components

from .helpers import clashing, docs, groups, words

LOWER = {c: c + 32 for c in range(65, 91)}


def slow_fingerprint(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_is_that_of_the_contract():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "One two", "a b c", "ÀÉ É x\x0by\x0cz", "a b c d"]
    texts += [" ".join(rng.choice("the of And TO in x y é ß 中".split()) for _ in range(n)) for n in (3, 4, 50, 400)]
    for t in texts:
        assert simhash.fingerprint_text(t) == slow_fingerprint(t)


def test_hash_is_sparks_own(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("the quick föx")).alias("h")).first()
    assert row.h % 2**64 == xxhash.xxh64("the quick föx".encode(), seed=42).intdigest()


def near(a, b):
    return bin((a ^ b) % 2**64).count("1") <= 3


@pytest.mark.parametrize("bucket_rows", [2048, 4])
def test_links_give_the_components_of_all_pairs(spark, bucket_rows):
    rng = random.Random(2)
    fps = {0, 1, 7, 2**64 - 1} | {rng.getrandbits(64) for _ in range(120)}
    for centre in list(fps)[:6]:
        for _ in range(40):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in fps]
    table = spark.createDataFrame(signed, "fp long").repartition(5)
    links = simhash.fingerprint_links(table, bucket_rows).collect()
    assert all(near(r.src, r.dst) for r in links)
    nodes = [r[0] for r in signed]
    want = groups([(a, b) for a, b in itertools.combinations(nodes, 2) if near(a, b)], nodes)
    assert groups([(r.src, r.dst) for r in links], nodes) == want


def test_bound_never_exceeds_the_distance():
    import numpy as np

    rng = np.random.default_rng(4)
    a, b = (rng.integers(0, 2**64, 500, dtype=np.uint64) for _ in range(2))
    masks = simhash.level_masks(())
    bound = simhash.bound(simhash.pivot_table(a, masks), simhash.pivot_table(b, masks))
    assert (bound <= np.bitwise_count(a ^ b)).all()


def test_levels_leave_few_bits_open():
    open_bits = 64
    for path in ((), (3,), (3, 17)):
        masks = simhash.level_masks(path)
        assert sum(bin(m).count("1") for m in masks) == open_bits
        open_bits -= sum(bin(masks[i]).count("1") for i in simhash.CHOICES[17 if path else 3])
    assert open_bits <= 9


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500 + i, 500) for i in range(1, 30)] + [(7, 7), (9, 8), (8, 9)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "src long, dst long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == groups([x for x in links if x[0] != x[1]], nodes)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_documents_against_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog and runs into the deep dark wood where nobody lives at all today"
    long = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
    rows = [(1, base), (2, base.upper()), (3, base + " "), (4, None), (5, ""), (6, " \n"), (7, "x"), (8, long), (9, long + " end"), (9, long), (None, base), (None, "alone here")]
    got = sorted(simhash.near_duplicates(clashing(docs(spark, rows)), 3).collect(), key=str)
    fps = [slow_fingerprint(t) for _, t in rows]
    want = groups([(i, j) for i, j in itertools.combinations(range(len(rows)), 2) if near(fps[i], fps[j])], range(len(rows)))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        known = least.get(want[i])
        least[want[i]] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    expected = sorted(((d, f"{f:016x}", least[want[i]]) for i, ((d, _), f) in enumerate(zip(rows, fps, strict=True))), key=str)
    assert sorted([tuple(r) for r in got], key=str) == expected


def test_one_of_each_keeps_one_row_as_it_is(spark):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (1, "a b c d e f g"), (2, "other words stand here, quite other ones"), (None, None), (8, "")]
    table = clashing(docs(spark, rows))
    got = simhash.one_of_each(table)
    assert got.columns == table.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, "a b c d e f g"), (2, "other words stand here, quite other ones"), (8, "")]


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.one_of_each(docs(spark, [])).count() == 0
