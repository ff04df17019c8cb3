import random

import pytest

from lynxrisk.llm import line_dedup

from .helpers import docs
from .test_line_dedup import check


def texts(rng, n, length=40):
    return [[f"w{rng.randrange(10**9)}" for _ in range(length)] for _ in range(n)]


def test_one_shingle_in_common_fetches_no_token_sets(spark, monkeypatch):
    """Two lines that share a single shingle can't be similar: their token sets are not made again."""
    fetched, whole = [], line_dedup._tokens_of
    monkeypatch.setattr(line_dedup, "_tokens_of", lambda classes, table: fetched.append(classes.count()) or whole(classes, table))
    rng = random.Random(3)
    lines = [" ".join(own + passage) for passage in texts(rng, 100, 5) for own in texts(rng, 2, 35)]
    got = line_dedup.dedup_lines(docs(spark, list(enumerate(lines)))).collect()
    assert sum(r.n_removed for r in got) == 0 and len(got) == 200
    assert sum(fetched) == 0


def test_only_sets_in_pairs_are_moved(spark, monkeypatch):
    """Lines that share passages and aren't similar are no pairs; only the two similar ones are compared."""
    compared, whole = [], line_dedup._similar
    monkeypatch.setattr(line_dedup, "_similar", lambda pairs, sets: compared.append(pairs.count()) or whole(pairs, sets))
    rng = random.Random(4)
    passage = texts(rng, 1, 20)[0]
    lines = [" ".join(own + passage) for own in texts(rng, 30, 30)]
    lines.append(lines[11] + " end")
    check(spark, list(enumerate(lines)))
    assert 1 <= sum(compared) <= 2


@pytest.mark.parametrize("frequent", [1000, 5])
def test_similar_line_in_the_middle_of_a_long_list(spark, monkeypatch, frequent):
    """Lists longer than what is joined at once, the similar line neither the first nor near; lengths about every limit."""
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    rng = random.Random(6)
    lines = []
    for length in (8, 9, 10, 13, 14, 22, 40):
        passage = texts(rng, 1, 7)[0]
        some = [passage + own for own in texts(rng, 24, length - 7)]
        near = [w + texts(rng, 1, k)[0] for w in some[8:14] for k in (1, 2, 3, 8)]
        lines += [" ".join(w) for w in some + near]
    check(spark, list(enumerate(lines)))
