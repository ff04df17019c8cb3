import random

import pytest
from pyspark.sql import functions as F

from lynxrisk.llm import line_dedup

from .helpers import clashing, docs, words


def tokens(line):
    w = words(line)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(spark, rows):
    """Kept text of each (doc_id, text) by comparing every line to every earlier one."""
    hashed = spark.createDataFrame([(t,) for _, t in rows], "t string").select(F.xxhash64("t")).collect()
    order = sorted({(d is None, d or 0, h[0], d, t) for (d, t), h in zip(rows, hashed, strict=True)}, key=lambda x: x[:3])
    seen, removed = [], {}
    for *_, d, t in order:
        gone = set()
        for i, line in enumerate((t or "").split("\n")):
            s = tokens(line)
            if not s:
                continue
            if any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                gone.add(i)
            seen.append(s)
        removed[d, t] = gone
    return [
        (d, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in removed[d, t]), 0 if t is None else len(t.split("\n")), len(removed[d, t]))
        for d, t in rows
    ]


def check(spark, rows):
    table = clashing(docs(spark, rows)).repartition(3)
    got = line_dedup.dedup_lines(table)
    assert got.columns == [c for c in table.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_removed) for r in got.collect()], key=str) == sorted(brute(spark, rows), key=str)


@pytest.mark.parametrize("frequent", [1000, 2])
def test_near_lines_against_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    lines = [" ".join(rng.choices(vocabulary, k=rng.randint(3, 60))) for _ in range(30)]
    for line in lines[:25]:
        for _ in range(5):
            w = line.split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            lines.append(" ".join(w + rng.choices(vocabulary, k=rng.randint(0, 3))))
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i * 5 : i * 5 + 5])) for i in range(len(lines) // 5)]
    check(spark, rows)


def test_given_documents_against_brute_force(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in given][:80])


def test_edges(spark):
    line = "one two three four five six"
    rows = [
        (2, line),
        (1, f"{line}\nshort one\n\n{line.upper()}\nshort one"),
        (3, None),
        (4, ""),
        (5, "\n\n"),
        (None, f"{line}\nnull ids come last of all here"),
        (7, "null ids come last of all here"),
        (8, "same row twice is kept twice"),
        (8, "same row twice is kept twice"),
        (8, "same id with another text here\nsame row twice is kept twice"),
        (9, " ".join(f"t{i}" for i in range(30_000))),
        (10, " ".join(f"t{i}" for i in range(29_990))),
        (11, "a a a a a a a a\tb"),
    ]
    check(spark, rows)


def test_many_copies_of_similar_lines(spark):
    """A large group of similar lines is settled without pairing all of them."""
    rows = [(i, " ".join(f"w{k}" for k in range(60)) + f" end{i}") for i in range(150)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(spark, rows)).collect()}
    assert got[0] == rows[0][1] and not any(got[i] for i in range(1, 150))


def test_empty_table(spark):
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = line_dedup.dedup_lines(docs(spark, [(1, "a b c d e f")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
