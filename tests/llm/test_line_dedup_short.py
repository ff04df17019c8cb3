import random

import pytest
from pyspark.sql import functions as F

from lynxrisk.llm import line_dedup
from lynxrisk.llm.queries import QUERIES

from .helpers import clashing, docs, words


def tokens(line):
    """All five-word shingles; the whole line where it is shorter."""
    w = tuple(words(line))
    return frozenset(w[i : i + 5] for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute(spark, rows):
    """Kept text of each (doc_id, text) by comparing every line with a word to every earlier one."""
    hashed = spark.createDataFrame([(t,) for _, t in rows], "t string").select(F.xxhash64("t")).collect()
    order = sorted(zip(rows, hashed, strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[1][0]))
    seen, out = [], []
    for (d, t), _ in order:
        kept = []
        for line in t.split("\n"):
            s = tokens(line)
            if not s or not any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                kept.append(line)
            seen.append(s)
        out.append((d, "\n".join(kept), len(t.split("\n")), len(t.split("\n")) - len(kept)))
    return out


def check(spark, rows):
    got = line_dedup.dedup_lines(clashing(docs(spark, rows)).repartition(3), least_words=1).collect()
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_removed) for r in got], key=str) == sorted(brute(spark, rows), key=str)


@pytest.mark.parametrize("frequent", [1000, 2])
def test_short_and_long_lines_against_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    rng = random.Random(8)
    few, many = [f"v{i}" for i in range(4)], [f"w{i}" for i in range(50)]
    lines = [" ".join(rng.choices(few, k=rng.randint(0, 4))) for _ in range(120)]
    for _ in range(20):
        w = rng.choices(many, k=rng.randint(5, 30))
        lines += [" ".join(w), " ".join([*w, rng.choice(many)]), "  ".join(w[:4]), " ".join(w[:8]), " ".join(w[:9])]
    rng.shuffle(lines)
    check(spark, [(i, "\n".join(lines[i * 5 : i * 5 + 5])) for i in range(len(lines) // 5)])


def test_given_documents_against_brute_force(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("text IS NOT NULL").select("doc_id", "text").collect()
    check(spark, [tuple(r) for r in given][:80])


def test_query_removes_repeated_short_lines(spark, tmp_path):
    rows = [(1, "Home\nRead  more\n\nHome\n \nhome"), (2, "Read more\nHome page\nRead more here now\n\n"), (3, "Home")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.text, r.n_removed) for r in QUERIES["op10_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: ("Home\nRead  more\n\n \nhome", 1), 2: ("Home page\nRead more here now\n\n", 1), 3: ("", 1)}
