import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lynxrisk.llm import quality

from .helpers import clashing, docs, words


def slow_counts(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "É#", "c|", "\n", " ", "\n\n", " "]), max_size=80).map(" ".join))
def test_counts(text):
    assert quality.counts_of(text)[:5] == slow_counts(text)


def test_counts_of_long_repeats():
    rng = random.Random(1)
    w = [str(rng.randrange(9)) for _ in range(3000)]
    text = " ".join(w[:1000] + w[200:230] + w[1000:])
    assert quality.counts_of(text)[:5] == slow_counts(text)
    assert quality.counts_of("x " * 9)[4] == 9 and quality.counts_of("x " * 8)[4] == 0


def test_buckets_hold_their_values(spark):
    values = sorted({v + d for e in range(40) for v in [2**e] for d in (-1, 0, 1, 2**e // 3)} - {-1})
    table = spark.createDataFrame([(v,) for v in values], "v long").withColumn("b", quality.bucket(F.col("v"))).withColumn("end", quality.bucket_end(F.col("b")))
    rows = table.collect()
    assert all(r.v <= r.end <= r.v + r.v / 16 for r in rows)
    assert [r.b for r in rows] == sorted(r.b for r in rows)


def test_sketches_merge_and_are_near(spark):
    rng = np.random.default_rng(2)
    rows = [("en" if i % 3 else "de", f"s{i % 4}", *(int(x) for x in rng.lognormal(5, 1.5, len(quality.MEASURES)))) for i in range(2000)]
    table = spark.createDataFrame(rows, ["lang", "source", *quality.MEASURES])
    one, other = quality.sketches(table.limit(700)), quality.sketches(table.exceptAll(table.limit(700)))
    merged = one.union(other).groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))
    assert merged.exceptAll(quality.sketches(table)).count() == 0
    got = {(r.lang, r.measure): (r.docs, r.q) for r in quality.quantiles(merged, ["lang"], {"q": 0.75}).collect()}
    for lang in ("en", "de"):
        for k, m in enumerate(quality.MEASURES):
            values = sorted(r[2 + k] for r in rows if r[0] == lang)
            exact = values[int(np.ceil(len(values) * 0.75)) - 1]
            assert got[lang, m][0] == len(values) and exact <= got[lang, m][1] <= exact * 17 / 16


def test_thresholds_follow_language_and_source(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    plain = lambda n: " ".join(word(rng.randint(4, 6)) for _ in range(n))
    tables = lambda n: " ".join(f"{word(5)} | " for _ in range(n))
    rows = [(i, plain(60), "en", "prose") for i in range(240)] + [(1000 + i, tables(60), "en", "tables") for i in range(240)]
    rows += [(5000, tables(60), "en", "prose"), (5001, tables(60), "en", "tables"), (5002, plain(10), "en", "prose"), (5003, "x " * 100, "en", "prose")]
    got = {r.doc_id: r for r in quality.judge(docs(spark, rows)).collect()}
    assert not got[5000].kept and got[5000].failed[0] == "symbols"
    assert got[5001].kept
    assert got[5002].base_failed and got[5003].base_failed and not got[5003].kept
    assert sum(got[i].kept for i in range(240)) == 240


def test_clean_documents_stay_and_junk_goes(spark):
    folder = "/root/testdata/sf0.1"
    judged = quality.judge(spark.read.parquet(f"{folder}/documents.parquet"))
    rated = judged.join(spark.read.parquet(f"{folder}/labels.parquet").filter("quality IS NOT NULL"), "doc_id").toPandas()
    clean, junk = rated[rated.quality == 1], rated[rated.quality == 0]
    assert clean.kept.mean() > 0.95
    assert junk.kept.mean() < 0.5


def test_edges(spark):
    rows = [(1, None, None, None), (2, "", "en", None), (None, "a b c " * 20, None, "s"), (4, "w " * 200_000, "en", "s"), (5, "dup", "en", "s"), (5, "dup", "en", "s")]
    got = quality.judge(clashing(docs(spark, rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for d, t, *_ in rows if d == r.doc_id)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == slow_counts(text)
        assert not (r.base_failed and r.kept)
    assert quality.judge(docs(spark, [])).count() == 0


def spoilt(rng, measure):
    """A text that is out of line in one measure and passes the base rules."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 6)))
    plain = [word() for _ in range(100)]
    if measure == "symbols":
        return " ".join(w + "|" * (i % 2) for i, w in enumerate(plain))
    if measure == "upper":
        return " ".join(plain[:50]) + " " + " ".join(w.upper() for w in plain[50:])
    if measure == "word_length":
        return " ".join(a + b + word() for a, b in zip(plain, plain[::-1], strict=True))
    if measure == "repeated":
        return " ".join(plain + plain[:14])  # 28 of 114 words lie in repeated windows
    if measure == "dup_lines":
        return " ".join(plain) + "\n" + "\n".join(f"{w} x" for w in [plain[0], plain[1], plain[2], plain[3]] * 3)
    return " ".join(plain)


def test_each_measure_rejects_what_the_base_rules_pass(spark):
    rng = random.Random(5)
    rows = [(i, spoilt(rng, None), "en", f"s{i % 2}") for i in range(300)]
    rows += [(1000 + i, spoilt(rng, m), "en", "s0") for i, m in enumerate(quality.MEASURES)]
    got = {r.doc_id: r for r in quality.judge(docs(spark, rows)).collect()}
    assert all(got[i].kept for i in range(300))
    for i, m in enumerate(quality.MEASURES):
        assert not got[1000 + i].base_failed and got[1000 + i].failed == [m]


def test_fences_change_little_with_one_document_more(spark):
    """No number of documents switches a group from other thresholds to its own."""
    sketch = lambda n: [("en", "big", "upper", 8, 5000), ("en", "own", "upper", 40, n)]
    most = []
    for n in (1, 60, 99, 100, 101, 199, 200, 201, 1000, 100_000):
        table = spark.createDataFrame(sketch(n), "lang string, source string, measure string, bucket long, n long")
        most.append(next(r.limits["upper"].most for r in quality.fences(table).collect() if r.f_source == "own"))
    assert most == sorted(most) and most[0] < most[-1]
    assert most[4] - most[2] <= 2 and most[7] - most[5] <= 2
