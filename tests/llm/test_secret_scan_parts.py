import random
import re
import string

from pyspark.sql import functions as F

from lynxrisk.llm import secret_scan as scan

from .helpers import docs

BASE62 = string.ascii_letters + string.digits


def key(rng, signs, n):
    return "".join(rng.choice(signs) for _ in range(n))


def test_runs_are_tokens_and_their_parts(spark):
    rng = random.Random(2)
    texts = ["", "é" + "a" * 25 + "/" + "b" * 19 + "=" + "c" * 20, "x" * 20 + " " + "y" * 19, "=" * 50]
    texts += ["".join(rng.choice("ab" * 12 + "/=_-+ ") for _ in range(800)) for _ in range(10)]
    table = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in table.select("i", scan.runs("t").alias("found")).collect():
        want = {(m.start(), m[0]) for signs in scan.SIGNS for m in re.finditer(f"[{signs}]{{20,}}", texts[r.i])}
        assert [tuple(x) for x in r.found] == sorted(want)


def test_narrowest_against_a_plain_loop(spark):
    rng = random.Random(3)
    rows = [[], [(0, 30)], [(0, 30), (0, 30 - 5), (26, 30)]]
    for _ in range(20):
        spans = set()
        for base in range(0, 600, 100):
            outer = (base, base + 90)
            inner = [(base, base + 25), (base + 30, base + 60), (base + 62, base + 90)]
            inmost = [(base + 31, base + 52)]
            spans |= {x for x in [outer, *inner, *inmost] if rng.random() < 0.5}
        rows.append(sorted(spans, key=lambda _: rng.random()))
    table = spark.createDataFrame(list(enumerate(rows)), "i int, s array<struct<start:int,end:int>>")
    for r in table.select("i", scan.narrowest(F.col("s")).alias("kept")).collect():
        want = [a for a in rows[r.i] if not any(b != a and a[0] <= b[0] and b[1] <= a[1] for b in rows[r.i])]
        assert sorted(tuple(x) for x in r.kept) == sorted(want)


def test_keys_behind_names_and_paths_and_keys_of_letters(spark):
    """Among many long words, so that the dismissal limit is near 0.05."""
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice(["the", "and", "ing", "tion", "er", "ment"]) for _ in range(n))
    heads = ["session_cookie_value=", "com/services/hooks/incoming/", "com/services/hooks/incoming/", ""]
    rows, want = [], {}
    for i in range(400):
        head = heads[i % 4]
        k = key(rng, string.ascii_letters if i % 4 == 3 else BASE62, 24 if i % 4 == 2 else 32)
        rows.append((i, f"see {head}{k} here"))
        want[i] = (4 + len(head), 3, 4 + len(head) + len(k))
    rows += [(1000 + i, " ".join(word(rng.randint(8, 14)) for _ in range(4))) for i in range(1000)]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in scan.find_secrets(docs(spark, rows)).collect()}
    for kind in range(4):
        assert sum(got[i] == [want[i]] for i in range(kind, 400, 4)) >= 85, kind
    assert sum(bool(got[1000 + i]) for i in range(1000)) <= 60
