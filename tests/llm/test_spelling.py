import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lynxrisk.llm import spelling
from lynxrisk.llm.queries import QUERIES

from .helpers import clashing, docs

FOLDER = "/root/testdata/sf0.001"


def brute(rows):
    """Everything from the definition: near words by deleting or masking each letter."""
    import re

    found = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            found[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 31 == 0 else w] += 1
    n = {w: k for w, k in found.items() if len(w) >= 7 and k >= 2}
    near, masked = defaultdict(set), defaultdict(list)
    for w in n:
        for i in range(len(w)):
            masked[w[:i], w[i + 1 :]].append(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in masked.values():
        for a in same:
            near[a].update(b for b in same if b != a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (n[w], len(near[w]), form.get(w), n.get(form.get(w)), root(w)) for w in n}


def answer(df):
    rows = df.collect()
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("cell_words", [40, spelling.CELL_WORDS])
def test_given_documents(spark, cell_words):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in table.collect()])
    assert answer(spelling.spelling_groups(table, cell_words)) == want
    assert any(v[2] for v in want.values())


def test_query(spark):
    got = QUERIES["op12_spelling_variants"](spark, FOLDER)
    assert set(got.columns) == {"word", "form", "root", "n", "n_near", "form_n"}


def test_variants_ties_and_chains(spark):
    """Words close together on purpose: repeated letters, anagrams, chains of forms, ties of counts."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["a", "b"]) * rng.randint(3, 4) + rng.choice(["abab", "baba", "abba"]) for _ in range(40))) for i in range(30)]
    rows += [(100, "notation " * 3000 + "notations " * 200 + "notationsx " * 15 + "notationsy " * 14 + "notationé " * 15 + "nôtationé " * 2 + "Étationé " * 3)]
    rows += [(200, "wortfolge " * 50 + "wortfolgen " * 50 + "wortfolgex " * 2 + "Wortfolg " * 4)]
    want = brute(rows)
    for cell_words in (3, 1000):
        assert answer(spelling.spelling_groups(docs(spark, rows).repartition(3), cell_words)) == want
    assert any(w[4] not in (k, w[2]) for k, w in want.items())  # a chain of at least two steps


def test_edges(spark):
    rows = [(None, "Abcdefgh abcdefgh"), (1, None), (2, ""), (3, "x" * 2_000 + " " + "x" * 2_000 + " " + "x" * 2_001 + " " + "x" * 2_001)]
    rows += [(4, "same words Here"), (4, "same words Here"), (5, "×÷×÷×÷× " * 3)]
    assert answer(spelling.spelling_groups(clashing(docs(spark, rows)))) == brute(rows)
    assert spelling.spelling_groups(docs(spark, rows).limit(0)).count() == 0


def test_tree_finds_all_in_reach():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("aabcdeé"), 8)).encode("latin-1") for _ in range(2000)]
    counts = spelling.letter_counts(words)
    tree = spelling.tree_of(counts)
    found = {(int(a), int(b)) for i, j in spelling.range_search(tree, counts, counts[:, :300], False) for a, b in zip(i, j, strict=True)}
    apart = np.abs(counts[:, :300, None].astype(int) - counts[:, None, :]).sum(axis=0)
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(apart <= 2)), strict=True))
