import zlib
import random

import numpy as np
import pytest

from lynxrisk.llm import langid

from .helpers import docs


def corpus(languages, per_language):
    """Documents of languages that each have syllables of their own and some shared words."""
    rng = random.Random(6)
    rows = []
    for k in range(languages):
        syllables = ["".join(rng.choice("bcdfghklmnprstvz") + rng.choice("aeiou") for _ in range(2)) for _ in range(12)]
        for i in range(per_language):
            text = " ".join(rng.choice(syllables) + rng.choice(syllables) if rng.random() < 0.8 else "data" for _ in range(40))
            rows.append((k * 10_000 + i, text, f"l{k}"))
    return rows


@pytest.mark.parametrize("languages", [5, 10])
def test_every_language_is_learned_from(spark, languages):
    table = docs(spark, corpus(languages, 90))
    got = langid.identify(table).toPandas()
    for lang, part in got.groupby("lang"):
        assert (part.lang_pred == lang).mean() > 0.95, lang
        assert part.rejected.mean() < 0.05, lang


@pytest.mark.parametrize("languages", [4, 5, 10])
def test_each_language_is_in_both_parts(monkeypatch, languages):
    """The temperature is set on a fifth of every language: the others are what is trained on."""
    labels = np.tile(np.arange(languages), 20)
    trained = []

    class Rng:
        def __init__(self):
            self.rng = np.random.Generator(np.random.PCG64(1))

        def __getattr__(self, name):
            return getattr(self.rng, name)

        def permutation(self, rows):
            trained.append(rows)
            return self.rng.permutation(rows)

    monkeypatch.setattr(langid.np.random, "default_rng", lambda seed: Rng())
    langid.train([str(i) for i in range(languages)], labels, [np.array([i % languages]) for i in range(len(labels))], [np.ones(1)] * len(labels))
    assert np.bincount(labels[trained[0]], minlength=languages).tolist() == [16] * languages


def test_a_language_of_equal_rows_is_learned(spark):
    """Thousands of equal rows have one draw; their language must not fall out of the sample."""
    table = spark.createDataFrame([(7 if i < 5000 else i, "der die und nicht" if i < 5000 else f"the and of {i} was", "de" if i < 5000 else "en") for i in range(5060)], "doc_id long, text string, lang string")
    for same_id in (7, 8, 9):
        moved = table.selectExpr(f"if(doc_id = 7, {same_id}, doc_id) AS doc_id", "text", "lang")
        languages = {r.lang for r in langid.sample(moved).select("lang").distinct().collect()}
        assert ("de" in languages) == (zlib.crc32(str(same_id).encode()) % 3 != 1) and "en" in languages
