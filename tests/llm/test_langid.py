from pyspark.sql import functions as F

from lynxrisk.llm import langid

from .helpers import clashing, docs


def given(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(spark):
    table = given(spark)
    answered = langid.identify(table).withColumn("held", langid.held_out(F.col("doc_id"))).toPandas()
    held = answered[answered.held]
    assert len(held) > 250
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert not answered.rejected.mean() > 0.01
    assert answered.score.between(0, 1).all()


def test_prediction_sees_the_text_alone(spark):
    model = langid.fit(given(spark))
    changed = given(spark).withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", -F.col("doc_id"))
    a = langid.identify(given(spark), model).select("text", "lang_pred", "score").distinct()
    b = langid.identify(changed.repartition(7), model).select("text", "lang_pred", "score").distinct()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_held_out_documents_are_not_learned_from(spark):
    import zlib

    table = given(spark)
    ids = [r.doc_id for r in table.select("doc_id").collect()]
    held = {i for i in ids if zlib.crc32(str(i).encode()) % 3 == 1}
    assert {r.doc_id for r in table.filter(langid.held_out(F.col("doc_id"))).collect()} == held
    poisoned = table.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert langid.fit(poisoned).languages == langid.fit(table).languages
    assert (langid.fit(poisoned).scores == langid.fit(table.repartition(3)).scores).all()


def test_sample_is_bounded(spark):
    counts = langid.sample(given(spark), 20).groupBy("lang").count().collect()
    assert {r["count"] for r in counts} == {20}


def test_subwords_are_what_they_say():
    """Grams of words with borders, against a plain loop over strings."""
    texts = ["Ab, cdé!", "", "x", "12 3", "a"]
    for n, (buckets, owner) in zip(langid.GRAMS, langid.subwords(texts), strict=True):
        want = []
        for i, t in enumerate(texts):
            s = "".join(c if c.isalpha() else " " for c in f" {t.lower()} ")
            for k in range(len(s) - n + 1):
                g = s[k : k + n]
                if (n == 2 and g.strip()) or (n > 2 and " " not in g[1:-1]):
                    want.append((i, g))
        assert owner.tolist() == [i for i, _ in want]
        assert len({b for b in buckets.tolist()}) <= len({g for _, g in want})


def test_edges(spark):
    text = "the and of that with this from have been were"
    rows = [(i, f"{text} {i}", "en") for i in range(30)] + [(100 + i, f"der die das und nicht ein eine mit sich auf {i}", "de") for i in range(30)]
    rows += [(200, None, "en"), (201, "", "de"), (202, "12 !? ##", "en"), (203, "the of " * 50_000, None), (None, text, None), (205, text, "en"), (205, text, "en")]
    got = {}
    for r in langid.identify(clashing(docs(spark, rows))).collect():
        got.setdefault(r.doc_id, (r.lang_pred, r.score, r.rejected))
    assert got[200] == got[201] == got[202] == ("und", 0.0, True)
    assert got[203][0] == got[None][0] == "en" and got[120][0] == "de"
    nothing = langid.identify(docs(spark, [(1, "some text", None)])).first()
    assert (nothing.lang_pred, nothing.score, nothing.rejected) == ("und", 0.0, True)
    assert langid.identify(docs(spark, [])).count() == 0
