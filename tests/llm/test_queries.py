"""Registered queries on the smallest given tables; SQL twins where there are any."""

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check import TABLES, canonical
from lynxrisk.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert len(got)
    if name in ORACLES:
        db = duckdb.connect()
        for t in TABLES:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
        cursor = db.execute(ORACLES[name])
        want = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description])
        pd.testing.assert_frame_equal(canonical(got), canonical(want))
    elif name.split("_")[0] not in ("op7",):
        assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_stages(spark, tmp_path):
    """Each stage on what the one before has written, against plain versions of what it must do."""
    from lynxrisk.llm import langid
    from lynxrisk.llm.queries import tokenizer_path

    from .test_line_dedup_short import brute
    from .test_mixing import slow_targets
    from .test_packing import check
    from .test_simhash import groups, near, slow_fingerprint

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
    first = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rejected = {r.doc_id for r in langid.identify(first).filter("rejected").collect()}
    stage1 = kept["language_id"]
    assert {r.doc_id for r in stage1} == {r.doc_id for r in first.collect()} - rejected and len(rejected) < 4
    stage2 = {r.doc_id: r.text for r in kept["line_dedup"]}
    assert stage2 == {d: t for d, t, *_ in brute(spark, [(r.doc_id, r.text) for r in stage1])}
    ids = sorted(stage2)
    fps = {i: slow_fingerprint(stage2[i]) for i in ids}
    roots = groups([(a, b) for a in ids for b in ids if a < b and near(fps[a], fps[b])], ids)
    assert sorted(r.doc_id for r in kept["simhash_near_dedup"]) == sorted(set(roots.values()))
    sizes, taken = {}, {}
    for r in kept["simhash_near_dedup"]:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    for r in kept["cube_mix"]:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    want = slow_targets(sizes)
    largest = max(len(r.text.split()) for r in kept["simhash_near_dedup"])
    assert all(abs(taken.get(s, 0) - want[s]) <= largest for s in sizes)
    check(kept["best_fit_packing"], [(r.doc_id, r.text) for r in kept["cube_mix"]], 2048)
    assert tokenizer_path()


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.count() > 0 and "sequence_id" in out.columns
