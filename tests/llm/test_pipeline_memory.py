"""What the pipeline's stages hold and write follows the rows, not the session's settings."""

import os
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from lynxrisk.llm.common import BATCH_BYTES, bound_batches
from lynxrisk.sources import session
from lynxrisk.sources.session import FILE_ROWS, settle

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def documents(spark, n):
    words = [f"w{i}" for i in range(12)]
    rows = [(i, f"{' '.join(words)} line {i % 7}\nshort {i}\n{' '.join(f'u{i}x{k}' for k in range(9))}", "en", "s", 1) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_batches_are_bounded_in_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], names=["size"])

    texts = spark.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    with settings(spark, **{LIMIT: None}):
        bound_batches(spark)
        found = [r.size for r in texts.mapInArrow(sizes, "size long").collect()]
    assert sum(found) > 4 * BATCH_BYTES and max(found) < 1.1 * BATCH_BYTES


def test_stages_bound_their_batches(spark):
    docs = documents(spark, 30)
    for name, stage in corpus_pipeline.STAGES:
        if name not in ("line_dedup", "cube_mix"):
            with settings(spark, **{LIMIT: None}):
                stage(spark, docs, "")
                assert spark.conf.get(LIMIT) == str(BATCH_BYTES), name
            with settings(spark, **{LIMIT: "1000000"}):
                stage(spark, docs, "")
                assert spark.conf.get(LIMIT) == "1000000", name


def files(path):
    return sum(f.startswith("part-") for f in os.listdir(path.removeprefix("file:")))


def test_settled_files_follow_the_rows(spark):
    grouped = spark.range(FILE_ROWS * 2).groupBy((F.col("id") * 3).alias("k")).count()
    with settings(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}):
        out = settle(grouped, rows=FILE_ROWS * 2)
        assert out.count() == FILE_ROWS * 2 and files(session._SETTLED[-1]) == 2
        settle(grouped)
        assert files(session._SETTLED[-1]) == 40


def test_small_tables_are_few_files(spark):
    """With many shuffle partitions that aren't coalesced, tables of a few hundred rows aren't a file for each partition."""
    docs = settle(documents(spark, 300))
    with settings(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}):
        for stage, most in ((corpus_pipeline.line_dedup_stage, 2), (corpus_pipeline.near_dedup, 0)):
            known = len(session._SETTLED)
            assert stage(spark, docs, "").count()
            assert sum(files(p) > 8 for p in session._SETTLED[known:]) <= most
