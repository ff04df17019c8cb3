"""From raw documents to packed sequences, in five stages; each is written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lynxrisk.llm import langid, line_dedup, mixing, packing, simhash
from lynxrisk.llm.common import settle
from lynxrisk.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model's rejects go. Texts and labels stay as they are."""
    answered = langid.identify(docs.select("doc_id", "text", "lang", F.struct("*").alias("row")))
    return answered.filter("NOT rejected").select("row.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, less the lines that are similar to an earlier one, short ones included; n_chars follows the text."""
    cut = line_dedup.dedup_lines(docs.select("doc_id", "text", F.struct("*").alias("row")), least_words=1)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return cut.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it."""
    return mixing.take(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids and their places in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path(), added=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup),
    ("cube_mix", source_mix),
    ("best_fit_packing", packed),
]

#: Not to be said in SQL: a trained model, XXH64 fingerprints, random draws and a tokenizer take part.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each on what the one before has written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
