"""Quality rules with thresholds that adapt to language and source.

Each document has a few whole-number measures. A sketch of each measure's distribution is kept for every (language, source): counts
in buckets whose width is a sixteenth of their value at most, as in a floating-point number with four bits of
fraction. Sketches of this kind add up, whatever the partitions, so one grouping makes them and languages and the whole
table get theirs by adding. Quartiles from the sketch, blended with the language's by the number of documents, set fences; documents
outside a fence are not kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.llm.common import settle, small_join

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

#: Measures, in thousandths unless said: least width of the quartile range, the largest value a text that passes the base rules can have (None:
#: no such), and whether a low value counts against a text too.
MEASURES = {
    "symbols": (50, None, False),  # symbols by words
    "upper": (40, 1000, False),  # A-Z by characters in words
    "word_length": (500, None, True),  # characters by words, in thousandths of a character
    "repeated": (100, 10 * MOST_REPEATED_PERCENT, False),  # words in repeated windows by words
    "dup_lines": (150, 1000, False),  # repeated lines by lines
}
#: A fence lies so many quartile ranges outside the quartiles, but leaves at least a quarter of the way from there to the largest value outside.
REACH = 3
#: A group's quartiles are blended with those of its language as if so many documents of the language were in it; a language's with those of all.
PRIOR_DOCS = 20
FRACTION_BITS = 4
_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_lines long"
_SYMBOL = re.compile(f"[{re.escape(SYMBOLS)}]")
_SPACES = " \t\n\x0b\x0c\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Number of words that lie in a window of so many words which the text has twice or more.

    Windows are compared exactly: runs of 1, 2, 4 and 8 words get numbers, each from a pair of numbers of half the length.
    """
    if len(words) <= window:
        return 0
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
    if len(known) == len(words):
        return 0
    length = 1
    while length < window:
        step = min(length, window - length)
        pair = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        different, ids = np.unique(pair, return_inverse=True)
        length += step
        if len(different) == len(pair):
            return 0
    again = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, np.flatnonzero(again), 1)
    np.add.at(edges, np.flatnonzero(again) + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def counts_of(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of the columns."""
    text = text or ""
    words = _WORD.findall(text)
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)
    chars = sum(map(len, words))
    code = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    capitals = int(((code >= 65) & (code <= 90)).sum())
    return len(words), chars, len(_SYMBOL.findall(text)), dup, repeated_words(words), capitals, lines


def measure_counts(text: Column) -> Column:
    @F.pandas_udf(_COUNTS)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _COUNTS.split(", ")]
        for texts in batches:
            yield pd.DataFrame([counts_of(t) for t in texts], columns=names).astype("int64")

    return of(text.cast("string"))


def bucket(value: Column) -> Column:
    """Sketch bucket of a whole number >= 0: its leading bit and the four bits after it; numbers below 16 have their own."""
    low = 1 << FRACTION_BITS
    bits = F.length(F.bin(value)) - 1
    shift = F.greatest(bits - FRACTION_BITS, F.lit(0))
    return F.when(value < low, value).otherwise(shift * low + F.call_function("shiftright", value, shift)).cast("long")


def bucket_end(number: Column) -> Column:
    """The largest value in a bucket."""
    low = 1 << FRACTION_BITS
    shift = F.greatest(F.floor(number / low) - 1, F.lit(0)).cast("int")
    return F.when(number < 2 * low, number).otherwise(F.call_function("shiftleft", number - shift * low + 1, shift) - 1)


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): mergeable sketches; adding n over groups gives the groups' sketch."""
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MEASURES])).alias("p")
    return measured.select("lang", "source", pairs).groupBy("lang", "source", "p.measure", "p.bucket").agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, by: list[str], shares: dict[str, float]) -> DataFrame:
    """For each group and measure: docs, and the sketch's value for each share."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    ranked = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("docs", F.sum("n").over(group))
    values = [F.min(F.when(F.col("upto") >= F.ceil(F.col("docs") * s), bucket_end(F.col("bucket")))).alias(k) for k, s in shares.items()]
    return ranked.groupBy(*by, "measure").agg(F.first("docs").alias("docs"), *values)


def fences(sketch: DataFrame, prior_docs: int = PRIOR_DOCS, reach: int = REACH) -> DataFrame:
    """(lang, source, limits): for each measure the least and most value, from the group's quartiles blended with its language's."""
    quartiles = {"q1": 0.25, "q3": 0.75}
    own = quantiles(sketch, ["lang", "source"], quartiles)
    language = quantiles(sketch, ["lang"], quartiles)
    everything = quantiles(sketch, [], quartiles)

    def named(table: DataFrame, prefix: str) -> DataFrame:
        return table.select(*[F.col(c).alias(f"{prefix}_{c}") for c in table.columns])

    def blend(docs: str, value: Column, prior: Column) -> Column:
        return F.floor((F.col(docs) * value + prior_docs * prior) / (F.col(docs) + prior_docs)).cast("long")

    o, lang, every = named(own, "o"), named(language, "l"), named(everything, "e")
    joined = o.join(lang, F.col("o_lang").eqNullSafe(F.col("l_lang")) & (F.col("o_measure") == F.col("l_measure"))).join(every, F.col("o_measure") == F.col("e_measure"))
    q1, q3 = (blend("o_docs", F.col(f"o_{q}"), blend("l_docs", F.col(f"l_{q}"), F.col(f"e_{q}"))) for q in quartiles)
    width, top, low_too = (F.create_map(*[x for m, facts in MEASURES.items() for x in (F.lit(m), F.lit(facts[k]))])[F.col("o_measure")] for k in range(3))
    span = F.greatest(q3 - q1, width) * reach
    inside = F.when(top.isNotNull(), q3 + F.floor((F.greatest(top, q3) - q3) * 3 / 4))
    most = F.least(q3 + span, inside)  # without a largest value: the first
    least = F.when(low_too, q1 - span).otherwise(F.lit(-1))
    limit = F.struct(F.col("o_measure").alias("measure"), least.cast("long").alias("least"), most.cast("long").alias("most"))
    return joined.groupBy(F.col("o_lang").alias("f_lang"), F.col("o_source").alias("f_source")).agg(
        F.map_from_entries(F.collect_list(F.struct(limit["measure"].alias("k"), limit.alias("v")))).alias("limits")
    )


def judge(docs: DataFrame, prior_docs: int = PRIOR_DOCS) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, failed.

    Base rules: fewer than 20 words, or over 30 % of the words in repeated 8-word windows, fails. The other documents make
    the sketches of their (lang, source); ``kept`` is false for a base failure and for a document outside a fence, and ``failed`` names the
    measures (``base`` for the base rules). A null text counts as empty. Null languages and sources are groups like
    any other. Repeated rows come back as often as they are there; an empty table gives none. Texts are measured whole, however long. Columns not
    read here don't matter.
    """
    counted = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), measure_counts(F.col("text")).alias("c"))
    base = (F.col("c.n_words") < LEAST_WORDS) | (F.col("c.n_repeat_words") * 100 > F.col("c.n_words") * MOST_REPEATED_PERCENT)
    share = lambda part, whole: F.floor(F.col(part) * 1000 / F.greatest(F.col(whole), F.lit(1))).cast("long")
    measured = settle(
        counted.select("doc_id", "lang", "source", "c.*", base.alias("base_failed")).select(
            "*",
            share("n_symbols", "n_words").alias("symbols"),
            share("n_upper", "word_chars").alias("upper"),
            share("word_chars", "n_words").alias("word_length"),
            share("n_repeat_words", "n_words").alias("repeated"),
            share("n_dup_lines", "n_lines").alias("dup_lines"),
        )
    )
    limits = settle(fences(sketches(measured.filter("NOT base_failed")), prior_docs))
    fenced = small_join(measured, limits, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    outside = [F.when(~F.col(m).between(F.col("limits")[m]["least"], F.col("limits")[m]["most"]), F.lit(m)) for m in MEASURES]
    failed = F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(F.array_compact(F.array(*outside)))
    return fenced.withColumn("failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (F.size("failed") == 0).alias("kept"), "failed"
    )
