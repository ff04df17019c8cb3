"""What several operators share: words, lines, seeded hashes, joins with small tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lynxrisk.sources.session import settle

# What parts words (ASCII white space only), and the words themselves.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: A table of up to so many values may be broadcast; they are counted first. About 30 MB.
SMALL_VALUES = 4_000_000


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def words(text: Column) -> Column:
    """The words of a text, in order, as an array. Where blanks are the only white space, a plain split is enough."""
    other = F.lit(False)
    for c in "\t\x0b\x0c\r\n":
        other = other | F.contains(text, F.lit(c))
    parts = F.when(other, F.split(text, SPACE, -1)).otherwise(F.split(text, " ", -1))
    return F.array_remove(parts, "")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_join(df: DataFrame, small: DataFrame, on: Column, how: str = "inner", lists: str | None = None) -> DataFrame:
    """Join with a table written before, broadcast only if its counted values are few.

    Values are its rows times its columns, and the elements of the column ``lists``. A larger table is joined by shuffle, where
    adaptive execution splits a hot key.
    """
    elements = F.sum(F.size(lists)) if lists else F.lit(0)
    rows, more = small.agg(F.count("*"), elements).first()
    few = rows * len(small.columns) + (more or 0) <= SMALL_VALUES
    return df.join(F.broadcast(small) if few else small, on, how)


#: An Arrow batch between Spark and Python holds about so many bytes. Spark's own limit is a number of rows, whatever their length.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches hold about ``BATCH_BYTES`` at most, unless it has a limit in bytes of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))


#: Texts are taken from an Arrow batch in groups of about so many bytes.
GROUP_BYTES = 2_000_000


def groups_of(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts of an Arrow batch, in order, in groups of about ``GROUP_BYTES``: Python holds one group at a time."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())).to_numpy(zero_copy_only=False)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(ends.searchsorted(before + GROUP_BYTES, side="right")))
        yield texts.slice(start, end - start).to_pylist()
        start = end


def replace(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns; columns of the same name (in any case) that the input has are replaced."""
    taken = {c.lower() for c in columns}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.select(*kept, *[v.alias(k) for k, v in columns.items()])


__all__ = ["BATCH_BYTES", "GROUP_BYTES", "SMALL_VALUES", "SPACE", "WORD", "bound_batches", "groups_of", "n_words", "partitions", "replace", "settle", "small_join", "text_or_empty", "uniform", "words"]
