"""Word rules on texts: tags per row, and tags per group as if its texts were one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.config import Scale
from lynxrisk.functions.expr import contains_any
from lynxrisk.operators.ordering import BORROWED, CHUNK, frame_chunks

Rules = dict[str, Sequence[str]]


def tag_array(hits: dict[str, Column]) -> Column:
    """The names whose condition is true, in rule order; none gives an empty array."""
    return F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in hits.items()]))


def tag_text(df: DataFrame, text_col: str, rules: Rules, out: str) -> DataFrame:
    return df.withColumn(out, tag_array({tag: contains_any(F.col(text_col), words) for tag, words in rules.items()}))


def tag_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    text_col: str,
    rule_sets: dict[str, Rules],
    sep: str = " ",
    scale: Scale = Scale(),
) -> DataFrame:
    """Tags of each group's texts, joined by ``sep`` in the given order.

    The joined text is never built: a group can be of any size. Every row is tested by itself
    before the shuffle. Only a word that contains the separator can also match across the
    seam of two or more texts; for those, the ends of the texts (as long as the longest such
    word) are put side by side.
    """
    flags = {f"_f{i}": words for i, words in enumerate(w for rules in rule_sets.values() for w in rules.values())}
    seam_words = [w.lower() for words in flags.values() for w in words if sep in w]
    low = F.lower(F.col(text_col))
    tested = df.withColumn("_low", low).select(
        *keys,
        *[c for c in order if c not in keys],
        F.col("_low").isNotNull().alias("_has_text"),
        *([F.right("_low", F.lit(_reach(seam_words))).alias("_tail")] if seam_words else []),
        *([F.left("_low", F.lit(_reach(seam_words))).alias("_head")] if seam_words else []),
        (F.length("_low") <= _reach(seam_words)).alias("_short"),
        *[F.coalesce(contains_any(F.col("_low"), words), F.lit(False)).alias(f) for f, words in flags.items()],
    )
    hits = {f: F.col(f) for f in flags}
    if seam_words:
        empty = tested.filter(~F.col("_has_text")).select(*keys, *flags)
        tested, seam = _with_seams(tested.filter("_has_text"), keys, order, seam_words, sep, scale)
        hits = {
            f: reduce(lambda a, b: a | b, [F.col(f), *[seam.contains(w.lower()) for w in words if sep in w]])
            for f, words in flags.items()
        }
        tested = tested.select(*keys, *[hit.alias(f) for f, hit in hits.items()]).unionByName(empty)
    grouped = tested.groupBy(*keys).agg(*[F.bool_or(f).alias(f) for f in flags])
    names = iter(flags)
    arrays = [
        tag_array({tag: F.col(next(names)) for tag in rules}).alias(out) for out, rules in rule_sets.items()
    ]
    return grouped.select(*keys, *arrays)


def _reach(words: Sequence[str]) -> int:
    return max((len(w) for w in words), default=0)


def _with_seams(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], words: Sequence[str], sep: str, scale: Scale
) -> tuple[DataFrame, Column]:
    """Adds ``_seam``: the end of this text, then the beginnings of the next ones.

    A text longer than any word is cut there, so nothing may follow it.
    """
    most = max(w.count(sep) for w in words)
    pieces = frame_chunks(rows, keys, order, after=most, scale=scale)
    following = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    parts = [F.col("_tail")]
    whole = F.lit(True)
    for step in range(1, most + 1):
        parts.append(F.when(whole, F.concat(F.lit(sep), F.lead("_head", step).over(following))))
        whole = whole & F.coalesce(F.lead("_short", step).over(following), F.lit(False))
    seam = F.concat(*[F.coalesce(p, F.lit("")) for p in parts])
    return pieces.withColumn("_seam", seam).filter(~F.col(BORROWED)), F.col("_seam")
