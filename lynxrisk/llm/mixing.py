"""Mixing sources to target weights by balanced sampling with the cube method.

A source that shall give r times its tokens has every document floor(r) times, and once more with the probability
that is left. Which documents get one more is drawn by the cube method: inclusion probabilities move at random along directions that
leave the source's token total and its document total as they are, until they are 0 or 1. Three documents always
allow such a direction, so at most two stay undecided (the landing problem). Every document flies, and every draw, the landing's too, leaves all
expectations as they are: each document has its ratio as its mean number of copies, the longest included.

At scale a source is cut into blocks by a hash. Each block is a task's work. Its undecided documents go on to the next level, where
blocks of such rest rows are formed, until one block is left for each source; only there the landing takes place. Documents are
settled from the longest to the shortest, so those that stay undecided are short, and the error left is about one short
document. All draws are seeded by hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.llm.common import n_words, settle, small_join

WEIGHTS = (1, 2, 3)
MOST = 3.0
#: Rows of a block; a flight takes time with the square of it.
BLOCK_ROWS = 2048
#: Rows that a block hands on, as a rule at most: the two that its flight leaves undecided.
REST_ROWS = 4
_NEAR = 1e-9


def source_targets(sizes: DataFrame, weights: Iterable[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, rows, target) from rows (source, size).

    Sources in the order of their code points, null last, have the weights in turn and share the sum of all sizes. A target stops at
    ``most`` times its source's size; what is over goes to the others by weight, until none is above. So a target is
    min(most * size, level * weight), with the level at which the targets add up: sources are ordered by the level at which they
    are full, and running sums find where it lies. Both windows run over one row for each source.
    """
    weights = list(weights)
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weighed = totals.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights)))))
    weighed = weighed.withColumn("room", F.col("source_size") * F.lit(most)).withColumn("full_at", F.col("room") / F.col("weight"))
    by_level = Window.orderBy("full_at", F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    filled = (
        weighed.withColumn("all", F.sum("source_size").over(everything))
        .withColumn("full_before", F.coalesce(F.sum("room").over(before), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    )
    # the level if this source and all later ones stay below their room; it falls from the first source where that holds
    level = filled.withColumn("level", (F.col("all") - F.col("full_before")) / F.col("open_weight"))
    reached = level.withColumn("at", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything))
    target = F.least(F.col("room"), F.coalesce(F.col("at"), F.lit(math.inf)) * F.col("weight"))
    return reached.select("source", "source_size", "rows", target.alias("target"))


def flight(probability: np.ndarray, tokens: np.ndarray, rows: np.ndarray | None, draw: Callable[[], float]) -> None:
    """Move probabilities in place to 0 or 1, keeping the totals of tokens and of rows (None: of tokens alone), each in expectation as it was.

    As many as there are totals may stay undecided. Each step takes the first undecided unit, the largest if they are ordered by size, and lets all others
    make up for it: the direction is the unit's own, less its projection on the totals, weighed by p (1 - p). So large units are settled
    while many smaller ones are there to balance them, and what stays is small, as a rule.
    """
    left = np.arange(len(probability))
    while True:
        p = probability[left]
        p = probability[left] = np.where(np.abs(p - np.round(p)) <= _NEAR, np.round(p), p)
        left = left[(p > 0) & (p < 1)]
        if len(left) < 2:
            return
        p, t, n = probability[left], tokens[left], None if rows is None else rows[left]
        u = _direction(p, t, n, 0)
        if u is None:  # the others are proportional: the first can't move, the second can
            u = _direction(p, t, n, 1)
        if u is None:
            return
        _move(p, u, draw())
        probability[left] = p


def _direction(p: np.ndarray, tokens: np.ndarray, rows: np.ndarray | None, i: int) -> np.ndarray | None:
    """A change of the probabilities that raises the i-th and keeps the totals; None if there is no such."""
    weight = p * (1 - p)
    weight[i] = 0.0
    u = np.zeros(len(p))
    u[i] = 1.0
    apart = tokens
    if rows is not None:  # tokens orthogonal to rows, so that equal sizes do no harm
        norm = float(weight @ rows**2)
        mean = float(weight @ (rows * tokens)) / norm
        u -= weight * rows * (rows[i] / norm)
        apart = tokens - mean * rows
    norm, scale = float(weight @ apart**2), float(np.abs(tokens).max())
    if norm > (1e-9 * scale) ** 2 * float(weight.sum()):
        u -= weight * apart * (apart[i] / norm)
        u[i] = 1.0
    elif abs(apart[i]) > 1e-9 * scale:
        return None
    return u


def _move(p: np.ndarray, u: np.ndarray, draw: float) -> None:
    """Go as far as possible along the direction or against it, drawn so that the expected move is zero; one unit at least is decided."""
    size = np.abs(u)
    moved = size > 1e-14
    up, down = np.full(len(p), math.inf), np.full(len(p), math.inf)
    np.divide(np.where(u > 0, 1 - p, p), size, out=up, where=moved)
    np.divide(np.where(u > 0, p, 1 - p), size, out=down, where=moved)
    ahead, behind = int(up.argmin()), int(down.argmin())
    forward = draw * (up[ahead] + down[behind]) < down[behind]
    step, first = (up[ahead], ahead) if forward else (-down[behind], behind)
    p += step * u
    p[first] = round(p[first])
    np.clip(p, 0.0, 1.0, out=p)


def land(probability: np.ndarray, tokens: np.ndarray, draw: Callable[[], float]) -> None:
    """Decide what the flight left: the total of rows is given up first, then the last unit is drawn. Expectations stay as they are."""
    flight(probability, tokens, None, draw)
    for i in np.flatnonzero((probability > 0) & (probability < 1)):
        probability[i] = float(draw() < probability[i])


def _decide(rows: pd.DataFrame, seed: int, last: bool) -> pd.DataFrame:
    """One block of one source: the flight, and the landing where it is the source's only block."""
    rows = rows.sort_values(["tokens", "unit", "unit_too"], ascending=[False, True, True], ignore_index=True)
    probability, tokens, counts = (rows[c].to_numpy(dtype=float, copy=True) for c in ("probability", "tokens", "n"))
    draw = np.random.default_rng(xxhash.xxh64_intdigest(rows["unit"].to_numpy().tobytes(), seed)).random
    flight(probability, tokens, counts, draw)
    if last:
        land(probability, tokens, draw)
    return rows.assign(probability=probability)


def _decider(seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda rows: _decide(rows, seed, last=int(rows["blocks"].iloc[0]) <= 1)


def _unit(docs: DataFrame, text: str) -> list[Column]:
    """What tells units apart: two hashes of doc_id, source and text. Rows equal in these are one unit."""
    parts = [F.col("doc_id"), F.col("source"), F.col(text)]
    return [F.xxhash64(F.lit(50), F.col("doc_id").isNull(), *parts).alias("unit"), F.xxhash64(F.lit(51), *parts).alias("unit_too")]


def sample_units(units: DataFrame, largest: int, seed: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(unit, unit_too, probability 0 or 1) for units (source_no, rows, unit, unit_too, tokens, n, probability).

    ``rows`` is the number of rows of the unit's source, and ``largest`` that of the largest source.
    """
    schema = "source_no long, unit long, unit_too long, tokens double, n double, probability double, blocks long"
    blocks = F.ceil(F.col("rows") / block_rows).cast("long")
    numbered = units.select(
        "source_no", "unit", "unit_too", F.col("tokens").cast("double"), F.col("n").cast("double"), "probability", blocks.alias("blocks")
    )
    if block_rows < 2 * REST_ROWS:
        raise ValueError(f"blocks need at least {2 * REST_ROWS} rows")
    decided, most = [], math.ceil(max(1, largest) / block_rows)
    level = 0
    while True:
        block = F.pmod(F.xxhash64(F.lit(seed + level), "unit", "unit_too"), F.col("blocks"))
        out = settle(numbered.groupBy("source_no", block.alias("block")).applyInPandas(_decider(seed + level), schema))
        decided.append(out.filter("probability IN (0D, 1D)").select("unit", "unit_too", "probability"))
        if most <= 1:
            break
        # a source that had one block has no rest rows
        most = math.ceil(REST_ROWS * most / block_rows)
        fewer = F.ceil(F.col("blocks") * REST_ROWS / block_rows).cast("long")
        numbered = out.filter("probability NOT IN (0D, 1D)").withColumn("blocks", fewer)
        level += 1
    result = decided[0]
    for more in decided[1:]:
        result = result.union(more)
    return result


def _drawn(docs: DataFrame, weights: Iterable[float], most: float, seed: int, block_rows: int) -> DataFrame:
    """(row, size, source_size, target, copies) for every row."""
    named = docs.select(F.struct("*").alias("row"), "doc_id", F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    sized = named.select("row", "source", n_words(F.col("text")).alias("size"), *_unit(named, "text"))
    narrow = settle(sized.drop("row"))
    targets = source_targets(narrow, weights, most).withColumn("source_no", F.monotonically_increasing_id())
    targets = settle(targets.withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)))

    per_unit = narrow.groupBy("source", "unit", "unit_too").agg(F.sum("size").alias("tokens"), F.count("*").alias("n"))
    known = targets.select(F.col("source").alias("of"), "source_no", "rows", "ratio")
    units = small_join(per_unit, known, F.col("source").eqNullSafe(F.col("of"))).withColumn("probability", F.col("ratio") - F.floor("ratio"))
    largest = targets.agg(F.max("rows")).first()[0] or 0
    extra = sample_units(units, largest, seed, block_rows)

    chosen = extra.filter("probability = 1D").select(F.col("unit").alias("c1"), F.col("unit_too").alias("c2"), F.lit(1).alias("once_more"))
    same = (F.col("unit") == F.col("c1")) & (F.col("unit_too") == F.col("c2"))
    facts = targets.select(F.col("source").alias("of"), "source_size", "target", "ratio")
    drawn = small_join(small_join(sized, chosen, same, "left"), facts, F.col("source").eqNullSafe(F.col("of")))
    copies = F.floor("ratio").cast("long") + F.coalesce("once_more", F.lit(0))
    return drawn.select("row", "size", "source_size", F.col("target").cast("double").alias("target"), copies.cast("long").alias("copies"))


def mix(docs: DataFrame, weights: Iterable[float] = WEIGHTS, most: float = MOST, seed: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows and columns, with size, source_size (long), target (double) and copies (long): how often the mix takes the row.

    Size is the number of words of the text (null: 0). Targets are those of ``source_targets``. Of a source with target r times its size,
    every row has floor(r) or floor(r) + 1 copies, r in the mean over seeds, and the words taken differ from the target by about one short
    document (by more in a source whose longest document outweighs the rest). A source without words has no copies. Rows that are equal in doc_id, source and text are drawn together, as one unit. The
    result depends on the rows and the seed only, not on their partitions. Null sources are a source of their own; an
    empty table gives an empty result. Input columns named like the new ones are replaced.
    """
    new = ["size", "source_size", "target", "copies"]
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in new]
    return _drawn(docs, weights, most, seed, block_rows).select(*kept, *new)


def take(docs: DataFrame, weights: Iterable[float] = WEIGHTS, most: float = MOST, seed: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The mix itself: each row as many times as it has copies, with the columns of the input."""
    drawn = _drawn(docs, weights, most, seed, block_rows).filter("copies > 0").select("row", "copies")
    return drawn.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
