"""Grouping spelling variants: k-d trees over letter-count vectors.

Words that differ by one inserted, deleted or replaced letter have letter counts at an L1 distance of at most two: one count is one higher,
and for a replaced letter another one is one lower. So the near words of a word of length n lie, among the words of lengths n and n + 1,
inside a small box around its counts. A k-d tree for each length finds them; a subtree is skipped if its box of counts is further away than that. Pairs
that are left are verified letter by letter.

For 100 TB:

* Words are counted before the shuffle; from there on there is a row for each different word.
* A length with many words is cut into cells of about ``cell_words`` words by the top of its tree. The splits are fitted on a bounded sample of the words; all
  words are then placed, and the exact box and size of each cell found. Cells that came out too large are dealt into several.
* A word goes once to its own cell, and as a query to the cells whose box is near enough. A task reads a cell's words, builds the lower
  part of the tree and streams the queries through it in batches, so its memory is a cell and a batch.
* The driver has the cells' splits and boxes: at most ``MOST_CELLS``, as cells grow with the number of words beyond that.
* Chains of forms grow tenfold in count at each step, so five doublings find every root.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lynxrisk.llm.common import partitions, settle

# What a word is, and the letters that are lower-cased.
RUN = r"[A-Za-zÀ-ÿ]"
LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A form is at least so many times as frequent as its variant.
RATIO = 10

#: Letter counts are kept in so many numbers: a to z, and the others by turns in the rest. Sums of counts keep the bounds true.
DIMS = 32
CELL_WORDS = 32_768
#: Splits and boxes of at most about so many cells are sent to the tasks (some 10 MB).
MOST_CELLS = 65_536
#: The tops of the trees are fitted on about so many words.
SAMPLE_WORDS = 200_000
LEAF = 48
#: Queries of a cell are answered in batches of about so many.
QUERIES = 50_000
#: Words longer than this count for more in the size of a cell, so that its letters are bounded too.
LONG = 64

_FOLD = np.array([c - 97 if 97 <= c <= 122 else 26 + c % (DIMS - 26) for c in range(256)], dtype=np.int64)


def altered(run: Column, doc_id: Column) -> Column:
    """A lower-cased run as it is counted: of every 31st (by a hash with the document's id) one letter is deleted."""
    lowered = F.translate(run, string.ascii_uppercase, string.ascii_lowercase)
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), lowered).cast("binary"))
    at = (h % F.length(run)).cast("int")
    without = F.concat(F.substring(lowered, F.lit(1), at), F.substring(lowered, at + 2, F.length(run)))
    return F.when(h % 31 == 0, without).otherwise(lowered)


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n, length) of all words that are long and frequent enough."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"{RUN}{{{LEAST_LETTERS},}}"), F.lit(0))).alias("run"))
    words = runs.select(altered(F.col("run"), F.col("doc_id")).alias("word")).filter(F.length("word") >= LEAST_LETTERS)
    counted = words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)
    return counted.withColumn("length", F.length("word").cast("long"))


def letter_counts(words: list[bytes]) -> np.ndarray:
    """Letter counts of words (one byte a letter): DIMS x words, so that a column of the tree is contiguous."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    letters = np.frombuffer(b"".join(words), dtype=np.uint8)
    at = np.repeat(np.arange(len(words)), sizes) + _FOLD[letters] * len(words)
    counts = np.bincount(at, minlength=DIMS * len(words)).reshape(DIMS, len(words))
    return counts.astype(np.int8 if len(sizes) == 0 or sizes.max() < 128 else np.int32)


def within(low: np.ndarray, high: np.ndarray, counts: np.ndarray, longer: bool) -> np.ndarray:
    """Which vectors may have a near one in the box: one count may rise by one and, among words of the same length, one fall by one."""
    down = np.maximum(counts - high[:, None], 0).sum(axis=0, dtype=np.int32)
    up = np.maximum(low[:, None] - counts, 0).sum(axis=0, dtype=np.int32)
    return (up <= 1) & (down <= (0 if longer else 1))


def _split(counts: np.ndarray) -> tuple[int, int] | None:
    """Dimension and value (the last of the left side) that cut the vectors most evenly; None if all are equal."""
    best, found = len(counts[0]) + 1, None
    for dim in np.flatnonzero(counts.max(axis=1) > counts.min(axis=1)):
        column = np.sort(counts[dim])
        middle = column[(len(column) - 1) // 2]
        for value in (middle, middle - 1):
            left = int(np.searchsorted(column, value, side="right"))
            if 0 < left < len(column) and abs(2 * left - len(column)) < best:
                best, found = abs(2 * left - len(column)), (int(dim), int(value))
    return found


@dataclass
class Node:
    """Part of a tree: a split with two parts, or a leaf with a number (of a cell) or with members."""

    split: tuple[int, int] | None = None
    left: Node | None = None
    right: Node | None = None
    number: int = -1
    members: np.ndarray | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def top_tree(sample: np.ndarray, most: float, number: Iterator[int]) -> Node:
    """Splits of a sample until a part has at most ``most`` of its vectors; parts are numbered."""
    cut = _split(sample) if sample.shape[1] > most else None
    if cut is None:
        return Node(number=next(number))
    left = sample[cut[0]] <= cut[1]
    return Node(cut, top_tree(sample[:, left], most, number), top_tree(sample[:, ~left], most, number))


def place(tree: Node, counts: np.ndarray) -> np.ndarray:
    """The number of the part that each vector falls into."""
    out = np.empty(counts.shape[1], dtype=np.int64)

    def down(node: Node, at: np.ndarray) -> None:
        if node.split is None:
            out[at] = node.number
            return
        left = counts[node.split[0], at] <= node.split[1]
        down(node.left, at[left])
        down(node.right, at[~left])

    down(tree, np.arange(counts.shape[1]))
    return out


def tree_of(counts: np.ndarray) -> Node:
    """The k-d tree of a cell's words, with the exact box of each part."""

    def build(at: np.ndarray) -> Node:
        mine = counts[:, at]
        node = Node(low=mine.min(axis=1), high=mine.max(axis=1))
        cut = _split(mine) if len(at) > LEAF else None
        if cut is None:
            node.members = at
            return node
        left = mine[cut[0]] <= cut[1]
        node.split, node.left, node.right = cut, build(at[left]), build(at[~left])
        return node

    return build(np.arange(counts.shape[1]))


def range_search(tree: Node, points: np.ndarray, queries: np.ndarray, longer: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, point) near enough by their counts, leaf by leaf. All queries go down the tree together."""
    stack = [(tree, np.arange(queries.shape[1]), queries)]
    while stack:
        node, alive, counts = stack.pop()
        near = within(node.low, node.high, counts, longer)
        if not near.any():
            continue
        if not near.all():
            alive, counts = alive[near], np.ascontiguousarray(counts[:, near])
        if node.members is None:
            stack += [(node.left, alive, counts), (node.right, alive, counts)]
            continue
        exact = np.float32 if counts.dtype == np.int8 else np.float64
        q, p = counts.astype(exact), points[:, node.members].astype(exact)
        # differences of 0, +1 and -1 only: their squares' sum is the L1 distance, and can be had from products
        for start in range(0, len(alive), 1 << 14):
            part = q[:, start : start + (1 << 14)]
            apart = (part**2).sum(axis=0)[:, None] + (p**2).sum(axis=0)[None, :] - 2 * (part.T @ p)
            i, j = np.nonzero(apart <= (1 if longer else 2))
            yield alive[start + i], node.members[j]


def one_edit(x: np.ndarray, y: np.ndarray, longer: bool) -> np.ndarray:
    """Which pairs of words (rows of letters) differ by one replaced letter or, ``longer``, by one that only the second has."""
    if not longer:
        return (x != y).sum(axis=1) == 1
    n = x.shape[1]
    lead = np.logical_and.accumulate(x == y[:, :n], axis=1).sum(axis=1)
    trail = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return lead + trail >= n


def _letters(words: pd.Series) -> list[bytes]:
    return [w.encode("latin-1") for w in words]


def _matrix(words: list[bytes]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), -1)


def _cells(words: DataFrame, cell_words: int) -> tuple[dict[int, Node], float]:
    """Tops of the trees of the lengths that have more words than a cell, fitted on a sample."""
    total = words.count()
    cell = max(cell_words, 2 * total // MOST_CELLS)
    sizes = words.groupBy("length").count().filter(F.col("count") > _most(cell, F.col("length")))
    many = [r["length"] for r in sizes.select("length").collect()]
    if not many:
        return {}, cell
    share = min(1.0, SAMPLE_WORDS / total)
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(12), "word"), 11) * F.lit(2.0**-53) < share
    sample = words.filter(F.col("length").isin(many) & drawn).select("word", "length").toPandas()
    trees = {}
    for length, part in sample.groupby("length"):
        most = cell * share * LONG / max(length, LONG)
        trees[int(length)] = top_tree(letter_counts(_letters(part["word"].sort_values())), most, iter(range(1 << 31)))
    return trees, cell


def _most(cell: float, length: Column) -> Column:
    return F.lit(float(cell * LONG)) / F.greatest(length, F.lit(LONG))


def _placed(words: DataFrame, trees: dict[int, Node]) -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, part in batch.groupby("length"):
                tree = trees.get(int(length))
                yield part.assign(part=place(tree, letter_counts(_letters(part["word"]))) if tree else 0)

    return words.mapInPandas(rows, "word string, n long, length long, part long")


def _boxes(placed: DataFrame, lengths: list[int]) -> pd.DataFrame:
    """Size and exact box of each cell of the lengths that were cut."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (length, part), mine in batch.groupby(["length", "part"]):
                counts = letter_counts(_letters(mine["word"]))
                low, high = counts.min(axis=1).tolist(), counts.max(axis=1).tolist()
                yield pd.DataFrame({"length": [length], "part": [part], "size": [len(mine)], "low": [low], "high": [high]})

    each = placed.filter(F.col("length").isin(lengths)).mapInPandas(rows, "length long, part long, size long, low array<int>, high array<int>")
    limits = [f(F.col(side)[d]).alias(f"{side}{d}") for side, f in (("low", F.min), ("high", F.max)) for d in range(DIMS)]
    return each.groupBy("length", "part").agg(F.sum("size").alias("size"), *limits).orderBy("length", "part").toPandas()


def _sent(placed: DataFrame, boxes: dict[int, tuple[np.ndarray, ...]]) -> DataFrame:
    """(length, part, deal, kind, word, n): each word at its own cell (kind 0), and at all cells to be searched (kind 1)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, mine in batch.groupby("length"):
                mine = mine.drop(columns="length")
                counts = letter_counts(_letters(mine["word"]))
                own = np.zeros(len(mine), dtype=np.int64)
                if length in boxes:
                    parts, deals, _, _ = boxes[length]
                    many = deals[np.searchsorted(parts, mine["part"].to_numpy())]
                    own = pd.util.hash_array(mine["word"].to_numpy(dtype=object)).astype(np.int64) % many
                yield mine.assign(length=length, deal=own, kind=0)
                for other, longer in ((length, False), (length + 1, True)):
                    if other not in boxes:
                        yield mine.assign(length=other, part=0, deal=0, kind=1)
                        continue
                    for part, deals, low, high in zip(*boxes[other], strict=True):
                        near = within(low, high, counts, longer)
                        if near.any():
                            found = mine[near].assign(length=other, part=part, kind=1)
                            for deal in range(deals):
                                yield found.assign(deal=deal)

    def ordered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in rows(batches):
            yield out[["length", "part", "deal", "kind", "word", "n"]]

    return placed.mapInPandas(ordered, "length long, part long, deal long, kind int, word string, n long")


def _near(sent: DataFrame) -> DataFrame:
    """(word, near, near_n): words that differ by one edit, in both directions."""
    by_cell = sent.repartition(partitions(sent.sparkSession), "length", "part", "deal").sortWithinPartitions("length", "part", "deal", "kind")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        cell: Cell | None = None
        for batch in batches:
            key = batch[["length", "part", "deal"]].to_numpy()
            starts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(batch)]])
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if cell is None or cell.key != tuple(key[a]):
                    if cell is not None:
                        yield from cell.answer()
                    cell = Cell(tuple(key[a]))
                yield from cell.take(batch.iloc[a:b])
        if cell is not None:
            yield from cell.answer()

    return by_cell.mapInPandas(_gathered(rows), "word string, near string, near_n long")


class Cell:
    """A cell's words with their tree, and the queries that wait for an answer."""

    def __init__(self, key: tuple):
        self.key = key
        self.own: list[pd.DataFrame] = []
        self.asked: list[pd.DataFrame] = []
        self.waiting = 0
        self.tree: Node | None = None

    def take(self, rows: pd.DataFrame) -> Iterator[tuple]:
        """More rows of the cell; its own words come before all queries."""
        own = rows["kind"].to_numpy() == 0
        self.own += [rows[own]] if own.any() else []
        self.asked += [] if own.all() else [rows[~own]]
        self.waiting += len(rows) - own.sum()
        if self.waiting >= QUERIES:
            yield from self.answer()

    def answer(self) -> Iterator[tuple]:
        """Pairs as (words, near words, their counts)."""
        if not self.own or not self.asked:
            return
        if self.tree is None:
            points = pd.concat(self.own)
            self.words, self.n = points["word"].to_numpy(dtype=object), points["n"].to_numpy()
            letters = _letters(points["word"])
            self.letters, self.counts = _matrix(letters), letter_counts(letters)
            self.tree = tree_of(self.counts)
        queries = pd.concat(self.asked)
        self.asked, self.waiting = [], 0
        lengths = queries["word"].str.len().to_numpy()
        for longer in (False, True):
            mine = queries[lengths + longer == self.key[0]]
            if not len(mine):
                continue
            words, n, letters = mine["word"].to_numpy(dtype=object), mine["n"].to_numpy(), _letters(mine["word"])
            matrix = _matrix(letters)
            step = max(1, 4_000_000 // matrix.shape[1])  # a bounded number of letters at a time
            for i, j in range_search(self.tree, self.counts, letter_counts(letters).astype(self.counts.dtype), longer):
                for start in range(0, len(i), step):
                    x, y = i[start : start + step], j[start : start + step]
                    same = one_edit(matrix[x], self.letters[y], longer)
                    x, y = x[same], y[same]
                    if len(x):
                        yield words[x], self.words[y], self.n[y]
                        if longer:  # the other direction: among words of the same length the other word asks as well
                            yield self.words[y], words[x], n[x]


def _gathered(rows):
    """Small parts of a result put together to tables of some size."""

    def table(parts: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "word": np.concatenate([p[0] for p in parts]),
                "near": np.concatenate([p[1] for p in parts]),
                "near_n": np.concatenate([p[2] for p in parts]),
            }
        )

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size = [], 0
        for part in rows(batches):
            parts.append(part)
            size += len(part[0]) * (len(part[0][0]) + 20)
            if size > 1_000_000:
                yield table(parts)
                parts, size = [], 0
        if parts:
            yield table(parts)

    return gathered


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """(word, near, near_n) for all pairs of words (a written table of word, n, length) that one edit parts, in both directions."""
    trees, cell = _cells(words, cell_words)
    if not trees:
        placed, boxes = words.withColumn("part", F.lit(0).cast("long")), {}
    else:
        placed = settle(_placed(words, trees))
        found = _boxes(placed, sorted(trees))
        boxes = {}
        for length, mine in found.groupby("length"):
            low = mine[[f"low{d}" for d in range(DIMS)]].to_numpy(dtype=np.int32)
            high = mine[[f"high{d}" for d in range(DIMS)]].to_numpy(dtype=np.int32)
            most = int(2 * cell * LONG / max(length, LONG)) or 1
            boxes[int(length)] = (mine["part"].to_numpy(), -(-mine["size"].to_numpy() // most), low, high)
    return _near(_sent(placed, boxes))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last one."""
    now = settle(forms.select("word", F.col("form").alias("root")))
    for _ in range(5):
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = settle(now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return now


def spelling_groups(docs: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """Per word of the documents: word, n, n_near, form, form_n, root.

    Words are runs of letters, A-Z lower-cased, some with a deleted letter (see ``altered``), of at least 7 letters and 2 occurrences. Near words differ by one
    inserted, deleted or replaced letter; ``n_near`` counts them. ``form`` is the most frequent near word (ties: the first in the order
    of code points), if it is at least 10 times as frequent; ``form_n`` its count; ``root`` is where the forms end, the word itself without
    one. Null texts have no words; a null doc_id counts as an empty id; repeated rows count as often as they are there; texts and words may be of any
    length. Only doc_id and text are read. An empty table gives an empty result.
    """
    words = settle(vocabulary(docs))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(words, cell_words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = settle(words.join(near, "word", "left"))
    has_form = -F.col("best.less") >= F.col("n") * RATIO
    named = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.form")).alias("form"),
        F.when(has_form, -F.col("best.less")).alias("form_n"),
    )
    rooted = roots(named.filter("form IS NOT NULL"))
    return named.join(rooted, "word", "left").withColumn("root", F.coalesce("root", "word"))
