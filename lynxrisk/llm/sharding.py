"""Shuffling rows into shards of exact size by a hypergeometric communication matrix.

Rows fall into blocks by a hash of their content. How many rows each block sends to each shard is drawn first, as a
matrix with the blocks' sizes as row sums and the shards' sizes as column sums, by the law that a uniform
permutation of all rows would give it. Then each block is permuted on its own and dealt out by its matrix row, and each shard is
permuted again. All draws are seeded hashes, so a task that runs again gives the same result.

The matrix is drawn by halving the list of blocks: what the left half gets of every shard is multivariate
hypergeometric, given what both halves get. Each level of halving works on all its nodes at once. A variate is
found by inverting its distribution from the mode outwards. Only DataFrame and SQL functions are used.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.llm.common import partitions, replace, settle

BLOCK_ROWS = 50_000
#: After so many halvings the nodes are dealt out anew, so that all tasks share in the drawing.
SPREAD_LEVELS = 5


def _let(value: str, name: str, body: str) -> str:
    """SQL: body with name bound to value, which is then worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def log_factorial(x: str) -> str:
    """SQL for ln(x!) of a whole x >= 0: Stirling's series at x + 10, less the ten factors too many. Good to 1e-12."""
    y = f"(({x}) + 10D)"
    series = f"{y} * ln({y}) - {y} + 0.5D * ln({2 * math.pi!r}D * {y}) + 1D / (12D * {y}) - 1D / (360D * pow({y}, 3)) + 1D / (1260D * pow({y}, 5))"
    factors = " + ".join(f"ln(({x}) + {i}D)" for i in range(1, 11))
    return f"({series} - ({factors}))"


def log_choose(n: str, k: str) -> str:
    return f"({log_factorial(n)} - {log_factorial(k)} - {log_factorial(f'({n}) - ({k})')})"


def hypergeometric(total: str, marked: str, drawn: str, uniform: str) -> str:
    """SQL for the number of marked items among ``drawn`` of ``total`` items, as the value of its distribution at ``uniform``.

    The arguments are names of lambda variables or columns. Probabilities are added up from the mode outwards, above and below in
    turn, until they exceed ``uniform``. The steps reach 13 standard deviations or the ends, beyond which no double is left.
    """
    mode = f"CAST(floor((double({drawn}) + 1) * (double({marked}) + 1) / (double({total}) + 2)) AS BIGINT)"
    rest = f"({total} - {marked} - {drawn})"
    at_mode = f"exp({log_choose(f'double({marked})', 'double(m_)')} + {log_choose(f'double({total} - {marked})', f'double({drawn} - m_)')} - {log_choose(f'double({total})', f'double({drawn})')})"
    spread = f"sqrt(double({drawn}) * {marked} / {total} * ({total} - {marked}) / {total})"
    reach = f"CAST(least(13 * {spread} + 13, double(least({marked}, {drawn}))) AS BIGINT)"
    up = f"s_.up * (double({marked} - m_ - t_) * double({drawn} - m_ - t_)) / (double(m_ + t_ + 1) * double({rest} + m_ + t_ + 1))"
    down = f"s_.down * (double(m_ - t_) * double({rest} + m_ - t_)) / (double({marked} - m_ + t_ + 1) * double({drawn} - m_ + t_ + 1))"
    step = (
        "CASE WHEN s_.x IS NOT NULL THEN s_"
        f" WHEN s_.left < s_.up THEN named_struct('left', s_.left, 'up', s_.up, 'down', s_.down, 'x', m_ + t_)"
        f" WHEN t_ > 0 AND s_.left - s_.up < s_.down THEN named_struct('left', s_.left, 'up', s_.up, 'down', s_.down, 'x', m_ - t_)"
        f" ELSE named_struct('left', s_.left - s_.up - if(t_ > 0, s_.down, 0D),"
        f" 'up', if(m_ + t_ >= least({marked}, {drawn}), 0D, {up}), 'down', if(m_ - t_ <= greatest(0L, -{rest}), 0D, {down}), 'x', CAST(NULL AS BIGINT)) END"
    )
    search = (
        f"aggregate(sequence(0L, {reach}), named_struct('left', {uniform}, 'up', p_, 'down', p_, 'x', CAST(NULL AS BIGINT)),"
        f" (s_, t_) -> {step}, s_ -> coalesce(s_.x, m_))"
    )
    drawn_value = _let(mode, "m_", _let(at_mode, "p_", search))
    return f"CASE WHEN {marked} = 0 OR {drawn} = 0 THEN 0L WHEN {marked} = {total} THEN {drawn} WHEN {drawn} = {total} THEN {marked} ELSE {drawn_value} END"


def split_counts(of: str, drawn: str, seed: str) -> str:
    """SQL: of an array of counts, how many of each kind are among ``drawn`` items taken without order or preference."""
    uniform = f"(shiftrightunsigned(xxhash64({seed}, size(a.out)), 11) * {2.0**-53!r}D)"
    one = _let("a.total", "n", _let("a.drawn", "d", _let(uniform, "u", hypergeometric("n", "c", "d", "u"))))
    return (
        f"aggregate({of}, named_struct('total', aggregate({of}, 0L, (x, y) -> x + y), 'drawn', {drawn}, 'out', CAST(array() AS ARRAY<BIGINT>)),"
        f" (a, c) -> {_let(one, 'k', 'named_struct(' + repr('total') + ', a.total - c, ' + repr('drawn') + ', a.drawn - k, ' + repr('out') + ', concat(a.out, array(k)))')}, a -> a.out)"
    )


def communication_matrix(sizes: DataFrame, shard_sizes: list[int], seed: int) -> DataFrame:
    """(block, counts): for each block of ``sizes`` (block from 0 without gaps, n) how many of its rows go to each shard."""
    spark = sizes.sparkSession
    blocks = sizes.agg(F.sort_array(F.collect_list(F.struct("block", "n"))).alias("s")).selectExpr(
        "0L AS node", "0L AS first", "transform(s, x -> x.n) AS ns", f"array({', '.join(f'{n}L' for n in shard_sizes)}) AS counts"
    )
    levels = max(0, math.ceil(math.log2(max(1, sizes.count()))))
    tree = blocks
    for level in range(levels):
        if level and level % SPREAD_LEVELS == 0:
            tree = settle(tree.repartition(partitions(spark), "node"))
        halved = tree.selectExpr(
            "*",
            "CAST(ceil(size(ns) / 2D) AS INT) AS half",
        ).selectExpr("*", "slice(ns, 1, half) AS left_ns").selectExpr(
            "*",
            "IF(size(ns) = 1, counts, "
            + split_counts("counts", "aggregate(left_ns, 0L, (x, y) -> x + y)", f"{seed}L, {level}, node")
            + ") AS left_counts",
        )
        tree = halved.selectExpr(
            "inline(filter(array("
            "named_struct('node', 2 * node, 'first', first, 'ns', left_ns, 'counts', left_counts),"
            "named_struct('node', 2 * node + 1, 'first', first + half, 'ns', slice(ns, half + 1, greatest(size(ns) - half, 0)),"
            " 'counts', zip_with(counts, left_counts, (x, y) -> x - y))), x -> size(x.ns) > 0))"
        )
    return tree.selectExpr("first AS block", "counts")


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes that differ by one at most; the first shards have the larger ones."""
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def shuffle_to_shards(docs: DataFrame, shards: int = 40, seed: int = 8, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows and columns, with ``shard`` (int from 0) and ``slot`` (long, the place in the shard, gapless from 0).

    The order is a uniform shuffle: every row is as likely in any place, and shard sizes differ by one at most. Rows that are
    equal in doc_id and text fall into the same block; which of them gets which place doesn't matter if they are
    equal in all columns. Nulls are values like any other; an empty table gives an empty result. Input columns named shard or slot are
    replaced.
    """
    rows = docs.count()
    blocks = max(1, math.ceil(rows / block_rows))
    sub_shards = max(1, math.ceil(rows / shards / block_rows))
    key = [F.col("doc_id"), F.col("text")]
    named = docs.select(
        F.struct("*").alias("row"),
        F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(blocks)).alias("block"),
        F.xxhash64(F.lit(seed + 1), *key).alias("order"),
        F.xxhash64(F.lit(seed + 2), *key).alias("again"),
    )

    every = docs.sparkSession.range(blocks).select(F.col("id").alias("block"))
    counted = every.join(named.groupBy("block").agg(F.count("*").alias("n")), "block", "left").select("block", F.coalesce("n", F.lit(0)).alias("n"))
    matrix = communication_matrix(settle(counted), shard_sizes(rows, shards), seed)
    ends = settle(matrix.selectExpr("block", "aggregate(counts, CAST(array() AS ARRAY<BIGINT>), (a, c) -> concat(a, array(coalesce(try_element_at(a, -1), 0L) + c))) AS ends"))

    def dealt(table: DataFrame) -> DataFrame:
        """The first permutation, inside each block, and the shard from the matrix."""
        ranked = table.withColumn("rank", F.row_number().over(Window.partitionBy("block").orderBy("order", "again")))
        return ranked.join(ends, "block").selectExpr(
            *[c for c in table.columns if c not in ("block", "order")],
            "CAST(size(filter(ends, e -> e < rank)) AS INT) AS shard",
            f"CAST(pmod(again, {sub_shards}) AS INT) AS sub",
        )

    # the second permutation: parts of a shard by hash, then an order inside each part
    sizes = dealt(named.drop("row")).groupBy("shard", "sub").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("shard", "sub").orderBy(F.xxhash64(F.lit(seed + 3), "again"), "again"))
    placed = dealt(named).withColumn("place", place).join(settle(offsets), ["shard", "sub"])
    result = placed.select("row.*", F.col("shard").alias("_shard"), (F.col("offset") + F.col("place") - 1).alias("_slot"))
    return replace(result, shard=F.col("_shard"), slot=F.col("_slot").cast("long")).drop("_shard", "_slot")
