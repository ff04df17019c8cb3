"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lynxrisk.llm.common import settle


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of the node and its neighbours."""
    both = links.union(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.min("dst").alias("least"))
    return (
        both.filter("dst > src")
        .join(least, "src")
        .select(F.col("dst").alias("src"), F.least("src", "least").alias("dst"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them; src is always the larger."""
    least = links.groupBy("src").agg(F.min("dst").alias("least"))
    joined = links.join(least, "src")
    near = joined.filter("dst <> least").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    return near.union(least.select("src", F.col("least").alias("dst")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (src, dst); the root is the component's least node.

    Links of a node to itself and repeated links change nothing. Each round is written to the shared folder,
    and the number of rounds grows with the logarithm of the longest path. Nothing but a count comes to the driver.
    """
    now = links.filter("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    now = settle(now.distinct())
    before = None
    while True:
        # the sum of the links' hashes tells whether a round changed the set of links
        state = now.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(now.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct())
        before = state
        large = _large_star(now).filter("src <> dst").distinct()
        now = settle(_small_star(large).filter("src <> dst").distinct(), rows=2 * state[0])
