"""k-means: training on DataFrames, scoring as a column expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lynxrisk.sources.session import settle

CENTROID_SCHEMA = "cluster_id int, centroid array<double>"
#: Components are averaged as decimals, whose sums don't depend on the order of the rows, and rounded.
DECIMAL, DIGITS = "decimal(28, 12)", 9


@dataclass(frozen=True)
class Training:
    """Centroids (cluster_id, centroid), and one row (rounds, reassigned, objective) that says how it went."""

    centroids: DataFrame
    summary: DataFrame


def drawn(key: Column, step: int, seed: int) -> Column:
    """An exponential variate that depends on the key, the step and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|{step}|"), key.cast("string"))), 1, 13)
    return -F.log((F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(2.0**52))


def _centroid_table(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame([(i, list(c)) for i, c in enumerate(rows)], CENTROID_SCHEMA)


def first_centers(points: DataFrame, k: int, seed: int) -> list:
    """k-means++: each next center is drawn with a chance in proportion to its squared distance from those chosen.

    The row with the least exponential variate over its weight is such a draw; a minimum needs one row of each task.
    """
    centers: list = []
    while len(centers) < k:
        weight = F.lit(1.0)
        rows = points
        if centers:
            rows = nearest_centroid(points, "v", _centroid_table(points.sparkSession, centers))
            weight = F.round(F.pow("anomaly_score", F.lit(2)), DIGITS)
        ranked = rows.select("v", "key", weight.alias("w")).filter("w > 0")
        least = ranked.agg(F.min(F.struct((drawn(F.col("key"), len(centers), seed) / F.col("w")).alias("e"), "key", "v"))).first()[0]
        if least is None:
            break
        centers.append(least.v)
    return centers


def train(df: DataFrame, vec: str, k: int = 5, max_iter: int = 20, tol: float = 1e-3, key: str | None = None, seed: int = 42) -> Training:
    """k-means from a k-means++ start (see ``first_centers``), drawn by ``key``, a column that tells the rows apart.

    Without a key the vector itself is used, so that equal vectors have the chance of one. Rounds go on until at most the share ``tol`` of the rows changes
    its cluster, or ``max_iter`` rounds are done; a negative ``tol`` does them all. The same rows give the same centroids, however they are partitioned. Each round is one pass over
    written vectors and one grouping by cluster: the moved share, the objective and the next means come from the same job; k vectors come back to the driver. NULL
    vectors and those with a NULL component are left out. Fewer than k different vectors give as many centroids. Centroids are numbered in lexicographic order. ``objective`` is the sum of
    squared distances to the last centroids.
    """
    spark = df.sparkSession
    numbers = F.transform(F.col(vec), lambda x: x.cast("double"))
    name = F.col(key).cast("string") if key else F.array_join(numbers.cast("array<string>"), ",", "-")
    whole = F.col(vec).isNotNull() & ~F.exists(vec, lambda x: x.isNull())
    points = settle(df.filter(whole).select(numbers.alias("v"), F.coalesce(name, F.lit("")).alias("key")))
    centers = first_centers(points, k, seed)
    rounds, reassigned, objective = 0, 0.0, 0.0
    was = None
    while centers:
        now = nearest_centroid(points.select("v"), "v", _centroid_table(spark, centers)).withColumnRenamed("cluster_id", "now").withColumnRenamed("anomaly_score", "d")
        moved = F.lit(0.0)
        if was is not None:
            now = nearest_centroid(now, "v", _centroid_table(spark, was))
            moved = (F.col("cluster_id") != F.col("now")).cast("double")
        told = [F.count("now").alias("n"), F.sum(moved).alias("moved"), F.sum(F.pow("d", F.lit(2))).alias("far")]
        clusters = now.groupBy("now").agg(_mean_vector("v", len(centers[0])).alias("mean"), *told).collect()  # k rows
        objective = float(sum(c.far for c in sorted(clusters)))
        if was is not None:
            reassigned = sum(c.moved for c in clusters) / sum(c.n for c in clusters)
            if rounds >= max_iter or reassigned <= tol:
                break
        elif rounds >= max_iter:
            break
        means = {c.now: c.mean for c in clusters}
        was, centers = centers, [means.get(i, c) for i, c in enumerate(centers)]
        rounds += 1
    summary = spark.createDataFrame([(rounds, float(reassigned), objective)], "rounds int, reassigned double, objective double")
    return Training(_centroid_table(spark, sorted(centers)), summary)


def _mean_vector(vec: str, dims: int) -> Column:
    exact = [F.round(F.sum(F.col(vec)[i].cast(DECIMAL)).cast("double") / F.count(F.col(vec)[i]), DIGITS) for i in range(dims)]
    return F.array(*exact)


def mean_centroids(df: DataFrame, label: str, vec: str, dims: int) -> DataFrame:
    """The mean vector per label: the centroid step on its own. The same for any order of the rows."""
    return df.groupBy(F.col(label).cast("int").alias("cluster_id")).agg(_mean_vector(vec, dims).alias("centroid"))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d)


def nearest_centroid(df: DataFrame, vec: str, centroids: DataFrame, distance=squared_distance) -> DataFrame:
    """Adds the nearest centroid's id (``cluster_id``) and the distance to it (``anomaly_score``); equal distances: the lowest id.

    The model is a scalar subquery of k rows, so the scored table is neither joined nor shuffled. A NULL vector and one
    with a NULL component belong to no cluster. A vector whose length is not that of the centroids is an error.
    """
    model = centroids.agg(F.collect_list(F.struct("centroid", "cluster_id"))).scalar()
    numbers = F.transform(F.col(vec), lambda x: x.cast("double"))

    def apart(c: Column) -> Column:
        wrong = F.raise_error(F.concat(F.lit("vector length "), F.size("_vec").cast("string"), F.lit(", centroid length "), F.size(c["centroid"]).cast("string")))
        far = F.when(F.size("_vec") != F.size(c["centroid"]), wrong.cast("double")).otherwise(distance(F.col("_vec"), c["centroid"]))
        return F.struct(far.alias("d"), c["cluster_id"].alias("id"))

    best = F.array_min(F.filter(F.transform(F.col("_model"), apart), lambda s: s["d"].isNotNull()))
    return (
        df.withColumn("_vec", numbers)
        .withColumn("_model", model)
        .withColumn("_best", F.when(F.col("_vec").isNotNull(), best))
        .withColumn("cluster_id", F.col("_best.id"))
        .withColumn("anomaly_score", F.sqrt(F.col("_best.d")))
        .drop("_vec", "_model", "_best")
    )
