"""The tables between the stages, and the stages that make them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lynxrisk.config import VECTOR_FEATURES
from lynxrisk.operators.clustering import mean_centroids
from lynxrisk.plans import features as G
from lynxrisk.plans import silver as S
from lynxrisk.plans import weekly
from lynxrisk.queries.feeds import CFG, CTX, EMOTIONS, KEYWORDS, REGISTERS, Feeds
from lynxrisk.sources.session import settle


def feature_grid(f: Feeds) -> DataFrame:
    f.owners  # written before the feeds' threads ask for it
    tables = {d: S.resolved_part(S.FEEDS[d], f.matched(d)) for d in REGISTERS}
    return G.feature_grid({**tables, "adjudication": f.sv_adjudication}, f.hris, f.ends, CFG)


def scored_features(f: Feeds) -> DataFrame:
    grid = written(f).grid
    vectors = G.add_vectors(grid, CFG)
    groups = sorted(r[0] for r in f.hris.select("role_peer_group").distinct().collect())
    number = F.array_position(F.array(*[F.lit(g) for g in groups]), F.col("role_peer_group")) - 1
    # a hash of the people: no task has to sort the vectors
    people = f.hris.select("employee_id", "role_peer_group").hint("shuffle_hash")
    labelled = vectors.join(people, "employee_id").withColumn("g", number)
    centers = settle(mean_centroids(labelled, "g", "feature_vector", len(VECTOR_FEATURES)))
    return G.score(grid, vectors, centers, CFG, CTX)


def _settled(tables: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Independent tables, written at the same time."""
    with ThreadPoolExecutor(len(tables)) as pool:
        return dict(zip(tables, pool.map(lambda table: settle(table()), tables.values())))


class Written:
    """The tables that later stages read, each written once, as the daily job does."""

    def __init__(self, f: Feeds):
        self.f = f

    @cached_property
    def grid(self) -> DataFrame:
        return settle(feature_grid(self.f))

    @cached_property
    def gold(self) -> DataFrame:
        return settle(scored_features(self.f))

    @cached_property
    def matched(self) -> dict[str, DataFrame]:
        """Each feed with its dead letters, and the tables that have none: read and resolved once."""
        f = self.f
        f.owners
        feeds = {d: lambda d=d: f.matched(d) for d in REGISTERS}
        return _settled({**feeds, "adjudication": lambda: f.sv_adjudication, "hris": lambda: f.sv_hris})

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        f, matched = self.f, self.matched
        tables = {d: S.resolved_part(S.FEEDS[d], matched[d]) for d in REGISTERS}
        tagged = S.tag_social(tables["pai"], f.tweets, f.handles, EMOTIONS, KEYWORDS)
        return {**tables, "pai": settle(tagged), "adjudication": matched["adjudication"], "hris": matched["hris"]}

    @cached_property
    def external(self) -> dict[str, DataFrame]:
        f = self.f
        return _settled({
            "silver_geo_anomalies": lambda: f.anomalies.ok,
            "silver_lifestyle_incongruity": lambda: f.sv_lifestyle.ok,
            "silver_financial_stress": lambda: f.sv_financial,
            "silver_darkweb_signals": lambda: f.sv_darkweb.ok,
        })

    @cached_property
    def dead(self) -> DataFrame:
        """The dead letters of all feeds; they lie in written tables already."""
        f = self.f
        parts = [S.dead_part(self.matched[d]) for d in REGISTERS]
        return reduce(DataFrame.unionByName, [*parts, f.anomalies.dead, f.sv_lifestyle.dead, f.sv_darkweb.dead])

    @cached_property
    def weekly(self) -> dict[str, DataFrame]:
        ext = self.external
        pai = self.silver["pai"]
        return _settled({
            "twitter": lambda: weekly.weekly_twitter(pai),
            "location": lambda: weekly.weekly_location(ext["silver_geo_anomalies"]),
            "lifestyle": lambda: weekly.weekly_lifestyle(ext["silver_lifestyle_incongruity"]),
            "financial": lambda: weekly.weekly_financial(ext["silver_financial_stress"]),
            "darkweb": lambda: weekly.weekly_darkweb(ext["silver_darkweb_signals"]),
        })


@lru_cache(maxsize=4)
def _written(spark: SparkSession, application: str, folder: str, files: tuple[str, ...]) -> Written:
    return Written(Feeds(spark, folder))


def _files(spark: SparkSession, folder: str) -> tuple[str, ...]:
    """Path, size and time of every file in a folder: other files mean other tables."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while listed.hasNext():
        file = listed.next()
        found.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
    return tuple(sorted(found))


def written(f: Feeds) -> Written:
    return _written(f.spark, f.spark.sparkContext.applicationId, f.folder, _files(f.spark, f.folder))


def gold(f: Feeds) -> DataFrame:
    return written(f).gold
