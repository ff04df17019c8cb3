"""Gold features: 12 signals and a count per employee and rolling window, then the scores.

Every feed is first grouped to one row per employee and day, where an employee with very many
events costs no more than any other; all windows and peer statistics work on these daily rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lynxrisk import config as C
from lynxrisk.config import RiskConfig, RunContext
from lynxrisk.functions.expr import any_true, count_true, ratio
from lynxrisk.operators.clustering import nearest_centroid, train
from lynxrisk.operators.grid import dense_grid, gather
from lynxrisk.operators.normalise import winsorize_minmax
from lynxrisk.operators.peers import gap_of, with_peer_stats, z_of
from lynxrisk.operators.ranking import percentile_rank_avg, percentile_tier
from lynxrisk.operators.rolling import Frame, calendar, rolling_features
from lynxrisk.operators.travel import impossible_travel
from lynxrisk.sources.session import settle

EMPLOYEE, DAY, END = "employee_id", "event_date", "window_end_date"
KEYS = [EMPLOYEE, END]
PEERS = [END, "role_peer_group"]


def _daily(rows: DataFrame, **measures: Column) -> DataFrame:
    """One row per employee and day, written out: the windows, their end dates and the peer
    statistics all start from it, and none of them may scan the feed again."""
    return settle(rows.groupBy(EMPLOYEE, DAY).agg(*[agg.alias(name) for name, agg in measures.items()]))


def _weekly_sums(daily: DataFrame, names: list[str], ends: Column, present: str) -> DataFrame:
    return rolling_features(daily, EMPLOYEE, DAY, {n: Frame(n) for n in names}, ends, present)


def pacs_windows(pacs: DataFrame, ends: Column) -> DataFrame:
    daily = _daily(pacs, swipes=F.count(F.lit(1)), late=count_true(F.col("after_hours_flag")))
    windows = _weekly_sums(daily, ["swipes", "late"], ends, "swipes")
    return windows.select(*KEYS, "swipes", ratio(F.col("late"), F.col("swipes")).alias("pacs_late"))


def network_windows(network: DataFrame, ends: Column) -> DataFrame:
    # an event without a type does not count as an event, but its flags do
    daily = _daily(
        network,
        events=F.count("event_type"),
        late=count_true(F.col("after_hours_flag")),
        vpn=count_true(F.col("vpn_flag")),
    )
    windows = _weekly_sums(daily, ["events", "late", "vpn"], ends, "events")
    return windows.select(*KEYS, "vpn", ratio(F.col("late"), F.col("events")).alias("network_late"))


def dlp_windows(dlp: DataFrame, ends: Column) -> DataFrame:
    daily = _daily(
        dlp,
        moves=F.count(F.lit(1)),
        usb=count_true(F.col("usb_flag")),
        uploads=count_true(F.col("cloud_upload_flag")),
    )
    return _weekly_sums(daily, ["moves", "usb", "uploads"], ends, "moves")


# feature -> (how it compares with the peers, the value compared)
PEER_FEATURES = {
    "badge_swipes_outlier": (z_of, "swipes"),
    "after_hours_pacs_score": (gap_of, "pacs_late"),
    "after_hours_network_score": (gap_of, "network_late"),
    "vpn_anomaly_score": (z_of, "vpn"),
    "usb_exfiltration_score": (z_of, "usb"),
    "file_movement_outlier": (z_of, "moves"),
    "cloud_upload_outlier": (z_of, "uploads"),
}


def add_peer_features(windows: DataFrame) -> DataFrame:
    """Replace the raw values of the windows by features against the peer group.

    All values share one set of peer statistics. An employee without events in a window has
    NULL values there, which no mean or deviation counts: only those present are peers.
    """
    found = {f: (rule, v) for f, (rule, v) in PEER_FEATURES.items() if v in windows.columns}
    raw = sorted({v for _, v in found.values()})
    compared = with_peer_stats(windows, raw, PEERS)
    kept = [c for c in windows.columns if c not in raw and c != "role_peer_group"]
    return compared.select(*kept, *[rule(v).alias(f) for f, (rule, v) in found.items()])


def agg_pacs(pacs: DataFrame, peers: DataFrame, ends: Column) -> DataFrame:
    return _against_peers(pacs_windows(pacs, ends), peers)


def agg_network(network: DataFrame, peers: DataFrame, ends: Column) -> DataFrame:
    return _against_peers(network_windows(network, ends), peers)


def agg_dlp(dlp: DataFrame, peers: DataFrame, ends: Column) -> DataFrame:
    return _against_peers(dlp_windows(dlp, ends), peers)


def _against_peers(windows: DataFrame, peers: DataFrame) -> DataFrame:
    return add_peer_features(windows.join(peers.select(EMPLOYEE, "role_peer_group"), EMPLOYEE, "left"))


def agg_comms(comms: DataFrame, ends: Column) -> DataFrame:
    """Change against the seven days before (0 if there were none) and the external share."""
    daily = _daily(comms, messages=F.count(F.lit(1)), outside=count_true(F.col("external_recipient_flag")))
    frames = {
        "now": Frame("messages"),
        "outside_now": Frame("outside"),
        "before": Frame("messages", first=-13, last=-7),
    }
    windows = rolling_features(daily, EMPLOYEE, DAY, frames, ends, "messages")
    change = ratio(F.col("now") - F.col("before"), F.col("before"))
    return windows.select(
        *KEYS,
        F.coalesce(change, F.lit(0.0)).alias("comms_volume_delta"),
        F.coalesce(ratio(F.col("outside_now"), F.col("now")), F.lit(0.0)).alias("external_comms_ratio"),
    )


def agg_pai(pai: DataFrame, ends: Column, baseline_days: int = 31) -> DataFrame:
    """Mean mood of the window less the mean of the baseline, which contains the window."""
    daily = _daily(
        pai,
        posts=F.count(F.lit(1)),
        scored=F.count("sentiment_score"),
        mood=F.sum("sentiment_score"),
    )
    frames = {
        "mood_now": Frame("mood"),
        "n_now": Frame("scored"),
        "mood_base": Frame("mood", first=1 - baseline_days),
        "n_base": Frame("scored", first=1 - baseline_days),
    }
    windows = rolling_features(daily, EMPLOYEE, DAY, frames, ends, "posts")
    trend = ratio(F.col("mood_now"), F.col("n_now")) - ratio(F.col("mood_base"), F.col("n_base"))
    return windows.select(*KEYS, F.coalesce(trend, F.lit(0.0)).alias("sentiment_trend"))


def agg_geo(geo: DataFrame, ends: Column, km: float = 500.0) -> DataFrame:
    days = impossible_travel(geo, EMPLOYEE, DAY, "latitude", "longitude", km)
    return rolling_features(
        days, EMPLOYEE, DAY, {"impossible_travel_flag": Frame("impossible", how="max")}, ends, "impossible"
    )


def agg_adjudication(adjudication: DataFrame, ends: Column) -> DataFrame:
    changed = any_true(F.col("investigation_flag")) | any_true(F.col("status_change_flag"))
    daily = _daily(adjudication, changed=changed)
    frames = {"clearance_anomaly_flag": Frame("changed", how="max")}
    return rolling_features(daily, EMPLOYEE, DAY, frames, ends, "changed")


def cross_domain_count(
    scores: list[str] = C.SCORE_FEATURES, flags: list[str] = C.FLAG_FEATURES, z: float = 1.5
) -> Column:
    """How many of the features stand out: scores beyond ``z`` on either side, and flags."""
    beyond = [F.coalesce(F.abs(F.round(F.col(s), 9)) > z, F.lit(False)) for s in scores]
    raised = [F.coalesce(F.col(f), F.lit(False)) for f in flags]
    return sum((hit.cast("int") for hit in beyond + raised), F.lit(0))


def feature_grid(silver: Mapping[str, DataFrame], people: DataFrame, ends: Column, cfg: RiskConfig) -> DataFrame:
    """Every employee with every window, all features filled, and the cross-domain count.

    ``silver`` maps feed names (pacs, network, ...) to tables; ``people`` has one row per
    employee with ``role_peer_group``.
    """
    feeds = [
        lambda: pacs_windows(silver["pacs"], ends),
        lambda: network_windows(silver["network"], ends),
        lambda: dlp_windows(silver["dlp"], ends),
        lambda: agg_comms(silver["comms"], ends),
        lambda: agg_pai(silver["pai"], ends, cfg.baseline_days),
        lambda: agg_geo(silver["geo"], ends, cfg.travel_km),
        lambda: agg_adjudication(silver["adjudication"], ends),
    ]
    # each writes its daily table and its windows; the writes are independent, so they share the cluster
    with ThreadPoolExecutor(len(feeds)) as pool:
        parts = list(pool.map(lambda windows: settle(windows()), feeds))
    present = gather(parts, KEYS, rows=sum(part.count() for part in parts))
    # an employee without any event in any window is no one's peer: only the others are compared, and meet the grid
    seen = reduce(DataFrame.union, [part.select(EMPLOYEE) for part in parts]).distinct().select(F.col(EMPLOYEE).alias("_seen_id"), F.lit(True).alias("_seen"))
    known = people.groupBy(EMPLOYEE).agg(F.max("role_peer_group").alias("role_peer_group"))
    known = settle(known.join(seen, F.col(EMPLOYEE).eqNullSafe(F.col("_seen_id")), "left").select(EMPLOYEE, "role_peer_group", "_seen"))
    groups = known.filter("_seen").select(F.col(EMPLOYEE).alias("_seen_id"), "role_peer_group")
    compared = settle(present.join(groups, F.col(EMPLOYEE).eqNullSafe(F.col("_seen_id"))).drop("_seen_id"))
    grid = dense_grid(known.filter("_seen").select(EMPLOYEE), ends)
    features = gather([add_peer_features(compared)], KEYS, grid, compared.count() + grid.count())
    idle = dense_grid(known.filter("_seen IS NULL").select(EMPLOYEE), ends)
    filled = features.unionByName(idle, allowMissingColumns=True).fillna(0.0, C.SCORE_FEATURES).fillna(False, C.FLAG_FEATURES)
    return filled.select(
        EMPLOYEE,
        END,
        F.date_sub(END, cfg.window_days - 1).alias("window_start_date"),
        *C.SCORE_FEATURES,
        *C.FLAG_FEATURES,
        cross_domain_count(z=cfg.outlier_z).alias("cross_domain_anomaly_count"),
    )


def add_vectors(features: DataFrame, cfg: RiskConfig) -> DataFrame:
    """The normalised features as one vector. Reads the table a few times: pass a written one."""
    units = winsorize_minmax(features, C.VECTOR_FEATURES, cfg.winsor, cfg.scale)
    return features.withColumn("feature_vector", F.array(*[units[c] for c in C.VECTOR_FEATURES]))


def add_tiers(scored: DataFrame, cfg: RiskConfig) -> DataFrame:
    ranked = percentile_rank_avg(scored, "anomaly_score", "anomaly_percentile")
    return ranked.withColumn("anomaly_tier", percentile_tier("anomaly_percentile", cfg.tier_cuts))


def score(grid: DataFrame, vectors: DataFrame, centroids: DataFrame, cfg: RiskConfig, ctx: RunContext) -> DataFrame:
    """Cluster, score, percentile, tier and lineage for the vectors of a feature grid."""
    scored = nearest_centroid(vectors, "feature_vector", centroids)
    # rows with the same behaviour must tie, whatever the order their sums were made in
    scored = scored.withColumn("anomaly_score", F.round("anomaly_score", 9))
    return add_tiers(scored, cfg).select(
        *grid.columns,
        "feature_vector",
        "cluster_id",
        "anomaly_score",
        "anomaly_percentile",
        "anomaly_tier",
        F.array(*[F.lit(t) for t in C.FEED_TABLES]).alias("source_silver_files"),
        F.lit(ctx.run_id).alias("model_run_id"),
        F.lit(ctx.ingested_at).alias("scored_at"),
    )


@dataclass(frozen=True)
class RiskFeatures:
    table: DataFrame
    centroids: DataFrame
    summary: DataFrame


def risk_features(
    silver: Mapping[str, DataFrame], people: DataFrame, cfg: RiskConfig, ctx: RunContext, ends: Column | None = None
) -> RiskFeatures:
    """The whole feature table: features, vector, trained clusters, score, percentile, tier."""
    grid = settle(feature_grid(silver, people, calendar(cfg) if ends is None else ends, cfg))
    vectors = add_vectors(grid, cfg)
    keyed = vectors.withColumn("_key", F.concat_ws("|", "employee_id", "window_end_date"))
    training = train(keyed, "feature_vector", cfg.clusters, cfg.max_iterations, cfg.tolerance, key="_key")
    return RiskFeatures(score(grid, vectors, training.centroids, cfg, ctx), training.centroids, training.summary)
