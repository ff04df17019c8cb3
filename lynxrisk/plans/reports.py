"""Report tables: top risks, trends, summaries, texts, catalogs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk import config as C
from lynxrisk.functions.expr import count_true, different_values, fixed


def _latest(gold: DataFrame) -> DataFrame:
    """Rows of the last window (a scalar subquery, so partitions can be pruned)."""
    return gold.filter(F.col("window_end_date") == gold.agg(F.max("window_end_date")).scalar())


def top_risks(gold: DataFrame, sv_hris: DataFrame, n: int = 25) -> DataFrame:
    """The highest HIGH scores of the last window with the employee's attributes."""
    people = sv_hris.select("employee_id", "full_name", "department", "role_title", "clearance_level")
    high = _latest(gold).filter(F.col("anomaly_tier") == "HIGH")
    rows = high.join(people, "employee_id")
    columns = [
        "employee_id",
        "full_name",
        "department",
        "role_title",
        "clearance_level",
        "anomaly_score",
        "anomaly_percentile",
        "anomaly_tier",
        "cross_domain_anomaly_count",
        "window_end_date",
    ]
    extra = [c for c in ("cluster_id", *C.SCORE_FEATURES, *C.FLAG_FEATURES, "model_run_id") if c in gold.columns]
    return rows.select(*columns, *extra).orderBy(F.desc("anomaly_score"), "employee_id").limit(n)


_TREND = ["employee_id", "window_end_date", "anomaly_score", "anomaly_tier", "cross_domain_anomaly_count"]


def persistent_high(gold: DataFrame, windows: int = 3) -> DataFrame:
    """All windows of the employees that were HIGH in at least that many of them."""
    often = (
        gold.filter(F.col("anomaly_tier") == "HIGH")
        .groupBy("employee_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= windows)
    )
    # a hash of the few employees: no task has to sort the windows of all others
    return gold.select(*_TREND).join(often.hint("shuffle_hash"), "employee_id", "left_semi").orderBy("employee_id", "window_end_date")


def risk_trend(gold: DataFrame, employees: Sequence[str]) -> DataFrame:
    """All windows of the named employees."""
    chosen = F.col("employee_id").isin(*employees)
    return gold.filter(chosen).select(*_TREND).orderBy("employee_id", "window_end_date")


def cluster_summary(gold: DataFrame, with_tiers: bool = True) -> DataFrame:
    tiers = [
        count_true(F.col("anomaly_tier") == tier).alias(f"{tier.lower()}_windows") for tier in ("HIGH", "MEDIUM")
    ]
    return (
        gold.groupBy("cluster_id")
        .agg(
            F.countDistinct("employee_id").alias("employees"),
            F.count(F.lit(1)).alias("windows"),
            F.round(F.avg("anomaly_score"), 4).alias("avg_score"),
            F.round(F.max("anomaly_score"), 4).alias("max_score"),
            F.round(F.avg("cross_domain_anomaly_count"), 2).alias("avg_domains_flagged"),
            *(tiers if with_tiers else []),
        )
        .orderBy(F.desc("avg_score"), "cluster_id")
    )


TIER_SIGNALS = {
    "avg_badge_outlier": "badge_swipes_outlier",
    "avg_ah_pacs": "after_hours_pacs_score",
    "avg_ah_network": "after_hours_network_score",
    "avg_usb_score": "usb_exfiltration_score",
    "avg_file_movement": "file_movement_outlier",
    "avg_vpn_score": "vpn_anomaly_score",
    "avg_comms_delta": "comms_volume_delta",
    "avg_sentiment_trend": "sentiment_trend",
}


def tier_signals(gold: DataFrame) -> DataFrame:
    """Mean signal per tier: which features drive a high score."""
    return (
        gold.groupBy("anomaly_tier")
        .agg(
            F.count(F.lit(1)).alias("windows"),
            *[F.round(F.avg(c), 3).alias(out) for out, c in TIER_SIGNALS.items()],
            count_true(F.col("impossible_travel_flag")).alias("impossible_travel_count"),
            count_true(F.col("clearance_anomaly_flag")).alias("clearance_anomaly_count"),
        )
        .orderBy("anomaly_tier")
    )


def resolution_audit(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Records per feed and resolution status."""
    rows = reduce(
        lambda a, b: a.unionByName(b),
        [t.select(F.lit(d).alias("source_domain"), "identity_resolution_status") for d, t in silver.items()],
    )
    keys = ["source_domain", "identity_resolution_status"]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("record_count")).orderBy(*keys)


def latest_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    columns = ["run_id", "stage_name", "status", "rows_in", "rows_out", "duration_seconds", "started_at"]
    return runs.select(*columns).orderBy(F.desc("started_at"), "run_id", "stage_name").limit(n)


def gold_stats(gold: DataFrame) -> DataFrame:
    different = {out: different_values(gold, c) for out, c in (("employees", "employee_id"), ("windows", "window_end_date"))}
    facts = gold.agg(F.count(F.lit(1)).alias("gold_rows"), F.max("model_run_id").alias("model_run_id"), F.max("scored_at").alias("scored_at"))
    return facts.withColumns(different).select("gold_rows", *different, "model_run_id", "scored_at")


def signal_summary() -> Column:
    """The conspicuous signals of a row as one sentence."""
    say = C.SIGNAL_PHRASES
    # a value at a threshold must not pass it by the noise of a sum
    value = lambda name: F.round(F.col(name), 9)
    rules = [
        (F.abs(value("badge_swipes_outlier")) > C.SIGNAL_Z, say["badge"]),
        (value("after_hours_pacs_score") > C.SIGNAL_LATE_GAP, say["after_hours_badge"]),
        (value("after_hours_network_score") > C.SIGNAL_LATE_GAP, say["after_hours_network"]),
        (value("usb_exfiltration_score") > C.SIGNAL_Z, say["usb"]),
        (value("file_movement_outlier") > C.SIGNAL_Z, say["files"]),
        (value("vpn_anomaly_score") > C.SIGNAL_Z, say["vpn"]),
        (value("comms_volume_delta") > C.SIGNAL_COMMS_UP, say["comms_up"]),
        (value("comms_volume_delta") < C.SIGNAL_COMMS_DOWN, say["comms_down"]),
        (value("sentiment_trend") < C.SIGNAL_SENTIMENT, say["sentiment"]),
        (F.col("impossible_travel_flag"), say["travel"]),
        (F.col("clearance_anomaly_flag"), say["clearance"]),
    ]
    phrases = F.array_compact(F.array(*[F.when(test, F.lit(text)) for test, text in rules]))
    return F.when(F.size(phrases) > 0, F.array_join(phrases, "; ")).otherwise(F.lit(C.NO_SIGNAL_PHRASE))


def case_narratives(top: DataFrame, n: int = 10) -> DataFrame:
    """A short case text for the first rows of ``top_risks``.

    The rank orders the few rows of the report, which its own limit bounds.
    """
    order = Window.orderBy(F.desc("anomaly_score"), "employee_id")
    ranked = top.withColumn("case_no", F.row_number().over(order)).filter(F.col("case_no") <= n)
    unknown = lambda name: F.coalesce(F.col(name), F.lit("Unknown"))
    text = F.concat(
        F.format_string("Case #%d: %s, %s. ", "case_no", "employee_id", F.coalesce("full_name", F.lit("REDACTED"))),
        F.concat(F.col("anomaly_tier"), F.lit(", score "), fixed(F.col("anomaly_score"), 4)),
        F.concat(F.lit(", percentile "), F.round("anomaly_percentile", 0).cast("int").cast("string"), F.lit(". ")),
        F.concat(F.lit("Department "), unknown("department"), F.lit(", role "), unknown("role_title")),
        F.concat(F.lit(", clearance "), unknown("clearance_level"), F.lit(". ")),
        F.concat(F.lit("Window to "), F.col("window_end_date").cast("string")),
        F.concat(F.lit(", cluster "), F.col("cluster_id").cast("string")),
        F.concat(F.lit(", features flagged "), F.col("cross_domain_anomaly_count").cast("string"), F.lit(". ")),
        F.concat(F.lit("Signals: "), signal_summary(), F.lit(".")),
    )
    return ranked.select("case_no", "employee_id", signal_summary().alias("signals"), text.alias("narrative"))


# Order and display name of the tables in each layer's catalog, with a short note.

BRONZE_CATALOG = [
    ("hris_events", "HR Master", "who the person is: role, clearance, status"),
    ("dlp_events", "Data Activity", "file copies, USB writes and uploads"),
    ("network_events", "System Activity", "sessions, VPN use and domains visited"),
    ("comms_events", "Communications", "mail and messages, with outside recipients"),
    ("pacs_events", "Building Access", "badge swipes at doors"),
    ("adjudication_events", "Security Clearance", "investigations and status changes"),
    ("raw_darkweb_signals", "Dark Web Alerts", "credentials seen in breach data"),
    ("raw_financial_stress", "Financial Stress", "liens, judgments and filings"),
    ("raw_lifestyle_signals", "Lifestyle Incongruity", "spending out of line with pay"),
    ("pai_events", "Social Sentiment", "mood of public posts"),
    ("raw_tweets", "Twitter / X Activity", "the posts themselves"),
    ("geo_events", "Campus Location Data", "device positions on campus"),
    ("raw_instagram_posts", "Public Location Activity", "public check-ins"),
    ("badge_registry", "Door & Badge Register", "badge to employee"),
    ("asset_assignment", "Workstation Register", "machine to employee, with dates"),
    ("directory", "Corporate Directory", "e-mail address to employee"),
    ("social_handle_map", "Social Media Identity Register", "public handle to employee"),
]
SILVER_CATALOG = [
    ("sv_hris", "Employee Records", "the employee master"),
    ("sv_dlp", "Data Activity Events", "file movements per employee"),
    ("sv_network", "System Activity Events", "sessions per employee"),
    ("sv_comms", "Communications Events", "messages per employee"),
    ("sv_pacs", "Building Access Events", "swipes per employee"),
    ("sv_adjudication", "Security Clearance Events", "clearance history per employee"),
    ("silver_darkweb_signals", "Dark Web Detections", "detections with severity and confidence"),
    ("silver_financial_stress", "Financial Stress Records", "public records with stress weights"),
    ("silver_lifestyle_incongruity", "Lifestyle Risk Signals", "spending against the salary band"),
    ("sv_pai", "Social Sentiment", "mood, emotion tags and keyword flags"),
    ("sv_geo", "Campus Location Events", "device positions per employee"),
    ("silver_geo_anomalies", "Location Anomalies", "posts by kind of place"),
    ("sv_unresolved_events", "Unlinked Event Log", "events without an employee"),
]
GOLD_CATALOG = [
    ("gold_composite_risk", "Composite Risk Score", "six streams fused per week"),
    ("employee_risk_features", "Behavioral Risk Profile", "features and scores per window"),
    ("gold_financial_stress_risk", "Financial Stress Risk", "weekly score from public records"),
    ("gold_darkweb_risk", "Dark Web Risk", "weekly score from detections"),
    ("gold_lifestyle_risk", "Lifestyle Risk", "weekly score from spending"),
    ("gold_twitter_risk", "Social Sentiment Risk", "weekly score from mood"),
    ("gold_location_risk", "Location Risk", "weekly score from places"),
    ("gd_kmeans_output", "Peer Group Model", "the centroids"),
    ("gd_scored", "Individual Score Results", "cluster and distance per window"),
    ("employee_features", "Scoring Input Vectors", "normalised vectors per window"),
]


def catalog(tables: Mapping[str, DataFrame], entries: Sequence[tuple[str, str, str]], name: str = "table_name") -> DataFrame:
    """Priority, display name, note and row count of each table of a layer."""
    rows = [
        tables[table]
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select(
            F.lit(priority).alias("priority"),
            F.lit(title).alias(name),
            F.lit(note).alias("description"),
            "record_count",
        )
        for priority, (table, title, note) in enumerate(entries, start=1)
        if table in tables
    ]
    return reduce(lambda a, b: a.unionByName(b), rows)
