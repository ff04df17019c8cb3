"""Every threshold, weight, word list and label of the engine, in one place."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

RESOLVED = "RESOLVED"
UNRESOLVED = "UNRESOLVED"
#: A line that did not fit its feed's schema.
INVALID = "INVALID"

# ---------------------------------------------------------------------------
# Results depend on these words, numbers and labels.
# ---------------------------------------------------------------------------

EMOTION_RULES = {
    "frustration": ["frustr", "angry", "rage"],
    "grievance": ["unfair", "betray", "resentment"],
    "disengagement": ["quit", "leaving", "resign"],
    "distress": ["depress", "hopeless", "stress"],
    "hostility": ["steal", "revenge", "payback"],
}

KEYWORD_RULES = {
    "sensitive_terms": ["secret", "confidential"],
    "financial_stress": ["money", "debt", "bankrupt"],
    "employment_concern": ["fired", "unemployed", "looking for work"],
    "job_seeking": ["recruiter", "new opportunity"],
}

SENSITIVE_PLACES = ["embassy", "pentagon", "military", "fort ", "base"]
TRAVEL_HUBS = ["airport", "international", "terminal"]
LUXURY_PLACES = ["casino", "luxury", "yacht", "resort", "five star"]

SENIOR_TITLES = ["senior", "director", "chief", " vp", "executive", "principal"]
MID_TITLES = ["manager", "lead", "analyst", "engineer"]
BAND_SPEND = {"senior": 5000.0, "mid": 2000.0, "low": 1000.0}

RECORD_STRESS = {
    "bankruptcy_filing": 1.0,
    "lien": 0.7,
    "eviction_notice": 0.6,
    "civil_judgment": 0.5,
}
OTHER_RECORD_STRESS = 0.3

# severity -> (base confidence, spread of the id-derived part in hundredths)
SEVERITY_CONFIDENCE = {"high": (0.75, 20), "medium": (0.45, 30)}
OTHER_CONFIDENCE = (0.15, 25)

# severity -> (rank on the 0..1 scale, part of the weekly score)
SEVERITY_RANK = {"high": (1.0, 0.60), "medium": (0.5, 0.30)}
OTHER_SEVERITY = (0.2, 0.10)

SCORE_FEATURES = [
    "badge_swipes_outlier",
    "after_hours_pacs_score",
    "after_hours_network_score",
    "usb_exfiltration_score",
    "file_movement_outlier",
    "cloud_upload_outlier",
    "vpn_anomaly_score",
    "comms_volume_delta",
    "external_comms_ratio",
    "sentiment_trend",
]
FLAG_FEATURES = ["impossible_travel_flag", "clearance_anomaly_flag"]
VECTOR_FEATURES = [
    "badge_swipes_outlier",
    "after_hours_pacs_score",
    "after_hours_network_score",
    "usb_exfiltration_score",
    "file_movement_outlier",
    "vpn_anomaly_score",
    "comms_volume_delta",
    "sentiment_trend",
    "cross_domain_anomaly_count",
]

# stream -> (weight in the composite, label as primary driver), in tie order
COMPOSITE_STREAMS = {
    "internal_behavioral_risk_score": (0.25, "internal_behavioral"),
    "financial_risk_score": (0.18, "financial_stress"),
    "darkweb_risk_score": (0.15, "dark_web"),
    "lifestyle_risk_score": (0.15, "lifestyle"),
    "twitter_risk_score": (0.15, "twitter_sentiment"),
    "location_risk_score": (0.12, "location"),
}

# lower bound of the composite score -> (tier, action)
COMPOSITE_TIERS = {
    0.75: ("CRITICAL", "ESCALATE"),
    0.50: ("HIGH", "INVESTIGATE"),
    0.25: ("MEDIUM", "MONITOR"),
}
LOWEST_TIER = ("LOW", "ROUTINE")

FEED_TABLES = ["sv_pacs", "sv_network", "sv_dlp", "sv_comms", "sv_pai", "sv_geo", "sv_adjudication"]

SIGNAL_PHRASES = {
    "badge": "unusual physical access frequency",
    "after_hours_badge": "elevated after-hours badge activity",
    "after_hours_network": "elevated after-hours network sessions",
    "usb": "anomalous USB write volume",
    "files": "unusual file movement activity",
    "vpn": "irregular VPN usage pattern",
    "comms_up": "significant week-over-week communications spike",
    "comms_down": "sudden drop in communications volume",
    "sentiment": "declining public sentiment trend",
    "travel": "impossible travel detected (geospatial anomaly)",
    "clearance": "security clearance status change or reinvestigation flag",
}
NO_SIGNAL_PHRASE = "multi-domain behavioral drift without single dominant signal"

# feature values beyond which a phrase is said
SIGNAL_Z = 1.5
SIGNAL_LATE_GAP = 0.2
SIGNAL_COMMS_UP = 0.5
SIGNAL_COMMS_DOWN = -0.3
SIGNAL_SENTIMENT = -0.2

# weekly scores: weight of each count or maximum
LOCATION_WEIGHTS = {"anomaly": 0.15, "incongruity": 0.10}
LIFESTYLE_WEIGHTS = {"event": 0.05, "incongruity": 0.30}
FINANCIAL_WEIGHTS = {"record": 0.10, "stress": 0.15}
DARKWEB_WEIGHTS = {"detection": 0.15}

# texts of the weekly tables; each %s is a value
NARRATIVES = {
    "twitter": "Weekly sentiment avg=%s vs 30d baseline=%s",
    "location": "Anomaly locations=%s incongruent=%s",
    "lifestyle": "Events=%s max_incongruity=%s 30d_spend=$%s",
    "financial": "Public records=%s cumulative_stress=%s",
    "darkweb": "Detections=%s max_severity=%s",
    "composite": "Composite=%s driver=%s",
}

# sentiment trends from falling to rising, and kinds of place in order of precedence
TRENDS = {"sharp": "declining_sharply", "slight": "declining", "up": "improving", "none": "stable"}
PLACE_KINDS = {
    "sensitive": "sensitive_government",
    "hub": "travel_hub",
    "away": "unusual_travel",
    "check_in": "standard_checkin",
    "other": "standard",
}

# hours: working day of a post (both inside), and the first and last hour that is not "after hours"
WORK_HOURS = (9, 17)
DAY_HOURS = (8, 17)


# ---------------------------------------------------------------------------
# Tunable settings, with the reference run's numbers as defaults.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Box:
    """The home area outside of which a post counts as travel."""

    lat_min: float = 38.5
    lat_max: float = 39.1
    lon_min: float = -77.5
    lon_max: float = -76.8


@dataclass(frozen=True)
class Scale:
    """Sizes at which an operator switches to its fully distributed form."""

    # largest number of rows of one key that a single window task may hold
    window_rows: int = 5_000_000
    # rows per piece when a larger key is cut
    chunk_rows: int = 1_000_000
    # row count up to which the built-in exact percentile is used
    percentile_rows: int = 1_000_000
    # rows that one task of a wide sort, window or grouping should hold at most
    task_rows: int = 250_000
    # values a quantile search may leave to be sorted at the end
    quantile_rest: int = 10_000


@dataclass(frozen=True)
class RiskConfig:
    timeline_start: dt.date = dt.date(2026, 1, 1)
    timeline_days: int = 90
    window_days: int = 7
    baseline_days: int = 31
    min_resolution: float = 0.90
    min_external_resolution: float = 0.30
    outlier_z: float = 1.5
    travel_km: float = 500.0
    winsor: tuple[float, float] = (0.01, 0.99)
    clusters: int = 5
    max_iterations: int = 20
    tolerance: float = 1e-3
    tier_cuts: tuple[float, float] = (75.0, 95.0)
    trend_cuts: tuple[float, float] = (0.25, 0.08)
    baseline_weeks: int = 5
    spend_rows: int = 30
    min_pacs_days: int = 40
    min_windows: int = 12
    max_null_rate: float = 0.02
    min_clusters: int = 3
    min_score_std: float = 0.01
    min_full_domains: int = 7
    min_composite_tiers: int = 2
    # False keeps the flag of a changed tier constant, as in the data model
    tier_changes: bool = False
    silver_version: str = "s2_silver_v2"
    gold_version: str = "s3_score_gold_v1"
    home: Box = field(default_factory=Box)
    scale: Scale = field(default_factory=Scale)

    def __post_init__(self) -> None:
        total = sum(weight for weight, _ in COMPOSITE_STREAMS.values())
        if abs(total - 1.0) > 1e-9:
            raise ValueError(f"composite weights sum to {total}, not 1")

    @property
    def first_window_end(self) -> dt.date:
        return self.timeline_start + dt.timedelta(days=self.window_days - 1)

    @property
    def last_window_end(self) -> dt.date:
        return self.timeline_start + dt.timedelta(days=self.timeline_days - 1)


@dataclass(frozen=True)
class RunContext:
    """What one run stamps on every row: a single clock reading and a version."""

    ingested_at: dt.datetime
    pipeline_version: str = "s2_silver_v2"
    run_id: str = ""
