"""Silver: each feed resolved to employees and conformed, with its dead letters."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lynxrisk import config as C
from lynxrisk.config import INVALID, RESOLVED, UNRESOLVED, Box, RunContext, Scale
from lynxrisk.functions.expr import (
    contains_any,
    first_match,
    id_spread,
    lookup,
    piped,
    record_hash,
    stamp,
)
from lynxrisk.operators.grid import enrich, first_row_per
from lynxrisk.operators.identity import (
    DEAD_LETTER_COLUMNS,
    Resolved,
    dead_letters,
    dual_register,
    known_people,
    latest_register,
    tag_identity,
)
from lynxrisk.operators.lineage import LINEAGE_COLUMNS, lineage
from lynxrisk.operators.ordering import running_sum, sliding
from lynxrisk.operators.tagging import Rules, tag_groups
from lynxrisk.sources.session import settle
from lynxrisk.sources.tables import CORRUPT

def _ts(name: str = "event_timestamp") -> Column:
    return F.col(name)


def _or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


# ---------------------------------------------------------------------------
# Internal event feeds: one description per feed, one plan for all
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Feed:
    """How one event feed becomes a silver table.

    ``own`` are its columns after the lineage prefix, as ``name`` or ``(source, name)``.
    ``hash_parts``, ``dead_hash`` and ``raw_parts`` list the columns that make up the record
    hash, the dead letter's hash and its raw text. ``"ts"`` means the event time as text and
    a trailing ``?`` an empty text for NULL.
    """

    domain: str
    key: str
    own: Sequence[str | tuple[str, str]]
    hash_parts: Sequence[str]
    dead_hash: Sequence[str] = ()
    raw_parts: Sequence[str] = ()
    register_key: str = ""
    prepare: Callable[[DataFrame], DataFrame] = field(default=lambda register: register)

    @property
    def source_file(self) -> str:
        return f"{self.domain}_events.csv"


def _part(name: str) -> Column:
    if name == "ts":
        return stamp(_ts())
    return _or_empty(name[:-1]) if name.endswith("?") else F.col(name)


def _newest_machine_owner(register: DataFrame) -> DataFrame:
    return latest_register(register, "machine_id", "effective_start")


FEEDS = {
    feed.domain: feed
    for feed in [
        Feed(
            "pacs",
            "badge_id",
            ["door_id", "location_name", "building_code", "direction",
             ("after_hours", "after_hours_flag"), ("weekend", "weekend_flag")],
            hash_parts=["badge_id", "ts", "door_id?"],
            dead_hash=["badge_id", "ts"],
            raw_parts=["badge_id", "ts", "building_code?"],
            register_key="badge_id",
        ),
        Feed(
            "network",
            "machine_id",
            ["machine_id", "ip_address", "event_type", "vpn_flag", "dns_query_domain", "bytes_transferred",
             "session_duration_min", ("after_hours", "after_hours_flag")],
            hash_parts=["machine_id", "ip_address", "ts"],
            dead_hash=["machine_id", "ts"],
            raw_parts=["machine_id", "ip_address", "ts"],
            register_key="machine_id",
            prepare=_newest_machine_owner,
        ),
        Feed(
            "dlp",
            "machine_id",
            ["machine_id", "event_type", "file_name", "file_extension", "file_size_mb", "destination_type",
             "usb_flag", "print_flag", "cloud_upload_flag"],
            hash_parts=["machine_id", "user_account", "ts"],
            dead_hash=["machine_id", "ts"],
            raw_parts=["machine_id", "user_account", "ts"],
            register_key="machine_id",
            prepare=_newest_machine_owner,
        ),
        Feed(
            "comms",
            "email_address",
            ["channel_type", "recipient_count", "external_recipient_flag", "attachment_flag",
             "attachment_size_mb", ("after_hours", "after_hours_flag")],
            hash_parts=["email_address", "ts", "channel_type"],
            dead_hash=["email_address", "ts"],
            raw_parts=["email_address", "channel_type", "ts"],
            register_key="email_address",
        ),
        Feed(
            "pai",
            "social_handle",
            ["platform", "sentiment_score", "post_count", "engagement_count"],
            hash_parts=["social_handle", "ts"],
            dead_hash=["social_handle", "ts"],
            raw_parts=["social_handle", "platform", "ts"],
            register_key="social_handle",
            prepare=known_people,
        ),
        Feed(
            "geo",
            "badge_id",
            ["building_code", "latitude", "longitude", "device_type"],
            hash_parts=["badge_id", "device_id", "ts"],
            dead_hash=["badge_id", "ts"],
            raw_parts=["badge_id", "device_id", "ts"],
            register_key="badge_id",
        ),
        Feed(
            "adjudication",
            "employee_id",
            ["clearance_level", "clearance_status", "investigation_flag", "reinvestigation_due_date",
             "status_change_flag"],
            hash_parts=["employee_id", "ts", "clearance_status"],
        ),
    ]
}


def _own(feed: Feed) -> list[Column]:
    pairs = [c if isinstance(c, tuple) else (c, c) for c in feed.own]
    return [F.col(source).alias(name) for source, name in pairs]


def conform(feed: Feed, events: DataFrame, ctx: RunContext) -> DataFrame:
    """Resolved events (they carry ``employee_id``) in the silver layout."""
    prefix = lineage(
        F.col("employee_id"),
        F.to_date(_ts()),
        feed.domain,
        feed.source_file,
        [_part(p) for p in feed.hash_parts],
        ctx,
        native=_ts(),
    )
    return events.select(*prefix, *_own(feed))


def tag_feed(feed: Feed, events: DataFrame, register: DataFrame) -> DataFrame:
    """The feed with ``employee_id`` and resolution status; dead letters included."""
    return tag_identity(events, feed.prepare(register), {feed.key: feed.register_key})


def conform_all(feed: Feed, tagged: DataFrame, ctx: RunContext) -> DataFrame:
    """Resolved events and dead letters side by side, for one write partitioned by status.

    The feed is then read and written once; ``resolved_part`` and ``dead_part`` each read
    their own partition of the result. If the feed was read with its malformed lines (``read_bronze(corrupt=True)``), these are
    dead letters of the status INVALID: the line as it came and its hash, nothing of what could be read of it.
    """
    line = F.col(CORRUPT) if CORRUPT in tagged.columns else F.lit(None).cast("string")
    bad = line.isNotNull()
    status = F.when(bad, INVALID).otherwise(F.col("identity_resolution_status"))
    resolved = status == RESOLVED
    prefix = lineage(
        F.col("employee_id"), F.to_date(_ts()), feed.domain, feed.source_file,
        [_part(p) for p in feed.hash_parts], ctx, native=_ts(),
    )
    hashes = F.when(resolved, record_hash([_part(p) for p in feed.hash_parts]))
    if feed.dead_hash:
        hashes = hashes.otherwise(record_hash([_part(p) for p in feed.dead_hash]))
    raw = piped([_part(p) for p in feed.raw_parts]) if feed.raw_parts else F.lit(None).cast("string")
    columns = dict(zip(LINEAGE_COLUMNS, prefix)) | {
        "employee_id": F.when(~bad, F.col("employee_id")).alias("employee_id"),
        "record_hash": F.when(bad, record_hash([line])).otherwise(hashes).alias("record_hash"),
        "identity_resolution_status": status.alias("identity_resolution_status"),
    }
    return tagged.select(
        *columns.values(),
        *_own(feed),
        F.when(~resolved & ~bad, F.col(feed.key)).alias("raw_identifier"),
        F.when(~resolved & ~bad, F.lit(feed.key)).alias("identifier_type"),
        F.when(~resolved, F.coalesce(line, raw)).alias("raw_record"),
    )


def resolved_part(feed: Feed, written: DataFrame) -> DataFrame:
    names = [c if isinstance(c, str) else c[1] for c in feed.own]
    return written.filter(F.col("identity_resolution_status") == RESOLVED).select(*LINEAGE_COLUMNS, *names)


def dead_part(written: DataFrame) -> DataFrame:
    return written.filter(F.col("identity_resolution_status").isin(UNRESOLVED, INVALID)).select(*DEAD_LETTER_COLUMNS)


def matched_feed(domain: str, events: DataFrame, register: DataFrame, ctx: RunContext) -> DataFrame:
    """A feed against its register: pacs, network, dlp, comms, pai or geo; resolved events and dead letters side by side."""
    feed = FEEDS[domain]
    return conform_all(feed, tag_feed(feed, events, register), ctx)


def silver_feed(domain: str, events: DataFrame, register: DataFrame, ctx: RunContext) -> Resolved:
    """The two parts of ``matched_feed``: the same plan as the daily job's, without the write between."""
    whole = matched_feed(domain, events, register, ctx)
    return Resolved(resolved_part(FEEDS[domain], whole), dead_part(whole))


def silver_adjudication(events: DataFrame, ctx: RunContext) -> DataFrame:
    return conform(FEEDS["adjudication"], events, ctx)


def silver_hris(hris: DataFrame, ctx: RunContext) -> DataFrame:
    """The employee master; its own id is the employee id, its date the start date."""
    started = F.col("start_date")
    prefix = lineage(
        F.col("employee_id"),
        started,
        "hris",
        "hris_events.csv",
        [F.col("employee_id"), F.col("full_name"), _or_empty("department")],
        ctx,
        native=started.cast("timestamp").alias("event_timestamp"),
    )
    own = ["full_name", "department", "role_title", "role_peer_group", "clearance_level", "employment_status"]
    return hris.select(*prefix, *own, "start_date", "end_date")


def people(sv_hris: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per employee: the latest record, if there are several."""
    return first_row_per(sv_hris, "employee_id", ["event_timestamp", "record_hash"], cols)


# ---------------------------------------------------------------------------
# External feeds: matched once and written, then split into resolved rows and dead letters
# ---------------------------------------------------------------------------

_SCRAPED = "scraped_datetime"


def tag_social(
    sv_pai: DataFrame,
    tweets: DataFrame,
    handles: DataFrame,
    emotions: Rules = C.EMOTION_RULES,
    keywords: Rules = C.KEYWORD_RULES,
    scale: Scale = Scale(),
) -> DataFrame:
    """Emotion tags and keyword flags of an employee's day, from all tweets of that day.

    Days without tweets keep NULL; days with tweets but no hit get an empty array.
    """
    register = known_people(handles)
    mine = tag_identity(tweets, register, {"handle": "social_handle"}).filter(
        F.col("identity_resolution_status") == RESOLVED
    )
    daily = tag_groups(
        mine.withColumn("event_date", F.to_date(_SCRAPED)),
        ["employee_id", "event_date"],
        [_SCRAPED, "tweet_id"],
        "tweet_text",
        {"emotion_tags": emotions, "keyword_flags": keywords},
        scale=scale,
    )
    return enrich(sv_pai, daily, ["employee_id", "event_date"], ["emotion_tags", "keyword_flags"])


@dataclass(frozen=True)
class PlaceRules:
    sensitive: Sequence[str] = tuple(C.SENSITIVE_PLACES)
    hubs: Sequence[str] = tuple(C.TRAVEL_HUBS)
    luxury: Sequence[str] = tuple(C.LUXURY_PLACES)
    home: Box = Box()


def _external_dead(tagged: DataFrame, domain: str, native: str, kind: Column, ctx: RunContext) -> DataFrame:
    handle = _or_empty("handle")
    return dead_letters(
        tagged,
        domain,
        EXTERNAL_FILES[domain],
        handle,
        kind,
        [F.col(native), handle],
        [F.col(native), handle, stamp(_ts(_SCRAPED))],
        ctx,
    )


EXTERNAL_FILES = {
    "instagram": "raw_instagram_posts.csv",
    "lifestyle": "raw_lifestyle_signals.csv",
    "financial_stress": "raw_financial_stress.csv",
    "darkweb": "raw_darkweb_signals.csv",
}


def _external_prefix(domain: str, native: str, hash_parts: Sequence[Column], ctx: RunContext) -> list[Column]:
    return lineage(
        F.col("employee_id"),
        F.to_date(_SCRAPED),
        domain,
        EXTERNAL_FILES[domain],
        hash_parts,
        ctx,
        native=F.col(native),
    )


def _found(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("identity_resolution_status") == RESOLVED).drop("identity_resolution_status")


def silver_geo_anomalies(
    posts: DataFrame, handles: DataFrame, ctx: RunContext, rules: PlaceRules = PlaceRules()
) -> Resolved:
    """Public posts by kind of place, with anomaly, work-hours and incongruity flags."""
    tagged = settle(tag_identity(posts, known_people(handles), {"handle": "social_handle"}))
    place, lat, lon = F.col("location_string"), F.col("location_lat"), F.col("location_lon")
    home = rules.home
    outside = (lat < home.lat_min) | (lat > home.lat_max) | (lon < home.lon_min) | (lon > home.lon_max)
    away = lat.isNotNull() & outside
    sensitive = contains_any(place, rules.sensitive)
    kind = first_match(
        [
            (sensitive, C.PLACE_KINDS["sensitive"]),
            (contains_any(place, rules.hubs), C.PLACE_KINDS["hub"]),
            (away, C.PLACE_KINDS["away"]),
            (F.col("post_type") == "check_in", C.PLACE_KINDS["check_in"]),
        ],
        C.PLACE_KINDS["other"],
    )
    ok = _found(tagged).select(
        *_external_prefix("instagram", "post_id", [F.col("post_id"), F.col("handle")], ctx),
        kind.alias("classified_location_type"),
        F.coalesce(sensitive | away, F.lit(False)).alias("anomaly_flag"),
        F.hour(_SCRAPED).between(*C.WORK_HOURS).alias("work_hours_flag"),
        F.coalesce(contains_any(place, rules.luxury), F.lit(False)).alias("incongruity_flag"),
    )
    return Resolved(ok, _external_dead(tagged, "instagram", "post_id", F.lit("social_handle"), ctx))


def salary_band(title: Column) -> Column:
    return first_match(
        [(contains_any(title, C.SENIOR_TITLES), "senior"), (contains_any(title, C.MID_TITLES), "mid")], "low"
    )


def silver_lifestyle(
    signals: DataFrame,
    handles: DataFrame,
    sv_hris: DataFrame,
    ctx: RunContext,
    rows: int = 30,
    scale: Scale = Scale(),
) -> Resolved:
    """Spending signals against the salary band, and the spend of the last 30 signals.

    The frame counts signals, not days. Signals of one day are ordered by id.
    """
    tagged = settle(tag_identity(signals, known_people(handles), {"handle": "social_handle"}))
    titles = people(sv_hris, ["role_title"])
    band = salary_band(F.col("role_title"))
    value = F.coalesce(F.col("estimated_value_usd"), F.lit(0))
    based = (
        _found(tagged)
        .join(titles, "employee_id", "left")
        .select(
            *_external_prefix("lifestyle", "signal_id", [F.col("signal_id"), F.col("employee_id")], ctx),
            F.col("signal_source").alias("signal_type"),
            value.alias("estimated_value_usd"),
            band.alias("salary_band"),
            F.round(value / lookup(band, C.BAND_SPEND, C.BAND_SPEND["low"]), 4).alias("incongruity_score"),
        )
    )
    spend = {"cumulative_30day_spend": F.sum("estimated_value_usd")}
    ok = sliding(based, spend, ["employee_id"], ["event_date", "signal_id"], rows - 1, scale)
    return Resolved(ok, _external_dead(tagged, "lifestyle", "signal_id", F.lit("social_handle"), ctx))


def _json(key: str) -> Column:
    return F.get_json_object("raw_json", f"$.{key}")


def silver_financial(records: DataFrame, ctx: RunContext, scale: Scale = Scale()) -> DataFrame:
    """Public records with a stress weight and its running sum per employee."""
    kind = F.coalesce(_json("type"), F.col("source"))
    based = records.select(
        *_external_prefix("financial_stress", "record_id", [F.col("record_id"), F.col("employee_id")], ctx),
        kind.alias("record_type"),
        F.coalesce(_json("amount").try_cast("int"), F.lit(0)).alias("amount_usd"),
        lookup(kind, C.RECORD_STRESS, C.OTHER_RECORD_STRESS).alias("stress_score"),
    )
    order = ["event_date", "record_id"]
    return running_sum(based, "stress_score", ["employee_id"], order, "cumulative_stress_score", scale)


def silver_darkweb(signals: DataFrame, directory: DataFrame, handles: DataFrame, ctx: RunContext) -> Resolved:
    """Detections matched by e-mail address or by social handle, whichever they name."""
    register = dual_register(directory, handles).withColumnsRenamed({"matched_on": "kind", "handle": "name"})
    tagged = settle(tag_identity(signals, register, {"matched_on": "kind", "handle": "name"}))
    severity = F.coalesce(_json("severity"), F.lit("low"))
    confidence = lambda base, spread: F.lit(base) + id_spread(F.col("detection_id"), spread) / 100.0
    score = None
    for level, (base, spread) in C.SEVERITY_CONFIDENCE.items():
        score = (F if score is None else score).when(severity == level, confidence(base, spread))
    ok = _found(tagged).select(
        *_external_prefix("darkweb", "detection_id", [F.col("detection_id"), F.col("handle")], ctx),
        F.coalesce(_json("type"), F.col("signal_source")).alias("signal_type"),
        severity.alias("severity"),
        score.otherwise(confidence(*C.OTHER_CONFIDENCE)).alias("confidence_score"),
        "matched_on",
    )
    return Resolved(ok, _external_dead(tagged, "darkweb", "detection_id", F.col("matched_on"), ctx))
