"""Weekly risk per employee: five streams, and their composite with the internal score."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk import config as C
from lynxrisk.config import RiskConfig
from lynxrisk.functions.expr import clip, count_true, filled, first_match, fixed, week_start
from lynxrisk.operators.grid import gather
from lynxrisk.operators.ordering import spread

WEEK, EMPLOYEE = "week_start_date", "employee_id"
KEYS = [WEEK, EMPLOYEE]


def _by_week(df: DataFrame):
    return df.withColumn(WEEK, week_start(F.col("event_date"))).groupBy(*KEYS)


def top_item(df: DataFrame, keys: list[str], items: str, out: str) -> DataFrame:
    """The most frequent array element per key; the first in the alphabet among equals."""
    counts = df.select(*keys, F.explode(items).alias(out)).groupBy(*keys, out).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("_n"), F.col(out))).alias("_best")
    return counts.groupBy(*keys).agg(best).select(*keys, F.col(f"_best.{out}").alias(out))


def weekly_twitter(sv_pai: DataFrame, cfg: RiskConfig = RiskConfig()) -> DataFrame:
    """Mood of the week against the mean of this and the previous weeks that have posts."""
    weeks = _by_week(sv_pai).agg(F.avg("sentiment_score").alias("_avg"))
    # one row per employee and week: a key is as long as the timeline has weeks
    past = Window.partitionBy(EMPLOYEE).orderBy(WEEK).rowsBetween(1 - cfg.baseline_weeks, 0)
    based = weeks.withColumn("_base", F.avg("_avg").over(past))
    change = F.round(F.col("_avg") - F.col("_base"), 9)
    sharp, slight = cfg.trend_cuts
    tagged = sv_pai.filter(F.col("emotion_tags").isNotNull()).withColumn(WEEK, week_start(F.col("event_date")))
    emotions = top_item(tagged, KEYS, "emotion_tags", "primary_emotion")
    trend = first_match(
        [(change < -sharp, C.TRENDS["sharp"]), (change < -slight, C.TRENDS["slight"]), (change > slight, C.TRENDS["up"])],
        C.TRENDS["none"],
    )
    return based.join(emotions, KEYS, "left").select(
        *KEYS,
        trend.alias("sentiment_trend"),
        clip((F.col("_base") - F.col("_avg") + 1.0) / 2.0, 0.0, 1.0).alias("sentiment_risk_score"),
        "primary_emotion",
        filled(C.NARRATIVES["twitter"], fixed(F.col("_avg"), 3), fixed(F.col("_base"), 3)).alias("risk_narrative"),
    )


def _capped(score: Column) -> Column:
    """At most 1, and in decimals: sums such as 0.1 + 0.2 must tie with 0.3."""
    return F.least(F.lit(1.0), F.round(score, 10))


def weekly_location(anomalies: DataFrame) -> DataFrame:
    weeks = _by_week(anomalies).agg(
        count_true(F.col("anomaly_flag")).alias("sensitive_location_count"),
        count_true(F.col("work_hours_flag")).alias("work_hours_absence_count"),
        count_true(F.col("incongruity_flag")).alias("_incongruent"),
    )
    found, odd, weights = F.col("sensitive_location_count"), F.col("_incongruent"), C.LOCATION_WEIGHTS
    return weeks.select(
        *KEYS,
        "sensitive_location_count",
        "work_hours_absence_count",
        _capped(found * weights["anomaly"] + odd * weights["incongruity"]).alias("location_risk_score"),
        filled(C.NARRATIVES["location"], found, odd).alias("risk_narrative"),
    )


def weekly_lifestyle(signals: DataFrame) -> DataFrame:
    weeks = _by_week(signals).agg(
        F.count(F.lit(1)).alias("incongruity_event_count"),
        F.max("cumulative_30day_spend").alias("cumulative_30day_spend"),
        F.max("incongruity_score").alias("max_incongruity_score"),
    )
    n, top, spend = (
        F.col(c) for c in ("incongruity_event_count", "max_incongruity_score", "cumulative_30day_spend")
    )
    weights = C.LIFESTYLE_WEIGHTS
    return weeks.select(
        "*",
        _capped(n * weights["event"] + top * weights["incongruity"]).alias("lifestyle_risk_score"),
        filled(C.NARRATIVES["lifestyle"], n, fixed(top, 3), spend).alias("risk_narrative"),
    )


def weekly_financial(records: DataFrame) -> DataFrame:
    weeks = _by_week(records).agg(
        F.count(F.lit(1)).alias("active_record_count"),
        F.max("cumulative_stress_score").alias("cumulative_stress_score"),
    )
    n, stress, weights = F.col("active_record_count"), F.col("cumulative_stress_score"), C.FINANCIAL_WEIGHTS
    return weeks.select(
        "*",
        _capped(n * weights["record"] + stress * weights["stress"]).alias("financial_risk_score"),
        filled(C.NARRATIVES["financial"], n, fixed(stress, 3)).alias("risk_narrative"),
    )


def weekly_darkweb(detections: DataFrame) -> DataFrame:
    """The severity in the text is the last in the alphabet, the numeric one the gravest."""
    severity = F.col("severity")
    scale = lambda i: first_match([(severity == s, v[i]) for s, v in C.SEVERITY_RANK.items()], C.OTHER_SEVERITY[i])
    weeks = _by_week(detections).agg(
        F.count(F.lit(1)).alias("detection_count"),
        F.max(scale(0)).alias("max_severity"),
        F.max(scale(1)).alias("_part"),
        F.max(severity).alias("_word"),
    )
    n = F.col("detection_count")
    return weeks.select(
        *KEYS,
        "detection_count",
        "max_severity",
        _capped(n * C.DARKWEB_WEIGHTS["detection"] + F.col("_part")).alias("darkweb_risk_score"),
        filled(C.NARRATIVES["darkweb"], n, F.col("_word")).alias("risk_narrative"),
    )


def weekly_internal(features: DataFrame, cfg: RiskConfig = RiskConfig()) -> DataFrame:
    """Mean percentile by window start, of a written table. Windows start on every weekday, the streams on Mondays."""
    start = F.date_sub("window_end_date", cfg.window_days - 1)
    starts = features.select(start.alias(WEEK), EMPLOYEE, "anomaly_percentile")
    return (
        spread(starts, features.count(), KEYS)
        .groupBy(*KEYS)
        .agg(F.avg(F.col("anomaly_percentile") / 100.0).alias("internal_behavioral_risk_score"))
    )


STREAM_SCORES = {
    "twitter": ("sentiment_risk_score", "twitter_risk_score"),
    "location": ("location_risk_score", "location_risk_score"),
    "lifestyle": ("lifestyle_risk_score", "lifestyle_risk_score"),
    "financial": ("financial_risk_score", "financial_risk_score"),
    "darkweb": ("darkweb_risk_score", "darkweb_risk_score"),
}


def composite(internal: DataFrame, streams: Mapping[str, DataFrame], rows: int = 0) -> DataFrame:
    """The six scores of a week fused into one, with tier, action and main driver.

    Weeks and employees that only some inputs have are kept; a missing score is 0. ``rows``: of all inputs together, if known.
    """
    parts = [
        streams[name].select(*KEYS, F.col(source).alias(score)) for name, (source, score) in STREAM_SCORES.items()
    ]
    scores = gather([internal, *parts], KEYS, rows=rows).fillna(0.0, list(C.COMPOSITE_STREAMS))
    total = sum((F.col(s) * weight for s, (weight, _) in C.COMPOSITE_STREAMS.items()), F.lit(0.0))
    # inner rounding: sums that differ in the last bit only must not fall on different sides
    scored = (
        scores.filter(F.col(WEEK).isNotNull() & F.col(EMPLOYEE).isNotNull())
        .withColumn("composite_risk_score", F.round(F.round(total, 10), 4))
        .withColumn("_top", F.greatest(*C.COMPOSITE_STREAMS))
    )
    value = F.col("composite_risk_score")
    cases = [(value >= floor, labels) for floor, labels in C.COMPOSITE_TIERS.items()]
    pick = lambda i: first_match([(test, labels[i]) for test, labels in cases], C.LOWEST_TIER[i])
    *leading, (_, last_label) = C.COMPOSITE_STREAMS.items()
    driver = first_match([(F.col(s) == F.col("_top"), label) for s, (_, label) in leading], last_label[1])
    return scored.withColumn("primary_signal_driver", driver).select(
        *KEYS,
        *[score for _, score in STREAM_SCORES.values()],
        "internal_behavioral_risk_score",
        "composite_risk_score",
        pick(0).alias("risk_tier"),
        F.lit(False).alias("tier_change_flag"),
        "primary_signal_driver",
        pick(1).alias("recommended_action"),
        filled(C.NARRATIVES["composite"], fixed(value, 4), F.col("primary_signal_driver")).alias("composite_narrative"),
    )


def earlier_tiers(fused: DataFrame, known: DataFrame) -> DataFrame:
    """The latest known (week, employee, tier) of each employee before the employee's first week in ``fused``.

    ``known`` holds composite rows of earlier runs, each employee's latest at least; weeks that ``fused`` has anew don't count. Employees that
    ``fused`` lacks keep their latest row, so the result is what the next run has to know besides ``fused``.
    """
    first = fused.groupBy(EMPLOYEE).agg(F.min(WEEK).alias("_first"))
    tiers = spread(known.select(*KEYS, "risk_tier"), known.count(), [EMPLOYEE])
    before = tiers.join(first, EMPLOYEE, "left").filter(F.col("_first").isNull() | (F.col(WEEK) < F.col("_first")))
    latest = before.groupBy(EMPLOYEE).agg(F.max(F.struct(WEEK, "risk_tier")).alias("_last"))
    return latest.select(f"_last.{WEEK}", EMPLOYEE, "_last.risk_tier")


def tier_changes(fused: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """``tier_change_flag``: whether the tier differs from that of the employee's previous week that is present, however long ago.

    ``fused`` is written. ``earlier`` (from ``earlier_tiers``) has the weeks of former runs that come before. An employee's first week is no change.
    """
    rows = fused.withColumn("_old", F.lit(False))
    if earlier is not None:
        rows = rows.unionByName(earlier.withColumn("_old", F.lit(True)), allowMissingColumns=True)
    # one row per employee and week: a key is as long as the timeline has weeks
    previous = F.lag("risk_tier").over(Window.partitionBy(EMPLOYEE).orderBy(WEEK))
    changed = spread(rows, fused.count(), [EMPLOYEE]).withColumn("tier_change_flag", F.coalesce(previous != F.col("risk_tier"), F.lit(False)))
    return changed.filter("NOT _old").select(*fused.columns)
