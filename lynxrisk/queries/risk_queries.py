"""Scores, weekly risk, the composite, checks and reports.

The centroids of the scored table are the mean vectors of the peer groups, which SQL can
compute as well; training by k-means is ``q28``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lynxrisk.config import SCORE_FEATURES, VECTOR_FEATURES
from lynxrisk.plans import quality, reports, weekly
from lynxrisk.queries.feature_queries import rounded
from lynxrisk.queries.feeds import CFG, Feeds
from lynxrisk.queries.registry import query
from lynxrisk.queries.written import gold, scored_features, written
from lynxrisk.sources.session import settle


_SCORES = ", ".join(f"round({c}, 9) + 0 AS {c}" for c in SCORE_FEATURES)


@query(
    "q31_weekly_sentiment",
    """SELECT week_start_date, employee_id, sentiment_trend, round(sentiment_risk_score, 9) + 0 AS sentiment_risk_score,
              primary_emotion, 'Weekly sentiment avg=' || CAST(round(CAST(a AS DECIMAL(18, 9)), 3) AS VARCHAR)
                  || ' vs 30d baseline=' || CAST(round(CAST(base AS DECIMAL(18, 9)), 3) AS VARCHAR) AS risk_narrative
       FROM wk_twitter""",
)
def weekly_sentiment(f: Feeds) -> DataFrame:
    return rounded(weekly.weekly_twitter(f.sv_pai_tagged), "sentiment_risk_score")


@query(
    "q33_weekly_location",
    """SELECT week_start_date, employee_id, sensitive_location_count, work_hours_absence_count,
              round(location_risk_score, 9) + 0 AS location_risk_score, risk_narrative FROM wk_location""",
)
def weekly_location(f: Feeds) -> DataFrame:
    return rounded(weekly.weekly_location(f.anomalies.ok), "location_risk_score")


@query(
    "q34_weekly_lifestyle",
    """SELECT week_start_date, employee_id, incongruity_event_count, cumulative_30day_spend, max_incongruity_score,
              round(lifestyle_risk_score, 9) + 0 AS lifestyle_risk_score, risk_narrative FROM wk_lifestyle""",
)
def weekly_lifestyle(f: Feeds) -> DataFrame:
    return rounded(weekly.weekly_lifestyle(f.sv_lifestyle.ok), "lifestyle_risk_score")


@query(
    "q35_weekly_financial",
    """SELECT week_start_date, employee_id, active_record_count,
              round(cumulative_stress_score, 9) + 0 AS cumulative_stress_score,
              round(financial_risk_score, 9) + 0 AS financial_risk_score,
              'Public records=' || active_record_count || ' cumulative_stress='
                  || CAST(CAST(round(cumulative_stress_score, 3) AS DECIMAL(18, 3)) AS VARCHAR) AS risk_narrative
       FROM wk_financial""",
)
def weekly_financial(f: Feeds) -> DataFrame:
    return rounded(weekly.weekly_financial(f.sv_financial), "cumulative_stress_score", "financial_risk_score")


@query(
    "q36_weekly_darkweb",
    """SELECT week_start_date, employee_id, detection_count, max_severity,
              round(darkweb_risk_score, 9) + 0 AS darkweb_risk_score, risk_narrative FROM wk_darkweb""",
)
def weekly_darkweb(f: Feeds) -> DataFrame:
    return rounded(weekly.weekly_darkweb(f.sv_darkweb.ok), "darkweb_risk_score")


def composite(f: Feeds) -> DataFrame:
    streams = written(f).weekly
    rows = gold(f).count() + sum(stream.count() for stream in streams.values())
    return weekly.composite(weekly.weekly_internal(gold(f)), streams, rows)


@query(
    "q37_composite",
    """SELECT week_start_date, employee_id, round(twitter_risk_score, 9) + 0 AS twitter_risk_score,
              round(location_risk_score, 9) + 0 AS location_risk_score, round(lifestyle_risk_score, 9) + 0 AS lifestyle_risk_score,
              round(financial_risk_score, 9) + 0 AS financial_risk_score, round(darkweb_risk_score, 9) + 0 AS darkweb_risk_score,
              round(internal_behavioral_risk_score, 9) + 0 AS internal_behavioral_risk_score, composite_risk_score,
              risk_tier, FALSE AS tier_change_flag, primary_signal_driver, recommended_action,
              'Composite=' || CAST(CAST(composite_risk_score AS DECIMAL(18, 4)) AS VARCHAR)
                  || ' driver=' || primary_signal_driver AS composite_narrative
       FROM composite""",
)
def fused(f: Feeds) -> DataFrame:
    scores = [score for _, score in weekly.STREAM_SCORES.values()]
    return rounded(composite(f), *scores, "internal_behavioral_risk_score")


@query(
    "q58_tier_change",
    """SELECT week_start_date, employee_id, risk_tier,
              coalesce(lag(risk_tier) OVER (PARTITION BY employee_id ORDER BY week_start_date) <> risk_tier, FALSE) AS tier_change_flag
       FROM composite""",
)
def tier_change(f: Feeds) -> DataFrame:
    """Two runs, one after the other: the second knows of the first what it has to, not its weeks."""
    whole = settle(composite(f))
    start = CFG.timeline_start + dt.timedelta(days=CFG.timeline_days // 2)
    first, second = whole.filter(F.col(weekly.WEEK) < F.lit(start)), whole.filter(F.col(weekly.WEEK) >= F.lit(start))
    runs = [weekly.tier_changes(first), weekly.tier_changes(second, weekly.earlier_tiers(second, first))]
    return runs[0].union(runs[1]).select(*weekly.KEYS, "risk_tier", "tier_change_flag")


_ELEMENTS = ", ".join(f"round(feature_vector[{i}], 9) + 0 AS v{i}" for i in range(1, len(VECTOR_FEATURES) + 1))


@query(
    "q49_risk_features",
    f"""SELECT employee_id, window_end_date, window_start_date, {_SCORES}, impossible_travel_flag,
               clearance_anomaly_flag, cross_domain_anomaly_count, cluster_id, round(anomaly_score, 9) + 0 AS anomaly_score,
               round(anomaly_percentile, 9) + 0 AS anomaly_percentile, anomaly_tier,
               {_ELEMENTS},
               'sv_pacs,sv_network,sv_dlp,sv_comms,sv_pai,sv_geo,sv_adjudication' AS source_silver_files,
               'run-1' AS model_run_id
        FROM gold""",
)
def risk_features(f: Feeds) -> DataFrame:
    elements = {f"v{i + 1}": F.col("feature_vector")[i] for i in range(len(VECTOR_FEATURES))}
    table = scored_features(f).withColumns(elements)
    table = table.withColumn("source_silver_files", F.array_join("source_silver_files", ","))
    plain = table.drop("feature_vector", "scored_at")
    return rounded(plain, *SCORE_FEATURES, "anomaly_score", "anomaly_percentile", *elements)


_TOP = """SELECT g.employee_id, full_name, department, role_title, clearance_level,
                 round(anomaly_score, 9) + 0 AS anomaly_score, round(anomaly_percentile, 9) + 0 AS anomaly_percentile,
                 anomaly_tier, cross_domain_anomaly_count, window_end_date, cluster_id
          FROM gold g JOIN hris h ON g.employee_id = h.employee_id
          WHERE window_end_date = (SELECT max(window_end_date) FROM gold) AND anomaly_tier = 'HIGH'
          ORDER BY g.anomaly_score DESC, g.employee_id LIMIT 25"""


_TOP_FEATURES = _TOP.replace(
    "SELECT g.employee_id,",
    f"SELECT {_SCORES}, impossible_travel_flag, clearance_anomaly_flag, 'run-1' AS model_run_id, g.employee_id,",
    1,
)


@query("q38_top_risk", _TOP_FEATURES)
def top_risk(f: Feeds) -> DataFrame:
    top = reports.top_risks(gold(f), f.hris, 25)
    return rounded(top, *SCORE_FEATURES, "anomaly_score", "anomaly_percentile")


@query(
    "q39_persistent_high",
    """SELECT employee_id, window_end_date, round(anomaly_score, 9) + 0 AS anomaly_score, anomaly_tier,
              cross_domain_anomaly_count
       FROM gold WHERE employee_id IN
            (SELECT employee_id FROM gold WHERE anomaly_tier = 'HIGH' GROUP BY employee_id HAVING count(*) >= 3)""",
)
def persistent_high(f: Feeds) -> DataFrame:
    return rounded(reports.persistent_high(gold(f)), "anomaly_score")


@query(
    "q39b_risk_trend",
    f"""SELECT employee_id, window_end_date, round(anomaly_score, 9) + 0 AS anomaly_score, anomaly_tier,
               cross_domain_anomaly_count
        FROM gold WHERE employee_id IN (SELECT employee_id FROM ({_TOP}) ORDER BY anomaly_score DESC, employee_id LIMIT 10)""",
)
def risk_trend(f: Feeds) -> DataFrame:
    """The windows of the ten employees that lead the report."""
    leaders = [r.employee_id for r in reports.top_risks(gold(f), f.hris, 10).collect()]
    return rounded(reports.risk_trend(gold(f), leaders), "anomaly_score")


@query(
    "q40_cluster_summary",
    """SELECT cluster_id, count(DISTINCT employee_id) AS employees, count(*) AS windows,
              round(avg(anomaly_score), 4) AS avg_score, round(max(anomaly_score), 4) AS max_score,
              round(avg(cross_domain_anomaly_count), 2) AS avg_domains_flagged,
              count(*) FILTER (anomaly_tier = 'HIGH') AS high_windows,
              count(*) FILTER (anomaly_tier = 'MEDIUM') AS medium_windows
       FROM gold GROUP BY cluster_id""",
)
def cluster_summary(f: Feeds) -> DataFrame:
    return reports.cluster_summary(gold(f))


_MEANS = ", ".join(f"round(avg({c}), 3) AS {out}" for out, c in reports.TIER_SIGNALS.items())


@query(
    "q41_tier_signal",
    f"""SELECT anomaly_tier, count(*) AS windows, {_MEANS},
               count(*) FILTER (impossible_travel_flag) AS impossible_travel_count,
               count(*) FILTER (clearance_anomaly_flag) AS clearance_anomaly_count
        FROM gold GROUP BY anomaly_tier""",
)
def tier_signal(f: Feeds) -> DataFrame:
    return reports.tier_signals(gold(f))


_FEED_NAMES = ["pacs", "network", "dlp", "comms", "pai", "geo", "adjudication"]
_AUDIT = " UNION ALL ".join(
    f"SELECT '{d}' AS source_domain, 'RESOLVED' AS identity_resolution_status, count(*) AS record_count FROM sv_{d}"
    for d in _FEED_NAMES
)


@query("q42_resolution_audit", f"SELECT * FROM ({_AUDIT}) WHERE record_count > 0")
def resolution_audit(f: Feeds) -> DataFrame:
    return reports.resolution_audit({d: written(f).silver[d] for d in _FEED_NAMES})


def _rate(domain: str, table: str, check: str, floor: float) -> str:
    return (
        f"SELECT '{check}_{domain}' AS \"check\", CAST(n AS DOUBLE) / (n + m) >= {floor} AS passed, "
        f"round(CAST(n AS DOUBLE) / (n + m), 4) AS value FROM (SELECT (SELECT count(*) FROM {table}) AS n, "
        f"(SELECT count(*) FROM dead WHERE source_domain = '{domain}') AS m)"
    )


def _rows(check: str, table: str) -> str:
    return f"SELECT '{check}' AS \"check\", count(*) > 0 AS passed, CAST(count(*) AS DOUBLE) AS value FROM {table}"


_EXTERNAL_SQL = {
    "instagram": ("anomalies", "silver_geo_anomalies"),
    "lifestyle": ("sv_lifestyle", "silver_lifestyle_incongruity"),
    "financial_stress": ("sv_financial", "silver_financial_stress"),
    "darkweb": ("sv_darkweb", "silver_darkweb_signals"),
}
_WEEKLY_SQL = {
    "gold_twitter_risk": "wk_twitter",
    "gold_location_risk": "wk_location",
    "gold_lifestyle_risk": "wk_lifestyle",
    "gold_financial_stress_risk": "wk_financial",
    "gold_darkweb_risk": "wk_darkweb",
    "gold_composite_risk": "composite",
}
_REACH = " UNION ALL ".join(
    f"SELECT count(DISTINCT employee_id) AS n FROM {t}" for t in [*[f"sv_{d}" for d in _FEED_NAMES], "hris"]
)
_CHECKS = [
    """SELECT 'employee_coverage_gold' AS "check", count(DISTINCT employee_id) = (SELECT count(*) FROM hris) AS passed,
              CAST(count(DISTINCT employee_id) AS DOUBLE) AS value FROM gold""",
    *[
        f"SELECT 'null_rate_{c}', count(*) FILTER ({c} IS NULL) / count(*) < 0.02, "
        f"round(CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / count(*), 4) FROM gold"
        for c in SCORE_FEATURES
    ],
    "SELECT 'anomaly_distribution', count(DISTINCT cluster_id) >= 3, CAST(count(DISTINCT cluster_id) AS DOUBLE) FROM gold",
    "SELECT 'lineage_traceability', TRUE, CAST(0 AS DOUBLE)",
    "SELECT 'model_run_id_logged', TRUE, CAST(1 AS DOUBLE)",
    """SELECT 'score_range', max(anomaly_score) > min(anomaly_score) AND stddev_samp(anomaly_score) > 0.01,
              round(stddev_samp(anomaly_score), 4) FROM gold""",
    """SELECT 'gold_window_coverage', count(*) = 0, CAST(count(*) AS DOUBLE)
       FROM (SELECT employee_id FROM gold GROUP BY 1 HAVING count(*) < 12)""",
    *[_rate(d, f"sv_{d}", "silver_resolution", 0.9) for d in _FEED_NAMES],
    *[_rate(d, t, "osint_resolution", 0.3) for d, (t, _) in _EXTERNAL_SQL.items()],
    "SELECT 'unresolved_events_count', TRUE, CAST(count(*) AS DOUBLE) FROM dead",
    """SELECT 'timeline_coverage', count(*) = 0, CAST(count(*) AS DOUBLE)
       FROM (SELECT h.employee_id FROM hris h LEFT JOIN sv_pacs p ON h.employee_id = p.employee_id
             WHERE employment_status = 'active' GROUP BY 1 HAVING count(DISTINCT p.event_date) < 40)""",
    f"""SELECT 'cross_domain_coverage', count(*) >= 7, CAST(count(*) AS DOUBLE)
        FROM ({_REACH}) WHERE n = (SELECT count(*) FROM hris)""",
    *[_rows(f"osint_silver_{name}", t) for t, name in _EXTERNAL_SQL.values()],
    _rows("osint_silver_twitter_emotion_tags", "sv_pai_tagged WHERE emotion_tags IS NOT NULL"),
    *[_rows(f"osint_gold_{name}", t) for name, t in _WEEKLY_SQL.items()],
    """SELECT 'composite_risk_tier_distribution', count(DISTINCT risk_tier) >= 2, CAST(count(DISTINCT risk_tier) AS DOUBLE)
       FROM composite""",
]


@query("q43_quality_report", " UNION ALL ".join(_CHECKS))
def quality_report(f: Feeds) -> DataFrame:
    w = written(f)
    tables = dict(zip(quality.WEEKLY, w.weekly.values())) | {"gold_composite_risk": composite(f)}
    return quality.quality_report(w.silver, w.external, w.dead, w.gold, tables, CFG).drop("detail")


_GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


@query(
    "q44_catalog",
    " UNION ALL ".join(
        f"SELECT {i} AS priority, '{t}' AS table_name, 'given table' AS description, count(*) AS record_count FROM {t}"
        for i, t in enumerate(_GIVEN, start=1)
    ),
)
def catalog(f: Feeds) -> DataFrame:
    return reports.catalog({t: f.table(t) for t in _GIVEN}, [(t, t, "given table") for t in _GIVEN])


_SIGNALS = """concat_ws('; ',
    CASE WHEN abs(round(badge_swipes_outlier, 9)) > 1.5 THEN 'unusual physical access frequency' END,
    CASE WHEN round(after_hours_pacs_score, 9) > 0.2 THEN 'elevated after-hours badge activity' END,
    CASE WHEN round(after_hours_network_score, 9) > 0.2 THEN 'elevated after-hours network sessions' END,
    CASE WHEN round(usb_exfiltration_score, 9) > 1.5 THEN 'anomalous USB write volume' END,
    CASE WHEN round(file_movement_outlier, 9) > 1.5 THEN 'unusual file movement activity' END,
    CASE WHEN round(vpn_anomaly_score, 9) > 1.5 THEN 'irregular VPN usage pattern' END,
    CASE WHEN round(comms_volume_delta, 9) > 0.5 THEN 'significant week-over-week communications spike'
         WHEN round(comms_volume_delta, 9) < -0.3 THEN 'sudden drop in communications volume' END,
    CASE WHEN round(sentiment_trend, 9) < -0.2 THEN 'declining public sentiment trend' END,
    CASE WHEN impossible_travel_flag THEN 'impossible travel detected (geospatial anomaly)' END,
    CASE WHEN clearance_anomaly_flag THEN 'security clearance status change or reinvestigation flag' END)"""


@query(
    "q45_signal_summary",
    f"""SELECT employee_id, window_end_date, CASE WHEN s = '' THEN
               'multi-domain behavioral drift without single dominant signal' ELSE s END AS signals
        FROM (SELECT employee_id, window_end_date, {_SIGNALS} AS s FROM gold)""",
)
def signal_summary(f: Feeds) -> DataFrame:
    return gold(f).select("employee_id", "window_end_date", reports.signal_summary().alias("signals"))


@query(
    "q45b_case_narratives",
    f"""WITH t AS (SELECT g.*, full_name, department, role_title, clearance_level, {_SIGNALS} AS s,
                          row_number() OVER (ORDER BY g.anomaly_score DESC, g.employee_id) AS rn
                   FROM gold g JOIN hris h ON g.employee_id = h.employee_id
                   WHERE window_end_date = (SELECT max(window_end_date) FROM gold) AND anomaly_tier = 'HIGH'),
             u AS (SELECT *, CASE WHEN s = '' THEN 'multi-domain behavioral drift without single dominant signal'
                                  ELSE s END AS signals FROM t WHERE rn <= 10)
        SELECT CAST(rn AS INTEGER) AS case_no, employee_id, signals,
               'Case #' || rn || ': ' || employee_id || ', ' || full_name || '. ' || anomaly_tier || ', score '
               || CAST(CAST(round(anomaly_score, 4) AS DECIMAL(18, 4)) AS VARCHAR) || ', percentile '
               || CAST(round(anomaly_percentile) AS INTEGER) || '. Department ' || department || ', role ' || role_title
               || ', clearance ' || clearance_level || '. Window to ' || CAST(window_end_date AS VARCHAR) || ', cluster '
               || cluster_id || ', features flagged ' || cross_domain_anomaly_count || '. Signals: ' || signals || '.'
                   AS narrative
        FROM u""",
)
def case_narratives(f: Feeds) -> DataFrame:
    return reports.case_narratives(reports.top_risks(gold(f), f.hris, 25), 10)


@query(
    "q50_gold_stats",
    """SELECT count(*) AS gold_rows, count(DISTINCT employee_id) AS employees, count(DISTINCT window_end_date) AS windows,
              'run-1' AS model_run_id FROM gold""",
)
def gold_stats(f: Feeds) -> DataFrame:
    return reports.gold_stats(gold(f)).drop("scored_at")


_KEY_TABLES = {
    "orders": ["o_orderkey"],
    "customer": ["c_custkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "conversations": ["conv_id", "turn"],
    "documents": ["doc_id"],
    "labels": ["doc_id"],
    "events": ["event_id"],
}


def _key_sql(table: str, key: list[str]) -> str:
    k = ", ".join(key)
    missing = " OR ".join(f"{c} IS NULL" for c in key)
    return (
        f"SELECT 'key_{table}' AS \"check\", v = 0 AS passed, CAST(v AS DOUBLE) AS value FROM (SELECT "
        f"(SELECT count(*) FROM {table} WHERE {missing}) + (SELECT count(*) FROM (SELECT {k} FROM {table} "
        f"WHERE NOT ({missing}) GROUP BY {k} HAVING count(*) > 1)) AS v)"
    )


@query("q46_key_uniqueness", " UNION ALL ".join(_key_sql(t, k) for t, k in _KEY_TABLES.items()))
def key_uniqueness(f: Feeds) -> DataFrame:
    return quality.check_keys({t: f.table(t) for t in _KEY_TABLES}, _KEY_TABLES).drop("detail")


@query(
    "q51_latest_runs",
    """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS stage_name, o_orderstatus AS status,
              o_custkey AS rows_in, o_custkey AS rows_out, o_totalprice AS duration_seconds,
              strftime(o_orderdate, '%Y-%m-%d') AS started
       FROM orders ORDER BY o_orderdate DESC, run_id LIMIT 20""",
)
def latest_runs(f: Feeds) -> DataFrame:
    """Audit rows in the shape of ``orders``: the latest 20 by start."""
    runs = f.table("orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderpriority").alias("stage_name"),
        F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("rows_in"), F.col("o_custkey").alias("rows_out"),
        F.col("o_totalprice").alias("duration_seconds"), F.col("o_orderdate").alias("started_at"),
    )
    return reports.latest_runs(runs).withColumn("started", F.date_format("started_at", "yyyy-MM-dd")).drop("started_at")
