"""Data checks: one row per check with the verdict, a number and a sentence."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lynxrisk import config as C
from lynxrisk.config import RESOLVED, RiskConfig
from lynxrisk.functions.expr import different_values
from lynxrisk.sources.schemas import KEYS

INTERNAL = ["pacs", "network", "dlp", "comms", "pai", "geo", "adjudication"]
EXTERNAL = {
    "silver_geo_anomalies": "instagram",
    "silver_lifestyle_incongruity": "lifestyle",
    "silver_financial_stress": "financial_stress",
    "silver_darkweb_signals": "darkweb",
}
WEEKLY = [
    "gold_twitter_risk",
    "gold_location_risk",
    "gold_lifestyle_risk",
    "gold_financial_stress_risk",
    "gold_darkweb_risk",
    "gold_composite_risk",
]


def _row(check: str, passed: Column, value: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        value.cast("double").alias("value"),
        detail.alias("detail"),
    )


def _rows(facts: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """Several checks from one row of aggregates."""
    return facts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def check_gold(gold: DataFrame, expected: Column, cfg: RiskConfig) -> DataFrame:
    """Coverage, null rates, clusters, lineage, model run and score range."""
    n = F.count(F.lit(1))
    different = {out: different_values(gold, c) for out, c in (("employees", "employee_id"), ("clusters", "cluster_id"), ("runs", "model_run_id"))}
    facts = gold.agg(
        n.alias("n"),
        *[(n - F.count(c)).alias(f"null_{c}") for c in C.SCORE_FEATURES],
        F.count_if(F.col("model_run_id").isNull() | F.col("source_silver_files").isNull()).alias("no_lineage"),
        F.max("model_run_id").alias("run"),
        F.min("anomaly_score").alias("low"),
        F.max("anomaly_score").alias("high"),
        F.avg("anomaly_score").alias("mean"),
        F.stddev_samp("anomaly_score").alias("std"),
    ).withColumns({"expected": expected, **different})
    col = F.col
    rates = {c: F.coalesce(col(f"null_{c}") / F.nullif(col("n"), F.lit(0)), F.lit(0.0)) for c in C.SCORE_FEATURES}
    return _rows(
        facts,
        [
            _row(
                "employee_coverage_gold",
                col("employees") == col("expected"),
                col("employees"),
                _text(col("employees"), " of ", col("expected"), " employees in Gold"),
            ),
            *[
                _row(
                    f"null_rate_{c}",
                    rate < cfg.max_null_rate,
                    F.round(rate, 4),
                    _text(c, ": ", col(f"null_{c}"), " of ", col("n"), " null"),
                )
                for c, rate in rates.items()
            ],
            _row(
                "anomaly_distribution",
                col("clusters") >= cfg.min_clusters,
                col("clusters"),
                _text(col("clusters"), f" clusters populated, need {cfg.min_clusters}"),
            ),
            _row(
                "lineage_traceability",
                col("no_lineage") == 0,
                col("no_lineage"),
                _text(col("no_lineage"), " Gold rows without run id or sources"),
            ),
            _row(
                "model_run_id_logged",
                col("runs") == 1,
                col("runs"),
                _text(col("runs"), " model runs in Gold, latest ", F.coalesce("run", F.lit("none"))),
            ),
            _row(
                "score_range",
                (col("high") > col("low")) & (col("std") > cfg.min_score_std),
                F.round("std", 4),
                _text("min ", F.round("low", 4), " max ", F.round("high", 4), " mean ", F.round("mean", 4)),
            ),
        ],
    )


def check_windows(gold: DataFrame, cfg: RiskConfig) -> DataFrame:
    """Every employee has enough windows."""
    short = gold.groupBy("employee_id").agg(F.count(F.lit(1)).alias("n"))
    facts = short.agg(F.count_if(F.col("n") < cfg.min_windows).alias("short"))
    return _rows(
        facts,
        [
            _row(
                "gold_window_coverage",
                F.col("short") == 0,
                F.col("short"),
                _text(F.col("short"), f" employees with fewer than {cfg.min_windows} windows"),
            )
        ],
    )


def resolution_counts(silver: Mapping[str, DataFrame], dead: DataFrame) -> DataFrame:
    """Resolved and all events per feed. Dead letters count, else every rate would be 1."""
    ok = _union(
        [
            t.groupBy().agg(
                F.count_if(F.col("identity_resolution_status") == RESOLVED).alias("resolved"),
                F.count(F.lit(1)).alias("total"),
            ).select(F.lit(domain).alias("source_domain"), "resolved", "total")
            for domain, t in silver.items()
        ]
    )
    lost = dead.groupBy("source_domain").agg(F.lit(0).cast("long").alias("resolved"), F.count(F.lit(1)).alias("total"))
    sums = [F.sum(c).alias(c) for c in ("resolved", "total")]
    return ok.unionByName(lost).groupBy("source_domain").agg(*sums)


def check_resolution(silver: Mapping[str, DataFrame], dead: DataFrame, external: Sequence[str], cfg: RiskConfig) -> DataFrame:
    """Resolution rate per feed, with the lower bar for external ones."""
    outside = F.col("source_domain").isin(*external) if external else F.lit(False)
    rate = F.coalesce(F.col("resolved") / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0))
    floor = F.when(outside, F.lit(cfg.min_external_resolution)).otherwise(F.lit(cfg.min_resolution))
    counts = resolution_counts(silver, dead).filter(F.col("source_domain").isin(*silver))
    return counts.select(
        F.concat(F.when(outside, F.lit("osint_resolution_")).otherwise(F.lit("silver_resolution_")), "source_domain").alias(
            "check"
        ),
        ((rate >= floor) | (outside & (F.col("total") == 0))).alias("passed"),
        F.round(rate, 4).alias("value"),
        _text(F.col("source_domain"), ": ", F.col("resolved"), " of ", F.col("total"), " resolved").alias("detail"),
    )


def check_unresolved(dead: DataFrame) -> DataFrame:
    facts = dead.agg(F.count(F.lit(1)).alias("n"))
    return _rows(facts, [_row("unresolved_events_count", F.lit(True), F.col("n"), _text(F.col("n"), " dead letters"))])


def check_timeline(sv_hris: DataFrame, sv_pacs: DataFrame, cfg: RiskConfig) -> DataFrame:
    """No active employee with too few days of building access; none at all counts as zero."""
    active = sv_hris.filter(F.col("employment_status") == "active").select("employee_id").distinct()
    days = sv_pacs.select("employee_id", "event_date").distinct().groupBy("employee_id").agg(F.count("event_date").alias("days"))
    sparse = active.join(days, "employee_id", "left").agg(
        F.count_if(F.coalesce("days", F.lit(0)) < cfg.min_pacs_days).alias("n")
    )
    return _rows(
        sparse,
        [
            _row(
                "timeline_coverage",
                F.col("n") == 0,
                F.col("n"),
                _text(F.col("n"), f" active employees with fewer than {cfg.min_pacs_days} days of access events"),
            )
        ],
    )


def check_domains(silver: Mapping[str, DataFrame], expected: Column, cfg: RiskConfig) -> DataFrame:
    """Enough of the feeds (with the employee master) reach every employee."""
    reach = _union(
        [t.agg(F.countDistinct("employee_id").alias("n")).select(F.lit(d).alias("d"), "n") for d, t in silver.items()]
    ).withColumn("expected", expected)
    facts = reach.agg(
        F.count_if(F.col("n") == F.col("expected")).alias("full"),
        F.array_join(F.sort_array(F.collect_list(_text(F.col("d"), ":", F.col("n")))), ", ").alias("each"),
    )
    return _rows(
        facts,
        [_row("cross_domain_coverage", F.col("full") >= cfg.min_full_domains, F.col("full"), F.col("each"))],
    )


def check_row_counts(tables: Mapping[str, DataFrame], prefix: str) -> DataFrame:
    counts = _union(
        [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, t in tables.items()]
    )
    return counts.select(
        F.concat(F.lit(prefix), "name").alias("check"),
        (F.col("n") > 0).alias("passed"),
        F.col("n").cast("double").alias("value"),
        _text(F.col("n"), " rows in ", F.col("name")).alias("detail"),
    )


def check_emotion_tags(sv_pai: DataFrame) -> DataFrame:
    """Some day was tagged; an empty array means tagged without a hit."""
    tagged = F.col("emotion_tags").isNotNull()
    facts = sv_pai.agg(F.count_if(tagged).alias("n"), F.count_if(tagged & (F.size("emotion_tags") > 0)).alias("hits"))
    return _rows(
        facts,
        [
            _row(
                "osint_silver_twitter_emotion_tags",
                F.col("n") > 0,
                F.col("n"),
                _text(F.col("n"), " rows tagged, ", F.col("hits"), " with a hit"),
            )
        ],
    )


def check_composite_tiers(composite: DataFrame, cfg: RiskConfig) -> DataFrame:
    facts = (
        composite.groupBy("risk_tier")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count(F.lit(1)).alias("tiers"),
            F.array_join(F.sort_array(F.collect_list(_text(F.col("risk_tier"), ":", F.col("n")))), ", ").alias("each"),
        )
    )
    return _rows(
        facts,
        [
            _row(
                "composite_risk_tier_distribution",
                F.col("tiers") >= cfg.min_composite_tiers,
                F.col("tiers"),
                F.col("each"),
            )
        ],
    )


def check_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = KEYS) -> DataFrame:
    """Declared keys: rows with a NULL in the key, and key values that occur more than once."""
    parts = []
    for name, table in tables.items():
        key = list(keys[name])
        missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
        facts = (
            table.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("_rows"))
            .agg(
                F.coalesce(F.sum(F.when(missing, F.col("_rows"))), F.lit(0)).alias("nulls"),
                F.count_if(~missing & (F.col("_rows") > 1)).alias("twice"),
            )
        )
        bad = F.col("nulls") + F.col("twice")
        parts.append(
            _rows(
                facts,
                [_row(f"key_{name}", bad == 0, bad, _text(F.col("nulls"), " null, ", F.col("twice"), " repeated keys"))],
            )
        )
    return _union(parts)


def quality_report(
    silver: Mapping[str, DataFrame],
    external: Mapping[str, DataFrame],
    dead: DataFrame,
    gold: DataFrame,
    weekly: Mapping[str, DataFrame],
    cfg: RiskConfig = RiskConfig(),
) -> DataFrame:
    """All checks. ``silver`` maps feed names (hris too) to tables, the others table names."""
    expected = silver["hris"].agg(F.countDistinct("employee_id")).scalar()
    internal = {d: silver[d] for d in INTERNAL}
    streams = {EXTERNAL[name]: table for name, table in external.items()}
    return _union(
        [
            check_gold(gold, expected, cfg),
            check_windows(gold, cfg),
            check_resolution({**internal, **streams}, dead, list(streams), cfg),
            check_unresolved(dead),
            check_timeline(silver["hris"], silver["pacs"], cfg),
            check_domains({**internal, "hris": silver["hris"]}, expected, cfg),
            check_row_counts(external, "osint_silver_"),
            check_emotion_tags(silver["pai"]),
            check_row_counts(weekly, "osint_gold_"),
            check_composite_tiers(weekly["gold_composite_risk"], cfg),
        ]
    )
