"""The daily run: bronze files to silver, gold, checks and reports, with an audit row per stage."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lynxrisk.config import INVALID, RESOLVED, RiskConfig, RunContext
from lynxrisk.operators.identity import Resolved, resolution_gate
from lynxrisk.plans import features as G
from lynxrisk.plans import quality, reports, weekly
from lynxrisk.plans import silver as S
from lynxrisk.sources.schemas import BRONZE, DEAD_LETTERS, KEYS, PIPELINE_RUNS
from lynxrisk.sources.session import scratch, settle, shared_folder, use_utc
from lynxrisk.sources.tables import Lake, append_rows, invalid_lines, read_bronze, write_dead_letter

REGISTERS = {
    "pacs": "badge_registry",
    "geo": "badge_registry",
    "network": "asset_assignment",
    "dlp": "asset_assignment",
    "comms": "directory",
    "pai": "social_handle_map",
}


class StageFailed(RuntimeError):
    pass


@dataclass
class Run:
    """One run over one folder of bronze files into one lake."""

    spark: SparkSession
    bronze: str
    lake: Lake
    cfg: RiskConfig
    ctx: RunContext

    def source(self, name: str, corrupt: bool = False) -> DataFrame:
        return read_bronze(self.spark, name, self.bronze, corrupt)

    def silver(self, name: str) -> DataFrame:
        return self.lake.read("silver", name)

    def gold(self, name: str) -> DataFrame:
        return self.lake.read("gold", name)

    @property
    def dead_path(self) -> str:
        return self.lake.path("silver", "sv_unresolved_events")

    @property
    def dead(self) -> DataFrame:
        return self.spark.read.schema(DEAD_LETTERS).parquet(self.dead_path)

    # --- stages: each returns (rows in, rows out) --------------------------------

    def check_inputs(self) -> tuple[int, int]:
        """Keep the lines that don't fit their schema, count them, and stop if a register lists a key twice.

        A register entry that is there twice would double every event that it matches.
        """
        lines = [invalid_lines(read_bronze(self.spark, n, self.bronze, corrupt=True), n) for n in BRONZE]
        bad = self.lake.write(reduce(DataFrame.unionByName, lines), "silver", "malformed_lines")
        per_source = bad.groupBy("source_domain").agg(F.count(F.lit(1)).alias("lines"))
        self.lake.write(per_source, "reports", "malformed_lines")
        keyed = [n for n in BRONZE if n in KEYS]
        checks = self.lake.write(quality.check_keys({n: self.source(n) for n in keyed}), "reports", "input_keys")
        registers = [f"key_{n}" for n in {*REGISTERS.values()}]
        wrong = [r.check for r in checks.filter(~F.col("passed") & F.col("check").isin(registers)).collect()]
        if wrong:
            raise StageFailed(f"registers with missing or repeated keys: {', '.join(sorted(wrong))}")
        return bad.count(), checks.count()

    def load_hris(self) -> tuple[int, int]:
        rows = self.lake.write(S.silver_hris(self.source("hris_events"), self.ctx), "silver", "sv_hris").count()
        return rows, rows

    def load_feed(self, domain: str) -> tuple[int, int]:
        """One scan and one write, malformed lines included; the counts of the gate come from the written partitions."""
        feed = S.FEEDS[domain]
        tagged = S.tag_feed(feed, self.source(f"{domain}_events", corrupt=True), self.source(REGISTERS[domain]))
        written = self.lake.write(
            S.conform_all(feed, tagged, self.ctx), "silver", f"matched_{domain}", ["identity_resolution_status"]
        )
        resolved, total = _status_counts(written)
        resolution_gate(resolved, total, domain, self.cfg)
        write_dead_letter(S.dead_part(written), self.dead_path)
        return total, resolved

    def feed(self, domain: str) -> DataFrame:
        if domain == "adjudication":
            return self.silver("sv_adjudication")
        if domain == "pai":
            return self.silver("sv_pai")
        return S.resolved_part(S.FEEDS[domain], self.silver(f"matched_{domain}"))

    def load_adjudication(self) -> tuple[int, int]:
        table = S.silver_adjudication(self.source("adjudication_events"), self.ctx)
        rows = self.lake.write(table, "silver", "sv_adjudication").count()
        return rows, rows

    def load_twitter(self) -> tuple[int, int]:
        pai = S.resolved_part(S.FEEDS["pai"], self.silver("matched_pai"))
        tagged = S.tag_social(pai, self.source("raw_tweets"), self.source("social_handle_map"), scale=self.cfg.scale)
        rows = self.lake.write(tagged, "silver", "sv_pai").count()
        return rows, rows

    def _load_external(self, name: str, table: str, result: Resolved) -> tuple[int, int]:
        resolved = self.lake.write(result.ok, "silver", table).count()
        write_dead_letter(result.dead, self.dead_path)
        lost = self.dead.filter(F.col("source_domain") == name).count()
        resolution_gate(resolved, resolved + lost, f"osint_{name}", self.cfg)
        return resolved + lost, resolved

    def load_instagram(self) -> tuple[int, int]:
        result = S.silver_geo_anomalies(
            self.source("raw_instagram_posts"), self.source("social_handle_map"), self.ctx,
            S.PlaceRules(home=self.cfg.home),
        )
        return self._load_external("instagram", "silver_geo_anomalies", result)

    def load_lifestyle(self) -> tuple[int, int]:
        result = S.silver_lifestyle(
            self.source("raw_lifestyle_signals"), self.source("social_handle_map"), self.silver("sv_hris"),
            self.ctx, self.cfg.spend_rows, self.cfg.scale,
        )
        return self._load_external("lifestyle", "silver_lifestyle_incongruity", result)

    def load_financial(self) -> tuple[int, int]:
        table = S.silver_financial(self.source("raw_financial_stress"), self.ctx, self.cfg.scale)
        rows = self.lake.write(table, "silver", "silver_financial_stress").count()
        return rows, rows

    def load_darkweb(self) -> tuple[int, int]:
        result = S.silver_darkweb(
            self.source("raw_darkweb_signals"), self.source("directory"), self.source("social_handle_map"), self.ctx
        )
        return self._load_external("darkweb", "silver_darkweb_signals", result)

    def score(self) -> tuple[int, int]:
        """Feature table, model and score tables, then the weekly tables and the composite."""
        ctx = RunContext(self.ctx.ingested_at, self.cfg.gold_version, self.ctx.run_id)
        people = S.people(self.silver("sv_hris"), ["role_peer_group"])
        result = G.risk_features({d: self.feed(d) for d in quality.INTERNAL}, people, self.cfg, ctx)
        month = result.table.withColumn("window_month", F.trunc("window_end_date", "MM"))
        gold = self.lake.write(month, "gold", "employee_risk_features", ["window_month"])
        self.lake.write(result.centroids, "gold", "gd_kmeans_output")
        self.lake.write(result.summary, "gold", "gd_kmeans_summary")
        keys = ["employee_id", "window_end_date"]
        self.lake.write(gold.select(*keys, "feature_vector"), "gold", "employee_features")
        self.lake.write(gold.select(*keys, "cluster_id", "anomaly_score"), "gold", "gd_scored")
        streams = {
            "twitter": weekly.weekly_twitter(self.silver("sv_pai"), self.cfg),
            "location": weekly.weekly_location(self.silver("silver_geo_anomalies")),
            "lifestyle": weekly.weekly_lifestyle(self.silver("silver_lifestyle_incongruity")),
            "financial": weekly.weekly_financial(self.silver("silver_financial_stress")),
            "darkweb": weekly.weekly_darkweb(self.silver("silver_darkweb_signals")),
        }
        stamped = lambda df: df.withColumn("scored_at", F.lit(self.ctx.ingested_at))
        names = dict(zip(streams, quality.WEEKLY))
        written = {s: self.lake.write(stamped(t), "gold", names[s]) for s, t in streams.items()}
        rows = gold.count()
        fused = weekly.composite(weekly.weekly_internal(gold, self.cfg), written, rows + sum(t.count() for t in written.values()))
        if self.cfg.tier_changes:
            fused = self._with_tier_changes(fused)
        self.lake.write(stamped(fused), "gold", "gold_composite_risk")
        return rows, rows

    def _with_tier_changes(self, fused: DataFrame) -> DataFrame:
        """Flags that go on from the last run's tables: its composite, and what it had to know of the runs before."""
        fused = settle(fused)
        last = self.lake.before("gold")
        names = ["gold_composite_risk", "gold_earlier_tiers"]
        known = [last.read("gold", t, [*weekly.KEYS, "risk_tier"]) for t in names if last and last.has("gold", t)]
        none = fused.select(*weekly.KEYS, "risk_tier").limit(0)
        earlier = weekly.earlier_tiers(fused, reduce(DataFrame.unionByName, known, none))
        return weekly.tier_changes(fused, self.lake.write(earlier, "gold", "gold_earlier_tiers"))

    def validate(self) -> tuple[int, int]:
        report = quality.quality_report(
            {d: self.feed(d) for d in quality.INTERNAL} | {"hris": self.silver("sv_hris")},
            {t: self.silver(t) for t in quality.EXTERNAL},
            self.dead,
            self.gold("employee_risk_features"),
            {t: self.gold(t) for t in quality.WEEKLY},
            self.cfg,
        )
        keyed = {t: self.gold(t) for t in ["employee_risk_features", *quality.WEEKLY]}
        checks = self.lake.write(report.unionByName(quality.check_keys(keyed)), "reports", "quality")
        rows = checks.count()
        return rows, rows

    def report(self) -> tuple[int, int]:
        gold, hris = self.gold("employee_risk_features"), self.silver("sv_hris")
        top = self.lake.write(reports.top_risks(gold, hris), "reports", "top_risks")
        tables = {
            "case_narratives": reports.case_narratives(top),
            "persistent_high": reports.persistent_high(gold),
            "cluster_summary": reports.cluster_summary(gold),
            "tier_signals": reports.tier_signals(gold),
            "resolution_audit": reports.resolution_audit({d: self.feed(d) for d in quality.INTERNAL}),
            "gold_stats": reports.gold_stats(gold),
            "bronze_catalog": reports.catalog(
                {t: self.source(t) for t, _, _ in reports.BRONZE_CATALOG}, reports.BRONZE_CATALOG, "source_name"
            ),
            "silver_catalog": reports.catalog(self._silver_tables(), reports.SILVER_CATALOG),
            "gold_catalog": reports.catalog(
                {t: self.gold(t) for t, _, _ in reports.GOLD_CATALOG}, reports.GOLD_CATALOG
            ),
        }
        for name, table in tables.items():
            self.lake.write(table, "reports", name)
        return top.count(), len(tables) + 1

    def _silver_tables(self) -> dict[str, DataFrame]:
        feeds = {f"sv_{d}": self.feed(d) for d in quality.INTERNAL}
        named = {t: self.silver(t) for t in ["sv_hris", *quality.EXTERNAL]}
        return {**feeds, **named, "sv_unresolved_events": self.dead}


def _status_counts(written: DataFrame) -> tuple[int, int]:
    counts = dict(written.groupBy("identity_resolution_status").count().collect())
    return counts.get(RESOLVED, 0), sum(n for status, n in counts.items() if status != INVALID)


def stages(run: Run) -> list[tuple[str, Callable[[], tuple[int, int]]]]:
    """In order: lifestyle needs the employee master, the tags need the posts."""
    feeds = [(f"silver_{d}", lambda d=d: run.load_feed(d)) for d in REGISTERS]
    return [
        ("inputs", run.check_inputs),
        ("silver_hris", run.load_hris),
        *feeds,
        ("silver_adjudication", run.load_adjudication),
        ("silver_osint_twitter", run.load_twitter),
        ("silver_osint_instagram", run.load_instagram),
        ("silver_osint_lifestyle", run.load_lifestyle),
        ("silver_osint_financial", run.load_financial),
        ("silver_osint_darkweb", run.load_darkweb),
        ("gold", run.score),
        ("validate", run.validate),
        ("report", run.report),
    ]


def run_pipeline(
    spark: SparkSession,
    bronze: str,
    base: str,
    cfg: RiskConfig = RiskConfig(),
    run_id: str | None = None,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Run all stages and return the audit rows of this run.

    A stage that fails, or that writes no rows, stops the run; its audit row says so. Tables
    of earlier runs are not touched.
    """
    use_utc(spark)
    shared_folder(spark)  # a missing one ends the run here, not hours later
    with scratch(spark):
        return _run_stages(spark, bronze, base, cfg, run_id, now)


def _run_stages(
    spark: SparkSession, bronze: str, base: str, cfg: RiskConfig, run_id: str | None, now: dt.datetime | None
) -> DataFrame:
    started = now or dt.datetime.now(dt.timezone.utc)
    run_id = run_id or started.strftime("run-%Y%m%dT%H%M%S")
    lake = Lake(spark, base, run_id)
    run = Run(spark, bronze, lake, cfg, RunContext(started, cfg.silver_version, run_id))
    for name, stage in stages(run):
        begun, clock = dt.datetime.now(dt.timezone.utc), time.perf_counter()
        rows_in = rows_out = 0
        status, notes, error = "success", None, None
        try:
            rows_in, rows_out = stage()
            if rows_out == 0 and name != "report":
                raise StageFailed(f"{name} wrote no rows")
        except Exception as e:  # recorded below, then raised again
            status, notes, error = "failed", str(e), e
        row = (
            f"{run_id}/{name}", name, begun, dt.datetime.now(dt.timezone.utc), status, rows_in, rows_out,
            time.perf_counter() - clock, [lake.base], notes,
        )
        append_rows(spark.createDataFrame([row], PIPELINE_RUNS), lake.runs_path)
        if error is not None:
            raise error
    return pipeline_runs(spark, base).filter(F.col("run_id").startswith(f"{run_id}/"))


def pipeline_runs(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(Lake(spark, base, "").runs_path)
