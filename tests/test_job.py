import datetime as dt

import pytest
from pyspark.sql import functions as F

from lynxrisk.config import RiskConfig
from lynxrisk.operators.identity import ResolutionTooLow
from lynxrisk.plans.job import StageFailed, pipeline_runs, run_pipeline
from lynxrisk.plans.reports import latest_runs, risk_trend
from lynxrisk.sources.tables import Lake
from tests.bronze_files import DAYS, PEOPLE, employee, write_bronze

CFG = RiskConfig(timeline_start=dt.date(2026, 1, 1), timeline_days=DAYS, clusters=3, min_pacs_days=10)
NOW = dt.datetime(2026, 2, 1)


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    bronze, base = tmp_path_factory.mktemp("bronze"), tmp_path_factory.mktemp("lake")
    write_bronze(str(bronze))
    runs = run_pipeline(spark, str(bronze), str(base), CFG, run_id="r1", now=NOW)
    return str(bronze), str(base), Lake(spark, str(base), "r1"), runs


def test_all_stages_succeed(done):
    rows = done[3].collect()
    assert len(rows) == 17
    assert {r.status for r in rows} == {"success"}
    assert all(r.rows_out > 0 for r in rows)


def test_gold_is_a_dense_grid(done):
    gold = done[2].read("gold", "employee_risk_features")
    assert gold.count() == PEOPLE * (DAYS - 6)
    assert gold.filter("size(feature_vector) <> 9").count() == 0
    assert gold.select("model_run_id").distinct().collect()[0][0] == "r1"
    assert gold.filter("anomaly_percentile <= 0 or anomaly_percentile > 100").count() == 0


def test_unusual_person_scores_highest(done):
    gold = done[2].read("gold", "employee_risk_features")
    late = gold.filter(F.col("window_end_date") >= dt.date(2026, 1, 15))
    means = {r.employee_id: r.m for r in late.groupBy("employee_id").agg(F.avg("anomaly_score").alias("m")).collect()}
    flags = late.filter(F.col("employee_id") == employee(1)).agg(F.max("impossible_travel_flag")).first()[0]
    others = late.filter((F.col("employee_id") != employee(1)) & F.col("impossible_travel_flag")).count()
    assert flags and others == 0
    counts = {r.employee_id: r.c for r in late.groupBy("employee_id").agg(F.max("cross_domain_anomaly_count").alias("c")).collect()}
    assert max(counts, key=counts.get) == employee(1)
    assert len(means) == PEOPLE


def test_dead_letters_and_matches_add_up(done, spark):
    lake = done[2]
    dead = spark.read.parquet(lake.path("silver", "sv_unresolved_events"))
    found = {(r.source_domain, r["count"]) for r in dead.groupBy("source_domain").count().collect()}
    assert found == {("pacs", 1), ("network", 1), ("pai", 1), ("instagram", 1), ("lifestyle", 1), ("darkweb", 2)}
    ghost = dead.filter("source_domain = 'darkweb' and raw_identifier = ''").first()
    assert ghost.identifier_type == "social_handle" and ghost.raw_record.startswith("DWS_4||")


def test_tags_reach_the_weekly_table(done):
    pai = done[2].read("silver", "sv_pai")
    rows = {(r.employee_id, r.event_date.day): r for r in pai.collect()}
    assert rows[employee(1), 12].emotion_tags == ["frustration", "grievance"]
    assert rows[employee(1), 12].keyword_flags == ["employment_concern"]
    assert rows[employee(2), 12].emotion_tags == []
    assert rows[employee(3), 12].emotion_tags is None
    weekly = done[2].read("gold", "gold_twitter_risk").filter(F.col("primary_emotion").isNotNull())
    assert {r.primary_emotion for r in weekly.collect()} == {"frustration"}


def test_reports_are_written(done, spark):
    lake = done[2]
    checks = {r.check: r for r in lake.read("reports", "quality").collect()}
    assert checks["employee_coverage_gold"].passed and checks["key_gold_composite_risk"].passed
    assert not checks["osint_resolution_darkweb"].value == 1.0
    assert len([c for c in checks if not c.startswith("key_")]) == 42
    catalogs = [lake.read("reports", f"{layer}_catalog").count() for layer in ("bronze", "silver", "gold")]
    assert catalogs == [17, 13, 10]
    assert latest_runs(pipeline_runs(spark, done[1]), 5).count() == 5
    trend = risk_trend(lake.read("gold", "employee_risk_features"), [employee(i) for i in range(1, 13)])
    assert trend.select("employee_id").distinct().count() == 12


def test_inputs_are_checked(done):
    lake = done[2]
    assert lake.read("silver", "malformed_lines").count() == 0
    keys = {r.check: r.passed for r in lake.read("reports", "input_keys").collect()}
    assert keys["key_badge_registry"] and keys["key_raw_tweets"]
    summary = lake.read("gold", "gd_kmeans_summary").first()
    assert summary.rounds >= 1 and 0 <= summary.reassigned <= 1


def test_settled_tables_are_deleted(done, spark):
    import os

    from lynxrisk.sources.session import scratch, settle, shared_folder

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with scratch(spark):
        assert settle(spark.range(3)).count() == 3
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before


def test_a_badge_listed_twice_stops_the_run(spark, tmp_path):
    bronze, lake = tmp_path / "bronze", tmp_path / "lake"
    bronze.mkdir()
    write_bronze(str(bronze))
    with open(bronze / "badge_registry.csv", "a") as register:
        register.write("BADGE_00001,EMP_00002,2021-01-01\n")
    with open(bronze / "geo_events.csv", "a") as feed:
        feed.write("BADGE_00001,DEV1,not a time,B1,north,-77.0,phone\n")
    with pytest.raises(StageFailed, match="key_badge_registry"):
        run_pipeline(spark, str(bronze), str(lake), CFG, run_id="twice", now=NOW)
    rows = Lake(spark, str(lake), "twice").read("silver", "malformed_lines").collect()
    assert [(r.source_domain, r.raw_record[:24]) for r in rows] == [("geo_events", "BADGE_00001,DEV1,not a t")]
    audit = pipeline_runs(spark, str(lake)).first()
    assert audit.status == "failed" and "key_badge_registry" in audit.notes


def test_rerun_gives_the_same_rows(done, spark):
    bronze, base, first, _ = done
    run_pipeline(spark, bronze, base, CFG, run_id="r2", now=NOW)
    second = Lake(spark, base, "r2")
    for layer, table in [("gold", "employee_risk_features"), ("gold", "gold_composite_risk"), ("silver", "sv_pai")]:
        a = first.read(layer, table).drop("model_run_id")
        b = second.read(layer, table).drop("model_run_id")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_gate_stops_the_run_and_is_recorded(done, spark, tmp_path):
    bronze, lake = tmp_path / "bronze", tmp_path / "lake"
    bronze.mkdir()
    write_bronze(str(bronze))
    (bronze / "badge_registry.csv").write_text("badge_id,employee_id,issued_date\nBADGE_00001,EMP_00001,2020-01-01\n")
    with pytest.raises(ResolutionTooLow):
        run_pipeline(spark, str(bronze), str(lake), CFG, run_id="bad")
    last = pipeline_runs(spark, str(lake)).filter("status = 'failed'").collect()
    assert [r.stage_name for r in last] == ["silver_pacs"]


def test_empty_stage_stops_the_run(spark, tmp_path):
    bronze = tmp_path / "bronze"
    bronze.mkdir()
    write_bronze(str(bronze))
    header = (bronze / "hris_events.csv").read_text().splitlines()[0]
    (bronze / "hris_events.csv").write_text(header + "\n")
    with pytest.raises(StageFailed):
        run_pipeline(spark, str(bronze), str(tmp_path / "lake"), CFG, run_id="empty")
