import datetime as dt

from pyspark.sql import functions as F

from lynxrisk import config as C
from lynxrisk.config import RiskConfig
from lynxrisk.plans import quality as Q
from lynxrisk.plans import reports as R
from lynxrisk.sources.tables import invalid_lines, read_bronze, write_dead_letter
from tests.conftest import day

STATUS = "employee_id string, identity_resolution_status string"


def gold(spark, rows):
    """Rows of (employee, day, score, tier, cluster) with quiet features."""
    df = spark.createDataFrame(
        rows, "employee_id string, window_end_date date, anomaly_score double, anomaly_tier string, cluster_id int"
    )
    quiet = {c: F.lit(0.0) for c in C.SCORE_FEATURES} | {c: F.lit(False) for c in C.FLAG_FEATURES}
    return df.withColumns(
        quiet
        | {
            "cross_domain_anomaly_count": F.lit(2),
            "anomaly_percentile": F.lit(99.0),
            "model_run_id": F.lit("m1"),
            "scored_at": F.lit(dt.datetime(2026, 1, 1)),
            "source_silver_files": F.array(F.lit("sv_pacs")),
        }
    )


def small_gold(spark):
    return gold(
        spark,
        [("A", day(n), 0.5 + n / 10, "HIGH" if n < 3 else "LOW", n % 3) for n in range(12)]
        + [("B", day(n), 0.1, "HIGH" if n in (0, 11) else "LOW", 1) for n in range(12)]
        + [("C", day(11), 0.3, "HIGH", 2)],
    )


def checks(df):
    return {r.check: r for r in df.collect()}


def test_gold_checks(spark):
    got = checks(Q.check_gold(small_gold(spark), F.lit(3), RiskConfig()))
    assert all(r.passed for r in got.values())
    assert got["employee_coverage_gold"].value == 3
    assert got["anomaly_distribution"].value == 3
    broken = small_gold(spark).withColumns(
        {"vpn_anomaly_score": F.lit(None).cast("double"), "model_run_id": F.col("employee_id"), "anomaly_score": F.lit(1.0)}
    )
    got = checks(Q.check_gold(broken, F.lit(500), RiskConfig()))
    failed = {name for name, r in got.items() if not r.passed}
    assert failed == {"employee_coverage_gold", "null_rate_vpn_anomaly_score", "model_run_id_logged", "score_range"}


def test_empty_gold_fails_without_an_error(spark):
    got = checks(Q.check_gold(gold(spark, []), F.lit(0), RiskConfig()))
    assert not got["score_range"].passed and got["null_rate_vpn_anomaly_score"].value == 0


def test_window_coverage(spark):
    got = checks(Q.check_windows(small_gold(spark), RiskConfig()))
    assert (got["gold_window_coverage"].passed, got["gold_window_coverage"].value) == (False, 1.0)


def test_resolution_counts_dead_letters(spark):
    ok = spark.createDataFrame([("A", "RESOLVED")] * 8, STATUS)
    dead = spark.createDataFrame([("pacs",)] * 2 + [("darkweb",)] * 3, "source_domain string")
    got = checks(Q.check_resolution({"pacs": ok, "darkweb": ok.limit(1), "instagram": ok.limit(0)}, dead, ["darkweb", "instagram"], RiskConfig()))
    assert (got["silver_resolution_pacs"].passed, got["silver_resolution_pacs"].value) == (False, 0.8)
    assert (got["osint_resolution_darkweb"].passed, got["osint_resolution_darkweb"].value) == (False, 0.25)
    assert got["osint_resolution_instagram"].passed


def test_timeline(spark):
    hris = spark.createDataFrame([("A", "active"), ("B", "active"), ("C", "inactive")], "employee_id string, employment_status string")
    pacs = spark.createDataFrame([("A", day(n)) for n in range(40)], "employee_id string, event_date date")
    got = checks(Q.check_timeline(hris, pacs, RiskConfig()))
    assert got["timeline_coverage"].value == 1.0


def test_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), ("b", 2)], "k string, n int")
    got = checks(Q.check_keys({"t": df}, {"t": ["k", "n"]}))
    assert (got["key_t"].passed, got["key_t"].value) == (False, 2.0)


def test_emotion_tag_check(spark):
    df = spark.createDataFrame([(None,), ([],), (["a"],)], "emotion_tags array<string>")
    row = Q.check_emotion_tags(df).first()
    assert (row.passed, row.value, row.detail) == (True, 2.0, "2 rows tagged, 1 with a hit")


def test_reports(spark):
    g = small_gold(spark)
    hris = spark.createDataFrame(
        [(e, f"N{e}", "OPS", None, "S") for e in "ABC"],
        "employee_id string, full_name string, department string, role_title string, clearance_level string",
    )
    top = R.top_risks(g, hris, 25)
    assert [r.employee_id for r in top.collect()] == ["C", "B"]
    assert [r.employee_id for r in R.top_risks(g, hris, 1).collect()] == ["C"]
    assert {r.employee_id for r in R.persistent_high(g).collect()} == {"A"}
    assert R.persistent_high(g).count() == 12
    texts = [r.narrative for r in R.case_narratives(top).collect()]
    assert texts[0] == (
        "Case #1: C, NC. HIGH, score 0.3000, percentile 99. Department OPS, role Unknown, clearance S. "
        "Window to 2026-01-12, cluster 2, features flagged 2. Signals: " + C.NO_SIGNAL_PHRASE + "."
    )
    summary = {r.cluster_id: r for r in R.cluster_summary(g).collect()}
    assert summary[1].employees == 2 and sum(r.windows for r in summary.values()) == 25
    assert [r.anomaly_tier for r in R.tier_signals(g).collect()] == ["HIGH", "LOW"]
    stats = R.gold_stats(g).first()
    assert (stats.gold_rows, stats.employees, stats.windows, stats.model_run_id) == (25, 3, 12, "m1")


def test_signal_texts(spark):
    loud = gold(spark, [("A", day(0), 1.0, "HIGH", 0)]).withColumns(
        {
            "badge_swipes_outlier": F.lit(-1.6), "after_hours_pacs_score": F.lit(0.2), "vpn_anomaly_score": F.lit(-9.0),
            "comms_volume_delta": F.lit(-0.31), "sentiment_trend": F.lit(-0.21), "impossible_travel_flag": F.lit(True),
        }
    )
    text = loud.select(R.signal_summary().alias("s")).first().s
    say = C.SIGNAL_PHRASES
    assert text == "; ".join([say["badge"], say["comms_down"], say["sentiment"], say["travel"]])


def test_bad_lines_and_dead_letter_partitions(spark, tmp_path):
    (tmp_path / "pacs_events.csv").write_text(
        "badge_id,event_timestamp,building_code,door_id,location_name,direction,after_hours,weekend\n"
        "B1,2026-01-01T10:00:00Z,B,D,L,in,false,false\nB2,not a time,B,D,L,in,maybe,false\n"
    )
    rows = read_bronze(spark, "pacs_events", str(tmp_path), corrupt=True).cache()
    assert rows.count() == 2
    assert [r.raw_record[:2] for r in invalid_lines(rows, "pacs").collect()] == ["B2"]
    path = str(tmp_path / "dead")
    letters = lambda domain, n: spark.createDataFrame([(domain, i) for i in range(n)], "source_domain string, i int")
    write_dead_letter(letters("pacs", 3), path)
    write_dead_letter(letters("geo", 2), path)
    write_dead_letter(letters("pacs", 1), path)
    assert dict(spark.read.parquet(path).groupBy("source_domain").count().collect()) == {"pacs": 1, "geo": 2}
