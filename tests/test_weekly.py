import datetime as dt

import pytest
from pyspark.sql import functions as F

from lynxrisk.config import COMPOSITE_STREAMS, RiskConfig, RunContext
from lynxrisk.plans import weekly as W
from lynxrisk.plans.job import Run
from lynxrisk.sources.schemas import PIPELINE_RUNS
from lynxrisk.sources.tables import Lake, append_rows
from tests.conftest import day

MONDAY = dt.date(2026, 1, 5)


def pai(spark, rows):
    schema = "employee_id string, event_date date, sentiment_score double, emotion_tags array<string>"
    return spark.createDataFrame(rows, schema)


def test_declining_week(spark):
    rows = [("E", MONDAY, 0.5, None), ("E", MONDAY + dt.timedelta(8), 0.1, ["b", "a"]), ("E", MONDAY + dt.timedelta(9), 0.1, ["a"]),
            ("F", MONDAY, 0.0, ["z", "b"])]
    got = {(r.employee_id, r.week_start_date): r for r in W.weekly_twitter(pai(spark, rows)).collect()}
    second = got["E", MONDAY + dt.timedelta(7)]
    assert second.sentiment_trend == "declining"
    assert second.sentiment_risk_score == pytest.approx(0.6)
    assert second.primary_emotion == "a"
    assert second.risk_narrative == "Weekly sentiment avg=0.100 vs 30d baseline=0.300"
    first = got["E", MONDAY]
    assert (first.sentiment_trend, first.primary_emotion) == ("stable", None)
    assert got["F", MONDAY].primary_emotion == "b"


def test_baseline_is_five_present_weeks(spark):
    rows = [("E", MONDAY + dt.timedelta(14 * n), float(v), None) for n, v in enumerate([9, 0, 0, 0, 0, 0])]
    last = W.weekly_twitter(pai(spark, rows)).orderBy(F.desc("week_start_date")).first()
    assert last.sentiment_risk_score == pytest.approx(0.5)


@pytest.mark.parametrize("anomalies,odd,score", [(3, 1, 0.55), (7, 0, 1.0), (0, 0, 0.0)])
def test_location(spark, anomalies, odd, score):
    rows = [("E", MONDAY, n < anomalies, n % 2 == 0, n < odd) for n in range(8)]
    schema = "employee_id string, event_date date, anomaly_flag boolean, work_hours_flag boolean, incongruity_flag boolean"
    row = W.weekly_location(spark.createDataFrame(rows, schema)).first()
    assert row.location_risk_score == score
    assert (row.sensitive_location_count, row.work_hours_absence_count) == (anomalies, 4)
    assert row.risk_narrative == f"Anomaly locations={anomalies} incongruent={odd}"


def test_lifestyle_and_financial(spark):
    signals = spark.createDataFrame(
        [("E", MONDAY, 0.5, 100), ("E", MONDAY + dt.timedelta(6), 1.25, 300), ("E", MONDAY + dt.timedelta(7), 9.0, 400)],
        "employee_id string, event_date date, incongruity_score double, cumulative_30day_spend long",
    )
    rows = W.weekly_lifestyle(signals).orderBy("week_start_date").collect()
    assert rows[0].lifestyle_risk_score == pytest.approx(2 * 0.05 + 1.25 * 0.30)
    assert rows[0].risk_narrative == "Events=2 max_incongruity=1.250 30d_spend=$300"
    assert rows[1].lifestyle_risk_score == 1.0
    records = spark.createDataFrame(
        [("E", MONDAY, 0.7), ("E", MONDAY, 1.3)], "employee_id string, event_date date, cumulative_stress_score double"
    )
    assert W.weekly_financial(records).first().financial_risk_score == pytest.approx(2 * 0.10 + 1.3 * 0.15)


def test_darkweb_text_and_number_differ(spark):
    rows = [("E", MONDAY, "high"), ("E", MONDAY, "low")]
    row = W.weekly_darkweb(spark.createDataFrame(rows, "employee_id string, event_date date, severity string")).first()
    assert (row.darkweb_risk_score, row.max_severity) == (0.9, 1.0)
    assert row.risk_narrative == "Detections=2 max_severity=low"


def streams(spark, **scores):
    out = {}
    for name, (source, _) in W.STREAM_SCORES.items():
        rows = [("E", MONDAY, scores[name])] if name in scores else []
        out[name] = spark.createDataFrame(rows, f"employee_id string, week_start_date date, {source} double")
    return out


def internal(spark, *rows):
    return spark.createDataFrame(list(rows), "employee_id string, week_start_date date, internal_behavioral_risk_score double")


def test_composite_of_the_internal_score_alone(spark):
    row = W.composite(internal(spark, ("E", MONDAY, 0.8)), streams(spark)).first()
    assert (row.composite_risk_score, row.risk_tier, row.recommended_action, row.primary_signal_driver) == (
        0.2, "LOW", "ROUTINE", "internal_behavioral"
    )
    assert row.composite_narrative == "Composite=0.2000 driver=internal_behavioral"


def test_composite_of_all_ones(spark):
    ones = dict.fromkeys(W.STREAM_SCORES, 1.0)
    row = W.composite(internal(spark, ("E", MONDAY, 1.0)), streams(spark, **ones)).first()
    assert (row.composite_risk_score, row.risk_tier, row.recommended_action, row.primary_signal_driver) == (
        1.0, "CRITICAL", "ESCALATE", "internal_behavioral"
    )


@pytest.mark.parametrize(
    "scores,driver",
    [({"financial": 0.9, "darkweb": 0.9}, "financial_stress"), ({"darkweb": 0.5, "lifestyle": 0.5}, "dark_web"),
     ({"lifestyle": 0.3, "twitter": 0.3}, "lifestyle"), ({"twitter": 0.3, "location": 0.3}, "twitter_sentiment"),
     ({"location": 0.3}, "location")],
)
def test_driver_order(spark, scores, driver):
    assert W.composite(internal(spark), streams(spark, **scores)).first().primary_signal_driver == driver


def test_weeks_that_do_not_meet_are_kept(spark):
    rows = [("E", MONDAY, 0.4), ("E", MONDAY + dt.timedelta(1), 0.8)]
    got = {r.week_start_date: r for r in W.composite(internal(spark, *rows), streams(spark, location=1.0)).collect()}
    assert len(got) == 2
    assert got[MONDAY].location_risk_score == 1.0 and got[MONDAY].internal_behavioral_risk_score == 0.4
    assert got[MONDAY + dt.timedelta(1)].location_risk_score == 0.0


def test_internal_weeks_start_on_any_day(spark):
    gold = spark.createDataFrame([("E", day(7), 40.0), ("E", day(8), 60.0)], "employee_id string, window_end_date date, anomaly_percentile double")
    got = {r.week_start_date: r.internal_behavioral_risk_score for r in W.weekly_internal(gold).collect()}
    assert got == {day(1): 0.4, day(2): 0.6}


def test_weights_must_sum_to_one(monkeypatch):
    monkeypatch.setitem(COMPOSITE_STREAMS, "location_risk_score", (0.5, "location"))
    with pytest.raises(ValueError):
        RiskConfig()


TIERS = {"A": "LLHHL", "B": "L..H.", "C": "..M.M", "D": "HL...", "E": "....L"}


def tiers(spark, weeks):
    rows = [(MONDAY + dt.timedelta(7 * w), e, t[w], False) for e, t in TIERS.items() for w in weeks if t[w] != "."]
    return spark.createDataFrame(rows, "week_start_date date, employee_id string, risk_tier string, tier_change_flag boolean")


def changed(df):
    return {(r.employee_id, (r.week_start_date - MONDAY).days // 7) for r in df.collect() if r.tier_change_flag}


WANT = {("A", 2), ("A", 4), ("B", 3), ("D", 1)}


def test_tier_changes_pass_over_missing_weeks(spark):
    got = W.tier_changes(tiers(spark, range(5)))
    assert got.count() == 12 and changed(got) == WANT


@pytest.mark.parametrize("runs", [[[0, 1], [2], [3, 4]], [[0], [1], [2], [3], [4]], [[0, 1, 2], [1, 2, 3], [3, 4]]])
def test_tier_changes_go_on_over_runs(spark, runs):
    """Weeks that a later run has anew included; what lies further back than the last run is carried along."""
    got, known = set(), None
    for weeks in runs:
        fused = tiers(spark, weeks)
        earlier = W.earlier_tiers(fused, known) if known is not None else None
        done = changed(W.tier_changes(fused, earlier))
        assert done == {x for x in WANT if x[1] in weeks}
        got |= done
        known = fused.select(*W.KEYS, "risk_tier")
        known = known.unionByName(earlier) if earlier is not None else known
    assert got == WANT


def test_the_job_reads_the_run_before(spark, tmp_path):
    cfg, base = RiskConfig(tier_changes=True), str(tmp_path)
    got = set()
    for n, weeks in enumerate([[0, 1], [2, 3], [4]]):
        now = dt.datetime(2026, 3, 1 + n)
        lake = Lake(spark, base, f"r{n}")
        append_rows(spark.createDataFrame([(f"r{n}/inputs", "inputs", now, now, "success", 1, 1, 0.0, [], None)], PIPELINE_RUNS), lake.runs_path)
        run = Run(spark, "", lake, cfg, RunContext(now, "v", f"r{n}"))
        fused = run._with_tier_changes(tiers(spark, weeks))
        got |= changed(lake.write(fused, "gold", "gold_composite_risk"))
        append_rows(spark.createDataFrame([(f"r{n}/gold", "gold", now, now, "success", 1, 1, 0.0, [], None)], PIPELINE_RUNS), lake.runs_path)
    assert got == WANT
