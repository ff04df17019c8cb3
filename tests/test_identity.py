import datetime as dt

import pytest
from pyspark.sql import functions as F

from lynxrisk.config import RiskConfig
from lynxrisk.operators.identity import (
    ResolutionTooLow,
    dual_register,
    known_people,
    latest_register,
    resolution_gate,
    resolution_report,
    tag_identity,
)
from lynxrisk.plans import silver as S
from tests.conftest import CTX, ts

PACS = ("badge_id string, event_timestamp timestamp, building_code string, door_id string, location_name string, "
        "direction string, after_hours boolean, weekend boolean")


def pacs(spark, badges):
    rows = [(b, ts("2026-01-02 09:30:00"), None, None, "HQ", "in", False, False) for b in badges]
    return spark.createDataFrame(rows, PACS)


def badges(spark):
    return spark.createDataFrame([("B1", "E1")], "badge_id string, employee_id string")


def test_unknown_badge_is_a_dead_letter(spark):
    result = S.silver_feed("pacs", pacs(spark, ["B1", "B9", None]), badges(spark), CTX)
    ok = result.ok.collect()
    assert [(r.employee_id, r.event_date, r.identity_resolution_status) for r in ok] == [
        ("E1", dt.date(2026, 1, 2), "RESOLVED")
    ]
    dead = {r.raw_identifier: r for r in result.dead.collect()}
    assert set(dead) == {"B9", None}
    assert dead["B9"].raw_record == "B9|2026-01-02 09:30:00|"
    assert dead["B9"].identifier_type == "badge_id"


def test_hashes_of_resolved_rows_and_dead_letters_differ(spark):
    events = pacs(spark, ["B1", "B9"])
    result = S.silver_feed("pacs", events, badges(spark), CTX)
    expect = events.select(
        F.md5(F.lit("B1|2026-01-02 09:30:00|")).alias("ok"), F.md5(F.lit("B9|2026-01-02 09:30:00")).alias("dead")
    ).first()
    assert result.ok.first().record_hash == expect.ok
    assert result.dead.first().record_hash == expect.dead


def test_one_write_holds_both_parts(spark):
    feed = S.FEEDS["pacs"]
    events = pacs(spark, ["B1", "B9"])
    tagged = S.tag_feed(feed, events, badges(spark))
    both = S.conform_all(feed, tagged, CTX)
    split = S.silver_feed("pacs", events, badges(spark), CTX)
    assert S.resolved_part(feed, both).exceptAll(split.ok).count() == 0
    assert S.dead_part(both).exceptAll(split.dead).count() == 0
    assert (S.resolved_part(feed, both).count(), S.dead_part(both).count()) == (1, 1)


def test_latest_assignment_wins_whatever_the_event_date(spark):
    register = spark.createDataFrame(
        [("M1", "A", dt.date(2025, 1, 1)), ("M1", "B", dt.date(2025, 6, 1)), ("M2", "C", None), ("M2", "D", dt.date(2025, 1, 1)),
         ("M3", "E", None)],
        "machine_id string, employee_id string, effective_start date",
    )
    latest = {r.machine_id: r.employee_id for r in latest_register(register, "machine_id", "effective_start").collect()}
    assert latest == {"M1": "B", "M2": "D", "M3": "E"}


def test_handle_without_employee_does_not_resolve(spark):
    register = spark.createDataFrame([("@a", None), ("@b", "E1")], "social_handle string, employee_id string")
    events = spark.createDataFrame([("@a",), ("@b",)], "handle string")
    tagged = tag_identity(events, known_people(register), {"handle": "social_handle"})
    assert {r.handle: r.identity_resolution_status for r in tagged.collect()} == {"@a": "UNRESOLVED", "@b": "RESOLVED"}


def test_dual_path(spark):
    directory = spark.createDataFrame([("e1@x", "E1")], "email_address string, employee_id string")
    handles = spark.createDataFrame([("@h", "E2"), ("e1@x", "E3")], "social_handle string, employee_id string")
    events = spark.createDataFrame(
        [(1, "email", "e1@x"), (2, "email", "e9@x"), (3, "social_handle", "@h"), (4, "social_handle", "@z"), (5, "other", "@h")],
        "id int, matched_on string, handle string",
    )
    register = dual_register(directory, handles).withColumnsRenamed({"matched_on": "k", "handle": "h"})
    tagged = tag_identity(events, register, {"matched_on": "k", "handle": "h"})
    assert {r.id: r.employee_id for r in tagged.collect()} == {1: "E1", 2: None, 3: "E2", 4: None, 5: None}


def test_gate():
    resolution_gate(9, 10, "pacs")
    resolution_gate(0, 0, "pacs")
    resolution_gate(3, 10, "osint_darkweb")
    with pytest.raises(ResolutionTooLow):
        resolution_gate(8, 10, "pacs")
    with pytest.raises(ResolutionTooLow):
        resolution_gate(2, 10, "osint_darkweb")
    resolution_gate(8, 10, "pacs", RiskConfig(min_resolution=0.8))


def test_resolution_report(spark):
    rows = [("pacs", "RESOLVED")] * 8 + [("pacs", "UNRESOLVED")] * 2 + [("osint_x", "RESOLVED"), ("osint_x", "UNRESOLVED")]
    report = resolution_report(spark.createDataFrame(rows, "source_domain string, identity_resolution_status string"))
    assert {r.source_domain: (r.resolved, r.total, r.passed) for r in report.collect()} == {
        "pacs": (8, 10, False),
        "osint_x": (1, 2, True),
    }


def test_a_register_that_holds_a_third_of_the_events_on_one_key(spark):
    events = spark.createDataFrame([("B1" if n % 3 == 0 else f"B{n}",) for n in range(300)], "badge_id string")
    register = spark.createDataFrame([("B1", "E1"), ("B4", "E4")], "badge_id string, employee_id string")
    tagged = tag_identity(events, register, {"badge_id": "badge_id"})
    assert tagged.count() == 300
    assert tagged.filter("employee_id = 'E1'").count() == 101
