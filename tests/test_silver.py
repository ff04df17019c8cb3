import datetime as dt

import pytest
from pyspark.sql import functions as F

from lynxrisk.functions.expr import id_spread
from lynxrisk.operators.grid import enrich, first_row_per
from lynxrisk.operators.tagging import tag_groups, tag_text
from lynxrisk.config import EMOTION_RULES, KEYWORD_RULES, Scale
from lynxrisk.plans import silver as S
from tests.conftest import CTX, TINY, day, ts

HANDLES = "social_handle string, employee_id string"


def handles(spark):
    return spark.createDataFrame([("@a", "E1"), ("@b", "E2"), ("@ghost", None)], HANDLES)


def test_tags_are_substrings_and_named_once(spark):
    df = spark.createDataFrame([("I am FRUSTRATED, on average",), ("nothing",), (None,)], "t string")
    tags = [r.tags for r in tag_text(df, "t", EMOTION_RULES, "tags").collect()]
    assert tags == [["frustration"], [], []]


@pytest.mark.parametrize("scale", [Scale(), TINY])
def test_words_match_across_texts_of_a_day(spark, scale):
    rows = [("E1", 1, "looking for"), ("E1", 2, "work"), ("E2", 1, "looking"), ("E2", 2, "for"), ("E2", 3, "work"),
            ("E3", 2, "looking for"), ("E3", 1, "work"), ("E4", 1, None), ("E5", 1, "looking for"), ("E5", 2, None), ("E5", 3, "work"),
            ("E6", 1, "looking for"), ("E6", 2, ""), ("E6", 3, "work")]
    df = spark.createDataFrame(rows, "e string, n int, t string")
    tags = {r.e: r.k for r in tag_groups(df, ["e"], ["n"], "t", {"k": KEYWORD_RULES}, scale=scale).collect()}
    hit = ["employment_concern"]
    assert tags == {"E1": hit, "E2": hit, "E3": [], "E4": [], "E5": hit, "E6": []}


def test_group_tags_equal_tags_of_the_joined_text(spark):
    import random

    rng = random.Random(3)
    pieces = ["looking", "for", "work", "new", "opportunity", "x" * 30, "", "looking for", "rage", None, "looking for work"]
    rows = [(0 if rng.random() < 0.4 else rng.randrange(30), n, rng.choice(pieces)) for n in range(600)]
    rules = {"a": ["looking for work"], "b": ["new opportunity", "rage"], "c": ["work new"]}
    df = spark.createDataFrame(rows, "g int, n int, t string")
    texts = {}
    for g, _, t in sorted(rows, key=lambda r: r[1]):
        texts.setdefault(g, []).extend([] if t is None else [t])
    expect = {g: [k for k, words in rules.items() if any(w in " ".join(ts_) for w in words)] for g, ts_ in texts.items()}
    for scale in (Scale(), TINY):
        got = {r.g: r.tags for r in tag_groups(df, ["g"], ["n"], "t", {"tags": rules}, scale=scale).collect()}
        assert got == expect


def test_day_without_tweets_keeps_null(spark):
    pai = spark.createDataFrame([("E1", day(0)), ("E1", day(1)), ("E2", day(0))], "employee_id string, event_date date")
    tweets = spark.createDataFrame(
        [("t1", ts("2026-01-01 09:00:00"), "@a", "so angry"), ("t2", ts("2026-01-01 09:00:00"), "@b", "fine"),
         ("t3", ts("2026-01-01 10:00:00"), "@ghost", "angry")],
        "tweet_id string, scraped_datetime timestamp, handle string, tweet_text string",
    )
    rows = {(r.employee_id, r.event_date): r for r in S.tag_social(pai, tweets, handles(spark)).collect()}
    assert rows["E1", day(0)].emotion_tags == ["frustration"]
    assert rows["E1", day(0)].keyword_flags == []
    assert rows["E1", day(1)].emotion_tags is None
    assert rows["E2", day(0)].emotion_tags == []


def posts(spark, *rows):
    schema = ("post_id string, scraped_datetime timestamp, handle string, location_string string, location_lat double, "
              "location_lon double, post_type string")
    return spark.createDataFrame(list(rows), schema)


def test_places(spark):
    at = ts("2026-01-01 12:00:00")
    result = S.silver_geo_anomalies(
        posts(
            spark,
            ("1", at, "@a", "Air Base, International Airport", None, None, "photo"),
            ("2", at, "@a", "Fort Worth", 38.9, -77.0, "photo"),
            ("3", at, "@a", "Comfort Inn", 38.9, -77.0, "photo"),
            ("4", at, "@a", "plain", 40.0, -77.0, "photo"),
            ("5", at, "@a", "plain", None, None, "check_in"),
            ("6", at, "@a", None, None, None, "photo"),
            ("7", at, "@a", "Terminal Five Star Hotel", 38.9, -77.0, "photo"),
            ("8", at, "@ghost", "plain", None, None, "photo"),
            ("9", at, "@a", "plain", 38.9, None, "photo"),
        ),
        handles(spark),
        CTX,
    )
    got = {r.post_id: (r.classified_location_type, r.anomaly_flag, r.incongruity_flag) for r in result.ok.collect()}
    assert got == {
        "1": ("sensitive_government", True, False),
        "2": ("sensitive_government", True, False),
        "3": ("sensitive_government", True, False),
        "4": ("unusual_travel", True, False),
        "5": ("standard_checkin", False, False),
        "6": ("standard", False, False),
        "7": ("travel_hub", False, True),
        "9": ("standard", False, False),
    }
    assert [r.raw_identifier for r in result.dead.collect()] == ["@ghost"]


def test_work_hours(spark):
    times = ["08:59:00", "09:00:00", "17:59:00", "18:00:00"]
    rows = [(t, ts(f"2026-01-01 {t}"), "@a", "x", None, None, "photo") for t in times]
    ok = S.silver_geo_anomalies(posts(spark, *rows), handles(spark), CTX).ok
    assert {r.post_id: r.work_hours_flag for r in ok.collect()} == dict(zip(times, [False, True, True, False]))


SIGNALS = "signal_id string, scraped_datetime timestamp, handle string, signal_source string, estimated_value_usd int"


def hris(spark, *rows):
    schema = "employee_id string, event_timestamp timestamp, record_hash string, role_title string"
    return spark.createDataFrame(list(rows), schema)


@pytest.mark.parametrize(
    "title,value,band,score",
    [("Senior Analyst", 2500, "senior", 0.5), ("Team Lead", 2500, "mid", 1.25), ("Clerk", 2500, "low", 2.5),
     ("SVP", 1000, "low", 1.0), ("Deputy VP", None, "senior", 0.0)],
)
def test_salary_band(spark, title, value, band, score):
    signals = spark.createDataFrame([("s", ts("2026-01-01 09:00:00"), "@a", "shop", value)], SIGNALS)
    row = S.silver_lifestyle(signals, handles(spark), hris(spark, ("E1", ts("2020-01-01"), "h", title)), CTX).ok.first()
    assert (row.salary_band, row.incongruity_score) == (band, score)


@pytest.mark.parametrize("scale", [Scale(), TINY])
def test_spend_counts_signals_not_days(spark, scale):
    rows = [(f"s{n:02d}", dt.datetime(2020 + n // 12, n % 12 + 1, 1), "@a", "shop", 1) for n in range(31)]
    # two records of one person must not double the signals
    master = hris(spark, ("E1", ts("2020-01-01"), "h", "Clerk"), ("E1", ts("2021-01-01"), "h", "Chief"))
    out = S.silver_lifestyle(spark.createDataFrame(rows, SIGNALS), handles(spark), master, CTX, scale=scale).ok
    got = [r.cumulative_30day_spend for r in out.orderBy("event_date").collect()]
    assert got == [*range(1, 31), 30]
    assert {r.salary_band for r in out.collect()} == {"senior"}


@pytest.mark.parametrize("scale", [Scale(), TINY])
def test_running_stress(spark, scale):
    rows = [("r1", ts("2026-01-01"), "E1", "court", '{"type":"lien","amount":900}'),
            ("r2", ts("2026-01-02"), "E1", "court", '{"type":"eviction_notice","amount":"n/a"}'),
            ("r3", ts("2026-01-02"), "E1", "court", '{"amount":5}')]
    rows += [(f"x{n}", ts("2026-01-03"), f"E{n + 2}", "court", "{}") for n in range(8)]
    schema = "record_id string, scraped_datetime timestamp, employee_id string, source string, raw_json string"
    out = S.silver_financial(spark.createDataFrame(rows, schema), CTX, scale)
    mine = {r.record_id: r for r in out.filter("employee_id = 'E1'").collect()}
    assert [round(mine[k].cumulative_stress_score, 6) for k in ("r1", "r2", "r3")] == [0.7, 1.3, 1.6]
    assert [mine[k].record_type for k in ("r1", "r2", "r3")] == ["lien", "eviction_notice", "court"]
    assert [mine[k].amount_usd for k in ("r1", "r2", "r3")] == [900, 0, 5]


def test_darkweb_severity_and_confidence(spark):
    directory = spark.createDataFrame([("e1@x", "E1")], "email_address string, employee_id string")
    rows = [(f"d{n}", ts("2026-01-01"), "e1@x", "dump", "email", j)
            for n, j in enumerate(['{"severity":"high"}', '{"severity":"medium"}', "{}", '{"severity":"odd"}'])]
    rows += [("dead", ts("2026-01-01"), None, "dump", "email", "{}")]
    schema = "detection_id string, scraped_datetime timestamp, handle string, signal_source string, matched_on string, raw_json string"
    result = S.silver_darkweb(spark.createDataFrame(rows, schema), directory, handles(spark), CTX)
    got = {r.detection_id: r for r in result.ok.collect()}
    assert [got[f"d{n}"].severity for n in range(4)] == ["high", "medium", "low", "odd"]
    for n, (low, high) in enumerate([(0.75, 0.94), (0.45, 0.74), (0.15, 0.39), (0.15, 0.39)]):
        assert low - 1e-9 <= got[f"d{n}"].confidence_score <= high + 1e-9
    assert result.dead.first().raw_identifier == ""


def test_id_spread_is_stable(spark):
    df = spark.range(1).select(id_spread(F.lit("abc"), 20).alias("n"))
    assert df.first().n == 0x90015098 % 20


def test_enrich_sets_matched_rows_even_to_null(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, None)], "k int, v string")
    assert {r.k: r.v for r in enrich(base, new, ["k"], ["v"]).collect()} == {1: None, 2: "b"}


def test_first_row_per(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, o int, v string")
    assert {r.k: r.v for r in first_row_per(df, "k", ["o"], ["v"]).collect()} == {"a": "y", "b": "z"}


def test_hris_and_adjudication(spark):
    hris_rows = spark.createDataFrame(
        [("E1", "N", None, "Clerk", "G", "S", "active", day(0), None)],
        "employee_id string, full_name string, department string, role_title string, role_peer_group string, "
        "clearance_level string, employment_status string, start_date date, end_date date",
    )
    row = S.silver_hris(hris_rows, CTX).first()
    assert row.event_date == day(0) and row.source_domain == "hris" and row.department is None
    adj = spark.createDataFrame(
        [("E1", ts("2026-01-05 23:59:59"), "S", "active", False, None, True)],
        "employee_id string, event_timestamp timestamp, clearance_level string, clearance_status string, "
        "investigation_flag boolean, reinvestigation_due_date date, status_change_flag boolean",
    )
    assert S.silver_adjudication(adj, CTX).first().event_date == day(4)
