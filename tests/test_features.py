import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lynxrisk.config import SCORE_FEATURES, RiskConfig
from lynxrisk.operators import clustering
from lynxrisk.operators.normalise import winsorize_minmax
from lynxrisk.operators.peers import peer_gap, safe_zscore
from lynxrisk.operators.rolling import Frame, calendar, rolling_features, window_calendar
from lynxrisk.plans import features as G
from tests.conftest import TINY, day

CFG = RiskConfig(timeline_days=20)
ENDS = calendar


def rows_by_key(df, *value):
    return {(r.employee_id, r.window_end_date): tuple(r[v] for v in value) for r in df.collect()}


def test_calendar(spark):
    ends = [r[0] for r in window_calendar(spark, dt.date(2026, 1, 1), 90).collect()]
    assert (len(ends), ends[0], ends[-1]) == (84, dt.date(2026, 1, 7), dt.date(2026, 3, 31))


def test_zscore_rules(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", 3.0), ("one", 9.0), ("same", 4.0), ("same", 4.0), (None, 1.0), (None, 2.0)],
        "g string, x double",
    )
    z = {(r.g, r.x): r.z for r in safe_zscore(df, "x", ["g"], "z").collect()}
    assert [z["a", v] for v in (1.0, 2.0, 3.0)] == [-1, 0, 1]
    assert z["one", 9.0] == 0 and z["same", 4.0] == 0
    assert z[None, 1.0] is None
    gap = {(r.g, r.x): r.gap for r in peer_gap(df, "x", ["g"], "gap").collect()}
    assert gap["a", 3.0] == 1 and gap[None, 1.0] == 0


def test_rolling_equals_a_loop(spark):
    rng = random.Random(2)
    rows = [(f"E{rng.randrange(6)}", rng.randrange(20), rng.randrange(1, 9)) for _ in range(60)]
    daily = spark.createDataFrame(
        [(e, day(d), sum(v for e2, d2, v in rows if (e2, d2) == (e, d))) for e, d in {(e, d) for e, d, _ in rows}],
        "employee_id string, event_date date, n long",
    )
    frames = {"now": Frame("n"), "before": Frame("n", -13, -7), "base": Frame("n", -30), "top": Frame("n", how="max")}
    got = rows_by_key(
        rolling_features(daily, "employee_id", "event_date", frames, calendar(CFG), "n"), "now", "before", "base", "top"
    )
    sums = {}
    for e, d, v in rows:
        sums[e, d] = sums.get((e, d), 0) + v
    expect = {}
    for e in {e for e, _ in sums}:
        for end in range(6, 20):
            within = lambda a, b: [v for (e2, d), v in sums.items() if e2 == e and a <= d <= b]
            now, before, base = within(end - 6, end), within(end - 13, end - 7), within(end - 30, end)
            if now:
                expect[e, day(end)] = (sum(now), sum(before) if before else None, sum(base), max(now))
    assert got == expect


def comms(spark, counts):
    rows = [(e, day(d), n == 0) for e, per_day in counts.items() for d, m in per_day.items() for n in range(m)]
    return spark.createDataFrame(rows, "employee_id string, event_date date, external_recipient_flag boolean")


def test_volume_delta_and_external_ratio(spark):
    out = G.agg_comms(comms(spark, {"A": {2: 10, 9: 15}, "B": {9: 4}}), calendar(CFG))
    got = rows_by_key(out, "comms_volume_delta", "external_comms_ratio")
    assert got["A", day(9)][0] == pytest.approx(0.5)
    assert got["A", day(9)][1] == pytest.approx(1 / 15)
    assert got["B", day(9)] == (0.0, 0.25)
    assert ("B", day(8)) not in got


def test_sentiment_trend_baseline_contains_the_window(spark):
    rows = [("A", day(0), 1.0), ("A", day(10), 0.0), ("A", day(10), -1.0)]
    pai = spark.createDataFrame(rows, "employee_id string, event_date date, sentiment_score double")
    got = rows_by_key(G.agg_pai(pai, calendar(CFG)), "sentiment_trend")
    assert got["A", day(10)][0] == pytest.approx(-0.5 - 0.0)
    assert got["A", day(6)][0] == pytest.approx(0.0)


def test_absent_peers_do_not_count(spark):
    pacs = spark.createDataFrame(
        [("A", day(8), False)] * 1 + [("B", day(8), False)] * 2 + [("C", day(8), True)] * 3,
        "employee_id string, event_date date, after_hours_flag boolean",
    )
    peers = spark.createDataFrame([(e, "G") for e in "ABCD"], "employee_id string, role_peer_group string")
    got = rows_by_key(G.agg_pacs(pacs, peers, calendar(CFG)), "badge_swipes_outlier", "after_hours_pacs_score")
    assert [got[e, day(8)][0] for e in "ABC"] == [-1, 0, 1]
    assert got["C", day(8)][1] == pytest.approx(2 / 3)
    assert ("D", day(8)) not in got


def test_clearance_flag(spark):
    rows = [("A", day(3), True, False), ("B", day(3), False, False), ("C", day(12), False, True)]
    adj = spark.createDataFrame(
        rows, "employee_id string, event_date date, investigation_flag boolean, status_change_flag boolean"
    )
    got = rows_by_key(G.agg_adjudication(adj, calendar(CFG)), "clearance_anomaly_flag")
    assert got["A", day(9)] == (True,) and ("A", day(10)) not in got
    assert got["B", day(9)] == (False,) and got["C", day(12)] == (True,)


def test_cross_domain_count(spark):
    values = dict.fromkeys(SCORE_FEATURES, 0.0) | {
        "badge_swipes_outlier": 1.6, "sentiment_trend": -1.6, "vpn_anomaly_score": 1.5,
        "impossible_travel_flag": True, "clearance_anomaly_flag": False,
    }
    df = spark.createDataFrame([tuple(values.values())], list(values))
    assert df.select(G.cross_domain_count().alias("n")).first().n == 3


def test_winsorize_minmax(spark):
    df = spark.createDataFrame([(float(n), 7.0) for n in range(101)], "x double, flat double")
    for scale in (RiskConfig().scale, TINY):
        units = winsorize_minmax(df, ["x", "flat"], scale=scale)
        got = [r.u for r in df.select("x", units["x"].alias("u")).orderBy("x").collect()]
        assert got[:3] == pytest.approx([0, 0, 1 / 98]) and got[-2:] == pytest.approx([1, 1])
        assert df.select(units["flat"].alias("u")).distinct().collect()[0].u == 0.0


def test_kmeans_separates_planted_groups(spark):
    rng = np.random.default_rng(1)
    points = [(int(g), [float(x) for x in rng.normal(g * 10, 0.1, 3)]) for g in range(3) for _ in range(30)]
    df = spark.createDataFrame(points, "g int, v array<double>")
    centers = clustering.train(df, "v", k=3).centroids
    assert [r.cluster_id for r in centers.orderBy("centroid").collect()] == [0, 1, 2]
    scored = clustering.nearest_centroid(df, "v", centers)
    assert scored.filter("cluster_id <> g").count() == 0
    model = {r.cluster_id: np.array(r.centroid) for r in centers.collect()}
    for r in scored.collect():
        assert r.anomaly_score == pytest.approx(min(np.linalg.norm(np.array(r.v) - c) for c in model.values()))


def test_equal_distance_takes_the_lower_id(spark):
    centers = spark.createDataFrame([(1, [2.0]), (0, [0.0])], clustering.CENTROID_SCHEMA)
    point = spark.createDataFrame([([1.0],)], "v array<float>")
    row = clustering.nearest_centroid(point, "v", centers).first()
    assert (row.cluster_id, row.anomaly_score) == (0, 1.0)
    one = clustering.nearest_centroid(point, "v", centers.filter("cluster_id = 1")).first()
    assert (one.cluster_id, one.anomaly_score) == (1, 1.0)


def test_vectors_that_cannot_be_placed(spark):
    centers = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 1.0])], clustering.CENTROID_SCHEMA)
    rows = spark.createDataFrame([(1, None), (2, [None, 1.0]), (3, [1.0, 1.0])], "id int, v array<double>")
    got = {r.id: (r.cluster_id, r.anomaly_score) for r in clustering.nearest_centroid(rows, "v", centers).collect()}
    assert got == {1: (None, None), 2: (None, None), 3: (1, 0.0)}
    long = spark.createDataFrame([([1.0, 1.0, 1.0],)], "v array<double>")
    with pytest.raises(Exception, match="vector length 3"):
        clustering.nearest_centroid(long, "v", centers).collect()


def test_training_does_not_depend_on_the_partitions(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([([float(x) for x in rng.normal(0, 1, 4)],) for _ in range(400)], "v array<double>")
    three, seven = (clustering.train(df.repartition(n), "v") for n in (3, 7))
    assert three.centroids.collect() == seven.centroids.collect()
    summary = three.summary.first()
    assert 1 <= summary.rounds <= 20 and summary.reassigned <= 1 and summary.objective > 0
    empty = clustering.train(df.limit(0), "v")
    assert empty.centroids.count() == 0 and empty.summary.first().rounds == 0


def test_start_follows_the_squared_distances(spark):
    """Draws of the second center over many seeds: in proportion to the squared distance, not the farthest alone."""
    rows = [(i, [float(x)]) for i, x in enumerate([0, 0, 0, 0, 3, 3, 3, 4])]
    points = clustering.settle(spark.createDataFrame(rows, "key int, v array<double>").selectExpr("v", "CAST(key AS string) AS key"))
    seconds = [tuple(c[0] for c in clustering.first_centers(points, 2, seed)) for seed in range(60)]
    from_zero = [b for a, b in seconds if a == 0.0]
    assert len(from_zero) > 15 and 0.0 not in from_zero
    assert 0.35 < sum(b == 3.0 for b in from_zero) / len(from_zero) < 0.85  # expected 27 / 43


def test_outliers_do_not_take_the_centers(spark):
    """The start by distances alone takes the outliers; drawn ones find the groups, so the objective is lower."""
    rng = np.random.default_rng(5)
    groups = [[float(x) for x in rng.normal((g * 8, g % 2 * 8), 0.5)] for g in range(5) for _ in range(400)]
    rows = [(i, v) for i, v in enumerate(groups + [[60.0, 0.0], [0.0, 60.0], [60.0, 60.0], [-60.0, 0.0]])]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    objective = clustering.train(df, "v", 5, key="id").summary.first().objective
    farthest = [min(v for _, v in rows)]
    while len(farthest) < 5:
        farthest.append(max((v for _, v in rows), key=lambda v: min(np.sum((np.array(v) - c) ** 2) for c in map(np.array, farthest))))
    x, centers = np.array([v for _, v in rows]), np.array(farthest)
    for _ in range(20):
        near = ((x[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        centers = np.array([x[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centers)])
    assert objective < ((x[:, None] - centers) ** 2).sum(axis=2).min(axis=1).sum()


def test_training_leaves_out_broken_vectors_and_stops_at_few(spark):
    df = spark.createDataFrame([(1, None), (2, [None, 1.0]), (3, [1.0, 1.0]), (4, [1.0, 1.0]), (5, [5.0, 5.0])], "id int, v array<double>")
    trained = clustering.train(df, "v", 4, key="id")
    assert [r.centroid for r in trained.centroids.orderBy("cluster_id").collect()] == [[1.0, 1.0], [5.0, 5.0]]
    assert trained.summary.first().objective == 0


def test_unknown_peer_group_gives_zero_features(spark):
    cols = "employee_id string, event_date date"
    empty = lambda extra: spark.createDataFrame([], f"{cols}, {extra}")
    silver = {
        "pacs": spark.createDataFrame([("A", day(8), True)], f"{cols}, after_hours_flag boolean"),
        "network": empty("event_type string, after_hours_flag boolean, vpn_flag boolean"),
        "dlp": empty("usb_flag boolean, cloud_upload_flag boolean"),
        "comms": empty("external_recipient_flag boolean"),
        "pai": empty("sentiment_score double"),
        "geo": empty("latitude double, longitude double"),
        "adjudication": empty("investigation_flag boolean, status_change_flag boolean"),
    }
    people = spark.createDataFrame([("A", None), ("B", "G")], "employee_id string, role_peer_group string")
    grid = G.feature_grid(silver, people, calendar(CFG), CFG)
    assert grid.count() == 2 * 14
    assert grid.filter(" or ".join(f"{c} <> 0 or {c} is null" for c in SCORE_FEATURES)).count() == 0
    assert grid.filter("impossible_travel_flag or clearance_anomaly_flag").count() == 0
