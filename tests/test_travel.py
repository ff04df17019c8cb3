import numpy as np
import pandas as pd
import pytest

from lynxrisk.operators import travel
from tests.conftest import day

SCHEMA = "k long, d date, la double, lo double"


def run(spark, rows):
    out = travel.impossible_travel(spark.createDataFrame(rows, SCHEMA), "k", "d", "la", "lo")
    return {(r.k, r.d): r.impossible for r in out.collect()}


def km(a, b):
    la1, lo1, la2, lo2 = map(np.radians, (*a, *b))
    h = np.sin((la2 - la1) / 2) ** 2 + np.cos(la1) * np.cos(la2) * np.sin((lo2 - lo1) / 2) ** 2
    return 6371 * 2 * np.arcsin(np.sqrt(min(h, 1)))


def test_pairs_of_a_day(spark):
    dc, ny, la = (38.9, -77.0), (40.7, -74.0), (34.0, -118.2)
    got = run(
        spark,
        [(1, day(0), *dc), (1, day(0), *ny), (2, day(0), *dc), (2, day(0), *la), (3, day(0), *dc), (3, day(1), *la),
         (4, day(0), *dc), (5, day(0), None, -77.0), (5, day(0), *dc), (6, day(0), None, None),
         (7, day(0), 0.0, 179.9), (7, day(0), 0.0, -179.9)],
    )
    assert got == {
        (1, day(0)): False, (2, day(0)): True, (3, day(0)): False, (3, day(1)): False, (4, day(0)): False,
        (5, day(0)): False, (6, day(0)): False, (7, day(0)): False,
    }


@pytest.mark.parametrize("few", [100, 4])
def test_equals_all_pairs(spark, monkeypatch, few):
    """Spreads around the limit, also at the poles and across the date line."""
    monkeypatch.setattr(travel, "FEW_POINTS", few)
    rng = np.random.default_rng(4)
    rows, groups = [], {}
    for g in range(200):
        spread = rng.choice([1, 3, 4.2, 4.4, 4.6, 5, 180])
        center = rng.uniform(-88, 88)
        groups[g] = []
        for _ in range(int(rng.integers(1, 14))):
            la = float(np.clip(center + rng.uniform(-spread / 2, spread / 2), -90, 90))
            lo = float(rng.uniform(-spread / 2, spread / 2) / max(np.cos(np.radians(center)), 0.2) + rng.choice([0.0, 179.0]))
            rows.append((g, day(0), la, lo))
            groups[g].append((la, lo))
    expect = {(g, day(0)): any(km(a, b) > 500 for i, a in enumerate(p) for b in p[:i]) for g, p in groups.items()}
    assert run(spark, rows) == expect
    assert 20 < sum(expect.values()) < 190


@pytest.mark.parametrize("piece,block", [(50_000, 4000), (300, 100)])
def test_one_day_with_very_many_points(spark, monkeypatch, piece, block):
    """A disc of 20,000 points just too small, and one with two points more."""
    monkeypatch.setattr(travel, "PIECE_POINTS", piece)
    monkeypatch.setattr(travel, "BLOCK_POINTS", block)
    rng = np.random.default_rng(7)
    r, a = 2.24 * np.sqrt(rng.random(20000)), rng.random(20000) * 2 * np.pi
    disc = [(1, day(0), float(x), float(y)) for x, y in zip(r * np.sin(a), r * np.cos(a))]
    far = [(2, *row[1:]) for row in disc] + [(2, day(0), 0.0, 2.27), (2, day(0), 0.0, -2.27)]
    got = run(spark, disc + far)
    assert got == {(1, day(0)): False, (2, day(0)): True}


def test_a_ring_of_corners_is_spread_over_tasks(spark, monkeypatch):
    """200,000 points on a circle are all corners; no task compares more than two blocks of them."""
    monkeypatch.setattr(travel, "BLOCK_POINTS", 2000)
    monkeypatch.setattr(travel, "PIECE_POINTS", 5000)
    a = np.linspace(0, 2 * np.pi, 200_000, endpoint=False)
    ring = pd.DataFrame({"g": 1, "d": day(0), "la": 2.245 * np.sin(a), "lo": 2.245 * np.cos(a)})
    table = spark.createDataFrame(ring)
    assert travel.impossible_travel(table, "g", "d", "la", "lo").first().impossible is False
    wider = ring.assign(la=ring.la * 1.003, lo=ring.lo * 1.003)
    assert travel.impossible_travel(spark.createDataFrame(wider), "g", "d", "la", "lo").first().impossible is True


def test_the_directions_cover_the_sphere():
    rng = np.random.default_rng(8)
    d = np.array(travel.DIRECTIONS, float)
    d /= np.linalg.norm(d, axis=1)[:, None]
    v = rng.normal(size=(200000, 3))
    v /= np.linalg.norm(v, axis=1)[:, None]
    assert np.abs(v @ d.T).max(axis=1).min() >= travel.NEAREST_DIRECTION


def test_hull_keeps_the_farthest_pair():
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"_lat": rng.uniform(40, 42, 500), "_lon": rng.uniform(10, 12, 500)})
    corners = travel.hull_corners(pdf)
    far = lambda p: max(km(a, b) for a in p.to_numpy() for b in p.to_numpy())
    assert len(corners) < 60
    assert far(corners) == pytest.approx(far(pdf.iloc[::1]), abs=1e-9)
