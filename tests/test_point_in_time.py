import datetime as dt
import random

import pytest

from lynxrisk.config import Scale
from lynxrisk.operators.ordering import sliding_days
from lynxrisk.operators.point_in_time import assigned_at
from tests.conftest import TINY, day

REGISTER = "machine_id string, employee_id string, effective_start date, effective_end date"
EVENTS = "event_id int, machine string, at timestamp, employee_id string"


def brute(events, register):
    out = {}
    for e, machine, at, _ in events:
        valid = [
            (s, who is not None, who or "", who)
            for m, who, s, t in register
            if at and m == machine and m is not None and s and s <= at.date() and (t is None or at.date() <= t)
        ]
        out[e] = max(valid)[3] if valid else None
    return out


def answer(spark, events, register, scale=Scale(), parts=3):
    rows = spark.createDataFrame(events, EVENTS).repartition(parts)
    got = assigned_at(rows, spark.createDataFrame(register, REGISTER).repartition(parts), ("machine", "machine_id"), "at", scale=scale)
    assert got.columns == ["event_id", "machine", "at", "employee_id"]
    found = got.collect()
    assert len(found) == len(events)
    return {r.event_id: r.employee_id for r in found}


def noon(n):
    return dt.datetime.combine(day(n), dt.time(12))


@pytest.mark.parametrize("scale", [Scale(), TINY])
def test_named_cases(spark, scale):
    register = [
        ("gap", "A", day(1), day(3)), ("gap", "B", day(6), day(7)),
        ("overlap", "A", day(1), day(9)), ("overlap", "B", day(4), day(5)),  # B inside A: A holds again after B
        ("open", "A", day(1), None), ("open", "B", day(5), None),
        ("equal", "A", day(2), day(8)), ("equal", "B", day(2), day(4)),
        ("nobody", "A", day(1), None), ("nobody", None, day(3), day(4)),
        ("never", "A", day(5), day(2)), ("never", "B", None, day(9)), (None, "A", day(1), None),
    ]
    machines = ["gap", "overlap", "open", "equal", "nobody", "never", "unknown", None]
    events = [(100 * i + n, m, noon(n), "old") for i, m in enumerate(machines) for n in range(11)] + [(9999, "open", None, "old")]
    got = answer(spark, events, register, scale)
    assert got == brute(events, register)
    assert [got[n] for n in range(9)] == [None, "A", "A", "A", None, None, "B", "B", None]
    assert [got[100 + n] for n in (3, 4, 5, 6, 9, 10)] == ["A", "B", "B", "A", "A", None]
    assert [got[300 + n] for n in (1, 2, 4, 5)] == [None, "B", "B", "A"]


@pytest.mark.parametrize("scale", [Scale(), TINY])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_registers(spark, scale, seed):
    """Half of all events on one machine; the open assignment is carried over every cut."""
    rng = random.Random(seed)
    machines = ["hot", "hot", "hot", "a", "b"]
    register = []
    for i in range(40):
        start = rng.randint(0, 60)
        register.append((rng.choice(machines), f"E{i:02}", day(start), rng.choice([None, day(start + rng.randint(-2, 12))])))
    register += register[:5]
    events = [(i, rng.choice(machines), noon(rng.randint(0, 80)), "x") for i in range(300)]
    events += [(i, "hot", noon(33), "x") for i in range(300, 360)]
    want = brute(events, register)
    assert answer(spark, events, register, scale) == want == answer(spark, events, register, scale, 7)


def test_empty_tables_and_plan(spark):
    events = [(1, "a", noon(1), "x")]
    assert answer(spark, events, [("b", "A", day(1), None)]) == {1: None}
    none = spark.createDataFrame([], REGISTER)
    rows = spark.createDataFrame(events, EVENTS)
    assert assigned_at(rows, none, ("machine", "machine_id"), "at").first().employee_id is None
    assert assigned_at(rows.limit(0), none, ("machine", "machine_id"), "at").count() == 0
    plan = assigned_at(rows, none, ("machine", "machine_id"), "at")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Join" not in plan  # no event meets a period by a join


def test_frames_of_days_against_loops(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["hot", "hot", "b", None]), rng.choice([None, *[day(n) for n in range(0, 200, 7)]]), rng.choice([None, rng.randint(-5, 9)])) for i in range(400)]
    rows += [(400 + i, "hot", day(70), 1) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, key string, day date, v int").repartition(5)
    frames = {"total": ("sum", "v"), "n": ("count", "v"), "least": ("min", "v"), "most": ("max", "v"), "mean": ("avg", "v")}
    got = {r.id: r for r in sliding_days(df, frames, ["key"], "day", 29).collect()}
    assert len(got) == len(rows)
    for i, key, d, _ in rows:
        mine = [v for _, k, e, v in rows if k == key and v is not None and ((d is None and e is None) or (d and e and 0 <= (d - e).days <= 29))]
        r = got[i]
        assert (r.total, r.n, r.least, r.most) == (sum(mine) if mine else None, len(mine), min(mine, default=None), max(mine, default=None))
        assert r.mean == (pytest.approx(sum(mine) / len(mine)) if mine else None)
