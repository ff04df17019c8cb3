"""Who held an identifier on the day of an event: a register with validity dates, joined as of the event's time.

The register's periods may overlap, leave gaps and have no end. They are first made disjoint, key by key: a table of changes (key, day,
who from that day on). Events and changes are then one sorted table, in which the last change before an event tells who it was. So no
event is compared with periods of its key, however many these are, and a register is never expanded into days.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lynxrisk.config import Scale
from lynxrisk.operators.ordering import SLICE, group_sizes, session_parts, sorted_slices, spread
from lynxrisk.sources.session import settle

#: The last day of a period without an end.
OPEN = 2**31 - 2


def _sweep(periods: list[tuple[int, int, str | None]]) -> list[tuple[int, str | None]]:
    """(day, who) at each change, of periods (first day, last day, who). The latest start wins; equal starts: the greatest name."""
    names = {w: -i for i, w in enumerate(sorted({w for _, _, w in periods if w is not None}))}
    waiting = sorted(periods, key=lambda p: p[0])
    borders = sorted({p[0] for p in periods} | {p[1] + 1 for p in periods if p[1] < OPEN})
    valid: list[tuple[int, int, int, str | None]] = []
    changes, at, now = [], 0, None
    for day in borders:
        while at < len(waiting) and waiting[at][0] <= day:
            start, end, who = waiting[at]
            heapq.heappush(valid, (-start, names.get(who, 1), end, who))
            at += 1
        while valid and valid[0][2] < day:
            heapq.heappop(valid)
        who = valid[0][3] if valid else None
        if who != now:
            changes.append((day, who))
            now = who
    return changes


def changes_of(register: DataFrame, key: str, since: str, until: str, who: str) -> DataFrame:
    """(_key, _day, who): from which day on which value holds; NULL where a period ends without another.

    A period includes its last day. Rows without a start, with an end before it, or without a key count for nothing; a period that names nobody hides
    those that began earlier. Equal periods are one before the shuffle, so a key's group is bounded by its dates, not by the rows of the register.
    A task walks through its sorted periods and holds one key at a time: many small keys cost no more than their rows.
    """
    start, end = F.unix_date(F.to_date(since)), F.coalesce(F.unix_date(F.to_date(until)), F.lit(OPEN))
    rows = register.select(F.col(key).alias("_key"), start.alias("start"), end.alias("end"), F.col(who).cast("string").alias("who"))
    periods = settle(rows.filter("_key IS NOT NULL AND start IS NOT NULL AND end >= start").groupBy("_key", "start", "end").agg(F.max("who").alias("who")))

    def swept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, out = None, [], []
        for batch in batches:
            names = [None if pd.isna(w) else w for w in batch["who"]]
            for key, *period in zip(batch["_key"].tolist(), batch["start"].tolist(), batch["end"].tolist(), names, strict=True):
                if held and key != now and (key == key or now == now):  # NaN is one key
                    out += [(now, *change) for change in _sweep(held)]
                    held = []
                now = key
                held.append(tuple(period))
            if out:
                yield pd.DataFrame(out, columns=["_key", "_day", "who"])
                out = []
        if held:
            yield pd.DataFrame([(now, *change) for change in _sweep(held)], columns=["_key", "_day", "who"])

    kind = dict(rows.dtypes)["_key"]
    parts = max(session_parts(register), ceil(periods.count() / Scale().task_rows))
    return periods.repartition(parts, "_key").sortWithinPartitions("_key").mapInPandas(swept, f"_key {kind}, _day int, who string")


def assigned_at(
    events: DataFrame,
    register: DataFrame,
    on: tuple[str, str],
    time: str,
    since: str = "effective_start",
    until: str = "effective_end",
    who: str = "employee_id",
    scale: Scale = Scale(),
) -> DataFrame:
    """All events with ``who`` (text) of the period of their key that is valid on their day; NULL in a gap or for an unknown key.

    ``on``: the key's column in the events and in the register. Of several valid periods the one with the latest start counts. Events with a NULL key or time have
    nobody and are not shuffled. If the largest key has more than ``Scale.window_rows`` rows, the sorted table is cut into ranges of
    (key, day, a hash of the event), and the value that holds at a cut is carried over it: one row for each key and range. An event column of the name ``who`` is replaced.
    """
    kept = [F.col(f"`{c}`") for c in events.columns if c.lower() != who.lower()]
    day = F.unix_date(F.to_date(time))
    marked = events.select(F.col(on[0]).alias("_key"), day.alias("_day"), F.struct(*kept).alias("_event"))
    nobody = F.lit(None).cast("string").alias(who)
    lost = marked.filter("_key IS NULL OR _day IS NULL").select("_event.*", nobody)
    asked = marked.filter("_key IS NOT NULL AND _day IS NOT NULL").withColumn("_kind", F.lit(1)).withColumn("_tie", F.xxhash64("_event"))
    # only what is asked for is swept: a register may hold many keys that no event has
    keys = settle(asked.select(F.col("_key").alias("_asked")).distinct())
    changes = settle(changes_of(register.join(keys, F.col(on[1]) == F.col("_asked"), "left_semi"), on[1], since, until, who))
    told = changes.select("_key", "_day", F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"), F.struct("who").alias("_change"))
    rows = asked.unionByName(told, allowMissingColumns=True)
    order = ["_day", "_kind", "_tie"]
    largest, total = group_sizes(rows.select("_key"), ["_key"])
    if largest <= scale.window_rows:
        upto = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        held = spread(rows, total, ["_key"]).withColumn("_held", F.last("_change", ignorenulls=True).over(upto))
    else:
        slices = sorted_slices(rows, ["_key"], order, ceil(largest / scale.chunk_rows), total)
        here = Window.partitionBy("_key", SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        local = spread(slices, total, ["_key", SLICE]).withColumn("_here", F.last("_change", ignorenulls=True).over(here))
        ends = slices.groupBy("_key", SLICE).agg(F.max(F.when(F.col("_kind") == 0, F.struct("_day", "_change"))).alias("_last"))
        earlier = Window.partitionBy("_key").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select("_key", SLICE, F.last("_last", ignorenulls=True).over(earlier)["_change"].alias("_carried"))
        held = local.join(carried, ["_key", SLICE], "left").withColumn("_held", F.coalesce("_here", "_carried"))
    return held.filter("_kind = 1").select("_event.*", F.col("_held.who").alias(who)).unionByName(lost)
