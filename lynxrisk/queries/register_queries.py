"""Registers with validity dates, and frames of days, on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lynxrisk.operators.ordering import sliding_days
from lynxrisk.operators.point_in_time import assigned_at
from lynxrisk.queries.feature_queries import TINY
from lynxrisk.queries.feeds import Feeds, name
from lynxrisk.queries.registry import query


def assignments(f: Feeds) -> DataFrame:
    """A machine (supplier and line number) belongs to a part's owner for as many days as the line's quantity; some periods have no end."""
    machine = F.concat(name("MACH_", "l_suppkey"), F.lit("_"), F.col("l_linenumber").cast("string"))
    start = F.to_date("l_shipdate")
    end = F.when(F.col("l_partkey") % 41 != 0, F.date_add(start, F.col("l_quantity").cast("int")))
    return f.table("lineitem").select(
        machine.alias("machine_id"), name("EMP_", "l_partkey").alias("employee_id"), start.alias("effective_start"), end.alias("effective_end")
    )


def machine_events(f: Feeds) -> DataFrame:
    """Every order as an event on a machine; a third of them on one machine, some on none."""
    usual = F.concat(F.lit("MACH_"), (F.col("o_custkey") % 100 + 1).cast("string"), F.lit("_"), (F.col("o_orderkey") % 7 + 1).cast("string"))
    machine = F.when(F.col("o_orderkey") % 11 == 0, F.lit(None)).when(F.col("o_orderkey") % 3 == 0, F.lit("MACH_1_1")).otherwise(usual)
    return f.table("orders").select("o_orderkey", machine.alias("machine_id"), F.col("o_orderdate").alias("event_timestamp"), "o_totalprice")


_EVENTS = """e AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'MACH_1_1'
                          ELSE 'MACH_' || (o_custkey % 100 + 1) || '_' || (o_orderkey % 7 + 1) END AS machine_id,
                      CAST(o_orderdate AS DATE) AS d, o_totalprice FROM orders)"""
_PIT = f"""WITH r AS (SELECT 'MACH_' || l_suppkey || '_' || l_linenumber AS machine_id, 'EMP_' || l_partkey AS employee_id, CAST(l_shipdate AS DATE) AS s,
                             CASE WHEN l_partkey % 41 <> 0 THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) END AS t FROM lineitem),
                {_EVENTS}
           SELECT o_orderkey, e.machine_id, arg_max(employee_id, (s, employee_id)) AS employee_id
           FROM e LEFT JOIN r ON e.machine_id = r.machine_id AND s <= d AND d <= coalesce(t, DATE '9999-12-31')
           GROUP BY o_orderkey, e.machine_id"""


@query("q48_pit_register", _PIT)
def point_in_time(f: Feeds) -> DataFrame:
    found = assigned_at(machine_events(f), assignments(f), ("machine_id", "machine_id"), "event_timestamp")
    return found.select("o_orderkey", "machine_id", "employee_id")


@query("q48b_pit_register_cut", _PIT)
def point_in_time_cut(f: Feeds) -> DataFrame:
    """The form for a hot machine, at sizes at which it is used on the given tables."""
    found = assigned_at(machine_events(f), assignments(f), ("machine_id", "machine_id"), "event_timestamp", scale=TINY)
    return found.select("o_orderkey", "machine_id", "employee_id")


_DAYS = f"""WITH {_EVENTS}
            SELECT o_orderkey, round(sum(o_totalprice) OVER w, 2) + 0 AS spent, count(*) OVER w AS events, max(o_totalprice) OVER w AS most
            FROM e WINDOW w AS (PARTITION BY machine_id ORDER BY d RANGE BETWEEN 29 PRECEDING AND CURRENT ROW)"""


@query("q57_spend_days", _DAYS)
def spend_days(f: Feeds) -> DataFrame:
    """Sums over the 30 days up to each event, not over 30 rows."""
    dated = machine_events(f).withColumn("day", F.to_date("event_timestamp"))
    frames = {"spent": ("sum", "o_totalprice"), "events": ("count", "o_orderkey"), "most": ("max", "o_totalprice")}
    out = sliding_days(dated, frames, ["machine_id"], "day", 29)
    return out.select("o_orderkey", (F.round("spent", 2) + 0).alias("spent"), "events", "most")
