"""The feeds and registers of the engine, derived from the given tables.

A person is a ``customer``; an event of a feed is a row of ``events`` (one feed per event
type); tweets are ``conversations``, posts are ``pages``, spending signals are ``orders``, and
the owner of a machine is the customer who last had a delivery from a supplier. The registers
are incomplete in a natural way: only customers with a balance of zero or more hold a badge,
and the handles of the others name nobody. ``FEED_SQL`` has the same definitions in SQL.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lynxrisk.config import RiskConfig, RunContext
from lynxrisk.functions.expr import after_hours, first_match, on_weekend
from lynxrisk.operators.identity import latest_rows
from lynxrisk.operators.ordering import spread
from lynxrisk.operators.rolling import data_calendar
from lynxrisk.plans import silver as S
from lynxrisk.sources.session import settle

CTX = RunContext(dt.datetime(2024, 2, 1), "s2_silver_v2", "run-1")
CFG = RiskConfig(timeline_start=dt.date(2024, 1, 1), timeline_days=30)

TITLES = {
    "MACHINERY": "Senior Engineer",
    "BUILDING": "Team Lead",
    "AUTOMOBILE": "Analyst",
    "FURNITURE": "Deputy VP",
}

# the given texts are invented words, so the rules look for syllables that occur in them
EMOTIONS = {"frustration": ["ation", "eaux"], "grievance": ["the of"], "distress": ["ing", "la de"], "hostility": ["sch"]}
KEYWORDS = {"sensitive_terms": ["tion"], "job_seeking": ["the and the", ". la"]}
REGISTERS = {"pacs": "badges", "geo": "badges", "network": "machines", "dlp": "machines", "comms": "directory", "pai": "handles"}
PLACES = S.PlaceRules(sensitive=("blog.", "spam-farm"), hubs=(".net/", ".html"), luxury=("utm_source", "#top"))


def name(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


class Feeds:
    """Bronze inputs and silver tables over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, table: str) -> DataFrame:
        if table not in self._tables:
            self._tables[table] = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        return self._tables[table]

    # --- events and people ---------------------------------------------------

    @cached_property
    def events(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").select(
            "event_id", F.col("ts").cast("timestamp").alias("event_timestamp"), "user_id", "event_type", "value",
            k.alias("k"),
        )

    def of_type(self, *types: str) -> DataFrame:
        return self.events.filter(F.col("event_type").isin(*types))

    @property
    def ends(self) -> Column:
        return data_calendar(self.events.select(F.to_date("event_timestamp").alias("day")), "day")

    @cached_property
    def hris(self) -> DataFrame:
        title = first_match([(F.col("c_mktsegment") == s, t) for s, t in TITLES.items()], "Clerk")
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        return (
            self.table("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                name("EMP_", "c_custkey").alias("employee_id"),
                F.col("c_name").alias("full_name"),
                F.col("n_name").alias("department"),
                title.alias("role_title"),
                F.col("c_mktsegment").alias("role_peer_group"),
                F.col("r_name").alias("clearance_level"),
                F.when(F.col("c_acctbal") >= 0, "active").otherwise("inactive").alias("employment_status"),
                F.lit(dt.date(2020, 1, 1)).alias("start_date"),
                F.lit(None).cast("date").alias("end_date"),
            )
        )

    # --- registers -------------------------------------------------------------

    @cached_property
    def badges(self) -> DataFrame:
        holders = self.table("customer").filter(F.col("c_acctbal") >= 0)
        return holders.select(name("BADGE_", "c_custkey").alias("badge_id"), name("EMP_", "c_custkey").alias("employee_id"))

    @cached_property
    def machines(self) -> DataFrame:
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
        lines = spread(lines, self.table("lineitem").count(), ["l_orderkey"]).join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        return lines.select(
            name("MACH_", "l_suppkey").alias("machine_id"),
            name("EMP_", "o_custkey").alias("employee_id"),
            F.to_date("l_shipdate").alias("effective_start"),
        )

    @cached_property
    def owners(self) -> DataFrame:
        """The latest assignments of the machines, written once for the feeds that look them up."""
        return settle(latest_rows(self.machines, "machine_id", "effective_start"))

    @cached_property
    def directory(self) -> DataFrame:
        mail = F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@corp.internal"))
        return self.table("customer").select(mail.alias("email_address"), name("EMP_", "c_custkey").alias("employee_id"))

    @cached_property
    def handles(self) -> DataFrame:
        return self.table("customer").select(
            name("@u", "c_custkey").alias("social_handle"),
            F.when(F.col("c_acctbal") >= 0, name("EMP_", "c_custkey")).alias("employee_id"),
        )

    # --- internal feeds --------------------------------------------------------

    @cached_property
    def pacs(self) -> DataFrame:
        k, ts = F.col("k"), F.col("event_timestamp")
        return self.of_type("click").select(
            name("BADGE_", "user_id").alias("badge_id"), "event_timestamp",
            F.concat(F.lit("B"), (k % 10).cast("string")).alias("building_code"),
            F.when(k >= 10, name("D", "k")).alias("door_id"),
            F.concat(F.lit("Site "), (k % 4).cast("string")).alias("location_name"),
            F.when(k % 2 == 0, "in").otherwise("out").alias("direction"),
            after_hours(ts).alias("after_hours"), on_weekend(ts).alias("weekend"),
        )

    @cached_property
    def network(self) -> DataFrame:
        k = F.col("k")
        return self.of_type("view").select(
            name("MACH_", "user_id").alias("machine_id"), name("10.0.0.", "k").alias("ip_address"), "event_timestamp",
            F.when(k % 2 == 0, "dns").otherwise("session").alias("event_type"),
            (k < 30).alias("vpn_flag"),
            F.when(k % 2 == 0, name("host", "k")).alias("dns_query_domain"),
            (F.col("event_id") * 10).alias("bytes_transferred"),
            F.col("value").alias("session_duration_min"),
            after_hours(F.col("event_timestamp")).alias("after_hours"),
        )

    @cached_property
    def dlp(self) -> DataFrame:
        k = F.col("k")
        return self.of_type("purchase").select(
            name("MACH_", "user_id").alias("machine_id"), name("user", "user_id").alias("user_account"),
            "event_timestamp", F.lit("copy").alias("event_type"), name("f", "event_id").alias("file_name"),
            F.when(k % 2 == 0, "pdf").otherwise("csv").alias("file_extension"),
            F.col("value").alias("file_size_mb"), F.lit("disk").alias("destination_type"),
            (k < 20).alias("usb_flag"), ((k >= 20) & (k < 30)).alias("print_flag"), (k >= 80).alias("cloud_upload_flag"),
        )

    @cached_property
    def comms(self) -> DataFrame:
        k = F.col("k")
        return self.of_type("signup").select(
            F.concat(name("user", "user_id"), F.lit("@corp.internal")).alias("email_address"), "event_timestamp",
            F.when(k % 2 == 0, "email").otherwise("slack").alias("channel_type"),
            (k % 7 + 1).alias("recipient_count"), (k % 5 == 0).alias("external_recipient_flag"),
            (k % 3 == 0).alias("attachment_flag"), F.col("value").alias("attachment_size_mb"),
            after_hours(F.col("event_timestamp")).alias("after_hours"),
        )

    @cached_property
    def pai(self) -> DataFrame:
        k = F.col("k")
        return self.of_type("error").select(
            name("@u", "user_id").alias("social_handle"), "event_timestamp", F.lit("x").alias("platform"),
            ((k - 50) / 50.0).alias("sentiment_score"), (k % 5).alias("post_count"), k.alias("engagement_count"),
        )

    @cached_property
    def geo(self) -> DataFrame:
        k = F.col("k")
        return self.events.select(
            name("BADGE_", "user_id").alias("badge_id"), name("DEV_", "event_type").alias("device_id"),
            "event_timestamp", F.concat(F.lit("B"), (k % 10).cast("string")).alias("building_code"),
            F.when(k != 50, k % 10 * 0.45 + 38.0).alias("latitude"),
            (F.col("event_id") % 13 * 0.4 - 77.0).alias("longitude"), F.lit("phone").alias("device_type"),
        )

    @cached_property
    def adjudication(self) -> DataFrame:
        k = F.col("k")
        return self.of_type("error").select(
            name("EMP_", "user_id").alias("employee_id"), "event_timestamp", F.lit("SECRET").alias("clearance_level"),
            F.when(k > 97, "suspended").otherwise("active").alias("clearance_status"),
            (k > 95).alias("investigation_flag"), F.lit(None).cast("date").alias("reinvestigation_due_date"),
            (k == 90).alias("status_change_flag"),
        )

    # --- external feeds --------------------------------------------------------

    @cached_property
    def tweets(self) -> DataFrame:
        day = F.make_interval(days=(F.col("conv_id") % 30).cast("int"), mins=F.col("turn").cast("int"))
        return self.table("conversations").select(
            F.concat(name("TWE_", "conv_id"), name("_", "turn")).alias("tweet_id"),
            (F.lit(dt.datetime(2024, 1, 1, 8)) + day).alias("scraped_datetime"),
            name("@u", "conv_id").alias("handle"), F.col("text").alias("tweet_text"),
        )

    @cached_property
    def posts(self) -> DataFrame:
        p = F.col("page_id")
        at = F.make_interval(days=(p % 30).cast("int"), hours=(p % 24).cast("int"))
        return self.table("pages").select(
            name("IGP_", "page_id").alias("post_id"),
            (F.lit(dt.datetime(2024, 1, 1)) + at).alias("scraped_datetime"),
            name("@u", "page_id").alias("handle"), F.col("url").alias("location_string"),
            F.when(p % 5 != 0, p % 17 * 0.1 + 38.0).alias("location_lat"), (p % 11 * 0.1 - 77.6).alias("location_lon"),
            F.when(p % 3 == 0, "check_in").otherwise("photo").alias("post_type"),
        )

    @cached_property
    def lifestyle(self) -> DataFrame:
        days = F.datediff(F.to_date("o_orderdate"), F.lit(dt.date(1995, 1, 1))) % 30
        return self.table("orders").select(
            name("LSG_", "o_orderkey").alias("signal_id"),
            F.date_add(F.lit(dt.date(2024, 1, 1)), days).cast("timestamp").alias("scraped_datetime"),
            name("@u", "o_custkey").alias("handle"), F.col("o_orderpriority").alias("signal_source"),
            F.floor("o_totalprice").cast("int").alias("estimated_value_usd"),
        )

    @cached_property
    def financial(self) -> DataFrame:
        k = F.col("k")
        kinds = ["bankruptcy_filing", "lien", "eviction_notice", "civil_judgment", "tax_notice"]
        kind = first_match([(k % 6 == i, f',"type":"{t}"') for i, t in enumerate(kinds)], "")
        amount = F.when(k % 7 != 0, F.concat(F.lit(',"amount":'), (k * 10).cast("string"))).otherwise(F.lit(""))
        return self.of_type("purchase").select(
            name("FSR_", "event_id").alias("record_id"), F.col("event_timestamp").alias("scraped_datetime"),
            name("EMP_", "user_id").alias("employee_id"), F.lit("court").alias("source"),
            F.concat(F.lit('{"k":'), k.cast("string"), kind, amount, F.lit("}")).alias("raw_json"),
        )

    @cached_property
    def darkweb(self) -> DataFrame:
        k = F.col("k")
        by_mail = F.col("event_type").isin("click", "view", "signup")
        host = F.when(F.col("value") < 100, "@corp.internal").otherwise("@company.com")
        mail = F.concat(name("user", "user_id"), host)
        severity = first_match([(k < 20, ',"severity":"high"'), (k < 50, ',"severity":"medium"'), (k < 90, ',"severity":"low"')], "")
        return self.events.select(
            name("DWS_", "event_id").alias("detection_id"), F.col("event_timestamp").alias("scraped_datetime"),
            F.when(k != 13, F.when(by_mail, mail).otherwise(name("@u", "user_id"))).alias("handle"),
            F.lit("breach").alias("signal_source"),
            F.when(by_mail, "email").otherwise("social_handle").alias("matched_on"),
            F.concat(F.lit('{"type":"'), F.col("event_type"), F.lit('"'), severity, F.lit("}")).alias("raw_json"),
        )

    # --- silver ----------------------------------------------------------------

    def feed(self, domain: str) -> S.Resolved:
        return S.silver_feed(domain, getattr(self, domain), getattr(self, REGISTERS[domain]), CTX)

    def matched(self, domain: str) -> DataFrame:
        """A feed's resolved events and dead letters, of the machines' latest owners: for several feeds."""
        register = REGISTERS[domain].replace("machines", "owners")
        return S.matched_feed(domain, getattr(self, domain), getattr(self, register), CTX)

    @cached_property
    def sv_hris(self) -> DataFrame:
        return S.silver_hris(self.hris, CTX)

    @cached_property
    def sv_adjudication(self) -> DataFrame:
        return S.silver_adjudication(self.adjudication, CTX)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        tables = {d: self.feed(d).ok for d in ("pacs", "network", "dlp", "comms", "geo")}
        return {**tables, "pai": self.sv_pai_tagged, "adjudication": self.sv_adjudication}

    @cached_property
    def sv_pai_tagged(self) -> DataFrame:
        return S.tag_social(self.feed("pai").ok, self.tweets, self.handles, EMOTIONS, KEYWORDS)

    @cached_property
    def anomalies(self) -> S.Resolved:
        return S.silver_geo_anomalies(self.posts, self.handles, CTX, PLACES)

    @cached_property
    def sv_lifestyle(self) -> S.Resolved:
        return S.silver_lifestyle(self.lifestyle, self.handles, self.sv_hris, CTX)

    @cached_property
    def sv_financial(self) -> DataFrame:
        return S.silver_financial(self.financial, CTX)

    @cached_property
    def sv_darkweb(self) -> S.Resolved:
        return S.silver_darkweb(self.darkweb, self.directory, self.handles, CTX)

    @cached_property
    def dead(self) -> DataFrame:
        parts = [self.feed(d).dead for d in ("pacs", "network", "dlp", "comms", "pai", "geo")]
        parts += [self.anomalies.dead, self.sv_lifestyle.dead, self.sv_darkweb.dead]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
