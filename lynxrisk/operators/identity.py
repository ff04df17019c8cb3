"""From a source's own identifier to the employee: registers, resolution, dead letters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lynxrisk.config import RESOLVED, UNRESOLVED, RiskConfig, RunContext
from lynxrisk.functions.expr import piped, record_hash

DEAD_LETTER_COLUMNS = [
    "source_domain",
    "source_file",
    "raw_identifier",
    "identifier_type",
    "record_hash",
    "identity_resolution_status",
    "ingested_at",
    "pipeline_version",
    "raw_record",
]


def latest_register(register: DataFrame, key: str, since: str, employee: str = "employee_id") -> DataFrame:
    """The latest assignment per key; an undated one only if there is no other.

    A grouped maximum, so every map task sends at most one row per key. Equal dates: the
    greatest employee id.
    """
    return latest_rows(register, key, since, employee).drop(since)


def latest_rows(register: DataFrame, key: str, since: str, employee: str = "employee_id") -> DataFrame:
    """The same with the date: a register that says no less than the whole about the latest assignments."""
    latest = F.max(F.struct(F.col(since), F.col(employee))).alias("_last")
    return register.groupBy(key).agg(latest).select(key, F.col(f"_last.{employee}").alias(employee), F.col(f"_last.{since}").alias(since))


def known_people(register: DataFrame) -> DataFrame:
    """Register rows that name an employee."""
    return register.filter(F.col("employee_id").isNotNull())


def dual_register(directory: DataFrame, handles: DataFrame) -> DataFrame:
    """E-mail addresses and social handles as one register keyed by (matched_on, handle)."""
    mails = directory.select(
        F.lit("email").alias("matched_on"), F.col("email_address").alias("handle"), "employee_id"
    )
    socials = handles.select(
        F.lit("social_handle").alias("matched_on"), F.col("social_handle").alias("handle"), "employee_id"
    )
    return known_people(mails.unionByName(socials))


@dataclass(frozen=True)
class Resolved:
    """Events with the employee found, and the dead letters."""

    ok: DataFrame
    dead: DataFrame


def tag_identity(events: DataFrame, register: DataFrame, on: dict[str, str]) -> DataFrame:
    """All events, with ``employee_id`` (or NULL) and the resolution status: one scan, one join.

    ``on`` maps event columns to register columns. The join type is left to Spark: a register
    under the broadcast threshold is broadcast, a larger one is merge-joined, where adaptive
    execution splits an identifier that owns too many events.
    """
    side = register.select(
        *[F.col(theirs).alias(f"_r{i}") for i, theirs in enumerate(on.values())],
        F.col("employee_id"),
        F.lit(True).alias("_hit"),
    )
    condition = [F.col(ours) == F.col(f"_r{i}") for i, ours in enumerate(on)]
    status = F.when(F.col("_hit"), F.lit(RESOLVED)).otherwise(F.lit(UNRESOLVED))
    return (
        events.join(side, condition, "left")
        .withColumn("identity_resolution_status", status)
        .drop("_hit", *[f"_r{i}" for i in range(len(on))])
    )


def dead_letters(
    tagged: DataFrame,
    domain: str,
    source_file: str,
    identifier: Column,
    identifier_type: Column,
    hash_parts: Sequence[Column],
    raw_parts: Sequence[Column],
    ctx: RunContext,
) -> DataFrame:
    return tagged.filter(F.col("identity_resolution_status") == UNRESOLVED).select(
        F.lit(domain).alias("source_domain"),
        F.lit(source_file).alias("source_file"),
        identifier.alias("raw_identifier"),
        identifier_type.alias("identifier_type"),
        record_hash(hash_parts).alias("record_hash"),
        F.lit(UNRESOLVED).alias("identity_resolution_status"),
        F.lit(ctx.ingested_at).alias("ingested_at"),
        F.lit(ctx.pipeline_version).alias("pipeline_version"),
        piped(raw_parts).alias("raw_record"),
    )


def resolution_floor(domain: str, cfg: RiskConfig = RiskConfig()) -> float:
    """External feeds, named with the prefix ``osint_``, are allowed to match less."""
    return cfg.min_external_resolution if domain.startswith("osint_") else cfg.min_resolution


class ResolutionTooLow(RuntimeError):
    pass


def resolution_gate(resolved: int, total: int, domain: str, cfg: RiskConfig = RiskConfig()) -> None:
    """Stop the run if too few events of a feed found their employee; an empty feed passes."""
    floor = resolution_floor(domain, cfg)
    if total and resolved / total < floor:
        raise ResolutionTooLow(f"{domain}: {resolved} of {total} resolved, need {floor:.0%}")


def resolution_report(tagged: DataFrame, cfg: RiskConfig = RiskConfig()) -> DataFrame:
    """Resolved and total events per ``source_domain`` with the verdict of the gate."""
    resolved = F.count_if(F.col("identity_resolution_status") == RESOLVED)
    floor = F.when(F.col("source_domain").startswith("osint_"), F.lit(cfg.min_external_resolution))
    return (
        tagged.groupBy("source_domain")
        .agg(resolved.alias("resolved"), F.count(F.lit(1)).alias("total"))
        .withColumn("rate", F.round(F.col("resolved") / F.col("total"), 4))
        .withColumn(
            "passed",
            F.col("resolved") / F.col("total") >= floor.otherwise(F.lit(cfg.min_resolution)),
        )
    )
