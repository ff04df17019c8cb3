"""The lineage columns that every silver table starts with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lynxrisk.config import RESOLVED, RunContext
from lynxrisk.functions.expr import record_hash

LINEAGE_COLUMNS = [
    "employee_id",
    "event_date",
    "event_timestamp",
    "source_domain",
    "source_file",
    "record_hash",
    "ingested_at",
    "transformed_at",
    "pipeline_version",
    "identity_resolution_status",
]


def lineage(
    employee: Column,
    event_date: Column,
    domain: str,
    source_file: str,
    hash_parts: Sequence[Column],
    ctx: RunContext,
    native: Column | None = None,
) -> list[Column]:
    """The common prefix; ``native`` is the third column (the timestamp or the source's own id)."""
    first = [employee.alias("employee_id"), event_date.alias("event_date")]
    if native is not None:
        first.append(native)
    return [
        *first,
        F.lit(domain).alias("source_domain"),
        F.lit(source_file).alias("source_file"),
        record_hash(hash_parts).alias("record_hash"),
        F.lit(ctx.ingested_at).alias("ingested_at"),
        F.lit(ctx.ingested_at).alias("transformed_at"),
        F.lit(ctx.pipeline_version).alias("pipeline_version"),
        F.lit(RESOLVED).alias("identity_resolution_status"),
    ]
