"""Identity, dead letters, texts and the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lynxrisk.config import RESOLVED, UNRESOLVED
from lynxrisk.operators.grid import enrich
from lynxrisk.operators.identity import latest_register, resolution_report
from lynxrisk.operators.tagging import tag_groups, tag_text
from lynxrisk.plans import silver as S
from lynxrisk.queries.feeds import CTX, EMOTIONS, KEYWORDS, Feeds
from lynxrisk.queries.registry import query

LINE = ["employee_id", "event_date", "source_domain", "source_file", "record_hash", "pipeline_version",
        "identity_resolution_status"]


def tags(col: str):
    """An array as text; NULL stays NULL, an empty array becomes an empty text."""
    return F.array_join(col, ",").alias(col)


@query(
    "q01_resolve_inner",
    """SELECT employee_id, event_date, 'pacs' AS source_domain, 'pacs_events.csv' AS source_file, record_hash,
              's2_silver_v2' AS pipeline_version, 'RESOLVED' AS identity_resolution_status, door_id, location_name,
              building_code, direction, after_hours AS after_hours_flag, weekend AS weekend_flag
       FROM sv_pacs""",
)
def resolve_inner(f: Feeds) -> DataFrame:
    return f.feed("pacs").ok.select(
        *LINE, "door_id", "location_name", "building_code", "direction", "after_hours_flag", "weekend_flag"
    )


DEAD_SQL = """SELECT source_domain, source_file, raw_identifier, identifier_type, record_hash,
              'UNRESOLVED' AS identity_resolution_status, 's2_silver_v2' AS pipeline_version, raw_record FROM dead"""


@query("q02_dead_letter", DEAD_SQL)
def dead_letter(f: Feeds) -> DataFrame:
    return f.dead.drop("ingested_at")


@query(
    "q03_resolution_rate",
    """WITH t AS (
           SELECT 'pacs' AS d, count(*) AS n FROM pacs UNION ALL SELECT 'network', count(*) FROM network
           UNION ALL SELECT 'dlp', count(*) FROM dlp UNION ALL SELECT 'comms', count(*) FROM comms
           UNION ALL SELECT 'pai', count(*) FROM pai UNION ALL SELECT 'geo', count(*) FROM geo),
       l AS (SELECT source_domain AS d, count(*) AS n FROM dead GROUP BY 1),
       x AS (
           SELECT 'instagram' AS d, count(*) AS n FROM anomalies UNION ALL SELECT 'lifestyle', count(*) FROM sv_lifestyle
           UNION ALL SELECT 'darkweb', count(*) FROM sv_darkweb),
       r AS (
           SELECT t.d, t.n - coalesce(l.n, 0) AS resolved, t.n AS total, 0.9 AS floor FROM t LEFT JOIN l ON t.d = l.d UNION ALL
           SELECT 'osint_' || x.d, x.n, x.n + coalesce(l.n, 0), 0.3 FROM x LEFT JOIN l ON x.d = l.d)
       SELECT d AS source_domain, resolved, total, round(CAST(resolved AS DOUBLE) / total, 4) AS rate,
              CAST(resolved AS DOUBLE) / total >= floor AS passed FROM r""",
)
def resolution_rate(f: Feeds) -> DataFrame:
    registers = {"pacs": f.badges, "geo": f.badges, "network": f.machines, "dlp": f.machines, "comms": f.directory,
                 "pai": f.handles}
    rows = None
    for domain, register in registers.items():
        tagged = S.tag_feed(S.FEEDS[domain], getattr(f, domain), register)
        part = tagged.select(F.lit(domain).alias("source_domain"), "identity_resolution_status")
        rows = part if rows is None else rows.unionByName(part)
    for domain, result in {"instagram": f.anomalies, "lifestyle": f.sv_lifestyle, "darkweb": f.sv_darkweb}.items():
        for table, status in ((result.ok, RESOLVED), (result.dead, UNRESOLVED)):
            rows = rows.unionByName(table.select(F.lit(f"osint_{domain}").alias("source_domain"), F.lit(status).alias("identity_resolution_status")))
    return resolution_report(rows)


@query("q04_latest_register", "SELECT machine_id, employee_id FROM owners")
def latest_owner(f: Feeds) -> DataFrame:
    return latest_register(f.machines, "machine_id", "effective_start")


@query(
    "q05_latest_register_join",
    """SELECT employee_id, event_date, 'network' AS source_domain, 'network_events.csv' AS source_file, record_hash,
              's2_silver_v2' AS pipeline_version, 'RESOLVED' AS identity_resolution_status, machine_id, ip_address,
              event_type, vpn_flag, dns_query_domain, bytes_transferred, session_duration_min,
              after_hours AS after_hours_flag
       FROM sv_network""",
)
def network(f: Feeds) -> DataFrame:
    return f.feed("network").ok.drop("event_timestamp", "ingested_at", "transformed_at")


@query(
    "q05b_dlp_conformed",
    """SELECT employee_id, event_date, 'dlp' AS source_domain, 'dlp_events.csv' AS source_file, record_hash,
              's2_silver_v2' AS pipeline_version, 'RESOLVED' AS identity_resolution_status, machine_id,
              'copy' AS event_type, file_name, file_extension, file_size_mb, 'disk' AS destination_type, usb_flag,
              print_flag, cloud_upload_flag
       FROM sv_dlp""",
)
def dlp(f: Feeds) -> DataFrame:
    return f.feed("dlp").ok.drop("event_timestamp", "ingested_at", "transformed_at")


@query(
    "q05c_comms_conformed",
    """SELECT employee_id, event_date, 'comms' AS source_domain, 'comms_events.csv' AS source_file, record_hash,
              's2_silver_v2' AS pipeline_version, 'RESOLVED' AS identity_resolution_status, channel_type,
              recipient_count, external_recipient_flag, attachment_flag, attachment_size_mb,
              after_hours AS after_hours_flag
       FROM sv_comms""",
)
def comms(f: Feeds) -> DataFrame:
    return f.feed("comms").ok.drop("event_timestamp", "ingested_at", "transformed_at")


@query(
    "q06_null_employee_join",
    """SELECT employee_id, event_date, 'pai' AS source_domain, 'pai_events.csv' AS source_file, record_hash,
              's2_silver_v2' AS pipeline_version, 'RESOLVED' AS identity_resolution_status, platform,
              round(sentiment_score, 9) + 0 AS sentiment_score, post_count, engagement_count
       FROM sv_pai""",
)
def pai(f: Feeds) -> DataFrame:
    rows = f.feed("pai").ok.drop("event_timestamp", "ingested_at", "transformed_at")
    return rows.withColumn("sentiment_score", F.round("sentiment_score", 9))


@query(
    "q06b_geo_conformed",
    """SELECT employee_id, event_date, record_hash, building_code, round(latitude, 9) + 0 AS latitude,
              round(longitude, 9) + 0 AS longitude, 'phone' AS device_type
       FROM sv_geo""",
)
def geo(f: Feeds) -> DataFrame:
    return f.feed("geo").ok.select(
        "employee_id", "event_date", "record_hash", "building_code", F.round("latitude", 9).alias("latitude"),
        F.round("longitude", 9).alias("longitude"), "device_type",
    )


@query(
    "q06c_adjudication_conformed",
    """SELECT employee_id, event_date, record_hash, 'SECRET' AS clearance_level, clearance_status, investigation_flag,
              status_change_flag, identity_resolution_status
       FROM sv_adjudication""",
)
def adjudication(f: Feeds) -> DataFrame:
    return f.sv_adjudication.select(
        "employee_id", "event_date", "record_hash", "clearance_level", "clearance_status", "investigation_flag",
        "status_change_flag", "identity_resolution_status",
    )


@query(
    "q06d_hris_conformed",
    """SELECT employee_id, DATE '2020-01-01' AS event_date, 'hris' AS source_domain, 'hris_events.csv' AS source_file,
              md5(employee_id || '|' || full_name || '|' || coalesce(department, '')) AS record_hash,
              's2_silver_v2' AS pipeline_version, 'RESOLVED' AS identity_resolution_status, full_name, department,
              role_title, role_peer_group, clearance_level, employment_status
       FROM hris""",
)
def hris(f: Feeds) -> DataFrame:
    return f.sv_hris.select(
        *LINE, "full_name", "department", "role_title", "role_peer_group", "clearance_level", "employment_status"
    )


@query(
    "q07_dual_path",
    """SELECT detection_id, event_date, employee_id, 'darkweb' AS source_domain, record_hash, signal_type, severity,
              matched_on
       FROM sv_darkweb""",
)
def dual_path(f: Feeds) -> DataFrame:
    return f.sv_darkweb.ok.select(
        "detection_id", "event_date", "employee_id", "source_domain", "record_hash", "signal_type", "severity",
        "matched_on",
    )


@query(
    "q08_text_concat_tags",
    """WITH c AS (SELECT conv_id, lower(string_agg(text, ' ' ORDER BY turn)) AS t FROM conversations GROUP BY 1)
       SELECT conv_id, concat_ws(',',
                  CASE WHEN contains(t, 'ation') OR contains(t, 'eaux') THEN 'frustration' END,
                  CASE WHEN contains(t, 'the of') THEN 'grievance' END,
                  CASE WHEN contains(t, 'ing') OR contains(t, 'la de') THEN 'distress' END,
                  CASE WHEN contains(t, 'sch') THEN 'hostility' END) AS emotion_tags,
              concat_ws(',', CASE WHEN contains(t, 'tion') THEN 'sensitive_terms' END,
                  CASE WHEN contains(t, 'the and the') OR contains(t, '. la') THEN 'job_seeking' END) AS keyword_flags
       FROM c""",
)
def text_tags(f: Feeds) -> DataFrame:
    rules = {"emotion_tags": EMOTIONS, "keyword_flags": KEYWORDS}
    tagged = tag_groups(f.table("conversations"), ["conv_id"], ["turn"], "text", rules)
    return tagged.select("conv_id", tags("emotion_tags"), tags("keyword_flags"))


@query(
    "q08b_document_tags",
    """SELECT doc_id, concat_ws(',',
                  CASE WHEN text ILIKE '%secret%' OR text ILIKE '%confidential%' THEN 'sensitive_terms' END,
                  CASE WHEN text ILIKE '%money%' OR text ILIKE '%debt%' OR text ILIKE '%bankrupt%'
                       THEN 'financial_stress' END,
                  CASE WHEN text ILIKE '%the of%' THEN 'seam' END) AS keyword_flags
       FROM documents""",
)
def document_tags(f: Feeds) -> DataFrame:
    rules = {"sensitive_terms": ["secret", "confidential"], "financial_stress": ["money", "debt", "bankrupt"], "seam": ["the of"]}
    return tag_text(f.table("documents"), "text", rules, "keyword_flags").select("doc_id", tags("keyword_flags"))


@query(
    "q08c_tag_social",
    """SELECT employee_id, event_date, record_hash, array_to_string(emotion_tags, ',') AS emotion_tags,
              array_to_string(keyword_flags, ',') AS keyword_flags, emotion_tags IS NULL AS untouched
       FROM sv_pai_tagged""",
)
def social(f: Feeds) -> DataFrame:
    return f.sv_pai_tagged.select(
        "employee_id", "event_date", "record_hash", tags("emotion_tags"), tags("keyword_flags"),
        F.col("emotion_tags").isNull().alias("untouched"),
    )


@query(
    "q09_update_enrich",
    """SELECT d.doc_id, lang, source, l.quality, l.toxic, l.doc_id IS NULL AS untouched
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def update_enrich(f: Feeds) -> DataFrame:
    documents = f.table("documents").select("doc_id", "lang", "source")
    enriched = enrich(documents, f.table("labels"), ["doc_id"], ["quality", "toxic"])
    return enriched.withColumn("untouched", F.col("quality").isNull())


@query(
    "q10_location_class",
    """SELECT post_id, event_date, employee_id, record_hash, classified_location_type, anomaly_flag, work_hours_flag,
              incongruity_flag
       FROM anomalies""",
)
def location_class(f: Feeds) -> DataFrame:
    return f.anomalies.ok.select(
        "post_id", "event_date", "employee_id", "record_hash", "classified_location_type", "anomaly_flag",
        "work_hours_flag", "incongruity_flag",
    )


@query(
    "q11_band_incongruity",
    """SELECT signal_id, event_date, employee_id, record_hash, signal_type, estimated_value_usd, salary_band,
              incongruity_score, cumulative_30day_spend
       FROM sv_lifestyle""",
)
def band_incongruity(f: Feeds) -> DataFrame:
    return f.sv_lifestyle.ok.select(
        "signal_id", "event_date", "employee_id", "record_hash", "signal_type", "estimated_value_usd", "salary_band",
        "incongruity_score", "cumulative_30day_spend",
    )


@query(
    "q12_json_stress_running",
    """SELECT record_id, event_date, employee_id, record_hash, record_type, amount_usd, stress_score,
              round(cumulative_stress_score, 9) + 0 AS cumulative_stress_score
       FROM sv_financial""",
)
def stress_running(f: Feeds) -> DataFrame:
    return f.sv_financial.select(
        "record_id", "event_date", "employee_id", "record_hash", "record_type", "amount_usd", "stress_score",
        F.round("cumulative_stress_score", 9).alias("cumulative_stress_score"),
    )


@query(
    "q13_hash_confidence",
    """SELECT detection_id, severity, round(confidence_score, 9) + 0 AS confidence_score FROM sv_darkweb""",
)
def hash_confidence(f: Feeds) -> DataFrame:
    return f.sv_darkweb.ok.select("detection_id", "severity", F.round("confidence_score", 9).alias("confidence_score"))
