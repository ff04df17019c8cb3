"""Declared schemas of all feeds, registers and tables."""

# --- bronze: CSV files with a header, UTF-8, UTC timestamps ------------------

BRONZE = {
    "hris_events": "employee_id string, full_name string, department string, role_title string, "
    "role_peer_group string, clearance_level string, employment_status string, start_date date, end_date date",
    "pacs_events": "badge_id string, event_timestamp timestamp, building_code string, door_id string, "
    "location_name string, direction string, after_hours boolean, weekend boolean",
    "network_events": "machine_id string, ip_address string, event_timestamp timestamp, event_type string, "
    "vpn_flag boolean, dns_query_domain string, bytes_transferred bigint, session_duration_min double, "
    "after_hours boolean",
    "dlp_events": "machine_id string, user_account string, event_timestamp timestamp, event_type string, "
    "file_name string, file_extension string, file_size_mb double, destination_type string, usb_flag boolean, "
    "print_flag boolean, cloud_upload_flag boolean",
    "adjudication_events": "employee_id string, event_timestamp timestamp, clearance_level string, "
    "clearance_status string, investigation_flag boolean, reinvestigation_due_date date, "
    "status_change_flag boolean",
    "comms_events": "email_address string, slack_handle string, event_timestamp timestamp, channel_type string, "
    "recipient_count int, external_recipient_flag boolean, attachment_flag boolean, attachment_size_mb double, "
    "after_hours boolean",
    "pai_events": "social_handle string, event_timestamp timestamp, platform string, sentiment_score double, "
    "post_count int, engagement_count int",
    "geo_events": "badge_id string, device_id string, event_timestamp timestamp, building_code string, "
    "latitude double, longitude double, device_type string",
    "badge_registry": "badge_id string, employee_id string, issued_date date",
    "asset_assignment": "machine_id string, employee_id string, effective_start date, effective_end date",
    "directory": "email_address string, slack_handle string, employee_id string",
    "social_handle_map": "social_handle string, employee_id string, platform string",
    "raw_tweets": "tweet_id string, scraped_datetime timestamp, handle string, tweet_text string, "
    "retweet_flag boolean, like_count int, raw_json string",
    "raw_instagram_posts": "post_id string, scraped_datetime timestamp, handle string, post_caption string, "
    "location_string string, location_lat double, location_lon double, post_type string, raw_json string",
    "raw_lifestyle_signals": "signal_id string, scraped_datetime timestamp, handle string, signal_source string, "
    "raw_text string, estimated_value_usd int, raw_json string",
    "raw_financial_stress": "record_id string, scraped_datetime timestamp, employee_id string, source string, "
    "raw_text string, raw_json string",
    "raw_darkweb_signals": "detection_id string, scraped_datetime timestamp, handle string, signal_source string, "
    "raw_text string, matched_on string, raw_json string",
}

# --- declared keys (not enforced by Spark; checked by the quality report) ----

KEYS = {
    "hris_events": ["employee_id"],
    "badge_registry": ["badge_id"],
    "asset_assignment": ["machine_id", "effective_start"],
    "directory": ["email_address"],
    "social_handle_map": ["social_handle"],
    "raw_tweets": ["tweet_id"],
    "raw_instagram_posts": ["post_id"],
    "raw_lifestyle_signals": ["signal_id"],
    "raw_financial_stress": ["record_id"],
    "raw_darkweb_signals": ["detection_id"],
    "employee_risk_features": ["employee_id", "window_end_date"],
    "gold_twitter_risk": ["employee_id", "week_start_date"],
    "gold_location_risk": ["employee_id", "week_start_date"],
    "gold_lifestyle_risk": ["employee_id", "week_start_date"],
    "gold_financial_stress_risk": ["employee_id", "week_start_date"],
    "gold_darkweb_risk": ["employee_id", "week_start_date"],
    "gold_composite_risk": ["employee_id", "week_start_date"],
    "pipeline_runs": ["run_id"],
}

PIPELINE_RUNS = (
    "run_id string, stage_name string, started_at timestamp, completed_at timestamp, status string, "
    "rows_in bigint, rows_out bigint, duration_seconds double, artifacts array<string>, notes string"
)

DEAD_LETTERS = (
    "source_domain string, source_file string, raw_identifier string, identifier_type string, record_hash string, "
    "identity_resolution_status string, ingested_at timestamp, pipeline_version string, raw_record string"
)
