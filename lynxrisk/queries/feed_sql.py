"""The feeds, registers and steps of the checks in SQL, as named WITH clauses."""

from __future__ import annotations

import re

FEED_SQL = {
    # --- events, people, registers --------------------------------------------
    "ev": """
        SELECT event_id, ts AS event_timestamp, CAST(ts AS DATE) AS day, user_id, event_type, value,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "ends": """
        SELECT CAST(unnest(generate_series(min(day) + 6, max(day), INTERVAL 1 DAY)) AS DATE) AS window_end_date
        FROM ev""",
    "hris": """
        SELECT 'EMP_' || c_custkey AS employee_id, c_name AS full_name, n_name AS department,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'Senior Engineer' WHEN 'BUILDING' THEN 'Team Lead'
                    WHEN 'AUTOMOBILE' THEN 'Analyst' WHEN 'FURNITURE' THEN 'Deputy VP' ELSE 'Clerk' END AS role_title,
               c_mktsegment AS role_peer_group, r_name AS clearance_level,
               CASE WHEN c_acctbal >= 0 THEN 'active' ELSE 'inactive' END AS employment_status
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "badges": """
        SELECT 'BADGE_' || c_custkey AS badge_id, 'EMP_' || c_custkey AS employee_id
        FROM customer WHERE c_acctbal >= 0""",
    "machines": """
        SELECT 'MACH_' || l_suppkey AS machine_id, 'EMP_' || o_custkey AS employee_id,
               CAST(l_shipdate AS DATE) AS effective_start
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "owners": """
        SELECT machine_id, employee_id FROM (
            SELECT machine_id, employee_id, row_number() OVER (
                PARTITION BY machine_id ORDER BY effective_start DESC NULLS LAST, employee_id DESC) AS rn
            FROM machines) WHERE rn = 1""",
    "directory": """
        SELECT 'user' || c_custkey || '@corp.internal' AS email_address, 'EMP_' || c_custkey AS employee_id
        FROM customer""",
    "handles": """
        SELECT '@u' || c_custkey AS social_handle,
               CASE WHEN c_acctbal >= 0 THEN 'EMP_' || c_custkey END AS employee_id
        FROM customer""",
    # --- internal feeds ---------------------------------------------------------
    "pacs": """
        SELECT 'BADGE_' || user_id AS badge_id, event_timestamp, day AS event_date, 'B' || (k % 10) AS building_code,
               CASE WHEN k >= 10 THEN 'D' || k END AS door_id, 'Site ' || (k % 4) AS location_name,
               CASE WHEN k % 2 = 0 THEN 'in' ELSE 'out' END AS direction,
               hour(event_timestamp) < 8 OR hour(event_timestamp) >= 18 AS after_hours,
               dayofweek(event_timestamp) IN (0, 6) AS weekend,
               strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS ts_text
        FROM ev WHERE event_type = 'click'""",
    "network": """
        SELECT 'MACH_' || user_id AS machine_id, '10.0.0.' || k AS ip_address, day AS event_date,
               CASE WHEN k % 2 = 0 THEN 'dns' ELSE 'session' END AS event_type, k < 30 AS vpn_flag,
               CASE WHEN k % 2 = 0 THEN 'host' || k END AS dns_query_domain, event_id * 10 AS bytes_transferred,
               value AS session_duration_min,
               hour(event_timestamp) < 8 OR hour(event_timestamp) >= 18 AS after_hours,
               strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS ts_text
        FROM ev WHERE event_type = 'view'""",
    "dlp": """
        SELECT 'MACH_' || user_id AS machine_id, 'user' || user_id AS user_account, day AS event_date,
               'f' || event_id AS file_name, CASE WHEN k % 2 = 0 THEN 'pdf' ELSE 'csv' END AS file_extension,
               value AS file_size_mb, k < 20 AS usb_flag, k >= 20 AND k < 30 AS print_flag,
               k >= 80 AS cloud_upload_flag, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS ts_text
        FROM ev WHERE event_type = 'purchase'""",
    "comms": """
        SELECT 'user' || user_id || '@corp.internal' AS email_address, day AS event_date,
               CASE WHEN k % 2 = 0 THEN 'email' ELSE 'slack' END AS channel_type, k % 7 + 1 AS recipient_count,
               k % 5 = 0 AS external_recipient_flag, k % 3 = 0 AS attachment_flag, value AS attachment_size_mb,
               hour(event_timestamp) < 8 OR hour(event_timestamp) >= 18 AS after_hours,
               strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS ts_text
        FROM ev WHERE event_type = 'signup'""",
    "pai": """
        SELECT '@u' || user_id AS social_handle, day AS event_date, 'x' AS platform,
               CAST(k - 50 AS DOUBLE) / CAST(50 AS DOUBLE) AS sentiment_score, k % 5 AS post_count,
               k AS engagement_count, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS ts_text
        FROM ev WHERE event_type = 'error'""",
    "geo": """
        SELECT 'BADGE_' || user_id AS badge_id, 'DEV_' || event_type AS device_id, day AS event_date,
               'B' || (k % 10) AS building_code,
               CASE WHEN k <> 50 THEN (k % 10) * CAST(0.45 AS DOUBLE) + CAST(38 AS DOUBLE) END AS latitude,
               (event_id % 13) * CAST(0.4 AS DOUBLE) - CAST(77 AS DOUBLE) AS longitude,
               strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS ts_text
        FROM ev""",
    "sv_adjudication": """
        SELECT 'EMP_' || user_id AS employee_id, day AS event_date,
               CASE WHEN k > 97 THEN 'suspended' ELSE 'active' END AS clearance_status,
               k > 95 AS investigation_flag, k = 90 AS status_change_flag,
               'RESOLVED' AS identity_resolution_status,
               md5('EMP_' || user_id || '|' || strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') || '|'
                   || CASE WHEN k > 97 THEN 'suspended' ELSE 'active' END) AS record_hash
        FROM ev WHERE event_type = 'error'""",
    # --- external feeds -----------------------------------------------------------
    "tweets": """
        SELECT 'TWE_' || conv_id || '_' || turn AS tweet_id, '@u' || conv_id AS handle, text AS tweet_text,
               TIMESTAMP '2024-01-01 08:00:00' + to_days(CAST(conv_id % 30 AS INTEGER)) + to_minutes(turn)
                   AS scraped_datetime
        FROM conversations""",
    "posts": """
        SELECT 'IGP_' || page_id AS post_id, '@u' || page_id AS handle, url AS location_string,
               TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(page_id % 30 AS INTEGER)) + to_hours(page_id % 24)
                   AS scraped_datetime,
               CASE WHEN page_id % 5 <> 0 THEN (page_id % 17) * CAST(0.1 AS DOUBLE) + CAST(38 AS DOUBLE) END AS lat,
               (page_id % 11) * CAST(0.1 AS DOUBLE) - CAST(77.6 AS DOUBLE) AS lon,
               CASE WHEN page_id % 3 = 0 THEN 'check_in' ELSE 'photo' END AS post_type
        FROM pages""",
    "lifestyle": """
        SELECT 'LSG_' || o_orderkey AS signal_id, '@u' || o_custkey AS handle, o_orderpriority AS signal_source,
               DATE '2024-01-01' + CAST((CAST(o_orderdate AS DATE) - DATE '1995-01-01') % 30 AS INTEGER) AS event_date,
               CAST(floor(o_totalprice) AS INTEGER) AS value_usd
        FROM orders""",
    "sv_financial_base": """
        SELECT 'FSR_' || event_id AS record_id, 'EMP_' || user_id AS employee_id, day AS event_date,
               CASE k % 6 WHEN 0 THEN 'bankruptcy_filing' WHEN 1 THEN 'lien' WHEN 2 THEN 'eviction_notice'
                    WHEN 3 THEN 'civil_judgment' WHEN 4 THEN 'tax_notice' ELSE 'court' END AS record_type,
               CASE WHEN k % 7 <> 0 THEN k * 10 ELSE 0 END AS amount_usd,
               CAST(CASE k % 6 WHEN 0 THEN 1.0 WHEN 1 THEN 0.7 WHEN 2 THEN 0.6 WHEN 3 THEN 0.5 ELSE 0.3 END
                    AS DOUBLE) AS stress_score
        FROM ev WHERE event_type = 'purchase'""",
    "darkweb": """
        SELECT 'DWS_' || event_id AS detection_id, day AS event_date,
               CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'email' ELSE 'social_handle' END AS matched_on,
               CASE WHEN k <> 13 THEN CASE WHEN event_type IN ('click', 'view', 'signup')
                    THEN 'user' || user_id || CASE WHEN value < 100 THEN '@corp.internal' ELSE '@company.com' END
                    ELSE '@u' || user_id END END AS handle,
               event_type AS signal_type,
               CASE WHEN k < 20 THEN 'high' WHEN k < 50 THEN 'medium' ELSE 'low' END AS severity,
               strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS ts_text
        FROM ev""",
    # --- silver -------------------------------------------------------------------
    "sv_pacs": """
        SELECT b.employee_id, p.*, md5(p.badge_id || '|' || ts_text || '|' || coalesce(door_id, '')) AS record_hash
        FROM pacs p JOIN badges b ON p.badge_id = b.badge_id""",
    "sv_network": """
        SELECT o.employee_id, n.*, md5(n.machine_id || '|' || ip_address || '|' || ts_text) AS record_hash
        FROM network n JOIN owners o ON n.machine_id = o.machine_id""",
    "sv_dlp": """
        SELECT o.employee_id, d.*, md5(d.machine_id || '|' || user_account || '|' || ts_text) AS record_hash
        FROM dlp d JOIN owners o ON d.machine_id = o.machine_id""",
    "sv_comms": """
        SELECT r.employee_id, c.*, md5(c.email_address || '|' || ts_text || '|' || channel_type) AS record_hash
        FROM comms c JOIN directory r ON c.email_address = r.email_address""",
    "sv_pai": """
        SELECT h.employee_id, p.*, md5(p.social_handle || '|' || ts_text) AS record_hash
        FROM pai p JOIN handles h ON p.social_handle = h.social_handle AND h.employee_id IS NOT NULL""",
    "sv_geo": """
        SELECT b.employee_id, g.*, md5(g.badge_id || '|' || device_id || '|' || ts_text) AS record_hash
        FROM geo g JOIN badges b ON g.badge_id = b.badge_id""",
    "tweet_days": """
        SELECT h.employee_id, CAST(scraped_datetime AS DATE) AS event_date,
               lower(string_agg(tweet_text, ' ' ORDER BY scraped_datetime, tweet_id)) AS t
        FROM tweets w JOIN handles h ON w.handle = h.social_handle AND h.employee_id IS NOT NULL GROUP BY 1, 2""",
    "tweet_tags": """
        SELECT employee_id, event_date, list_filter([
                   CASE WHEN contains(t, 'ation') OR contains(t, 'eaux') THEN 'frustration' END,
                   CASE WHEN contains(t, 'the of') THEN 'grievance' END,
                   CASE WHEN contains(t, 'ing') OR contains(t, 'la de') THEN 'distress' END,
                   CASE WHEN contains(t, 'sch') THEN 'hostility' END], lambda x: x IS NOT NULL) AS emotion_tags,
               list_filter([
                   CASE WHEN contains(t, 'tion') THEN 'sensitive_terms' END,
                   CASE WHEN contains(t, 'the and the') OR contains(t, '. la') THEN 'job_seeking' END],
                   lambda x: x IS NOT NULL) AS keyword_flags
        FROM tweet_days""",
    "sv_pai_tagged": """
        SELECT s.*, t.emotion_tags, t.keyword_flags
        FROM sv_pai s LEFT JOIN tweet_tags t ON s.employee_id = t.employee_id AND s.event_date = t.event_date""",
    "post_facts": """
        SELECT p.*, h.employee_id, lower(location_string) AS place,
               lat IS NOT NULL AND (lat < 38.5 OR lat > 39.1 OR lon < -77.5 OR lon > -76.8) AS away
        FROM posts p LEFT JOIN handles h ON p.handle = h.social_handle AND h.employee_id IS NOT NULL""",
    "anomalies": """
        SELECT post_id, CAST(scraped_datetime AS DATE) AS event_date, employee_id,
               md5(post_id || '|' || handle) AS record_hash,
               CASE WHEN contains(place, 'blog.') OR contains(place, 'spam-farm') THEN 'sensitive_government'
                    WHEN contains(place, '.net/') OR contains(place, '.html') THEN 'travel_hub'
                    WHEN away THEN 'unusual_travel' WHEN post_type = 'check_in' THEN 'standard_checkin'
                    ELSE 'standard' END AS classified_location_type,
               contains(place, 'blog.') OR contains(place, 'spam-farm') OR away AS anomaly_flag,
               hour(scraped_datetime) BETWEEN 9 AND 17 AS work_hours_flag,
               contains(place, 'utm_source') OR contains(place, '#top') AS incongruity_flag
        FROM post_facts WHERE employee_id IS NOT NULL""",
    "sv_lifestyle_base": """
        SELECT l.signal_id, l.event_date, h.employee_id, l.signal_source AS signal_type,
               md5(signal_id || '|' || h.employee_id) AS record_hash, value_usd AS estimated_value_usd,
               CASE WHEN role_title ILIKE '%senior%' OR role_title ILIKE '% vp%' THEN 'senior'
                    WHEN role_title ILIKE '%lead%' OR role_title ILIKE '%analyst%' THEN 'mid' ELSE 'low' END AS salary_band
        FROM lifestyle l JOIN handles h ON l.handle = h.social_handle AND h.employee_id IS NOT NULL
        LEFT JOIN hris r ON h.employee_id = r.employee_id""",
    "sv_lifestyle": """
        SELECT *, round(estimated_value_usd / CAST(CASE salary_band WHEN 'senior' THEN 5000 WHEN 'mid' THEN 2000
                        ELSE 1000 END AS DOUBLE), 4) AS incongruity_score,
               CAST(sum(estimated_value_usd) OVER (PARTITION BY employee_id ORDER BY event_date, signal_id
                        ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_30day_spend
        FROM sv_lifestyle_base""",
    "sv_financial": """
        SELECT *, md5(record_id || '|' || employee_id) AS record_hash,
               sum(stress_score) OVER (PARTITION BY employee_id ORDER BY event_date, record_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_stress_score
        FROM sv_financial_base""",
    "darkweb_matched": """
        SELECT d.*, coalesce(r.employee_id, h.employee_id) AS employee_id
        FROM darkweb d
        LEFT JOIN directory r ON d.matched_on = 'email' AND d.handle = r.email_address
        LEFT JOIN handles h ON d.matched_on = 'social_handle' AND d.handle = h.social_handle""",
    "sv_darkweb": """
        SELECT *, md5(detection_id || '|' || handle) AS record_hash,
               CAST(CASE severity WHEN 'high' THEN 0.75 WHEN 'medium' THEN 0.45 ELSE 0.15 END AS DOUBLE)
                 + (CAST('0x' || substr(md5(detection_id), 1, 8) AS BIGINT)
                    % CASE severity WHEN 'high' THEN 20 WHEN 'medium' THEN 30 ELSE 25 END) / CAST(100 AS DOUBLE)
                 AS confidence_score
        FROM darkweb_matched WHERE employee_id IS NOT NULL""",
    # --- dead letters -------------------------------------------------------------
    "dead": """
        SELECT 'pacs' AS source_domain, 'pacs_events.csv' AS source_file, p.badge_id AS raw_identifier,
               'badge_id' AS identifier_type, md5(p.badge_id || '|' || ts_text) AS record_hash,
               p.badge_id || '|' || ts_text || '|' || coalesce(building_code, '') AS raw_record
        FROM pacs p WHERE NOT EXISTS (SELECT 1 FROM badges b WHERE b.badge_id = p.badge_id)
        UNION ALL
        SELECT 'network', 'network_events.csv', machine_id, 'machine_id', md5(machine_id || '|' || ts_text),
               machine_id || '|' || ip_address || '|' || ts_text
        FROM network n WHERE NOT EXISTS (SELECT 1 FROM owners o WHERE o.machine_id = n.machine_id)
        UNION ALL
        SELECT 'dlp', 'dlp_events.csv', machine_id, 'machine_id', md5(machine_id || '|' || ts_text),
               machine_id || '|' || user_account || '|' || ts_text
        FROM dlp d WHERE NOT EXISTS (SELECT 1 FROM owners o WHERE o.machine_id = d.machine_id)
        UNION ALL
        SELECT 'comms', 'comms_events.csv', email_address, 'email_address', md5(email_address || '|' || ts_text),
               email_address || '|' || channel_type || '|' || ts_text
        FROM comms c WHERE NOT EXISTS (SELECT 1 FROM directory r WHERE r.email_address = c.email_address)
        UNION ALL
        SELECT 'pai', 'pai_events.csv', social_handle, 'social_handle', md5(social_handle || '|' || ts_text),
               social_handle || '|' || platform || '|' || ts_text
        FROM pai p WHERE NOT EXISTS
            (SELECT 1 FROM handles h WHERE h.social_handle = p.social_handle AND h.employee_id IS NOT NULL)
        UNION ALL
        SELECT 'geo', 'geo_events.csv', g.badge_id, 'badge_id', md5(g.badge_id || '|' || ts_text),
               g.badge_id || '|' || device_id || '|' || ts_text
        FROM geo g WHERE NOT EXISTS (SELECT 1 FROM badges b WHERE b.badge_id = g.badge_id)
        UNION ALL
        SELECT 'instagram', 'raw_instagram_posts.csv', handle, 'social_handle', md5(post_id || '|' || handle),
               post_id || '|' || handle || '|' || strftime(scraped_datetime, '%Y-%m-%d %H:%M:%S')
        FROM post_facts WHERE employee_id IS NULL
        UNION ALL
        SELECT 'lifestyle', 'raw_lifestyle_signals.csv', handle, 'social_handle', md5(signal_id || '|' || handle),
               signal_id || '|' || handle || '|' || strftime(event_date, '%Y-%m-%d %H:%M:%S')
        FROM lifestyle l WHERE NOT EXISTS
            (SELECT 1 FROM handles h WHERE h.social_handle = l.handle AND h.employee_id IS NOT NULL)
        UNION ALL
        SELECT 'darkweb', 'raw_darkweb_signals.csv', coalesce(handle, ''), matched_on,
               md5(detection_id || '|' || coalesce(handle, '')),
               detection_id || '|' || coalesce(handle, '') || '|' || ts_text
        FROM darkweb_matched WHERE employee_id IS NULL""",
    # --- features: windows by a range join ----------------------------------------------
    "w_pacs": """
        SELECT employee_id, window_end_date, count(*) AS swipes, count(*) FILTER (after_hours) AS late
        FROM sv_pacs JOIN ends ON event_date BETWEEN window_end_date - 6 AND window_end_date GROUP BY 1, 2""",
    "f_pacs": """
        WITH w AS (SELECT w.*, role_peer_group AS g, CAST(late AS DOUBLE) / swipes AS share
                   FROM w_pacs w LEFT JOIN hris USING (employee_id)),
             s AS (SELECT window_end_date, g, avg(swipes) AS m, stddev_samp(swipes) AS sd, avg(share) AS ms
                   FROM w GROUP BY 1, 2)
        SELECT employee_id, w.window_end_date, coalesce((swipes - m) / nullif(sd, 0), 0) AS badge_swipes_outlier,
               share - ms AS after_hours_pacs_score
        FROM w JOIN s ON w.window_end_date = s.window_end_date AND w.g = s.g""",
    "f_network": """
        WITH w AS (SELECT employee_id, window_end_date, role_peer_group AS g,
                          count(*) FILTER (vpn_flag) AS vpn, CAST(count(*) FILTER (after_hours) AS DOUBLE) / count(*) AS share
                   FROM sv_network JOIN ends ON event_date BETWEEN window_end_date - 6 AND window_end_date
                   LEFT JOIN hris USING (employee_id) GROUP BY 1, 2, 3),
             s AS (SELECT window_end_date, g, avg(vpn) AS m, stddev_samp(vpn) AS sd, avg(share) AS ms FROM w GROUP BY 1, 2)
        SELECT employee_id, w.window_end_date, share - ms AS after_hours_network_score,
               coalesce((vpn - m) / nullif(sd, 0), 0) AS vpn_anomaly_score
        FROM w JOIN s ON w.window_end_date = s.window_end_date AND w.g = s.g""",
    "f_dlp": """
        WITH w AS (SELECT employee_id, window_end_date, role_peer_group AS g, count(*) AS moves,
                          count(*) FILTER (usb_flag) AS usb, count(*) FILTER (cloud_upload_flag) AS up
                   FROM sv_dlp JOIN ends ON event_date BETWEEN window_end_date - 6 AND window_end_date
                   LEFT JOIN hris USING (employee_id) GROUP BY 1, 2, 3),
             s AS (SELECT window_end_date, g, avg(moves) AS m1, stddev_samp(moves) AS s1, avg(usb) AS m2,
                          stddev_samp(usb) AS s2, avg(up) AS m3, stddev_samp(up) AS s3 FROM w GROUP BY 1, 2)
        SELECT employee_id, w.window_end_date, coalesce((usb - m2) / nullif(s2, 0), 0) AS usb_exfiltration_score,
               coalesce((moves - m1) / nullif(s1, 0), 0) AS file_movement_outlier,
               coalesce((up - m3) / nullif(s3, 0), 0) AS cloud_upload_outlier
        FROM w JOIN s ON w.window_end_date = s.window_end_date AND w.g = s.g""",
    "f_comms": """
        WITH now AS (SELECT employee_id, window_end_date, count(*) AS n,
                            count(*) FILTER (external_recipient_flag) AS x
                     FROM sv_comms JOIN ends ON event_date BETWEEN window_end_date - 6 AND window_end_date GROUP BY 1, 2),
             old AS (SELECT employee_id, window_end_date, count(*) AS n
                     FROM sv_comms JOIN ends ON event_date BETWEEN window_end_date - 13 AND window_end_date - 7 GROUP BY 1, 2)
        SELECT now.employee_id, now.window_end_date,
               CAST(now.n - coalesce(old.n, now.n) AS DOUBLE) / coalesce(old.n, 1) AS comms_volume_delta,
               CAST(x AS DOUBLE) / now.n AS external_comms_ratio
        FROM now LEFT JOIN old ON now.employee_id = old.employee_id AND now.window_end_date = old.window_end_date""",
    "f_pai": """
        WITH now AS (SELECT employee_id, window_end_date, avg(sentiment_score) AS a
                     FROM sv_pai JOIN ends ON event_date BETWEEN window_end_date - 6 AND window_end_date GROUP BY 1, 2),
             base AS (SELECT employee_id, window_end_date, avg(sentiment_score) AS a
                      FROM sv_pai JOIN ends ON event_date BETWEEN window_end_date - 30 AND window_end_date GROUP BY 1, 2)
        SELECT now.employee_id, now.window_end_date, now.a - base.a AS sentiment_trend
        FROM now JOIN base ON now.employee_id = base.employee_id AND now.window_end_date = base.window_end_date""",
    "geo_days": """
        WITH p AS (SELECT employee_id, event_date, latitude, longitude, row_number() OVER () AS i FROM sv_geo)
        SELECT a.employee_id, a.event_date, coalesce(max(2 * 6371 * asin(sqrt(
                   pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude))
                   * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2)))) > 500, FALSE)
                   AS impossible
        FROM p a LEFT JOIN p b ON a.employee_id = b.employee_id AND a.event_date = b.event_date AND a.i < b.i
             AND a.latitude IS NOT NULL AND b.latitude IS NOT NULL
        GROUP BY 1, 2""",
    "f_geo": """
        SELECT employee_id, window_end_date, bool_or(impossible) AS impossible_travel_flag
        FROM geo_days JOIN ends ON event_date BETWEEN window_end_date - 6 AND window_end_date GROUP BY 1, 2""",
    "f_adjudication": """
        SELECT employee_id, window_end_date, bool_or(investigation_flag OR status_change_flag) AS clearance_anomaly_flag
        FROM sv_adjudication JOIN ends ON event_date BETWEEN window_end_date - 6 AND window_end_date GROUP BY 1, 2""",
    "grid": """
        SELECT h.employee_id, e.window_end_date, e.window_end_date - 6 AS window_start_date,
               coalesce(badge_swipes_outlier, 0) AS badge_swipes_outlier,
               coalesce(after_hours_pacs_score, 0) AS after_hours_pacs_score,
               coalesce(after_hours_network_score, 0) AS after_hours_network_score,
               coalesce(usb_exfiltration_score, 0) AS usb_exfiltration_score,
               coalesce(file_movement_outlier, 0) AS file_movement_outlier,
               coalesce(cloud_upload_outlier, 0) AS cloud_upload_outlier,
               coalesce(vpn_anomaly_score, 0) AS vpn_anomaly_score,
               coalesce(comms_volume_delta, 0) AS comms_volume_delta,
               coalesce(external_comms_ratio, 0) AS external_comms_ratio,
               coalesce(sentiment_trend, 0) AS sentiment_trend,
               coalesce(impossible_travel_flag, FALSE) AS impossible_travel_flag,
               coalesce(clearance_anomaly_flag, FALSE) AS clearance_anomaly_flag
        FROM hris h CROSS JOIN ends e
        LEFT JOIN f_pacs USING (employee_id, window_end_date)
        LEFT JOIN f_network USING (employee_id, window_end_date)
        LEFT JOIN f_dlp USING (employee_id, window_end_date)
        LEFT JOIN f_comms USING (employee_id, window_end_date)
        LEFT JOIN f_pai USING (employee_id, window_end_date)
        LEFT JOIN f_geo USING (employee_id, window_end_date)
        LEFT JOIN f_adjudication USING (employee_id, window_end_date)""",
    "counted": """
        SELECT *, (abs(round(badge_swipes_outlier, 9)) > 1.5)::INT + (abs(round(after_hours_pacs_score, 9)) > 1.5)::INT
                + (abs(round(after_hours_network_score, 9)) > 1.5)::INT + (abs(round(usb_exfiltration_score, 9)) > 1.5)::INT
                + (abs(round(file_movement_outlier, 9)) > 1.5)::INT + (abs(round(cloud_upload_outlier, 9)) > 1.5)::INT
                + (abs(round(vpn_anomaly_score, 9)) > 1.5)::INT + (abs(round(comms_volume_delta, 9)) > 1.5)::INT
                + (abs(round(external_comms_ratio, 9)) > 1.5)::INT + (abs(round(sentiment_trend, 9)) > 1.5)::INT
                + impossible_travel_flag::INT + clearance_anomaly_flag::INT AS cross_domain_anomaly_count
        FROM grid""",
}

_VECTOR = [
    "badge_swipes_outlier", "after_hours_pacs_score", "after_hours_network_score", "usb_exfiltration_score",
    "file_movement_outlier", "vpn_anomaly_score", "comms_volume_delta", "sentiment_trend",
    "cross_domain_anomaly_count",
]
_BOUNDS = ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.01) AS lo{i}, quantile_cont(CAST({c} AS DOUBLE), 0.99) AS hi{i}"
    for i, c in enumerate(_VECTOR)
)
_UNITS = ", ".join(
    f"coalesce((greatest(lo{i}, least(hi{i}, CAST({c} AS DOUBLE))) - lo{i}) / nullif(hi{i} - lo{i}, 0), 0)"
    for i, c in enumerate(_VECTOR)
)
_MEANS = ", ".join(f"avg(feature_vector[{i + 1}])" for i in range(len(_VECTOR)))

FEED_SQL |= {
    "vectors": f"""
        SELECT c.*, [{_UNITS}] AS feature_vector FROM counted c, (SELECT {_BOUNDS} FROM counted) b""",
    "centroids": f"""
        SELECT rank_id AS cluster_id, [{_MEANS}] AS centroid
        FROM vectors JOIN hris USING (employee_id)
        JOIN (SELECT g, row_number() OVER (ORDER BY g) - 1 AS rank_id
              FROM (SELECT DISTINCT role_peer_group AS g FROM hris)) r ON role_peer_group = g
        GROUP BY rank_id""",
    "scored": """
        WITH d AS (SELECT v.employee_id, v.window_end_date, c.cluster_id,
                          round(list_sum(list_transform(list_zip(feature_vector, centroid),
                                lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 12) AS sq
                   FROM vectors v, centroids c),
             b AS (SELECT *, row_number() OVER (PARTITION BY employee_id, window_end_date ORDER BY sq, cluster_id) AS rn
                   FROM d)
        SELECT v.*, CAST(b.cluster_id AS INTEGER) AS cluster_id, round(sqrt(b.sq), 9) AS anomaly_score
        FROM vectors v JOIN b ON v.employee_id = b.employee_id AND v.window_end_date = b.window_end_date AND b.rn = 1""",
    "gold": """
        SELECT *, CASE WHEN p > 95 THEN 'HIGH' WHEN p > 75 THEN 'MEDIUM' ELSE 'LOW' END AS anomaly_tier,
               p AS anomaly_percentile
        FROM (SELECT *, round((rank() OVER (ORDER BY anomaly_score)
                    + (count(*) OVER (PARTITION BY anomaly_score) - 1) / CAST(2 AS DOUBLE))
                    / count(*) OVER () * 100, 9) AS p FROM scored)""",
    # --- weekly streams -------------------------------------------------------------------
    "wk_twitter": """
        WITH w AS (SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start_date, employee_id,
                          avg(sentiment_score) AS a FROM sv_pai_tagged GROUP BY 1, 2),
             r AS (SELECT *, avg(a) OVER (PARTITION BY employee_id ORDER BY week_start_date
                          ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS base FROM w),
             x AS (SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start_date, employee_id,
                          unnest(emotion_tags) AS emotion FROM sv_pai_tagged WHERE emotion_tags IS NOT NULL),
             n AS (SELECT week_start_date, employee_id, emotion, count(*) AS n FROM x GROUP BY 1, 2, 3),
             t AS (SELECT *, row_number() OVER (PARTITION BY week_start_date, employee_id ORDER BY n DESC, emotion) AS rn
                   FROM n)
        SELECT r.week_start_date, r.employee_id,
               CASE WHEN round(a - base, 9) < -0.25 THEN 'declining_sharply' WHEN round(a - base, 9) < -0.08 THEN 'declining'
                    WHEN round(a - base, 9) > 0.08 THEN 'improving' ELSE 'stable' END AS sentiment_trend,
               greatest(0, least(1, (base - a + 1) / 2)) AS sentiment_risk_score, emotion AS primary_emotion, a, base
        FROM r LEFT JOIN t ON r.week_start_date = t.week_start_date AND r.employee_id = t.employee_id AND t.rn = 1""",
    "wk_location": """
        SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start_date, employee_id,
               count(*) FILTER (anomaly_flag) AS sensitive_location_count,
               count(*) FILTER (work_hours_flag) AS work_hours_absence_count,
               CAST(least(1.0, count(*) FILTER (anomaly_flag) * 0.15 + count(*) FILTER (incongruity_flag) * 0.10)
                    AS DOUBLE) AS location_risk_score,
               'Anomaly locations=' || count(*) FILTER (anomaly_flag) || ' incongruent='
                   || count(*) FILTER (incongruity_flag) AS risk_narrative
        FROM anomalies GROUP BY 1, 2""",
    "wk_lifestyle": """
        SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start_date, employee_id,
               count(*) AS incongruity_event_count, max(cumulative_30day_spend) AS cumulative_30day_spend,
               max(incongruity_score) AS max_incongruity_score,
               least(1, round(count(*) * CAST(0.05 AS DOUBLE) + max(incongruity_score) * CAST(0.30 AS DOUBLE), 10))
                   AS lifestyle_risk_score,
               'Events=' || count(*) || ' max_incongruity=' || CAST(round(CAST(CAST(max(incongruity_score) AS VARCHAR) AS DECIMAL(18, 6)), 3) AS VARCHAR)
                   || ' 30d_spend=$' || max(cumulative_30day_spend) AS risk_narrative
        FROM sv_lifestyle GROUP BY 1, 2""",
    "wk_financial": """
        SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start_date, employee_id,
               count(*) AS active_record_count, max(cumulative_stress_score) AS cumulative_stress_score,
               least(1, round(count(*) * CAST(0.10 AS DOUBLE) + max(cumulative_stress_score) * CAST(0.15 AS DOUBLE), 10))
                   AS financial_risk_score
        FROM sv_financial GROUP BY 1, 2""",
    "wk_darkweb": """
        SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start_date, employee_id,
               count(*) AS detection_count,
               CAST(max(CASE severity WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.5 ELSE 0.2 END) AS DOUBLE) AS max_severity,
               CAST(least(1.0, count(*) * 0.15 + max(CASE severity WHEN 'high' THEN 0.60 WHEN 'medium' THEN 0.30
                    ELSE 0.10 END)) AS DOUBLE) AS darkweb_risk_score,
               'Detections=' || count(*) || ' max_severity=' || max(severity) AS risk_narrative
        FROM sv_darkweb GROUP BY 1, 2""",
    "wk_internal": """
        SELECT window_end_date - 6 AS week_start_date, employee_id,
               avg(anomaly_percentile / 100) AS internal_behavioral_risk_score FROM gold GROUP BY 1, 2""",
    "fused": """
        SELECT week_start_date, employee_id,
               coalesce(t.sentiment_risk_score, 0) AS twitter_risk_score,
               coalesce(l.location_risk_score, 0) AS location_risk_score,
               coalesce(s.lifestyle_risk_score, 0) AS lifestyle_risk_score,
               coalesce(f.financial_risk_score, 0) AS financial_risk_score,
               coalesce(d.darkweb_risk_score, 0) AS darkweb_risk_score,
               coalesce(i.internal_behavioral_risk_score, 0) AS internal_behavioral_risk_score
        FROM wk_internal i FULL OUTER JOIN wk_twitter t USING (week_start_date, employee_id)
        FULL OUTER JOIN wk_location l USING (week_start_date, employee_id)
        FULL OUTER JOIN wk_lifestyle s USING (week_start_date, employee_id)
        FULL OUTER JOIN wk_financial f USING (week_start_date, employee_id)
        FULL OUTER JOIN wk_darkweb d USING (week_start_date, employee_id)""",
    "composite": """
        WITH x AS (SELECT *, CAST(round(CAST(internal_behavioral_risk_score * CAST(0.25 AS DOUBLE)
                          + financial_risk_score * CAST(0.18 AS DOUBLE) + twitter_risk_score * CAST(0.15 AS DOUBLE)
                          + lifestyle_risk_score * CAST(0.15 AS DOUBLE) + darkweb_risk_score * CAST(0.15 AS DOUBLE)
                          + location_risk_score * CAST(0.12 AS DOUBLE) AS DECIMAL(18, 10)), 4) AS DOUBLE) AS composite_risk_score,
                          greatest(internal_behavioral_risk_score, financial_risk_score, twitter_risk_score,
                                   lifestyle_risk_score, darkweb_risk_score, location_risk_score) AS top
                   FROM fused)
        SELECT *, CASE WHEN composite_risk_score >= 0.75 THEN 'CRITICAL' WHEN composite_risk_score >= 0.50 THEN 'HIGH'
                       WHEN composite_risk_score >= 0.25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
               CASE WHEN composite_risk_score >= 0.75 THEN 'ESCALATE' WHEN composite_risk_score >= 0.50 THEN 'INVESTIGATE'
                    WHEN composite_risk_score >= 0.25 THEN 'MONITOR' ELSE 'ROUTINE' END AS recommended_action,
               CASE WHEN internal_behavioral_risk_score = top THEN 'internal_behavioral'
                    WHEN financial_risk_score = top THEN 'financial_stress' WHEN darkweb_risk_score = top THEN 'dark_web'
                    WHEN lifestyle_risk_score = top THEN 'lifestyle' WHEN twitter_risk_score = top THEN 'twitter_sentiment'
                    ELSE 'location' END AS primary_signal_driver
        FROM x""",
}


def _needed(sql: str, found: dict[str, None]) -> None:
    """Clauses named after FROM or JOIN, and the ones those need, before them."""
    for match in re.finditer(r"(?:FROM|JOIN|,)\s+(\w+)", sql):
        clause = match.group(1)
        if clause in FEED_SQL and clause not in found:
            _needed(FEED_SQL[clause], found)
            found[clause] = None


def with_feeds(sql: str) -> str:
    """Put the WITH clauses that a query names in front of it."""
    found: dict[str, None] = {}
    _needed(sql, found)
    if not found:
        return sql.strip()
    clauses = ",\n".join(f"{name} AS ({FEED_SQL[name]})" for name in found)
    own = re.match(r"\s*WITH\s", sql)
    rest = ",\n" + sql[own.end():].strip() if own else "\n" + sql.strip()
    return f"WITH {clauses}{rest}"
