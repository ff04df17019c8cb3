"""A small set of bronze CSV files: 12 people, 21 days, one of them with unusual behaviour."""

import csv
import datetime as dt
import json
import os

PEOPLE = 12
DAYS = 21
START = dt.datetime(2026, 1, 1)
TITLES = ["Senior Analyst", "Team Lead", "Clerk", "Engineer"]


def employee(i):
    return f"EMP_{i:05d}"


def write(folder, name, header, rows):
    with open(os.path.join(folder, f"{name}.csv"), "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header.split())
        writer.writerows(rows)


def stamp(d, hour, minute=0):
    return (START + dt.timedelta(days=d, hours=hour, minutes=minute)).strftime("%Y-%m-%dT%H:%M:%S.000Z")


def write_bronze(folder: str) -> None:
    ids = range(1, PEOPLE + 1)
    odd = 1  # works at night, copies to USB, posts angrily
    write(folder, "hris_events",
          "employee_id full_name department role_title role_peer_group clearance_level employment_status start_date end_date",
          [[employee(i), f"Person {i}", "OPS", TITLES[i % 4], f"OPS_L{i % 2 + 1}", "SECRET", "active", "2020-05-01", ""]
           for i in ids])
    write(folder, "badge_registry", "badge_id employee_id issued_date",
          [[f"BADGE_{i:05d}", employee(i), "2020-05-01"] for i in ids])
    write(folder, "asset_assignment", "machine_id employee_id effective_start effective_end",
          [[f"MACH_{i:05d}", employee(i), "2025-06-01", ""] for i in ids]
          + [["MACH_00002", employee(3), "2024-01-01", "2025-05-31"]])
    write(folder, "directory", "email_address slack_handle employee_id",
          [[f"emp_{i:05d}@corp.internal", f"@slack{i}", employee(i)] for i in ids])
    write(folder, "social_handle_map", "social_handle employee_id platform",
          [[f"@h{i}", employee(i), "x"] for i in ids] + [["@ghost", "", "x"]])
    pacs, net, dlp, comms, pai, geo, adj = [], [], [], [], [], [], []
    for d in range(DAYS):
        for i in ids:
            late = i == odd and d > 10
            hour = 22 if late else 9
            for n in range(2 + (i + d) % 3 + (4 if late else 0)):
                pacs.append([f"BADGE_{i:05d}", stamp(d, hour, n), "B1", "D1", "HQ", "in", str(late).lower(), "false"])
            for n in range(1 + (i * d) % 3):
                net.append([f"MACH_{i:05d}", f"10.0.0.{i}", stamp(d, hour, n), "session", str(late).lower(), "a.b", 100 * n, 5.5,
                            str(late).lower()])
            for n in range(1 + (i + d) % 2 + (5 if late else 0)):
                dlp.append([f"MACH_{i:05d}", f"user{i}", stamp(d, hour, n), "copy", "f", "pdf", 1.5, "disk",
                            str(late).lower(), "false", "false"])
            for n in range(3 + (i + 2 * d) % 4):
                comms.append([f"emp_{i:05d}@corp.internal", f"@slack{i}", stamp(d, 10, n), "email", 2,
                              str(n == 0 and i % 3 == 0).lower(), "false", 0.0, "false"])
            pai.append([f"@h{i}", stamp(d, 12), "x", -0.8 if late else 0.1 * ((i + d) % 5), 1, 3])
            geo.append([f"BADGE_{i:05d}", f"DEV{i}", stamp(d, 9), "B1", 38.9, -77.0, "phone"])
            if late and d % 4 == 0:
                geo.append([f"BADGE_{i:05d}", f"DEV{i}", stamp(d, 15), "B1", 34.0, -118.2, "phone"])
            if d == 3:
                adj.append([employee(i), stamp(d, 8), "SECRET", "active", str(i == odd).lower(), "2027-01-01", "false"])
    pacs.append(["BADGE_99999", stamp(1, 9), "B1", "D1", "HQ", "in", "false", "false"])
    net.append(["MACH_99999", "10.9.9.9", stamp(1, 9), "session", "false", "a.b", 1, 1.0, "false"])
    pai.append(["@ghost", stamp(2, 12), "x", 0.5, 1, 1])
    write(folder, "pacs_events", "badge_id event_timestamp building_code door_id location_name direction after_hours weekend", pacs)
    write(folder, "network_events", "machine_id ip_address event_timestamp event_type vpn_flag dns_query_domain "
          "bytes_transferred session_duration_min after_hours", net)
    write(folder, "dlp_events", "machine_id user_account event_timestamp event_type file_name file_extension file_size_mb "
          "destination_type usb_flag print_flag cloud_upload_flag", dlp)
    write(folder, "comms_events", "email_address slack_handle event_timestamp channel_type recipient_count "
          "external_recipient_flag attachment_flag attachment_size_mb after_hours", comms)
    write(folder, "pai_events", "social_handle event_timestamp platform sentiment_score post_count engagement_count", pai)
    write(folder, "geo_events", "badge_id device_id event_timestamp building_code latitude longitude device_type", geo)
    write(folder, "adjudication_events", "employee_id event_timestamp clearance_level clearance_status investigation_flag "
          "reinvestigation_due_date status_change_flag", adj)
    write(folder, "raw_tweets", "tweet_id scraped_datetime handle tweet_text retweet_flag like_count raw_json",
          [[f"TWE_{i}_{d}_{n}", stamp(d, 10 + n), f"@h{i}", text, "false", 1, "{}"]
           for i in (1, 2) for d in (11, 12, 13)
           for n, text in enumerate(["so ANGRY, they are unfair", "I am looking for", "work now"] if i == 1 else ["nice day"])])
    write(folder, "raw_instagram_posts", "post_id scraped_datetime handle post_caption location_string location_lat "
          "location_lon post_type raw_json",
          [["IGP_1", stamp(12, 14), "@h1", "", "Fort Worth", "", "", "photo", "{}"],
           ["IGP_2", stamp(12, 20), "@h1", "", "Casino Royale", 40.0, -77.0, "photo", "{}"],
           ["IGP_3", stamp(5, 8), "@h2", "", "home", 38.9, -77.0, "check_in", "{}"],
           ["IGP_4", stamp(5, 8), "@ghost", "", "home", "", "", "photo", "{}"]])
    write(folder, "raw_lifestyle_signals", "signal_id scraped_datetime handle signal_source raw_text estimated_value_usd raw_json",
          [[f"LSG_{i}_{d}", stamp(d, 9), f"@h{i}", "shop", "x", 2500, "{}"] for i in (1, 2, 4) for d in (10, 12)]
          + [["LSG_g", stamp(4, 9), "@ghost", "shop", "x", 1, "{}"]])
    write(folder, "raw_financial_stress", "record_id scraped_datetime employee_id source raw_text raw_json",
          [[f"FSR_{n}", stamp(10 + n, 9), employee(1), "court", "x", json.dumps(j)]
           for n, j in enumerate([{"type": "lien", "amount": 900}, {"type": "eviction_notice"}, {"amount": "n/a"}])])
    write(folder, "raw_darkweb_signals", "detection_id scraped_datetime handle signal_source raw_text matched_on raw_json",
          [["DWS_1", stamp(12, 9), "emp_00001@corp.internal", "dump", "x", "email", '{"type": "cred", "severity": "high"}'],
           ["DWS_2", stamp(13, 9), "@h1", "dump", "x", "social_handle", "{}"],
           ["DWS_3", stamp(13, 9), "p1@company.com", "dump", "x", "email", "{}"],
           ["DWS_4", stamp(13, 9), "", "dump", "x", "social_handle", "{}"]])
