import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from lynxrisk.operators.rolling import Frame, rolling_features
from lynxrisk.plans import silver as S
from lynxrisk.sources.tables import read_bronze
from lynxrisk.streaming import sink
from lynxrisk.streaming.ingest import stream_feed_batches
from lynxrisk.streaming.state import hopping_totals, late_rows, unique_records
from tests.bronze_files import write_bronze
from tests.conftest import CTX, day

RECORD = "record_hash string, employee_id string, event_timestamp timestamp, n int"


class Inbox:
    """Files of records that arrive one after the other, each a batch of its own."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        (folder / "inbox").mkdir()

    def arrive(self, rows):
        lines = [json.dumps({"record_hash": h, "employee_id": e, "event_timestamp": t.isoformat() + "Z", "n": n}) for h, e, t, n in rows]
        file = self.folder / "inbox" / f"{self.files:03}.json"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + self.files,) * 2)  # files are taken in the order of their times
        self.files += 1

    @property
    def stream(self):
        return self.spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).json(str(self.folder / "inbox"))

    def run(self, stream):
        query = sink.write_batches(stream, str(self.folder / "out"), str(self.folder / "checkpoint"))
        assert query.awaitTermination(180)
        return query

    def result(self, stream):
        return sink.read_batches(self.spark, str(self.folder / "out"), stream.schema)


def at(d, hour=0):
    return dt.datetime.combine(day(d), dt.time(hour))


def test_repeats_in_other_batches_late_rows_and_a_restart(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    unique = unique_records(inbox.stream, "3 days")
    inbox.arrive([("a", "A", at(1), 1), ("a", "A", at(1), 2), ("b", "A", at(2), 3)])
    inbox.arrive([("b", "A", at(2), 4), ("c", "B", at(3), 5)])  # a repeat in another batch
    inbox.run(unique)
    inbox.arrive([("c", "B", at(3, 5), 6), ("d", "B", at(10), 7)])  # after a restart; then the watermark moves to day 7
    inbox.run(unique)
    inbox.arrive([("e", "B", at(2), 8), ("f", "B", at(9), 9), ("d", "B", at(10), 10)])  # e is too late
    query = inbox.run(unique)
    got = [(r.record_hash, r.n) for r in inbox.result(unique).orderBy("record_hash", "n").collect()]
    assert [h for h, _ in got] == ["a", "b", "c", "d", "f"] and dict(got)["d"] == 7 and dict(got)["b"] in (3, 4)
    assert late_rows(query) == 1


def test_hopping_windows_equal_the_batch(spark, tmp_path):
    inbox = Inbox(spark, tmp_path)
    frames = {"total": Frame("n"), "most": Frame("n", how="max"), "rows": Frame("n", how="count")}
    stream = hopping_totals(inbox.stream, frames, "2 days")
    rows = [(f"{e}{d}{i}", e, at(d, (5 * i) % 24), d + i) for d in range(15) for e in ("A", "B") for i in range((d * (1 if e == "A" else 3)) % 4)]
    inbox.arrive(rows[:15])
    inbox.run(stream)
    inbox.arrive(rows[15:])
    inbox.arrive([("between", "Z", at(14), 1)])  # a watermark counts for late rows one batch after it has closed windows
    inbox.arrive([("late", "A", at(1), 100)])  # behind the watermark: in none of the open windows
    inbox.arrive([("end", "Z", at(60), 1)])  # closes all windows of the days before
    inbox.arrive([("end2", "Z", at(61), 1)])
    query = inbox.run(stream)
    got = inbox.result(stream).filter("employee_id <> 'Z'")
    table = spark.createDataFrame(rows, RECORD)
    daily = table.groupBy("employee_id", F.to_date("event_timestamp").alias("event_date")).agg(
        F.sum("n").alias("sum_n"), F.max("n").alias("max_n"), F.count("n").alias("count_n")
    )
    ends = F.sequence(F.lit(day(0)), F.lit(day(21)), F.expr("INTERVAL 1 DAY"))
    batch_frames = {"total": Frame("sum_n"), "most": Frame("max_n", how="max"), "rows": Frame("count_n")}
    want = rolling_features(daily, "employee_id", "event_date", batch_frames, ends, "count_n").select(got.columns)
    assert got.count() > 30
    assert got.exceptAll(want).collect() == [] and want.exceptAll(got).collect() == []
    assert late_rows(query) > 0


def test_a_frame_must_be_the_window(spark):
    with pytest.raises(ValueError, match="whole window"):
        hopping_totals(spark.createDataFrame([], RECORD), {"x": Frame("n", first=-2)}, None)


def test_a_batch_run_again_replaces_and_broken_writes_are_not_read(spark, tmp_path):
    write = sink.batch_writer(str(tmp_path / "out"), ["part"])
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "id int, part string")
    read = lambda: sorted(r.id for r in sink.read_batches(spark, str(tmp_path / "out"), rows.schema).collect())
    assert read() == []
    write(rows, 0)
    write(rows, 0)
    write(rows.filter("id = 2"), 1)
    assert read() == [1, 2, 2]
    write(rows.limit(0), 1)
    assert read() == [1, 2]
    (tmp_path / "out" / "batch_id=0" / "_SUCCESS").unlink()
    assert read() == []


def test_a_failed_batch_leaves_the_tables_equal(spark, tmp_path):
    """Malformed lines, dead letters and resolved rows; the second batch is written, fails before its commit, and runs again."""
    bronze, inbox = tmp_path / "bronze", tmp_path / "inbox"
    bronze.mkdir()
    inbox.mkdir()
    write_bronze(str(bronze))
    header, *lines = (bronze / "network_events.csv").read_text().splitlines()
    broken = ["MACH_00001,not,a,good,line", "only one value"]
    for name, part in (("a", lines[:100] + broken[:1]), ("b", lines[100:] + broken[1:])):
        (inbox / f"{name}.csv").write_text("\n".join([header, *part]) + "\n")
    (bronze / "network_events.csv").write_text("\n".join([header, *lines, *broken]) + "\n")
    register = read_bronze(spark, "asset_assignment", str(bronze))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    run = lambda: stream_feed_batches(spark, "network", str(inbox), register, out, checkpoint, CTX, 1).awaitTermination(180)
    run()
    feed = S.FEEDS["network"]
    whole = S.conform_all(feed, S.tag_feed(feed, read_bronze(spark, "network_events", str(bronze), corrupt=True), register), CTX)

    def check():
        got = sink.read_batches(spark, out, whole.schema)
        assert got.count() == len(lines) + 2
        assert got.exceptAll(whole).count() == 0 and whole.exceptAll(got).count() == 0
        dead = S.dead_part(got).filter("identity_resolution_status = 'INVALID'").collect()
        assert sorted(r.raw_record for r in dead) == sorted(broken)
        assert all(r.source_domain == "network" and r.raw_identifier is None and r.record_hash for r in dead)
        return got

    check()
    last = max((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    for crc in (tmp_path / "checkpoint" / "commits").glob(f".{last.name}.crc"):
        crc.unlink()
    run()
    check()
    assert {r.source_domain: r.n for r in S.dead_part(check()).groupBy("source_domain").agg(F.count("*").alias("n")).collect()}["network"] >= 2
