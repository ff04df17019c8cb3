from lynxrisk.plans import silver as S
from lynxrisk.sources.tables import read_bronze
from lynxrisk.streaming.ingest import stream_feed
from tests.bronze_files import write_bronze
from tests.conftest import CTX


def test_files_arrive_in_two_parts(spark, tmp_path):
    """Two calls over a growing folder give what one batch over all files gives."""
    bronze, inbox = tmp_path / "bronze", tmp_path / "inbox"
    bronze.mkdir()
    inbox.mkdir()
    write_bronze(str(bronze))
    lines = (bronze / "network_events.csv").read_text().splitlines()
    register = read_bronze(spark, "asset_assignment", str(bronze))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for part, rows in (("a", lines[1:100]), ("b", lines[100:])):
        (inbox / f"{part}.csv").write_text("\n".join([lines[0], *rows]) + "\n")
        query = stream_feed(spark, "network", str(inbox), register, out, checkpoint, CTX)
        query.awaitTermination(120)
    feed = S.FEEDS["network"]
    written = spark.read.parquet(out)
    batch = S.silver_feed("network", read_bronze(spark, "network_events", str(bronze)), register, CTX)
    streamed = S.resolved_part(feed, written)
    assert streamed.count() == batch.ok.count() == len(lines) - 2
    assert streamed.exceptAll(batch.ok).count() == 0
    assert S.dead_part(written).select("raw_record").collect() == batch.dead.select("raw_record").collect()
