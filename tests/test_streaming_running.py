import random

import pytest
from pyspark.sql import functions as F

from lynxrisk.config import Scale
from lynxrisk.operators.ordering import running_sum, sliding
from lynxrisk.streaming import sink
from lynxrisk.streaming.running import running_batches

SCHEMA = "employee_id string, day int, record_id long, amount long"
ORDER = ["day", "record_id"]
OUT = f"{SCHEMA}, total long, mean30 double, n30 long, most30 long"


def frames():
    return {"mean30": F.avg("amount"), "n30": F.count("record_id"), "most30": F.max("amount")}


def rows_of(days, seed=1):
    """A third of the rows and more are one employee's; one employee has no name, one no amounts, one only the first days."""
    rng, out = random.Random(seed), []
    for d in days:
        for n in range(8):
            who = ["hot", "hot", "hot", "B", None, "empty", "C", "early" if d < 10 else "B"][n]
            out.append((who, d, d * 100 + n, None if who == "empty" or rng.random() < 0.1 else rng.randrange(100)))
    rng.shuffle(out)
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def whole(df):
    summed = running_sum(df, "amount", ["employee_id"], ORDER, "total")
    return sliding(summed, frames(), ["employee_id"], ORDER, 29).select("employee_id", *ORDER, "amount", "total", *frames())


def got(spark, folder):
    schema = spark.createDataFrame([], OUT).schema
    return sorted(map(repr, sink.read_batches(spark, f"{folder}/rows", schema).collect()))


@pytest.mark.parametrize("scale", [Scale(), Scale(window_rows=20, chunk_rows=40)])
def test_batches_equal_the_batch_job(spark, tmp_path, scale):
    """Also when a batch is tried twice, is empty, or is tried again after its state was written."""
    write = running_batches(str(tmp_path), ["employee_id"], ORDER, {"total": "amount"}, frames(), 29, scale)
    parts = [rows_of(range(0, 12)), rows_of(range(12, 13)), [], rows_of(range(13, 24))]
    for number, part in enumerate(parts):
        write(table(spark, part), number)
        if number in (0, 3):
            write(table(spark, part), number)
    want = sorted(map(repr, whole(table(spark, [r for part in parts for r in part])).collect()))
    assert got(spark, tmp_path) == want
    assert len(list((tmp_path / "carried").glob("batch_id=*"))) == 2
    state = spark.read.parquet(str(tmp_path / "carried" / "batch_id=3"))
    assert state.groupBy("employee_id").count().agg(F.max("count")).first()[0] <= 29
    assert {r.employee_id for r in state.select("employee_id").distinct().collect()} == {"hot", "B", None, "empty", "C", "early"}


def test_rows_out_of_order_are_kept_apart(spark, tmp_path):
    write = running_batches(str(tmp_path), ["employee_id"], ORDER, {"total": "amount"}, frames(), 29)
    write(table(spark, [("A", 3, 1, 5), ("B", 1, 2, 1)]), 0)
    write(table(spark, [("A", 2, 3, 7), ("A", 3, 1, 5), ("A", 4, 4, 2), ("B", 2, 5, 1)]), 1)  # a late row, and one that was there
    rows = sink.read_batches(spark, f"{tmp_path}/rows", spark.createDataFrame([], OUT).schema)
    assert {(r.employee_id, r.day, r.total) for r in rows.collect()} == {("A", 3, 5), ("B", 1, 1), ("A", 4, 7), ("B", 2, 2)}
    late = sink.read_batches(spark, f"{tmp_path}/late", spark.createDataFrame([], SCHEMA).schema)
    assert {tuple(r) for r in late.collect()} == {("A", 2, 3, 7), ("A", 3, 1, 5)}


def test_a_stream_of_files_and_a_restart(spark, tmp_path):
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    write = running_batches(out, ["employee_id"], ORDER, {"total": "amount"}, frames(), 29)
    every = []
    for n in range(2):
        part = rows_of(range(n * 5, n * 5 + 5))
        table(spark, part).coalesce(1).write.mode("append").parquet(str(inbox))
        every += part
        stream = spark.readStream.schema(SCHEMA).parquet(str(inbox))
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        assert query.awaitTermination(180)
    assert got(spark, out) == sorted(map(repr, whole(table(spark, every)).collect()))
