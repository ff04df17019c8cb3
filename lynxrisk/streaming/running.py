"""Running sums and frames of rows that go on from batch to batch of a stream.

Each batch is computed by the operators of the batch job (``operators.ordering``), so a hot key is cut there too. What it has to know of the
batches before is a table of each key's last rows, the newest with its totals; it is written with the batch and read by the next.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lynxrisk.config import Scale
from lynxrisk.operators.ordering import row_index, running_sum, sliding
from lynxrisk.sources.session import scratch, settle
from lynxrisk.streaming.sink import batch_writer

_OLD, _BACK, _INDEX, _ROWS, _LAST = "_old", "_back", "_row_index", "_row_count", "_last_order"


def running_batches(
    out: str,
    keys: Sequence[str],
    order: Sequence[str],
    totals: Mapping[str, str],
    frames: Mapping[str, Column],
    preceding: int,
    scale: Scale = Scale(),
) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch``.

    ``totals`` names the running sum of each value column, ``frames`` aggregates over a row and the ``preceding`` rows before it. ``order`` must be total. The
    rows go to ``out/rows``, read by ``sink.read_batches``. A row that doesn't come after its key's last row of the batches before (out of order, or there
    already) changes no sum and goes to ``out/late``; within a batch any order is right. A batch that is tried again replaces its
    first try. State (``out/carried``) is ``preceding`` rows for each key, one at least; tables older than a retry can need are deleted.
    """
    after, late, carried = (batch_writer(f"{out}/{part}") for part in ("rows", "late", "carried"))

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with scratch(spark):
            rows, before = settle(batch), _carried(spark, f"{out}/carried", number)
            if before is None:
                late(rows.limit(0), number)
                both = rows.withColumns({_OLD: F.lit(False), _BACK: F.lit(None).cast("long")})
                both = both.withColumns({f"_in_{name}": F.col(value) for name, value in totals.items()})
            else:
                newest = before.filter(F.col(_BACK) == 0).select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.struct(*order).alias(_LAST))
                on = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
                held = rows.join(newest, on, "left").withColumn("_late", F.coalesce(F.struct(*order) <= F.col(_LAST), F.lit(False)))
                late(held.filter("_late").select(*rows.columns), number)
                old = before.withColumn(_OLD, F.lit(True))
                fresh = held.filter("NOT _late").select(*rows.columns, F.lit(False).alias(_OLD))
                both = old.unionByName(fresh, allowMissingColumns=True)
                # the newest row stands for all that its key had; the other old rows serve the frames only
                entered = lambda name, value: F.when(~F.col(_OLD), F.col(value)).when(F.col(_BACK) == 0, F.col(name))
                both = both.withColumns({f"_in_{name}": entered(name, value) for name, value in totals.items()})
            for name in totals:
                both = running_sum(both.drop(name), f"_in_{name}", keys, order, name, scale)
            both = settle(sliding(both, dict(frames), keys, order, preceding, scale))
            after(both.filter(f"NOT {_OLD}").select(*rows.columns, *totals, *frames), number)
            carried(_last_rows(both, keys, order, max(preceding, 1)).select(*rows.columns, *totals, _BACK), number)
        _forget(spark, f"{out}/carried", number)

    return write


def _last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], most: int) -> DataFrame:
    """Each key's last rows, with the number of rows after each."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_ROWS)).select(*[F.col(k).alias(f"_of_{k}") for k in keys], _ROWS)
    numbered = row_index(df, keys, order, _INDEX).join(counts, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return numbered.withColumn(_BACK, F.col(_ROWS) - F.col(_INDEX)).filter(F.col(_BACK) < most)


def _written(spark: SparkSession, folder: str, marks: str) -> tuple[object, dict[int, object]]:
    """The file system, and the folders of batches by number."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/batch_id=*{marks}")
    files = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    paths = [f.getPath() for f in files.globStatus(pattern) or []]
    paths = [p.getParent() if marks else p for p in paths]
    return files, {int(p.getName().split("=")[1]): p for p in paths}


def _carried(spark: SparkSession, folder: str, number: int) -> DataFrame | None:
    """The state after the last batch before this one."""
    finished = {n: path for n, path in _written(spark, folder, "/_SUCCESS")[1].items() if n < number}
    return spark.read.parquet(finished[max(finished)].toString()) if finished else None


def _forget(spark: SparkSession, folder: str, number: int) -> None:
    """Delete states that no batch reads again: a retry of this one reads that of the one before."""
    files, found = _written(spark, folder, "")
    for n in sorted(n for n in found if n < number)[:-1]:
        files.delete(found[n], True)
