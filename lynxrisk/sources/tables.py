"""Reading feeds, and reading and writing the tables of the three layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lynxrisk.sources.schemas import BRONZE

CORRUPT = "_corrupt_record"


def read_bronze(spark: SparkSession, name: str, base: str, corrupt: bool = False) -> DataFrame:
    """A feed or register, with its declared schema.

    ``base`` is any folder Spark can read, such as ``s3a://bucket/bronze`` (endpoint and keys
    go into ``spark.hadoop.fs.s3a.*``). A quote inside a quoted value is doubled. Values that do not parse become NULL; with
    ``corrupt`` the original line is kept in a column of its own.
    """
    schema = BRONZE[name] + (f", {CORRUPT} string" if corrupt else "")
    reader = spark.read.schema(schema).options(header=True, mode="PERMISSIVE", escape='"')
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.csv(f"{base}/{name}.csv")


def invalid_lines(df: DataFrame, name: str) -> DataFrame:
    """The lines of a feed (read with ``corrupt=True``) that did not fit its schema."""
    # Spark refuses a plan that reads the original line alone; a length that is never below zero reads all columns
    values = F.concat_ws("", *[F.col(c).cast("string") for c in df.columns if c != CORRUPT])
    return df.filter(F.col(CORRUPT).isNotNull() & (F.length(values) >= 0)).select(
        F.lit(name).alias("source_domain"), F.col(CORRUPT).alias("raw_record")
    )


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full refresh of a table. With partitions, only those in ``df`` are replaced."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_dead_letter(df: DataFrame, path: str) -> None:
    """Replace the dead letters of the domains in ``df``; the other domains stay."""
    write_table(df, path, partition_by=["source_domain"])


@dataclass(frozen=True)
class Lake:
    """Where the layers live. Each run writes its own folder, so a failed run spoils nothing."""

    spark: SparkSession
    base: str
    run_id: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}/run_id={self.run_id}"

    def read(self, layer: str, name: str, cols: list[str] | None = None) -> DataFrame:
        df = self.spark.read.parquet(self.path(layer, name))
        return df.select(*cols) if cols else df

    def write(self, df: DataFrame, layer: str, name: str, partition_by: list[str] | None = None) -> DataFrame:
        write_table(df, self.path(layer, name), partition_by)
        return self.read(layer, name)

    def has(self, layer: str, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(layer, name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def before(self, stage: str) -> Lake | None:
        """The lake of the last other run that ended this stage, by the audit rows; None if there is none."""
        runs = self.spark.read.parquet(self.runs_path).filter((F.col("stage_name") == stage) & (F.col("status") == "success"))
        run = F.substring_index("run_id", "/", 1)
        last = runs.filter(run != self.run_id).agg(F.max_by(run, "completed_at")).first()[0]
        return last and Lake(self.spark, self.base, last)

    @property
    def runs_path(self) -> str:
        return f"{self.base}/bronze/pipeline_runs"
