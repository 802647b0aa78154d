"""Writing marts and check logs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Whether Spark removes the shuffle files of a query when it ends, and not first when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Partition values to which a task writes at once; it sorts the rows of further ones.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
MOST_WRITERS = 16


@contextmanager
def held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session for a while."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write_mart(df: DataFrame, path: str, partition_by: str | None = None, together: bool = False, in_place: bool = False) -> DataFrame:
    """A mart as Parquet under a new ``path``; returns the written table. A path in use is an error.

    A partitioned mart is rebalanced on its partition column first: few files
    per partition value, while a value holding much of the data is split over
    several tasks by adaptive execution. ``together`` says that this was done
    already, on narrower rows. ``in_place`` moves no row: each task writes a file
    for each value it holds, for large tables of few values. Keys are hex
    digests: an entropy code halves them. The shuffle files go when the mart is written.
    """
    spark = df.sparkSession
    with held(spark, {CLEANUP: "true", **({WRITERS: str(MOST_WRITERS)} if in_place else {})}):
        if partition_by is None:
            df.write.parquet(path, compression="zstd")
        else:
            rows = df if together or in_place else df.hint("rebalance", F.col(partition_by))
            rows.write.partitionBy(partition_by).parquet(path, compression="zstd")
    return spark.read.parquet(path)


def write_stamped(df: DataFrame, path: str, created_at: str) -> DataFrame:
    """A result table (forecasts, metadata, recommendations) with the time of its making, under a new path; read back."""
    stamped = df.withColumn("created_at", F.lit(created_at).cast("timestamp_ntz"))
    stamped.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_check_log(results: DataFrame, path: str, run_at: str) -> DataFrame:
    """One JSON line per check result, under a run-stamped folder, each with the run's passed and failed totals.

    Returns the log as read back.
    """
    all_checks = Window.partitionBy()  # one row per declared check
    logged = results.withColumns(
        {
            "run_at": F.lit(run_at),
            "passed_total": F.count_if("passed").over(all_checks),
            "failed_total": F.count_if(~F.col("passed")).over(all_checks),
        }
    )
    logged.write.json(path)
    return results.sparkSession.read.schema(logged.schema).json(path)
