"""Metrics kept between runs: each run adds the buckets that it measured, and replaces those from its first day on.

The table is append-only. A run writes one folder, ``run=<number>/since=<first day>``; a row counts unless a later run
began at or before its bucket. So late rows are taken in by measuring again from an earlier day, a run that died is
repeated under its number, and no file of another run is touched.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.operators.anomaly import fill_gaps, score

SCHEMA = "model string, column_name string, metric string, sensitivity double, step_days int, bucket date, units bigint"


class MetricHistory:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def record(self, run: int, since: date, measured: DataFrame) -> None:
        """Store what run ``run`` measured (rows of ``bucket_metrics``) in buckets from ``since`` on."""
        rows = measured.filter(F.col("bucket") >= F.lit(since.isoformat()).cast("date")).select(
            *[F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in SCHEMA.split(", ")]
        )
        # A row without a model marks the run, also one that found no bucket.
        mark = self.spark.createDataFrame([(None,) * 7], SCHEMA)
        rows.unionByName(mark).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={run}/since={since.isoformat()}")

    def runs(self) -> list[tuple[int, date]]:
        """(run, since) of the stored runs, one each."""
        marks = self._stored().filter(F.col("model").isNull()).select("run", "since").distinct()
        return sorted((r.run, r.since) for r in marks.collect())

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(f"{SCHEMA}, run int, since date").parquet(self.path)

    def metrics(self) -> DataFrame:
        """The rows that count, as if all had been measured at once."""
        until, ends = None, {}
        for run, since in reversed(self.runs()):
            if until is not None:
                ends[run] = until
            until = since if until is None else min(until, since)
        rows = self._stored().filter(F.col("model").isNotNull())
        for run, end in ends.items():
            rows = rows.filter((F.col("run") != run) | (F.col("bucket") < F.lit(end.isoformat()).cast("date")))
        return rows.drop("run", "since")

    def scored(self) -> DataFrame:
        """Every stored bucket against those before it, of whatever run."""
        return score(fill_gaps(self.metrics()))
