"""Write, check, publish: readers see a run's tables only after its checks have passed.

A run writes under its own folder. Each table is checked as soon as it is written, on the written files; the first
failing check ends the run. Only a run without failures is entered in the list of published runs, one small file each,
and readers follow the last entry. Nothing is overwritten, so a failed run, or one that died, leaves the old version as
it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What gates a table: a function from its name and written rows to (column_name, test, failures, passed).
Gate = Callable[[str, DataFrame], DataFrame]


class Publication:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def run_folder(self, run: str) -> str:
        return f"{self.folder}/runs/{run}"

    def current(self) -> str | None:
        """The published run, None before the first."""
        entries = f"{self.folder}/published"
        try:
            listed = self.spark.read.schema("place bigint, run string").json(entries)
            last = listed.orderBy(F.desc("place"), F.desc("run")).first()
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None
        return last.run if last else None

    def table(self, name: str) -> DataFrame:
        run = self.current()
        if run is None:
            raise LookupError("nothing has been published yet")
        return self.spark.read.parquet(f"{self.run_folder(run)}/{name}")

    def publish(self, run: str, written: Iterable[tuple[str, DataFrame]], gate: Gate) -> list:
        """Check the tables of ``run`` as ``written`` yields them; publish if none fails. Returns the failing tests."""
        failures = []
        for name, rows in written:
            # One row for each declared test.
            failures = gate(name, rows).filter(~F.col("passed")).collect()
            if failures:
                break
        if not failures:
            place = self.spark.createDataFrame([(self._next(), run)], "place bigint, run string")
            place.coalesce(1).write.mode("append").json(f"{self.folder}/published")
        return failures

    def _next(self) -> int:
        if self.current() is None:
            return 1
        return self.spark.read.schema("place bigint").json(f"{self.folder}/published").agg(F.max("place")).first()[0] + 1
