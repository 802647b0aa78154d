"""A stored version table (type 2) that is updated in place of being rebuilt.

The table is partitioned by a hash of its key. A batch of changes rewrites only the partitions that hold a key with a
change not known before, or a key that vanished from the source; the files of all others stay. Running a batch again
finds nothing new and writes nothing, so a run that died is simply repeated.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larderline.operators.price_versions import close_missing, close_versions, merge_versions

PART = "__part"


class VersionStore:
    """Versions under ``path``, one open or closed row per key and change time.

    ``parts`` is fixed when the table is made; choose it so that a part is a few files of usual size.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, changed_at: str, parts: int = 64) -> None:
        self.spark, self.path, self.key, self.changed_at, self.parts = spark, path, key, changed_at, parts
        self._schema: StructType | None = None

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def _write(self, versions: DataFrame) -> None:
        """Overwrite the parts that ``versions`` holds, and no others; a large part is written by several tasks."""
        placed = versions.withColumn(PART, self._part())
        self._schema = placed.schema
        writer = placed.hint("rebalance", F.col(PART)).write.mode("overwrite").partitionBy(PART)
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def _stored(self, parts: list[int] | None = None) -> DataFrame:
        if self._schema is None:
            self._schema = self.spark.read.parquet(self.path).schema
        rows = self.spark.read.schema(self._schema).parquet(self.path)
        return rows if parts is None else rows.filter(F.col(PART).isin(parts))

    def _parts_of(self, rows: DataFrame) -> list[int]:
        """Parts that hold the keys of ``rows``: at most ``parts`` numbers."""
        return sorted(r[PART] for r in rows.select(self._part().alias(PART)).distinct().collect())

    def versions(self) -> DataFrame:
        return self._stored().drop(PART)

    def create(self, changes: DataFrame) -> None:
        self._write(close_versions(changes, self.key, self.changed_at))

    def apply(self, changes: DataFrame | None = None, source_keys: DataFrame | None = None, as_of: date | None = None) -> list[int]:
        """Fold in ``changes``, then end the open versions of keys that ``source_keys`` lacks; returns the parts rewritten.

        Late changes split the version they fall into; rows already known, and rows without a key or a time, change
        nothing.
        """
        touched: set[int] = set()
        if changes is not None:
            changes = changes.filter(F.col(self.key).isNotNull() & F.col(self.changed_at).isNotNull())
            near = self._stored(self._parts_of(changes))
            known = near.select(F.col(self.key).alias("_key"), F.col("valid_from").alias("_known"))
            on = (F.col(self.key) == F.col("_key")) & (F.col(self.changed_at) == F.col("_known"))
            touched.update(self._parts_of(changes.join(known, on, "left_anti")))
        if source_keys is not None:
            if as_of is None:
                raise ValueError("ending vanished keys needs as_of, the day on which their versions end")
            keys = self._stored().filter(F.col("valid_to").isNull()).select(self.key)
            touched.update(self._parts_of(keys.join(source_keys.select(self.key), self.key, "left_anti")))
            if changes is not None:
                touched.update(self._parts_of(changes.join(source_keys.select(self.key), self.key, "left_anti")))
        if not touched:
            return []
        parts = sorted(touched)
        made = self._stored(parts).drop(PART)
        if changes is not None:
            made = merge_versions(made, changes.filter(self._part().isin(parts)), self.key, self.changed_at)
        if source_keys is not None:
            made = close_missing(made, source_keys, self.key, as_of)
        self._write(made.select(*[f.name for f in self._schema if f.name != PART]))
        return parts
