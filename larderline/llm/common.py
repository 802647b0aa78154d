"""Helpers shared by the operators: source tables, stored intermediate tables, Arrow batches, sequence numbers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one on a local master only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="larderline-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


#: Whether Spark removes the shuffle files of a query when it ends, and not first when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so lost executors cost no recomputation.

    The shuffle files of the write go with its end: the disk holds those of one step at a time.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def release_caches() -> None:
    """Drop what an operator that this worker served before has left. (Called by name: the worker's module holds it.)"""
    _WORKER_CACHES.clear()


_SHIPPED: set[str] = set()
_WORKER_CACHES: dict[object, object] = {}


def worker_cache(key: object, make: Callable[[], object]) -> object:
    """The cache of a Python worker, kept over tasks; a worker holds one at a time."""
    if key not in _WORKER_CACHES:
        _WORKER_CACHES.clear()
        _WORKER_CACHES[key] = make()
    return _WORKER_CACHES[key]


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that their workers can import it from anywhere."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="larderline-code-"), "larderline-code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def arrow_map(df: DataFrame, schema: str | StructType, rows: Callable[[pa.RecordBatch], dict[str, object]], start: Callable | None = None) -> DataFrame:
    """``mapInArrow`` with a function from a batch to columns (arrays or lists by name).

    ``start``, if given, is called once per task and returns the function.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_code(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not start:
            release_caches()
        make = start() if start else rows
        for batch in batches:
            if not batch.num_rows:
                continue
            out = make(batch)
            yield pa.RecordBatch.from_arrays(
                [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], type=f.type) for f in target],
                schema=target,
            )

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Whole texts of a batch, null as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def numbered(df: DataFrame, group: list[str], spread: list[str], order: list[str], name: str, per_part: int = 10_000) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in parts so that a hot group is never sorted in one task.

    ``spread`` columns deal a group's rows to parts by hash; ``order`` fixes the place within a part. The parts grow
    in number with the table. Rows equal in all these columns are interchangeable. Returns ``df`` with ``name`` (long).
    """
    parts = max(1, df.count() // per_part)
    part = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(parts)) if parts > 1 else F.lit(0).cast("long")
    dealt = df.withColumn("__part", part)
    sizes = dealt.groupBy(*group, "__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__base", F.coalesce(F.sum("__size").over(before), F.lit(0)))
    inside = Window.partitionBy(*group, "__part").orderBy(*order)
    placed = dealt.withColumn("__place", F.row_number().over(inside) - 1)
    on = [placed[c].eqNullSafe(sizes[c]) for c in [*group, "__part"]]
    joined = placed.join(sizes, on, "inner")
    return joined.select(*[placed[c] for c in df.columns], (F.col("__base") + F.col("__place")).alias(name))
