"""The seven raw feeds: reading them from Parquet and counting what arrived."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.sources.schemas import RAW_SCHEMAS


class RawTables:
    """One DataFrame per raw feed, as attributes; each is planned when first read.

    ``arranged`` holds feeds that are cheaper to put together while they are made than afterwards: a function by name,
    from the column whose equal values come together.
    """

    stores: DataFrame
    suppliers: DataFrame
    products: DataFrame
    product_price_history: DataFrame
    inventory_snapshots: DataFrame
    pos_sales: DataFrame
    purchase_orders: DataFrame

    def __init__(self, arranged: dict[str, Callable[[str], DataFrame]] | None = None, **feeds: DataFrame | Callable[[], DataFrame]) -> None:
        if set(feeds) != set(RAW_SCHEMAS):
            raise ValueError(f"raw feeds must be exactly: {', '.join(RAW_SCHEMAS)}")
        self._feeds = feeds
        self._arranged = arranged or {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._feeds:
            raise AttributeError(name)
        feed = self._feeds[name]
        frame = feed if isinstance(feed, DataFrame) else feed()
        setattr(self, name, frame)
        return frame

    def together(self, name: str, column: str) -> DataFrame:
        """A feed with rows of equal ``column`` in one partition."""
        if name in self._arranged:
            return self._arranged[name](column)
        return getattr(self, name).repartition(column)

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in RAW_SCHEMAS]


def read_available(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], list[str]]:
    """Open every raw feed found under ``folder``; returns the frames and the missing names."""
    found: dict[str, DataFrame] = {}
    missing: list[str] = []
    for name, schema in RAW_SCHEMAS.items():
        try:
            found[name] = spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
    return found, missing


def load_raw(spark: SparkSession, folder: str) -> RawTables:
    """All seven feeds; names every missing one in a single error."""
    found, missing = read_available(spark, folder)
    if missing:
        raise FileNotFoundError(f"raw feeds missing under {folder}: {', '.join(missing)}")
    return RawTables(**found)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one row per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def load_status(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, status, row_count): loaded feeds with their size, absent ones marked missing."""
    found, missing = read_available(spark, folder)
    absent = spark.createDataFrame(
        [(name, "missing", None) for name in missing],
        "table_name string, status string, row_count bigint",
    )
    if not found:
        return absent
    loaded = row_counts(found).withColumn("status", F.lit("loaded"))
    return loaded.select("table_name", "status", "row_count").unionByName(absent)


def discover_assets(spark: SparkSession, folder: str) -> DataFrame:
    """(asset, row_count): every ``<asset>.parquet`` in a folder, single file or directory.

    No data column is read: the scan yields only file paths, counted per asset.
    """
    path = F.col("_metadata.file_path")
    return (
        spark.read.parquet(f"{folder}/*.parquet")
        .select(F.regexp_extract(path, r"/([^/]+)\.parquet(?:/[^/]*)?$", 1).alias("asset"))
        .groupBy("asset")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
