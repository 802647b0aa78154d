"""The common questions of the data catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_stores_by_state(dim_stores: DataFrame) -> DataFrame:
    return dim_stores.filter("is_active").groupBy("state").agg(F.count(F.lit(1)).alias("store_count"))


def metro_split(dim_stores: DataFrame) -> DataFrame:
    return dim_stores.groupBy("is_metro").agg(F.count(F.lit(1)).alias("store_count"))


def current_catalogue(dim_products: DataFrame) -> DataFrame:
    return dim_products.filter("is_current_version AND is_active").select(
        "product_id", "product_name", "category", "unit_price"
    )


def multi_price_products(dim_products: DataFrame) -> DataFrame:
    """Products with more than one price version, most versions first."""
    return (
        dim_products.groupBy("product_id", "product_name")
        .agg(F.count(F.lit(1)).alias("price_versions"))
        .filter(F.col("price_versions") > 1)
        .orderBy(F.desc("price_versions"), "product_id")
    )


def stockouts_by_category(latest_inventory: DataFrame) -> DataFrame:
    return (
        latest_inventory.filter(F.col("stock_status") == "stockout")
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("stockout_count"))
        .orderBy(F.desc("stockout_count"), "category")
    )


def critical_stores(latest_inventory: DataFrame, k: int = 20) -> DataFrame:
    """The k stores with most products out of stock or critical (ties by store)."""
    return (
        latest_inventory.filter(F.col("stock_status").isin("stockout", "critical"))
        .groupBy("store_id")
        .agg(F.count(F.lit(1)).alias("critical_products"))
        .orderBy(F.desc("critical_products"), "store_id")
        .limit(k)
    )
