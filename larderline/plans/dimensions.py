"""Store and product dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.functions import labels
from larderline.functions.columns import lookup


def dim_stores(stg_stores: DataFrame) -> DataFrame:
    """One row per store, with its cluster tier and spelled-out state."""
    return stg_stores.withColumns(
        {
            "cluster_tier": lookup(F.col("store_cluster"), labels.CLUSTER_TIER),
            "state_full_name": lookup(F.col("state"), labels.STATE_NAME),
        }
    )


def dim_products(stg_products: DataFrame, stg_suppliers: DataFrame) -> DataFrame:
    """One row per product version, with its supplier; supplier_id is NULL when unmatched."""
    suppliers = stg_suppliers.select("supplier_id", "supplier_name", "lead_time_days", "is_reliable_supplier")
    own = stg_products.withColumnRenamed("supplier_id", "_supplier")
    return own.join(suppliers, F.col("_supplier") == F.col("supplier_id"), "left").select(
        "product_version_key",
        "product_id",
        "product_name",
        "category",
        "unit_of_measure",
        "is_active",
        "unit_price",
        "cost_price",
        "gross_margin_pct",
        "valid_from",
        "valid_to",
        "is_current_version",
        "supplier_id",
        "supplier_name",
        "lead_time_days",
        "is_reliable_supplier",
        lookup(F.col("category"), labels.PERISHABILITY).alias("perishability"),
    )


def current_products(dim_products: DataFrame) -> DataFrame:
    """The open version of every product."""
    return dim_products.filter("is_current_version")
