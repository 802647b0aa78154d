"""Staging: typed, renamed and derived columns over each raw feed."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.functions import labels
from larderline.functions.columns import day, in_cents, rounded_ratio, surrogate_key, true_when
from larderline.operators.dedup import keep_first
from larderline.operators.price_versions import close_versions


def money(name: str) -> Column:
    return F.col(name).cast("decimal(10,2)").alias(name)


def integer(name: str) -> Column:
    return F.col(name).cast("int").alias(name)


def as_date(name: str) -> Column:
    return F.col(name).cast("date").alias(name)


def stg_stores(stores: DataFrame) -> DataFrame:
    """One row per store."""
    return stores.select(
        "store_id",
        "store_name",
        "city",
        "postcode",
        "state",
        "store_cluster",
        as_date("opened_date"),
        true_when(F.col("store_cluster").isin(labels.METRO_CLUSTERS)).alias("is_metro"),
        F.col("is_active").cast("boolean").alias("is_active"),
    )


def stg_suppliers(suppliers: DataFrame) -> DataFrame:
    """One row per supplier; reliable = active with a lead time under two weeks."""
    quick = F.col("is_active").cast("boolean") & (F.col("lead_time_days") < labels.LONG_LEAD_DAYS)
    return suppliers.select(
        "supplier_id",
        "supplier_name",
        "country",
        "payment_terms",
        integer("lead_time_days"),
        true_when(quick).alias("is_reliable_supplier"),
        F.col("is_active").cast("boolean").alias("is_active"),
    )


def stg_inventory(inventory_snapshots: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """One row per store, product and snapshot day; ``carried`` columns are kept as they are."""
    on_hand = F.col("quantity_on_hand")
    return inventory_snapshots.select(
        surrogate_key("store_id", "product_id", "snapshot_date").alias("inventory_snapshot_key"),
        "store_id",
        "product_id",
        as_date("snapshot_date"),
        integer("quantity_on_hand"),
        integer("reorder_point"),
        integer("reorder_qty"),
        true_when(on_hand == 0).alias("is_stockout"),
        true_when((on_hand > 0) & (on_hand <= F.col("reorder_point"))).alias("is_below_reorder_point"),
        *carried,
    )


def stg_purchase_orders(purchase_orders: DataFrame, as_of: date) -> DataFrame:
    """One row per order line; late = still open after its expected day."""
    cost = F.col("unit_cost").cast("decimal(10,2)")
    value = F.round(F.col("quantity_ordered") * F.col("unit_cost"), 2).cast("decimal(18,2)")
    late = F.col("status").isin(labels.OPEN_ORDER_STATUSES) & (day(as_of) > F.col("expected_date"))
    return purchase_orders.select(
        "po_id",
        "store_id",
        "product_id",
        "supplier_id",
        as_date("order_date"),
        as_date("expected_date"),
        integer("quantity_ordered"),
        cost.alias("unit_cost"),
        value.alias("total_order_value"),
        "status",
        true_when(late).alias("is_late"),
        true_when(F.col("status") == "delivered").alias("is_fulfilled"),
    )


def first_sales(pos_sales: DataFrame) -> DataFrame:
    """One raw row per sale id: the largest total wins, ties by store, product, date and quantity."""
    return keep_first(
        pos_sales,
        ["sale_id"],
        [
            F.desc_nulls_last("total_amount"),
            F.asc_nulls_last("store_id"),
            F.asc_nulls_last("product_id"),
            F.asc_nulls_last("sale_date"),
            F.asc_nulls_last("quantity"),
        ],
    )


def stg_sales(pos_sales: DataFrame) -> DataFrame:
    """One row per sale id."""
    return staged_sales(first_sales(pos_sales))


def staged_sales(sales: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Typed sales, a row for each raw one of ``sales``; ``carried`` columns are kept as they are."""
    weekday = F.dayofweek("sale_date") - 1  # 0 = Sunday
    difference = F.abs(F.col("total_amount") - F.col("quantity") * F.col("unit_price"))
    return sales.select(
        surrogate_key("sale_id", "store_id", "product_id", "sale_date").alias("sale_key"),
        "sale_id",
        "store_id",
        "product_id",
        as_date("sale_date"),
        F.year("sale_date").alias("sale_year"),
        F.month("sale_date").alias("sale_month"),
        weekday.alias("sale_dow"),
        true_when(weekday.isin(0, 6)).alias("is_weekend"),
        integer("quantity"),
        money("unit_price"),
        money("total_amount"),
        true_when(difference > F.lit("0.01").cast("decimal(10,2)")).alias("has_price_discrepancy"),
        *carried,
    )


def margin_percent(price: Column, cost: Column) -> Column:
    """(price - cost) / price in percent to two decimals, exact; NULL for a zero price."""
    price, cost = in_cents(price.cast("decimal(10,2)")), in_cents(cost.cast("decimal(10,2)"))
    hundredths = rounded_ratio((price - cost) * 100, price, 2)
    return (hundredths * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(5,2)")


def with_product_attributes(price_history: DataFrame, products: DataFrame) -> DataFrame:
    """Price rows with the attributes of their product and the margin of each price."""
    attributes = products.select(
        "product_id", "product_name", "category", "supplier_id", "unit_of_measure", "is_active"
    )
    margin = margin_percent(F.col("unit_price"), F.col("cost_price"))
    return price_history.join(attributes, "product_id").withColumn("gross_margin_pct", margin)


def product_snapshot(product_price_history: DataFrame, products: DataFrame) -> DataFrame:
    """Versioned products: every price with the timespan it held.

    Versions are closed on the narrow price history, before the product
    attributes are joined, so the windows move only keys, prices and times.
    """
    dearest = [F.desc_nulls_last("unit_price"), F.desc_nulls_last("cost_price")]
    versions = close_versions(product_price_history, "product_id", "effective_from", dearest)
    return with_product_attributes(versions, products)


def stg_products(snapshot: DataFrame) -> DataFrame:
    """One row per product version."""
    return snapshot.select(
        surrogate_key("product_id", "valid_from").alias("product_version_key"),
        "product_id",
        "product_name",
        "category",
        "supplier_id",
        "unit_of_measure",
        money("unit_price"),
        money("cost_price"),
        F.col("gross_margin_pct").cast("decimal(5,2)").alias("gross_margin_pct"),
        as_date("valid_from"),
        as_date("valid_to"),
        F.col("valid_to").isNull().alias("is_current_version"),
        F.col("is_active").cast("boolean").alias("is_active"),
    )
