"""Fact tables: inventory, purchase orders, sales, stock-outs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larderline.functions import labels
from larderline.functions.columns import day, in_cents, rounded_ratio, to_units
from larderline.operators.joins import splittable_left_join
from larderline.operators.price_versions import join_at
from larderline.plans.dimensions import current_products
from larderline.plans.staging import staged_sales, stg_inventory

STORE_PRODUCT = ["store_id", "product_id"]


def stock_levels(stg_inventory: DataFrame) -> DataFrame:
    """Sum and count of on-hand units per store and product (their ratio is the average level)."""
    return stg_inventory.groupBy(*STORE_PRODUCT).agg(
        F.sum("quantity_on_hand").alias("on_hand_sum"),
        F.count("quantity_on_hand").alias("on_hand_count"),
    )


LEVELS = ["on_hand_sum", "on_hand_count"]


def with_levels(inventory_snapshots: DataFrame, pair: Sequence[str] = STORE_PRODUCT) -> DataFrame:
    """Raw inventory with the sum and count of on-hand units of its store and product.

    A pair holds one row a week, so this is one exchange of narrow raw rows; keys and flags are made after it. Rows that
    come together by store and product, or by one of them, are not moved, nor sorted if they come in the order of ``pair``.
    """
    units, pair = F.col("quantity_on_hand").cast("int"), Window.partitionBy(*pair)
    return inventory_snapshots.withColumns({"on_hand_sum": F.sum(units).over(pair), "on_hand_count": F.count(units).over(pair)})


def fct_inventory(
    inventory_snapshots: DataFrame, dim_stores: DataFrame, dim_products: DataFrame, by_day: bool = False, by_product: bool = False
) -> DataFrame:
    """One row per store, product and snapshot day, with stock cover and status.

    Days of stock = on hand / (average level / 7) to one decimal, from exact integers. ``by_day`` puts the rows of a
    snapshot together, as files by day want them. ``by_product`` says that the rows of a product come together: its
    averages and its attributes then find them where they are.
    """
    stores = dim_stores.select("store_id", "store_cluster", "state", "is_metro")
    products = current_products(dim_products).select(
        "product_id",
        "product_name",
        "category",
        "perishability",
        "supplier_name",
        "lead_time_days",
        "cost_price",
    )
    cover = rounded_ratio(
        F.col("quantity_on_hand").cast("bigint") * 7 * F.col("on_hand_count"), F.col("on_hand_sum"), 1
    )
    status = (
        F.when(F.col("is_stockout"), "stockout")
        .when(F.col("is_below_reorder_point") & (F.col("lead_time_days") >= labels.LONG_LEAD_DAYS), "critical")
        .when(F.col("is_below_reorder_point"), "low")
        .otherwise("healthy")
    )
    # Keys and flags are made after the joins: their exchanges move raw rows.
    levelled = with_levels(inventory_snapshots, STORE_PRODUCT[::-1] if by_product else STORE_PRODUCT)
    located = levelled.join(products, "product_id", "left").join(stores, "store_id", "left")
    if by_day:
        located = located.hint("rebalance", F.col("snapshot_date"))
    carried = [*LEVELS, *stores.columns[1:], *products.columns[1:]]
    return (
        stg_inventory(located, carried)
        .select(
            "inventory_snapshot_key",
            "store_id",
            "product_id",
            "snapshot_date",
            "store_cluster",
            "state",
            "is_metro",
            "product_name",
            "category",
            "perishability",
            "supplier_name",
            "lead_time_days",
            "quantity_on_hand",
            "reorder_point",
            "reorder_qty",
            (F.col("quantity_on_hand") * F.col("cost_price")).cast("decimal(18,2)").alias("inventory_value"),
            to_units(cover, 1).alias("days_of_stock_remaining"),
            status.alias("stock_status"),
            "is_stockout",
            "is_below_reorder_point",
        )
    )


def fct_purchase_orders(
    stg_purchase_orders: DataFrame,
    dim_stores: DataFrame,
    dim_products: DataFrame,
    stg_suppliers: DataFrame,
    as_of: date,
) -> DataFrame:
    """One row per order line, with promised lead and days overdue at ``as_of``."""
    stores = dim_stores.select("store_id", "store_cluster", "state")
    products = current_products(dim_products).select("product_id", "product_name", "category")
    suppliers = stg_suppliers.select("supplier_id", "supplier_name", "lead_time_days")
    overdue = F.when(F.col("is_late"), F.datediff(day(as_of), "expected_date")).otherwise(F.lit(0))
    return (
        stg_purchase_orders.join(stores, "store_id", "left")
        .join(products, "product_id", "left")
        .join(suppliers, "supplier_id", "left")
        .select(
            "po_id",
            "store_id",
            "product_id",
            "supplier_id",
            "store_cluster",
            "state",
            "product_name",
            "category",
            "supplier_name",
            "lead_time_days",
            "order_date",
            "expected_date",
            "quantity_ordered",
            "unit_cost",
            "total_order_value",
            "status",
            F.datediff("expected_date", "order_date").alias("promised_lead_days"),
            overdue.alias("days_overdue"),
            "is_late",
            "is_fulfilled",
        )
    )


def fct_sales(
    first_sales: DataFrame,
    dim_products: DataFrame,
    dim_stores: DataFrame,
    as_of: date,
    by_day: bool = False,
) -> DataFrame:
    """One row per sale, priced against the product version valid on the sale day; ``first_sales`` holds a raw row of each.

    Versions are disjoint by construction, so no dedup (and no shuffle of the
    sales) follows the version join; see ``disjoint_versions`` for overlapping ones.
    ``by_day`` puts the sales of a day together, as files by day want them. Keys,
    flags and what stores bring are made after these exchanges.
    """
    versions = dim_products.select(
        "product_id",
        "product_name",
        "category",
        "perishability",
        "supplier_name",
        F.col("unit_price").alias("catalogue_price"),
        "cost_price",
        "gross_margin_pct",
        "valid_from",
        "valid_to",
    )
    stores = dim_stores.select("store_id", "store_name", "state", "store_cluster", "cluster_tier", "is_metro")
    profit = F.col("quantity") * (F.col("pos_unit_price") - F.col("cost_price"))
    variance = F.col("pos_unit_price") - F.col("catalogue_price")
    priced = join_at(first_sales, versions, "product_id", F.col("sale_date").cast("date"), as_of, by_year=True)
    if by_day:
        priced = priced.withColumn("_day", F.col("sale_date").cast("date")).hint("rebalance", F.col("_day"))
    carried = [*versions.columns[1:-2], *stores.columns[1:]]
    staged = staged_sales(priced.join(stores, "store_id", "left"), carried)
    return (
        staged.withColumnRenamed("unit_price", "pos_unit_price")
        .select(
            "sale_key",
            "sale_id",
            "store_id",
            "product_id",
            "store_name",
            "state",
            "store_cluster",
            "cluster_tier",
            "is_metro",
            "product_name",
            "category",
            "perishability",
            "supplier_name",
            "sale_date",
            "sale_year",
            "sale_month",
            "sale_dow",
            "is_weekend",
            "quantity",
            "pos_unit_price",
            F.col("total_amount").alias("revenue"),
            profit.cast("decimal(18,2)").alias("gross_profit"),
            "gross_margin_pct",
            variance.cast("decimal(12,2)").alias("price_variance"),
            "has_price_discrepancy",
        )
    )


def daily_demand(stg_sales: DataFrame, dim_products: DataFrame, dim_stores: DataFrame, as_of: date) -> DataFrame:
    """Units and revenue per store, product and day, with the category valid on it and the store's cluster.

    What the demand series need of the sales: the sums are taken before versions and stores are joined, so the joins
    see one narrow row for all sales of a product in a store on a day.
    """
    daily = stg_sales.groupBy(*STORE_PRODUCT, "sale_date").agg(F.sum("quantity").alias("quantity"), F.sum("total_amount").alias("revenue"))
    versions = dim_products.select("product_id", "category", "valid_from", "valid_to")
    priced = join_at(daily, versions, "product_id", "sale_date", as_of, by_year=True)
    return priced.join(dim_stores.select("store_id", "store_cluster"), "store_id", "left").select(
        *STORE_PRODUCT, "sale_date", "category", "store_cluster", "quantity", "revenue"
    )


def sales_averages(stg_sales: DataFrame) -> DataFrame:
    """Revenue (cents) and quantity sums with their counts per store and product.

    They need no column of products or stores, and a sale meets at most one version: so no join comes before the sums.
    """
    return stg_sales.groupBy(*STORE_PRODUCT).agg(
        F.sum(in_cents(F.col("total_amount"))).alias("revenue_cents"),
        F.count("total_amount").alias("revenue_count"),
        F.sum("quantity").alias("quantity_sum"),
        F.count("quantity").alias("quantity_count"),
    )


def fct_stockouts(fct_inventory: DataFrame, stg_sales: DataFrame) -> DataFrame:
    """Stock-outs and low stock per store, product and day, with estimated lost revenue.

    The averages are per sale row, the seven days one snapshot interval.
    """
    events = fct_inventory.filter("is_stockout OR is_below_reorder_point")
    revenue = F.col("revenue_cents").cast("double") / 100.0 / F.col("revenue_count")
    quantity = F.col("quantity_sum").cast("double") / F.col("quantity_count")
    lost_cents = F.coalesce(
        rounded_ratio(F.col("revenue_cents") * 7, F.col("revenue_count")), F.lit(0).cast("bigint")
    )
    long_lead = F.col("lead_time_days") >= labels.LONG_LEAD_DAYS
    urgency = (
        F.when(F.col("is_stockout") & long_lead, "critical")
        .when(F.col("is_stockout") & ~long_lead, "high")
        .when(F.col("is_below_reorder_point"), "medium")
        .otherwise("low")
    )
    return splittable_left_join(events, sales_averages(stg_sales), STORE_PRODUCT).select(
        "store_id",
        "product_id",
        F.col("snapshot_date").alias("stockout_date"),
        "stock_status",
        "is_stockout",
        "is_below_reorder_point",
        "days_of_stock_remaining",
        "store_cluster",
        "state",
        "product_name",
        "category",
        "lead_time_days",
        F.coalesce(revenue, F.lit(0.0)).alias("avg_daily_revenue"),
        F.coalesce(quantity, F.lit(0.0)).alias("avg_daily_quantity"),
        F.when(F.col("is_stockout"), to_units(lost_cents, 2))
        .otherwise(F.lit(0.0))
        .alias("estimated_lost_revenue_7d"),
        urgency.alias("urgency"),
    )
