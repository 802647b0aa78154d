"""Reorder recommendations per store and product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.functions.columns import lookup
from larderline.operators.joins import sharing_left_join
from larderline.plans.facts import STORE_PRODUCT
from larderline.plans.forecast import forecast_summary

# Safety multipliers by stock status as documented.
DOCUMENTED_MULTIPLIERS = {"stockout": 1.5, "critical": 1.3, "low": 1.1, "healthy": 1.0}
# Multipliers by urgency tier, as the reorder job applies them to the status.
URGENCY_MULTIPLIERS = {"critical": 1.5, "high": 1.3, "medium": 1.1, "low": 1.0}
URGENT = ["stockout", "critical"]
COVER_DAYS = 28


def latest_inventory(fct_inventory: DataFrame) -> DataFrame:
    """The newest snapshot; on a mart partitioned by date the scalar subquery prunes to one partition."""
    newest = fct_inventory.agg(F.max("snapshot_date")).scalar()
    return fct_inventory.filter(F.col("snapshot_date") == newest).select(
        "store_id",
        "product_id",
        "snapshot_date",
        "category",
        "store_cluster",
        "quantity_on_hand",
        "reorder_point",
        "reorder_qty",
        "stock_status",
        "days_of_stock_remaining",
        "lead_time_days",
        "product_name",
        "supplier_name",
    )


def recommend(expected: DataFrame, multipliers: dict[str, float]) -> DataFrame:
    """Reorder decision and quantity for inventory rows with their weekly forecast attached.

    Needs ``avg_weekly_forecast`` and ``forecast_upper_avg``. Missing forecasts are
    NULL (never NaN): then only the stock status can trigger, with quantity 0.
    """
    lead, on_hand = F.col("lead_time_days"), F.col("quantity_on_hand")
    multiplier = F.coalesce(lookup(F.col("stock_status"), multipliers), F.lit(1.0))
    steps = (
        expected.withColumn("_daily", F.col("avg_weekly_forecast") / 7.0)
        .withColumn("_lead_demand", F.col("_daily") * lead)
        .withColumn("_safety", F.col("forecast_upper_avg") / 7.0 * lead * (multiplier - 1.0))
        .withColumn("_trigger", F.col("_lead_demand") + F.col("_safety"))
    )
    should = F.coalesce(on_hand <= F.col("_trigger"), F.lit(False)) | F.coalesce(
        F.col("stock_status").isin(URGENT), F.lit(False)
    )
    wanted = F.col("_daily") * COVER_DAYS - on_hand + F.col("_safety")
    quantity = F.when(should, F.bround(F.greatest(F.lit(0.0), wanted), 0)).otherwise(F.lit(0.0))

    def shown(name: str) -> Column:
        return F.bround(F.col(name), 1)

    return steps.select(
        "store_id",
        "product_id",
        "product_name",
        "supplier_name",
        "category",
        "store_cluster",
        on_hand.alias("current_stock"),
        "stock_status",
        "days_of_stock_remaining",
        "lead_time_days",
        shown("avg_weekly_forecast").alias("avg_weekly_forecast"),
        shown("_lead_demand").alias("demand_during_lead_time"),
        shown("_safety").alias("safety_stock"),
        shown("_trigger").alias("calc_reorder_point"),
        should.alias("should_reorder"),
        quantity.alias("recommended_order_qty"),
    )


def reorder_by_cluster(
    latest: DataFrame,
    forecast: DataFrame,
    multipliers: dict[str, float] = URGENCY_MULTIPLIERS,
) -> DataFrame:
    """Forecasts matched on (category, store_cluster) as they are stored.

    Category forecasts carry the cluster "all" and match no store, so the status
    alone decides; kept because it is what the stored forecasts yield.
    """
    summary = forecast_summary(forecast)
    return recommend(latest.join(summary, ["category", "store_cluster"], "left"), multipliers)


def reorder_by_share(
    latest: DataFrame,
    forecast: DataFrame,
    sales: DataFrame,
    multipliers: dict[str, float] = DOCUMENTED_MULTIPLIERS,
) -> DataFrame:
    """Category forecasts brought to each store and product by its share of the category's units.

    The sums of sales are read three times (forecast, totals, shares). The joins let no filter on their keys go below
    them, so that the three have one plan and its exchanges run once. Null keys match nothing.
    """
    sold = sales.groupBy("category", *STORE_PRODUCT).agg(F.sum("quantity").alias("units"))
    totals = sold.groupBy(F.col("category").alias("_category")).agg(F.sum("units").alias("category_units"))
    ahead = forecast_summary(forecast).drop("store_cluster", "max_weekly_forecast")
    ahead = ahead.join(totals, F.col("category").eqNullSafe(F.col("_category"))).drop("_category")
    ahead = ahead.withColumnsRenamed(
        {"avg_weekly_forecast": "_category_avg", "forecast_upper_avg": "_category_upper"}
    )
    located = sharing_left_join(latest, sold, ["category", *STORE_PRODUCT])
    share = F.try_divide(
        F.coalesce(F.col("units"), F.lit(0)).cast("double"), F.col("category_units").cast("double")
    )
    expected = (
        # One row a category: without the hint all stock may be moved by category before its size is known.
        located.join(F.broadcast(ahead), "category", "left")
        .withColumn("_share", share)
        .withColumn("avg_weekly_forecast", F.col("_category_avg") * F.col("_share"))
        .withColumn("forecast_upper_avg", F.col("_category_upper") * F.col("_share"))
    )
    return recommend(expected, multipliers)


def _severity(*statuses: str) -> Column:
    return F.coalesce(
        lookup(F.col("stock_status"), {s: i for i, s in enumerate(statuses, 1)}), F.lit(len(statuses) + 1)
    )


def top_reorders(recommendations: DataFrame, k: int = 10) -> DataFrame:
    """The k most urgent recommendations (ties by store and product)."""
    return (
        recommendations.filter("should_reorder")
        .orderBy(
            _severity("stockout", "critical", "low"),
            F.desc_nulls_last("recommended_order_qty"),
            "store_id",
            "product_id",
        )
        .limit(k)
        .select("product_name", "store_id", "product_id", "stock_status", "current_stock", "recommended_order_qty")
    )


def urgent_orders(recommendations: DataFrame) -> DataFrame:
    """Orders to raise today: worst status first, then the largest."""
    return (
        recommendations.filter(F.col("should_reorder") & F.col("stock_status").isin(URGENT))
        .orderBy(_severity("stockout"), F.desc_nulls_last("recommended_order_qty"), "store_id", "product_id")
        .select("store_id", "product_name", "supplier_name", "recommended_order_qty", "stock_status")
    )


def urgent_orders_planner(recommendations: DataFrame) -> DataFrame:
    """The planners' list: urgent recommendations with current stock, worst status first."""
    return (
        recommendations.filter(F.col("should_reorder") & F.col("stock_status").isin(URGENT))
        .orderBy(_severity("stockout", "critical"), "store_id", "product_id")
        .select(
            "store_id",
            "product_name",
            "supplier_name",
            "stock_status",
            "current_stock",
            "recommended_order_qty",
        )
    )
