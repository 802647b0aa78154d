"""The aggregates behind the planning dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.functions import labels
from larderline.functions.columns import rounded_ratio, to_units

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
ACTIONABLE = ["stockout", "critical", "low"]


def weekly_chart(weekly_sales: DataFrame) -> DataFrame:
    """Weekly units and revenue per category, week as text."""
    return weekly_sales.select(
        F.date_format("week_start", "yyyy-MM-dd").alias("week_start"), "category", "total_quantity", "total_revenue"
    ).orderBy("week_start", "category")


def forecast_series(weekly_sales: DataFrame, forecast: DataFrame) -> DataFrame:
    """Every category on every week that has sales or a forecast: 0 units without sales, NULL without forecast.

    Categories outside the known ones (or none) keep the weeks for which they have rows.

    The grid comes from exploding the known categories on each week; history,
    forecast and grid meet in one grouping instead of joins.
    """
    history = weekly_sales.select("week_start", "category", F.col("total_quantity").alias("units"))
    ahead = forecast.select(F.col("forecast_date").alias("week_start"), "category", "yhat", "yhat_lower", "yhat_upper")
    known = F.explode(F.array(*[F.lit(c) for c in labels.CATEGORIES])).alias("category")
    weeks = history.select("week_start").unionByName(ahead.select("week_start")).distinct()
    cells = (
        history.unionByName(ahead, allowMissingColumns=True)
        .unionByName(weeks.select("week_start", known), allowMissingColumns=True)
    )
    return cells.groupBy("week_start", "category").agg(
        F.coalesce(F.sum("units"), F.lit(0)).alias("history_units"),
        *[F.bround(F.max(c), 0).cast("bigint").alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")],
    )


def status_counts(latest_inventory: DataFrame) -> DataFrame:
    """Store-product pairs per category, cluster and stock status."""
    return latest_inventory.groupBy("category", "store_cluster", "stock_status").agg(F.count(F.lit(1)).alias("cnt"))


def stockout_heatmap(latest_inventory: DataFrame) -> DataFrame:
    """Stock-out share in percent, one row per category and one column per cluster; 0 where nothing is stocked.

    Stores of no known cluster are counted in the last column, "other".
    """
    out = F.count_if(F.col("stock_status") == "stockout")
    share = to_units(rounded_ratio(out * 100, F.count(F.lit(1)), 1), 1)
    columns = [*labels.CLUSTERS, "other"]
    cluster = F.when(F.col("store_cluster").isin(labels.CLUSTERS), F.col("store_cluster")).otherwise("other")
    grid = latest_inventory.withColumn("store_cluster", cluster).groupBy("category").pivot("store_cluster", columns).agg(share)
    return grid.fillna(0.0, columns)


def reorder_counts(recommendations: DataFrame) -> DataFrame:
    """(category, stock_status, total, needs_reorder) over the statuses that call for action."""
    return (
        recommendations.filter(F.col("stock_status").isin(ACTIONABLE))
        .groupBy("category", "stock_status")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if("should_reorder").alias("needs_reorder"))
    )


def reorder_urgency(recommendations: DataFrame) -> DataFrame:
    """Pairs to reorder, one row per category and one column per status; 0 where none."""
    counts = reorder_counts(recommendations)
    grid = counts.groupBy("category").pivot("stock_status", ACTIONABLE).agg(F.sum("needs_reorder"))
    return grid.fillna(0, ACTIONABLE)


def seasonal_profile(fct_sales: DataFrame) -> DataFrame:
    """Average units per sale by calendar month and category, one decimal."""
    average = to_units(rounded_ratio(F.sum("quantity"), F.count("quantity"), 1), 1)
    return fct_sales.groupBy(
        F.month("sale_date").alias("month_num"), F.date_format("sale_date", "MMM").alias("month_name"), "category"
    ).agg(average.alias("avg_daily_qty"))


def seasonal_grid(profile: DataFrame) -> DataFrame:
    """The seasonal profile with one column per month, in whole units; 0 where nothing sold."""
    whole = F.bround(F.max("avg_daily_qty"), 0).cast("bigint")
    return profile.groupBy("category").pivot("month_name", MONTHS).agg(whole).fillna(0, MONTHS)


def kpi_summary(latest_inventory: DataFrame, recommendations: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row of headline numbers, merged from three one-row aggregates."""

    def status(name: str) -> Column:
        return F.count_if(F.col("stock_status") == name)

    needs = F.count_if(F.col("should_reorder") & F.col("stock_status").isin(ACTIONABLE))
    stock = latest_inventory.agg(status("stockout").alias("stockouts"), status("critical").alias("critical"))
    orders = recommendations.agg(needs.alias("reorders"), F.count(F.lit(1)).alias("pairs_evaluated"))
    models = metadata.agg(
        F.min("mape").alias("best_mape"), F.max("mape").alias("worst_mape"), F.count(F.lit(1)).alias("models")
    )
    merged = stock.unionByName(orders, allowMissingColumns=True).unionByName(models, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])
