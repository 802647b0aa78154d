"""Weekly demand series built from the sales fact, or from its sums by store, product and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_WEEKS = 26
MAX_ZERO_SHARE = 0.3


def weekly_sales(sales: DataFrame) -> DataFrame:
    """Units and revenue per Monday week and category, every week included."""
    return sales.groupBy(F.trunc("sale_date", "week").alias("week_start"), "category").agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum("revenue").cast("decimal(38,2)").alias("total_revenue"),
    )


def weekly_demand(sales: DataFrame) -> DataFrame:
    """The forecast input: weekly units, revenue and selling stores, without the partial first week."""
    weekly = sales.groupBy(F.trunc("sale_date", "week").alias("week_start"), "category").agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum("revenue").cast("decimal(38,2)").alias("total_revenue"),
        F.countDistinct("store_id").alias("store_count"),
    )
    return after_first_week(weekly)


def after_first_week(weekly: DataFrame) -> DataFrame:
    """Weekly rows without the first week of any category.

    The first week comes from the grouped rows themselves, so the sales are read once; the window holds one row per
    calendar week and category.
    """
    first = F.min("week_start").over(Window.partitionBy())
    return weekly.withColumn("_first", first).filter(F.col("week_start") > F.col("_first")).drop("_first")


def series_profile(weekly: DataFrame) -> DataFrame:
    """One row: number of weekly rows and categories, first and last week."""
    return weekly.agg(
        F.count(F.lit(1)).alias("weekly_rows"),
        F.countDistinct("category").alias("categories"),
        F.min("week_start").alias("first_week"),
        F.max("week_start").alias("last_week"),
    )


def eligibility(weekly: DataFrame) -> DataFrame:
    """Per category: history length, share of zero weeks, and whether (or why not) it can be forecast."""
    zero_share = F.col("zero_weeks") / F.col("n_weeks")
    short = F.col("n_weeks") < MIN_WEEKS
    sparse = zero_share > MAX_ZERO_SHARE
    percent = F.bround(zero_share * 100, 0).cast("int")
    reason = F.when(short, F.format_string("Only %d weeks of history", F.col("n_weeks"))).when(
        sparse, F.format_string("Too many zero weeks (%d%%) — sparse data", percent)
    )
    return (
        weekly.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("n_weeks"),
            F.count_if(F.col("total_quantity") == 0).alias("zero_weeks"),
            F.min("week_start").alias("first_week"),
            F.max("week_start").alias("last_week"),
        )
        .select(
            "category",
            "n_weeks",
            "zero_weeks",
            "first_week",
            "last_week",
            F.when(short | sparse, "skipped").otherwise("eligible").alias("status"),
            reason.alias("reason"),
        )
    )


def eligible_series(weekly: DataFrame) -> DataFrame:
    """The weekly rows of the categories that can be forecast; rows without a category never are.

    A window partition holds one series: one row per calendar week.
    """
    series = Window.partitionBy("category")
    zero = (F.col("total_quantity") == 0).cast("int")
    return (
        weekly.filter(F.col("category").isNotNull())
        .withColumns({"_weeks": F.count(F.lit(1)).over(series), "_zeros": F.sum(zero).over(series)})
        .filter((F.col("_weeks") >= MIN_WEEKS) & (F.col("_zeros") / F.col("_weeks") <= MAX_ZERO_SHARE))
        .drop("_weeks", "_zeros")
    )


def weekly_by_cluster(sales: DataFrame) -> DataFrame:
    """Units per week, category and store cluster: the one pass over sales behind all forecast steps."""
    return sales.groupBy(F.trunc("sale_date", "week").alias("week_start"), "category", "store_cluster").agg(
        F.sum("quantity").alias("total_quantity")
    )


def category_series(by_cluster: DataFrame) -> DataFrame:
    """Weekly units per category from the cluster rows, without the partial first week."""
    weekly = by_cluster.groupBy("week_start", "category").agg(F.sum("total_quantity").alias("total_quantity"))
    return after_first_week(weekly)


def demand_shares(rows: DataFrame, keys: Sequence[str], units: str) -> DataFrame:
    """Units of each (category, *keys) and of its category: their ratio is the demand share.

    Category totals are summed from the already grouped rows and joined back, so
    a large category is never one window partition.
    """
    parts = rows.groupBy("category", *keys).agg(F.sum(units).alias("units"))
    totals = parts.groupBy("category").agg(F.sum("units").alias("category_units"))
    return parts.join(totals, "category")
