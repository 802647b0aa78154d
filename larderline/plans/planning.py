"""Planning quantities: which forecast number to order to, by the published guidance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.functions import labels
from larderline.functions.columns import lookup

UNRELIABLE_MAPE = 80.0
STOCKOUT_UPLIFT = 1.15
RECENT_WEEKS = 4


def recent_cluster_demand(by_cluster: DataFrame, weeks: int = RECENT_WEEKS) -> DataFrame:
    """Average weekly units of the last weeks of history per category and cluster."""
    last = by_cluster.agg(F.max("week_start")).scalar()
    recent = by_cluster.filter(F.datediff(last, "week_start") < weeks * 7)
    return recent.groupBy("category", "store_cluster").agg(
        (F.sum("total_quantity").cast("double") / float(weeks)).alias("recent_weekly_units")
    )


def recent_stockouts(fct_inventory: DataFrame, weeks: int = RECENT_WEEKS) -> DataFrame:
    """Categories and clusters with a stock-out in the last weeks of snapshots."""
    last = fct_inventory.agg(F.max("snapshot_date")).scalar()
    recent = fct_inventory.filter(F.col("is_stockout") & (F.datediff(last, "snapshot_date") < weeks * 7))
    return recent.select("category", "store_cluster").distinct().withColumn("had_stockout", F.lit(True))


def planning_quantity(
    cluster_forecast: DataFrame,
    metadata: DataFrame,
    recent_demand: DataFrame,
    stockouts: DataFrame,
    stockout_uplift: float = STOCKOUT_UPLIFT,
) -> DataFrame:
    """Units to plan per category, cluster and week. The first rule that applies sets the base:

    1. error above 80 %: the upper bound, at least the last four weeks' average; to be reviewed
    2. a stock-out in the last four weeks: the upper bound plus 15 %
    3. fresh produce: the upper bound
    4. otherwise the point forecast

    Perishables in rural clusters get one further average week on top. All inputs
    are aggregates by category and cluster.
    """
    keys = ["category", "store_cluster"]
    average = cluster_forecast.groupBy(*keys).agg(F.avg("yhat").alias("average_week"))
    unreliable = F.coalesce(F.col("mape") > UNRELIABLE_MAPE, F.lit(False))
    suppressed = F.coalesce(F.col("had_stockout"), F.lit(False))
    floor = F.coalesce(F.col("recent_weekly_units"), F.lit(0.0))
    rule = (
        F.when(unreliable, "unreliable")
        .when(suppressed, "recent_stockout")
        .when(F.col("category") == "fresh_produce", "fresh_produce")
        .otherwise("point_forecast")
    )
    base = (
        F.when(F.col("rule") == "unreliable", F.greatest(F.col("yhat_upper"), floor))
        .when(F.col("rule") == "recent_stockout", F.col("yhat_upper") * stockout_uplift)
        .when(F.col("rule") == "fresh_produce", F.col("yhat_upper"))
        .otherwise(F.col("yhat"))
    )
    spoils = lookup(F.col("category"), labels.PERISHABILITY) == "Perishable"
    extra = F.when((F.col("store_cluster") == "rural") & spoils, F.col("average_week")).otherwise(F.lit(0.0))
    return (
        cluster_forecast.join(metadata.select("category", "mape"), "category", "left")
        .join(recent_demand, keys, "left")
        .join(stockouts, keys, "left")
        .join(average, keys, "left")
        .withColumn("rule", rule)
        .select(
            "forecast_date",
            "category",
            "store_cluster",
            "rule",
            unreliable.alias("needs_review"),
            (base + extra).alias("planned_units"),
        )
    )


PAIR = ["store_id", "product_id"]


def open_week_rates(
    stock: DataFrame,
    stg_sales: DataFrame,
    recent_weeks: int = RECENT_WEEKS,
    stores: DataFrame | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Demand per store and product from the weeks in which its shelf was not empty.

    A week with a stock-out shows what could be sold, not what was wanted: it is masked for its own store and product,
    and ``weekly_rate`` is the mean of the others (NULL if none is left). Only weeks with a snapshot count. Also
    ``recent_units`` (mean of the last weeks, masked or not) and ``had_stockout`` in these.

    ``stock`` holds snapshots with ``category`` and ``store_cluster``, or without them: then each pair gets them from
    ``stores`` and ``products`` after its weeks are summed, and only pairs are moved for that. All steps on weeks share
    the partitions by store and product.
    """
    week = F.trunc("snapshot_date", "week")
    span = stock.agg(F.min(week).alias("first"), F.max(week).alias("last"))
    first, last = span.select("first").scalar(), span.select("last").scalar()
    labelled = [c for c in ("category", "store_cluster") if c in stock.columns]
    weeks = stock.groupBy(*PAIR, *labelled, week.alias("week_start")).agg(F.bool_or("is_stockout").alias("masked"))
    sold_in = F.trunc("sale_date", "week")
    sold = stg_sales.filter(F.col("sale_date") >= first).groupBy(*PAIR, sold_in.alias("week_start")).agg(F.sum("quantity").alias("units"))
    # One row a pair, with a map of its weeks: the join is by the pair alone, so the weeks of stock stay where they are.
    by_week = F.map_from_entries(F.collect_list(F.struct("week_start", "units"))).alias("_units")
    sold = sold.groupBy(*PAIR).agg(by_week).hint("shuffle_hash")
    units = F.coalesce(F.try_element_at("_units", F.col("week_start")), F.lit(0).cast("bigint"))
    recent = F.datediff(last, "week_start") < recent_weeks * 7
    by_pair = weeks.join(sold, PAIR, "left").groupBy(*PAIR, *labelled).agg(
        F.count_if(~F.col("masked")).alias("open_weeks"),
        F.count_if("masked").alias("masked_weeks"),
        F.sum(F.when(~F.col("masked"), units)).alias("open_units"),
        (F.sum(F.when(recent, units).otherwise(0)).cast("double") / float(recent_weeks)).alias("recent_units"),
        F.bool_or(recent & F.col("masked")).alias("had_stockout"),
    )
    if products is not None:
        by_pair = by_pair.join(products.select("product_id", "category").distinct(), "product_id", "left")
    if stores is not None:
        by_pair = by_pair.join(stores.select("store_id", "store_cluster").distinct(), "store_id", "left")
    rate = F.try_divide(F.col("open_units").cast("double"), F.col("open_weeks").cast("double"))
    return by_pair.withColumn("weekly_rate", rate).drop("open_units")


def planning_products(forecast: DataFrame, metadata: DataFrame, rates: DataFrame, stockout_uplift: float = STOCKOUT_UPLIFT) -> DataFrame:
    """Units to plan per store, product and week: the category forecast by shares of uncensored demand.

    The rules are those of :func:`planning_quantity`, with the stock-out rule for the very store and product. The
    forecast is a category's mean over its horizon. Products without a forecast category or an open week have no plan.
    """
    totals = rates.groupBy("category").agg(F.sum("weekly_rate").alias("_total"))
    ahead = forecast.groupBy("category").agg(F.avg("yhat").alias("_yhat"), F.avg("yhat_upper").alias("_upper"))
    by_category = ahead.join(totals, "category").join(metadata.select("category", "mape"), "category", "left")
    share = F.try_divide(F.col("weekly_rate"), F.col("_total"))
    unreliable = F.coalesce(F.col("mape") > UNRELIABLE_MAPE, F.lit(False))
    point, upper = F.col("_yhat") * F.col("_share"), F.col("_upper") * F.col("_share")
    rule = (
        F.when(unreliable, "unreliable")
        .when(F.col("had_stockout"), "recent_stockout")
        .when(F.col("category") == "fresh_produce", "fresh_produce")
        .otherwise("point_forecast")
    )
    base = (
        F.when(F.col("rule") == "unreliable", F.greatest(upper, F.col("recent_units")))
        .when(F.col("rule") == "recent_stockout", upper * stockout_uplift)
        .when(F.col("rule") == "fresh_produce", upper)
        .otherwise(point)
    )
    spoils = lookup(F.col("category"), labels.PERISHABILITY) == "Perishable"
    extra = F.when((F.col("store_cluster") == "rural") & spoils, point).otherwise(F.lit(0.0))
    # One row a category: the planner may broadcast it.
    return (
        rates.join(by_category, "category", "left")
        .withColumn("_share", share)
        .withColumn("rule", rule)
        .select(
            *PAIR,
            "category",
            "store_cluster",
            "open_weeks",
            "masked_weeks",
            "weekly_rate",
            "rule",
            unreliable.alias("needs_review"),
            F.when(F.col("_share").isNotNull(), base + extra).alias("planned_weekly_units"),
        )
    )
