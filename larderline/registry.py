"""Every registered query by name: (spark, folder) -> DataFrame over the given tables."""

from __future__ import annotations

import os
import uuid
import weakref
from collections.abc import Callable
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.functions.columns import surrogate_key
from larderline.operators import price_versions, quality
from larderline.operators.metric_history import MetricHistory
from larderline.operators.reuse import shared_folder
from larderline.operators.stored_versions import VersionStore
from larderline.plans import catalogue, checks, dashboard, demand, forecast, planning, reorder, staging
from larderline.plans.dimensions import current_products
from larderline.plans.warehouse import Warehouse
from larderline.sources import raw as raw_feeds
from larderline.sources import sinks
from larderline.sources.from_orders import derive_raw
from larderline.sources.publish import Publication
from larderline.sources.raw import RawTables
from larderline.sources.schemas import RAW_SCHEMAS

AS_OF = date(2001, 12, 1)
# Order lateness is judged earlier: by AS_OF every open order would be late.
ORDERS_AS_OF = date(2001, 7, 1)
# Price changes up to this day count as the existing snapshot in the merge query.
SNAPSHOT_SPLIT = date(1998, 1, 1)
# The first of two monitoring runs ends here, without some rows of its last days.
HISTORY_SPLIT = date(1999, 3, 10)
LATE_DAYS = 6
# Changes from this day on come as a second batch in the stored snapshot.
SECOND_BATCH = date(1999, 7, 1)
HOLIDAY_YEARS = range(1995, 2003)
FORECAST_FROM = date(2001, 12, 1)

Query = Callable[[SparkSession, str], DataFrame]
Listing = tuple[tuple[str, int, int], ...]


class Shop(Warehouse):
    """The warehouse over derived feeds plus the tables that queries share."""

    @cached_property
    def weekly_sales(self) -> DataFrame:
        return demand.weekly_sales(self.daily_demand)

    @cached_property
    def weekly_demand(self) -> DataFrame:
        return demand.weekly_demand(self.daily_demand)

    @cached_property
    def by_cluster(self) -> DataFrame:
        """Weekly units by category and cluster: trend, backtest, shares and floors all read it."""
        return demand.weekly_by_cluster(self.daily_demand)

    @cached_property
    def series(self) -> DataFrame:
        return demand.category_series(self.by_cluster)

    @cached_property
    def latest_inventory(self) -> DataFrame:
        return reorder.latest_inventory(self.fct_inventory)

    @cached_property
    def trend(self) -> DataFrame:
        return forecast.trend_forecast(self.series)

    @cached_property
    def trend_metadata(self) -> DataFrame:
        accuracies = forecast.accuracy(forecast.trend_backtest(self.series))
        return forecast.model_metadata(self.series, accuracies)

    @cached_property
    def cluster_forecast(self) -> DataFrame:
        return forecast.topdown_forecast(self.trend, self.by_cluster)

    @cached_property
    def recommendations(self) -> DataFrame:
        return reorder.reorder_by_share(self.latest_inventory, self.trend, self.daily_demand)

    @cached_property
    def stored_recommendations(self) -> DataFrame:
        return reorder.reorder_by_cluster(self.latest_inventory, self.trend)

    @cached_property
    def feeds(self) -> dict[str, DataFrame]:
        return dict(self.raw.items())


_shops: weakref.WeakKeyDictionary[SparkSession, dict[str, tuple[Listing, Shop]]] = weakref.WeakKeyDictionary()


def _listing(folder: str) -> Listing | None:
    """The files of a local folder with their sizes and times; None elsewhere."""
    if not os.path.isdir(folder):
        return None
    names = [os.path.join(at, name) for at, _, found in os.walk(folder) for name in found]
    return tuple(sorted((name, (stat := os.stat(name)).st_size, stat.st_mtime_ns) for name in names))


def shop(spark: SparkSession, folder: str) -> Shop:
    """The warehouse over a folder: kept for a session as long as the files of a local folder stay as they are."""
    listing = _listing(folder)
    known = _shops.setdefault(spark, {})
    if listing is None or folder not in known or known[folder][0] != listing:
        known[folder] = listing, Shop(derive_raw(spark, folder), AS_OF, ORDERS_AS_OF)
    return known[folder][1]


def forget() -> None:
    """Drop the kept warehouses, so the next query starts from the files."""
    _shops.clear()


def _versions(snapshot: DataFrame) -> DataFrame:
    """Snapshot columns in the form the version queries share."""
    return snapshot.select(
        "product_id",
        "product_name",
        "category",
        "supplier_id",
        "unit_of_measure",
        "is_active",
        "unit_price",
        "cost_price",
        "gross_margin_pct",
        F.col("valid_from").cast("date").alias("valid_from"),
        F.col("valid_to").cast("date").alias("valid_to"),
    )


def _hard_deletes(s: Shop) -> DataFrame:
    """Products no longer active count as gone from the source."""
    source = s.raw.products.filter("is_active").select("product_id")
    return _versions(price_versions.close_missing(s.product_snapshot, source, "product_id", AS_OF))


def _merged(s: Shop) -> DataFrame:
    """Later price changes folded into the snapshot of the earlier ones."""
    history = s.raw.product_price_history
    split = F.lit(SNAPSHOT_SPLIT.isoformat()).cast("timestamp_ntz")
    earlier = price_versions.close_versions(
        history.filter(F.col("effective_from") < split), "product_id", "effective_from"
    )
    later = history.filter(F.col("effective_from") >= split)
    merged = price_versions.merge_versions(earlier, later, "product_id", "effective_from")
    return _versions(staging.with_product_attributes(merged, s.raw.products))


def _incremental(spark: SparkSession, folder: str) -> DataFrame:
    """A stored snapshot brought up to date by two batches of changes and the list of products still sold."""
    s = shop(spark, folder)
    history = s.raw.product_price_history
    first, second = (F.lit(d.isoformat()).cast("timestamp_ntz") for d in (SNAPSHOT_SPLIT, SECOND_BATCH))
    at = F.col("effective_from")
    store = VersionStore(spark, _new_folder(spark), "product_id", "effective_from", parts=16)
    store.create(history.filter(at < first))
    store.apply(history.filter((at >= first) & (at < second)))
    still_sold = s.raw.products.filter("is_active").select("product_id")
    store.apply(history.filter(at >= second), still_sold, AS_OF)
    return _versions(staging.with_product_attributes(store.versions(), s.raw.products))


def _priced(s: Shop, versions: DataFrame) -> DataFrame:
    columns = ["product_id", "unit_price", "gross_margin_pct", "valid_from", "valid_to"]
    sales = s.stg_sales.select("sale_key", "product_id", "sale_date", F.col("unit_price").alias("pos_unit_price"))
    chosen = versions.select(*columns).withColumnRenamed("unit_price", "version_price")
    joined = price_versions.join_at(sales, chosen, "product_id", "sale_date", AS_OF, by_year=True)
    return joined.select(
        "sale_key", "product_id", "sale_date", "pos_unit_price", "version_price", "gross_margin_pct", "valid_from"
    )


def _overlapping(s: Shop) -> DataFrame:
    """Every version left open, as in a first snapshot run: the overlap is resolved on the versions."""
    left_open = s.stg_products.withColumn("valid_to", F.lit(None).cast("date"))
    narrow = left_open.select("product_id", "unit_price", "gross_margin_pct", "valid_from", "valid_to")
    resolved = price_versions.disjoint_versions(narrow, "product_id", AS_OF)
    return _priced(s, resolved)


def _suite(*kinds: str) -> Callable[[Shop], DataFrame]:
    chosen = [check for check in checks.RAW_SUITE if not kinds or check.expectation in kinds]
    return lambda s: quality.run_checks(s.feeds, chosen, AS_OF)


def _log_lines(s: Shop) -> DataFrame:
    """The check log: one JSON text per result."""
    record = F.to_json(F.struct("expectation", F.col("table_name").alias("table"), F.col("column_name").alias("column"), "passed"))
    return _suite()(s).select(record.alias("record"), "details")


def _profile(s: Shop) -> DataFrame:
    parts = [quality.profile(name, feed) for name, feed in s.feeds.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _keys(s: Shop) -> DataFrame:
    """Surrogate keys over every feed that has one."""
    sales = s.raw.pos_sales.select(surrogate_key("sale_id", "store_id", "product_id", "sale_date").alias("record_key"))
    stock = s.raw.inventory_snapshots.select(
        surrogate_key("store_id", "product_id", "snapshot_date").alias("record_key")
    )
    versions = s.stg_products.select(F.col("product_version_key").alias("record_key"))
    keyed = sales.withColumn("feed", F.lit("pos_sales")).unionByName(stock.withColumn("feed", F.lit("inventory_snapshots")))
    return keyed.unionByName(versions.withColumn("feed", F.lit("product_price_history")))


def _planning(s: Shop) -> DataFrame:
    return planning.planning_quantity(
        s.cluster_forecast,
        s.trend_metadata,
        planning.recent_cluster_demand(s.by_cluster),
        planning.recent_stockouts(s.fct_inventory),
    )


def _open_week_rates(s: Shop) -> DataFrame:
    return planning.open_week_rates(s.stg_inventory, s.stg_sales, stores=s.dim_stores, products=current_products(s.dim_products))


def _six_places(df: DataFrame) -> DataFrame:
    """Forecast numbers to six decimals, for comparison between engines."""
    rounded = {f.name: F.round(f.name, 6) for f in df.schema if f.dataType.typeName() == "double"}
    return df.withColumns(rounded)


def _additive_metadata(s: Shop) -> DataFrame:
    accuracies = forecast.accuracy(forecast.additive_backtest(s.series, HOLIDAY_YEARS))
    return forecast.model_metadata(s.series, accuracies)


_BY_SHOP: dict[str, Callable[[Shop], DataFrame]] = {
    "raw_row_counts": lambda s: raw_feeds.row_counts(s.feeds),
    "load_spot_checks": checks.load_spot_checks,
    "stockout_rate": checks.stockout_rate,
    "price_change_products": checks.repriced_products,
    "surrogate_key": _keys,
    "stg_stores": lambda s: s.stg_stores,
    "stg_suppliers": lambda s: s.stg_suppliers,
    "stg_products": lambda s: s.stg_products,
    "stg_inventory": lambda s: s.stg_inventory,
    "stg_purchase_orders": lambda s: s.stg_purchase_orders,
    "stg_sales": lambda s: s.stg_sales,
    "scd2_prices": lambda s: _versions(s.product_snapshot),
    "scd2_merge": _merged,
    "scd2_hard_deletes": _hard_deletes,
    "dim_stores": lambda s: s.dim_stores,
    "dim_products": lambda s: s.dim_products,
    "asof_price_join": lambda s: _priced(s, s.dim_products),
    "asof_price_overlap": _overlapping,
    "fct_sales": lambda s: s.fct_sales,
    "fct_inventory": lambda s: s.fct_inventory,
    "fct_purchase_orders": lambda s: s.fct_purchase_orders,
    "fct_stockouts": lambda s: s.fct_stockouts,
    "dq_profile": _profile,
    "dq_not_null": _suite(quality.NO_NULLS),
    "dq_unique": _suite(quality.UNIQUE),
    "dq_accepted_values": _suite(quality.ACCEPTED),
    "dq_between": _suite(quality.BETWEEN),
    "dq_row_count": _suite(quality.ROW_COUNT),
    "dq_referential": _suite(quality.REFERENCE),
    "dq_freshness": _suite(quality.FRESH),
    "dq_source_freshness": lambda s: quality.source_freshness(s.feeds, checks.LOADED_AT, AS_OF),
    "dq_suite_raw": _suite(),
    "dq_results": _log_lines,
    "dq_summary": lambda s: quality.summarise(_suite()(s)),
    "dq_suite_models": checks.model_test_results,
    "anomaly_volume": checks.volume_anomalies,
    "anomaly_column": checks.column_anomalies,
    "anomaly_drift": checks.distribution_drift,
    "weekly_demand": lambda s: s.weekly_demand,
    "series_profile": lambda s: demand.series_profile(s.weekly_demand),
    "forecast_eligibility": lambda s: demand.eligibility(s.series),
    "holiday_features": lambda s: forecast.holiday_features(s.series, HOLIDAY_YEARS),
    "forecast_future_frame": lambda s: forecast.future_frame(s.series),
    "forecast_future_mondays": lambda s: forecast.future_frame(s.series, anchor="monday"),
    "forecast_trend": lambda s: _six_places(s.trend),
    "forecast_trend_backtest": lambda s: _six_places(forecast.trend_backtest(s.series)),
    "forecast_topdown": lambda s: _six_places(s.cluster_forecast),
    "forecast_summary": lambda s: _six_places(forecast.forecast_summary(s.cluster_forecast)),
    "forecast_window": lambda s: _six_places(forecast.forecast_window(s.trend, "fresh_produce", FORECAST_FROM)),
    "forecast_accuracy": lambda s: forecast.graded_accuracy(s.trend_metadata),
    "forecast_failure_modes": lambda s: s.trend_metadata.select("category", "failure_modes"),
    "model_performance": lambda s: forecast.model_performance(s.trend_metadata),
    "planning_quantity": lambda s: _six_places(_planning(s)),
    "planning_products": lambda s: _six_places(planning.planning_products(s.trend, s.trend_metadata, _open_week_rates(s))),
    "forecast_additive": lambda s: forecast.additive_forecast(s.series, holiday_years=HOLIDAY_YEARS),
    "forecast_backtest": lambda s: _six_places(forecast.additive_backtest(s.series, HOLIDAY_YEARS)),
    "forecast_metadata": _additive_metadata,
    "latest_inventory": lambda s: s.latest_inventory,
    "reorder_literal": lambda s: s.stored_recommendations,
    "reorder_topdown": lambda s: s.recommendations,
    "top_reorders": lambda s: reorder.top_reorders(s.recommendations),
    "urgent_orders": lambda s: reorder.urgent_orders(s.recommendations),
    "urgent_orders_planner": lambda s: reorder.urgent_orders_planner(s.recommendations),
    "dashboard_weekly": lambda s: dashboard.weekly_chart(s.weekly_sales),
    "forecast_series": lambda s: dashboard.forecast_series(s.weekly_sales, s.trend),
    "inventory_status_counts": lambda s: dashboard.status_counts(s.latest_inventory),
    "stockout_heatmap": lambda s: dashboard.stockout_heatmap(s.latest_inventory),
    "reorder_counts": lambda s: dashboard.reorder_counts(s.recommendations),
    "reorder_urgency": lambda s: dashboard.reorder_urgency(s.recommendations),
    "reorder_urgency_literal": lambda s: dashboard.reorder_urgency(s.stored_recommendations),
    "seasonal_profile": lambda s: dashboard.seasonal_profile(s.fct_sales),
    "seasonal_grid": lambda s: dashboard.seasonal_grid(dashboard.seasonal_profile(s.fct_sales)),
    "kpi_summary": lambda s: dashboard.kpi_summary(s.latest_inventory, s.recommendations, s.trend_metadata),
    "cat_active_stores_by_state": lambda s: catalogue.active_stores_by_state(s.dim_stores),
    "cat_metro_split": lambda s: catalogue.metro_split(s.dim_stores),
    "cat_current_products": lambda s: catalogue.current_catalogue(s.dim_products),
    "cat_multi_price_products": lambda s: catalogue.multi_price_products(s.dim_products),
    "cat_stockouts_by_category": lambda s: catalogue.stockouts_by_category(s.latest_inventory),
    "cat_critical_stores": lambda s: catalogue.critical_stores(s.latest_inventory),
}


CREATED_AT = "2001-12-01T06:00:00"


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/sink-{uuid.uuid4().hex}"


def _loaded(spark: SparkSession, folder: str) -> Shop:
    """A warehouse over the feeds written as files and loaded with their declared types."""
    target = _new_folder(spark)
    for name, feed in shop(spark, folder).feeds.items():
        declared = spark.createDataFrame([], RAW_SCHEMAS[name])
        typed = feed.select(*[F.col(f.name).cast(f.dataType) for f in declared.schema if f.name in feed.columns])
        typed.write.parquet(f"{target}/{name}.parquet")
    return Shop(raw_feeds.load_raw(spark, target), AS_OF, ORDERS_AS_OF)


def _loaded_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Staged sales over loaded files: money arrives as DOUBLE."""
    return _loaded(spark, folder).stg_sales.select(
        "sale_key", "sale_id", "sale_year", "sale_month", "sale_dow", "is_weekend", "quantity", "has_price_discrepancy"
    )


def _written_marts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every mart, counted on the written tables."""
    return raw_feeds.row_counts(shop(spark, folder).write_marts(_new_folder(spark)))


def _published_marts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every mart as readers see it after a good run and a later one whose stores are doubled."""
    good = shop(spark, folder)
    twice = RawTables(**{name: (lambda feed=feed: feed) for name, feed in (good.feeds | {"stores": good.raw.stores.unionByName(good.raw.stores)}).items()})
    publication = Publication(spark, _new_folder(spark))
    first = good.publish_marts(publication, "first", checks.mart_gate)
    second = Shop(twice, AS_OF, ORDERS_AS_OF).publish_marts(publication, "second", checks.mart_gate)
    rows = raw_feeds.row_counts({name: publication.table(name) for name in checks.MART_TESTS})
    run = publication.current()
    return rows.select(
        "*", F.lit(run).alias("published_run"), F.lit(not first).alias("first_passed"), F.lit(", ".join(sorted(f"{r.column_name} {r.test}" for r in second))).alias("second_failed")
    )


def _history(spark: SparkSession, folder: str) -> DataFrame:
    """Volumes recorded by two runs: the first misses late rows of its last days, the second measures from there on."""
    s = shop(spark, folder)
    history = MetricHistory(spark, _new_folder(spark))
    split = F.lit(HISTORY_SPLIT.isoformat()).cast("date")
    late_from = HISTORY_SPLIT - timedelta(days=LATE_DAYS)

    # Weekly buckets begin on a Monday.
    since = late_from - timedelta(days=late_from.weekday())

    def on_time(rows: DataFrame, at: str) -> Column:
        day = F.col(at).cast("date")
        late = (day >= F.lit(late_from.isoformat()).cast("date")) & (F.pmod(F.xxhash64(*rows.columns), F.lit(5)) == 0)
        return (day < split) & ~late

    def again(rows: DataFrame, at: str) -> Column:
        return F.col(at).cast("date") >= F.lit(since.isoformat()).cast("date")

    # Both runs are measured in one pass over the feeds; a row per run, model and bucket is kept.
    kept = _new_folder(spark)
    checks.volumes(s, {1: on_time, 2: again}).write.parquet(kept)
    measured = spark.read.parquet(kept)
    history.record(1, date(1970, 1, 1), measured.filter("run = 1").drop("run"))
    history.record(2, since, measured.filter("run = 2").drop("run"))
    return history.scored().drop("column_name", "metric")


def _stamped(build: Callable[[Shop], DataFrame]) -> Query:
    return lambda spark, folder: sinks.write_stamped(build(shop(spark, folder)), _new_folder(spark), CREATED_AT)


def _check_log(spark: SparkSession, folder: str) -> DataFrame:
    log = sinks.write_check_log(_suite()(shop(spark, folder)), _new_folder(spark), CREATED_AT)
    return log.select("expectation", "table_name", "column_name", "passed", "run_at", "passed_total", "failed_total")


#: Queries that write tables under the shared folder and return what is read back from there.
WRITING: dict[str, Query] = {
    "load_raw_counts": lambda spark, folder: raw_feeds.row_counts(_loaded(spark, folder).feeds),
    "load_raw_sales": _loaded_sales,
    "scd2_incremental": _incremental,
    "write_marts": _written_marts,
    "publish_marts": _published_marts,
    "anomaly_history": _history,
    "write_forecasts": _stamped(lambda s: _six_places(s.trend)),
    "write_metadata": _stamped(lambda s: forecast.model_performance(s.trend_metadata)),
    "write_recommendations": _stamped(lambda s: s.recommendations),
    "write_check_log": _check_log,
}


def _bind(build: Callable[[Shop], DataFrame]) -> Query:
    return lambda spark, folder: build(shop(spark, folder))


QUERIES: dict[str, Query] = {
    "asset_discovery": raw_feeds.discover_assets,
    **{name: _bind(build) for name, build in _BY_SHOP.items()},
    **WRITING,
}
