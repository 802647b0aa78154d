"""Marts, forecasts and reorders on hand-made rows; raw loading and mart writing."""

import json
from datetime import date, timedelta

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from larderline import registry
from larderline.functions.columns import rounded_ratio
from larderline.plans import demand, forecast, reorder
from larderline.sources import raw, sinks

MONDAY = date(2023, 1, 2)


def series(spark, values, category="dairy"):
    rows = [(MONDAY + timedelta(days=7 * i), category, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "week_start date, category string, total_quantity bigint")


def test_rounded_ratio_is_exact_half_away(spark):
    cases = [(1, 8, 2), (-1, 8, 2), (5, 2, 0), (1, 3, 3), (7, 0, 1), (2675, 1000, 2)]
    got = [spark.range(1).select(rounded_ratio(F.lit(a), F.lit(b), d)).first()[0] for a, b, d in cases]
    assert got == [13, -13, 3, 333, None, 268]


def test_eligibility_reasons(spark):
    short = series(spark, [1] * 20, "bakery")
    sparse = series(spark, [0 if i % 2 else 3 for i in range(40)], "pantry")
    good = series(spark, [5 + i % 3 for i in range(40)], "dairy")
    weekly = short.unionByName(sparse).unionByName(good)
    out = {r["category"]: r for r in demand.eligibility(weekly).collect()}
    assert out["bakery"]["reason"] == "Only 20 weeks of history"
    assert out["pantry"]["reason"] == "Too many zero weeks (50%) — sparse data"
    assert out["dairy"]["status"] == "eligible" and out["dairy"]["reason"] is None
    assert {r["category"] for r in forecast.trend_forecast(weekly).select("category").distinct().collect()} == {"dairy"}


def test_future_days_and_folds(spark):
    weekly = series(spark, [10 + i for i in range(52)])
    sundays = [r["forecast_date"] for r in forecast.future_frame(weekly).orderBy("step").collect()]
    assert sundays[0] == date(2023, 12, 31) and sundays[-1] == date(2024, 3, 17) and len(sundays) == 12
    mondays = [r["forecast_date"] for r in forecast.future_frame(weekly, anchor="monday").orderBy("step").collect()]
    assert mondays[0] == date(2024, 1, 1)
    cutoffs = {r["cutoff"] for r in forecast.folds(weekly).select("cutoff").distinct().collect()}
    assert cutoffs == {date(2023, 11, 27), date(2023, 10, 30)}


def test_line_forecast_is_exact_and_capped(spark):
    out = forecast.trend_forecast(series(spark, [10 + 2 * i for i in range(52)]), anchor="monday")
    rows = out.orderBy("forecast_date").collect()
    assert rows[0]["yhat"] == pytest.approx(10 + 2 * 52) and rows[0]["yhat_lower"] == pytest.approx(rows[0]["yhat"])
    falling = forecast.trend_forecast(series(spark, [max(0, 100 - 4 * i) + 1 for i in range(52)]))
    assert all(r["yhat"] >= 0 and r["yhat_upper"] <= 3 * 101 for r in falling.collect())


def test_models_follow_a_clean_series(spark):
    weekly = series(spark, [1000 + 3 * i for i in range(104)])
    errors = forecast.accuracy(forecast.additive_backtest(weekly)).first()
    assert errors["n_folds"] >= 10 and errors["mape"] < 10
    assert forecast.accuracy(forecast.trend_backtest(weekly)).first()["mape"] == 0.0
    ahead = forecast.additive_forecast(weekly).collect()
    assert len(ahead) == 12 and all(r["yhat_lower"] <= r["yhat"] <= r["yhat_upper"] for r in ahead)


def test_metadata_of_a_short_history(spark):
    weekly = series(spark, [5 + i % 4 for i in range(30)], "fresh_produce")
    meta = forecast.model_metadata(weekly, forecast.accuracy(forecast.trend_backtest(weekly))).first()
    assert meta["cv_status"].startswith("failed") and meta["mape"] is None
    assert json.loads(meta["failure_modes"]) == [
        "Limited history (30 weeks). Higher uncertainty.",
        "Fresh produce sensitive to weather/promotions not in model.",
    ]


INVENTORY = (
    "store_id string, product_id string, product_name string, supplier_name string, category string, "
    "store_cluster string, quantity_on_hand int, stock_status string, days_of_stock_remaining double, "
    "lead_time_days int, avg_weekly_forecast double, forecast_upper_avg double"
)


def test_reorder_rules(spark):
    def row(name, stock, status, lead, avg, upper):
        return ("S", name, name, "sup", "dairy", "rural", stock, status, 1.0, lead, avg, upper)

    rows = [
        row("no_forecast_low", 3, "low", 7, None, None),
        row("no_forecast_out", 0, "stockout", 7, None, None),
        row("enough", 100, "healthy", 7, 14.0, 21.0),
        row("short", 14, "healthy", 7, 14.0, 21.0),
        row("out", 0, "stockout", 7, 14.0, 21.0),
        row("no_lead", 0, "stockout", None, 14.0, 21.0),
    ]
    inventory = spark.createDataFrame(rows, INVENTORY)
    out = {r["product_id"]: r for r in reorder.recommend(inventory, reorder.DOCUMENTED_MULTIPLIERS).collect()}
    assert not out["no_forecast_low"]["should_reorder"]
    assert out["no_forecast_out"]["should_reorder"] and out["no_forecast_out"]["recommended_order_qty"] == 0
    assert not out["enough"]["should_reorder"]
    assert out["short"]["should_reorder"] and out["short"]["recommended_order_qty"] == 42
    assert out["out"]["safety_stock"] == 10.5 and out["out"]["recommended_order_qty"] == 66
    assert out["no_lead"]["should_reorder"] and out["no_lead"]["recommended_order_qty"] == 0


def test_load_round_trip_and_missing_feeds(spark, tmp_path):
    feeds = registry.shop(spark, SMALL).raw
    folder = str(tmp_path)
    for name in ("stores", "suppliers"):
        getattr(feeds, name).write.parquet(f"{folder}/{name}.parquet")
    status = {r["table_name"]: (r["status"], r["row_count"]) for r in raw.load_status(spark, folder).collect()}
    assert status["stores"] == ("loaded", 25) and status["pos_sales"] == ("missing", None) and len(status) == 7
    with pytest.raises(FileNotFoundError, match="pos_sales"):
        raw.load_raw(spark, folder)
    assets = {r["asset"]: r["row_count"] for r in raw.discover_assets(spark, folder).collect()}
    assert assets == {"stores": 25, "suppliers": 10}


def test_written_marts_equal_lazy_ones(spark, tmp_path):
    shop = registry.shop(spark, SMALL)
    written = shop.write_marts(str(tmp_path))
    for name in ("fct_sales", "fct_inventory", "fct_stockouts", "dim_products"):
        lazy = getattr(shop, name)
        stored = written[name].select(*lazy.columns)
        assert stored.count() == lazy.count()
        assert stored.exceptAll(lazy).isEmpty()


def test_check_log(spark, tmp_path):
    results = registry.QUERIES["dq_row_count"](spark, SMALL)
    sinks.write_check_log(results, f"{tmp_path}/log", "2001-12-01T00:00:00")
    assert spark.read.json(f"{tmp_path}/log").count() == 6


def test_fitted_model_queries_cover_every_category(spark):
    assert registry.QUERIES["forecast_additive"](spark, SMALL).count() == 96
    assert registry.QUERIES["forecast_metadata"](spark, SMALL).filter("cv_status = 'success'").count() == 8
