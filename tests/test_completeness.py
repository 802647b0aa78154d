"""Nothing is dropped without a trace; building a query runs no job; calendars and exact arithmetic."""

from datetime import date, datetime

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from larderline import registry
from larderline.functions import labels
from larderline.functions.columns import rounded_ratio
from larderline.operators import anomaly, price_versions, quality as q
from larderline.plans import dashboard, forecast

AS_OF = date(2023, 12, 31)


def test_model_tests_of_every_kind(spark):
    rows = [("a", "x", date(2023, 12, 1)), ("a", "y", date(2023, 12, 2)), ("b", "y", None)]
    t = spark.createDataFrame(rows, "k string, l string, d date")
    tests = [q.unique("t", "k"), q.unique("t", "l"), q.row_count_between("t", 5, 9), q.fresh("t", "d", 10), q.fresh("t", "d", 40)]
    out = q.run_model_tests("mart", "t", t, tests, {}, AS_OF).collect()
    assert sorted((r["test"], r["column_name"], r["failures"], r["passed"]) for r in out) == [
        ("freshness", "d", 1, False),
        ("row_count", "*", 1, False),
        ("unique", "k", 1, False),
        ("unique", "l", 1, False),
    ]
    with pytest.raises(ValueError, match="no such test"):
        q.run_model_tests("mart", "t", t, [q.Check("expect_magic", "t", "k")], {})
    with pytest.raises(ValueError, match="as_of"):
        q.run_model_tests("mart", "t", t, [q.fresh("t", "d", 1)], {})


def test_metrics_keep_fractions_of_any_type(spark):
    rows = [(date(2023, 1, 1), 2.7, 1), (date(2023, 1, 1), 0.3, 2)]
    t = spark.createDataFrame(rows, "d date, v double, n int").withColumn("m", F.col("v").cast("decimal(10,3)"))
    metrics = [anomaly.Metric(c, kind) for c in ("v", "m", "n") for kind in ("sum", "max", "average")]
    got = {(r["column_name"], r["metric"]): r["units"] for r in anomaly.bucket_metrics("t", t, "d", "day", metrics).collect()}
    assert [got["v", k] for k in ("sum", "max", "average")] == [30000, 27000, 15000]
    assert [got["m", k] for k in ("sum", "max", "average")] == [30000, 27000, 15000]
    assert [got["n", k] for k in ("sum", "max", "average")] == [30000, 20000, 15000]


def test_unlisted_categories_and_clusters_are_carried(spark):
    weekly = spark.createDataFrame([(date(2023, 1, 2), "toys", 5), (date(2023, 1, 2), None, 7)], "week_start date, category string, total_quantity bigint")
    ahead = spark.createDataFrame([], "forecast_date date, category string, yhat double, yhat_lower double, yhat_upper double")
    got = {r["category"]: r["history_units"] for r in dashboard.forecast_series(weekly, ahead).collect()}
    assert got == {c: 0 for c in labels.CATEGORIES} | {"toys": 5, None: 7}
    rows = [("toys", "mars", "stockout"), ("toys", None, "ok"), ("toys", labels.CLUSTERS[0], "ok")]
    grid = dashboard.stockout_heatmap(spark.createDataFrame(rows, "category string, store_cluster string, stock_status string")).first()
    assert grid["other"] == 50.0 and grid[labels.CLUSTERS[0]] == 0.0


def test_a_late_change_splits_the_version_it_falls_into(spark):
    day = lambda d: datetime(2023, 1, d)
    schema = "k string, at timestamp_ntz, price int"
    first = price_versions.close_versions(spark.createDataFrame([("p", day(1), 1), ("p", day(20), 3)], schema), "k", "at")
    late = spark.createDataFrame([("p", day(10), 2), ("p", day(20), 9), ("q", day(5), 4)], schema)
    got = sorted((r["k"], r["valid_from"], r["valid_to"], r["price"]) for r in price_versions.merge_versions(first, late, "k", "at").collect())
    assert got == [("p", day(1), day(10), 1), ("p", day(10), day(20), 2), ("p", day(20), None, 3), ("q", day(5), None, 4)]


@pytest.mark.parametrize("year,sunday", [(1996, (4, 7)), (2001, (4, 15)), (2000, (4, 23)), (2008, (3, 23)), (2023, (4, 9)), (2038, (4, 25))])
def test_movable_holidays(year, sunday):
    assert forecast.easter_sunday(year) == date(year, *sunday)
    days = {n: d for n, k, d in forecast.holiday_days([year]) if k == 0}
    assert (date(year, *sunday) - days["Good Friday"]).days == 2 and days["Queen's Birthday"].isocalendar()[2] == 1
    if year == 2023:
        assert days == dict(forecast.HOLIDAYS)


def test_ratios_of_sums_beyond_a_long(spark):
    t = spark.range(1).select(F.lit(9_000_000_000_000_000_000).alias("a"), F.lit(3).alias("b"))
    t = t.select(F.col("a").cast("decimal(38,0)").alias("a"), "b")
    assert t.select(rounded_ratio(F.col("a"), F.lit(4_000_000_000_000_000_000).cast("bigint"), 4)).first()[0] == 22500
    negative = spark.range(1).select(F.lit(-7).alias("a"), F.lit(2).alias("b"))
    assert negative.select(rounded_ratio(F.col("a"), F.col("b"))).first()[0] == -4


def test_building_queries_runs_no_job(spark):
    """Schemas of the tables are read before; then no query object starts a job."""
    registry.forget()
    tracker = spark.sparkContext.statusTracker()
    registry.QUERIES["stg_stores"](spark, SMALL)
    for name, build in registry.QUERIES.items():
        if name == "asset_discovery" or name in registry.WRITING:  # these write when they are called
            continue
        spark.sparkContext.setJobGroup(f"build {name}", name)
        build(spark, SMALL)
        jobs = tracker.getJobIdsForGroup(f"build {name}")
        # A first read of a table's files looks at their schema: one job of one task.
        for job in jobs:
            stages = [tracker.getStageInfo(s) for s in tracker.getJobInfo(job).stageIds]
            assert all(s is None or "parquet at" in s.name for s in stages), (name, [s.name for s in stages])
    spark.sparkContext.setJobGroup("", "")


def test_averages_of_stockouts_need_no_version_join(spark):
    text = registry.QUERIES["fct_stockouts"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    below = text[text.index("revenue_cents"):] if "revenue_cents" in text else ""
    averages = below.split("Aggregate [store_id", 1)[-1]
    assert below and "valid_from" not in averages


def test_weeks_with_an_empty_shelf_do_not_count_as_demand(spark):
    from larderline.plans import planning

    monday = lambda w: date(2023, 1, 2 + 7 * w)
    stock = [("S1", "P1", w, w in (2, 3)) for w in range(4)] + [("S2", "P1", w, False) for w in range(4)] + [("S1", "P2", w, True) for w in range(4)]
    inventory = spark.createDataFrame([(s, p, monday(w), out, "dairy", "rural" if s == "S2" else "suburban") for s, p, w, out in stock],
                                      "store_id string, product_id string, snapshot_date date, is_stockout boolean, category string, store_cluster string")
    sales = [("S1", "P1", 0, 10), ("S1", "P1", 1, 20), ("S1", "P1", 3, 1), ("S2", "P1", 0, 20), ("S2", "P1", 2, 20), ("S1", "P2", 0, 3)]
    sold = spark.createDataFrame([(s, p, date(2023, 1, 4 + 7 * w), q_) for s, p, w, q_ in sales], "store_id string, product_id string, sale_date date, quantity int")
    rates = {(r.store_id, r.product_id): r for r in planning.open_week_rates(inventory, sold, recent_weeks=1).collect()}
    assert [(rates[k].open_weeks, rates[k].masked_weeks, rates[k].weekly_rate) for k in (("S1", "P1"), ("S2", "P1"), ("S1", "P2"))] == [(2, 2, 15.0), (4, 0, 10.0), (0, 4, None)]
    assert rates["S1", "P1"].had_stockout and rates["S1", "P1"].recent_units == 1.0 and not rates["S2", "P1"].had_stockout
    ahead = spark.createDataFrame([("dairy", 100.0, 200.0)], "category string, yhat double, yhat_upper double")
    meta = spark.createDataFrame([("dairy", 30.0)], "category string, mape double")
    plan = planning.planning_products(ahead, meta, planning.open_week_rates(inventory, sold, recent_weeks=1))
    got = {(r.store_id, r.product_id): (r.rule, r.planned_weekly_units) for r in plan.collect()}
    assert got["S1", "P1"] == ("recent_stockout", pytest.approx(200 * 0.6 * 1.15))
    assert got["S2", "P1"] == ("point_forecast", pytest.approx(100 * 0.4 * 2)) and got["S1", "P2"] == ("recent_stockout", None)


def test_a_changed_folder_is_read_anew(spark, tmp_path):
    import os
    import shutil

    folder = str(tmp_path / "tables")
    os.mkdir(folder)
    for name in ("region", "nation", "supplier", "part", "customer", "orders", "lineitem"):
        shutil.copy(f"{SMALL}/{name}.parquet", folder)
    first = registry.shop(spark, folder)
    assert registry.shop(spark, folder) is first and first.raw.suppliers.count() > 3
    os.remove(f"{folder}/supplier.parquet")
    spark.read.parquet(f"{SMALL}/supplier.parquet").limit(3).write.parquet(f"{folder}/supplier.parquet")
    assert registry.shop(spark, folder).raw.suppliers.count() == 3


def test_optional_queries_may_be_absent():
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    blocked = "import sys; sys.modules['larderline.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    made = subprocess.run([sys.executable, "-c", blocked], cwd=root, capture_output=True, text=True)
    assert made.stdout.split() == [str(len(registry.QUERIES))] * 2
