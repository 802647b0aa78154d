"""What keeps large inventories cheap: few exchanges of weekly rows, narrow rows in those that stay."""

from datetime import date, datetime

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from larderline import registry
from larderline.functions.columns import rounded_ratio
from larderline.operators import joins, prints, quality
from larderline.operators.joins import sharing_left_join, splittable_left_join
from larderline.operators.reuse import read_whole
from larderline.plans import checks, facts, planning
from larderline.sources.raw import RawTables
from larderline.sources.schemas import RAW_SCHEMAS
from larderline.sources.sinks import CLEANUP, WRITERS, write_mart
from tests_plan import plan, settings


def test_pairs_are_dealt_out_before_their_weeks(spark):
    registry.forget()
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(registry.QUERIES["stg_inventory"](spark, SMALL))
        whole = plan(registry.QUERIES["fct_inventory"](spark, SMALL))
    weeks = text.index("Generate explode(org.apache.spark.sql.catalyst.expressions.UnsafeArrayData")
    assert "Exchange" not in text[:weeks] and "Exchange hashpartitioning(store_id" in text[weeks:]
    # Keys are made after the last exchange.
    assert whole.index("md5") < whole.index("Exchange")


def test_weekly_stock_meets_many_products_where_it_is(spark):
    registry.forget()
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(registry.QUERIES["fct_inventory"](spark, SMALL))
    weeks = text.index("Generate explode(org.apache.spark.sql.catalyst.expressions.UnsafeArrayData")
    assert "Exchange" not in text[text.index("SortMergeJoin [product_id") : weeks]
    registry.forget()


@pytest.mark.parametrize("feed", ["derived", "given"])
def test_stock_put_together_by_product_gives_the_same_rows(spark, feed):
    registry.forget()
    shop = registry.shop(spark, SMALL)
    if feed == "derived":
        raw, stores, products = shop.raw, shop.dim_stores, shop.dim_products
    else:
        at = lambda w: datetime(2023, 1, 2 + 7 * w)
        rows = [("S1", "P1", at(0), 5), ("S1", "P1", at(1), 0), ("S1", "P1", at(1), 0), ("S2", "P1", at(0), None), ("S1", "P2", at(0), 3), ("S9", "P9", at(0), 1)]
        rows += [(None, "P1", at(0), 4), ("S1", None, at(0), 6), ("S2", None, at(1), 7), (None, None, at(0), 8)]
        stock = spark.createDataFrame([(*r, 4, 9) for r in rows], "store_id string, product_id string, snapshot_date timestamp_ntz, quantity_on_hand bigint, reorder_point bigint, reorder_qty bigint")
        raw = RawTables(**{name: stock if name == "inventory_snapshots" else spark.range(0) for name in RAW_SCHEMAS})
        stores = spark.createDataFrame([("S1", "rural", "NSW", False), ("S2", "rural", "VIC", False), ("S2", "rural", "VIC", True)], "store_id string, store_cluster string, state string, is_metro boolean")
        products = spark.createDataFrame([("P1", "milk", 7, True), ("P1", "milk", 7, True), ("P1", "old", 7, False), ("P2", "tea", None, True)], "product_id string, product_name string, lead_time_days int, is_current_version boolean")
        products = products.withColumns({"category": F.lit("dairy"), "perishability": F.lit("Perishable"), "supplier_name": F.lit("s"), "cost_price": F.lit("1.25").cast("decimal(10,2)")})
    apart = facts.fct_inventory(raw.inventory_snapshots, stores, products)
    together = facts.fct_inventory(raw.together("inventory_snapshots", "product_id"), stores, products, by_product=True)
    assert together.schema == apart.schema
    assert together.exceptAll(apart).isEmpty() and apart.exceptAll(together).isEmpty() and not apart.isEmpty()


def test_weeks_meet_sales_without_an_exchange_of_their_own(spark):
    registry.forget()
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        text = plan(registry._open_week_rates(registry.shop(spark, SMALL)))
    join = next(line for line in text.splitlines() if "Join [store_id" in line and ", product_id" in line)
    assert "week_start" not in join
    left = text[text.index(join):].split("Generate", 1)[0]
    assert "Exchange hashpartitioning" not in left


def test_pairs_get_their_labels_after_the_weeks_are_summed(spark):
    day = lambda w: date(2023, 1, 2 + 7 * w)
    stock = spark.createDataFrame([("S1", "P1", day(0), False), ("S1", "P1", day(0), True), ("S1", "P1", day(1), False), ("S2", "P9", day(1), False), (None, "P1", day(1), False)],
                                  "store_id string, product_id string, snapshot_date date, is_stockout boolean")
    sold = spark.createDataFrame([("S1", "P1", day(0), 5), ("S1", "P1", day(1), 3), ("S1", "P1", day(1), 4)], "store_id string, product_id string, sale_date date, quantity int")
    stores = spark.createDataFrame([("S1", "rural"), ("S1", "rural")], "store_id string, store_cluster string")
    products = spark.createDataFrame([("P1", "dairy"), ("P1", "dairy"), ("P1", "bakery")], "product_id string, category string")
    columns = ["store_id", "product_id", "category", "store_cluster", "open_weeks", "masked_weeks", "recent_units", "had_stockout", "weekly_rate"]
    wide = stock.join(stores, "store_id", "left").join(products, "product_id", "left")
    late = planning.open_week_rates(stock, sold, 1, stores=stores, products=products).select(columns).collect()
    early = planning.open_week_rates(wide, sold, 1).select(columns).collect()
    assert sorted(map(str, late)) == sorted(map(str, early)) and len(late) == 5
    assert {(r.open_weeks, r.masked_weeks, r.weekly_rate) for r in late if r.store_id == "S1"} == {(1, 1, 7.0)}


def test_forecast_totals_and_shares_read_one_plan_of_demand(spark):
    registry.forget()
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(registry.QUERIES["reorder_topdown"](spark, SMALL))
    lines = text.splitlines()
    priced = [x for x in lines if "- Exchange hashpartitioning(product_id" in x and "year(sale_date" in x]
    assert len(priced) == 1
    # Stock is not moved by its few categories.
    assert "BroadcastHashJoin [category" in text


def test_null_keys_meet_nothing_in_a_shared_lookup(spark):
    keys = [("a", 1), ("a", None), (None, 1), (None, None), ("b", 2), ("b", 2)]
    facts = spark.createDataFrame([(*k, i) for i, k in enumerate(keys)], "k string, n int, i int")
    lookup = spark.createDataFrame([(*k, 10 * i) for i, k in enumerate(keys[:5])], "k string, n int, v int")
    one, other = (join(facts, lookup, ["k", "n"]) for join in (sharing_left_join, splittable_left_join))
    assert sorted(one.select("k", "n", "i", "v").collect(), key=str) == sorted(other.select("k", "n", "i", "v").collect(), key=str)
    assert {r.i: r.v for r in one.collect()} == {0: 0, 1: None, 2: None, 3: None, 4: 40, 5: 40}


def test_digests_are_counted_as_bytes(spark):
    values = ["00ff", "00ff", "00FF", "0ff", "", "x", "x", None, None, "12"]
    t = spark.createDataFrame([(v,) for v in values], "k string")
    parent = spark.createDataFrame([("00ff",), ("x",)], "k string")
    counted = quality.counted_once(t, {}, {}, {"k": quality.Keyed("k", parent, "k")})
    got = counted.first()
    assert (got.n, got.k_repeated, got.k_null_repeated, got.k_lost, got.k_parent_null) == (10, 3, 1, 4, False)
    assert "unhex" in counted._jdf.queryExecution().optimizedPlan().toString()


def test_marts_are_written_with_an_entropy_code(spark, tmp_path):
    rows = spark.range(50).select(F.md5(F.col("id").cast("string")).alias("key"), (F.col("id") % 3).alias("day"))
    assert write_mart(rows, f"{tmp_path}/a", "day").count() == write_mart(rows, f"{tmp_path}/b").count() == 50
    files = list(tmp_path.rglob("*.parquet"))
    assert files and all("zstd" in f.name for f in files)


@pytest.mark.parametrize("kind", ["bigint", "decimal(38,0)"])
def test_ratios_are_exact_in_64_bits_and_beyond(spark, kind):
    rows = [(1, 2), (-1, 2), (1, -2), (25, 1000), (2**62, 3), (-(2**63), 7), (2**57, 3), (5, 0), (None, 1)]
    ratios = spark.createDataFrame(rows, "n bigint, d bigint").select(rounded_ratio(F.col("n").cast(kind), F.col("d"), 0).alias("r"))

    def expected(n, d):
        if n is None or not d:
            return None
        size = (2 * abs(n) + abs(d)) // (2 * abs(d))
        return size if (n < 0) == (d < 0) else -size

    assert [r.r for r in ratios.collect()] == [expected(n, d) for n, d in rows]
    assert "WHEN" in ratios._jdf.queryExecution().optimizedPlan().toString()


def test_sale_keys_are_made_after_the_exchanges(spark):
    registry.forget()
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(registry.QUERIES["fct_sales"](spark, SMALL))
    assert text.index("md5") < text.index("Exchange")
    registry.forget()


def test_marts_of_many_products_equal_lazy_ones(spark, tmp_path, monkeypatch):
    registry.forget()
    with monkeypatch.context() as as_if_large:
        as_if_large.setattr(joins, "UNPACKED", 10**9)
        written = registry.shop(spark, SMALL).write_marts(str(tmp_path))
    registry.forget()
    shop = registry.shop(spark, SMALL)
    for name in checks.MART_TESTS:
        lazy = getattr(shop, name)
        stored = written[name].select(*lazy.columns)
        assert stored.exceptAll(lazy).isEmpty() and lazy.exceptAll(stored).isEmpty(), name
    # No row of the stock was moved for its day: every task wrote its own file.
    assert max(len(list(day.glob("*.parquet"))) for day in (tmp_path / "fct_inventory").glob("snapshot_date=*")) > 1


def test_a_mart_written_in_place_keeps_its_partitions(spark, tmp_path):
    rows = spark.range(0, 600, 1, 4).select("id", F.md5(F.col("id").cast("string")).alias("key"), (F.col("id") % 20).alias("day"))
    before = {name: spark.conf.get(name, None) for name in (CLEANUP, WRITERS)}
    stored = write_mart(rows, f"{tmp_path}/a", "day", in_place=True)
    assert stored.select("id", "key", F.col("day").cast("bigint")).exceptAll(rows).isEmpty() and stored.count() == 600
    assert {len(list(day.glob("*.parquet"))) for day in (tmp_path / "a").glob("day=*")} == {4}
    assert {name: spark.conf.get(name, None) for name in before} == before


def test_keys_compared_by_prints_are_counted_as_in_one_pass(spark):
    values = ["00ff", "00ff", "00FF", "0ff", "", "", "x", "x", "x", None, None, "12", "1200", " x"]
    rows = [(v, i % 5 if i else None, "only") for i, v in enumerate(values)]
    t = spark.createDataFrame(rows, "k string, i int, hot string").repartition(3)
    parent = spark.createDataFrame([("00ff",), (None,)], "k string")
    keyed = {"k": quality.Keyed("k"), "i": quality.Keyed("i"), "h": quality.Keyed("hot"), "p": quality.Keyed("k", parent, "k")}
    for frame in (t, t.filter("hot = 'none'"), t.select("k", "i", F.lit(None).cast("string").alias("hot"))):
        once, by_prints = (count(frame, {"s": F.lit(1)}, {"m": F.col("i")}, keyed).first().asDict() for count in (quality.counted_once, quality.counted_by_prints))
        assert by_prints == once


def test_prints_leave_out_what_comes_once(spark):
    many = spark.range(0, 200_000, 1, 6).select(F.md5((F.col("id") % 199_990).cast("string")).alias("key"), F.lit("same").alias("hot"))
    found = prints.maybe_repeated(many, ["key"])
    assert found.groupBy("value").count().filter("count > 1").count() == 10
    assert found.count() < 200
    assert prints.maybe_repeated(many, ["key", "hot"]).filter("place = 1").count() == 200_000


def test_inventory_keys_are_not_moved_to_be_compared(spark):
    registry.forget()
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        text = plan(registry.QUERIES["dq_suite_models"](spark, SMALL))
    # Three passes over each of these models: measures, prints, the values that may come twice.
    assert text.count("MapInArrow") >= 2
    registry.forget()


def test_models_of_sales_read_them_once(spark):
    registry.forget()
    with settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(registry.QUERIES["dq_suite_models"](spark, SMALL))
    assert sum("FileScan parquet" in line and "l_orderkey" in line for line in text.splitlines()) == 1
    registry.forget()


def test_a_table_read_whole_is_the_same_table(spark):
    rows = [("a", 1, None), ("a", 1, None), (None, None, None), ("b", 2, 1.5)]
    t = spark.createDataFrame(rows, "k string, i int, x double")
    shared = read_whole(t, "t")
    both = shared.select("k").unionByName(shared.select("i"), allowMissingColumns=True).count()
    assert shared.schema == t.schema and both == 8
    assert shared.exceptAll(t).isEmpty() and t.exceptAll(shared).isEmpty() and read_whole(t.limit(0), "none").isEmpty()
