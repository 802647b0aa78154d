"""Plan shapes that must hold at scale."""

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from larderline import registry
from larderline.operators.joins import splittable_left_join
from larderline.plans import facts


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


@pytest.fixture(autouse=True)
def fresh_queries():
    """A query that was executed prints its finished plan besides the first one."""
    registry.forget()


def test_dedup_limits_groups_before_the_shuffle(spark):
    text = plan(registry.QUERIES["stg_sales"](spark, SMALL))
    above, below = text.split("Exchange hashpartitioning(sale_id", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below


def test_no_cross_joins_and_no_row_at_a_time_python(spark):
    for name in ("fct_sales", "fct_inventory", "reorder_topdown", "forecast_series", "planning_quantity"):
        text = plan(registry.QUERIES[name](spark, SMALL))
        assert "CartesianProduct" not in text and "BatchEvalPython" not in text
        assert not re.search(r"BroadcastNestedLoopJoin", text), name


def test_weekly_demand_reads_sales_once_and_only_needed_columns(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(registry.QUERIES["weekly_demand"](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = [line for line in text.splitlines() if "FileScan parquet" in line and "l_orderkey" in line]
    assert len(scans) == 1 and "l_extendedprice" not in scans[0] and "l_tax" not in scans[0]
    assert "md5" not in text


def test_hot_key_is_split_in_the_average_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.col("id") % 3 == 0
        rows = spark.range(60000, numPartitions=8).select(
            F.when(hot, F.lit("S0")).otherwise(F.concat(F.lit("S"), F.col("id") % 500)).alias("store_id"),
            F.when(hot, F.lit("P0")).otherwise(F.concat(F.lit("P"), F.col("id") % 70)).alias("product_id"),
            (F.col("id") % 11).cast("int").alias("quantity_on_hand"),
            F.sha2(F.col("id").cast("string"), 256).alias("filler"),
        )
        joined = splittable_left_join(rows, facts.stock_levels(rows), facts.STORE_PRODUCT)
        total = joined.agg(F.count("on_hand_sum")).collect()[0][0]
        assert total == 60000
        executed = joined.select("filler", "on_hand_sum")
        executed.collect()
        assert "skew=true" in executed._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["dq_suite_raw", "load_spot_checks"])
def test_checks_read_sales_once(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(registry.QUERIES[name](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum("FileScan parquet" in line and "l_orderkey" in line for line in text.splitlines()) == 1


def test_inventory_is_built_and_exchanged_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(registry.QUERIES["fct_inventory"](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("Exchange hashpartitioning(store_id") == 1 and text.count("[n_nationkey % 5") <= 1
    window = text.index("Window [sum(")
    assert "md5" in text[:window] and "md5" not in text[window:]


@pytest.mark.parametrize("name", ["weekly_demand", "forecast_trend", "reorder_topdown"])
def test_sales_are_summed_before_versions_are_joined(spark, name):
    text = registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    lines = text.splitlines()
    joins = [i for i, line in enumerate(lines) if re.search(r"Join LeftOuter.*valid_from", line)]
    depth = lambda line: len(re.match(r"[ :+|-]*", line)[0])
    for i in joins:
        below = lines[i + 1 :]
        first = below[0]
        inside = [line for k, line in enumerate(below) if k == 0 or all(depth(x) >= depth(first) for x in below[: k + 1])]
        assert any("Aggregate [store_id" in line and "sale_date" in line for line in inside)
    assert joins
