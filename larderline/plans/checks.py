"""The declared checks: raw suite, model tests, monitored metrics.

Fixed values: tables, columns, bounds and value lists must equal the published
suites for the verdicts to match.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.functions import labels
from larderline.functions.columns import rounded_ratio, to_units
from larderline.operators.anomaly import Metric, bucket_metrics, fill_gaps, score
from larderline.operators.drift import Watched, divergence, histograms
from larderline.operators.quality import (
    ACCEPTED,
    NO_NULLS,
    UNIQUE,
    Check,
    Keyed,
    accepted_values,
    counted_once,
    fresh,
    no_nulls,
    references,
    row_count_between,
    run_model_tests,
    unique,
    values_between,
)
from larderline.plans.warehouse import Warehouse

RAW_SUITE: list[Check] = [
    row_count_between("stores", 350, 450),
    no_nulls("stores", "store_id"),
    unique("stores", "store_id"),
    no_nulls("stores", "state"),
    accepted_values("stores", "state", labels.STATES),
    accepted_values("stores", "store_cluster", labels.CLUSTERS),
    row_count_between("suppliers", 40, 60),
    no_nulls("suppliers", "supplier_id"),
    unique("suppliers", "supplier_id"),
    values_between("suppliers", "lead_time_days", 1, 21),
    accepted_values("suppliers", "payment_terms", labels.PAYMENT_TERMS),
    row_count_between("products", 400, 600),
    no_nulls("products", "product_id"),
    unique("products", "product_id"),
    accepted_values("products", "category", labels.CATEGORIES),
    values_between("products", "unit_price", 0.50, 100.00),
    values_between("products", "cost_price", 0.10, 80.00),
    references("products", "supplier_id", "suppliers", "supplier_id"),
    row_count_between("pos_sales", 100_000, 10_000_000),
    no_nulls("pos_sales", "sale_id"),
    no_nulls("pos_sales", "store_id"),
    no_nulls("pos_sales", "product_id"),
    no_nulls("pos_sales", "sale_date"),
    values_between("pos_sales", "quantity", 1, 500),
    values_between("pos_sales", "total_amount", 0.01, 50_000, mostly=0.999),
    fresh("pos_sales", "sale_date", 400),
    references("pos_sales", "store_id", "stores", "store_id"),
    references("pos_sales", "product_id", "products", "product_id"),
    row_count_between("inventory_snapshots", 500_000, 20_000_000),
    no_nulls("inventory_snapshots", "store_id"),
    no_nulls("inventory_snapshots", "product_id"),
    no_nulls("inventory_snapshots", "snapshot_date"),
    values_between("inventory_snapshots", "quantity_on_hand", 0, 10_000),
    fresh("inventory_snapshots", "snapshot_date", 400),
    row_count_between("purchase_orders", 1_000, 100_000),
    no_nulls("purchase_orders", "po_id"),
    unique("purchase_orders", "po_id"),
    accepted_values("purchase_orders", "status", labels.ORDER_STATUSES),
    references("purchase_orders", "store_id", "stores", "store_id"),
    references("purchase_orders", "product_id", "products", "product_id"),
]

# Feeds with a load-time column, for source freshness.
LOADED_AT = {"stores": "opened_date", "inventory_snapshots": "snapshot_date", "pos_sales": "sale_date"}


def _model(name: str, keys: list[str], filled: list[str], *others: Check) -> list[Check]:
    """Tests of one model: key columns are unique and filled, the others filled."""
    return [
        *[no_nulls(name, c) for c in keys + filled],
        *[unique(name, c) for c in keys],
        *others,
    ]


SOURCE_TESTS: dict[str, list[Check]] = {
    "stores": _model(
        "stores",
        ["store_id"],
        ["store_cluster", "state", "is_active"],
        accepted_values("stores", "store_cluster", labels.CLUSTERS),
        accepted_values("stores", "state", labels.STATES),
    ),
    "suppliers": _model(
        "suppliers",
        ["supplier_id"],
        ["lead_time_days"],
        accepted_values("suppliers", "payment_terms", labels.PAYMENT_TERMS),
    ),
    "products": _model(
        "products",
        ["product_id"],
        ["category", "supplier_id", "unit_price", "cost_price"],
        accepted_values("products", "category", labels.CATEGORIES),
        references("products", "supplier_id", "suppliers", "supplier_id"),
    ),
    "product_price_history": _model(
        "product_price_history",
        [],
        ["product_id", "effective_from", "unit_price"],
        references("product_price_history", "product_id", "products", "product_id"),
    ),
    "inventory_snapshots": _model(
        "inventory_snapshots",
        [],
        ["store_id", "product_id", "snapshot_date", "quantity_on_hand"],
        references("inventory_snapshots", "store_id", "stores", "store_id"),
        references("inventory_snapshots", "product_id", "products", "product_id"),
    ),
    "purchase_orders": _model(
        "purchase_orders",
        ["po_id"],
        ["store_id", "product_id", "supplier_id", "quantity_ordered"],
        accepted_values("purchase_orders", "status", labels.ORDER_STATUSES),
        references("purchase_orders", "store_id", "stores", "store_id"),
        references("purchase_orders", "product_id", "products", "product_id"),
        references("purchase_orders", "supplier_id", "suppliers", "supplier_id"),
    ),
    "pos_sales": _model(
        "pos_sales",
        [],
        ["sale_id", "store_id", "product_id", "sale_date", "quantity", "unit_price", "total_amount"],
        references("pos_sales", "store_id", "stores", "store_id"),
        references("pos_sales", "product_id", "products", "product_id"),
    ),
}

STAGING_TESTS: dict[str, list[Check]] = {
    "stg_stores": _model(
        "stg_stores",
        ["store_id"],
        ["store_cluster", "state", "is_active", "is_metro"],
        accepted_values("stg_stores", "store_cluster", labels.CLUSTERS),
    ),
    "stg_suppliers": _model(
        "stg_suppliers",
        ["supplier_id"],
        ["lead_time_days", "is_reliable_supplier"],
        values_between("stg_suppliers", "lead_time_days", 1, 21),
    ),
    "stg_products": _model(
        "stg_products",
        ["product_version_key"],
        ["product_id", "unit_price", "gross_margin_pct", "is_current_version"],
        values_between("stg_products", "unit_price", 0.50, 100.00),
        values_between("stg_products", "gross_margin_pct", 0, 100),
    ),
    "stg_inventory": _model(
        "stg_inventory",
        ["inventory_snapshot_key"],
        ["store_id", "product_id", "snapshot_date", "quantity_on_hand", "is_stockout", "is_below_reorder_point"],
        values_between("stg_inventory", "quantity_on_hand", 0, 10_000),
    ),
    "stg_purchase_orders": _model(
        "stg_purchase_orders",
        ["po_id"],
        ["store_id", "product_id", "supplier_id", "quantity_ordered", "is_late", "is_fulfilled"],
        values_between("stg_purchase_orders", "quantity_ordered", 1, 1000),
        accepted_values("stg_purchase_orders", "status", labels.ORDER_STATUSES),
    ),
    "stg_sales": _model(
        "stg_sales",
        ["sale_key"],
        ["sale_id", "store_id", "product_id", "sale_date", "quantity", "total_amount", "is_weekend", "has_price_discrepancy"],
        values_between("stg_sales", "quantity", 1, 1000),
        values_between("stg_sales", "total_amount", 0.01, 50_000),
    ),
}

MART_TESTS: dict[str, list[Check]] = {
    "dim_stores": _model(
        "dim_stores",
        ["store_id"],
        ["store_cluster", "cluster_tier", "is_active"],
        values_between("dim_stores", "cluster_tier", 1, 6),
    ),
    "dim_products": _model(
        "dim_products",
        ["product_version_key"],
        ["product_id", "unit_price", "is_current_version", "perishability"],
        values_between("dim_products", "unit_price", 0.50, 100.00),
        accepted_values("dim_products", "perishability", ["Perishable", "Non-Perishable"]),
    ),
    "fct_inventory": _model(
        "fct_inventory",
        ["inventory_snapshot_key"],
        ["store_id", "product_id", "snapshot_date", "stock_status"],
        accepted_values("fct_inventory", "stock_status", labels.STOCK_STATUSES),
        values_between("fct_inventory", "days_of_stock_remaining", 0, 365),
    ),
    "fct_purchase_orders": _model(
        "fct_purchase_orders",
        ["po_id"],
        ["store_id", "product_id", "total_order_value", "days_overdue"],
        accepted_values("fct_purchase_orders", "status", labels.ORDER_STATUSES),
        values_between("fct_purchase_orders", "total_order_value", 0, 100_000),
    ),
    "fct_sales": _model(
        "fct_sales",
        ["sale_key"],
        ["store_id", "product_id", "sale_date", "revenue", "gross_profit", "category", "store_cluster"],
        values_between("fct_sales", "revenue", 0.01, 50_000),
    ),
    "fct_stockouts": _model(
        "fct_stockouts",
        [],
        ["store_id", "product_id", "stockout_date", "urgency", "estimated_lost_revenue_7d"],
        accepted_values("fct_stockouts", "urgency", labels.URGENCIES),
        values_between("fct_stockouts", "estimated_lost_revenue_7d", 0, 100_000),
    ),
}

# Models whose rows are many and cheap to make again: no exchange of theirs, or one that all passes share, moves the rows.
READ_AGAIN = {"stg_inventory", "fct_inventory", "stg_sales"}

MODEL_TESTS = {"source": SOURCE_TESTS, "staging": STAGING_TESTS, "mart": MART_TESTS}


def model_test_results(warehouse: Warehouse, layers: tuple[str, ...] = ("source", "staging", "mart")) -> DataFrame:
    """Every declared test of the given layers: failures and verdict."""
    warehouse = replace(warehouse, sales_shared=True)
    feeds = {**dict(warehouse.raw.items()), "pos_sales": warehouse.pos_sales}
    parts = [
        run_model_tests(layer, model, feeds[model] if layer == "source" else getattr(warehouse, model), tests, feeds, read_again=model in READ_AGAIN)
        for layer in layers
        for model, tests in MODEL_TESTS[layer].items()
    ]
    return reduce(DataFrame.unionByName, parts)


def mart_gate(name: str, rows: DataFrame) -> DataFrame:
    """What a written mart must pass to be published: its keys, filled columns and value lists."""
    kinds = (NO_NULLS, UNIQUE, ACCEPTED)
    return run_model_tests("mart", name, rows, [check for check in MART_TESTS[name] if check.expectation in kinds], {}, read_again=True)


# Row-volume monitors: model, timestamp, bucket, sensitivity.
VOLUME_MONITORS = [
    ("dim_products", "valid_from", "day", 2),
    ("fct_inventory", "snapshot_date", "week", 3),
    ("fct_purchase_orders", "order_date", "day", 3),
    ("fct_sales", "sale_date", "day", 3),
    ("fct_stockouts", "stockout_date", "week", 2),
]

# Column monitors: model, timestamp, bucket, metrics.
COLUMN_MONITORS = [
    (
        "fct_inventory",
        "snapshot_date",
        "week",
        [
            Metric("stock_status", "null_count"),
            Metric("quantity_on_hand", "null_count"),
            Metric("quantity_on_hand", "zero_count"),
            Metric("quantity_on_hand", "average"),
        ],
    ),
    (
        "fct_purchase_orders",
        "order_date",
        "day",
        [Metric("total_order_value", "average"), Metric("total_order_value", "max")],
    ),
    (
        "fct_sales",
        "sale_date",
        "day",
        [
            Metric("revenue", "average"),
            Metric("revenue", "sum"),
            Metric("revenue", "null_count"),
            Metric("quantity", "average"),
            Metric("quantity", "max"),
        ],
    ),
    (
        "fct_stockouts",
        "stockout_date",
        "week",
        [Metric("estimated_lost_revenue_7d", "average", 2), Metric("estimated_lost_revenue_7d", "sum", 2)],
    ),
]


# Distributions watched for drift: model, timestamp, bucket, columns.
DRIFT_MONITORS = [
    ("fct_sales", "sale_date", "day", [Watched("revenue", 2), Watched("quantity")]),
    ("fct_inventory", "snapshot_date", "week", [Watched("quantity_on_hand")]),
]


def at_grain(warehouse: Warehouse, model: str) -> DataFrame:
    """The staged table whose rows are those of ``model``, with its monitored columns that need no dimension.

    Facts are left joins of one staged table to lookups with one row per key, so that table fixes their rows.
    """
    if model == "dim_products":
        return warehouse.stg_products
    if model == "fct_purchase_orders":
        return warehouse.stg_purchase_orders
    if model == "fct_sales":
        return warehouse.stg_sales.withColumn("revenue", F.col("total_amount"))
    if model == "fct_inventory":
        return warehouse.stg_inventory
    if model == "fct_stockouts":
        stock = warehouse.stg_inventory.filter("is_stockout OR is_below_reorder_point")
        return stock.withColumn("stockout_date", F.col("snapshot_date"))
    raise ValueError(f"no staged table is known for {model}")


def volumes(warehouse: Warehouse, runs: Mapping[int, Callable[[DataFrame, str], Column]] | None = None) -> DataFrame:
    """Row counts per bucket of every monitored model; ``runs`` gives the condition on the rows of each of several runs
    from a model's rows and its day column, and all runs are measured in one pass."""
    parts = []
    for model, at, bucket, sensitivity in VOLUME_MONITORS:
        rows = at_grain(warehouse, model)
        chosen = None if runs is None else {run: condition(rows, at) for run, condition in runs.items()}
        parts.append(bucket_metrics(model, rows, at, bucket, [Metric("*", "row_count", sensitivity)], chosen))
    return reduce(DataFrame.unionByName, parts)


def volume_anomalies(warehouse: Warehouse) -> DataFrame:
    """Scored row counts per bucket of every monitored model."""
    return score(fill_gaps(volumes(warehouse))).drop("column_name", "metric")


def column_anomalies(warehouse: Warehouse) -> DataFrame:
    """Scored column metrics per bucket of every monitored model."""

    def rows(model: str, metrics: list[Metric]) -> DataFrame:
        staged = at_grain(warehouse, model)
        return staged if {m.column for m in metrics} <= set(staged.columns) else getattr(warehouse, model)

    parts = [
        bucket_metrics(model, rows(model, metrics), at, bucket, metrics)
        for model, at, bucket, metrics in COLUMN_MONITORS
    ]
    return score(fill_gaps(reduce(DataFrame.unionByName, parts)))


def distribution_drift(warehouse: Warehouse) -> DataFrame:
    """Divergence per bucket of every watched distribution."""
    parts = [histograms(model, at_grain(warehouse, model), at, bucket, watched) for model, at, bucket, watched in DRIFT_MONITORS]
    return divergence(reduce(DataFrame.unionByName, parts))


def load_spot_checks(warehouse: Warehouse) -> DataFrame:
    """(check_name, value): sales of known stores, of known products, stock-out rate, repriced products."""
    raw = warehouse.raw

    keyed = {"store": Keyed("store_id", raw.stores, "store_id"), "product": Keyed("product_id", raw.products, "product_id")}
    nulls = {k: F.col(of.column).isNull().cast("bigint") for k, of in keyed.items()}
    counted = counted_once(raw.pos_sales, nulls, {}, keyed)
    found = [
        F.struct(
            F.lit(f"Sales with valid {k}").alias("check_name"),
            (F.col("n") - F.col(f"{k}_lost") - F.coalesce(k, F.lit(0))).cast("double").alias("value"),
        )
        for k in keyed
    ]
    known = counted.select(F.inline(F.array(*found)))
    rate = stockout_rate(warehouse).select(
        F.lit("Inventory stockout rate").alias("check_name"), F.col("pct_stockout").alias("value")
    )
    repriced = repriced_products(warehouse).agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("Products with price changes").alias("check_name"), "value"
    )
    return known.unionByName(rate).unionByName(repriced)


def stockout_rate(warehouse: Warehouse) -> DataFrame:
    """One row: share of inventory rows with nothing on hand, percent to two decimals."""
    empty = F.count_if(F.col("quantity_on_hand") == 0)
    percent = to_units(rounded_ratio(empty * 100, F.count(F.lit(1)), 2), 2)
    return warehouse.raw.inventory_snapshots.agg(percent.alias("pct_stockout"))


def repriced_products(warehouse: Warehouse) -> DataFrame:
    """(product_id, versions) of every product with more than one price."""
    return (
        warehouse.raw.product_price_history.groupBy("product_id")
        .agg(F.count(F.lit(1)).alias("versions"))
        .filter(F.col("versions") > 1)
    )
