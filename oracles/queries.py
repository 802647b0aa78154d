"""One SQL text per registered query that SQL can express."""

from __future__ import annotations

import math

from oracles.fragments import AS_OF, CATEGORIES, CLUSTERS, FRAGMENTS, STATES, Z, compose, fragment, key, ratio, units

QUERIES: dict[str, str] = {}


def add(name: str, final: str, *needs: str) -> None:
    QUERIES[name] = compose(final, *needs)


def whole(name: str, fragment: str | None = None) -> None:
    add(name, f"SELECT * FROM {fragment or name}", fragment or name)


def quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def six(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


FEEDS = [
    "stores",
    "suppliers",
    "products",
    "product_price_history",
    "inventory_snapshots",
    "pos_sales",
    "purchase_orders",
]
GIVEN = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

# ---- loading ----------------------------------------------------------------
add("asset_discovery", "\nUNION ALL ".join(f"SELECT '{t}' AS asset, count(*) AS row_count FROM {t}" for t in GIVEN))
add(
    "raw_row_counts",
    "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in FEEDS),
    *FEEDS,
)
RATE = units(ratio("sum(CASE WHEN quantity_on_hand = 0 THEN 100 ELSE 0 END)", "count(*)", 2), 2)
add("stockout_rate", f"SELECT {RATE} AS pct_stockout FROM inventory_snapshots", "inventory_snapshots")
REPRICED = "SELECT product_id, count(*) AS versions FROM product_price_history GROUP BY product_id HAVING count(*) > 1"
add("price_change_products", REPRICED, "product_price_history")
add(
    "load_spot_checks",
    f"""
SELECT 'Sales with valid store' AS check_name, CAST(count(*) AS DOUBLE) AS value FROM pos_sales
WHERE store_id IN (SELECT store_id FROM stores)
UNION ALL SELECT 'Sales with valid product', CAST(count(*) AS DOUBLE) FROM pos_sales
WHERE product_id IN (SELECT product_id FROM products)
UNION ALL SELECT 'Inventory stockout rate', {RATE} FROM inventory_snapshots
UNION ALL SELECT 'Products with price changes', CAST(count(*) AS DOUBLE) FROM ({REPRICED})""",
    *FEEDS,
)
add(
    "surrogate_key",
    f"""
SELECT {key('sale_id', 'store_id', 'product_id', 'sale_date')} AS record_key, 'pos_sales' AS feed FROM pos_sales
UNION ALL
SELECT {key('store_id', 'product_id', 'snapshot_date')}, 'inventory_snapshots' FROM inventory_snapshots
UNION ALL
SELECT product_version_key, 'product_price_history' FROM stg_products""",
    "pos_sales",
    "inventory_snapshots",
    "stg_products",
)

# ---- staging, versions, marts -----------------------------------------------
for table in (
    "stg_stores",
    "stg_suppliers",
    "stg_products",
    "stg_inventory",
    "stg_purchase_orders",
    "stg_sales",
    "dim_stores",
    "dim_products",
    "fct_sales",
    "fct_inventory",
    "fct_purchase_orders",
    "fct_stockouts",
):
    whole(table)

VERSION = """product_id, product_name, category, supplier_id, unit_of_measure, is_active, unit_price, cost_price,
       gross_margin_pct, CAST(valid_from AS DATE) AS valid_from"""
for name in ("scd2_prices", "scd2_merge"):
    add(name, f"SELECT {VERSION}, CAST(valid_to AS DATE) AS valid_to FROM snapshot", "snapshot")
for name in ("scd2_hard_deletes", "scd2_incremental"):
    add(
        name,
        f"""
SELECT {VERSION}, CASE WHEN valid_to IS NULL AND product_id NOT IN (SELECT product_id FROM products WHERE is_active)
                       THEN {AS_OF} ELSE CAST(valid_to AS DATE) END AS valid_to
FROM snapshot""",
        "snapshot",
        "products",
    )
add(
    "asof_price_join",
    """
SELECT sale_key, product_id, sale_date, unit_price AS pos_unit_price, catalogue_price AS version_price,
       gross_margin_pct, valid_from
FROM priced_sales""",
    "priced_sales",
)
add(
    "asof_price_overlap",
    """
SELECT s.sale_key, s.product_id, s.sale_date, s.unit_price AS pos_unit_price, p.unit_price AS version_price,
       p.gross_margin_pct, p.valid_from
FROM stg_sales s LEFT JOIN stg_products p ON s.product_id = p.product_id AND s.sale_date >= p.valid_from
QUALIFY row_number() OVER (PARTITION BY s.sale_key ORDER BY p.valid_from DESC) = 1""",
    "stg_sales",
    "stg_products",
)

# ---- raw expectations -------------------------------------------------------
SUITE: list[tuple[str, str]] = []  # (expectation, SELECT of one result row)


def check(expectation: str, table: str, column: str, passed: str, details: str, source: str) -> None:
    SUITE.append(
        (
            expectation,
            f"SELECT 'expect_{expectation}' AS expectation, '{table}' AS table_name, '{column}' AS column_name, "
            f"{passed} AS passed, {details} AS details FROM ({source})",
        )
    )


def no_nulls(table: str, column: str) -> None:
    source = f"SELECT count(*) AS b FROM {table} WHERE {column} IS NULL"
    check("no_nulls", table, column, "b = 0", "concat('{\"null_count\":', b, '}')", source)


def unique(table: str, column: str) -> None:
    source = f"SELECT count(*) AS b FROM (SELECT 1 FROM {table} GROUP BY {column} HAVING count(*) > 1)"
    check("unique", table, column, "b = 0", "concat('{\"duplicate_count\":', b, '}')", source)


def accepted(table: str, column: str, values: list[str]) -> None:
    allowed = ",".join(f'"{v}"' for v in values)
    source = f"SELECT count(*) AS b FROM {table} WHERE {column} NOT IN ({quoted(values)}) AND {column} IS NOT NULL"
    details = f"concat('{{\"bad_count\":', b, ',\"accepted_values\":[{allowed}]}}')"
    check("accepted_values", table, column, "b = 0", details, source)


def between(table: str, column: str, low: float, high: float, mostly: float = 1.0) -> None:
    source = f"SELECT count(*) AS n, count(*) FILTER (WHERE {column} < {low} OR {column} > {high}) AS b FROM {table}"
    share = f"coalesce({units(ratio('n - b', 'n', 4), 4)}, CAST(1 AS DOUBLE))"
    details = (
        f"concat('{{\"min_val\":{float(low)},\"max_val\":{float(high)},\"mostly\":{float(mostly)},"
        f"\"pct_passing\":', {share}, ',\"bad_count\":', b, '}}')"
    )
    passed = f"CASE WHEN n = 0 THEN TRUE ELSE CAST(n - b AS DOUBLE) / n >= {mostly} END"
    check("values_between", table, column, passed, details, source)


def row_count(table: str, low: int, high: int) -> None:
    details = f"concat('{{\"row_count\":', n, ',\"min_rows\":{low},\"max_rows\":{high}}}')"
    check("row_count_between", table, "*", f"n BETWEEN {low} AND {high}", details, f"SELECT count(*) AS n FROM {table}")


def references(table: str, column: str, parent: str, parent_column: str) -> None:
    source = (
        f"SELECT count(*) AS b, (SELECT coalesce(bool_or({parent_column} IS NULL), FALSE) FROM {parent}) AS h "
        f"FROM {table} WHERE {column} NOT IN (SELECT {parent_column} FROM {parent}) AND {column} IS NOT NULL"
    )
    details = "concat('{\"orphan_count\":', b, ',\"parent_has_null\":', h, '}')"
    check("referential_integrity", table, f"{column} → {parent}.{parent_column}", "b = 0", details, source)


def fresh(table: str, column: str, days: int) -> None:
    source = f"SELECT datediff('day', CAST(max({column}) AS DATE), {AS_OF}) AS d FROM {table}"
    details = f"concat('{{\"days_since_latest\":', d, ',\"max_allowed\":{days}}}')"
    check("freshness", table, column, f"coalesce(d <= {days}, FALSE)", details, source)


TERMS = ["NET30", "NET60", "NET14", "COD"]
STATUSES = ["delivered", "in_transit", "pending", "cancelled"]
row_count("stores", 350, 450)
no_nulls("stores", "store_id")
unique("stores", "store_id")
no_nulls("stores", "state")
accepted("stores", "state", STATES)
accepted("stores", "store_cluster", CLUSTERS)
row_count("products", 400, 600)
no_nulls("products", "product_id")
unique("products", "product_id")
accepted("products", "category", CATEGORIES)
between("products", "unit_price", 0.50, 100.00)
between("products", "cost_price", 0.10, 80.00)
references("products", "supplier_id", "suppliers", "supplier_id")
row_count("suppliers", 40, 60)
no_nulls("suppliers", "supplier_id")
unique("suppliers", "supplier_id")
between("suppliers", "lead_time_days", 1, 21)
accepted("suppliers", "payment_terms", TERMS)
row_count("pos_sales", 100_000, 10_000_000)
for column in ("sale_id", "store_id", "product_id", "sale_date"):
    no_nulls("pos_sales", column)
between("pos_sales", "quantity", 1, 500)
between("pos_sales", "total_amount", 0.01, 50_000, 0.999)
fresh("pos_sales", "sale_date", 400)
references("pos_sales", "store_id", "stores", "store_id")
references("pos_sales", "product_id", "products", "product_id")
row_count("inventory_snapshots", 500_000, 20_000_000)
for column in ("store_id", "product_id", "snapshot_date"):
    no_nulls("inventory_snapshots", column)
between("inventory_snapshots", "quantity_on_hand", 0, 10_000)
fresh("inventory_snapshots", "snapshot_date", 400)
row_count("purchase_orders", 1_000, 100_000)
no_nulls("purchase_orders", "po_id")
unique("purchase_orders", "po_id")
accepted("purchase_orders", "status", STATUSES)
references("purchase_orders", "store_id", "stores", "store_id")
references("purchase_orders", "product_id", "products", "product_id")


def suite(*kinds: str) -> str:
    return "\nUNION ALL ".join(sql for kind, sql in SUITE if not kinds or kind in kinds)


for name, kind in {
    "dq_not_null": "no_nulls",
    "dq_unique": "unique",
    "dq_accepted_values": "accepted_values",
    "dq_between": "values_between",
    "dq_row_count": "row_count_between",
    "dq_referential": "referential_integrity",
    "dq_freshness": "freshness",
}.items():
    add(name, suite(kind), *FEEDS)
add("dq_suite_raw", suite(), *FEEDS)
add(
    "dq_results",
    f"""
SELECT concat('{{"expectation":"', expectation, '","table":"', table_name, '","column":"', column_name,
              '","passed":', passed, '}}') AS record, details
FROM ({suite()})""",
    *FEEDS,
)
add(
    "dq_summary",
    f"""
SELECT count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed,
       bool_and(passed) AS all_passed FROM ({suite()})""",
    *FEEDS,
)


def profile(table: str, text: str, numbers: str = "", other: str = "") -> str:
    rows = []
    for column in f"{text} {other}".split() + numbers.split():
        zero = f"count(*) FILTER (WHERE {column} = 0)" if column in numbers.split() else "CAST(NULL AS BIGINT)"
        rows.append(
            f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) AS row_count, "
            f"count(*) FILTER (WHERE {column} IS NULL) AS null_count, {zero} AS zero_count FROM {table}"
        )
    return "\nUNION ALL ".join(rows)


add(
    "dq_profile",
    "\nUNION ALL ".join(
        [
            profile("stores", "store_id store_name state city postcode store_cluster opened_date is_active"),
            profile("suppliers", "supplier_id supplier_name country payment_terms is_active", "lead_time_days"),
            profile(
                "products",
                "product_id product_name category supplier_id unit_of_measure is_active effective_from",
                "unit_price cost_price",
            ),
            profile("product_price_history", "product_id effective_from effective_to", "unit_price cost_price"),
            profile(
                "inventory_snapshots",
                "store_id product_id snapshot_date",
                "quantity_on_hand reorder_point reorder_qty",
            ),
            profile("pos_sales", "sale_id store_id product_id sale_date", "quantity unit_price total_amount"),
            profile(
                "purchase_orders",
                "po_id store_id product_id supplier_id order_date expected_date status",
                "quantity_ordered unit_cost",
            ),
        ]
    ),
    *FEEDS,
)
AGES = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS loaded_at_field, "
    f"CAST(datediff('day', CAST(max({c}) AS DATE), {AS_OF}) * 24 AS BIGINT) AS age_hours FROM {t}"
    for t, c in (("stores", "opened_date"), ("inventory_snapshots", "snapshot_date"), ("pos_sales", "sale_date"))
)
add(
    "dq_source_freshness",
    f"""
SELECT *, CASE WHEN age_hours IS NULL OR age_hours > 48 THEN 'error' WHEN age_hours > 24 THEN 'warn'
               ELSE 'pass' END AS status FROM ({AGES})""",
    *FEEDS,
)

# ---- declared model tests ---------------------------------------------------
MODEL_ROWS: list[str] = []
MODELS_USED: list[str] = []


def test(layer: str, model: str, column: str, kind: str, failing: str) -> None:
    MODEL_ROWS.append(
        f"SELECT '{layer}' AS layer, '{model}' AS model, '{column}' AS column_name, '{kind}' AS test, "
        f"b AS failures, b = 0 AS passed FROM (SELECT count(*) AS b FROM {failing})"
    )
    if model not in MODELS_USED:
        MODELS_USED.append(model)


def model(layer: str, name: str, unique_columns: str, filled: str, **others: list) -> None:
    for column in f"{unique_columns} {filled}".split():
        test(layer, name, column, "not_null", f"{name} WHERE {column} IS NULL")
    for column in unique_columns.split():
        repeated = f"(SELECT 1 FROM {name} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
        test(layer, name, column, "unique", repeated)
    for column, spec in others.items():
        if spec and isinstance(spec[0], str):
            test(layer, name, column, "accepted_values", f"{name} WHERE {column} NOT IN ({quoted(spec)})")
        elif spec:
            test(layer, name, column, "between", f"{name} WHERE {column} < {spec[0]} OR {column} > {spec[1]}")


def related(name: str, column: str, parent: str) -> None:
    failing = (
        f"{name} c WHERE c.{column} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})"
    )
    test("source", name, column, "relationships", failing)


model("source", "stores", "store_id", "store_cluster state is_active", store_cluster=CLUSTERS, state=STATES)
model("source", "suppliers", "supplier_id", "lead_time_days", payment_terms=TERMS)
model("source", "products", "product_id", "category supplier_id unit_price cost_price", category=CATEGORIES)
model("source", "product_price_history", "", "product_id effective_from unit_price")
model("source", "inventory_snapshots", "", "store_id product_id snapshot_date quantity_on_hand")
model("source", "purchase_orders", "po_id", "store_id product_id supplier_id quantity_ordered", status=STATUSES)
model("source", "pos_sales", "", "sale_id store_id product_id sale_date quantity unit_price total_amount")
related("products", "supplier_id", "suppliers")
related("product_price_history", "product_id", "products")
for name in ("inventory_snapshots", "purchase_orders", "pos_sales"):
    related(name, "store_id", "stores")
    related(name, "product_id", "products")
related("purchase_orders", "supplier_id", "suppliers")
model("staging", "stg_stores", "store_id", "store_cluster state is_active is_metro", store_cluster=CLUSTERS)
model("staging", "stg_suppliers", "supplier_id", "lead_time_days is_reliable_supplier", lead_time_days=[1, 21])
model(
    "staging",
    "stg_products",
    "product_version_key",
    "product_id unit_price gross_margin_pct is_current_version",
    unit_price=[0.5, 100],
    gross_margin_pct=[0, 100],
)
model(
    "staging",
    "stg_inventory",
    "inventory_snapshot_key",
    "store_id product_id snapshot_date quantity_on_hand is_stockout is_below_reorder_point",
    quantity_on_hand=[0, 10000],
)
model(
    "staging",
    "stg_purchase_orders",
    "po_id",
    "store_id product_id supplier_id quantity_ordered is_late is_fulfilled",
    quantity_ordered=[1, 1000],
    status=STATUSES,
)
model(
    "staging",
    "stg_sales",
    "sale_key",
    "sale_id store_id product_id sale_date quantity total_amount is_weekend has_price_discrepancy",
    quantity=[1, 1000],
    total_amount=[0.01, 50000],
)
model("mart", "dim_stores", "store_id", "store_cluster cluster_tier is_active", cluster_tier=[1, 6])
model(
    "mart",
    "dim_products",
    "product_version_key",
    "product_id unit_price is_current_version perishability",
    unit_price=[0.5, 100],
    perishability=["Perishable", "Non-Perishable"],
)
model(
    "mart",
    "fct_inventory",
    "inventory_snapshot_key",
    "store_id product_id snapshot_date stock_status",
    stock_status=["stockout", "critical", "low", "healthy"],
    days_of_stock_remaining=[0, 365],
)
model(
    "mart",
    "fct_purchase_orders",
    "po_id",
    "store_id product_id total_order_value days_overdue",
    status=STATUSES,
    total_order_value=[0, 100000],
)
model(
    "mart",
    "fct_sales",
    "sale_key",
    "store_id product_id sale_date revenue gross_profit category store_cluster",
    revenue=[0.01, 50000],
)
model(
    "mart",
    "fct_stockouts",
    "",
    "store_id product_id stockout_date urgency estimated_lost_revenue_7d",
    urgency=["critical", "high", "medium", "low"],
    estimated_lost_revenue_7d=[0, 100000],
)
add("dq_suite_models", "\nUNION ALL ".join(MODEL_ROWS), *MODELS_USED)

# ---- anomalies --------------------------------------------------------------
SCALE = 10000
ZERO_FILLED = quoted(["row_count", "null_count", "zero_count", "sum"])


def bucketed(model: str, column: str, metric: str, sensitivity: int, at: str, bucket: str, value: str) -> str:
    start = f"CAST(date_trunc('{bucket}', {at}) AS DATE)"
    step = 7 if bucket == "week" else 1
    return (
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{metric}' AS metric, {sensitivity} AS sensitivity, "
        f"{step} AS step, {start} AS bucket, CAST({value} AS HUGEINT) AS units FROM {model} GROUP BY 6"
    )


def scored(measures: list[str], columns: str) -> str:
    measured = "\nUNION ALL ".join(measures)
    return f"""
SELECT {columns}, bucket, {units('units', 4)} AS value, n AS training_buckets,
       mean / CAST({SCALE} AS DOUBLE) AS training_mean, round(z, 6) AS z_score,
       coalesce(abs(z) > sensitivity, FALSE) AS is_anomalous
FROM (SELECT *, CASE WHEN n >= 7 AND deviation > 0 THEN (CAST(units AS DOUBLE) - mean) / deviation END AS z
      FROM (SELECT *, CAST(s AS DOUBLE) / CAST(nullif(n, 0) AS DOUBLE) AS mean,
                   sqrt(CAST(n * q - s * s AS DOUBLE) / CAST(nullif(n * (n - 1), 0) AS DOUBLE)) AS deviation
            FROM (SELECT *, count(units) OVER past AS n, sum(units) OVER past AS s, sum(units * units) OVER past AS q
                  FROM (SELECT c.model, c.column_name, c.metric, c.sensitivity, c.bucket,
                               CASE WHEN m.bucket IS NOT NULL THEN m.units
                                    WHEN c.metric IN ({ZERO_FILLED}) THEN 0 END AS units
                        FROM (SELECT model, column_name, metric, any_value(sensitivity) AS sensitivity,
                                     CAST(unnest(generate_series(min(bucket), max(bucket),
                                          any_value(step) * INTERVAL 1 DAY)) AS DATE) AS bucket
                              FROM measured GROUP BY model, column_name, metric) c
                        LEFT JOIN measured m ON c.model = m.model AND c.column_name = m.column_name
                             AND c.metric = m.metric AND c.bucket = m.bucket)
                  WINDOW past AS (PARTITION BY model, column_name, metric ORDER BY bucket
                                  ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))))""", measured


def anomaly(name: str, measures: list[str], columns: str, *needs: str) -> None:
    final, measured = scored(measures, columns)
    text = compose(final, *needs)
    head, tail = text.rsplit("\n" + final.strip(), 1)[0], final.strip()
    QUERIES[name] = f"{head},\nmeasured AS MATERIALIZED ({measured})\n{tail}"


def cents_average(column: str) -> str:
    return ratio(f"sum(CAST(round({column} * 100, 0) AS BIGINT))", f"count({column})", 2)


anomaly(
    "anomaly_volume",
    [
        bucketed(m, "*", "row_count", sensitivity, at, bucket, f"count(*) * {SCALE}")
        for m, at, bucket, sensitivity in (
            ("dim_products", "valid_from", "day", 2),
            ("fct_inventory", "snapshot_date", "week", 3),
            ("fct_purchase_orders", "order_date", "day", 3),
            ("fct_sales", "sale_date", "day", 3),
            ("fct_stockouts", "stockout_date", "week", 2),
        )
    ],
    "model",
    "dim_products",
    "fct_inventory",
    "fct_purchase_orders",
    "fct_sales",
    "fct_stockouts",
)


def cents_sum(column: str) -> str:
    return f"sum(CAST(round({column} * 100, 0) AS BIGINT)) * 100"


INV, PO, SALE, OUT = (
    ("fct_inventory", "snapshot_date", "week"),
    ("fct_purchase_orders", "order_date", "day"),
    ("fct_sales", "sale_date", "day"),
    ("fct_stockouts", "stockout_date", "week"),
)
LOST = "estimated_lost_revenue_7d"
anomaly(
    "anomaly_column",
    [
        bucketed(source[0], column, metric, sensitivity, source[1], source[2], value)
        for source, column, metric, sensitivity, value in (
            (INV, "stock_status", "null_count", 3, f"count(*) FILTER (WHERE stock_status IS NULL) * {SCALE}"),
            (INV, "quantity_on_hand", "null_count", 3, f"count(*) FILTER (WHERE quantity_on_hand IS NULL) * {SCALE}"),
            (INV, "quantity_on_hand", "zero_count", 3, f"count(*) FILTER (WHERE quantity_on_hand = 0) * {SCALE}"),
            (INV, "quantity_on_hand", "average", 3, ratio("sum(quantity_on_hand)", "count(quantity_on_hand)", 4)),
            (PO, "total_order_value", "average", 3, cents_average("total_order_value")),
            (PO, "total_order_value", "max", 3, "CAST(max(total_order_value) * 100 AS BIGINT) * 100"),
            (SALE, "revenue", "average", 3, cents_average("revenue")),
            (SALE, "revenue", "sum", 3, cents_sum("revenue")),
            (SALE, "revenue", "null_count", 3, f"count(*) FILTER (WHERE revenue IS NULL) * {SCALE}"),
            (SALE, "quantity", "average", 3, ratio("sum(quantity)", "count(quantity)", 4)),
            (SALE, "quantity", "max", 3, f"max(quantity) * {SCALE}"),
            (OUT, LOST, "average", 2, cents_average(LOST)),
            (OUT, LOST, "sum", 2, cents_sum(LOST)),
        )
    ],
    "model, column_name, metric",
    "fct_inventory",
    "fct_purchase_orders",
    "fct_sales",
    "fct_stockouts",
)

# ---- demand and forecasts ---------------------------------------------------
whole("weekly_demand", "weekly")
add(
    "series_profile",
    """
SELECT count(*) AS weekly_rows, count(DISTINCT category) AS categories, min(week_start) AS first_week,
       max(week_start) AS last_week FROM weekly""",
    "weekly",
)
whole("forecast_eligibility", "eligibility")
HOLIDAYS = """(VALUES ('New Year''s Day', 1, 1), ('Australia Day', 1, 26), ('Anzac Day', 4, 25),
      ('Christmas Day', 12, 25), ('Boxing Day', 12, 26)) AS holidays(holiday, m, d)"""
# Easter Sundays as published; the birthday is the second Monday of June.
MOVABLE = """
      SELECT unnest(['Good Friday', 'Easter Monday']) AS holiday, unnest([sunday - 2, sunday + 1]) AS holiday_day
      FROM (VALUES (DATE '1995-04-16'), (DATE '1996-04-07'), (DATE '1997-03-30'), (DATE '1998-04-12'),
                   (DATE '1999-04-04'), (DATE '2000-04-23'), (DATE '2001-04-15'), (DATE '2002-03-31')) AS easter(sunday)
      UNION ALL
      SELECT 'Queen''s Birthday', d FROM (SELECT make_date(CAST(y AS INTEGER), 6, CAST(n AS INTEGER)) AS d
        FROM range(1995, 2003) AS years(y), range(8, 15) AS days(n)) WHERE isodow(d) = 1"""
add(
    "holiday_features",
    f"""
SELECT w.week_start, c.holiday, c.day_offset
FROM (SELECT DISTINCT week_start FROM weekly) w
JOIN (SELECT holiday, CAST(k AS INTEGER) AS day_offset, holiday_day + CAST(k AS INTEGER) AS holiday_day
      FROM (SELECT holiday, make_date(CAST(y AS INTEGER), m, d) AS holiday_day
            FROM {HOLIDAYS}, range(1995, 2003) AS years(y) UNION ALL {MOVABLE}), range(0, 2) AS offsets(k)) c
  ON w.week_start = c.holiday_day""",
    "weekly",
)
add("forecast_future_frame", "SELECT category, step, sunday AS forecast_date FROM future", "future")
add("forecast_future_mondays", "SELECT category, step, monday AS forecast_date FROM future", "future")
BANDS = six("yhat", "yhat_lower", "yhat_upper", "trend")
add("forecast_trend", f"SELECT forecast_date, category, store_cluster, {BANDS} FROM forecast", "forecast")
add("forecast_trend_backtest", f"SELECT category, cutoff, week_start, y, {six('yhat')} FROM backtest", "backtest")
add(
    "forecast_topdown",
    f"SELECT forecast_date, category, store_cluster, {BANDS} FROM cluster_forecast",
    "cluster_forecast",
)
add(
    "forecast_summary",
    """
SELECT category, store_cluster, round(avg(yhat), 6) AS avg_weekly_forecast,
       round(max(yhat), 6) AS max_weekly_forecast, round(avg(yhat_upper), 6) AS forecast_upper_avg
FROM cluster_forecast GROUP BY category, store_cluster""",
    "cluster_forecast",
)
add(
    "forecast_window",
    """
SELECT forecast_date, category, store_cluster, round(yhat, 6) AS forecast_units, round(yhat_lower, 6) AS low_estimate,
       round(yhat_upper, 6) AS high_estimate
FROM forecast WHERE forecast_date >= DATE '2001-12-01' AND category = 'fresh_produce'""",
    "forecast",
)
add(
    "forecast_accuracy",
    """
SELECT category, mape, rmse, n_weeks,
       CASE WHEN mape < 25 THEN 'Excellent' WHEN mape < 60 THEN 'Acceptable' WHEN mape < 100 THEN 'Poor'
            WHEN mape IS NOT NULL THEN 'Unreliable' END AS grade FROM metadata""",
    "metadata",
)
add("forecast_failure_modes", "SELECT category, failure_modes FROM metadata", "metadata")
whole("model_performance", "metadata")
add(
    "planning_quantity",
    """
SELECT forecast_date, category, store_cluster, rule, needs_review,
       round(CASE rule WHEN 'unreliable' THEN greatest(yhat_upper, recent)
                       WHEN 'recent_stockout' THEN yhat_upper * CAST(1.15 AS DOUBLE)
                       WHEN 'fresh_produce' THEN yhat_upper ELSE yhat END
             + CASE WHEN store_cluster = 'rural' AND category IN ('fresh_produce', 'dairy', 'bakery', 'meat_seafood')
                    THEN average_week ELSE 0 END, 6) AS planned_units
FROM (SELECT f.*, coalesce(m.mape > 80, FALSE) AS needs_review, coalesce(r.recent, 0) AS recent,
             CASE WHEN m.mape > 80 THEN 'unreliable' WHEN o.category IS NOT NULL THEN 'recent_stockout'
                  WHEN f.category = 'fresh_produce' THEN 'fresh_produce' ELSE 'point_forecast' END AS rule,
             avg(f.yhat) OVER (PARTITION BY f.category, f.store_cluster) AS average_week
      FROM cluster_forecast f
      LEFT JOIN metadata m ON f.category = m.category
      LEFT JOIN (SELECT category, store_cluster, CAST(sum(quantity) AS DOUBLE) / CAST(4 AS DOUBLE) AS recent
                 FROM fct_sales
                 WHERE CAST((SELECT date_trunc('week', max(sale_date)) FROM fct_sales) AS DATE)
                       - CAST(date_trunc('week', sale_date) AS DATE) < 28
                 GROUP BY category, store_cluster) r
             ON f.category = r.category AND f.store_cluster = r.store_cluster
      LEFT JOIN (SELECT DISTINCT category, store_cluster FROM fct_inventory
                 WHERE is_stockout AND (SELECT max(snapshot_date) FROM fct_inventory) - snapshot_date < 28) o
             ON f.category = o.category AND f.store_cluster = o.store_cluster)""",
    "cluster_forecast",
    "metadata",
    "fct_sales",
    "fct_inventory",
)

# ---- reorders ---------------------------------------------------------------
add(
    "latest_inventory",
    """
SELECT store_id, product_id, snapshot_date, category, store_cluster, quantity_on_hand, reorder_point, reorder_qty,
       stock_status, days_of_stock_remaining, lead_time_days, product_name, supplier_name FROM latest""",
    "latest",
)
whole("reorder_literal")
whole("reorder_topdown")
add(
    "top_reorders",
    """
SELECT product_name, store_id, product_id, stock_status, current_stock, recommended_order_qty
FROM reorder_topdown WHERE should_reorder
ORDER BY CASE stock_status WHEN 'stockout' THEN 1 WHEN 'critical' THEN 2 WHEN 'low' THEN 3 ELSE 4 END,
         recommended_order_qty DESC NULLS LAST, store_id, product_id LIMIT 10""",
    "reorder_topdown",
)
URGENT = "should_reorder AND stock_status IN ('stockout', 'critical')"
add(
    "urgent_orders",
    f"""
SELECT store_id, product_name, supplier_name, recommended_order_qty, stock_status
FROM reorder_topdown WHERE {URGENT}""",
    "reorder_topdown",
)
add(
    "urgent_orders_planner",
    f"""
SELECT store_id, product_name, supplier_name, stock_status, current_stock, recommended_order_qty
FROM reorder_topdown WHERE {URGENT}""",
    "reorder_topdown",
)

# ---- dashboard and catalogue ------------------------------------------------
add(
    "dashboard_weekly",
    """
SELECT strftime(week_start, '%Y-%m-%d') AS week_start, category, total_quantity, total_revenue FROM weekly_all""",
    "weekly_all",
)
add(
    "forecast_series",
    f"""
SELECT g.week_start, g.category, coalesce(h.total_quantity, 0) AS history_units,
       CAST(round_even(f.yhat, 0) AS BIGINT) AS yhat, CAST(round_even(f.yhat_lower, 0) AS BIGINT) AS yhat_lower,
       CAST(round_even(f.yhat_upper, 0) AS BIGINT) AS yhat_upper
FROM (SELECT week_start, category
      FROM (SELECT week_start FROM weekly_all UNION SELECT forecast_date FROM forecast),
           (SELECT unnest([{quoted(CATEGORIES)}]) AS category)) g
LEFT JOIN weekly_all h ON g.week_start = h.week_start AND g.category = h.category
LEFT JOIN forecast f ON g.week_start = f.forecast_date AND g.category = f.category""",
    "weekly_all",
    "forecast",
)
add(
    "inventory_status_counts",
    "SELECT category, store_cluster, stock_status, count(*) AS cnt FROM latest GROUP BY ALL",
    "latest",
)


def share_of(cluster: str) -> str:
    listed = ", ".join(f"'{c}'" for c in CLUSTERS)
    here = f"store_cluster = '{cluster}'" if cluster != "other" else f"coalesce(store_cluster NOT IN ({listed}), true)"
    out = f"100 * count(*) FILTER (WHERE {here} AND stock_status = 'stockout')"
    return f"coalesce({units(ratio(out, f'count(*) FILTER (WHERE {here})', 1), 1)}, 0) AS {cluster}"


add(
    "stockout_heatmap",
    f"SELECT category, {', '.join(share_of(c) for c in [*CLUSTERS, 'other'])} FROM latest GROUP BY category",
    "latest",
)
ACTIONABLE = "stock_status IN ('stockout', 'critical', 'low')"
add(
    "reorder_counts",
    f"""
SELECT category, stock_status, count(*) AS total, count(*) FILTER (WHERE should_reorder) AS needs_reorder
FROM reorder_topdown WHERE {ACTIONABLE} GROUP BY category, stock_status""",
    "reorder_topdown",
)
for name, source in (("reorder_urgency", "reorder_topdown"), ("reorder_urgency_literal", "reorder_literal")):
    counts = ", ".join(
        f"count(*) FILTER (WHERE should_reorder AND stock_status = '{s}') AS {s}" for s in ("stockout", "critical", "low")
    )
    add(name, f"SELECT category, {counts} FROM {source} WHERE {ACTIONABLE} GROUP BY category", source)
SEASON = f"""
SELECT CAST(extract(month FROM sale_date) AS INTEGER) AS month_num, strftime(sale_date, '%b') AS month_name, category,
       {units(ratio('sum(quantity)', 'count(quantity)', 1), 1)} AS avg_daily_qty
FROM fct_sales GROUP BY 1, 2, 3"""
add("seasonal_profile", SEASON, "fct_sales")
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
add(
    "seasonal_grid",
    "SELECT category, "
    + ", ".join(
        f"coalesce(CAST(round_even(max(avg_daily_qty) FILTER (WHERE month_name = '{m}'), 0) AS BIGINT), 0) AS {m}"
        for m in MONTHS
    )
    + f" FROM ({SEASON}) GROUP BY category",
    "fct_sales",
)
add(
    "kpi_summary",
    f"""
SELECT (SELECT count(*) FROM latest WHERE stock_status = 'stockout') AS stockouts,
       (SELECT count(*) FROM latest WHERE stock_status = 'critical') AS critical,
       (SELECT count(*) FROM reorder_topdown WHERE should_reorder AND {ACTIONABLE}) AS reorders,
       (SELECT count(*) FROM reorder_topdown) AS pairs_evaluated,
       (SELECT min(mape) FROM metadata) AS best_mape, (SELECT max(mape) FROM metadata) AS worst_mape,
       (SELECT count(*) FROM metadata) AS models""",
    "latest",
    "reorder_topdown",
    "metadata",
)
add(
    "cat_active_stores_by_state",
    "SELECT state, count(*) AS store_count FROM dim_stores WHERE is_active GROUP BY state",
    "dim_stores",
)
add("cat_metro_split", "SELECT is_metro, count(*) AS store_count FROM dim_stores GROUP BY is_metro", "dim_stores")
add(
    "cat_current_products",
    "SELECT product_id, product_name, category, unit_price FROM dim_products WHERE is_current_version AND is_active",
    "dim_products",
)
add(
    "cat_multi_price_products",
    """
SELECT product_id, product_name, count(*) AS price_versions FROM dim_products
GROUP BY product_id, product_name HAVING count(*) > 1""",
    "dim_products",
)
add(
    "cat_stockouts_by_category",
    "SELECT category, count(*) AS stockout_count FROM latest WHERE is_stockout GROUP BY category",
    "latest",
)
add(
    "cat_critical_stores",
    """
SELECT store_id, count(*) AS critical_products FROM latest WHERE stock_status IN ('stockout', 'critical')
GROUP BY store_id ORDER BY critical_products DESC, store_id LIMIT 20""",
    "latest",
)

# ---- written tables, read back ------------------------------------------------
STAMP = "TIMESTAMP '2001-12-01 06:00:00' AS created_at"
QUERIES["load_raw_counts"] = QUERIES["raw_row_counts"]
add(
    "load_raw_sales",
    """
SELECT sale_key, sale_id, sale_year, sale_month, sale_dow, is_weekend, quantity, has_price_discrepancy FROM stg_sales""",
    "stg_sales",
)
MARTS = ["dim_stores", "dim_products", "fct_inventory", "fct_purchase_orders", "fct_sales", "fct_stockouts"]
add("write_marts", "\nUNION ALL ".join(f"SELECT '{m}' AS table_name, count(*) AS row_count FROM {m}" for m in MARTS), *MARTS)
for name, source in (
    ("write_forecasts", "forecast_trend"),
    ("write_metadata", "model_performance"),
    ("write_recommendations", "reorder_topdown"),
):
    QUERIES[name] = f"SELECT *, {STAMP} FROM (\n{QUERIES[source]}\n) AS made"
QUERIES["write_check_log"] = f"""
SELECT expectation, table_name, column_name, passed, '2001-12-01T06:00:00' AS run_at,
       count(*) FILTER (WHERE passed) OVER () AS passed_total,
       count(*) FILTER (WHERE NOT passed) OVER () AS failed_total
FROM (
{QUERIES["dq_suite_raw"]}
) AS results"""

# ---- drift of distributions -------------------------------------------------


def binned(model: str, column: str, units_: str, at: str, days: int, source: str) -> str:
    """Rows of a watched column with their histogram bin: four steps in each power of two."""
    size = f"abs({units_})"
    return f"""
SELECT '{model}' AS model, '{column}' AS column_name, {days} AS step_days, bucket, top, size, u
FROM (SELECT {at} AS bucket, {units_} AS u, {size} AS size, length(bin({size})) - 1 AS top FROM {source})
WHERE u IS NOT NULL AND bucket IS NOT NULL"""


DRIFT = f"""
SELECT model, column_name, bucket, CAST(c_all AS BIGINT) AS rows, CAST(coalesce(trained, 0) AS BIGINT) AS training_buckets,
       CAST(r_all AS BIGINT) AS training_rows, round(psi, 6) AS psi, round(noise, 6) AS psi_noise, round(ks, 6) AS ks,
       round(critical, 6) AS ks_critical,
       coalesce(trained >= 7 AND ks > critical AND psi > 0.25 + noise, FALSE) AS is_drifting
FROM (
  SELECT model, column_name, bucket, c_all, r_all, any_value(trained) AS trained,
         CASE WHEN r_all > 0 THEN sum((p - q) * ln(p / q) ORDER BY bin) END AS psi,
         CASE WHEN r_all > 0 THEN (count(*) - 1) * CAST(c_all + r_all AS DOUBLE) / (CAST(c_all AS DOUBLE) * r_all) END AS noise,
         CASE WHEN r_all > 0 THEN max(abs(c_run * r_all - r_run * c_all)) / (CAST(c_all AS DOUBLE) * r_all) END AS ks,
         CASE WHEN r_all > 0 THEN sqrt(CAST(c_all + r_all AS DOUBLE) / (CAST(c_all AS DOUBLE) * r_all)) * 1.628 END AS critical
  FROM (
    SELECT *, (c + 0.5) / (c_all + 0.5 * bins) AS p, (r + 0.5) / (r_all + 0.5 * bins) AS q,
           CAST(sum(c) OVER running AS DOUBLE) AS c_run, CAST(sum(r) OVER running AS DOUBLE) AS r_run
    FROM (
      SELECT *, sum(c) OVER each AS c_all, sum(r) OVER each AS r_all, count(*) OVER each AS bins
      FROM (
        SELECT model, column_name, target AS bucket, bin, CAST(sum(CASE WHEN ahead = 0 THEN n ELSE 0 END) AS BIGINT) AS c,
               CAST(sum(CASE WHEN ahead > 0 THEN n ELSE 0 END) AS BIGINT) AS r
        FROM (SELECT *, CAST(bucket + CAST(ahead * step_days AS INTEGER) AS DATE) AS target FROM histogram, range(0, 15) AS o(ahead))
        GROUP BY model, column_name, target, bin
      )
      WINDOW each AS (PARTITION BY model, column_name, bucket)
    )
    WINDOW running AS (PARTITION BY model, column_name, bucket ORDER BY bin)
  ) LEFT JOIN (
    SELECT model, column_name, CAST(bucket + CAST(ahead * step_days AS INTEGER) AS DATE) AS bucket, count(*) AS trained
    FROM (SELECT DISTINCT model, column_name, step_days, bucket FROM histogram), range(1, 15) AS o(ahead)
    GROUP BY ALL
  ) USING (model, column_name, bucket)
  WHERE c_all > 0
  GROUP BY model, column_name, bucket, c_all, r_all
)"""


def drift(name: str, *watched: tuple[str, ...]) -> None:
    rows = " UNION ALL ".join(binned(*each) for each in watched)
    histogram = f"""
SELECT model, column_name, step_days, bucket, sign(u) * CASE WHEN u = 0 THEN 0 ELSE 4 * top + 1 +
       (CASE WHEN top >= 2 THEN size >> CAST(top - 2 AS INTEGER) ELSE size << CAST(2 - top AS INTEGER) END & 3) END AS bin, count(*) AS n
FROM ({rows}) GROUP BY ALL"""
    text = compose(DRIFT, *dict.fromkeys(each[5] for each in watched))
    head = text.rsplit(chr(10) + DRIFT.strip(), 1)[0]
    QUERIES[name] = f"{head},\nhistogram AS MATERIALIZED ({histogram})\n{DRIFT.strip()}"


drift(
    "anomaly_drift",
    ("fct_sales", "revenue", "CAST(round(revenue * 100, 0) AS BIGINT)", "sale_date", 1, "fct_sales"),
    ("fct_sales", "quantity", "CAST(quantity AS BIGINT)", "sale_date", 1, "fct_sales"),
    (
        "fct_inventory",
        "quantity_on_hand",
        "CAST(quantity_on_hand AS BIGINT)",
        "CAST(date_trunc('week', snapshot_date) AS DATE)",
        7,
        "fct_inventory",
    ),
)

# ---- additive model ---------------------------------------------------------
# Fixed values of the model: features in units of 2^-20, ten changepoints, waves of a year and of a month.

UNIT = 2**20
WAVES = [2.0 * math.pi * k / period for period, order in ((365.25, 10), (30.5, 3)) for k in range(1, order + 1)]
SIZE = 2 + 10 + 2 * len(WAVES) + 16
RIDGE = [1e-8] * 2 + [1.0 / 0.05**2] * 10 + [1.0 / 10.0**2] * (SIZE - 12)


def doubles(values: list[float]) -> str:
    return "[" + ", ".join(f"CAST('{v!r}' AS DOUBLE)" for v in values) + "]"


def model_features(day: str) -> str:
    """Level, slope, changepoints, sines, cosines and holiday flags of a day, as whole numbers."""
    elapsed = f"(({day} - first_day) * {2 * UNIT} + span) // (2 * span)"
    bends = ", ".join(f"greatest(0, {elapsed} - {round(UNIT * 0.8 * c / 10)})" for c in range(1, 11))
    waves = [f"list_transform({doubles(WAVES)}, lambda w: CAST(floor({turn}(CAST({day} AS DOUBLE) * w) * {UNIT} + 0.5) AS BIGINT))" for turn in ("sin", "cos")]
    flags = f"list_transform(holidays, lambda h: CAST(CASE WHEN list_contains(h, {day}) THEN {UNIT} ELSE 0 END AS BIGINT))"
    return f"list_concat([CAST({UNIT} AS BIGINT), {elapsed}, {bends}], {waves[0]}, {waves[1]}, {flags})"


fragment(
    "holiday_lists",
    f"""
SELECT list(days ORDER BY holiday, k) AS holidays
FROM (SELECT holiday, k, list(CAST(holiday_day + CAST(k AS INTEGER) - DATE '1970-01-01' AS BIGINT)) AS days
      FROM (SELECT holiday, make_date(CAST(y AS INTEGER), m, d) AS holiday_day
            FROM {HOLIDAYS}, range(1995, 2003) AS years(y) UNION ALL {MOVABLE}), range(0, 2) AS offsets(k)
      GROUP BY holiday, k)""",
)
fragment(
    "model_series",
    """
SELECT s.category, s.week_start, s.t, CAST(s.total_quantity AS BIGINT) AS y, x.first_day, x.last_day,
       greatest(x.last_day - x.first_day, 1) AS span, h.holidays,
       CAST(CASE WHEN x.last_day - x.first_day >= 322 THEN (x.last_day - x.first_day - 322) // 28 + 1 ELSE 0 END AS BIGINT) AS n_folds,
       (x.last_day - s.t) // 28 AS period
FROM series s JOIN (SELECT category, min(t) AS first_day, max(t) AS last_day FROM series GROUP BY category) x
  ON s.category = x.category, holiday_lists h""",
    "series",
    "holiday_lists",
)


def additive(name: str, fold: str, folds: str, chosen: str) -> None:
    """Fragment ``<name>_fits``: coefficients per category and fold from running sums over the folds' numbers."""
    fragment(
        f"{name}_rows",
        f"SELECT category, {fold} AS fold, y, {model_features('t')} AS f FROM model_series WHERE {chosen}",
        "model_series",
    )
    fragment(f"{name}_folds", f"SELECT DISTINCT category, k AS fold FROM model_series, range(0, 10000) AS n(k) WHERE {folds}", "model_series")
    running = "OVER (PARTITION BY category, i, j ORDER BY fold DESC)"
    fragment(
        f"{name}_gram",
        f"""
SELECT category, fold, i, j, sum(coalesce(g, 0)) {running} AS g
FROM (SELECT f.category, f.fold, i, j FROM {name}_folds f, range(1, {SIZE + 1}) AS a(i), range(1, {SIZE + 2}) AS b(j) WHERE j >= i)
LEFT JOIN (SELECT category, fold, i, j, sum(CAST(f[i] AS HUGEINT) * CASE WHEN j > {SIZE} THEN y ELSE f[j] END) AS g
           FROM {name}_rows, range(1, {SIZE + 1}) AS a(i), range(1, {SIZE + 2}) AS b(j) WHERE j >= i GROUP BY ALL)
  USING (category, fold, i, j)""",
        f"{name}_folds",
        f"{name}_rows",
    )
    later = "OVER (PARTITION BY category ORDER BY fold DESC)"
    fragment(
        f"{name}_totals",
        f"""
SELECT *, greatest(peak, CAST(1 AS DOUBLE)) AS scale, greatest((syy / n - (sy / n) * (sy / n)) / (greatest(peak, 1) * greatest(peak, 1)), 1e-6) AS noise
FROM (SELECT f.category, f.fold, CAST(sum(n) {later} AS DOUBLE) AS n, CAST(sum(sy) {later} AS DOUBLE) AS sy,
             CAST(sum(syy) {later} AS DOUBLE) AS syy, CAST(max(peak) {later} AS DOUBLE) AS peak
      FROM {name}_folds f LEFT JOIN (SELECT category, fold, count(*) AS n, sum(y) AS sy, sum(CAST(y AS HUGEINT) * y) AS syy, max(y) AS peak
                                     FROM {name}_rows GROUP BY ALL) r USING (category, fold))""",
        f"{name}_folds",
        f"{name}_rows",
    )
    fragment(
        f"{name}_fits",
        f"""
WITH RECURSIVE systems AS (
  SELECT category, fold, list(r ORDER BY i) AS m
  FROM (SELECT category, fold, i, list(v ORDER BY j) AS r
        FROM (SELECT g.category, g.fold, i, j,
                     CASE WHEN j > {SIZE} THEN CAST(g AS DOUBLE) / CAST({UNIT} AS DOUBLE) / t.scale
                          ELSE CAST(g AS DOUBLE) / CAST({UNIT**2} AS DOUBLE) + CASE WHEN i = j THEN ({doubles(RIDGE)})[i] * t.noise ELSE CAST(0 AS DOUBLE) END
                     END AS v
              FROM (SELECT category, fold, i, j, g FROM {name}_gram
                    UNION ALL SELECT category, fold, j, i, g FROM {name}_gram WHERE j > i AND j <= {SIZE}) g
              JOIN {name}_totals t ON g.category = t.category AND g.fold = t.fold)
        GROUP BY category, fold, i)
  GROUP BY category, fold
), steps AS (
  SELECT category, fold, 1 AS k, m FROM systems
  UNION ALL
  SELECT category, fold, k + 1,
         list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(m[k][2:], lambda x: x / m[k][1])
                                             ELSE list_transform(r[2:], lambda x, c: x - (r[1] / m[k][1]) * m[k][c + 1]) END)
  FROM steps WHERE k <= {SIZE}
)
SELECT s.category, s.fold, flatten(s.m) AS beta, t.scale, t.noise, t.n, t.syy, t.peak,
       (SELECT list(CAST(g AS DOUBLE) / CAST({UNIT} AS DOUBLE) / t.scale ORDER BY i) FROM {name}_gram g
        WHERE g.category = s.category AND g.fold = s.fold AND j > {SIZE}) AS rhs
FROM steps s JOIN {name}_totals t ON s.category = t.category AND s.fold = t.fold WHERE k = {SIZE + 1}""",
        f"{name}_gram",
        f"{name}_totals",
    )


def dot(features_: str, places: int = SIZE) -> str:
    return f"list_sum(list_transform(({features_})[1:{places}], lambda x, c: CAST(x AS DOUBLE) / CAST({UNIT} AS DOUBLE) * beta[c])) * scale"


additive("model_whole", "0", "k = 0", "TRUE")
additive("model_fold", "least(period, n_folds) - 1", "k < n_folds", "n_folds > 0 AND period >= 1")
SHRUNK = f"list_sum(list_transform({doubles(RIDGE)}, lambda w, c: beta[c] * beta[c] * (w * noise)))"
fragment(
    "additive_forecast",
    f"""
SELECT forecast_date, category, 'all' AS store_cluster, round(greatest(CAST(0 AS DOUBLE), least(yhat, cap)), 2) AS yhat,
       round(greatest(CAST(0 AS DOUBLE), least(yhat - band, cap)), 2) AS yhat_lower,
       round(greatest(CAST(0 AS DOUBLE), least(yhat + band, cap)), 2) AS yhat_upper, round(trend, 2) AS trend
FROM (SELECT forecast_date, category, peak * CAST(3 AS DOUBLE) AS cap, {dot('f')} AS yhat, {dot('f', 12)} AS trend,
             sqrt(greatest(syy / (scale * scale) - list_sum(list_transform(rhs, lambda x, c: x * beta[c])) - {SHRUNK}, CAST(0 AS DOUBLE))
                  / greatest(n - 2, CAST(1 AS DOUBLE))) * scale * {Z} AS band
      FROM (SELECT w.*, u.sunday AS forecast_date, {model_features("CAST(u.sunday - DATE '1970-01-01' AS BIGINT)")} AS f
            FROM model_whole_fits w JOIN (SELECT DISTINCT category, first_day, span, holidays FROM model_series) m ON w.category = m.category
            JOIN future u ON w.category = u.category))""",
    "model_whole_fits",
    "model_series",
    "future",
)
fragment(
    "additive_backtest",
    f"""
SELECT category, CAST(DATE '1970-01-01' + CAST(last_day - 28 * (fold + 1) AS INTEGER) AS DATE) AS cutoff, week_start, y, {dot('f')} AS yhat
FROM (SELECT m.*, w.fold, w.beta, w.scale, {model_features('t')} AS f
      FROM model_series m JOIN model_fold_fits w ON m.category = w.category AND m.period = w.fold)""",
    "model_series",
    "model_fold_fits",
)
fragment("additive_accuracy", FRAGMENTS["accuracy"].replace("FROM backtest", "FROM additive_backtest"), "additive_backtest")
fragment("additive_metadata", FRAGMENTS["metadata"].replace("JOIN accuracy", "JOIN additive_accuracy"), "eligibility", "additive_accuracy")
whole("forecast_additive", "additive_forecast")
add("forecast_backtest", f"SELECT category, cutoff, week_start, y, {six('yhat')} FROM additive_backtest", "additive_backtest")
add(
    "forecast_metadata",
    """
SELECT m.category, m.store_cluster, m.mape, m.rmse,
       CASE WHEN a.n_folds > 0 THEN 'success'
            ELSE 'failed: history is shorter than the initial window plus one horizon' END AS cv_status,
       m.n_weeks, m.failure_modes
FROM additive_metadata m LEFT JOIN additive_accuracy a ON m.category = a.category""",
    "additive_metadata",
    "additive_accuracy",
)

# ---- planning by product ----------------------------------------------------
fragment(
    "open_rates",
    """
SELECT store_id, product_id, category, store_cluster, CAST(count(*) FILTER (NOT masked) AS BIGINT) AS open_weeks,
       CAST(count(*) FILTER (masked) AS BIGINT) AS masked_weeks,
       CAST(sum(units) FILTER (NOT masked) AS DOUBLE) / nullif(CAST(count(*) FILTER (NOT masked) AS DOUBLE), 0) AS weekly_rate,
       CAST(coalesce(sum(units) FILTER (last_week - week_start < 28), 0) AS DOUBLE) / CAST(4 AS DOUBLE) AS recent_units,
       bool_or(masked AND last_week - week_start < 28) AS had_stockout
FROM (SELECT i.*, coalesce(s.units, 0) AS units, max(i.week_start) OVER () AS last_week
      FROM (SELECT store_id, product_id, category, store_cluster, CAST(date_trunc('week', snapshot_date) AS DATE) AS week_start,
                   bool_or(is_stockout) AS masked
            FROM fct_inventory GROUP BY ALL) i
      LEFT JOIN (SELECT store_id, product_id, CAST(date_trunc('week', sale_date) AS DATE) AS week_start, sum(quantity) AS units
                 FROM stg_sales GROUP BY ALL) s USING (store_id, product_id, week_start))
GROUP BY store_id, product_id, category, store_cluster""",
    "fct_inventory",
    "stg_sales",
)

# ---- runs over stored tables ------------------------------------------------
QUERIES["anomaly_history"] = QUERIES["anomaly_volume"]
add(
    "publish_marts",
    "\nUNION ALL ".join(
        f"SELECT '{m}' AS table_name, count(*) AS row_count, 'first' AS published_run, TRUE AS first_passed, 'store_id unique' AS second_failed FROM {m}"
        for m in MARTS
    ),
    *MARTS,
)
add(
    "planning_products",
    """
SELECT r.store_id, r.product_id, r.category, r.store_cluster, r.open_weeks, r.masked_weeks, round(r.weekly_rate, 6) AS weekly_rate,
       CASE WHEN a.mape > 80 THEN 'unreliable' WHEN r.had_stockout THEN 'recent_stockout'
            WHEN r.category = 'fresh_produce' THEN 'fresh_produce' ELSE 'point_forecast' END AS rule,
       coalesce(a.mape > 80, FALSE) AS needs_review,
       round(CASE WHEN a.mape > 80 AND r.weekly_rate / a.total IS NOT NULL THEN greatest(a.up * (r.weekly_rate / a.total), r.recent_units)
                  WHEN a.mape > 80 THEN NULL
                  WHEN r.had_stockout THEN a.up * (r.weekly_rate / a.total) * CAST(1.15 AS DOUBLE)
                  WHEN r.category = 'fresh_produce' THEN a.up * (r.weekly_rate / a.total)
                  ELSE a.mid * (r.weekly_rate / a.total) END
             + CASE WHEN r.store_cluster = 'rural' AND r.category IN ('fresh_produce', 'dairy', 'meat_seafood', 'bakery')
                    THEN a.mid * (r.weekly_rate / a.total) ELSE CAST(0 AS DOUBLE) END, 6) AS planned_weekly_units
FROM open_rates r LEFT JOIN (
  SELECT f.category, f.mid, f.up, t.total, m.mape
  FROM (SELECT category, avg(yhat) AS mid, avg(yhat_upper) AS up FROM forecast GROUP BY category) f
  JOIN (SELECT category, sum(weekly_rate) AS total FROM open_rates GROUP BY category) t ON f.category = t.category
  LEFT JOIN metadata m ON f.category = m.category) a ON r.category = a.category""",
    "open_rates",
    "forecast",
    "metadata",
)
