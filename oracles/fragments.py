"""Named SQL building blocks: raw feeds, staging, marts and forecasts over the given tables.

Each fragment is one common table expression; ``NEEDS`` lists the fragments it
reads. ``compose`` puts the needed ones in front of a final SELECT.
"""

from __future__ import annotations

AS_OF = "DATE '2001-12-01'"
ORDERS_AS_OF = "DATE '2001-07-01'"


def padded(number: str, width: int) -> str:
    return f"lpad(CAST({number} AS VARCHAR), CAST(greatest({width}, length(CAST({number} AS VARCHAR))) AS INTEGER), '0')"


def ratio(num: str, den: str, digits: int = 0) -> str:
    """Exact round-half-away of num/den in units of 10^-digits (integers in, BIGINT out)."""
    top = f"(CAST({num} AS HUGEINT) * {10**digits})"
    bottom = f"nullif(abs(CAST({den} AS HUGEINT)), 0)"
    return (
        f"CAST(((2 * abs({top}) + {bottom}) // (2 * {bottom})) * sign({top}) * sign(CAST({den} AS HUGEINT)) AS BIGINT)"
    )


def units(scaled: str, digits: int) -> str:
    return f"(CAST({scaled} AS DOUBLE) / CAST({10**digits} AS DOUBLE))"


def key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '_null_')" for c in columns)
    return f"md5(concat_ws('|', {parts}))"


def listed(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


PRICE = "CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.1 AS DECIMAL(10,2))"
COST = f"CAST({PRICE} * CAST(45 + p_partkey % 31 AS INTEGER) * 0.01 AS DECIMAL(10,2))"
STORE = "concat('STR', " + padded("(c_nationkey + 1)", 4) + ")"
STATES = ["NSW", "VIC", "QLD", "WA", "SA"]
CLUSTERS = ["metro_large", "metro_small", "suburban", "regional", "rural", "convenience"]
CATEGORIES = [
    "fresh_produce", "dairy", "bakery", "meat_seafood", "pantry", "frozen", "beverages", "health_beauty",
]

FRAGMENTS: dict[str, str] = {}
NEEDS: dict[str, tuple[str, ...]] = {}


def fragment(name: str, sql: str, *needs: str) -> None:
    FRAGMENTS[name] = sql.strip()
    NEEDS[name] = needs


fragment(
    "stores",
    f"""
SELECT concat('STR', {padded('(n_nationkey + 1)', 4)}) AS store_id, n_name AS store_name,
       ({listed(STATES)})[n_regionkey + 1] AS state, r_name AS city,
       CAST(2000 + 37 * n_nationkey AS VARCHAR) AS postcode,
       ({listed(CLUSTERS)})[n_nationkey % 6 + 1] AS store_cluster,
       DATE '2005-01-01' + CAST(97 * n_nationkey AS INTEGER) AS opened_date,
       n_nationkey % 12 <> 11 AS is_active
FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
fragment(
    "suppliers",
    f"""
SELECT concat('SUP', {padded('(s_suppkey + 1)', 4)}) AS supplier_id, s_name AS supplier_name,
       (['Australia', 'New Zealand', 'USA', 'China', 'Thailand'])[s_nationkey % 5 + 1] AS country,
       CAST(1 + s_suppkey % 20 AS BIGINT) AS lead_time_days,
       (['NET30', 'NET60', 'NET14', 'COD'])[s_suppkey % 4 + 1] AS payment_terms,
       s_suppkey % 17 <> 16 AS is_active
FROM supplier""",
)
fragment(
    "products",
    f"""
SELECT concat('PRD', {padded('(p_partkey + 1)', 6)}) AS product_id, p_name AS product_name,
       ({listed(CATEGORIES)})[p_partkey % 8 + 1] AS category,
       concat('SUP', {padded('(p_partkey % (SELECT count(*) FROM supplier) + 1)', 4)}) AS supplier_id,
       {PRICE} AS unit_price, {COST} AS cost_price,
       (['each', 'kg', 'litre', 'pack'])[p_partkey % 4 + 1] AS unit_of_measure,
       p_partkey % 20 <> 19 AS is_active, DATE '1995-01-01' AS effective_from
FROM part""",
)
fragment(
    "product_price_history",
    f"""
SELECT concat('PRD', {padded('(p_partkey + 1)', 6)}) AS product_id,
       CAST({PRICE} * factor * 0.01 AS DECIMAL(10,2)) AS unit_price,
       CAST({COST} * factor * 0.01 AS DECIMAL(10,2)) AS cost_price,
       CAST(DATE '1995-01-01' + CAST(CASE WHEN k = 0 THEN 0 ELSE 600 * k + (13 * p_partkey) % 500 END AS INTEGER)
            AS TIMESTAMP) AS effective_from,
       CAST(CASE WHEN k > 0 AND k < changes
                 THEN DATE '1995-01-01' + CAST(600 * (k + 1) + (13 * p_partkey) % 500 - 1 AS INTEGER) END
            AS TIMESTAMP) AS effective_to
FROM (SELECT *, CASE WHEN p_partkey % 10 < 3 THEN 1 + (p_partkey // 10) % 3 ELSE 0 END AS changes,
             CAST(CASE WHEN k = 0 THEN 100 ELSE 85 + (7 * p_partkey + 13 * k) % 36 END AS INTEGER) AS factor
      FROM part, range(0, 4) AS steps(k)
      WHERE k = 0 OR (p_partkey % 10 < 3 AND k <= 1 + (p_partkey // 10) % 3))""",
)
fragment(
    "inventory_snapshots",
    f"""
SELECT concat('STR', {padded('(n_nationkey + 1)', 4)}) AS store_id,
       concat('PRD', {padded('(p_partkey + 1)', 6)}) AS product_id,
       CAST(DATE '2001-08-06' + CAST(7 * w AS INTEGER) AS TIMESTAMP) AS snapshot_date,
       CAST(CASE WHEN (7 * n_nationkey + 13 * p_partkey + 31 * w) % 25 < 2 THEN 0
            ELSE greatest(0, 10 + (37 * n_nationkey + 11 * p_partkey) % 190 + (p_partkey + 17 * w) % 50 - 20)
            END AS BIGINT) AS quantity_on_hand,
       CAST(10 + (p_partkey + 3 * w) % 30 AS BIGINT) AS reorder_point,
       CAST(20 + (5 * n_nationkey + p_partkey + 3 * w) % 80 AS BIGINT) AS reorder_qty
FROM part, nation, range(0, 13) AS weeks(w)
WHERE p_partkey % 20 <> 19 AND n_nationkey % 12 <> 11 AND (p_partkey + n_nationkey) % 5 < 3""",
)
fragment(
    "pos_sales",
    f"""
SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS sale_id, {STORE} AS store_id,
       concat('PRD', {padded('(l_partkey + 1)', 6)}) AS product_id, l_shipdate AS sale_date,
       CAST(l_quantity AS BIGINT) AS quantity, {PRICE} AS unit_price,
       CAST(CAST({PRICE} * CAST(l_quantity AS INTEGER) AS DECIMAL(10,2))
            + CASE WHEN l_orderkey % 97 = 0 THEN 0.05 ELSE 0.00 END AS DECIMAL(10,2)) AS total_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey""",
)
fragment(
    "purchase_orders",
    f"""
SELECT concat('PO', {padded('o_orderkey', 8)}) AS po_id, {STORE} AS store_id,
       concat('PRD', {padded('(p_partkey + 1)', 6)}) AS product_id,
       concat('SUP', {padded('(p_partkey % (SELECT count(*) FROM supplier) + 1)', 4)}) AS supplier_id,
       o_orderdate AS order_date,
       CAST(CAST(o_orderdate AS DATE)
            + CAST(1 + (p_partkey % (SELECT count(*) FROM supplier)) % 20 AS INTEGER) AS TIMESTAMP) AS expected_date,
       CAST(20 + o_orderkey % 180 AS BIGINT) AS quantity_ordered, {COST} AS unit_cost,
       CASE WHEN o_orderkey % 20 = 0 THEN 'cancelled' WHEN o_orderstatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'O' THEN 'in_transit' ELSE 'pending' END AS status
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN part ON p_partkey = (31 * o_orderkey) % (SELECT count(*) FROM part)""",
)

fragment(
    "stg_stores",
    """
SELECT store_id, store_name, city, postcode, state, store_cluster, CAST(opened_date AS DATE) AS opened_date,
       CASE WHEN store_cluster IN ('metro_large', 'metro_small') THEN TRUE ELSE FALSE END AS is_metro, is_active
FROM stores""",
    "stores",
)
fragment(
    "stg_suppliers",
    """
SELECT supplier_id, supplier_name, country, payment_terms, CAST(lead_time_days AS INTEGER) AS lead_time_days,
       CASE WHEN is_active AND lead_time_days < 14 THEN TRUE ELSE FALSE END AS is_reliable_supplier, is_active
FROM suppliers""",
    "suppliers",
)
fragment(
    "snapshot",
    f"""
SELECT h.product_id, p.product_name, p.category, p.supplier_id, p.unit_of_measure, p.is_active,
       h.unit_price, h.cost_price,
       CAST({ratio('CAST((h.unit_price - h.cost_price) * 100 AS BIGINT) * 100', 'CAST(h.unit_price * 100 AS BIGINT)', 2)}
            * 0.01 AS DECIMAL(5,2)) AS gross_margin_pct,
       h.effective_from AS valid_from,
       lead(h.effective_from) OVER (PARTITION BY h.product_id ORDER BY h.effective_from) AS valid_to
FROM product_price_history h JOIN products p ON h.product_id = p.product_id""",
    "product_price_history",
    "products",
)
fragment(
    "stg_products",
    f"""
SELECT {key('product_id', 'valid_from')} AS product_version_key, product_id, product_name, category, supplier_id,
       unit_of_measure, unit_price, cost_price, gross_margin_pct, CAST(valid_from AS DATE) AS valid_from,
       CAST(valid_to AS DATE) AS valid_to, valid_to IS NULL AS is_current_version, is_active
FROM snapshot""",
    "snapshot",
)
fragment(
    "stg_inventory",
    f"""
SELECT {key('store_id', 'product_id', 'snapshot_date')} AS inventory_snapshot_key, store_id, product_id,
       CAST(snapshot_date AS DATE) AS snapshot_date, CAST(quantity_on_hand AS INTEGER) AS quantity_on_hand,
       CAST(reorder_point AS INTEGER) AS reorder_point, CAST(reorder_qty AS INTEGER) AS reorder_qty,
       quantity_on_hand = 0 AS is_stockout,
       quantity_on_hand > 0 AND quantity_on_hand <= reorder_point AS is_below_reorder_point
FROM inventory_snapshots""",
    "inventory_snapshots",
)
fragment(
    "stg_purchase_orders",
    f"""
SELECT po_id, store_id, product_id, supplier_id, CAST(order_date AS DATE) AS order_date,
       CAST(expected_date AS DATE) AS expected_date, CAST(quantity_ordered AS INTEGER) AS quantity_ordered,
       unit_cost, CAST(CAST(quantity_ordered AS INTEGER) * unit_cost AS DECIMAL(18,2)) AS total_order_value, status,
       CASE WHEN status IN ('in_transit', 'pending') AND {ORDERS_AS_OF} > expected_date THEN TRUE ELSE FALSE END
           AS is_late,
       status = 'delivered' AS is_fulfilled
FROM purchase_orders""",
    "purchase_orders",
)
fragment(
    "stg_sales",
    f"""
SELECT {key('sale_id', 'store_id', 'product_id', 'sale_date')} AS sale_key, sale_id, store_id, product_id,
       CAST(sale_date AS DATE) AS sale_date, CAST(extract(year FROM sale_date) AS INTEGER) AS sale_year,
       CAST(extract(month FROM sale_date) AS INTEGER) AS sale_month,
       CAST(extract(dow FROM sale_date) AS INTEGER) AS sale_dow,
       extract(dow FROM sale_date) IN (0, 6) AS is_weekend, CAST(quantity AS INTEGER) AS quantity,
       unit_price, total_amount,
       abs(total_amount - CAST(quantity AS INTEGER) * unit_price) > 0.01 AS has_price_discrepancy
FROM pos_sales
QUALIFY row_number() OVER (PARTITION BY sale_id
        ORDER BY total_amount DESC, store_id, product_id, sale_date, quantity) = 1""",
    "pos_sales",
)

fragment(
    "dim_stores",
    """
SELECT *, CASE store_cluster WHEN 'metro_large' THEN 1 WHEN 'metro_small' THEN 2 WHEN 'suburban' THEN 3
                             WHEN 'regional' THEN 4 WHEN 'rural' THEN 5 WHEN 'convenience' THEN 6 END AS cluster_tier,
       CASE state WHEN 'NSW' THEN 'New South Wales' WHEN 'VIC' THEN 'Victoria' WHEN 'QLD' THEN 'Queensland'
                  WHEN 'WA' THEN 'Western Australia' WHEN 'SA' THEN 'South Australia' END AS state_full_name
FROM stg_stores""",
    "stg_stores",
)
fragment(
    "dim_products",
    """
SELECT p.product_version_key, p.product_id, p.product_name, p.category, p.unit_of_measure, p.is_active, p.unit_price,
       p.cost_price, p.gross_margin_pct, p.valid_from, p.valid_to, p.is_current_version, s.supplier_id,
       s.supplier_name, s.lead_time_days, s.is_reliable_supplier,
       CASE WHEN p.category IN ('fresh_produce', 'dairy', 'meat_seafood', 'bakery') THEN 'Perishable'
            WHEN p.category IN ('frozen', 'pantry', 'beverages', 'health_beauty') THEN 'Non-Perishable'
       END AS perishability
FROM stg_products p LEFT JOIN stg_suppliers s ON p.supplier_id = s.supplier_id""",
    "stg_products",
    "stg_suppliers",
)
fragment("current_products", "SELECT * FROM dim_products WHERE is_current_version", "dim_products")
fragment(
    "fct_inventory",
    f"""
SELECT i.inventory_snapshot_key, i.store_id, i.product_id, i.snapshot_date, s.store_cluster, s.state, s.is_metro,
       p.product_name, p.category, p.perishability, p.supplier_name, p.lead_time_days, i.quantity_on_hand,
       i.reorder_point, i.reorder_qty,
       CAST(i.quantity_on_hand * p.cost_price AS DECIMAL(18,2)) AS inventory_value,
       {units(ratio('CAST(i.quantity_on_hand AS HUGEINT) * 7 * v.levels', 'v.total', 1), 1)} AS days_of_stock_remaining,
       CASE WHEN i.is_stockout THEN 'stockout'
            WHEN i.is_below_reorder_point AND p.lead_time_days >= 14 THEN 'critical'
            WHEN i.is_below_reorder_point THEN 'low' ELSE 'healthy' END AS stock_status,
       i.is_stockout, i.is_below_reorder_point
FROM stg_inventory i
LEFT JOIN dim_stores s ON i.store_id = s.store_id
LEFT JOIN current_products p ON i.product_id = p.product_id
LEFT JOIN (SELECT store_id, product_id, sum(quantity_on_hand) AS total, count(quantity_on_hand) AS levels
           FROM stg_inventory GROUP BY store_id, product_id) v
       ON i.store_id = v.store_id AND i.product_id = v.product_id""",
    "stg_inventory",
    "dim_stores",
    "current_products",
)
fragment(
    "fct_purchase_orders",
    f"""
SELECT o.po_id, o.store_id, o.product_id, o.supplier_id, s.store_cluster, s.state, p.product_name, p.category,
       u.supplier_name, u.lead_time_days, o.order_date, o.expected_date, o.quantity_ordered, o.unit_cost,
       o.total_order_value, o.status, CAST(o.expected_date - o.order_date AS INTEGER) AS promised_lead_days,
       CASE WHEN o.is_late THEN CAST({ORDERS_AS_OF} - o.expected_date AS INTEGER) ELSE 0 END AS days_overdue,
       o.is_late, o.is_fulfilled
FROM stg_purchase_orders o
LEFT JOIN dim_stores s ON o.store_id = s.store_id
LEFT JOIN current_products p ON o.product_id = p.product_id
LEFT JOIN stg_suppliers u ON o.supplier_id = u.supplier_id""",
    "stg_purchase_orders",
    "dim_stores",
    "current_products",
    "stg_suppliers",
)
fragment(
    "priced_sales",
    f"""
SELECT s.*, p.product_name, p.category, p.perishability, p.supplier_name, p.unit_price AS catalogue_price,
       p.cost_price, p.gross_margin_pct, p.valid_from
FROM stg_sales s
LEFT JOIN dim_products p ON s.product_id = p.product_id AND s.sale_date >= p.valid_from
      AND s.sale_date < coalesce(p.valid_to, {AS_OF} + 1)
QUALIFY row_number() OVER (PARTITION BY s.sale_key ORDER BY p.valid_from DESC, p.valid_to DESC) = 1""",
    "stg_sales",
    "dim_products",
)
fragment(
    "fct_sales",
    """
SELECT w.sale_key, w.sale_id, w.store_id, w.product_id, t.store_name, t.state, t.store_cluster, t.cluster_tier,
       t.is_metro, w.product_name, w.category, w.perishability, w.supplier_name, w.sale_date, w.sale_year,
       w.sale_month, w.sale_dow, w.is_weekend, w.quantity, w.unit_price AS pos_unit_price, w.total_amount AS revenue,
       CAST(w.quantity * (w.unit_price - w.cost_price) AS DECIMAL(18,2)) AS gross_profit, w.gross_margin_pct,
       CAST(w.unit_price - w.catalogue_price AS DECIMAL(12,2)) AS price_variance, w.has_price_discrepancy
FROM priced_sales w LEFT JOIN dim_stores t ON w.store_id = t.store_id""",
    "priced_sales",
    "dim_stores",
)
fragment(
    "fct_stockouts",
    f"""
SELECT i.store_id, i.product_id, i.snapshot_date AS stockout_date, i.stock_status, i.is_stockout,
       i.is_below_reorder_point, i.days_of_stock_remaining, i.store_cluster, i.state, i.product_name, i.category,
       i.lead_time_days,
       coalesce(CAST(a.cents AS DOUBLE) / CAST(100 AS DOUBLE) / CAST(a.sales AS DOUBLE), CAST(0 AS DOUBLE))
           AS avg_daily_revenue,
       coalesce(CAST(a.units AS DOUBLE) / CAST(a.sales AS DOUBLE), CAST(0 AS DOUBLE)) AS avg_daily_quantity,
       CASE WHEN i.is_stockout THEN {units('coalesce(' + ratio('a.cents * 7', 'a.sales') + ', 0)', 2)}
            ELSE CAST(0 AS DOUBLE) END AS estimated_lost_revenue_7d,
       CASE WHEN i.is_stockout AND i.lead_time_days >= 14 THEN 'critical'
            WHEN i.is_stockout AND i.lead_time_days < 14 THEN 'high'
            WHEN i.is_below_reorder_point THEN 'medium' ELSE 'low' END AS urgency
FROM fct_inventory i
LEFT JOIN (SELECT store_id, product_id, sum(CAST(revenue * 100 AS BIGINT)) AS cents, sum(quantity) AS units,
                  count(*) AS sales
           FROM fct_sales GROUP BY store_id, product_id) a
       ON i.store_id = a.store_id AND i.product_id = a.product_id
WHERE i.is_stockout OR i.is_below_reorder_point""",
    "fct_inventory",
    "fct_sales",
)
fragment(
    "latest",
    "SELECT * FROM fct_inventory WHERE snapshot_date = (SELECT max(snapshot_date) FROM fct_inventory)",
    "fct_inventory",
)

fragment(
    "weekly_all",
    """
SELECT CAST(date_trunc('week', sale_date) AS DATE) AS week_start, category,
       CAST(sum(quantity) AS BIGINT) AS total_quantity, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue,
       count(DISTINCT store_id) AS store_count
FROM fct_sales GROUP BY 1, 2""",
    "fct_sales",
)
fragment(
    "weekly",
    "SELECT * FROM weekly_all WHERE week_start > (SELECT min(week_start) FROM weekly_all)",
    "weekly_all",
)
fragment(
    "eligibility",
    """
SELECT category, n_weeks, zero_weeks, first_week, last_week,
       CASE WHEN n_weeks < 26 OR zero_weeks / n_weeks > 0.3 THEN 'skipped' ELSE 'eligible' END AS status,
       CASE WHEN n_weeks < 26 THEN concat('Only ', n_weeks, ' weeks of history')
            WHEN zero_weeks / n_weeks > 0.3
            THEN concat('Too many zero weeks (', CAST(round_even(100 * zero_weeks / n_weeks, 0) AS INTEGER),
                        '%) — sparse data') END AS reason
FROM (SELECT category, count(*) AS n_weeks, count(*) FILTER (WHERE total_quantity = 0) AS zero_weeks,
             min(week_start) AS first_week, max(week_start) AS last_week
      FROM weekly GROUP BY category)""",
    "weekly",
)
fragment(
    "series",
    """
SELECT w.*, CAST(w.week_start - DATE '1970-01-01' AS BIGINT) AS t FROM weekly w
WHERE category IN (SELECT category FROM eligibility WHERE status = 'eligible' AND category IS NOT NULL)""",
    "weekly",
    "eligibility",
)


def line(source: str, group: str, extra: str = "") -> str:
    """Least-squares line of total_quantity on t per group, from exact integer sums."""
    return f"""
SELECT *, CAST(n * sty - st * sy AS DOUBLE) / nullif(CAST(n * stt - st * st AS DOUBLE), 0) AS slope,
       CAST(st AS DOUBLE) / CAST(n AS DOUBLE) AS t_mean, CAST(sy AS DOUBLE) / CAST(n AS DOUBLE) AS y_mean,
       sqrt(greatest(CAST(n * syy - sy * sy AS DOUBLE)
                     - CAST(n * sty - st * sy AS DOUBLE) * CAST(n * sty - st * sy AS DOUBLE)
                       / nullif(CAST(n * stt - st * st AS DOUBLE), 0), CAST(0 AS DOUBLE))
            / nullif(CAST(n * (n - 2) AS DOUBLE), 0)) AS sigma
FROM (SELECT {group}, CAST(count(*) AS HUGEINT) AS n, sum(t) AS st, sum(total_quantity) AS sy, sum(t * t) AS stt,
             sum(t * total_quantity) AS sty, sum(CAST(total_quantity AS HUGEINT) * total_quantity) AS syy{extra}
      FROM {source} GROUP BY {group})"""


fragment(
    "fitted",
    line("series", "category", ", max(week_start) AS last_week, max(total_quantity) AS peak"),
    "series",
)
Z = "CAST(1.2815515655446004 AS DOUBLE)"
fragment(
    "future",
    """
SELECT category, CAST(h AS INTEGER) AS step,
       last_week + CAST(7 - CASE WHEN isodow(last_week) = 7 THEN 0 ELSE isodow(last_week) END + 7 * (h - 1) AS INTEGER)
           AS sunday,
       last_week + CAST(7 * h AS INTEGER) AS monday
FROM (SELECT category, max(week_start) AS last_week FROM weekly GROUP BY category), range(1, 13) AS steps(h)""",
    "weekly",
)
fragment(
    "forecast",
    f"""
SELECT sunday AS forecast_date, category, 'all' AS store_cluster,
       greatest(CAST(0 AS DOUBLE), least(trend, cap)) AS yhat,
       greatest(CAST(0 AS DOUBLE), least(trend - sigma * {Z}, cap)) AS yhat_lower,
       greatest(CAST(0 AS DOUBLE), least(trend + sigma * {Z}, cap)) AS yhat_upper, trend
FROM (SELECT f.category, f.sigma, u.sunday, CAST(f.peak AS DOUBLE) * CAST(3 AS DOUBLE) AS cap,
             f.y_mean + f.slope * (CAST(u.sunday - DATE '1970-01-01' AS DOUBLE) - f.t_mean) AS trend
      FROM fitted f JOIN future u ON f.category = u.category)""",
    "fitted",
    "future",
)
fragment(
    "cutoffs",
    """
SELECT category, CAST(last_week - CAST(28 + 28 * k AS INTEGER) AS DATE) AS cutoff
FROM (SELECT category, min(week_start) AS first_week, max(week_start) AS last_week FROM series GROUP BY category),
     range(0, 10000) AS steps(k)
WHERE last_week - CAST(28 + 28 * k AS INTEGER) >= first_week + 294""",
    "series",
)
fragment(
    "training",
    "SELECT s.*, c.cutoff FROM series s JOIN cutoffs c ON s.category = c.category AND s.week_start <= c.cutoff",
    "series",
    "cutoffs",
)
fragment("fold_fits", line("training", "category, cutoff"), "training")
fragment(
    "backtest",
    """
SELECT f.category, f.cutoff, s.week_start, s.total_quantity AS y,
       f.y_mean + f.slope * (CAST(s.t AS DOUBLE) - f.t_mean) AS yhat
FROM fold_fits f JOIN series s
  ON f.category = s.category AND s.week_start > f.cutoff AND s.week_start <= f.cutoff + 28""",
    "fold_fits",
    "series",
)
fragment(
    "accuracy",
    """
SELECT category, round(avg(ape) * 100, 2) AS mape, round(avg(rmse), 2) AS rmse, max(n_folds) AS n_folds
FROM (SELECT category, week_start - cutoff AS ahead,
             avg(CASE WHEN y <> 0 THEN abs(yhat - y) / y END) AS ape, sqrt(avg((yhat - y) * (yhat - y))) AS rmse,
             count(DISTINCT cutoff) AS n_folds
      FROM backtest GROUP BY 1, 2) GROUP BY category""",
    "backtest",
)
fragment(
    "metadata",
    """
SELECT s.category, 'all' AS store_cluster, a.mape, a.rmse, s.n_weeks,
       CAST(to_json(CASE WHEN len(found) = 0 THEN ['No known failure modes detected.'] ELSE found END) AS VARCHAR)
           AS failure_modes
FROM (SELECT e.category, e.n_weeks, list_filter([
        CASE WHEN a.mape > 25 THEN concat('High forecast error (MAPE ', a.mape, '%) — treat with caution.') END,
        CASE WHEN e.n_weeks < 40 THEN concat('Limited history (', e.n_weeks, ' weeks). Higher uncertainty.') END,
        CASE WHEN 100 * e.zero_weeks / e.n_weeks > 10
             THEN concat('Zero-sales rate ', CAST(round_even(100 * e.zero_weeks / e.n_weeks, 0) AS INTEGER),
                         '% — stockouts may suppress true demand.') END,
        CASE WHEN e.category = 'fresh_produce'
             THEN 'Fresh produce sensitive to weather/promotions not in model.' END], lambda x: x IS NOT NULL) AS found
      FROM eligibility e LEFT JOIN accuracy a ON e.category = a.category
      WHERE e.status = 'eligible' AND e.category IS NOT NULL) s
LEFT JOIN accuracy a ON s.category = a.category""",
    "eligibility",
    "accuracy",
)
fragment(
    "cluster_forecast",
    """
SELECT f.forecast_date, f.category, s.store_cluster, f.yhat * s.share AS yhat, f.yhat_lower * s.share AS yhat_lower,
       f.yhat_upper * s.share AS yhat_upper, f.trend * s.share AS trend
FROM forecast f
JOIN (SELECT category, store_cluster,
             CAST(sum(quantity) AS DOUBLE) / CAST(sum(sum(quantity)) OVER (PARTITION BY category) AS DOUBLE) AS share
      FROM fct_sales GROUP BY category, store_cluster) s ON f.category = s.category""",
    "forecast",
    "fct_sales",
)


def reorder_columns(multiplier: str) -> str:
    """Reorder arithmetic over columns a (average), u (upper average) and the latest inventory."""
    lead = "a / CAST(7 AS DOUBLE) * lead_time_days"
    safety = f"u / CAST(7 AS DOUBLE) * lead_time_days * ({multiplier} - CAST(1 AS DOUBLE))"
    should = (
        f"(coalesce(quantity_on_hand <= {lead} + {safety}, FALSE)"
        " OR coalesce(stock_status IN ('stockout', 'critical'), FALSE))"
    )
    wanted = f"a / CAST(7 AS DOUBLE) * 28 - quantity_on_hand + {safety}"
    return f"""store_id, product_id, product_name, supplier_name, category, store_cluster,
       quantity_on_hand AS current_stock, stock_status, days_of_stock_remaining, lead_time_days,
       round_even(a, 1) AS avg_weekly_forecast, round_even({lead}, 1) AS demand_during_lead_time,
       round_even({safety}, 1) AS safety_stock, round_even({lead} + {safety}, 1) AS calc_reorder_point,
       {should} AS should_reorder,
       CASE WHEN {should} THEN round_even(greatest(CAST(0 AS DOUBLE), {wanted}), 0) ELSE CAST(0 AS DOUBLE) END
           AS recommended_order_qty"""


fragment(
    "reorder_topdown",
    f"""
SELECT {reorder_columns("CAST(CASE stock_status WHEN 'stockout' THEN 1.5 WHEN 'critical' THEN 1.3 WHEN 'low' THEN 1.1 ELSE 1.0 END AS DOUBLE)")}
FROM (SELECT i.*, c.avg_week * share AS a, c.avg_upper * share AS u
      FROM (SELECT i.*, CAST(coalesce(s.units, 0) AS DOUBLE) / CAST(t.units AS DOUBLE) AS share
            FROM latest i
            LEFT JOIN (SELECT category, store_id, product_id, sum(quantity) AS units FROM fct_sales GROUP BY ALL) s
                   ON i.category = s.category AND i.store_id = s.store_id AND i.product_id = s.product_id
            LEFT JOIN (SELECT category, sum(quantity) AS units FROM fct_sales GROUP BY category) t
                   ON i.category = t.category) i
      LEFT JOIN (SELECT category, avg(yhat) AS avg_week, avg(yhat_upper) AS avg_upper FROM forecast
                 GROUP BY category) c ON i.category = c.category)""",
    "latest",
    "fct_sales",
    "forecast",
)
fragment(
    "reorder_literal",
    f"""
SELECT {reorder_columns("CAST(CASE stock_status WHEN 'critical' THEN 1.5 WHEN 'high' THEN 1.3 WHEN 'medium' THEN 1.1 ELSE 1.0 END AS DOUBLE)")}
FROM (SELECT i.*, c.a, c.u FROM latest i
      LEFT JOIN (SELECT category, store_cluster, avg(yhat) AS a, avg(yhat_upper) AS u FROM forecast
                 GROUP BY category, store_cluster) c
             ON i.category = c.category AND i.store_cluster = c.store_cluster)""",
    "latest",
    "forecast",
)


def compose(final: str, *needs: str) -> str:
    """WITH the needed fragments (and theirs) in reading order, then the final SELECT."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for need in NEEDS[name]:
                visit(need)
            ordered.append(name)

    for need in needs:
        visit(need)
    if not ordered:
        return final.strip()
    body = ",\n".join(f"{name} AS MATERIALIZED ({FRAGMENTS[name]})" for name in ordered)
    return f"WITH {body}\n{final.strip()}"
