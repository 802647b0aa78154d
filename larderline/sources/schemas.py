"""Column layouts of the seven raw feeds."""

from __future__ import annotations

STORES = (
    "store_id string, store_name string, state string, city string, postcode string, "
    "store_cluster string, opened_date date, is_active boolean"
)
SUPPLIERS = (
    "supplier_id string, supplier_name string, country string, lead_time_days bigint, "
    "payment_terms string, is_active boolean"
)
PRODUCTS = (
    "product_id string, product_name string, category string, supplier_id string, "
    "unit_price double, cost_price double, unit_of_measure string, is_active boolean, "
    "effective_from date"
)
PRODUCT_PRICE_HISTORY = (
    "product_id string, unit_price double, cost_price double, "
    "effective_from timestamp_ntz, effective_to timestamp_ntz"
)
INVENTORY_SNAPSHOTS = (
    "store_id string, product_id string, snapshot_date timestamp_ntz, "
    "quantity_on_hand bigint, reorder_point bigint, reorder_qty bigint"
)
POS_SALES = (
    "sale_id string, store_id string, product_id string, sale_date timestamp_ntz, "
    "quantity bigint, unit_price double, total_amount double"
)
PURCHASE_ORDERS = (
    "po_id string, store_id string, product_id string, supplier_id string, "
    "order_date timestamp_ntz, expected_date timestamp_ntz, quantity_ordered bigint, "
    "unit_cost double, status string"
)

RAW_SCHEMAS: dict[str, str] = {
    "stores": STORES,
    "suppliers": SUPPLIERS,
    "products": PRODUCTS,
    "product_price_history": PRODUCT_PRICE_HISTORY,
    "inventory_snapshots": INVENTORY_SNAPSHOTS,
    "pos_sales": POS_SALES,
    "purchase_orders": PURCHASE_ORDERS,
}
