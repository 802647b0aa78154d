"""All tables of the warehouse over one set of raw feeds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame

from larderline.operators.joins import may_broadcast
from larderline.operators.reuse import read_whole
from larderline.plans import dimensions, facts, staging
from larderline.sources.publish import Gate, Publication
from larderline.sources.raw import RawTables
from larderline.sources.sinks import write_mart


@dataclass(frozen=True)
class Warehouse:
    """Lazy staging tables, dimensions and facts; ``as_of`` is the reference day ("today")."""

    raw: RawTables
    as_of: date
    orders_as_of: date | None = None
    #: For one query over several models of the sales: they read the same rows and columns, which are made once.
    sales_shared: bool = False

    @cached_property
    def pos_sales(self) -> DataFrame:
        return read_whole(self.raw.pos_sales, "pos_sales") if self.sales_shared else self.raw.pos_sales

    @cached_property
    def stg_stores(self) -> DataFrame:
        return staging.stg_stores(self.raw.stores)

    @cached_property
    def stg_suppliers(self) -> DataFrame:
        return staging.stg_suppliers(self.raw.suppliers)

    @cached_property
    def product_snapshot(self) -> DataFrame:
        return staging.product_snapshot(self.raw.product_price_history, self.raw.products)

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.product_snapshot)

    @cached_property
    def stg_inventory(self) -> DataFrame:
        return staging.stg_inventory(self.raw.inventory_snapshots)

    @cached_property
    def stg_purchase_orders(self) -> DataFrame:
        return staging.stg_purchase_orders(self.raw.purchase_orders, self.orders_as_of or self.as_of)

    @cached_property
    def first_sales(self) -> DataFrame:
        first = staging.first_sales(self.pos_sales)
        return read_whole(first, "first_sales") if self.sales_shared else first

    @cached_property
    def stg_sales(self) -> DataFrame:
        return staging.staged_sales(self.first_sales)

    @cached_property
    def dim_stores(self) -> DataFrame:
        return dimensions.dim_stores(self.stg_stores)

    @cached_property
    def dim_products(self) -> DataFrame:
        return dimensions.dim_products(self.stg_products, self.stg_suppliers)

    @cached_property
    def _many_products(self) -> bool:
        """Products that cannot be sent to every task: stock is put together by product, so that it meets them in place."""
        return not may_broadcast(self.raw.products)

    @cached_property
    def _stock(self) -> DataFrame:
        return self.raw.together("inventory_snapshots", "product_id") if self._many_products else self.raw.inventory_snapshots

    @cached_property
    def fct_inventory(self) -> DataFrame:
        return facts.fct_inventory(self._stock, self.dim_stores, self.dim_products, by_product=self._many_products)

    @cached_property
    def fct_purchase_orders(self) -> DataFrame:
        return facts.fct_purchase_orders(
            self.stg_purchase_orders,
            self.dim_stores,
            self.dim_products,
            self.stg_suppliers,
            self.orders_as_of or self.as_of,
        )

    @cached_property
    def fct_sales(self) -> DataFrame:
        return facts.fct_sales(self.first_sales, self.dim_products, self.dim_stores, self.as_of)

    @cached_property
    def daily_demand(self) -> DataFrame:
        return facts.daily_demand(self.stg_sales, self.dim_products, self.dim_stores, self.as_of)

    @cached_property
    def fct_stockouts(self) -> DataFrame:
        return facts.fct_stockouts(self.fct_inventory, self.stg_sales)

    def written_marts(self, folder: str) -> Iterator[tuple[str, DataFrame]]:
        """Write the marts under a new ``folder`` one by one and yield each as read back; later marts read earlier ones."""
        as_of_orders = self.orders_as_of or self.as_of

        def put(name: str, df: DataFrame, partition_by: str | None = None, together: bool = False, in_place: bool = False) -> tuple[str, DataFrame]:
            return name, write_mart(df, f"{folder}/{name}", partition_by, together, in_place)

        yield (made := put("dim_stores", self.dim_stores))
        stores = made[1]
        yield (made := put("dim_products", self.dim_products))
        products = made[1]
        # Large tables of few days stay in the partitions they were joined in: every task writes to each day.
        large = self._many_products
        stock = facts.fct_inventory(self._stock, stores, products, by_day=not large, by_product=large)
        yield (made := put("fct_inventory", stock, "snapshot_date", together=True, in_place=large))
        inventory = made[1]
        orders = facts.fct_purchase_orders(self.stg_purchase_orders, stores, products, self.stg_suppliers, as_of_orders)
        yield put("fct_purchase_orders", orders)
        # Sales are put together once for both of their marts, so their feeds are not on disk beside these marts' exchanges.
        sales = write_mart(self.first_sales, f"{folder}/first_sales")
        yield put("fct_sales", facts.fct_sales(sales, products, stores, self.as_of, by_day=True), "sale_date", together=True)
        yield put("fct_stockouts", facts.fct_stockouts(inventory, staging.staged_sales(sales)), "stockout_date", in_place=large)

    def write_marts(self, folder: str) -> dict[str, DataFrame]:
        """Every mart under a new ``folder``."""
        return dict(self.written_marts(folder))

    def publish_marts(self, publication: Publication, run: str, gate: Gate) -> list:
        """Write all marts as ``run``, check each as written, publish if all pass; returns the failing tests."""
        return publication.publish(run, self.written_marts(publication.run_folder(run)), gate)
