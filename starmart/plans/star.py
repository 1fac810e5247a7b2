"""The clean layer and the star schema as values of lazy DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

from starmart.plans import clean, dims, fact
from starmart.session import stage_rows
from starmart.sources.raw import RawSources


@dataclass(frozen=True)
class CleanTables:
    customers: DataFrame
    sellers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f"tb_{f.name}": getattr(self, f.name) for f in fields(self)}


@dataclass(frozen=True)
class Star:
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_seller: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame
    # Clean order headers with text-free timestamps, kept after cleanup
    # for the queries that need purchase / delivery times.
    orders_snapshot: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def clean_all(raw: RawSources) -> CleanTables:
    customers = clean.clean_customers(raw.customers)
    sellers = clean.clean_sellers(raw.sellers)
    products = clean.clean_products(raw.products)
    orders = clean.clean_orders(raw.orders, customers)
    items = clean.clean_order_items(raw.items, orders, products, sellers)
    return CleanTables(customers, sellers, products, orders, items)


def clean_parents(raw: RawSources) -> CleanTables:
    """``clean_all`` with every table but the items written once, as a load does: the items and the star read them often."""
    customers = stage_rows(clean.clean_customers(raw.customers))
    sellers = stage_rows(clean.clean_sellers(raw.sellers))
    products = stage_rows(clean.clean_products(raw.products))
    orders = stage_rows(clean.clean_orders(raw.orders, customers))
    items = clean.clean_order_items(raw.items, orders, products, sellers)
    return CleanTables(customers, sellers, products, orders, items)


def build_star(tb: CleanTables, existing: Star | None = None, load_date=None) -> tuple[Star, Star]:
    """One load over the clean layer.

    Returns ``(added, whole)``: the rows this load adds to each table, and
    each table after the load (existing ∪ added). With ``existing=None``
    this is the first load into an empty warehouse.
    """
    ex = existing
    new_date = dims.new_dim_date(tb.orders, ex.dim_date if ex else None)
    new_customer = dims.new_dim_customer(tb.customers, ex.dim_customer if ex else None, load_date)
    new_product = dims.new_dim_product(tb.products, ex.dim_product if ex else None)
    new_seller = dims.new_dim_seller(tb.sellers, ex.dim_seller if ex else None)

    def whole(old, new):
        return new if old is None else old.unionByName(new)

    dim_date = whole(ex and ex.dim_date, new_date)
    dim_customer = whole(ex and ex.dim_customer, new_customer)
    dim_product = whole(ex and ex.dim_product, new_product)
    dim_seller = whole(ex and ex.dim_seller, new_seller)

    candidates = fact.fact_candidates(tb.order_items, tb.orders, dim_customer, dim_product, dim_seller, dim_date)
    new_fact = fact.new_fact_sales(candidates, ex.fact_sales if ex else None)
    fact_sales = whole(ex and ex.fact_sales, new_fact)

    added = Star(new_customer, new_product, new_seller, new_date, new_fact, tb.orders)
    after = Star(dim_customer, dim_product, dim_seller, dim_date, fact_sales, tb.orders)
    return added, after
