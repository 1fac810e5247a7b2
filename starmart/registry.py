"""Named queries over a folder of test tables: ``name -> fn(spark, sf_dir)``.

Two kinds:

* **load steps** (cleaning, dimension and fact loads) run from the raw test
  tables: the clean layer is planned lazily; surrogate keys write their
  positions to the checkpoint folder as a load does;
* **increments** load two batches one after the other, an early partial
  delivery and then everything, and return a table as it stands after both;
* **warehouse queries** (audits and analytics) read a warehouse that the
  load job built from the same tables. It is built once per application and
  input folder, into the shared checkpoint folder (a written table, not an
  in-memory cache), exactly as a scheduled load would precede the reports.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.load import run_load
from starmart.plans import analytics, clean, dims, quality
from starmart.plans.star import CleanTables, Star, build_star, clean_all, clean_parents
from starmart.session import scratch_path, stage_rows
from starmart.sinks import export
from starmart.sinks.warehouse import Warehouse
from starmart.sources import csv
from starmart.sources.raw import RawSources
from starmart.sources.testdata import load_testdata

_lock = threading.Lock()
_built: dict[tuple[str, str], str] = {}


def warehouse_root(spark: SparkSession, sf_dir: str) -> str:
    """Root of the warehouse loaded from ``sf_dir`` (built on first use)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _lock:
        root = _built.get(key)
        if root is None or not Warehouse(spark, root).exists("fact_sales"):
            root = scratch_path(spark, "warehouse")
            run_load(spark, _inputs(spark, sf_dir), root, stage_inputs=False, keep_intermediate=True, audit=False)
            _built[key] = root
        return root


def _inputs(spark: SparkSession, sf_dir: str) -> RawSources:
    """The raw inputs of a load, the orders (a join of two tables, read once for each table and batch) written as delivered."""
    raw = load_testdata(spark, sf_dir)
    return replace(raw, orders=stage_rows(raw.orders))


def stored(spark: SparkSession, sf_dir: str) -> tuple[CleanTables, Star]:
    wh = Warehouse(spark, warehouse_root(spark, sf_dir))
    return wh.read_clean(), wh.read_star()


def _clean(spark: SparkSession, sf_dir: str) -> CleanTables:
    return clean_all(load_testdata(spark, sf_dir))


def _first_load(spark: SparkSession, sf_dir: str) -> Star:
    tb = clean_parents(_inputs(spark, sf_dir))
    added, _ = build_star(tb)
    return added


def _batches(raw: RawSources) -> tuple[RawSources, RawSources]:
    """An early delivery that lacks members, late orders and later item numbers, and the whole of it."""
    lacks = lambda df, key, digit: df.where(~F.col(key).endswith(digit))
    early = RawSources(
        orders=raw.orders.where(F.col("order_purchase_timestamp") < F.lit("1995-06-01").cast("timestamp_ntz")),
        items=raw.items.where("order_item_id <= 3"),
        customers=lacks(raw.customers, "customer_id", "7"),
        products=lacks(raw.products, "product_id", "5"),
        sellers=lacks(raw.sellers, "seller_id", "3"),
    )
    return early, raw


def twice_loaded(spark: SparkSession, sf_dir: str) -> Star:
    """The star after both batches (built on first use)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/") + "#increment")
    with _lock:
        root = _built.get(key)
        if root is None or not Warehouse(spark, root).exists("fact_sales"):
            root = scratch_path(spark, "warehouse")
            for batch in _batches(_inputs(spark, sf_dir)):
                run_load(spark, batch, root, stage_inputs=False, audit=False)
            _built[key] = root
        return Warehouse(spark, root).read_star()


def _after_both(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: fn(twice_loaded(spark, sf))


def csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """The five inputs of ``sf_dir`` as folders of CSV files (written on first use)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/") + "#csv")
    with _lock:
        if key not in _built:
            root = scratch_path(spark, "csv")
            for name, df in load_testdata(spark, sf_dir).as_dict().items():
                df.write.option("header", True).option("escape", '"').csv(f"{root}/{csv.FILE_NAMES[name]}")
            _built[key] = root
        return _built[key]


def _from_csv(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{csv_folder(spark, sf_dir)}/{csv.FILE_NAMES[name]}"
        found = csv.read_with_rejects(spark, path, schemas.RAW_SCHEMAS[name], multiline=False)
        if not found.rejects.isEmpty():
            raise csv.RejectedRecords(path)
        return found.rows

    return query


def text_delivery_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery days over a snapshot whose times are text, as the raw files have them."""
    orders = csv.text_orders(spark, f"{csv_folder(spark, sf_dir)}/{csv.FILE_NAMES['orders']}", multiline=False)
    return analytics.delivery_days(clean.snapshot_orders(csv.typed_orders(orders)))


def catalog_monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over unqualified names, which resolve in the registered default database."""
    Warehouse(spark, warehouse_root(spark, sf_dir)).register("analytics", use=False)
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase("analytics")
    try:
        return spark.sql(
            "SELECT year, month, CAST(SUM(price + freight_value) AS DECIMAL(38,2)) AS total_vendas "
            "FROM fact_sales JOIN dim_date USING (date_sk) GROUP BY year, month"
        )
    finally:
        spark.catalog.setCurrentDatabase(before)


def profile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = Warehouse(spark, warehouse_root(spark, sf_dir))
    names = (*schemas.STAR_ORDER, wh.SNAPSHOT)
    return export.profile_report(spark, {n: partial(wh.read, n) for n in names})


def _raw(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: getattr(load_testdata(spark, sf), name)


def _on_star(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: fn(stored(spark, sf)[1])


def _on_both(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: fn(*stored(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # analytics (flagship first)
    "monthly_revenue": _on_star(analytics.monthly_revenue),
    "top_products": _on_star(analytics.top_products),
    "sales_cube": _on_star(analytics.sales_cube),
    "cohort_retention": _on_star(analytics.cohort_retention),
    "monthly_average_ticket": _on_star(analytics.monthly_average_ticket),
    "top_items_labelled": _on_star(analytics.top_items_labelled),
    "monthly_revenue_label": _on_star(analytics.monthly_revenue_label),
    "top_customers": _on_star(analytics.top_customers),
    "monthly_delivery_days": _on_star(analytics.monthly_delivery_days),
    "best_worst_month": _on_star(analytics.best_worst_month),
    # audits
    "validate_counts": _on_both(quality.validate_counts),
    "validate_null_keys": _on_star(quality.validate_null_keys),
    "validate_price_sum": _on_both(quality.validate_price_sum),
    "audit_constraints": _on_both(quality.audit_constraints),
    # exports
    "warehouse_dump": lambda spark, sf: export.dump_statements(
        {k: v for k, v in stored(spark, sf)[1].as_dict().items() if k != "orders_snapshot"}
    ),
    "table_profile": lambda spark, sf: export.table_profile(spark, stored(spark, sf)[1].as_dict()),
    # inputs (the stand-in for the five source files)
    "staging_orders": _raw("orders"),
    "staging_items": _raw("items"),
    "staging_customers": _raw("customers"),
    "staging_products": _raw("products"),
    "staging_sellers": _raw("sellers"),
    # the same five as CSV files, split and checked record by record
    "csv_orders": _from_csv("orders"),
    "csv_items": _from_csv("items"),
    "csv_customers": _from_csv("customers"),
    "csv_products": _from_csv("products"),
    "csv_sellers": _from_csv("sellers"),
    "text_delivery_days": text_delivery_days,
    # the catalog, the chart date and the preview
    "catalog_monthly_revenue": catalog_monthly_revenue,
    "monthly_revenue_period": _on_star(lambda star: analytics.with_period(analytics.monthly_revenue(star))),
    "monthly_revenue_preview": _on_star(lambda star: analytics.preview(analytics.monthly_revenue(star))),
    "table_profile_report": profile_report,
    # load steps, planned from the raw tables
    "clean_customers": lambda spark, sf: _clean(spark, sf).customers,
    "clean_sellers": lambda spark, sf: _clean(spark, sf).sellers,
    "clean_products": lambda spark, sf: _clean(spark, sf).products,
    "clean_orders": lambda spark, sf: _clean(spark, sf).orders,
    "clean_order_items": lambda spark, sf: _clean(spark, sf).order_items,
    "load_dim_date": lambda spark, sf: dims.new_dim_date(_clean(spark, sf).orders),
    "load_dim_customer": lambda spark, sf: dims.new_dim_customer(_clean(spark, sf).customers),
    "load_dim_product": lambda spark, sf: dims.new_dim_product(_clean(spark, sf).products),
    "load_dim_seller": lambda spark, sf: dims.new_dim_seller(_clean(spark, sf).sellers),
    "load_fact_sales": lambda spark, sf: _first_load(spark, sf).fact_sales,
    # a second load onto a first one
    "increment_dim_date": _after_both(lambda star: star.dim_date),
    "increment_dim_customer": _after_both(lambda star: star.dim_customer),
    "increment_dim_product": _after_both(lambda star: star.dim_product),
    "increment_dim_seller": _after_both(lambda star: star.dim_seller),
    "increment_fact_sales": _after_both(lambda star: star.fact_sales),
    "increment_cohort": _after_both(analytics.cohort_retention),
}
