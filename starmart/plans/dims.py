"""Dimension loads: the rows each load adds (insert-only, rerun-safe).

Each function takes the clean source and the dimension as it stands and
returns only the new rows, with surrogate keys continuing after the
largest existing key. Running a load twice over unchanged input returns no
rows the second time.

The customer dimension is insert-only: new ids get ``effective_from`` =
load date, ``effective_to`` NULL and ``is_current`` TRUE; nothing closes or
compares attribute versions (the source does not either).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import iso_day_of_week, iso_week
from starmart.operators import absent_from, assign_surrogate_keys, day_series, next_key


def _empty(spark, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


def _load_date(load_date: _dt.date | str | Column | None) -> Column:
    if load_date is None:
        return F.current_date()
    if isinstance(load_date, Column):
        return load_date.cast("date")
    return F.lit(str(load_date)).cast("date")


def calendar_days(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last purchase date of the orders.

    Bounds come from one global min/max aggregate (partial per task, one
    row at the end); days with no order inside the range are included.
    """
    purchase = F.to_date("order_purchase_timestamp")
    bounds = orders.agg(F.min(purchase).alias("lo"), F.max(purchase).alias("hi"))
    days = day_series(bounds, "lo", "hi", "full_date")
    d = F.col("full_date")
    return days.select(
        d,
        F.year(d).cast("int").alias("year"),
        F.month(d).cast("int").alias("month"),
        F.dayofmonth(d).cast("int").alias("day"),
        F.quarter(d).cast("int").alias("quarter"),
        iso_day_of_week(d).alias("day_of_week"),
        iso_week(d).alias("week_of_year"),
    )


def new_dim_date(orders: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Days not yet in ``dim_date`` (insert-if-absent on ``full_date``)."""
    days = calendar_days(orders)
    if existing is None:
        existing = _empty(orders.sparkSession, schemas.DIM_DATE)
    new = absent_from(days, existing, ["full_date"])
    keyed = assign_surrogate_keys(new, ["full_date"], "date_sk", next_key(existing, "date_sk"))
    return keyed.select(*schemas.DIM_DATE.fieldNames())


def new_dim_customer(
    customers: DataFrame, existing: DataFrame | None = None, load_date=None
) -> DataFrame:
    if existing is None:
        existing = _empty(customers.sparkSession, schemas.DIM_CUSTOMER)
    new = absent_from(customers.select("customer_id"), existing, ["customer_id"])
    keyed = assign_surrogate_keys(new, ["customer_id"], "customer_sk", next_key(existing, "customer_sk"))
    return keyed.select(
        "customer_sk",
        "customer_id",
        _load_date(load_date).alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def _new_simple_dim(source: DataFrame, existing: DataFrame | None, id_col: str, sk_col: str, schema) -> DataFrame:
    if existing is None:
        existing = _empty(source.sparkSession, schema)
    new = absent_from(source.select(id_col), existing, [id_col])
    keyed = assign_surrogate_keys(new, [id_col], sk_col, next_key(existing, sk_col))
    return keyed.select(sk_col, id_col)


def new_dim_product(products: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _new_simple_dim(products, existing, "product_id", "product_sk", schemas.DIM_PRODUCT)


def new_dim_seller(sellers: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _new_simple_dim(sellers, existing, "seller_id", "seller_sk", schemas.DIM_SELLER)
