"""Clean relational layer: ids normalised, defaults filled, one row per key,
children kept only when their parents exist.

Every function is DataFrame → DataFrame. Key columns go through
``required``: a NULL primary key fails the job, as the constrained target
table would — after the parent joins, which drop a row that matches no parent
whatever its own key is. Duplicate keys keep the first row under a total order of the
other columns (the source picks an arbitrary one; this pick is repeatable).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import clean_id, required
from starmart.functions import defaults as dv
from starmart.operators import distinct_on, first_by_key, present_in


def clean_customers(raw: DataFrame) -> DataFrame:
    df = raw.select(
        required(clean_id("customer_id"), "tb_customers.customer_id").alias("customer_id"),
        required(clean_id("customer_unique_id"), "tb_customers.customer_unique_id").alias("customer_unique_id"),
        F.coalesce("customer_zip_code_prefix", F.lit(dv.DEFAULT_ZIP)).alias("customer_zip_code_prefix"),
        F.coalesce("customer_city", F.lit(dv.DEFAULT_CITY)).alias("customer_city"),
        F.coalesce("customer_state", F.lit(dv.DEFAULT_STATE)).alias("customer_state"),
    )
    return distinct_on(df, ["customer_id"])


def clean_sellers(raw: DataFrame) -> DataFrame:
    df = raw.select(
        required(clean_id("seller_id"), "tb_sellers.seller_id").alias("seller_id"),
        F.coalesce("seller_zip_code_prefix", F.lit(dv.DEFAULT_ZIP)).alias("seller_zip_code_prefix"),
        F.coalesce("seller_city", F.lit(dv.DEFAULT_CITY)).alias("seller_city"),
        F.coalesce("seller_state", F.lit(dv.DEFAULT_STATE)).alias("seller_state"),
    )
    return distinct_on(df, ["seller_id"])


def clean_products(raw: DataFrame) -> DataFrame:
    df = raw.select(
        required(clean_id("product_id"), "tb_products.product_id").alias("product_id"),
        F.coalesce("product_category_name", F.lit(dv.DEFAULT_CATEGORY)).alias("product_category_name"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in schemas.PRODUCT_INT_COLUMNS],
    )
    return distinct_on(df, ["product_id"])


ORDER_TS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def clean_orders(raw: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders of known customers, one per order id.

    The customer filter comes first and the dedup second, as in the source.
    """
    df = raw.select(
        clean_id("order_id").alias("order_id"),
        clean_id("customer_id").alias("customer_id"),
        F.coalesce("order_status", F.lit(dv.DEFAULT_STATUS)).alias("order_status"),
        *ORDER_TS,
    )
    df = present_in(df, customers, ["customer_id"])
    df = df.withColumn("order_id", required(F.col("order_id"), "tb_orders.order_id"))
    return distinct_on(df, ["order_id"])


def snapshot_orders(raw: DataFrame) -> DataFrame:
    """The orders as delivered, with clean ids and typed times, one row per order id: what the snapshot keeps.

    It stands for the raw orders, not for the clean layer: orders of unknown
    customers stay in, and a missing status stays NULL. A report over the
    snapshot alone (delivery times) counts every delivered order; those that
    join it with the fact meet the loaded ones by themselves.
    """
    df = raw.select(
        required(clean_id("order_id"), "orders_snapshot.order_id").alias("order_id"),
        clean_id("customer_id").alias("customer_id"),
        "order_status",
        *ORDER_TS,
    )
    return distinct_on(df, ["order_id"])


ITEM_ORDER = ("product_id", "seller_id", "price", "freight_value", "shipping_limit_date")


def clean_order_items(raw: DataFrame, orders: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items whose order, product and seller exist; one per (order, item no.).

    Products and sellers are looked up first: they decide which of two rows
    of one key is left to choose. The orders depend on the key alone, so the
    dedup goes before them, an aggregate that cuts a key's copies to one row
    in each map task before anything is shuffled by order.
    """
    zero = F.lit(0).cast(schemas.MONEY)
    df = raw.select(
        clean_id("order_id").alias("order_id"),
        "order_item_id",
        clean_id("product_id").alias("product_id"),
        clean_id("seller_id").alias("seller_id"),
        "shipping_limit_date",
        F.coalesce("price", zero).alias("price"),
        F.coalesce("freight_value", zero).alias("freight_value"),
    )
    df = present_in(df, products, ["product_id"])
    df = present_in(df, sellers, ["seller_id"])
    df = present_in(first_by_key(df, ["order_id", "order_item_id"], ITEM_ORDER), orders, ["order_id"])
    return df.withColumn("order_item_id", required(F.col("order_item_id"), "tb_order_items.order_item_id"))
