"""Stand-in inputs derived from the TPC-H-like test tables.

The warehouse expects five e-commerce inputs (orders, order items,
customers, products, sellers). The test tables are mapped onto them:

* order / customer / product / seller ids get a hyphenated prefix
  (``O-``, ``C-``, ``P-``, ``S-``), which exercises id cleaning;
* order status F → delivered, O → shipped, anything else → NULL;
* purchase time = order date; delivery time = the order's last ship date
  when not earlier than the order date, else NULL;
* item price = extended price as money; freight = price × tax as money;
* city = nation name; category = part type; length = part size.

Everything is a lazy projection/join of the test tables, so the work grows
with them. The only aggregate (last ship date per order) is partial-
aggregated before its shuffle and joined on the same key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.sources.raw import RawSources


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _prefixed(prefix: str, c: str):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    last_ship = (
        _table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("last_ship"))
        .withColumnRenamed("l_orderkey", "o_orderkey")
    )
    status = F.when(F.col("o_orderstatus") == "F", F.lit("delivered")).when(
        F.col("o_orderstatus") == "O", F.lit("shipped")
    )
    no_ts = F.lit(None).cast("timestamp_ntz")
    df = orders.join(last_ship, "o_orderkey", "left").select(
        _prefixed("O-", "o_orderkey").alias("order_id"),
        _prefixed("C-", "o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        no_ts.alias("order_approved_at"),
        no_ts.alias("order_delivered_carrier_date"),
        F.when(F.col("last_ship") >= F.col("o_orderdate"), F.col("last_ship")).alias(
            "order_delivered_customer_date"
        ),
        no_ts.alias("order_estimated_delivery_date"),
    )
    return _conform(df, schemas.RAW_ORDERS)


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    df = li.select(
        _prefixed("O-", "l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _prefixed("P-", "l_partkey").alias("product_id"),
        _prefixed("S-", "l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(10,2)").alias("freight_value"),
    )
    return _conform(df, schemas.RAW_ITEMS)


def _nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "nation").select(F.col("n_nationkey"), F.col("n_name"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation has 25 rows: a fixed-size side, broadcast by the planner.
    df = c.join(_nation_names(spark, sf_dir), c.c_nationkey == F.col("n_nationkey"), "left").select(
        _prefixed("C-", "c_custkey").alias("customer_id"),
        _prefixed("C-", "c_custkey").alias("customer_unique_id"),
        F.lit(None).cast("string").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.lit(None).cast("string").alias("customer_state"),
    )
    return _conform(df, schemas.RAW_CUSTOMERS)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    ints = {c: F.lit(None).cast("int") for c in schemas.PRODUCT_INT_COLUMNS}
    ints["product_length_cm"] = F.col("p_size").cast("int")
    df = p.select(
        _prefixed("P-", "p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        *[v.alias(k) for k, v in ints.items()],
    )
    return _conform(df, schemas.RAW_PRODUCTS)


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    df = s.join(_nation_names(spark, sf_dir), s.s_nationkey == F.col("n_nationkey"), "left").select(
        _prefixed("S-", "s_suppkey").alias("seller_id"),
        F.lit(None).cast("string").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.lit(None).cast("string").alias("seller_state"),
    )
    return _conform(df, schemas.RAW_SELLERS)


def load_testdata(spark: SparkSession, sf_dir: str) -> RawSources:
    return RawSources(
        orders=raw_orders(spark, sf_dir),
        items=raw_items(spark, sf_dir),
        customers=raw_customers(spark, sf_dir),
        products=raw_products(spark, sf_dir),
        sellers=raw_sellers(spark, sf_dir),
    )
