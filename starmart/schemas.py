"""Declared schemas: the five raw inputs, the clean layer, the star schema.

Nothing is inferred. The source spelling ``*_lenght`` is part of the input
contract and kept as is. Timestamps carry no zone (``TimestampNTZType``).
Surrogate keys are 64-bit.
"""

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()
TS, D, B = T.TimestampNTZType(), T.DateType(), T.BooleanType()
MONEY = T.DecimalType(10, 2)


def _struct(*fields, nullable=True):
    return T.StructType([T.StructField(n, t, nullable) for n, t in fields])


# ---- raw inputs (one CSV each) --------------------------------------------
RAW_ORDERS = _struct(
    ("order_id", S), ("customer_id", S), ("order_status", S),
    ("order_purchase_timestamp", TS), ("order_approved_at", TS),
    ("order_delivered_carrier_date", TS), ("order_delivered_customer_date", TS),
    ("order_estimated_delivery_date", TS),
)
RAW_ITEMS = _struct(
    ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
    ("shipping_limit_date", TS), ("price", MONEY), ("freight_value", MONEY),
)
RAW_CUSTOMERS = _struct(
    ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
    ("customer_city", S), ("customer_state", S),
)
PRODUCT_INT_COLUMNS = (
    "product_name_lenght", "product_description_lenght", "product_photos_qty",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
)
RAW_PRODUCTS = _struct(
    ("product_id", S), ("product_category_name", S), *[(c, I) for c in PRODUCT_INT_COLUMNS]
)
RAW_SELLERS = _struct(
    ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S),
)

RAW_SCHEMAS = {
    "orders": RAW_ORDERS,
    "items": RAW_ITEMS,
    "customers": RAW_CUSTOMERS,
    "products": RAW_PRODUCTS,
    "sellers": RAW_SELLERS,
}

# Declared text widths of the source DDL; checked by the constraint audit.
VARCHAR_LIMITS = {
    "customers": {"customer_zip_code_prefix": 10, "customer_city": 100, "customer_state": 2},
    "sellers": {"seller_zip_code_prefix": 10, "seller_city": 100, "seller_state": 2},
    "products": {"product_category_name": 100},
    "orders": {"order_status": 50},
}

# ---- star schema ------------------------------------------------------------
DIM_CUSTOMER = _struct(
    ("customer_sk", L), ("customer_id", S), ("effective_from", D),
    ("effective_to", D), ("is_current", B),
)
DIM_PRODUCT = _struct(("product_sk", L), ("product_id", S))
DIM_SELLER = _struct(("seller_sk", L), ("seller_id", S))
DIM_DATE = _struct(
    ("date_sk", L), ("full_date", D), ("year", I), ("month", I), ("day", I),
    ("quarter", I), ("day_of_week", I), ("week_of_year", I),
)
FACT_SALES = _struct(
    ("sale_sk", L), ("order_id", S), ("customer_sk", L), ("product_sk", L),
    ("seller_sk", L), ("date_sk", L), ("price", MONEY), ("freight_value", MONEY),
)

STAR_SCHEMAS = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_seller": DIM_SELLER,
    "dim_date": DIM_DATE,
    "fact_sales": FACT_SALES,
}
# Dimensions first: the fact refers to them.
STAR_ORDER = ("dim_customer", "dim_product", "dim_seller", "dim_date", "fact_sales")
SURROGATE_KEYS = {name: schema.fieldNames()[0] for name, schema in STAR_SCHEMAS.items()}
