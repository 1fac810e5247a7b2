import os
import tempfile

import pytest

from starmart import schemas
from starmart.sinks.export import dump_statements, insert_statements, table_profile
from starmart.sources.csv import read_csv, read_sources


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="starmart-csv-")
    p = os.path.join(d, "f.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


SELLERS_HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"


def test_null_versus_empty_and_escapes(spark):
    p = _write(
        SELLERS_HEADER
        + 's-1,,"",SP\n'
        + 's-2,"01234","say ""hi""",RJ\n'
        + 's-3,00001,"two\nlines",MG\n'
    )
    rows = {r.seller_id: r for r in read_csv(spark, p, schemas.RAW_SELLERS).collect()}
    assert rows["s-1"].seller_zip_code_prefix is None
    assert rows["s-1"].seller_city == ""
    assert rows["s-2"].seller_zip_code_prefix == "01234"  # leading zero kept
    assert rows["s-2"].seller_city == 'say "hi"'
    assert rows["s-3"].seller_city == "two\nlines"


def test_short_row_fails(spark):
    p = _write(SELLERS_HEADER + "s-1,1,city\n")
    with pytest.raises(Exception):
        read_csv(spark, p, schemas.RAW_SELLERS).collect()


def test_typed_columns_and_folder_reader(spark):
    d = tempfile.mkdtemp(prefix="starmart-src-")
    files = {
        "olist_orders_dataset.csv": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
        "o-1,c-1,delivered,2017-10-02 10:56:33,,,2017-10-10 21:25:13,\n",
        "olist_order_items_dataset.csv": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o-1,1,p-1,s-1,2017-10-06 11:07:15,29.99,8.725\n",
        "olist_customers_dataset.csv": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
        "c-1,u-1,03149,sao paulo,SP\n",
        "olist_products_dataset.csv": "product_id,product_category_name,product_name_lenght,product_description_lenght,"
        "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm\n"
        "p-1,utilidades,40,268,4,500,19,8,13\n",
        "olist_sellers_dataset.csv": SELLERS_HEADER + "s-1,13023,campinas,SP\n",
    }
    for name, text in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    src = read_sources(spark, d)
    o = src.orders.first()
    assert str(o.order_purchase_timestamp) == "2017-10-02 10:56:33" and o.order_approved_at is None
    i = src.items.first()
    assert str(i.price) == "29.99" and str(i.freight_value) == "8.73"  # half-up to 2 places
    assert src.customers.first().customer_zip_code_prefix == "03149"
    assert src.products.first().product_length_cm == 19


def test_insert_statements_and_profile(spark):
    import datetime as dt
    from decimal import Decimal

    dim = spark.createDataFrame(
        [(1, "c'1", dt.date(2024, 1, 2), None, True)], schemas.DIM_CUSTOMER
    )
    line = insert_statements(dim, "dim_customer").first().statement
    assert line == (
        "INSERT INTO analytics.dim_customer (customer_sk, customer_id, effective_from, effective_to, is_current) "
        "VALUES (1, 'c''1', '2024-01-02', NULL, True);"
    )
    fact = spark.createDataFrame([(1, "o1", 1, 1, 1, 1, Decimal("10.50"), Decimal("0.00"))], schemas.FACT_SALES)
    both = dump_statements({"dim_customer": dim, "fact_sales": fact}, order=["dim_customer", "fact_sales"])
    assert [(r.position, r.table_name) for r in both.orderBy("position").collect()] == [
        (1, "dim_customer"), (2, "fact_sales")
    ]
    assert both.where("position = 2").first().statement.endswith("VALUES (1, 'o1', 1, 1, 1, 1, 10.50, 0.00);")
    prof = {r.tablename: (r.record_count, r.columns_list) for r in table_profile(spark, {"dim_customer": dim}).collect()}
    assert prof["dim_customer"][0] == 1
    assert prof["dim_customer"][1].startswith('["customer_sk","customer_id"')
