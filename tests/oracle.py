"""DuckDB restatement of every registered query (the correctness oracle).

The test tables are pre-registered as views. The clean layer is generated
from a few lines of rules for each table, the star from that, and the reports
are written from their stated meaning over one table of sale cells, in other
shapes than the Spark plans, so that a mistake in one isn't repeated here.
"""

from __future__ import annotations

_NULL_INTS = ", ".join(
    f"CAST(NULL AS INTEGER) AS {c}"
    for c in ("product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g")
)

RAW_CTES = f"""
raw_orders AS (
  SELECT 'O-' || CAST(o.o_orderkey AS VARCHAR) AS order_id,
         'C-' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
         CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' END AS order_status,
         CAST(o.o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
         CAST(NULL AS TIMESTAMP) AS order_approved_at,
         CAST(NULL AS TIMESTAMP) AS order_delivered_carrier_date,
         CASE WHEN s.last_ship >= o.o_orderdate THEN CAST(s.last_ship AS TIMESTAMP) END AS order_delivered_customer_date,
         CAST(NULL AS TIMESTAMP) AS order_estimated_delivery_date
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) s
    ON s.l_orderkey = o.o_orderkey
),
raw_items AS (
  SELECT 'O-' || CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_linenumber AS INTEGER) AS order_item_id,
         'P-' || CAST(l_partkey AS VARCHAR) AS product_id,
         'S-' || CAST(l_suppkey AS VARCHAR) AS seller_id,
         CAST(l_shipdate AS TIMESTAMP) AS shipping_limit_date,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2)) AS freight_value
  FROM lineitem
),
raw_customers AS (
  SELECT 'C-' || CAST(c.c_custkey AS VARCHAR) AS customer_id,
         'C-' || CAST(c.c_custkey AS VARCHAR) AS customer_unique_id,
         CAST(NULL AS VARCHAR) AS customer_zip_code_prefix,
         n.n_name AS customer_city,
         CAST(NULL AS VARCHAR) AS customer_state
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw_products AS (
  SELECT 'P-' || CAST(p_partkey AS VARCHAR) AS product_id,
         p_type AS product_category_name,
         {_NULL_INTS},
         CAST(p_size AS INTEGER) AS product_length_cm,
         CAST(NULL AS INTEGER) AS product_height_cm,
         CAST(NULL AS INTEGER) AS product_width_cm
  FROM part
),
raw_sellers AS (
  SELECT 'S-' || CAST(s.s_suppkey AS VARCHAR) AS seller_id,
         CAST(NULL AS VARCHAR) AS seller_zip_code_prefix,
         n.n_name AS seller_city,
         CAST(NULL AS VARCHAR) AS seller_state
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
)
"""

_TS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]
_SIZES = [
    "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm",
]
# table: (source, key, columns as (name, rule), parents as (column, table)). A rule is "id",
# None (as it is) or the value in place of NULL, as SQL.
_CLEAN = {
    "tb_customers": ("raw_customers", ["customer_id"], [
        ("customer_id", "id"), ("customer_unique_id", "id"), ("customer_zip_code_prefix", "'00000'"),
        ("customer_city", "'Desconhecido'"), ("customer_state", "'XX'")], []),
    "tb_sellers": ("raw_sellers", ["seller_id"], [
        ("seller_id", "id"), ("seller_zip_code_prefix", "'00000'"), ("seller_city", "'Desconhecido'"),
        ("seller_state", "'XX'")], []),
    "tb_products": ("raw_products", ["product_id"], [
        ("product_id", "id"), ("product_category_name", "'outros'"), *[(c, "0") for c in _SIZES]], []),
    "tb_orders": ("raw_orders", ["order_id"], [
        ("order_id", "id"), ("customer_id", "id"), ("order_status", "'indefinido'"), *[(c, None) for c in _TS]],
        [("customer_id", "tb_customers")]),
    "tb_order_items": ("raw_items", ["order_id", "order_item_id"], [
        ("order_id", "id"), ("order_item_id", None), ("product_id", "id"), ("seller_id", "id"),
        ("price", "0.00"), ("freight_value", "0.00"), ("shipping_limit_date", None)],
        [("order_id", "tb_orders"), ("product_id", "tb_products"), ("seller_id", "tb_sellers")]),
}


def _cleaned(table: str, p: str) -> str:
    """The clean table of batch ``p``: rules applied, orphans out, the least row of each key."""
    source, key, columns, parents = _CLEAN[table]

    def value(name: str, rule: str | None) -> str:
        if rule == "id":
            return f"array_to_string(string_split({name}, '-'), '') AS {name}"
        return f"ifnull({name}, {rule}) AS {name}" if rule else name

    names = [c for c, _ in columns]
    kept = " AND ".join(f"{c} IN (SELECT {c} FROM {p}{t})" for c, t in parents) or "TRUE"
    order = ", ".join(f"{c} NULLS FIRST" for c in names if c not in key)
    return f"""{p}{table} AS (
  SELECT * FROM (SELECT {", ".join(value(*c) for c in columns)} FROM {p}{source})
  WHERE {kept}
  QUALIFY count(*) OVER (PARTITION BY {", ".join(key)} ORDER BY {order} ROWS UNBOUNDED PRECEDING) = 1
)"""


def _numbered(p: str, old: str | None, dim: str, sk: str, columns: str, source: str, key: str) -> str:
    """A dimension after batch ``p``: what ``old`` held, then new members numbered on in key order."""
    first = f"(SELECT max({sk}) FROM {old}{dim})" if old else "0"
    fresh = f"WHERE {key} NOT IN (SELECT {key} FROM {old}{dim})" if old else ""
    had = f"SELECT * FROM {old}{dim} UNION ALL BY NAME " if old else ""
    return f"""{p}{dim} AS (
  {had}SELECT {first} + rank() OVER (ORDER BY {key}) AS {sk}, {columns} FROM {source} {fresh}
)"""


def _star(p: str = "", old: str | None = None) -> str:
    """CTEs of the clean layer and the star after loading batch ``p`` onto the star of ``old``."""
    days = f"""(
    SELECT lo + CAST(i AS INTEGER) AS full_date
    FROM (SELECT CAST(min(order_purchase_timestamp) AS DATE) AS lo, CAST(max(order_purchase_timestamp) AS DATE) AS hi
          FROM {p}tb_orders), LATERAL (SELECT unnest(range(0, CAST(hi - lo AS BIGINT) + 1)) AS i))"""
    parts = """full_date, CAST(date_part('year', full_date) AS INTEGER) AS year,
    CAST(date_part('month', full_date) AS INTEGER) AS month, CAST(date_part('day', full_date) AS INTEGER) AS day,
    CAST(date_part('quarter', full_date) AS INTEGER) AS quarter, CAST(date_part('isodow', full_date) AS INTEGER) AS day_of_week,
    CAST(date_part('week', full_date) AS INTEGER) AS week_of_year"""
    customer = "customer_id, current_date AS effective_from, CAST(NULL AS DATE) AS effective_to, TRUE AS is_current"
    lookups = f"""
    SELECT order_id, order_item_id, price, freight_value, customer_sk, product_sk, seller_sk, date_sk
    FROM {p}tb_order_items
    JOIN (SELECT order_id, customer_sk, date_sk FROM {p}tb_orders
          JOIN (SELECT customer_id, customer_sk FROM {p}dim_customer WHERE is_current) USING (customer_id)
          JOIN {p}dim_date ON full_date = CAST(order_purchase_timestamp AS DATE)) USING (order_id)
    JOIN {p}dim_product USING (product_id) JOIN {p}dim_seller USING (seller_id)"""
    known = f"WHERE (order_id, product_sk, seller_sk) NOT IN (SELECT (order_id, product_sk, seller_sk) FROM {old}fact_sales)" if old else ""
    first = f"(SELECT max(sale_sk) FROM {old}fact_sales)" if old else "0"
    had = f"SELECT * FROM {old}fact_sales UNION ALL BY NAME " if old else ""
    return ",\n".join(
        [
            *[_cleaned(t, p) for t in _CLEAN],
            _numbered(p, old, "dim_date", "date_sk", parts, days, "full_date"),
            _numbered(p, old, "dim_customer", "customer_sk", customer, f"{p}tb_customers", "customer_id"),
            _numbered(p, old, "dim_product", "product_sk", "product_id", f"{p}tb_products", "product_id"),
            _numbered(p, old, "dim_seller", "seller_sk", "seller_id", f"{p}tb_sellers", "seller_id"),
            f"""{p}fact_sales AS (
  {had}SELECT {first} + rank() OVER (ORDER BY order_id, order_item_id) AS sale_sk, order_id, customer_sk, product_sk,
    seller_sk, date_sk, price, freight_value
  FROM ({lookups}) {known}
)""",
            # The snapshot after the load: the delivery's raw orders under clean ids; earlier orders stay.
            f"""{p}df_orders AS (
  SELECT DISTINCT ON (order_id) * FROM (SELECT * REPLACE (array_to_string(string_split(order_id, '-'), '') AS order_id,
    array_to_string(string_split(customer_id, '-'), '') AS customer_id) FROM {p}raw_orders)"""
            + (f" UNION ALL BY NAME SELECT * FROM {old}df_orders WHERE order_id NOT IN (SELECT replace(order_id, '-', '') FROM {p}raw_orders)" if old else "")
            + ")",
        ]
    )


_CELLS = """,
sale AS (
  SELECT sale_sk, order_id, customer_sk, product_sk, seller_sk, year, month, price + freight_value AS revenue,
         format('{:04d}-{:02d}', year, month) AS ym
  FROM fact_sales NATURAL JOIN dim_date
)"""
STAR_CTES = RAW_CTES.strip() + ",\n" + _star() + _CELLS


def _q(body: str) -> str:
    return "WITH " + STAR_CTES.strip() + ",\nq AS (\n" + body.strip() + "\n)\nSELECT * FROM q"


def _dup(table: str, keys: list[str], rule: str = "primary key") -> str:
    cols = ", ".join(keys)
    where = f"WHERE {' AND '.join(k + ' IS NOT NULL' for k in keys)}" if rule == "unique" else ""
    return (
        f"SELECT '{table}' AS table_name, '{rule} ({cols})' AS rule, "
        f"CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS violations "
        f"FROM (SELECT {cols}, COUNT(*) AS n FROM {table} {where} GROUP BY {cols} HAVING COUNT(*) > 1) d"
    )


def _nn(table: str, col: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, 'not null ({col})' AS rule, "
        f"CAST(COUNT(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS violations FROM {table}"
    )


def _wide(table: str, col: str, n: int) -> str:
    return (
        f"SELECT '{table}' AS table_name, 'width ({col} <= {n})' AS rule, "
        f"CAST(COUNT(*) FILTER (WHERE length({col}) > {n}) AS BIGINT) AS violations FROM {table}"
    )


def _fk(table: str, col: str, parent: str, pk: str | None = None) -> str:
    pk = pk or col
    return (
        f"SELECT '{table}' AS table_name, 'foreign key ({col}) -> {parent}' AS rule, "
        f"CAST(COUNT(*) AS BIGINT) AS violations FROM {table} c "
        f"WHERE c.{col} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{col})"
    )


_AUDIT_PARTS = [
    _dup("tb_customers", ["customer_id"]),
    _nn("tb_customers", "customer_id"),
    _nn("tb_customers", "customer_unique_id"),
    _wide("tb_customers", "customer_zip_code_prefix", 10),
    _wide("tb_customers", "customer_city", 100),
    _wide("tb_customers", "customer_state", 2),
    _dup("tb_sellers", ["seller_id"]),
    _nn("tb_sellers", "seller_id"),
    _wide("tb_sellers", "seller_zip_code_prefix", 10),
    _wide("tb_sellers", "seller_city", 100),
    _wide("tb_sellers", "seller_state", 2),
    _dup("tb_products", ["product_id"]),
    _nn("tb_products", "product_id"),
    _wide("tb_products", "product_category_name", 100),
    _dup("tb_orders", ["order_id"]),
    _nn("tb_orders", "order_id"),
    _wide("tb_orders", "order_status", 50),
    _fk("tb_orders", "customer_id", "tb_customers"),
    _dup("tb_order_items", ["order_id", "order_item_id"]),
    _nn("tb_order_items", "order_id"),
    _nn("tb_order_items", "order_item_id"),
    _fk("tb_order_items", "order_id", "tb_orders"),
    _fk("tb_order_items", "product_id", "tb_products"),
    _fk("tb_order_items", "seller_id", "tb_sellers"),
    _dup("dim_customer", ["customer_sk"]),
    _nn("dim_customer", "customer_sk"),
    _dup("dim_customer", ["customer_id", "effective_from"], "unique"),
    _dup("dim_product", ["product_sk"]),
    _nn("dim_product", "product_sk"),
    _dup("dim_product", ["product_id"], "unique"),
    _dup("dim_seller", ["seller_sk"]),
    _nn("dim_seller", "seller_sk"),
    _dup("dim_seller", ["seller_id"], "unique"),
    _dup("dim_date", ["date_sk"]),
    _nn("dim_date", "date_sk"),
    _dup("dim_date", ["full_date"], "unique"),
    _dup("fact_sales", ["sale_sk"]),
    *[_nn("fact_sales", c) for c in ("sale_sk", "customer_sk", "product_sk", "seller_sk", "date_sk")],
    _fk("fact_sales", "customer_sk", "dim_customer"),
    _fk("fact_sales", "product_sk", "dim_product"),
    _fk("fact_sales", "seller_sk", "dim_seller"),
    _fk("fact_sales", "date_sk", "dim_date"),
]

_CUBE = [("seller_sk", "BIGINT"), ("product_sk", "BIGINT"), ("year", "INTEGER"), ("month", "INTEGER")]
# Months are counted through; a customer's row number among the months is 1 in the cohort's own.
_COHORT = """
SELECT format('{:04d}-{:02d}', cohort // 12, cohort % 12 + 1) AS cohort_month, CAST(m - cohort AS INTEGER) AS month_number,
       count(*) AS retained_customers, max(size) AS cohort_size, count(*)::DOUBLE * 100 / max(size) AS retention_rate
FROM (SELECT *, count(*) FILTER (WHERE m = cohort) OVER (PARTITION BY cohort) AS size
      FROM (SELECT DISTINCT customer_sk, m, min(m) OVER (PARTITION BY customer_sk) AS cohort
            FROM (SELECT customer_sk, year(order_purchase_timestamp) * 12 + month(order_purchase_timestamp) - 1 AS m
                  FROM fact_sales NATURAL JOIN df_orders)))
GROUP BY cohort, m
"""
_BODIES = {
    "monthly_revenue": """
SELECT DISTINCT year, month, CAST(sum(revenue) OVER (PARTITION BY year, month) AS DECIMAL(38,2)) AS total_vendas FROM sale
""",
    "top_products": """
SELECT product_sk, n AS quantidade_vendida
FROM (SELECT product_sk, count(*) AS n FROM sale GROUP BY ALL)
QUALIFY row_number() OVER (ORDER BY n DESC, product_sk) <= 10
""",
    "sales_cube": "\nUNION ALL\n".join(
        "SELECT "
        + ", ".join(c if bits >> i & 1 else f"CAST(NULL AS {t}) AS {c}" for i, (c, t) in enumerate(_CUBE))
        + ", CAST(sum(revenue) AS DECIMAL(38,2)) AS total_vendas FROM sale GROUP BY ALL"
        for bits in range(16)
    ),
    "cohort_retention": _COHORT,
    "monthly_average_ticket": """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_month, count(*) AS total_orders,
       CAST(sum(spent) AS DECIMAL(38,2)) AS total_revenue,
       CAST(round(round(CAST(sum(spent) AS DOUBLE) * 100) / count(*)) / 100 AS DECIMAL(38,2)) AS average_ticket
FROM (SELECT order_id, sum(revenue) AS spent FROM sale GROUP BY ALL) NATURAL JOIN df_orders
GROUP BY 1
""",
    "top_items_labelled": """
SELECT concat('item: ', product_sk) AS produto, n AS total_unidades_vendidas
FROM (SELECT product_sk, count(*) AS n FROM sale GROUP BY ALL)
QUALIFY row_number() OVER (ORDER BY n DESC, product_sk) <= 10
""",
    "monthly_revenue_label": """
SELECT ym AS ano_mes, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_vendas FROM sale GROUP BY ALL
""",
    "top_customers": """
SELECT concat('client: ', customer_sk) AS cliente, CAST(spent AS DECIMAL(38,2)) AS valor_total_compras
FROM (SELECT customer_sk, sum(revenue) AS spent FROM sale GROUP BY ALL)
QUALIFY row_number() OVER (ORDER BY spent DESC, customer_sk) <= 10
""",
    "monthly_delivery_days": """
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS ano_mes, count(*) AS total_compras,
       avg((epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400000000.0::DOUBLE)
         AS dias_medios_atendimento
FROM df_orders
WHERE ifnull(order_status, '') = 'delivered' AND order_delivered_customer_date = order_delivered_customer_date
GROUP BY ALL
""",
    "best_worst_month": """
SELECT concat('item: ', product_sk) AS produto,
       list_sort(list((-n, ym)))[1][2] AS melhor_mes, max(n) AS qtd_vendas_max,
       list_sort(list((n, ym)))[1][2] AS pior_mes, min(n) AS qtd_vendas_min
FROM (SELECT product_sk, ym, count(*) AS n FROM sale GROUP BY ALL)
NATURAL JOIN (SELECT product_sk, product_id FROM dim_product)
GROUP BY product_sk, product_id
QUALIFY row_number() OVER (ORDER BY sum(n) DESC, product_id) <= 10
""",
    "validate_counts": """
SELECT unnest(['1. OLTP: Pedidos (tb_orders)', '2. OLTP: Itens de Pedido (tb_order_items)', '3. DW: Fato Vendas (fact_sales)'])
         AS tabela_origem,
       unnest([(SELECT count(*) FROM tb_orders), (SELECT count(*) FROM tb_order_items), (SELECT count(*) FROM fact_sales)])
         AS total_registros
""",
    "validate_null_keys": """
SELECT unnest([format('Registros com {} Nulo', k) FOR k IN ['Customer_SK', 'Product_SK', 'Seller_SK', 'Date_SK']]) AS validacao,
       unnest([count(*) - count(customer_sk), count(*) - count(product_sk), count(*) - count(seller_sk),
               count(*) - count(date_sk)]) AS qtd_erros
FROM fact_sales
""",
    "validate_price_sum": """
SELECT unnest(['OLTP: Soma Total Preço', 'DW: Soma Total Preço']) AS metrica,
       unnest([CAST((SELECT sum(price) FROM tb_order_items) AS DECIMAL(38,2)),
               CAST((SELECT sum(price) FROM fact_sales) AS DECIMAL(38,2))]) AS valor_total
""",
    "audit_constraints": "\nUNION ALL\n".join(_AUDIT_PARTS),
    "staging_orders": "SELECT * FROM raw_orders",
    "staging_items": "SELECT * FROM raw_items",
    "staging_customers": "SELECT * FROM raw_customers",
    "staging_products": "SELECT * FROM raw_products",
    "staging_sellers": "SELECT * FROM raw_sellers",
    "clean_customers": "SELECT * FROM tb_customers",
    "clean_sellers": "SELECT * FROM tb_sellers",
    "clean_products": "SELECT * FROM tb_products",
    "clean_orders": "SELECT * FROM tb_orders",
    "clean_order_items": "SELECT * FROM tb_order_items",
    "load_dim_date": "SELECT * FROM dim_date",
    "load_dim_customer": "SELECT * FROM dim_customer",
    "load_dim_product": "SELECT * FROM dim_product",
    "load_dim_seller": "SELECT * FROM dim_seller",
    "load_fact_sales": "SELECT * FROM fact_sales",
}

def _lit(col: str, kind: str) -> str:
    """DuckDB rendering of a value as a SQL literal (NULL, quoted text, True)."""
    if kind == "text":
        body = "'''' || replace(CAST(" + col + " AS VARCHAR), '''', '''''') || ''''"
    elif kind == "bool":
        body = f"CASE WHEN {col} THEN 'True' ELSE 'False' END"
    else:
        body = f"CAST({col} AS VARCHAR)"
    return f"CASE WHEN {col} IS NULL THEN 'NULL' ELSE {body} END"


_DUMP_TABLES = [
    ("dim_customer", [("customer_sk", "num"), ("customer_id", "text"), ("effective_from", "text"),
                      ("effective_to", "text"), ("is_current", "bool")]),
    ("dim_product", [("product_sk", "num"), ("product_id", "text")]),
    ("dim_seller", [("seller_sk", "num"), ("seller_id", "text")]),
    ("dim_date", [("date_sk", "num"), ("full_date", "text"), ("year", "num"), ("month", "num"), ("day", "num"),
                  ("quarter", "num"), ("day_of_week", "num"), ("week_of_year", "num")]),
    ("fact_sales", [("sale_sk", "num"), ("order_id", "text"), ("customer_sk", "num"), ("product_sk", "num"),
                    ("seller_sk", "num"), ("date_sk", "num"), ("price", "num"), ("freight_value", "num")]),
]


def _dump_part(pos: int, table: str, cols: list[tuple[str, str]]) -> str:
    names = ", ".join(c for c, _ in cols)
    values = " || ', ' || ".join(_lit(c, k) for c, k in cols)
    return (
        f"SELECT {pos} AS position, '{table}' AS table_name, "
        f"'INSERT INTO analytics.{table} ({names}) VALUES (' || {values} || ');' AS statement FROM {table}"
    )


_BODIES["warehouse_dump"] = "\nUNION ALL\n".join(
    _dump_part(pos, t, cols) for pos, (t, cols) in enumerate(_DUMP_TABLES, start=1)
)

_SNAPSHOT_COLUMNS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
]


def _profile_part(table: str, source: str, cols: list[str]) -> str:
    listing = ",".join(f'"{c}"' for c in cols)
    return (
        f"SELECT '{table}' AS tablename, CAST(COUNT(*) AS BIGINT) AS record_count, "
        f"'[{listing}]' AS columns_list FROM {source}"
    )


_BODIES["table_profile"] = "\nUNION ALL\n".join(
    [_profile_part(t, t, [c for c, _ in cols]) for t, cols in _DUMP_TABLES]
    + [_profile_part("orders_snapshot", "df_orders", _SNAPSHOT_COLUMNS)]
)

for _name in ("orders", "items", "customers", "products", "sellers"):
    _BODIES[f"csv_{_name}"] = _BODIES[f"staging_{_name}"]  # written as CSV and read back, they are what they were
_BODIES["text_delivery_days"] = _BODIES["monthly_delivery_days"]
_BODIES["catalog_monthly_revenue"] = "SELECT year, month, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_vendas FROM sale GROUP BY ALL"
_BODIES["monthly_revenue_period"] = (
    "SELECT year, month, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_vendas, make_date(year, month, 1) AS periodo FROM sale GROUP BY ALL"
)
_BODIES["monthly_revenue_preview"] = f"SELECT * FROM ({_BODIES['catalog_monthly_revenue']}) QUALIFY row_number() OVER (ORDER BY year, month) <= 5"
_BODIES["table_profile_report"] = (
    "SELECT tablename, CAST(record_count AS VARCHAR) AS record_count, columns_list FROM (" + _BODIES["table_profile"] + ")"
)

# Two loads: an early, partial delivery, then everything (registry._batches).
_DAY = "TIMESTAMP '1995-06-01'"
_FIRST_BATCH = f"""one_raw_customers AS (SELECT * FROM raw_customers WHERE right(customer_id, 1) <> '7'),
one_raw_sellers AS (SELECT * FROM raw_sellers WHERE right(seller_id, 1) <> '3'),
one_raw_products AS (SELECT * FROM raw_products WHERE right(product_id, 1) <> '5'),
one_raw_orders AS (SELECT * FROM raw_orders WHERE order_purchase_timestamp < {_DAY}),
one_raw_items AS (SELECT * FROM raw_items WHERE order_item_id <= 3)"""
_SECOND_BATCH = ",\n".join(f"two_{t} AS (SELECT * FROM {t})" for t in
                           ("raw_customers", "raw_sellers", "raw_products", "raw_orders", "raw_items"))
_TWO_LOADS = "WITH " + ",\n".join(
    [RAW_CTES.strip(), _FIRST_BATCH, _star("one_"), _SECOND_BATCH, _star("two_", "one_")]
)

ORACLE_SQL: dict[str, str] = {name: _q(body) for name, body in _BODIES.items()}
ORACLE_SQL |= {
    f"increment_{t}": f"{_TWO_LOADS}\nSELECT * FROM two_{t}"
    for t in ("dim_date", "dim_customer", "dim_product", "dim_seller", "fact_sales")
}
ORACLE_SQL["increment_cohort"] = (
    _TWO_LOADS + _COHORT.replace("fact_sales", "two_fact_sales").replace("df_orders", "two_df_orders")
)
