"""Fixed values of the data contract.

These literals must equal the source system's for right results; they are
kept together here, as text, in their natural order.
"""

# Defaults written by the cleaning step for missing text.
DEFAULT_ZIP = "00000"
DEFAULT_CITY = "Desconhecido"
DEFAULT_STATE = "XX"
DEFAULT_CATEGORY = "outros"
DEFAULT_STATUS = "indefinido"

# The status that marks a delivered order.
STATUS_DELIVERED = "delivered"

# Label prefixes of the ranked reports.
ITEM_LABEL = "item: "
CLIENT_LABEL = "client: "

# Row labels of the validation reports.
COUNT_LABELS = (
    "1. OLTP: Pedidos (tb_orders)",
    "2. OLTP: Itens de Pedido (tb_order_items)",
    "3. DW: Fato Vendas (fact_sales)",
)
NULL_KEY_LABELS = (
    "Registros com Customer_SK Nulo",
    "Registros com Product_SK Nulo",
    "Registros com Seller_SK Nulo",
    "Registros com Date_SK Nulo",
)
PRICE_SUM_LABELS = (
    "OLTP: Soma Total Preço",
    "DW: Soma Total Preço",
)
