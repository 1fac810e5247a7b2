"""Business queries over the star schema.

Each function takes a :class:`~starmart.plans.star.Star` (lazy frames) and
returns a lazy DataFrame. Shape choices for scale:

* Aggregate the fact before joining it to a dimension whenever the join key
  is the grouping key (or determines it): the fact is reduced map-side to
  one row per key before anything is joined or shuffled twice.
* Top-k is ``orderBy(...).limit(k)``: planned as TakeOrderedAndProject, a
  per-task top-k merged on the driver (k rows per task), never a full sort.
* Ties under a limit or a row_number are broken by the key (ascending), and
  month ties by the earliest month, so results are repeatable.
* Money sums are returned as DECIMAL(38,2); counts as BIGINT.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions import (
    elapsed_days,
    label,
    make_period,
    month_index,
    year_month,
)
from starmart.functions import defaults as dv
from starmart.plans.star import Star
from starmart.session import stage_bucketed, stage_rows

SUM_TYPE = "decimal(38,2)"


def _revenue() -> Column:
    return F.col("price") + F.col("freight_value")


def _daily_revenue(star: Star) -> DataFrame:
    """Revenue per date key: the fact reduced to one row per day."""
    return star.fact_sales.groupBy("date_sk").agg(F.sum(_revenue()).alias("revenue"))


# --- A-1 -------------------------------------------------------------------
def monthly_revenue(star: Star) -> DataFrame:
    """Revenue (price + freight) per calendar year and month, in order."""
    return (
        _daily_revenue(star)
        .join(star.dim_date.select("date_sk", "year", "month"), "date_sk")
        .groupBy("year", "month")
        .agg(F.sum("revenue").cast(SUM_TYPE).alias("total_vendas"))
        .orderBy("year", "month")
    )


# --- A-2 -------------------------------------------------------------------
def top_products(star: Star, k: int = 10) -> DataFrame:
    """The k product keys with the most sale rows."""
    return (
        star.fact_sales.groupBy("product_sk")
        .agg(F.count("product_sk").alias("quantidade_vendida"))
        .orderBy(F.desc("quantidade_vendida"), F.asc("product_sk"))
        .limit(k)
    )


# --- A-3 -------------------------------------------------------------------
def cube_cells(star: Star) -> DataFrame:
    """Revenue by seller, product, year and month, written once, bucketed by product.

    The calendar, a row a day, goes to the sales: these are summed by month
    where they are read, so what a hot pair of seller and product moves is its
    months.
    """
    spark = star.fact_sales.sparkSession
    s, p = "seller_sk", "product_sk"
    dates = F.broadcast(star.dim_date.select("date_sk", "year", "month"))
    sales = star.fact_sales.select(s, p, "date_sk", _revenue().alias("revenue")).join(dates, "date_sk")
    cells = sales.groupBy(s, p, "year", "month").agg(F.sum("revenue").cast("decimal(31,2)").alias("revenue"))
    return stage_bucketed(cells, p, int(spark.conf.get("spark.sql.shuffle.partitions")))


def sales_cube(star: Star, sort: bool = True) -> DataFrame:
    """Revenue over every combination of seller, product, year and month.

    16 grouping sets; a NULL key means "all" (the keys are never NULL
    themselves). Nearly every sale is a cell of its own at the finest grain, so
    expanding cells 16 times would shuffle 16 fact tables. Instead the finest
    cells are written once, bucketed by product: the eight sets that hold the
    product are sums within a bucket and move nothing. The other eight come
    from the sellers' monthly cells, summed before they are moved.
    """
    s, p, y, m = "seller_sk", "product_sk", "year", "month"

    def total(df: DataFrame, *keys: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum("revenue").alias("revenue"))

    cells = cube_cells(star)
    products, sellers = total(cells, p, y, m), stage_rows(total(cells, s, y, m))
    months = total(sellers, y, m)
    sets = [cells, total(cells, s, p, y), total(cells, s, p, m), total(cells, s, p)]
    for few, key in ((products, [p]), (sellers, [s]), (months, [])):
        sets += [few, total(few, *key, y), total(few, *key, m), total(few, *key)]
    keys = [
        [F.col(c) if c in part.columns else F.lit(None).cast(cells.schema[c].dataType).alias(c) for c in (s, p, y, m)]
        for part in sets
    ]
    parts = [part.select(*k, F.col("revenue").cast(SUM_TYPE).alias("total_vendas")) for part, k in zip(sets, keys)]
    # An empty fact has no cells; the grand total of nothing is no row either.
    cube = reduce(DataFrame.unionAll, parts[:-1]).unionAll(parts[-1].where("total_vendas is not null"))
    if sort:
        cube = stage_rows(cube).orderBy(
            F.asc_nulls_last("seller_sk"),
            F.asc_nulls_last("product_sk"),
            F.asc_nulls_last("year"),
            F.asc_nulls_last("month"),
        )
    return cube


# --- A-4 -------------------------------------------------------------------
MONTHS_A_WORD = 60


def customer_months(star: Star) -> tuple[DataFrame, int, int]:
    """``customer_sk, words``: the months in which a customer bought, as bits from a base month; the base and the span.

    A word holds 60 months; a customer's are or-ed together where they are
    read, so a customer with any number of sales sends a row from each task.
    Orders without a purchase time have no month.
    """
    at = month_index("order_purchase_timestamp")
    orders = star.orders_snapshot.select("order_id", at.alias("at"))
    base, top = orders.agg(F.min("at"), F.max("at")).first()
    base, span = (base, top - base + 1) if base is not None else (0, 0)
    month = F.col("at") - F.lit(base)
    words = []
    for word in range(-(-span // MONTHS_A_WORD)):
        bit = F.expr(f"shiftleft(1L, cast(pmod(at - {base}, {MONTHS_A_WORD}) as int))")
        here = F.floor(month / MONTHS_A_WORD) == word
        words.append(F.coalesce(F.bit_or(F.when(here, bit)), F.lit(0).cast("long")))
    sales = star.fact_sales.select("order_id", "customer_sk").join(orders.where("at is not null"), "order_id")
    found = F.array(*words) if words else F.array().cast("array<bigint>")
    return sales.groupBy("customer_sk").agg(found.alias("words")), base, span


def cohort_retention(star: Star) -> DataFrame:
    """Monthly cohorts by first purchase month and their retention.

    Fact and snapshot are bucketed by order and meet in place; the one shuffle
    of their rows is by customer, of one set of month bits each. The cohort is
    the lowest bit; every bit is one (cohort, month offset) and is counted where
    it stands. The cohort's size is its month 0, found by a window over those
    few cells.
    """
    customers, base, span = customer_months(star)
    numbers = F.sequence(F.lit(0), F.lit(max(span - 1, 0)))
    word = lambda i: F.get("words", F.floor(i / MONTHS_A_WORD).cast("int"))
    bought = F.filter(numbers, lambda i: F.getbit(word(i), (i % MONTHS_A_WORD).cast("int")) == 1)
    months = customers.select(bought.alias("months")).select(F.element_at("months", 1).alias("first"), "months")
    active = months.select("first", F.explode("months").alias("at"))
    cells = active.groupBy("first", (F.col("at") - F.col("first")).alias("month_number")).agg(
        F.count(F.lit(1)).alias("retained_customers")
    )
    zero = F.when(F.col("month_number") == 0, F.col("retained_customers"))
    cells = cells.withColumn("cohort_size", F.max(zero).over(Window.partitionBy("first")))
    index = F.col("first") + F.lit(base) - 1  # year * 12 + month, with January as 1
    month = F.format_string("%04d-%02d", F.floor(index / 12).cast("int"), (index % 12 + 1).cast("int"))
    return cells.select(
        month.alias("cohort_month"),
        F.col("month_number").cast("int").alias("month_number"),
        "retained_customers",
        "cohort_size",
        (F.col("retained_customers").cast("double") * 100 / F.col("cohort_size")).alias("retention_rate"),
    ).orderBy("cohort_month", "month_number")


def _round_half_up_ratio(cents: str, n: str) -> Column:
    """round(cents / n / 100, 2) exactly, half away from zero (n > 0).

    Integer arithmetic only: a decimal quotient would first be rounded to a
    fixed number of digits, and rounding twice can be off by a cent. ``div``
    cuts towards zero, so half a step is added away from it.
    """
    q = F.expr(f"(2 * {cents} + if({cents} < 0, -{n}, {n})) div (2 * {n})")
    return (q.cast("decimal(38,0)") * F.lit(0.01).cast("decimal(3,2)")).cast(SUM_TYPE)


# --- A-5 -------------------------------------------------------------------
def monthly_average_ticket(star: Star) -> DataFrame:
    """Per purchase month: orders, revenue, and revenue per order (2 places).

    The fact is first reduced to one row per order (its revenue), then the
    order's purchase time is attached by a join on the same key (no second
    shuffle of the aggregated side).
    """
    per_order = star.fact_sales.groupBy("order_id").agg(F.sum(_revenue()).alias("order_revenue"))
    monthly = (
        per_order.join(star.orders_snapshot.select("order_id", "order_purchase_timestamp"), "order_id")
        .groupBy(year_month("order_purchase_timestamp").alias("order_month"))
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("order_revenue").alias("revenue"),
        )
    )
    return (
        monthly.withColumn("cents", (F.col("revenue") * 100).cast("bigint"))
        .select(
            "order_month",
            "total_orders",
            F.col("revenue").cast(SUM_TYPE).alias("total_revenue"),
            _round_half_up_ratio("cents", "total_orders").alias("average_ticket"),
        )
        .orderBy("order_month")
    )


# --- G-1 -------------------------------------------------------------------
def top_items_labelled(star: Star, k: int = 10) -> DataFrame:
    """Top-k products by sale rows, labelled ``item: <product_sk>``.

    Counted per product key first; the join to the product dimension only
    keeps keys that exist there (it runs on one row per product, not per
    sale).
    """
    counts = star.fact_sales.groupBy("product_sk").agg(F.count("sale_sk").alias("total_unidades_vendidas"))
    return (
        counts.join(star.dim_product.select("product_sk"), "product_sk")
        .orderBy(F.desc("total_unidades_vendidas"), F.asc("product_sk"))
        .limit(k)
        .select(label(dv.ITEM_LABEL, "product_sk").alias("produto"), "total_unidades_vendidas")
    )


# --- G-2 -------------------------------------------------------------------
def monthly_revenue_label(star: Star) -> DataFrame:
    """Revenue per ``yyyy-MM`` month text, in order."""
    return (
        _daily_revenue(star)
        .join(star.dim_date.select("date_sk", "full_date"), "date_sk")
        .groupBy(year_month("full_date").alias("ano_mes"))
        .agg(F.sum("revenue").cast(SUM_TYPE).alias("total_vendas"))
        .orderBy("ano_mes")
    )


# --- G-3 -------------------------------------------------------------------
def top_customers(star: Star, k: int = 10) -> DataFrame:
    """Top-k customers by spend, labelled ``client: <customer_sk>``."""
    spend = star.fact_sales.groupBy("customer_sk").agg(F.sum(_revenue()).alias("spend"))
    return (
        spend.join(star.dim_customer.select("customer_sk"), "customer_sk")
        .orderBy(F.desc("spend"), F.asc("customer_sk"))
        .limit(k)
        .select(
            label(dv.CLIENT_LABEL, "customer_sk").alias("cliente"),
            F.col("spend").cast(SUM_TYPE).alias("valor_total_compras"),
        )
    )


# --- G-4 -------------------------------------------------------------------
def monthly_delivery_days(star: Star) -> DataFrame:
    """Delivered orders per purchase month and their mean delivery time (days)."""
    return delivery_days(star.orders_snapshot)


def delivery_days(orders: DataFrame) -> DataFrame:
    """``monthly_delivery_days`` over any snapshot of orders with typed times."""
    return (
        orders.where((F.col("order_status") == dv.STATUS_DELIVERED) & F.col("order_delivered_customer_date").isNotNull())
        .groupBy(year_month("order_purchase_timestamp").alias("ano_mes"))
        .agg(
            F.count("order_id").alias("total_compras"),
            F.avg(elapsed_days("order_purchase_timestamp", "order_delivered_customer_date")).alias(
                "dias_medios_atendimento"
            ),
        )
        .orderBy("ano_mes")
    )


# --- G-5 -------------------------------------------------------------------
def best_worst_month(star: Star, k: int = 10) -> DataFrame:
    """For the k best-selling products: their best and worst month.

    The products are ranked by their total alone; only the sales of those k
    are counted by month. A month's place is the smallest of
    (count, month), with the count negated for the best, so one aggregate
    finds both ends, the earliest month on ties. Months without sales are
    not candidates for the worst month.
    """
    names = star.dim_product.select("product_sk", "product_id")
    totals = star.fact_sales.groupBy("product_sk").agg(F.count("sale_sk").alias("total"))
    top = totals.join(names, "product_sk").orderBy(F.desc("total"), F.asc("product_id")).limit(k)
    sold = star.fact_sales.select("product_sk", "date_sk", "sale_sk").join(
        F.broadcast(top.select("product_sk")), "product_sk"  # k rows
    )
    daily = sold.groupBy("product_sk", "date_sk").agg(F.count("sale_sk").alias("n"))
    monthly = (
        daily.join(star.dim_date.select("date_sk", year_month("full_date").alias("ano_mes")), "date_sk")
        .groupBy("product_sk", "ano_mes")
        .agg(F.sum("n").alias("qtd"))
    )
    ends = monthly.groupBy("product_sk").agg(
        F.min(F.struct((-F.col("qtd")).alias("qtd"), "ano_mes")).alias("best"),
        F.min(F.struct("qtd", "ano_mes")).alias("worst"),
    )
    return ends.select(
        label(dv.ITEM_LABEL, "product_sk").alias("produto"),
        F.col("best.ano_mes").alias("melhor_mes"),
        (-F.col("best.qtd")).alias("qtd_vendas_max"),
        F.col("worst.ano_mes").alias("pior_mes"),
        F.col("worst.qtd").alias("qtd_vendas_min"),
    )


def with_period(df: DataFrame) -> DataFrame:
    """Add ``periodo`` (first day of the month) when ``year`` and ``month`` exist.

    Charts of the monthly reports plot against this date; frames without the
    two columns are returned unchanged.
    """
    if {"year", "month"} <= set(df.columns):
        return df.withColumn("periodo", make_period("year", "month"))
    return df


def preview(report: DataFrame, n: int = 5) -> DataFrame:
    """The first rows of an ordered report: a top-n kept in each task, no full sort."""
    return report.limit(n)
