"""Report queries on a hand-made star, against values worked out by hand."""

import datetime as dt
from decimal import Decimal

import pytest

from starmart import schemas
from starmart.plans import analytics
from starmart.plans.star import Star
from tests.helpers import ts


@pytest.fixture(scope="module")
def star(spark):
    days = [dt.date(2017, 1, 1) + dt.timedelta(days=i) for i in range(90)]  # Jan..Mar 2017
    dim_date = spark.createDataFrame(
        [(i + 1, d, d.year, d.month, d.day, (d.month - 1) // 3 + 1, d.isoweekday(), d.isocalendar()[1])
         for i, d in enumerate(days)],
        schemas.DIM_DATE,
    )
    sk = {d: i + 1 for i, d in enumerate(days)}
    jan, feb, mar = dt.date(2017, 1, 10), dt.date(2017, 2, 10), dt.date(2017, 3, 10)
    m = Decimal
    # (sale, order, customer, product, seller, day, price, freight)
    rows = [
        (1, "oA1", 1, 2, 1, jan, m("5.00"), m("0.00")),
        (2, "oA1", 1, 2, 1, jan, m("5.00"), m("0.00")),
        (3, "oB1", 2, 2, 1, jan, m("10.01"), m("0.00")),
        (4, "oB2", 2, 1, 2, feb, m("1.00"), m("0.50")),
        (5, "oC1", 3, 1, 2, feb, m("1.00"), m("0.50")),
        (6, "oC1", 3, 2, 2, feb, m("2.00"), m("0.00")),
        (7, "oA2", 1, 2, 1, mar, m("3.00"), m("1.00")),
    ]
    fact = spark.createDataFrame(
        [(s, o, c, p, se, sk[d], pr, fr) for s, o, c, p, se, d, pr, fr in rows], schemas.FACT_SALES
    )
    orders = spark.createDataFrame(
        [(o, f"c{c}", "delivered", dt.datetime.combine(d, dt.time(8)), None, None,
          dt.datetime.combine(d, dt.time(20)), None)
         for o, c, d in {(r[1], r[2], r[5]) for r in rows}],
        schemas.RAW_ORDERS,
    )
    dim_product = spark.createDataFrame([(1, "p1"), (2, "p2")], schemas.DIM_PRODUCT)
    dim_seller = spark.createDataFrame([(1, "s1"), (2, "s2")], schemas.DIM_SELLER)
    dim_customer = spark.createDataFrame(
        [(i, f"c{i}", dt.date(2024, 1, 1), None, True) for i in (1, 2, 3)], schemas.DIM_CUSTOMER
    )
    return Star(dim_customer, dim_product, dim_seller, dim_date, fact, orders)


def test_best_and_worst_month(star):
    got = {r.produto: tuple(r)[1:] for r in analytics.best_worst_month(star).collect()}
    # p1 sold in February only: best and worst month are the same
    assert got["item: 1"] == ("2017-02", 2, "2017-02", 2)
    # p2: Jan 3, Feb 1, Mar 1 → worst is the earliest of the tied months
    assert got["item: 2"] == ("2017-01", 3, "2017-02", 1)


def test_cohort_retention(star):
    got = {(r.cohort_month, r.month_number): (r.retained_customers, r.cohort_size, r.retention_rate)
           for r in analytics.cohort_retention(star).collect()}
    # customers 1 and 2 start in January, 3 in February; 1 returns in March, 2 in February
    assert got == {
        ("2017-01", 0): (2, 2, 100.0),
        ("2017-01", 1): (1, 2, 50.0),
        ("2017-01", 2): (1, 2, 50.0),
        ("2017-02", 0): (1, 1, 100.0),
    }


def test_average_ticket_rounds_half_up_exactly(star):
    got = {r.order_month: (r.total_orders, r.total_revenue, r.average_ticket)
           for r in analytics.monthly_average_ticket(star).collect()}
    # January: orders of 10.00 and 10.01 → 10.005 → 10.01
    assert got["2017-01"] == (2, Decimal("20.01"), Decimal("10.01"))
    assert got["2017-02"] == (2, Decimal("5.00"), Decimal("2.50"))


def test_cube_totals_and_nulls_last(star):
    rows = analytics.sales_cube(star).collect()
    assert len({(r.seller_sk, r.product_sk, r.year, r.month) for r in rows}) == len(rows)
    grand = [r for r in rows if r.seller_sk is None and r.product_sk is None and r.year is None and r.month is None]
    assert grand[0].total_vendas == Decimal("29.01") and rows[-1] == grand[0]


def test_monthly_and_top_reports(star):
    assert [(r.year, r.month, r.total_vendas) for r in analytics.monthly_revenue(star).collect()] == [
        (2017, 1, Decimal("20.01")), (2017, 2, Decimal("5.00")), (2017, 3, Decimal("4.00"))
    ]
    assert [tuple(r) for r in analytics.top_products(star, 1).collect()] == [(2, 5)]
    assert [tuple(r) for r in analytics.top_customers(star, 2).collect()] == [
        ("client: 1", Decimal("14.00")), ("client: 2", Decimal("11.51"))
    ]
    assert [tuple(r) for r in analytics.top_items_labelled(star, 2).collect()] == [("item: 2", 5), ("item: 1", 2)]
    delivery = analytics.monthly_delivery_days(star).collect()
    assert [(r.ano_mes, r.total_compras, r.dias_medios_atendimento) for r in delivery][0] == ("2017-01", 2, 0.5)


def _star_of_purchases(spark, purchases):
    """(customer, order time) pairs as a fact and a snapshot of one order each."""
    fact = [(i, f"o{i}", c, 1, 1, 1, None, None) for i, (c, _) in enumerate(purchases)]
    orders = [(f"o{i}", "c", "delivered", t, None, None, None, None) for i, (_, t) in enumerate(purchases)]
    frames = {n: spark.createDataFrame([], s) for n, s in schemas.STAR_SCHEMAS.items()}
    frames["fact_sales"] = spark.createDataFrame(fact + fact[:2], schemas.FACT_SALES)  # two items of one order
    return Star(**frames, orders_snapshot=spark.createDataFrame(orders, schemas.RAW_ORDERS))


def test_cohorts_over_more_months_than_a_word_holds(spark):
    import random
    from collections import Counter

    r = random.Random(7)
    purchases = [(c, ts(1990 + (m := r.randrange(200)) // 12, m % 12 + 1, 5)) for c in range(40) for _ in range(r.randrange(1, 9))]
    purchases += [(1, None), (99, None)]  # no time: no month
    got = {(r.cohort_month, r.month_number): (r.retained_customers, r.cohort_size, r.retention_rate)
           for r in analytics.cohort_retention(_star_of_purchases(spark, purchases)).collect()}
    months = {}
    for c, t in purchases:
        if t:
            months.setdefault(c, set()).add(t.year * 12 + t.month - 1)
    cells = Counter((min(ms), m - min(ms)) for ms in months.values() for m in ms)
    expected = {(f"{a // 12:04d}-{a % 12 + 1:02d}", d): (n, cells[a, 0], n * 100 / cells[a, 0]) for (a, d), n in cells.items()}
    assert got == expected and max(d for _, d in got) > 2 * analytics.MONTHS_A_WORD


def test_cohorts_of_nothing(spark):
    assert analytics.cohort_retention(_star_of_purchases(spark, [])).collect() == []
    assert analytics.cohort_retention(_star_of_purchases(spark, [(1, None)])).collect() == []
