"""Load job behaviour: first load, rerun, increments, calendar, audits."""

import datetime as dt

from pyspark.sql import functions as F

from starmart.load import run_load
from starmart.plans import quality
from starmart.sinks.warehouse import Warehouse
from tests.helpers import customer, item, order, product, raw, seller, ts

LOAD_DATE = "2024-05-06"


def _inputs(spark, extra_items=(), extra_orders=()):
    return raw(
        spark,
        customers=[customer("c-1"), customer("c-2")],
        sellers=[seller("s-1"), seller("s-2")],
        products=[product("p-1"), product("p-2")],
        orders=[
            order("o-1", "c-1", purchase=ts(2017, 1, 1, 10), delivered=ts(2017, 1, 3, 22)),
            order("o-2", "c-2", purchase=ts(2017, 1, 4)),
            order("o-3", "c-2", purchase=None),
            *extra_orders,
        ],
        items=[
            item("o-1", 1, "p-1", "s-1"),
            item("o-1", 2, "p-1", "s-1"),  # same (order, product, seller) twice
            item("o-2", 1, "p-2", "s-2"),
            item("o-3", 1, "p-1", "s-1"),  # order without purchase time
            *extra_items,
        ],
    )


def _load(spark, root, **kw):
    return run_load(spark, _inputs(spark, **kw), root, load_date=LOAD_DATE, keep_intermediate=True)


def test_first_load(spark, tmp_root):
    report = _load(spark, tmp_root)
    wh = Warehouse(spark, tmp_root)
    star = wh.read_star()
    fact = sorted((r.sale_sk, r.order_id) for r in star.fact_sales.collect())
    # repeated triple kept in the first load; the item of the order with no
    # purchase time is absent; sale keys follow (order_id, item no.)
    assert fact == [(1, "o1"), (2, "o1"), (3, "o2")]
    assert report.added == {"dim_customer": 2, "dim_product": 2, "dim_seller": 2, "dim_date": 4, "fact_sales": 3}
    assert report.violations == 0
    # the calendar fills days without orders between min and max
    days = [r.full_date for r in star.dim_date.orderBy("date_sk").collect()]
    assert days == [dt.date(2017, 1, d) for d in range(1, 5)]
    c = star.dim_customer.orderBy("customer_sk").first()
    assert (c.customer_sk, c.customer_id, str(c.effective_from), c.effective_to, c.is_current) == (
        1, "c1", LOAD_DATE, None, True
    )
    # the order without purchase time is kept in the orders snapshot
    assert star.orders_snapshot.count() == 3


def test_rerun_adds_nothing(spark, tmp_root):
    _load(spark, tmp_root)
    wh = Warehouse(spark, tmp_root)
    before = {n: df.count() for n, df in wh.read_star_tables().items()}
    report = _load(spark, tmp_root)
    assert all(v == 0 for v in report.added.values())
    assert {n: df.count() for n, df in wh.read_star_tables().items()} == before


def test_increment_respects_coarse_guard_and_extends_calendar(spark, tmp_root):
    _load(spark, tmp_root)
    report = _load(
        spark,
        tmp_root,
        extra_orders=[order("o-4", "c-1", purchase=ts(2017, 1, 7))],
        extra_items=[
            item("o-1", 3, "p-1", "s-1"),  # new item of an already loaded triple → skipped
            item("o-4", 1, "p-2", "s-1"),  # new order → added
        ],
    )
    assert report.added["fact_sales"] == 1
    assert report.added["dim_date"] == 3  # 2017-01-05 .. 2017-01-07
    star = Warehouse(spark, tmp_root).read_star()
    new = star.fact_sales.where(F.col("order_id") == "o4").first()
    assert new.sale_sk == 4
    dd = {r.full_date: r.date_sk for r in star.dim_date.collect()}
    assert dd[dt.date(2017, 1, 7)] == 7 and dd[new_date(star, new.date_sk)] == 7


def new_date(star, date_sk):
    return star.dim_date.where(F.col("date_sk") == date_sk).first().full_date


def test_validations_after_load(spark, tmp_root):
    _load(spark, tmp_root)
    wh = Warehouse(spark, tmp_root)
    tb, star = wh.read_clean(), wh.read_star()
    counts = dict(quality.validate_counts(tb, star).collect())
    assert list(counts.values()) == [3, 4, 3]
    assert all(v == 0 for _, v in quality.validate_null_keys(star).collect())
    sums = [v for _, v in quality.validate_price_sum(tb, star).collect()]
    assert sums[0] - sums[1] == 10  # the dropped item (order without purchase time)


def test_audit_counts_violations(spark):
    from starmart.plans.star import CleanTables

    cust = spark.createDataFrame([("c1", "u"), ("c1", "u"), (None, None)], "customer_id string, customer_unique_id string")
    cust = cust.select("*", F.lit("z").alias("customer_zip_code_prefix"), F.lit("x" * 101).alias("customer_city"),
                       F.lit("XX").alias("customer_state"))
    sell = spark.createDataFrame([("s1", "0", "c", "XX")], "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    prod = spark.createDataFrame([("p1", "cat")], "product_id string, product_category_name string")
    orders = spark.createDataFrame([("o1", "c404", "ok")], "order_id string, customer_id string, order_status string")
    items = spark.createDataFrame([("o1", 1, "p1", "s1"), ("o1", 1, "p2", "s1")], "order_id string, order_item_id int, product_id string, seller_id string")
    tb = CleanTables(cust, sell, prod, orders, items)
    got = {(r.table_name, r.rule): r.violations for r in quality.audit_constraints(tb, None).collect()}
    assert got[("tb_customers", "primary key (customer_id)")] == 1  # c1 twice: one row too many
    assert got[("tb_customers", "not null (customer_id)")] == 1
    assert got[("tb_customers", "width (customer_city <= 100)")] == 3
    assert got[("tb_orders", "foreign key (customer_id) -> tb_customers")] == 1
    assert got[("tb_order_items", "primary key (order_id, order_item_id)")] == 1
    assert got[("tb_order_items", "foreign key (product_id) -> tb_products")] == 1
    assert got[("tb_sellers", "primary key (seller_id)")] == 0


def test_catalog_registration_and_cleanup(spark, tmp_root):
    _load(spark, tmp_root)
    wh = Warehouse(spark, tmp_root)
    names = wh.register("analytics_test")
    assert {"fact_sales", "dim_date", "tb_orders"} <= set(names)
    assert spark.sql("SELECT COUNT(*) FROM fact_sales").first()[0] == 3  # unqualified name resolves
    dropped = wh.drop_intermediates()
    assert "tb_orders" in dropped and not wh.exists("tb_orders")
    assert not spark.catalog.tableExists("tb_orders", "analytics_test")
    assert wh.exists("fact_sales") and wh.exists("orders_snapshot")
    spark.catalog.setCurrentDatabase("default")


def test_violation_blocks_publishing(spark, tmp_root):
    import pytest

    bad = raw(
        spark,
        customers=[customer("c-1", city="x" * 101)],
        sellers=[seller("s-1")],
        products=[product("p-1")],
        orders=[order("o-1", "c-1", purchase=ts(2017, 1, 1))],
        items=[item("o-1", 1, "p-1", "s-1")],
    )
    with pytest.raises(ValueError, match="nothing published"):
        run_load(spark, bad, tmp_root, load_date=LOAD_DATE, keep_intermediate=True)
    wh = Warehouse(spark, tmp_root)
    assert all(df.count() == 0 for df in wh.read_star_tables().values())
    report = run_load(spark, bad, tmp_root, load_date=LOAD_DATE, raise_on_violation=False, keep_intermediate=True)
    assert report.violations == 1 and report.published


def _star_of(spark, fact_keys, customer_keys, sale_keys=None):
    from starmart import schemas
    from starmart.plans.star import Star

    sale_keys = sale_keys or range(1, len(fact_keys) + 1)
    fact = spark.createDataFrame(
        [(s, "o", k, 1, 1, 1, None, None) for s, k in zip(sale_keys, fact_keys)], schemas.FACT_SALES
    )
    customers = spark.createDataFrame([(k, f"c{i}", None, None, True) for i, k in enumerate(customer_keys)], schemas.DIM_CUSTOMER)
    one = {n: spark.createDataFrame([(1, *[None] * (len(s.fields) - 1))], s) for n, s in schemas.STAR_SCHEMAS.items()}
    return Star(**one | {"dim_customer": customers, "fact_sales": fact}, orders_snapshot=None)


def _violations(parts):
    return {(r.table_name, r.rule): r.violations for p in parts for r in p.collect()}


def test_key_orphans_range_check_and_fallback(spark):
    from starmart.plans.quality import audit_star, orphans

    for keys in ([1, 2, 3, 4], [1, 2, 4, 5], []):
        star = _star_of(spark, [1, 3, 5, None, 0], keys)
        found = _violations(audit_star(star))
        slow = orphans(star.fact_sales, star.dim_customer, "f", "customer_sk", "d").first().violations
        assert found["fact_sales", "foreign key (customer_sk) -> dim_customer"] == slow
        assert found["fact_sales", "not null (customer_sk)"] == 1
        assert found["fact_sales", "foreign key (date_sk) -> dim_date"] == 0
    assert slow == 4


def test_repeated_keys_that_fill_their_range_are_found(spark):
    from starmart.plans.quality import audit_star

    # As many as the range has, with its sum and sum of squares: 1, 5, 6 in place of 2, 3, 7.
    star = _star_of(spark, [1] * 7, [1], sale_keys=[1, 1, 4, 5, 5, 6, 6])
    assert _violations(audit_star(star))["fact_sales", "primary key (sale_sk)"] == 3
    star = _star_of(spark, [1] * 4, [1], sale_keys=[2, 3, 4, 5])
    assert _violations(audit_star(star))["fact_sales", "primary key (sale_sk)"] == 0


def test_new_rows_are_checked_against_the_ranges_of_stored_folders(spark):
    from starmart.plans.quality import STAR_KEYS, audit_star
    from starmart.sinks.commits import Folder
    from starmart.sinks.warehouse import Delta

    def audit(sales, had, customers=(4, 5), keys=(5, 1)):
        # The stored rows are 1 to 3 of each table; only new ones are in these frames.
        new = _star_of(spark, list(keys), list(customers), sale_keys=sales)
        old = _star_of(spark, [1, 2, 3], [1, 2, 3])
        star = type(new)(**{n: f.unionByName(getattr(new, n)) for n, f in old.as_dict().items() if f is not None}, orders_snapshot=None)
        deltas = {n: Delta(getattr(new, n) if n in ("dim_customer", "fact_sales") else getattr(new, n).limit(0), had if n in ("dim_customer", "fact_sales") else (Folder("x", 1, 1, 1),)) for n in STAR_KEYS}
        return _violations(audit_star(star, deltas))

    had = (Folder("a", 2, 1, 2), Folder("b", 1, 3, 3))
    found = audit([4, 5], had)
    assert found["fact_sales", "primary key (sale_sk)"] == 0
    assert found["dim_customer", "primary key (customer_sk)"] == 0
    assert found["fact_sales", "foreign key (customer_sk) -> dim_customer"] == 0
    assert audit([3, 4], had)["fact_sales", "primary key (sale_sk)"] == 1  # 3 is stored
    assert audit([4, 5], had, customers=(3, 4))["dim_customer", "primary key (customer_sk)"] == 1
    assert audit([4, 5], had, keys=(6, 1))["fact_sales", "foreign key (customer_sk) -> dim_customer"] == 1


def test_audit_reads_the_fact_once_and_moves_none_of_its_keys(spark, tmp_root):
    from starmart.plans import quality

    _load(spark, tmp_root)
    wh = Warehouse(spark, tmp_root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = quality.audit_constraints(wh.read_clean(), wh.read_star())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The fact's one scan is in the statistics; what is left reads the clean layer and the dimensions.
    assert ".fact_sales_" not in plan and "sale_sk" not in plan
    # One shuffle for all text keys; the others put sums of one row together.
    assert plan.count("FileScan") <= 18 and plan.count("Exchange hashpartitioning(g") <= 4 and plan.count("Exchange") <= 12


def test_drop_leaves_other_databases_and_roots_alone(spark, tmp_root):
    wh = Warehouse(spark, f"{tmp_root}/a")
    frame = spark.createDataFrame([(1,)], "x int")
    spark.sql("CREATE DATABASE IF NOT EXISTS other_db")
    frame.write.mode("overwrite").saveAsTable("other_db.tb_orders")
    try:
        wh.overwrite("tb_orders", frame)
        wh.register("roots_test", use=False)
        assert wh.drop("tb_orders") and not wh.exists("tb_orders")
        assert spark.table("other_db.tb_orders").count() == 1
        second = Warehouse(spark, f"{tmp_root}/b")
        for w, rows in ((wh, [(1,), (2,)]), (second, [(i,) for i in range(5)])):
            w.overwrite("dim_x", spark.createDataFrame(rows, "x int"))
            w.register("roots_test", use=False)
            assert spark.table("roots_test.dim_x").count() == len(rows)
        assert wh.drop("dim_x") and spark.table("roots_test.dim_x").count() == 5  # the entry is the second root's
    finally:
        spark.sql("DROP DATABASE IF EXISTS other_db CASCADE")
        spark.sql("DROP DATABASE IF EXISTS roots_test CASCADE")


def test_second_load_keeps_the_orders_of_the_first(spark, tmp_root):
    from starmart.plans import analytics

    def batch(n, month):
        return raw(
            spark,
            customers=[customer("c-1")],
            sellers=[seller("s-1")],
            products=[product("p-1")],
            orders=[order(f"o-{n}", "c-1", purchase=ts(2017, month, 5))],
            items=[item(f"o-{n}", 1, "p-1", "s-1")],
        )

    run_load(spark, batch(1, 1), tmp_root, load_date=LOAD_DATE)
    # A load that broke off before its rename is in no table.
    wh = Warehouse(spark, tmp_root)
    wh.read_star().fact_sales.write.parquet(f"{tmp_root}/_pending/fact_sales-broken")
    run_load(spark, batch(2, 2), tmp_root, load_date=LOAD_DATE)
    star = wh.read_star()
    assert star.fact_sales.count() == 2
    months = {(r.year, r.month) for r in analytics.monthly_revenue(star).collect()}
    assert months == {(2017, 1), (2017, 2)}
    assert [r.order_month for r in analytics.monthly_average_ticket(star).collect()] == ["2017-01", "2017-02"]
    cohort = [(r.cohort_month, r.month_number) for r in analytics.cohort_retention(star).collect()]
    assert cohort == [("2017-01", 0), ("2017-01", 1)]
