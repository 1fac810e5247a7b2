"""Physical-plan shape: the operators the design relies on are the ones planned."""

import pytest

from starmart import registry
from starmart.plans import analytics
from starmart.plans.star import clean_all
from starmart.sources.testdata import load_testdata

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return registry.stored(spark, SF)[1]


def test_items_are_cut_to_one_row_a_key_before_the_shuffle(spark):
    raw = load_testdata(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = plan(clean_all(raw).order_items).split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    at = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(order_id" in x and "order_item_id" in x)
    assert "partial_min" in "".join(lines[at : at + 3])


def test_inputs_are_pruned_and_not_shuffled_as_they_are_read(spark):
    raw = load_testdata(spark, SF)
    p = plan(raw.orders)
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:" in p and "REPARTITION" not in p
    assert "l_comment" not in plan(raw.items) and "l_returnflag" not in plan(raw.items)


def test_new_members_use_anti_join(spark):
    from starmart.operators import absent_from

    tb = clean_all(load_testdata(spark, SF))
    existing = spark.createDataFrame([], "product_sk bigint, product_id string")
    assert "LeftAnti" in plan(absent_from(tb.products.select("product_id"), existing, ["product_id"]))


def test_parent_filter_is_semi_join(spark):
    tb = clean_all(load_testdata(spark, SF))
    assert "LeftSemi" in plan(tb.orders)


def test_top_k_is_take_ordered(star):
    p = plan(analytics.top_products(star))
    assert "TakeOrderedAndProject" in p and "limit=10" in p


def exchanges(df) -> list[str]:
    return [x for x in plan(df).split("\n") if "Exchange" in x]


def test_cube_moves_no_cell_that_has_a_product(spark, star):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cube = analytics.sales_cube(star, sort=False)
        found = exchanges(cube)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Expand" not in plan(cube)
    # Eight sets are sums within the buckets of the written cells; seven of the others move sums of sellers' months.
    assert not [x for x in found if "product_sk" in x]
    assert plan(cube).count("Bucketed: true") == 7 and len(found) <= 11


def test_cube_cells_are_summed_before_they_are_moved(spark, star):
    sales = star.fact_sales.groupBy("seller_sk", "product_sk", "date_sk").agg({"price": "sum"})
    lines = plan(sales).split("\n")
    (at,) = [i for i, x in enumerate(lines) if "Exchange" in x]
    assert "partial_sum" in lines[at + 1]
    cells = analytics.cube_cells(star)
    assert cells.groupBy("product_sk", "year").count().rdd.getNumPartitions() == 8  # the buckets, in place
    assert not exchanges(cells.groupBy("product_sk", "year").count())


def test_cohorts_move_customers_once_and_build_their_cells_once(spark, star):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exchanges(analytics.cohort_retention(star))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # customers; cells; cells by cohort; the order of the report
    assert len(found) == 4 and sum("customer_sk" in x for x in found) == 1


def test_reports_aggregate_the_fact_before_joining_dimensions(star):
    p = plan(analytics.monthly_revenue(star))
    # the fact scan feeds an aggregate by date_sk before any join
    assert "keys=[date_sk" in p


def test_scans_prune_columns(star):
    p = star.fact_sales.select("date_sk", "price").where("price > 0")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<date_sk:bigint,price:decimal(10,2)>" in p
    assert "PushedFilters" in p and "GreaterThan(price" in p


def test_orders_of_a_load_are_read_from_what_was_written_once(spark):
    p = plan(registry._inputs(spark, SF).orders)
    assert "Join" not in p and "lineitem" not in p


def test_cube_cells_are_summed_by_month_where_sales_are_read(spark, star, monkeypatch):
    seen = []
    monkeypatch.setattr(analytics, "stage_bucketed", lambda df, by, n: seen.append(plan(df)) or df)
    analytics.cube_cells(star)
    moved = [x for x in seen[0].split("\n") if "Exchange" in x and "Broadcast" not in x]
    assert len(moved) == 1 and "month" in moved[0] and "date_sk" not in moved[0]


def test_candidates_are_dealt_once_by_order(spark, star):
    """The guard and the key assignment read candidates where they lie; neither moves one."""
    from starmart.plans import fact

    tb = registry.stored(spark, SF)[0]
    dims = (star.dim_customer, star.dim_product, star.dim_seller, star.dim_date)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = fact.stage_candidates(fact.fact_candidates(tb.order_items, tb.orders, *dims))
        found = exchanges(fact.key_fact(staged, 1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [x for x in found if "product_sk" in x or "order_item_id" in x]
    assert fact.key_fact(staged, 1).count() == star.fact_sales.count()
