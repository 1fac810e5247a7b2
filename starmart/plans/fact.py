"""Fact load: one row per clean order item, keyed by the dimensions.

Lookups are inner joins, so an item whose order, customer, product, seller
or purchase day is not found is left out (an order without a purchase time
drops its items); the row-count reconciliation report exposes that.

Rerun guard: an item is skipped when the fact already holds a row with the
same (order_id, product_sk, seller_sk) — checked against the fact as it
stood before this load, with no dedup inside the load itself. That guard is
coarser than the fact grain, on purpose: it reproduces the source exactly
(first load keeps repeated triples; a later load drops a new item of an
already loaded triple).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.operators import absent_from, assign_keys_in_groups, next_key
from starmart.session import stage_bucketed

FACT_ORDER = ("order_id", "order_item_id")


def fact_candidates(
    items: DataFrame,
    orders: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_seller: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """Items with every surrogate key resolved (before the rerun guard).

    Join order for scale: the order-level keys (customer and date) are
    resolved on the order headers, which are several times fewer than the
    items; the items meet the product and seller dimensions first and the
    resolved headers last, so that they come out dealt by ``order_id``, as the
    guard, the key assignment and the fact want them, and no later step moves
    them. The big side is shuffled three times in all. Which dimension joins
    broadcast is left to the planner's size checks (static file sizes for
    stored tables, runtime sizes under adaptive execution): a dimension that
    grows past the threshold falls back to a shuffle join. All joins are
    inner, as in the source, so the order of the lookups does not change the
    result.
    """
    heads = (
        orders.select("order_id", "customer_id", F.to_date("order_purchase_timestamp").alias("full_date"))
        .join(dim_customer.where(F.col("is_current")).select("customer_id", "customer_sk"), "customer_id")
        .join(dim_date.select("full_date", "date_sk"), "full_date")
        .select("order_id", "customer_sk", "date_sk")
    )
    return (
        items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
        .join(dim_product.select("product_id", "product_sk"), "product_id")
        .join(dim_seller.select("seller_id", "seller_sk"), "seller_id")
        .drop("product_id", "seller_id")
        .join(heads, "order_id")
        .select(
            "order_id", "order_item_id", "customer_sk", "product_sk", "seller_sk", "date_sk",
            "price", "freight_value",
        )
    )


GUARD_KEYS = ["order_id", "product_sk", "seller_sk"]


def stored_sales_of(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """(order_id, product_sk, seller_sk) of the stored sales whose order the batch has.

    The batch's orders are the side that is hashed: the stored fact streams
    past them, neither sorted nor, where it is bucketed by order, moved. What
    comes out is as large as the batch.
    """
    orders = candidates.select("order_id").distinct()
    return existing.select(*GUARD_KEYS).join(orders.hint("shuffle_hash"), "order_id", "left_semi")


def rerun_guard(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates whose (order_id, product_sk, seller_sk) is not in the fact yet.

    A sale that could stop a candidate has the candidate's order, so the fact
    is cut to the orders of the batch before the keys are compared. Candidates
    are read twice: pass written rows.
    """
    return absent_from(candidates, stored_sales_of(candidates, existing), GUARD_KEYS)


def stage_candidates(candidates: DataFrame, buckets: int | None = None) -> DataFrame:
    """Candidates written once, bucketed by order: the guard and the key assignment read them, and move none."""
    n = buckets or int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage_bucketed(candidates, "order_id", n)


def key_fact(fresh: DataFrame, start: int) -> DataFrame:
    """Assign ``sale_sk`` from ``start`` in (order_id, item no.) order. Read twice: pass written rows."""
    keyed = assign_keys_in_groups(fresh, FACT_ORDER[0], FACT_ORDER[1:], "sale_sk", start)
    return keyed.select(*schemas.FACT_SALES.fieldNames())


def new_fact_sales(candidates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Fact rows this load adds, keyed after the current largest ``sale_sk``."""
    candidates = stage_candidates(candidates)
    if existing is None:
        return key_fact(candidates, 1)
    return key_fact(stage_candidates(rerun_guard(candidates, existing)), next_key(existing, "sale_sk"))
