"""The load job: raw inputs → staging → clean layer → star schema.

One load is one transaction on the warehouse's commit log (``sinks.commits``):

1. optional staging copy of the raw inputs (``tmp_*``, rebuilt);
2. clean layer (``tb_*``, rebuilt) written parents-first and read back, so
   the dedup and parent filters run once and later steps scan Parquet;
3. the star as the load found it: the folders of the version it began from;
4. new dimension members (insert-if-absent, keys continuing after the current
   maximum), then the fact rows, resolved against existing and new dimensions
   and passed through the rerun guard against the fact as it stood, each
   written once, in folders that no reader looks at yet;
5. the orders snapshot, written anew beside the old one: orders of earlier
   loads stay, those of this one replace theirs;
6. the constraint audit over the clean layer and the star as it will be, read
   from what was written; nothing is published when it finds anything, unless
   ``raise_on_violation=False`` asks for that;
7. one log entry publishes all tables. A load that breaks off anywhere before
   leaves all of them as they were, and of two loads that began from one
   version the second raises ``ConcurrentLoad``; either may be run again.

What is staged on the way (fact candidates, numbered rows of key assignment)
lies in a folder of the job below the shared checkpoint folder and goes with
the job.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.plans import clean, dims, fact
from starmart.plans.quality import audit_constraints
from starmart.plans.star import CleanTables, Star
from starmart.session import job_scratch, stage_rows
from starmart.sinks.warehouse import Load, Warehouse
from starmart.sources.raw import RawSources


@dataclass
class LoadReport:
    added: dict[str, int] = field(default_factory=dict)
    violations: int | None = None
    published: bool = False
    version: int | None = None


def stage_raw(load: Load, raw: RawSources) -> RawSources:
    names = dict(zip(("orders", "items", "customers", "products", "sellers"), Warehouse.STAGING_TABLES))
    return RawSources(**{k: load.replace(names[k], v) for k, v in raw.as_dict().items()})


def together(*jobs: Callable[[], DataFrame]) -> list[DataFrame]:
    """Run independent steps of a load as concurrent Spark jobs; all have ended when it returns or raises."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(copy_context().run, step) for step in jobs]
    return [r.result() for r in running]


def write_snapshot(load: Load, raw: RawSources) -> DataFrame:
    """The orders of this delivery, and those of earlier loads that it doesn't have."""
    orders = clean.snapshot_orders(raw.orders)
    if load.before.tables.get(Warehouse.SNAPSHOT):
        orders = stage_rows(orders)
        # The delivery is hashed; the stored snapshot, bucketed by order, streams past it.
        had = load.read(Warehouse.SNAPSHOT).join(orders.select("order_id").hint("shuffle_hash"), "order_id", "left_anti")
        orders = had.unionByName(orders)
    return load.replace(Warehouse.SNAPSHOT, orders)


def write_tables(load: Load, raw: RawSources, load_date=None) -> tuple[CleanTables, DataFrame]:
    """Clean layer, dimensions, snapshot and fact; returns the clean layer and the snapshot.

    A table is planned against its parents *as written* (read back from
    Parquet), so a parent's dedup and joins run once, not again inside every
    child's plan. Steps that don't need each other run at the same time.
    """
    for name, schema in schemas.STAR_SCHEMAS.items():
        load.ensure(name, schema)
    customers, sellers, products = together(
        lambda: load.replace("tb_customers", clean.clean_customers(raw.customers)),
        lambda: load.replace("tb_sellers", clean.clean_sellers(raw.sellers)),
        lambda: load.replace("tb_products", clean.clean_products(raw.products)),
    )
    orders = load.replace("tb_orders", clean.clean_orders(raw.orders, customers))

    def members(name: str, rows: Callable[[DataFrame], DataFrame]) -> Callable[[], DataFrame]:
        return lambda: load.append(name, rows(load.read(name)))

    items, snapshot, *_ = together(
        lambda: load.replace("tb_order_items", clean.clean_order_items(raw.items, orders, products, sellers)),
        lambda: write_snapshot(load, raw),
        members("dim_date", lambda had: dims.new_dim_date(orders, had)),
        members("dim_customer", lambda had: dims.new_dim_customer(customers, had, load_date)),
        members("dim_product", lambda had: dims.new_dim_product(products, had)),
        members("dim_seller", lambda had: dims.new_dim_seller(sellers, had)),
    )
    tb = CleanTables(customers, sellers, products, orders, items)
    whole = [load.read(name) for name in ("dim_customer", "dim_product", "dim_seller", "dim_date")]
    stored = load.tables["fact_sales"]
    # Dealt like the fact, so its write moves nothing either.
    candidates = fact.stage_candidates(fact.fact_candidates(items, orders, *whole), stored.buckets)
    if stored.folders:
        candidates = guarded(load, candidates)
    load.append("fact_sales", fact.key_fact(candidates, stored.top + 1))
    return tb, snapshot


def guarded(load: Load, candidates: DataFrame) -> DataFrame:
    """Candidates that the stored fact doesn't have; folders whose orders all lie outside the batch's are not read.

    Both sides lie by order, and rows that agree in all three keys agree in the
    order: told so, Spark compares them where they lie.
    """
    bounds = candidates.agg(F.min("order_id"), F.max("order_id")).first()
    if bounds[0] is None:
        return candidates
    fresh = fact.rerun_guard(candidates, load.read("fact_sales", tuple(bounds)))
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = load.spark.conf.get(key, "true")
    load.spark.conf.set(key, "false")
    try:
        return fact.stage_candidates(fresh, load.tables["fact_sales"].buckets)
    finally:
        load.spark.conf.set(key, before)


def run_load(
    spark: SparkSession,
    raw: RawSources,
    root: str,
    load_date=None,
    stage_inputs: bool = True,
    keep_intermediate: bool = False,
    audit: bool = True,
    raise_on_violation: bool = True,
) -> LoadReport:
    wh, report = Warehouse(spark, root), LoadReport()
    with job_scratch(spark), wh.begin() as load:
        if stage_inputs:
            raw = stage_raw(load, raw)
        tb, snapshot = write_tables(load, raw, load_date)
        report.added = {name: load.added(name) for name in schemas.STAR_ORDER}
        if audit:
            star = Star(**{name: load.read(name) for name in schemas.STAR_ORDER}, orders_snapshot=snapshot)
            found = audit_constraints(tb, star, load.deltas(schemas.STAR_ORDER))
            report.violations = int(found.agg(F.sum("violations")).first()[0] or 0)
            if raise_on_violation and report.violations:
                raise ValueError(f"constraint audit found {report.violations} violations; nothing published")
        if not keep_intermediate:
            for name in (*Warehouse.CLEAN_TABLES, *Warehouse.STAGING_TABLES):
                load.drop(name)
        report.version = load.commit().version
        report.published = True
    return report


def main(argv: list[str] | None = None) -> int:
    """``python -m starmart.load --warehouse PATH (--csv DIR | --testdata DIR) [--profile DIR] [--dump DIR]``."""
    import argparse
    import json
    from dataclasses import asdict

    from starmart.job import run_job
    from starmart.session import build_session

    ap = argparse.ArgumentParser(description="Load the star schema (rerun-safe), validate, profile and dump it.")
    ap.add_argument("--warehouse", required=True, help="warehouse root (shared storage)")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="folder with the five source CSV files")
    src.add_argument("--testdata", help="folder with the TPC-H-like test tables")
    ap.add_argument("--one-line-records", action="store_true", help="no line ends in CSV fields: split large files")
    ap.add_argument("--rejects", choices=("fail", "keep"), help="count CSV records that don't fit before failing, or leave them out")
    ap.add_argument("--load-date", help="effective date of new customers (default: today)")
    ap.add_argument("--keep-intermediate", action="store_true")
    ap.add_argument("--lenient", action="store_true", help="publish even when the audit finds violations")
    ap.add_argument("--profile", help="folder for the table profile (CSV)")
    ap.add_argument("--dump", help="folder for the INSERT dump")
    args = ap.parse_args(argv)

    spark = build_session()
    if args.csv:
        from starmart.sources.csv import read_sources

        raw = read_sources(spark, args.csv, multiline=not args.one_line_records, rejects=args.rejects)
    else:
        from starmart.sources.testdata import load_testdata

        raw = load_testdata(spark, args.testdata)
    report = run_job(
        spark,
        raw,
        args.warehouse,
        profile_dir=args.profile,
        dump_dir=args.dump,
        keep_intermediate=args.keep_intermediate,
        load_date=args.load_date,
        stage_inputs=bool(args.csv),
        raise_on_violation=not args.lenient,
    )
    print(json.dumps(asdict(report), default=str))
    return 1 if report.errors else 0


if __name__ == "__main__":
    raise SystemExit(main())
