"""One log entry publishes a load: breaks, races and rebuilds show old or new rows, never a mix."""

import os
from concurrent.futures import ThreadPoolExecutor
from itertools import count

import pytest
from pyspark.sql import functions as F

from starmart import load as job
from starmart import schemas
from starmart.plans import analytics, fact
from starmart.session import checkpoint_root
from starmart.sinks import storage
from starmart.sinks.commits import CommitLog, Folder, State
from starmart.sinks.warehouse import ConcurrentLoad, Load, Warehouse
from tests.helpers import customer, item, order, product, raw, seller, ts


def batch(spark, n):
    """Order n, its own customer, product and seller, and order 0 again with another status."""
    return raw(
        spark,
        customers=[customer("c-0"), customer(f"c-{n}")],
        sellers=[seller(f"s-{n}")],
        products=[product(f"p-{n}")],
        orders=[order("o-0", "c-0", status=f"status {n}", purchase=ts(2017, 1, 1)), order(f"o-{n}", f"c-{n}", purchase=ts(2017, 1, n + 1))],
        items=[item("o-0", 1, f"p-{n}", f"s-{n}"), item(f"o-{n}", 1, f"p-{n}", f"s-{n}", price=f"{n}.50")],
    )


def run(spark, root, n):
    return job.run_load(spark, batch(spark, n), root, load_date="2024-01-01", stage_inputs=False, audit=False)


def rows(wh):
    names = (*schemas.STAR_ORDER, wh.SNAPSHOT)
    return {n: sorted(map(repr, wh.read(n).collect())) for n in names}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("commits"))
    run(spark, root, 1)
    return root


def test_a_load_that_stops_at_any_step_changes_nothing(spark, loaded, monkeypatch):
    wh = Warehouse(spark, loaded)
    before, listing = rows(wh), {n: sorted(os.listdir(wh.path(n))) for n in wh.tables()}
    write = Load._write
    for last in range(1, 12):  # five clean tables, five star tables, the snapshot
        step = count(1)

        def stop(self, name, shape, df, last=last, step=step):
            at = next(step)  # some steps run at the same time: those behind the last fail, too
            folder = write(self, name, shape, df)
            if at >= last:
                raise RuntimeError("executor lost")
            return folder

        monkeypatch.setattr(Load, "_write", stop)
        with pytest.raises(RuntimeError, match="executor lost"):
            run(spark, loaded, 2)
        assert next(step) > last
    monkeypatch.setattr(Load, "_write", write)

    def no_commit(self, after):
        raise OSError("log not reached")

    monkeypatch.setattr(CommitLog, "commit", no_commit)
    with pytest.raises(OSError):
        run(spark, loaded, 2)
    monkeypatch.undo()
    assert rows(wh) == before and wh.state().version == 1
    assert {n: sorted(os.listdir(wh.path(n))) for n in wh.tables()} == listing  # nothing left behind
    scratch = f"{checkpoint_root(spark)}/starmart"
    assert not [n for n in os.listdir(scratch) if n.startswith("job-")]


def test_of_two_loads_at_once_the_second_is_refused(spark, loaded, monkeypatch):
    wh = Warehouse(spark, loaded)
    version = wh.state().version
    snapshot = job.write_snapshot

    def overtaken(load, inputs):
        monkeypatch.setattr(job, "write_snapshot", snapshot)
        assert run(spark, loaded, 2).published  # begins and ends inside the other
        return snapshot(load, inputs)

    monkeypatch.setattr(job, "write_snapshot", overtaken)
    with pytest.raises(ConcurrentLoad):
        run(spark, loaded, 3)
    after = rows(wh)
    assert wh.state().version == version + 1
    assert not any("o3" in r for r in after["fact_sales"] + after["orders_snapshot"])
    assert run(spark, loaded, 3).added["fact_sales"] == 2  # run again, it publishes
    keys = [r.sale_sk for r in wh.read("fact_sales").collect()]
    assert len(keys) == len(set(keys)) and max(keys) == len(keys)


def test_snapshot_keeps_earlier_orders_and_a_failing_write_leaves_them(spark, loaded):
    wh = Warehouse(spark, loaded)
    had = rows(wh)["orders_snapshot"]
    bad = wh.read(wh.SNAPSHOT).withColumn("order_status", F.raise_error(F.lit("no disk")).cast("string"))
    with pytest.raises(Exception, match="no disk"):
        wh.overwrite(wh.SNAPSHOT, bad)
    assert rows(wh)["orders_snapshot"] == had and len(had) >= 2


def test_snapshot_holds_delivered_orders_of_unknown_customers(spark, tmp_root):
    inputs = raw(
        spark,
        customers=[customer("c-1")],
        sellers=[seller("s-1")],
        products=[product("p-1")],
        orders=[
            order("o-1", "c-1", purchase=ts(2017, 1, 1), delivered=ts(2017, 1, 3)),
            order("o-2", "c-404", purchase=ts(2017, 1, 1), delivered=ts(2017, 1, 5)),
            order("o-2", "c-404", purchase=ts(2017, 1, 1), delivered=ts(2017, 1, 5)),
            order("o-3", "c-1", status=None, purchase=ts(2017, 1, 2)),
        ],
        items=[item("o-1", 1, "p-1", "s-1"), item("o-2", 1, "p-1", "s-1")],
    )
    job.run_load(spark, inputs, tmp_root, load_date="2024-01-01", stage_inputs=False)
    star = Warehouse(spark, tmp_root).read_star()
    assert {r.order_id: r.order_status for r in star.orders_snapshot.collect()} == {
        "o1": "delivered", "o2": "delivered", "o3": None
    }
    assert star.fact_sales.count() == 1
    assert [tuple(r) for r in analytics.monthly_delivery_days(star).collect()] == [("2017-01", 2, 3.0)]


def test_put_if_absent_lets_one_of_many_through(spark, tmp_root):
    path = f"{tmp_root}/_log/1.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: storage.put_if_absent(spark, path, f"text {i}"), range(8)))
    assert sum(won) == 1
    assert storage.read_text(spark, path) == f"text {won.index(True)}"
    assert [n for n, _, _ in storage.children(spark, f"{tmp_root}/_log")] == ["1.json"]


def test_vacuum_removes_what_no_version_lists(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    frames = [spark.range(n).select(F.col("id").cast("string").alias("order_id")) for n in (3, 5, 2)]
    wh.overwrite(wh.SNAPSHOT, frames[0])
    wh.overwrite(wh.SNAPSHOT, frames[1])
    wh.append(wh.SNAPSHOT, frames[2])
    spark.range(4).write.parquet(f"{wh.path(wh.SNAPSHOT)}/load=broken")
    assert wh.read(wh.SNAPSHOT).count() == 7
    assert wh.vacuum(older_than_hours=1) == []  # a running load's folders are young
    gone = wh.vacuum(older_than_hours=0)
    assert len(gone) == 2 and "orders_snapshot/load=broken" in gone
    assert wh.read(wh.SNAPSHOT).count() == 7 and wh.log.versions() == [3]
    assert wh.compact(wh.SNAPSHOT).count() == 7
    assert len(wh.state().tables[wh.SNAPSHOT].folders) == 1


def test_another_session_reads_the_same_version(spark, loaded):
    other = spark.newSession()
    assert rows(Warehouse(other, loaded)) == rows(Warehouse(spark, loaded))
    assert State.from_json(Warehouse(spark, loaded).state().to_json()) == Warehouse(other, loaded).state()


# ---- plans ---------------------------------------------------------------


def nodes_above(plan, leaf):
    """The nodes from each leaf that holds ``leaf`` up to the root (of a plan printed as a tree)."""
    lines = plan.split("\n")
    depth = lambda x: len(x) - len(x.lstrip(" :+-*"))
    for i, line in enumerate(lines):
        if leaf in line:
            path, at = [], depth(line)
            for up in reversed(lines[:i]):
                if up.strip() and depth(up) < at:
                    path.append(up.lstrip(" :+-*"))
                    at = depth(up)
            yield path


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("report", [analytics.cohort_retention, analytics.monthly_average_ticket])
def test_fact_and_snapshot_meet_without_an_exchange(spark, loaded, no_broadcast, report):
    star = Warehouse(spark, loaded).read_star()
    plan = report(star)._jdf.queryExecution().executedPlan().toString()
    for table in ("fact_sales", "orders_snapshot"):
        paths = list(nodes_above(plan, f".{table}_"))
        assert paths
        for path in paths:
            join = next(i for i, x in enumerate(path) if "SortMergeJoin [order_id" in x)
            assert not [x for x in path[:join] if x.startswith("Exchange")]


def test_guard_moves_only_the_batch_and_skips_folders_out_of_its_range(spark, loaded, no_broadcast):
    if not Warehouse(spark, loaded).read("fact_sales").where("order_id = 'o2'").count():
        run(spark, loaded, 2)
    with Warehouse(spark, loaded).begin() as load:
        load.done = True  # nothing to commit
        candidates = spark.createDataFrame([("o2", 1, 5, 5)], "order_id string, order_item_id int, product_sk long, seller_sk long")
        stored = load.read("fact_sales", ("o2", "o2"))
        plan = fact.stored_sales_of(candidates, stored)._jdf.queryExecution().executedPlan().toString()
        (path,) = nodes_above(plan, ".fact_sales_")
        assert not [x for x in path if x.startswith(("Exchange", "Sort"))]
        scan = " ".join(stored.inputFiles())
        folders = load.tables["fact_sales"].folders
        met = [f.name for f in folders if f.meets("o2", "o2")]
        assert 0 < len(met) < len(folders)
        assert all((f.name in scan) == (f.name in met) for f in folders)


def test_folder_ranges():
    f = Folder("x", 3, 1, 3, "b", "d")
    assert [f.meets(*r) for r in (("a", "a"), ("a", "b"), ("c", "c"), ("d", "z"), ("e", "z"))] == [False, True, True, True, False]
    assert Folder("x", 3).meets("a", "b")
