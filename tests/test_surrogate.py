from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators import assign_surrogate_keys, next_key


def _expected(df, order, start):
    w = Window.orderBy(*order)
    return {tuple(r[:-1]): r[-1] for r in df.withColumn("e", F.row_number().over(w) + start - 1).collect()}


def test_many_buckets_equal_global_rank(spark):
    df = spark.range(0, 5000).select(F.concat(F.lit("k"), (F.col("id") * 7919 % 5000).cast("string")).alias("k"))
    got = assign_surrogate_keys(df, ["k"], "sk", start=101, partitions=17)
    rows = got.collect()
    exp = _expected(df, ["k"], 101)
    assert len(rows) == 5000
    assert {(r.k,): r.sk for r in rows} == exp
    assert sorted(r.sk for r in rows) == list(range(101, 5101))


def test_composite_key_and_repeatability(spark):
    df = spark.range(0, 3000).select(
        (F.col("id") % 97).cast("string").alias("a"), (F.col("id") % 31).cast("int").alias("b"), "id"
    ).dropDuplicates(["a", "b"])
    first = assign_surrogate_keys(df, ["a", "b"], "sk", partitions=13)
    again = assign_surrogate_keys(df, ["a", "b"], "sk", partitions=13)
    a = {(r.a, r.b): r.sk for r in first.collect()}
    b = {(r.a, r.b): r.sk for r in again.collect()}
    assert a == b
    w = Window.orderBy("a", "b")
    exp = {(r.a, r.b): r.e for r in df.withColumn("e", F.row_number().over(w)).collect()}
    assert a == exp


def test_small_input_takes_the_same_way(spark):
    df = spark.range(0, 500).select(F.col("id").cast("string").alias("k"))
    got = assign_surrogate_keys(df, ["k"], "sk", start=7)
    assert {(r.k,): r.sk for r in got.collect()} == _expected(df, ["k"], 7)


def test_empty_input_and_next_key(spark):
    empty = spark.createDataFrame([], "k string")
    assert assign_surrogate_keys(empty, ["k"], "sk").count() == 0
    assert next_key(spark.createDataFrame([], "sk bigint"), "sk") == 1
    assert next_key(spark.createDataFrame([(4,), (9,)], "sk bigint"), "sk") == 10


def test_rows_are_placed_by_range_not_one_task(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("k"))
    out = assign_surrogate_keys(df, ["k"], "sk", partitions=10)
    parts = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(parts) >= 5
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "__sk_part" in plan and "Window" not in plan


def test_many_partitions(spark):
    df = spark.range(0, 20000).select(F.concat(F.lit("O"), (F.col("id") * 7919 % 20000).cast("string")).alias("o"),
                                      (F.col("id") % 3).cast("int").alias("n"))
    got = assign_surrogate_keys(df, ["o", "n"], "sk", partitions=2000)  # 2000 partitions
    exp = _expected(df, ["o", "n"], 1)
    assert {(r.o, r.n): r.sk for r in got.collect()} == exp


def test_keys_in_groups_equal_global_rank_and_move_no_row(spark):
    """Groups are numbered by range, the rows of a bucketed table stay where they are; one group holds a third."""
    from starmart.operators import assign_keys_in_groups
    from starmart.session import stage_bucketed

    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'HOT', cast(id div 4 as string)) as o", "cast(3000 - id as int) as n")
    rows = stage_bucketed(df, "o", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = assign_keys_in_groups(rows, "o", ["n"], "sk", start=11, partitions=5)
        got = {(r.o, r.n): r.sk for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = sorted(("HOT" if i % 3 == 0 else str(i // 4), 3000 - i) for i in range(3000))
    assert got == {k: at for at, k in enumerate(want, 11)}
    assert not [x for x in plan.split("\n") if "Exchange" in x and "n#" in x] and "Bucketed: true" in plan


def test_keys_in_groups_of_no_rows(spark):
    from starmart.operators import assign_keys_in_groups

    assert assign_keys_in_groups(spark.createDataFrame([], "o string, n int"), "o", ["n"], "sk").count() == 0
