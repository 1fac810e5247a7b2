"""A key holding a third of all rows: results stay whole, plans cut it early."""

from pyspark.sql import functions as F

from starmart.operators import distinct_on


def test_hot_key_dedup(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.lit(n) - F.col("id")).alias("v"),
    )
    out = distinct_on(df, ["k"], ["v"])
    rows = {r.k: r.v for r in out.collect()}
    assert len(rows) == 1 + (n - n // 3)
    assert rows["HOT"] == min(n - i for i in range(0, n, 3))
    p = out._jdf.queryExecution().executedPlan().toString()
    # the hot key is cut to one row per map task before the exchange
    assert p.index("Partial") > p.index("Exchange")
