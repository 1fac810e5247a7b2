"""Connected components of a table of links, by alternating star steps.

Each round hangs every node's larger neighbours under its smallest one
(large star), then its smaller neighbours too (small star), and writes what
is left. Links only get fewer and shorter; when a round changes nothing,
every link leads from a node to the smallest node of its component. Rounds
grow with the logarithm of the longest path. All state is in written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import stage

MAX_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written, so that the join below reads both sides straight from a
    # shuffle and adaptive execution can split a node with very many links.
    least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """``links(u, v)`` → ``(node, root)`` for every node with a link to another.

    ``root`` is the smallest node of the component. Repeated, reversed and
    self links are allowed, nulls are ignored; an empty table gives an empty
    one.
    """
    ends = links.where("u is not null and v is not null and u <> v")
    e = stage(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(e)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        e = stage(_small_star(_large_star(e)).distinct())
        last, mark = mark, _mark(e)
        if mark == last:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
