"""Surrogate keys: dense, increasing, retry-stable, without one global task.

``assign_surrogate_keys(df, order, "x_sk", start)`` numbers the rows
``start, start+1, …`` in the total order ``order`` — the same numbers as
``start - 1 + row_number() OVER (ORDER BY order)`` — and takes one way at
every size:

1. The rows are range-partitioned on the order key into as many partitions
   as the session shuffles into, and each partition is sorted.
2. (partition, position) is written once to the shared checkpoint folder.
   Writing fixes the sampled range bounds: the counts and the numbering below
   read the same rows, whatever a later re-execution would have sampled. Within
   that job, a retried task sorts the same rows by a unique key, so it
   reproduces the same positions.
3. The rows of each partition (one number for each shuffle partition, a bound
   that the session sets and the data doesn't move) give running offsets;
   ``sk = start + offset + position``.

The order key must be unique (it is, for every caller: ids, or the item key).
Calling it runs the job that writes the positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LOW_33_BITS = (1 << 33) - 1


def assign_surrogate_keys(
    df: DataFrame, order: Sequence[str], sk_col: str, start: int = 1, partitions: int | None = None
) -> DataFrame:
    """Add ``sk_col`` = start + (0-based rank of the row under ``order``)."""
    from starmart.session import stage_rows

    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    p, pos, off = "__sk_part", "__sk_pos", "__sk_offset"
    placed = stage_rows(
        df.repartitionByRange(parts, *[F.col(c).asc() for c in order])
        .sortWithinPartitions(*order)
        .withColumn(p, F.spark_partition_id())
        .withColumn(pos, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_33_BITS)))
    )
    offsets, before = [], 0
    for part, rows in sorted(tuple(r) for r in placed.groupBy(p).agg(F.count(F.lit(1))).collect()):
        offsets.append((part, before))
        before += rows
    starts = spark.createDataFrame(offsets, f"{p} int, {off} long")
    # At most one row for each shuffle partition.
    numbered = placed.join(F.broadcast(starts), p)
    return numbered.withColumn(sk_col, F.lit(start) + F.col(off) + F.col(pos)).select(*df.columns, sk_col)


def assign_keys_in_groups(
    df: DataFrame, group: str, order: Sequence[str], sk_col: str, start: int = 1, partitions: int | None = None
) -> DataFrame:
    """Add ``sk_col`` = start + (0-based rank of the row under ``group``, ``order``), moving groups, not rows.

    Only the size of each group is placed by range: a group's first number is
    the running sum of the sizes before it, and a row's is its position in the
    group after that. Rows that lie together by ``group``, as a bucketed table's
    do, stay where they are. ``df`` is read twice: pass written rows.
    """
    from starmart.session import stage_rows

    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    p, pos, off, n = "__sk_part", "__sk_pos", "__sk_offset", "__sk_rows"
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias(n))
    placed = stage_rows(sizes.repartitionByRange(parts, F.col(group).asc()).withColumn(p, F.spark_partition_id()))
    offsets, before = [], 0
    for part, rows in sorted(tuple(r) for r in placed.groupBy(p).agg(F.sum(n)).collect()):
        offsets.append((part, before))
        before += rows
    starts = F.broadcast(spark.createDataFrame(offsets, f"{p} int, {off} long"))  # a row for each partition at most
    within = Window.partitionBy(p).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.withColumn(pos, F.coalesce(F.sum(n).over(within), F.lit(0))).join(starts, p)
    firsts = firsts.select(group, (F.col(off) + F.col(pos)).alias(off))
    # Numbered first: the order of the groups serves the join too.
    numbered = df.withColumn(pos, F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    keyed = numbered.join(firsts.hint("merge"), group)
    return keyed.select(*df.columns, (F.lit(start - 1) + F.col(off) + F.col(pos)).alias(sk_col))


def next_key(existing: DataFrame, sk_col: str) -> int:
    """max(existing key) + 1, or 1 for an empty table (one-row aggregate)."""
    top = existing.agg(F.max(sk_col)).first()[0]
    return 1 if top is None else int(top) + 1
