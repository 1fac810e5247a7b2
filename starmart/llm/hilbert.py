"""Shards along a Hilbert curve over metadata, for multidimensional file pruning.

Each dimension is quantised to ``2 ** bits`` cells at its quantiles, the cells
of a row give its index on the Hilbert curve, rows are ranked by that index,
and the ranks are cut in runs of equal length (counts differ by one at most).
Rows that are near in all dimensions share a shard, so a shard's range in each
dimension is narrow: ``manifest`` keeps the ranges and ``matching`` names the
shards that a query on any of the dimensions has to read.

Defined results: nulls are the lowest cell of a dimension (a null text has no
bytes and size 1); equal rows take neighbouring places; an empty table gives
an empty table; columns of the input are carried along except those with the
names that are added.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import quantiles, ranked, stage

BITS = 6


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """``cells``: (rows, dimensions) under ``2 ** bits`` → place on the curve.

    Skilling's transform (AIP Conf. Proc. 707, 2004), a column at a time.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations, highest bit first
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where(x[-1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = out << 1 | (x[i] >> b & 1)
    return out


def text_key(name: str) -> Column:
    """A number that orders strings by their first seven bytes; null for null."""
    head = F.substring(F.col(name).cast("binary"), 1, 7)
    return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("long")


def with_text_rank(df: DataFrame, name: str, rank: str) -> DataFrame:
    """Add ``rank``: the place of the string among the column's distinct ones, by all its bytes; null for null."""
    value = F.col(name).cast("string").alias("__value")
    distinct = stage(df.select(value).where(F.col("__value").isNotNull()).distinct())
    places = stage(ranked(distinct, [F.col("__value")], rank))
    # Few distinct strings are broadcast by their size on disk; many are shuffled, a hot one split by AQE.
    return df.join(places, F.col(name).cast("string") == F.col("__value"), "left").drop("__value")


def with_curve_index(df: DataFrame, dims: Sequence[Column], bits: int = BITS) -> DataFrame:
    """Add ``hilbert``. ``dims``: numbers. ``2 ** bits - 1`` quantiles of each are collected."""
    if len(dims) * bits > 62:
        raise ValueError("dimensions times bits must be at most 62")
    keys = [f"__dim_{i}" for i in range(len(dims))]
    numbered = df.withColumns({k: d.cast("double") for k, d in zip(keys, dims)})
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = [np.unique(np.array(c, float)) for c in quantiles(numbered.select(keys), keys, share).values()]

    @F.pandas_udf("long")
    def index(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for cols in parts:
            cells = [np.searchsorted(c, col.to_numpy(float, na_value=-np.inf), "right") for c, col in zip(cuts, cols)]
            yield pd.Series(hilbert_index(np.stack(cells, axis=1), bits))

    return numbered.withColumn("hilbert", index(*keys)).drop(*keys)


def shard_rows(
    df: DataFrame, dims: Sequence[Column], shards: int = 16, then: Sequence[Column] = (), bits: int = BITS
) -> DataFrame:
    """Add ``hilbert``, ``shard`` (0 to ``shards - 1``) and ``slot`` (from 0 in its shard).

    Ranks come from range partitions, so no task and no driver sees all rows;
    ``then`` orders rows of one index.
    """
    rank, total = "__curve_rank", "__curve_rows"
    placed = ranked(with_curve_index(df, dims, bits), [F.col("hilbert"), *then], rank, total)
    shard = F.expr(f"cast({rank} * {shards} div {total} as int)")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col(rank) - first).drop(rank, total)


def write_sharded(sharded: DataFrame, path: str) -> None:
    """One folder a shard, rows in curve order inside it."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def manifest(sharded: DataFrame, names: Sequence[str]) -> DataFrame:
    """A row for each shard: its rows and the range of each named column."""
    ends = [f(n).alias(f"{k}_{n}") for n in names for k, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *ends)


def matching(ranges: DataFrame, **wanted: tuple) -> DataFrame:
    """Shards whose ranges meet ``column=(low, high)`` for every column given."""
    for name, (low, high) in wanted.items():
        ranges = ranges.where((F.col(f"min_{name}") <= F.lit(high)) & (F.col(f"max_{name}") >= F.lit(low)))
    return ranges.select("shard")
