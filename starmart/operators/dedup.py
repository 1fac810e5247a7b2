"""DISTINCT ON: keep the first row of every key under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (ascending, NULLs first), which names all other columns.

    An aggregate, so each map task sends one row for a key however many
    copies it has read, and joins on part of the key can follow it.
    """
    first = F.min(F.struct(*order)).alias("__first")
    picked = df.groupBy(*keys).agg(first)
    return picked.select(*[F.col(c) if c in keys else F.col(f"__first.{c}").alias(c) for c in df.columns])


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per ``keys``: the first under ``order`` (ascending, NULLs first).

    ``order`` defaults to every non-key column, which makes the pick
    repeatable: the source system leaves it arbitrary.

    Planned as ``row_number() = 1``; Catalyst turns that into a
    WindowGroupLimit that also runs *before* the shuffle, so a key with a
    huge number of copies is cut to one row per map task before it is sent
    anywhere (a hot key cannot pile up in one reducer).
    """
    keys = list(keys)
    if order is None:
        order = [c for c in df.columns if c not in keys]
    order_cols = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    if not order_cols:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    rn = "__distinct_on_rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)
