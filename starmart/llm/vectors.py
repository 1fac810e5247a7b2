"""Rows of embeddings that take part: whole, finite and of one length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finite(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite entries."""
    inf = F.lit(float("inf"))
    whole = F.forall(vector, lambda e: e.isNotNull() & (F.abs(e.cast("double")) < inf))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & whole, F.lit(False))


def usable(df: DataFrame, id_col: str, vector_col: str, nonzero: bool = False) -> tuple[DataFrame, int]:
    """``(vec_id, vector)`` of the rows that take part, and their dimension.

    Vectors of one table have one length. Where they differ, the most frequent
    length stands (of equally frequent ones the greater) and the others are
    left out. The dimension of a table without such rows is 0. Entries stay
    what they are, float or double; whole numbers become double.
    """
    kind = df.schema[vector_col].dataType
    entry = kind.elementType if isinstance(kind, T.ArrayType) else None
    vector = F.col(vector_col)
    if not isinstance(entry, (T.FloatType, T.DoubleType)):
        vector = vector.cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(finite(F.col("vector")))
    if nonzero:
        rows = rows.where(F.exists("vector", lambda e: e != 0))
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    dim = top[0]["d"] if top else 0
    return rows.where(F.size("vector") == dim), dim


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A column of lists of ``dim`` entries as rows of a matrix."""
    return np.asarray(column.flatten()).reshape(-1, dim)
