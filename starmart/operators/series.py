"""Inclusive day series between two dates (``generate_series`` by one day)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_series(bounds: DataFrame, lo: str | Column, hi: str | Column, name: str = "full_date") -> DataFrame:
    """Every day from ``lo`` to ``hi`` (both included), one row each.

    ``bounds`` is a one-row frame (for example a global min/max aggregate).
    NULL bounds give no rows. The output size is the calendar span, not the
    data volume.
    """
    lo = F.col(lo) if isinstance(lo, str) else lo
    hi = F.col(hi) if isinstance(hi, str) else hi
    days = F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(F.when(lo <= hi, days)).alias(name))
