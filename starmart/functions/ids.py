"""Identifier normalisation and NOT NULL enforcement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_id(c: str | Column) -> Column:
    """Text id with every hyphen removed, so ``abc-123`` equals ``abc123``.

    NULL stays NULL.
    """
    return F.replace(_col(c).cast("string"), F.lit("-"), F.lit(""))


def required(c: str | Column, what: str) -> Column:
    """The value itself, but the job fails when it is NULL.

    This is how a primary-key / NOT NULL column behaves on insert: one
    offending row aborts the whole load instead of being silently kept.
    """
    c = _col(c)
    return F.when(c.isNull(), F.raise_error(F.lit(f"NULL value in NOT NULL column {what}"))).otherwise(c)
