"""Text helpers: report labels and SQL literal rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label(prefix: str, c: str | Column) -> Column:
    """``prefix || value`` (e.g. ``'item: ' || product_sk``)."""
    return F.concat(F.lit(prefix), _col(c).cast("string"))


def sql_literal(c: str | Column, dtype: T.DataType) -> Column:
    """Render a value as a SQL literal.

    NULL → ``NULL``; text, dates and timestamps are quoted with ``'`` doubled;
    booleans as ``True``/``False``; numbers as their plain text (decimals keep
    their scale).
    """
    c = _col(c)
    if isinstance(dtype, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        body = F.concat(F.lit("'"), F.replace(c.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    elif isinstance(dtype, T.BooleanType):
        body = F.when(c, F.lit("True")).otherwise(F.lit("False"))
    else:
        body = c.cast("string")
    return F.when(c.isNull(), F.lit("NULL")).otherwise(body)
