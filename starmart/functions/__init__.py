"""Column-expression helpers (all built-in, JVM-side, codegen-friendly)."""

from starmart.functions.ids import clean_id, required
from starmart.functions.dates import (
    elapsed_days,
    first_of_month,
    iso_day_of_week,
    make_period,
    parse_timestamp,
    try_parse_timestamp,
    iso_week,
    month_index,
    months_between_starts,
    year_month,
)
from starmart.functions.text import label, sql_literal

__all__ = [
    "clean_id",
    "required",
    "elapsed_days",
    "first_of_month",
    "iso_day_of_week",
    "make_period",
    "parse_timestamp",
    "try_parse_timestamp",
    "iso_week",
    "month_index",
    "months_between_starts",
    "year_month",
    "label",
    "sql_literal",
]
