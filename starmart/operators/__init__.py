"""Operators Spark has no single built-in for, composed from built-ins."""

from starmart.operators.dedup import distinct_on, first_by_key
from starmart.operators.incremental import absent_from, present_in
from starmart.operators.series import day_series
from starmart.operators.surrogate import assign_keys_in_groups, assign_surrogate_keys, next_key

__all__ = [
    "distinct_on",
    "first_by_key",
    "absent_from",
    "present_in",
    "day_series",
    "assign_keys_in_groups",
    "assign_surrogate_keys",
    "next_key",
]
