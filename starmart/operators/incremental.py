"""Insert-if-absent building blocks.

The source system writes "new members only" as ``LEFT JOIN … WHERE
right.key IS NULL`` and "skip existing" as ``NOT EXISTS`` / ``ON CONFLICT DO
NOTHING``. Catalyst does not rewrite the LEFT JOIN/IS NULL form into an
anti join, so it is written as one directly: a ``LeftAnti`` join streams the
candidates and only probes the existing keys (no columns of the target are
carried, nothing is materialised twice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def absent_from(candidates: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``candidates`` whose ``keys`` do not occur in ``existing``.

    NULL keys never match, so a candidate with a NULL key is kept — the
    same as the ``LEFT JOIN … IS NULL`` form it replaces.
    """
    keys = list(keys)
    return candidates.join(existing.select(*keys), on=keys, how="left_anti").select(*candidates.columns)


def present_in(children: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``children`` whose ``keys`` exist in ``parents`` (FK filter).

    Written as a semi join: no parent column is needed, and the parents'
    keys are unique, so it equals the inner join of the source SQL.
    """
    keys = list(keys)
    return children.join(parents.select(*keys), on=keys, how="left_semi").select(*children.columns)
