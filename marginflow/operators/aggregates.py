"""Aggregate-expression helpers with explicit NULL semantics.

``sum_if`` adds 0 for non-matching rows (result 0 when nothing matches),
``max_if`` ignores them (NULL when nothing matches); a NULL condition counts
as not matching in both.  All are built-in aggregates, so
Spark plans a partial (map-side) aggregate before every shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marginflow.functions.numeric import _col


def sum_if(cond: Column, value) -> Column:
    return F.sum(F.when(cond, _col(value)).otherwise(F.lit(0)))


def max_if(cond: Column, value) -> Column:
    return F.max(F.when(cond, _col(value)))


def month_start(c) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(_col(c).cast("date"), "month")
