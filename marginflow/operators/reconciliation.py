"""Reconciliation of two aggregates that should agree per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str], expected_value: str, actual_value: str,
              tolerance: float = 1e-6) -> DataFrame:
    """(keys, expected, actual, difference, reconciled) per group of either side.

    Both sides hold one value per group (more are added up).  A group that only
    one side has is kept, with NULL on the other; NULL keys are groups of their
    own.  That is a null-safe full outer join, written as union and grouping:
    one shuffle, collapsed map-side, no hot key.  difference counts a missing
    side as 0; reconciled: both sides are there and differ by at most
    ``tolerance`` relative to the larger of 1 and the expected value.
    """
    null = F.lit(None).cast("double")
    both = (expected.select(*keys, F.col(expected_value).cast("double").alias("expected"), null.alias("actual"))
            .unionByName(actual.select(*keys, null.alias("expected"), F.col(actual_value).cast("double").alias("actual"))))
    sums = both.groupBy(*keys).agg(F.sum("expected").alias("expected"), F.sum("actual").alias("actual"))
    difference = F.coalesce("actual", F.lit(0.0)) - F.coalesce("expected", F.lit(0.0))
    return sums.withColumn("difference", difference).withColumn("reconciled", _near(tolerance))


def _near(tolerance: float) -> Column:
    bound = F.lit(tolerance) * F.greatest(F.lit(1.0), F.abs("expected"))
    return F.coalesce(F.abs("difference") <= bound, F.lit(False)) & F.col("expected").isNotNull() & F.col("actual").isNotNull()
