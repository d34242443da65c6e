"""Lookup joins.

No side is hinted: Spark broadcasts a side whose size it knows from file
statistics or has measured (AQE) to be under
``spark.sql.autoBroadcastJoinThreshold``, and AQE splits hot keys of the
sort-merge joins otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parts over which rows without a key are dealt.
NULL_PARTS = 1024


def spread_nulls(fact: DataFrame, lookup: DataFrame, key: str, by: list[str],
                 deal: Callable[[DataFrame, str], DataFrame] = lambda df, key: df) -> DataFrame:
    """Left join of ``lookup`` (string ``key``) that deals the fact rows with a
    NULL key by a hash of the columns ``by``: as one join key they would all
    meet in one task.  They match nothing, as before.  ``deal`` may store the
    rows by the key of the join."""
    part = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*by), F.lit(NULL_PARTS)).cast("string"))
    other = lookup.withColumnRenamed(key, "_lookup_key")
    dealt = deal(fact.withColumn("_fact_key", F.coalesce(F.col(key), part)), "_fact_key")
    return dealt.join(other, F.col("_fact_key") == F.col("_lookup_key"), "left").drop("_fact_key", "_lookup_key")
