"""Two-tier proportional cost allocation.

Distributes a cost that is known per (entity, day) over fact rows of that
entity and day by their share of a weight (e.g. media spend); where the day
has no cost at all, the entity's lifetime cost is spread by lifetime weight
share instead.

Plan shape (no window function, so no entity is ever gathered in one task):

* weight and cost arrive pre-aggregated to (entity, day) (map-side partial
  aggregation); the lifetime totals roll the same relations up, and because
  the day is compared null-safely, no filter tells the two uses apart: Spark
  reuses one exchange for both;
* the totals are joined to the daily rows (one row per entity and day), then
  facts LEFT JOIN daily on (entity, day): the facts are dealt out once, by a
  key that spreads a hot entity over its days; a sort-merge join whose skewed
  partitions AQE splits, or a broadcast when AQE measures ``daily`` small.

Equi-joins never match NULL keys: a fact row with a NULL day gets no day
values (lifetime tier only) and a NULL entity gets nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AllocationColumns:
    day_cost: str = "client_internal_cost_eur"
    day_weight: str = "client_total_spend_eur"
    total_cost: str = "client_total_internal_cost_eur"
    total_weight: str = "client_lifetime_spend_eur"
    day_share: str = "spend_share_in_client_day"
    allocated: str = "internal_cost_eur"


def daily_sum(df: DataFrame, entity: str, day: str, value: str, alias: str) -> DataFrame:
    """(entity, day, sum(value)): partial aggregation map-side, so a hot
    entity or day is collapsed before the shuffle."""
    return df.groupBy(entity, day).agg(F.sum(value).alias(alias))


def roll_up(daily: DataFrame, entity: str, value: str, alias: str) -> DataFrame:
    """Entity totals from a daily aggregate (NULL days included).  Built on
    the daily relation, so both share its exchange instead of re-reading
    the facts."""
    return daily.groupBy(entity).agg(F.sum(value).alias(alias))


def allocate_two_tier(facts: DataFrame, day_weight: DataFrame, day_cost: DataFrame, *,
                      entity: str = "client_id", day: str = "report_date",
                      weight: str = "ad_spend_eur",
                      cols: AllocationColumns = AllocationColumns(), co_located: bool = False) -> DataFrame:
    """Allocate ``day_cost`` over ``facts`` by ``weight``.

    ``day_weight``: (entity, day, cols.day_weight), the facts' weight summed
    per entity and day; ``day_cost``: (entity, day, cols.day_cost).

    ``co_located``: the facts, and what weight and cost are summed from, are
    dealt out by (entity, day) already (tables bucketed by both).  Days are then
    compared by plain equality, so the facts need no exchange; facts without a
    day, which only have the totals, are joined to them on their own.
    """
    total_weight = roll_up(day_weight, entity, cols.day_weight, cols.total_weight)
    total_cost = roll_up(day_cost, entity, cols.day_cost, cols.total_cost)
    totals = (total_weight.join(total_cost, entity, "left")
              .select(F.col(entity).alias("_all"), cols.total_weight, cols.total_cost))
    same = (lambda a, b: F.col(a) == F.col(b)) if co_located else (lambda a, b: F.col(a).eqNullSafe(F.col(b)))
    # the totals travel with the daily rows (a NULL day has one, too), so the
    # facts meet both tiers in one join
    cost = day_cost.select(F.col(entity).alias("_entity"), F.col(day).alias("_day"), cols.day_cost)
    daily = (day_weight.join(cost, (F.col(entity) == F.col("_entity")) & same(day, "_day"), "left")
             .join(totals, F.col(entity) == F.col("_all"), "left")
             .select(F.col(entity).alias("_of"), F.col(day).alias("_on"),
                     *[F.when(F.col(day).isNotNull(), F.col(c)).alias(c) for c in (cols.day_weight, cols.day_cost)],
                     cols.total_weight, cols.total_cost))
    met = (F.col(entity) == F.col("_of")) & same(day, "_on")
    if co_located:
        undated = facts.where(F.col(day).isNull()).join(totals, F.col(entity) == F.col("_all"), "left").drop("_all")
        none = {c: F.lit(None).cast(daily.schema[c].dataType) for c in (cols.day_weight, cols.day_cost)}
        joined = (facts.where(F.col(day).isNotNull()).join(daily, met, "left").drop("_of", "_on")
                  .unionByName(undated.withColumns(none)))
    else:
        joined = facts.join(daily, met, "left").drop("_of", "_on")

    w = F.col(weight)
    share = F.when(F.col(cols.day_weight) > 0, w / F.col(cols.day_weight))
    joined = joined.withColumn(cols.day_share, share)
    allocated = (
        F.when(F.col(cols.day_cost).isNotNull() & F.col(cols.day_share).isNotNull(),
               F.col(cols.day_cost) * F.col(cols.day_share))
        .when(F.col(cols.day_cost).isNull() & F.col(cols.total_cost).isNotNull()
              & (F.col(cols.total_weight) > 0),
              F.col(cols.total_cost) * (w / F.col(cols.total_weight))))
    return joined.withColumn(cols.allocated, allocated)


def allocation_branch(cols: AllocationColumns = AllocationColumns()):
    """Label of the tier that produced each allocated value."""
    day_cost, share = F.col(cols.day_cost), F.col(cols.day_share)
    return (F.when(day_cost.isNotNull() & share.isNotNull(), F.lit("daily"))
            .when(day_cost.isNull() & F.col(cols.total_cost).isNotNull()
                  & (F.col(cols.total_weight) > 0), F.lit("lifetime"))
            .when(F.col(cols.total_cost).isNull(), F.lit("no_cost"))
            .when(day_cost.isNotNull(), F.lit("cost_day_without_spend"))
            .otherwise(F.lit("no_spend")))
