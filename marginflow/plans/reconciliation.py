"""The allocation's invariants as contracts: what a tier should give out
against what its rows received.

* ``daily``: a client-day with cost and spend gives out exactly its cost, over
  all campaigns, platforms and windows (must reconcile);
* ``lifetime``: a client whose cost days never meet a spend day, and that has
  lifetime spend, gives out exactly its lifetime cost (must reconcile);
* ``mixed``: a client with both kinds of rows gives out its day costs and, over
  the days without cost, shares of the whole lifetime cost again: known not to
  reconcile, the difference is reported;
* ``unmet``: a client-day with cost, without any ad row, of a client that has no
  fallback rows: nobody can receive its cost, which is reported;
* ``withheld``: a client-day with cost but without positive spend gives out
  nothing, also not by the lifetime tier (expected 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.functions.numeric import round_half_away
from marginflow.operators.reconciliation import reconcile
from marginflow.plans.context import Workspace
from marginflow.plans.operational import (ALLOC, client_day_ad_spend, client_day_internal_cost,
                                          internal_cost_allocation)

MUST_RECONCILE = ("daily", "lifetime", "withheld")
# Digits of the reported sums: fewer than what the order of addition may change.
DIGITS = 4


def _expected(ws: Workspace) -> DataFrame:
    """What each tier should give out, from the daily aggregates alone."""
    cost, weight = F.col(ALLOC.day_cost), F.col(ALLOC.day_weight)
    spend = client_day_ad_spend(ws).select(F.col("client_id").alias("_of"), F.col("report_date").alias("_on"), ALLOC.day_weight)
    costs = client_day_internal_cost(ws).where("client_id IS NOT NULL")
    # a day meets a day: without a date, cost and spend are the lifetime's alone
    met = costs.join(spend, (F.col("client_id") == F.col("_of")) & (F.col("report_date") == F.col("_on")), "left")
    paid = cost.isNotNull() & (weight > 0)
    daily = met.where(paid).select(F.lit("daily").alias("tier"), "client_id", "report_date", cost.alias("cost"))
    withheld = (met.where(cost.isNotNull() & F.col("_of").isNotNull() & ~F.coalesce(weight > 0, F.lit(False)))
                .select(F.lit("withheld").alias("tier"), "client_id", "report_date", F.lit(0.0).alias("cost")))
    clients = (met.groupBy("client_id").agg(F.sum(cost).alias("cost"), F.max(F.col("_of").isNotNull() & cost.isNotNull()).alias("meets"))
               .where(F.col("cost").isNotNull()))
    # a client has fallback rows if any of its spend days has no cost
    spent = (client_day_ad_spend(ws).where("client_id IS NOT NULL").join(
        client_day_internal_cost(ws).where(cost.isNotNull()).select(F.col("client_id").alias("_of"), F.col("report_date").alias("_on")),
        (F.col("client_id") == F.col("_of")) & (F.col("report_date") == F.col("_on")), "left")
        .groupBy("client_id").agg(F.sum(weight).alias("spend"), F.max(F.col("_of").isNull()).alias("free")))
    fallback = clients.join(spent.where((F.col("spend") > 0) & F.col("free")), "client_id")
    lifetime = fallback.select(F.when(F.col("meets"), F.lit("mixed")).otherwise(F.lit("lifetime")).alias("tier"), "client_id",
                               F.lit(None).cast("date").alias("report_date"), "cost")
    unmet = (met.where(F.col("_of").isNull() & cost.isNotNull()).join(fallback.select("client_id"), "client_id", "left_anti")
             .select(F.lit("unmet").alias("tier"), "client_id", "report_date", cost.alias("cost")))
    return daily.unionByName(withheld).unionByName(lifetime).unionByName(unmet)


def _actual(ws: Workspace) -> DataFrame:
    """What the rows of the model received, by the tier of their client."""
    rows = internal_cost_allocation(ws).select("client_id", "report_date", ALLOC.allocated, "allocation_branch")
    branch = F.col("allocation_branch")
    by_day = (rows.where("client_id IS NOT NULL").groupBy("client_id", "report_date")
              .agg(F.sum(ALLOC.allocated).alias("received"), F.max(branch == "daily").alias("daily"),
                   F.max(branch == "lifetime").alias("lifetime"),
                   F.max(branch == "cost_day_without_spend").alias("withheld")))
    daily = by_day.where("daily").select(F.lit("daily").alias("tier"), "client_id", "report_date", "received")
    withheld = by_day.where("withheld").select(F.lit("withheld").alias("tier"), "client_id", "report_date",
                                               F.coalesce("received", F.lit(0.0)).alias("received"))
    clients = (by_day.groupBy("client_id").agg(F.sum("received").alias("received"), F.max("lifetime").alias("lifetime"),
                                               F.max(F.col("daily") | F.col("withheld")).alias("meets"))
               .where("lifetime"))
    per_client = clients.select(F.when(F.col("meets"), F.lit("mixed")).otherwise(F.lit("lifetime")).alias("tier"), "client_id",
                                F.lit(None).cast("date").alias("report_date"), "received")
    return daily.unionByName(withheld).unionByName(per_client)


def allocation_reconciliation(ws: Workspace, tolerance: float = 1e-6) -> DataFrame:
    """(tier, client_id, report_date, expected_cost_eur, allocated_cost_eur,
    difference_eur, reconciled, violation) per client-day (daily, withheld,
    unmet) or client (lifetime, mixed; report_date NULL).  violation: a tier that must
    reconcile does not."""
    found = reconcile(_expected(ws), _actual(ws), ["tier", "client_id", "report_date"], "cost", "received", tolerance)
    return found.select("tier", "client_id", "report_date",
                        round_half_away("expected", DIGITS).alias("expected_cost_eur"),
                        round_half_away("actual", DIGITS).alias("allocated_cost_eur"),
                        # of a reconciled group the difference is rounding noise
                        F.when(F.col("reconciled"), F.lit(0.0)).otherwise(round_half_away("difference", DIGITS)).alias("difference_eur"),
                        "reconciled", (F.col("tier").isin(*MUST_RECONCILE) & ~F.col("reconciled")).alias("violation"))
