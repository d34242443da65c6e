"""Every registered query against its DuckDB twin, plus shape and count anchors."""

import pytest

import __spark_entry__ as E
from marginflow.plans.catalog import QUERIES as CATALOG
from tests.conftest import SF_CHECK, SF_SMALL
from tests.harness import compare, duck

# the training-data queries have tests of their own
QUERIES = dict(CATALOG)
SQL = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, con_small, name):
    r = compare(spark, con_small, name, QUERIES[name], SQL[name], SF_SMALL)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 46
    assert df.count() > 0


@pytest.mark.parametrize("name,ncols", [
    ("ol_unified_ad_metrics", 22), ("ol_client_projects_with_time", 17),
    ("ol_campaign_profitability", 36), ("bl_client_performance_dashboard", 46),
    ("bl_monthly_campaign_cohorts", 32), ("bl_resource_utilization", 29),
])
def test_model_widths(spark, name, ncols):
    assert len(QUERIES[name](spark, SF_SMALL).columns) == ncols


def test_fixture_anchors_sf001(spark):
    """Row counts stated for the sf0.01 fixture mapping."""
    q = lambda n: QUERIES[n](spark, SF_CHECK)
    assert q("ol_unified_ad_metrics").count() == 59981
    assert q("ol_client_projects_with_time").count() == 58964
    assert q("bl_client_performance_dashboard").count() == 14635
    assert q("bl_monthly_campaign_cohorts").count() == 58210
    assert q("bl_resource_utilization").count() == 59388
    assert q("client_social_pivot").count() == 1320  # grows with the tables
    # every row of the tables is used
    assert q("il_employees").count() == 100 and q("il_time_tracking").count() == 60000
    assert sum(r.violations for r in q("dq_violating_rows").collect()) == 2351  # orphan employees
    branches = {r[0]: r[1] for r in q("internal_cost_allocation").groupBy("allocation_branch").count().collect()}
    assert branches["daily"] == 44975
    assert branches["lifetime"] == 6105
    assert branches["no_cost"] == 5923
    assert branches["cost_day_without_spend"] == 2978


def test_allocation_invariants_sf001(spark):
    """Invariant 1: where a client-day has cost and positive spend, the
    allocated cost of all its rows (every campaign, platform and window)
    adds up to that day's cost."""
    from pyspark.sql import functions as F
    a = QUERIES["internal_cost_allocation"](spark, SF_CHECK)
    daily = (a.where((F.col("client_internal_cost_eur").isNotNull()) & (F.col("client_total_spend_eur") > 0))
             .groupBy("client_id", "report_date")
             .agg(F.sum("internal_cost_eur").alias("alloc"), F.first("client_internal_cost_eur").alias("cost")))
    bad = daily.where(F.abs(F.col("alloc") - F.col("cost")) > 1e-6 * F.greatest(F.lit(1.0), F.col("cost")))
    assert daily.count() > 0 and bad.count() == 0
    # Invariant 2: clients whose cost never meets a spend day get exactly their lifetime cost.
    per_client = a.groupBy("client_id").agg(
        F.sum(F.when(F.col("allocation_branch") == "daily", 1).otherwise(0)).alias("n_daily"),
        F.sum(F.when(F.col("allocation_branch") == "lifetime", 1).otherwise(0)).alias("n_life"),
        F.sum("internal_cost_eur").alias("alloc"),
        F.first("client_total_internal_cost_eur").alias("total"),
        F.sum(F.when(F.col("client_internal_cost_eur").isNotNull(), 1).otherwise(0)).alias("n_cost_days"))
    lifetime_only = per_client.where((F.col("n_daily") == 0) & (F.col("n_cost_days") == 0) & (F.col("n_life") > 0))
    bad2 = lifetime_only.where(F.abs(F.col("alloc") - F.col("total")) > 1e-6 * F.greatest(F.lit(1.0), F.col("total")))
    assert lifetime_only.count() > 0 and bad2.count() == 0


def test_fixture_anchors_sf0001(spark):
    """Row counts stated for the sf0.001 fixture mapping."""
    q = lambda n: QUERIES[n](spark, SF_SMALL)
    assert q("ol_unified_ad_metrics").count() == 5998
    assert q("ol_client_projects_with_time").count() == 5884
    assert q("bl_client_performance_dashboard").count() == 1461
    assert q("bl_monthly_campaign_cohorts").count() == 5817
    assert q("bl_resource_utilization").count() == 5508
    branches = {r[0]: r[1] for r in q("internal_cost_allocation").groupBy("allocation_branch").count().collect()}
    assert (branches["daily"], branches["lifetime"], branches["no_cost"],
            branches["cost_day_without_spend"]) == (4555, 505, 658, 280)
