"""Analyst queries over the business layer (sanity reports, top-k, trends).

Sums of already-rounded money or hour columns are taken in DECIMAL(18,2)
and converted back to double: the inputs have two decimals, so the decimal
sum is exact and its double is the same whatever order executors add in.
Top-k queries order by the metric and then by the grain keys, so a limit
always selects the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.functions.numeric import r2, r4
from marginflow.plans.business import (MONTHLY_ORDER, client_performance_dashboard,
                                       monthly_campaign_cohorts, resource_utilization)
from marginflow.plans.context import Workspace

# --- fixed values: defaults of the parameterised reports ----------------------
TREND_CLIENT = "1"
CANDIDATE_WINDOW = "7d_click"
CANDIDATE_MIN_SPEND = 5000.0
TOP_REVENUE_CLIENTS = 10
TOP_PROFIT_ROWS = 20
FIRST_MONTHLY_ROWS = 50
CANDIDATE_ROWS = 10
# ------------------------------------------------------------------------------

DASHBOARD_GRAIN = ["client_id", "platform", "attribution_window"]


def money_sum(c: str) -> Column:
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def _asc(cols):
    return [F.asc_nulls_last(c) for c in cols]


def _dash(ws):
    return client_performance_dashboard(ws)


def _monthly(ws):
    return monthly_campaign_cohorts(ws, ordered=False)


def _util(ws):
    return resource_utilization(ws)


# -- dashboard ----------------------------------------------------------------

def grain_coverage(ws: Workspace) -> DataFrame:
    return (_dash(ws).groupBy("client_id", "client_name", "platform", "attribution_window")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 money_sum("total_ad_spend_eur").alias("total_ad_spend_eur"),
                 money_sum("total_revenue_eur").alias("total_revenue_eur"))
            .orderBy(*_asc(DASHBOARD_GRAIN)))


def top_revenue_clients(ws: Workspace, k: int = TOP_REVENUE_CLIENTS) -> DataFrame:
    g = (_dash(ws).groupBy("client_id", "client_name")
         .agg(money_sum("total_revenue_eur").alias("total_revenue_eur"),
              money_sum("total_ad_spend_eur").alias("total_ad_spend_eur")))
    g = g.withColumn("blended_roas",
                     r2(F.col("total_revenue_eur") / F.nullif(F.col("total_ad_spend_eur"), F.lit(0.0))))
    return g.orderBy(F.desc_nulls_last("total_revenue_eur"), *_asc(["client_id", "client_name"])).limit(k)


def top_profit_rows(ws: Workspace, k: int = TOP_PROFIT_ROWS) -> DataFrame:
    return (_dash(ws).select("client_id", "client_name", "platform", "attribution_window",
                             "media_only_total_cost_eur", "media_only_profit_eur",
                             "media_only_margin_on_revenue")
            .orderBy(F.desc_nulls_last("media_only_profit_eur"), *_asc(DASHBOARD_GRAIN)).limit(k))


def dashboard_negative(ws: Workspace) -> DataFrame:
    return _dash(ws).where((F.col("total_ad_spend_eur") < 0) | (F.col("total_revenue_eur") < 0))


def dashboard_missing_dims(ws: Workspace) -> DataFrame:
    return _dash(ws).where(F.col("platform").isNull() | F.col("attribution_window").isNull())


def optimization_candidates(ws: Workspace, window: str = CANDIDATE_WINDOW,
                            min_spend: float = CANDIDATE_MIN_SPEND, k: int = CANDIDATE_ROWS) -> DataFrame:
    """High spend, lowest return first: one attribution window, spend above a threshold."""
    return (_dash(ws).where((F.col("attribution_window") == window)
                            & (F.col("total_ad_spend_eur") > min_spend))
            .select("client_id", "client_name", "platform", "attribution_window",
                    "total_ad_spend_eur", "blended_roas", "blended_cpa_eur")
            .orderBy(F.asc_nulls_last("blended_roas"), *_asc(["client_id", "platform"])).limit(k))


# -- monthly ------------------------------------------------------------------

def monthly_coverage(ws: Workspace, k: int = FIRST_MONTHLY_ROWS) -> DataFrame:
    return (_monthly(ws).select("cohort_month", "client_id", "client_name", "platform",
                                "attribution_window", "num_campaigns", "monthly_ad_spend_eur",
                                "monthly_revenue_eur")
            .orderBy(*_asc(MONTHLY_ORDER)).limit(k))


def client_trend(ws: Workspace, client_id: str = TREND_CLIENT) -> DataFrame:
    return (_monthly(ws).where(F.col("client_id") == client_id)
            .select("cohort_month", "client_id", "client_name", "platform", "attribution_window",
                    "num_campaigns", "monthly_ad_spend_eur", "monthly_revenue_eur")
            .orderBy(*_asc(["cohort_month", "platform", "attribution_window"])))


def resource_consistency(ws: Workspace) -> DataFrame:
    """Month x client: internal cost vs media-only profit vs net profit."""
    return (_monthly(ws).groupBy("cohort_month", "client_id", "client_name")
            .agg(money_sum("monthly_internal_cost_eur").alias("internal_cost_eur"),
                 money_sum("media_only_profit_eur").alias("media_only_profit_eur"),
                 money_sum("monthly_net_profit_after_internal_eur").alias("net_profit_after_internal_eur"))
            .orderBy(*_asc(["cohort_month", "client_id"])))


def monthly_margins(ws: Workspace, k: int = FIRST_MONTHLY_ROWS) -> DataFrame:
    return (_monthly(ws).select("cohort_month", "client_id", "client_name", "platform",
                                "attribution_window", "monthly_media_only_margin_on_revenue",
                                "monthly_media_only_margin_on_cost")
            .orderBy(*_asc(MONTHLY_ORDER)).limit(k))


def monthly_negative(ws: Workspace) -> DataFrame:
    return _monthly(ws).where((F.col("monthly_ad_spend_eur") < 0) | (F.col("monthly_revenue_eur") < 0)
                              | (F.col("media_only_profit_eur") < 0))


def monthly_missing_keys(ws: Workspace) -> DataFrame:
    return _monthly(ws).where(F.col("platform").isNull() | F.col("attribution_window").isNull()
                              | F.col("cohort_month").isNull())


def monthly_duplicate_grain(ws: Workspace) -> DataFrame:
    return (_monthly(ws).groupBy("client_id", "platform", "attribution_window", "cohort_month")
            .agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1))


# -- utilisation --------------------------------------------------------------

def employee_utilization(ws: Workspace) -> DataFrame:
    g = (_util(ws).groupBy("employee_id", "employee_name", "department_name")
         .agg(money_sum("total_hours").alias("total_hours"),
              money_sum("billable_hours").alias("billable_hours")))
    g = g.withColumn("utilization_rate_billable_hours",
                     r4(F.col("billable_hours") / F.nullif(F.col("total_hours"), F.lit(0.0))))
    return g.orderBy(F.desc_nulls_last("utilization_rate_billable_hours"),
                     *_asc(["employee_id", "employee_name", "department_name"]))


def client_internal_cost(ws: Workspace) -> DataFrame:
    return (_util(ws).groupBy("client_id", "client_name")
            .agg(money_sum("total_hours").alias("total_hours"),
                 money_sum("total_cost_eur").alias("total_internal_cost_eur"))
            .orderBy(F.desc_nulls_last("total_internal_cost_eur")))


def department_cost(ws: Workspace) -> DataFrame:
    return (_util(ws).groupBy("department_name")
            .agg(money_sum("total_hours").alias("total_hours"),
                 money_sum("total_cost_eur").alias("total_internal_cost_eur"))
            .orderBy(F.desc_nulls_last("total_internal_cost_eur")))


def utilization_negative(ws: Workspace) -> DataFrame:
    return _util(ws).where((F.col("total_hours") < 0) | (F.col("total_cost_eur") < 0))


def utilization_not_one(ws: Workspace) -> DataFrame:
    """Rows with billable share of hours different from 1 (NULL rates excluded)."""
    return _util(ws).where(F.col("utilization_rate_billable_hours") != 1)


def utilization_missing_ids(ws: Workspace) -> DataFrame:
    return _util(ws).where(F.col("employee_id").isNull() | F.col("client_id").isNull())
