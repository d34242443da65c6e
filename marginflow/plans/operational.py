"""Operational layer: unified ad metrics, client time, campaign profitability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.functions.numeric import r2, ratio
from marginflow.operators.aggregates import sum_if
from marginflow.operators.allocation import (AllocationColumns, allocate_two_tier, allocation_branch,
                                             daily_sum, roll_up)
from marginflow.operators.joins import spread_nulls
from marginflow.plans.context import Workspace

UNIFIED_KEYS = ["client_id", "client_name", "primary_industry", "country", "campaign_id",
                "campaign_name", "platform", "report_date", "attribution_window",
                "campaign_status", "daily_budget_eur"]
AD_VOLUMES = ["spend_eur", "impressions", "clicks", "conversions", "revenue_eur"]
KPI_COLUMNS = ["cpm_calc", "ctr_calc", "cvr_calc", "cpc_calc", "cpa_calc", "roas_calc"]

TIME_KEYS = ["client_id", "client_name", "primary_industry", "country", "project_id",
             "project_name", "project_start_date", "project_end_date", "monthly_budget_eur",
             "report_date"]

PROFIT_GRAIN = ["client_id", "campaign_id", "platform", "report_date", "attribution_window"]


def client_lookup(ws: Workspace) -> DataFrame:
    return ws.cl("clients").select("client_id", "client_name", "primary_industry", "country")


def unified_sums(ws: Workspace) -> DataFrame:
    """The summed volumes of the unified ad metrics (their KPIs follow from them)."""
    def build():
        facts = ws.cl("ad_metrics").select("campaign_id", "client_id", "report_date",
                                           "attribution_window", *AD_VOLUMES)
        campaigns = ws.cl("campaigns").select("campaign_id", "campaign_name", "platform",
                                              "campaign_status", "daily_budget_eur")
        if ws.dealing:
            # The facts come dealt out by campaign and are stored by client: one
            # dealing between, and a task that stores sums has few buckets.
            base = ws.dealt(facts.join(campaigns, "campaign_id", "left"), "client_id", "ad-facts")
            base = base.join(client_lookup(ws), "client_id", "left")
        else:
            # Campaigns last: the aggregate below then finds the rows dealt out by
            # campaign_id, not by client_id, which a few clients dominate.
            base = facts.join(client_lookup(ws), "client_id", "left").join(campaigns, "campaign_id", "left")
        return base.groupBy(*UNIFIED_KEYS).agg(*[F.sum(c).alias(c) for c in AD_VOLUMES])
    return ws.model("unified_sums", build)


def unified_ad_metrics(ws: Workspace) -> DataFrame:
    """Daily ad metrics at client x campaign x platform x day x window.

    Platform and campaign attributes come from the campaign dimension (an
    unmatched campaign yields NULL platform); client attributes from clients.
    """
    def build():
        spend, impr = F.col("spend_eur"), F.col("impressions")
        return unified_sums(ws).select(
            *UNIFIED_KEYS, *AD_VOLUMES,
            F.when(impr > 0, spend * F.lit(1000.0) / impr).alias("cpm_calc"),
            ratio("clicks", "impressions").alias("ctr_calc"),
            ratio("conversions", "clicks").alias("cvr_calc"),
            ratio("spend_eur", "clicks").alias("cpc_calc"),
            ratio("spend_eur", "conversions").alias("cpa_calc"),
            ratio("revenue_eur", "spend_eur").alias("roas_calc"))
    return ws.model("unified_ad_metrics", build)


def _with_employee_and_project(ws: Workspace, employees: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Time entries with their employee and project, dealt out by client: clients
    are looked up last, so groupings find the facts dealt out by one of their keys.
    ``keep``: they are read more than once; what is wide is stored then."""
    facts = ws.cl("time_tracking").select("client_id", "project_id", "report_date",
                                          "employee_id", "hours_worked", "cost_eur",
                                          "is_productive")
    projects = ws.cl("projects").select("project_id", "project_name", "project_start_date",
                                        "project_end_date", "monthly_budget_eur")
    base = spread_nulls(facts, employees, "employee_id", by=["client_id", "report_date", "project_id"],
                        deal=lambda rows, key: ws.dealt(rows, key, name))
    base = spread_nulls(base, projects, "project_id", by=["client_id", "report_date", "employee_id"],
                        deal=lambda rows, key: ws.dealt(rows, key, name, keep))
    return ws.dealt(base, "client_id", name, keep)


def work_facts(ws: Workspace, keep: bool = False) -> DataFrame:
    """Time entries with all columns of their employee and project."""
    return ws.model("work_facts", lambda: _with_employee_and_project(ws, ws.cl("employees").select(
        "employee_id", "employee_name", "department_name", "team_name", "hourly_rate_eur",
        F.col("status").alias("employee_status")), "work-facts", keep))


def client_projects_with_time(ws: Workspace, with_utilization: bool = False) -> DataFrame:
    """Internal time and cost at client x project x day.

    The employee lookup adds no column, but a repeated employee row counts
    its time entries again, as in every join of this model, so it is planned.
    ``with_utilization``: the query adds up the utilisation, too, so both start
    from the same rows, which are dealt out once.
    """
    def build():
        base = work_facts(ws, keep=True) if with_utilization else _with_employee_and_project(
            ws, ws.cl("employees").select("employee_id"), "time-facts")
        base = base.join(client_lookup(ws), "client_id", "left")
        productive = F.col("is_productive")
        return base.groupBy(*TIME_KEYS).agg(
            F.countDistinct("employee_id").alias("n_employees"),
            F.sum("hours_worked").alias("total_hours"),
            F.sum("cost_eur").alias("total_cost_eur"),
            sum_if(productive, "hours_worked").alias("productive_hours"),
            sum_if(~productive, "hours_worked").alias("non_productive_hours"),
            sum_if(productive, "cost_eur").alias("productive_cost_eur"),
            sum_if(~productive, "cost_eur").alias("non_productive_cost_eur"))
    return ws.model("client_projects_with_time", build)


def campaign_performance(ws: Workspace) -> DataFrame:
    """Unified metrics with spend renamed ad_spend_eur (allocation weight)."""
    u = unified_ad_metrics(ws)
    cols = [F.col(c).alias("ad_spend_eur") if c == "spend_eur" else F.col(c)
            for c in UNIFIED_KEYS + AD_VOLUMES + KPI_COLUMNS]
    return u.select(*cols)


def _allocated(ws: Workspace) -> DataFrame:
    def build():
        return allocate_two_tier(campaign_performance(ws), client_day_ad_spend(ws),
                                 client_day_internal_cost(ws), entity="client_id",
                                 day="report_date", weight="ad_spend_eur", co_located=ws.co_located)
    return ws.model("allocated", build)


def media_only(rows: DataFrame) -> DataFrame:
    """Add cost, profit and margins without internal cost (rounded per row)."""
    spend, revenue = F.col("ad_spend_eur"), F.col("revenue_eur")
    profit, cost = F.col("media_only_profit_eur"), F.col("media_only_total_cost_eur")
    return rows.withColumns({
        "media_only_total_cost_eur": spend,
        "media_only_profit_eur": F.when(revenue.isNotNull() & spend.isNotNull(), r2(revenue - spend)),
    }).withColumns({
        "media_only_margin_on_revenue": F.when((revenue > 0) & profit.isNotNull(), r2(profit / revenue)),
        "media_only_margin_on_cost": F.when((cost > 0) & profit.isNotNull(), r2(profit / cost)),
    })


def media_profitability(ws: Workspace) -> DataFrame:
    """Campaign-day rows with the media-only measures.  They need no internal
    cost, so no allocation is planned for them: the stored profitability table
    where there is one, else the unified metrics."""
    if ws.stored("model:campaign_profitability"):
        return campaign_profitability(ws)
    return ws.model("media_profitability", lambda: media_only(campaign_performance(ws)))


def campaign_profitability(ws: Workspace) -> DataFrame:
    """Campaign-day profitability: full (with allocated internal cost) and media-only."""
    def build():
        a = _allocated(ws)
        spend, revenue, internal = F.col("ad_spend_eur"), F.col("revenue_eur"), F.col(ALLOC.allocated)
        a = a.select(
            *UNIFIED_KEYS, "ad_spend_eur", "impressions", "clicks", "conversions", "revenue_eur",
            *KPI_COLUMNS, ALLOC.day_cost, ALLOC.day_weight, ALLOC.total_cost, ALLOC.total_weight,
            ALLOC.day_share, ALLOC.allocated,
            F.when(internal.isNotNull(), spend + internal).alias("full_total_cost_eur"),
            F.when(revenue.isNotNull() & internal.isNotNull(),
                   revenue - (spend + internal)).alias("full_profit_eur"))
        full_profit, full_cost = F.col("full_profit_eur"), F.col("full_total_cost_eur")
        return media_only(a).withColumns({
            "margin_on_revenue_full": F.when((revenue > 0) & full_profit.isNotNull(), full_profit / revenue),
            "margin_on_cost_full": F.when((full_cost > 0) & full_profit.isNotNull(), full_profit / full_cost),
        }).select(*a.columns, "media_only_total_cost_eur", "media_only_profit_eur", "margin_on_revenue_full",
                  "margin_on_cost_full", "media_only_margin_on_revenue", "media_only_margin_on_cost")
    return ws.model("campaign_profitability", build)


# -- the allocation building blocks ------------------------------------------
#
# Summed from the operational models, so that rows which a lookup repeats
# weigh in the totals as they weigh in the model (shares add up to 1).

ALLOC = AllocationColumns()


def client_day_ad_spend(ws: Workspace) -> DataFrame:
    return ws.model("client_day_ad_spend", lambda: daily_sum(
        unified_ad_metrics(ws), "client_id", "report_date", "spend_eur", ALLOC.day_weight))


def client_day_internal_cost(ws: Workspace) -> DataFrame:
    return ws.model("client_day_internal_cost", lambda: daily_sum(
        client_projects_with_time(ws), "client_id", "report_date", "total_cost_eur", ALLOC.day_cost))


def client_total_ad_spend(ws: Workspace) -> DataFrame:
    return roll_up(client_day_ad_spend(ws), "client_id", ALLOC.day_weight, ALLOC.total_weight)


def client_total_internal_cost(ws: Workspace) -> DataFrame:
    return roll_up(client_day_internal_cost(ws), "client_id", ALLOC.day_cost, ALLOC.total_cost)


def internal_cost_allocation(ws: Workspace) -> DataFrame:
    """Allocation result per campaign-day row with the tier that produced it."""
    return _allocated(ws).select(
        *PROFIT_GRAIN, "ad_spend_eur", ALLOC.day_cost, ALLOC.day_weight, ALLOC.total_cost,
        ALLOC.total_weight, ALLOC.day_share, ALLOC.allocated,
        allocation_branch(ALLOC).alias("allocation_branch"))
