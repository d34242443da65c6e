"""Business layer: client dashboard, monthly cohorts, resource utilisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.functions.numeric import r2, r4, ratio
from marginflow.operators.aggregates import max_if, month_start, sum_if
from marginflow.plans.context import Workspace
from marginflow.plans.operational import (campaign_performance, client_lookup, client_projects_with_time,
                                          media_only, media_profitability, work_facts)

# --- fixed values ---------------------------------------------------------------
SOCIAL_CHANNELS = ("Facebook", "Instagram")
WORKDAY_HOURS = 8
# --------------------------------------------------------------------------------


def _sum(c):
    return F.sum(F.col(c))


SPEND_COLUMNS = ["client_id", "client_name", "primary_industry", "country", "campaign_id", "platform",
                 "report_date", "attribution_window", "impressions", "clicks", "conversions",
                 "ad_spend_eur", "revenue_eur"]
MEDIA_COLUMNS = [*SPEND_COLUMNS, "media_only_total_cost_eur", "media_only_profit_eur"]


def media_rows(ws: Workspace) -> DataFrame:
    """The campaign-day rows that the rollups add up, dealt out by client
    (stored operational tables are already); cost and profit are computed anew
    from what is dealt."""
    def build():
        if any(ws.stored(f"model:{m}") for m in ("campaign_profitability", "unified_ad_metrics", "unified_sums")):
            return media_profitability(ws).select(*MEDIA_COLUMNS)
        rows = ws.dealt(campaign_performance(ws).select(*SPEND_COLUMNS), "client_id", "media-rows", placed=True)
        return media_only(rows).select(*MEDIA_COLUMNS)
    return ws.model("media_rows", build)


# ---------------------------------------------------------------- dashboard --

PAID_KEYS = ["client_id", "client_name", "primary_industry", "platform", "attribution_window"]


def client_paid_blended(ws: Workspace) -> DataFrame:
    """Paid performance per client x platform x window, KPIs from raw sums."""
    def build():
        p = media_rows(ws)
        g = p.groupBy(*PAID_KEYS).agg(
            F.countDistinct("campaign_id").alias("num_campaigns"),
            F.min("report_date").alias("first_activity_date"),
            F.max("report_date").alias("last_activity_date"),
            _sum("impressions").alias("total_impressions"),
            _sum("clicks").alias("total_clicks"),
            _sum("conversions").alias("total_conversions"),
            _sum("ad_spend_eur").alias("_spend"),
            _sum("revenue_eur").alias("_revenue"),
            _sum("media_only_total_cost_eur").alias("_media_cost"),
            _sum("media_only_profit_eur").alias("_media_profit"))
        return g.select(
            *PAID_KEYS, "num_campaigns", "first_activity_date", "last_activity_date",
            "total_impressions", "total_clicks", "total_conversions",
            r2("_spend").alias("total_ad_spend_eur"),
            r2("_revenue").alias("total_revenue_eur"),
            r2(ratio("total_clicks", "total_impressions")).alias("blended_ctr"),
            r2(ratio("total_conversions", "total_clicks")).alias("blended_cvr"),
            r2(ratio("_spend", "total_clicks")).alias("blended_cpc_eur"),
            r2(ratio("_spend", "total_conversions")).alias("blended_cpa_eur"),
            r2(ratio("_revenue", "_spend")).alias("blended_roas"),
            r2("_media_cost").alias("media_only_total_cost_eur_client"),
            r2("_media_profit").alias("media_only_profit_eur_client"),
            r2(ratio("_media_profit", "_revenue")).alias("media_only_margin_on_revenue_client"),
            r2(ratio("_media_profit", "_media_cost")).alias("media_only_margin_on_cost_client"))
    return ws.model("client_paid_blended", build)


def client_internal_totals(ws: Workspace) -> DataFrame:
    def build():
        return client_projects_with_time(ws).groupBy("client_id").agg(
            r2(_sum("total_hours")).alias("total_hours_all_projects"),
            r2(_sum("total_cost_eur")).alias("total_internal_cost_eur"),
            r2(_sum("productive_hours")).alias("productive_hours"),
            r2(_sum("productive_cost_eur")).alias("productive_internal_cost_eur"))
    return ws.model("client_internal_totals", build)


def social_with_client(ws: Workspace) -> DataFrame:
    """Social rows whose campaign resolves to a known client (campaign ->
    account -> client); rows without one are dropped, so both lookups are
    inner joins."""
    social = ws.cl("social_metrics").select("campaign_id", "platform", "report_date",
                                            "new_followers", "engaged_users",
                                            "website_clicks", "total_followers")
    campaigns = ws.cl("campaigns").select("campaign_id", F.col("account_id").alias("client_id"))
    clients = ws.cl("clients").select("client_id")
    return social.join(campaigns, "campaign_id").join(clients, "client_id").drop("campaign_id")


def client_social_pivot(ws: Workspace) -> DataFrame:
    """Organic social per client, one column block per channel.

    Two plain aggregations instead of three distinct counts (which Spark
    would plan as an Expand multiplying every row): first per client and
    day, where each channel keeps its sum, value count and maximum (a hot
    page collapses map-side), then per client.  Days are counted as the
    non-NULL (client, day) groups, per channel the groups where it appears.
    """
    def build():
        s = social_with_client(ws)
        daily = []
        for ch in SOCIAL_CHANNELS:
            on, sfx = F.col("platform") == ch, ch.lower()
            daily.append(F.max(on).alias(f"_seen_{sfx}"))
            for m in ("new_followers", "engaged_users", "website_clicks"):
                daily.append(sum_if(on, m).alias(f"_sum_{m}_{sfx}"))
                daily.append(F.count(F.when(on, F.col(m))).alias(f"_n_{m}_{sfx}"))
            daily.append(max_if(on, "total_followers").alias(f"_max_{sfx}"))
        per_day = s.groupBy("client_id", "report_date").agg(*daily)
        dated = F.col("report_date").isNotNull()
        aggs = [F.count("report_date").alias("n_report_days_social")]
        for ch in SOCIAL_CHANNELS:
            sfx = ch.lower()
            aggs.append(F.count_if(dated & F.col(f"_seen_{sfx}")).alias(f"n_report_days_{sfx}"))
        for ch in SOCIAL_CHANNELS:
            sfx = ch.lower()
            for m in ("new_followers", "engaged_users", "website_clicks"):
                total, n = F.sum(f"_sum_{m}_{sfx}"), F.sum(f"_n_{m}_{sfx}")
                aggs.append(total.alias(f"total_{m}_{sfx}"))
                # average over the channel's non-NULL rows: sum / count of the
                # rows that have a value (sum_if adds 0 for the others)
                aggs.append(r2(ratio(F.sum(F.when(F.col(f"_n_{m}_{sfx}") > 0, F.col(f"_sum_{m}_{sfx}"))), n))
                            .alias(f"avg_daily_{m}_{sfx}"))
            aggs.append(F.max(f"_max_{sfx}").alias(f"current_total_followers_{sfx}"))
        return per_day.groupBy("client_id").agg(*aggs)
    return ws.model("client_social_pivot", build)


DASHBOARD_SOCIAL_COLUMNS = (
    ["n_report_days_social"]
    + [c for ch in ("facebook", "instagram") for c in (
        f"n_report_days_{ch}", f"total_new_followers_{ch}", f"avg_daily_new_followers_{ch}",
        f"total_engaged_users_{ch}", f"avg_daily_engaged_users_{ch}",
        f"total_website_clicks_{ch}", f"avg_daily_website_clicks_{ch}",
        f"current_total_followers_{ch}")])


def client_performance_dashboard(ws: Workspace) -> DataFrame:
    """Client x platform x window view: paid, media-only profit, internal
    cost and organic social.  Internal and social values are client-level
    and repeat across platforms and windows: never sum them downstream."""
    def build():
        paid = client_paid_blended(ws)
        j = paid.join(client_internal_totals(ws), "client_id", "left").join(client_social_pivot(ws), "client_id", "left")
        profit, internal = F.col("media_only_profit_eur_client"), F.col("total_internal_cost_eur")
        both = profit.isNotNull() & internal.isNotNull()
        net = F.when(both, r2(profit - internal))
        return j.select(
            *PAID_KEYS, "first_activity_date", "last_activity_date", "num_campaigns",
            "total_impressions", "total_clicks", "total_conversions", "total_ad_spend_eur",
            "total_revenue_eur", "blended_ctr", "blended_cvr", "blended_cpc_eur",
            "blended_cpa_eur", "blended_roas",
            F.col("media_only_total_cost_eur_client").alias("media_only_total_cost_eur"),
            profit.alias("media_only_profit_eur"),
            F.col("media_only_margin_on_revenue_client").alias("media_only_margin_on_revenue"),
            F.col("media_only_margin_on_cost_client").alias("media_only_margin_on_cost"),
            "total_hours_all_projects", "total_internal_cost_eur", "productive_hours",
            "productive_internal_cost_eur",
            net.alias("net_profit_after_internal_eur"),
            F.when(both & (F.col("total_revenue_eur") > 0),
                   r2((profit - internal) / F.col("total_revenue_eur"))).alias("project_margin_after_internal"),
            net.alias("client_lifetime_value_eur"),
            *DASHBOARD_SOCIAL_COLUMNS)
    return ws.model("client_performance_dashboard", build)


# ------------------------------------------------------------------ monthly --

MONTHLY_KEYS = ["client_id", "client_name", "primary_industry", "country", "platform",
                "attribution_window", "cohort_month"]
MONTHLY_ORDER = ["cohort_month", "client_id", "platform", "attribution_window"]


def campaign_monthly(ws: Workspace) -> DataFrame:
    def build():
        p = media_rows(ws).withColumn("cohort_month", month_start("report_date"))
        return p.groupBy(*MONTHLY_KEYS).agg(
            F.countDistinct("campaign_id").alias("num_campaigns"),
            F.min("report_date").alias("first_activity_date_in_month"),
            F.max("report_date").alias("last_activity_date_in_month"),
            _sum("impressions").alias("monthly_impressions"),
            _sum("clicks").alias("monthly_clicks"),
            _sum("conversions").alias("monthly_conversions"),
            r2(_sum("ad_spend_eur")).alias("monthly_ad_spend_eur"),
            r2(_sum("revenue_eur")).alias("monthly_revenue_eur"),
            r2(_sum("media_only_total_cost_eur")).alias("media_only_total_cost_eur"),
            r2(_sum("media_only_profit_eur")).alias("media_only_profit_eur"))
    return ws.model("campaign_monthly", build)


def client_internal_monthly(ws: Workspace) -> DataFrame:
    def build():
        t = client_projects_with_time(ws).withColumn("cohort_month", month_start("report_date"))
        return t.groupBy("client_id", "cohort_month").agg(
            r2(_sum("total_hours")).alias("monthly_total_hours_all_projects"),
            r2(_sum("total_cost_eur")).alias("monthly_internal_cost_eur"),
            r2(_sum("productive_hours")).alias("monthly_productive_hours"),
            r2(_sum("productive_cost_eur")).alias("monthly_productive_internal_cost_eur"))
    return ws.model("client_internal_monthly", build)


def _monthly_sums(ws: Workspace) -> DataFrame:
    def build():
        j = campaign_monthly(ws).join(client_internal_monthly(ws), ["client_id", "cohort_month"], "left")
        return j.select(
            *MONTHLY_KEYS, "num_campaigns", "first_activity_date_in_month",
            "last_activity_date_in_month", "monthly_impressions", "monthly_clicks",
            "monthly_conversions", "monthly_ad_spend_eur", "monthly_revenue_eur",
            "media_only_total_cost_eur", "media_only_profit_eur",
            "monthly_total_hours_all_projects", "monthly_internal_cost_eur",
            "monthly_productive_hours", "monthly_productive_internal_cost_eur")
    return ws.model("monthly_sums", build)


def monthly_campaign_cohorts(ws: Workspace, ordered: bool = True) -> DataFrame:
    """Month x client x platform x window rollup; KPIs from the rounded sums.
    The sums are put in order without the KPIs, which would double what is moved for it."""
    if ordered and not ws.stored("model:monthly_campaign_cohorts"):
        return _with_monthly_kpis(_in_monthly_order(_monthly_sums(ws)))
    out = ws.model("monthly_campaign_cohorts", lambda: _with_monthly_kpis(_monthly_sums(ws)))
    return _in_monthly_order(out) if ordered else out


def _in_monthly_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(*[F.asc_nulls_last(c) for c in MONTHLY_ORDER])


def _with_monthly_kpis(sums: DataFrame) -> DataFrame:
    spend, revenue = F.col("monthly_ad_spend_eur"), F.col("monthly_revenue_eur")
    profit, cost = F.col("media_only_profit_eur"), F.col("media_only_total_cost_eur")
    hours, internal = F.col("monthly_total_hours_all_projects"), F.col("monthly_internal_cost_eur")
    return sums.select(
        *sums.columns,
        r4(ratio("monthly_clicks", "monthly_impressions")).alias("monthly_ctr"),
        r4(ratio("monthly_conversions", "monthly_clicks")).alias("monthly_cvr"),
        r2(ratio(spend, "monthly_clicks")).alias("monthly_cpc_eur"),
        r2(ratio(spend, "monthly_conversions")).alias("monthly_cpa_eur"),
        r2(ratio(revenue, spend)).alias("monthly_roas"),
        F.when((revenue > 0) & profit.isNotNull(), r2(profit / revenue))
         .alias("monthly_media_only_margin_on_revenue"),
        F.when((cost > 0) & profit.isNotNull(), r2(profit / cost))
         .alias("monthly_media_only_margin_on_cost"),
        r4(ratio("monthly_productive_hours", hours)).alias("monthly_utilization_rate_billable_hours"),
        r2(ratio(internal, hours)).alias("monthly_internal_cost_per_hour_eur"),
        F.when(profit.isNotNull() & internal.isNotNull(), r2(profit - internal))
         .alias("monthly_net_profit_after_internal_eur"),
        F.when((revenue > 0) & profit.isNotNull() & internal.isNotNull(),
               r2((profit - internal) / revenue)).alias("monthly_project_margin_after_internal"))


# -------------------------------------------------------------- utilisation --

UTILIZATION_KEYS = ["employee_id", "employee_name", "department_name", "team_name",
                    "hourly_rate_eur", "employee_status", "client_id", "client_name",
                    "primary_industry", "country", "project_id", "project_name",
                    "project_start_date", "project_end_date", "monthly_budget_eur"]


def resource_utilization(ws: Workspace) -> DataFrame:
    """Employee x client x project: billable vs non-billable hours and cost."""
    def build():
        j = work_facts(ws).join(client_lookup(ws), "client_id", "left")
        billable = F.col("is_productive")
        g = j.groupBy(*UTILIZATION_KEYS).agg(
            F.min("report_date").alias("first_work_date"),
            F.max("report_date").alias("last_work_date"),
            F.countDistinct("report_date").alias("n_work_days"),
            _sum("hours_worked").alias("_hours"),
            sum_if(billable, "hours_worked").alias("_billable_hours"),
            sum_if(~billable, "hours_worked").alias("_non_billable_hours"),
            _sum("cost_eur").alias("_cost"),
            sum_if(billable, "cost_eur").alias("_billable_cost"),
            sum_if(~billable, "cost_eur").alias("_non_billable_cost"))
        days = F.col("n_work_days")
        return g.select(
            *UTILIZATION_KEYS, "first_work_date", "last_work_date", "n_work_days",
            r2("_hours").alias("total_hours"),
            r2("_billable_hours").alias("billable_hours"),
            r2("_non_billable_hours").alias("non_billable_hours"),
            r2("_cost").alias("total_cost_eur"),
            r2("_billable_cost").alias("billable_cost_eur"),
            r2("_non_billable_cost").alias("non_billable_cost_eur"),
            r4(ratio("_billable_hours", "_hours")).alias("utilization_rate_billable_hours"),
            r4(ratio("_billable_cost", "_cost")).alias("utilization_rate_billable_cost"),
            r2(ratio("_hours", days)).alias("avg_hours_per_work_day"),
            r4(ratio("_hours", days * WORKDAY_HOURS)).alias("empirical_utilization_rate"),
            r2(ratio("_cost", "_hours")).alias("internal_cost_per_hour_eur"))
    return ws.model("resource_utilization", build)
