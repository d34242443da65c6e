"""Cleansed layer: one projection per raw source (narrow, no shuffle).

Rules: keys become strings, text is trimmed, blanks become NULL where the
column is optional, labels are normalised, measures get explicit types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.functions.text import (blank_to_null, canonical_category, float_key_string,
                                       key_string, null_if_prefixed, strip_non_ascii, trimmed,
                                       upper_blank_to_null)


def _d(name):
    return F.col(name).cast("double")


def _l(name):
    return F.col(name).cast("bigint")


def cleanse_ad_metrics(raw: DataFrame) -> DataFrame:
    """Grain: campaign x platform x report_date x attribution_window."""
    return raw.select(
        key_string("campaign_id").alias("campaign_id"),
        key_string("client_id").alias("client_id"),
        trimmed("client_name").alias("client_name"),
        trimmed("platform").alias("platform"),
        F.col("report_date").cast("date").alias("report_date"),
        trimmed("attribution_window").alias("attribution_window"),
        _d("spend_eur").alias("spend_eur"),
        _l("impressions").alias("impressions"),
        _l("clicks").alias("clicks"),
        _l("conversions").alias("conversions"),
        *[_d(c).alias(c) for c in ("cpm", "ctr", "cvr", "cpc", "cpa", "revenue_eur", "roas")],
    )


def cleanse_campaigns(raw: DataFrame) -> DataFrame:
    """Grain: campaign_id.  account_id is the owning client (1:1)."""
    return raw.select(
        key_string("campaign_id").alias("campaign_id"),
        key_string("account_id").alias("account_id"),
        trimmed("account_name").alias("account_name"),
        trimmed("campaign_name").alias("campaign_name"),
        trimmed("platform").alias("platform"),
        F.col("start_date"),
        F.col("start_date").cast("timestamp_ntz").alias("start_timestamp"),
        upper_blank_to_null("campaign_status").alias("campaign_status"),
        _d("daily_budget_eur").alias("daily_budget_eur"),
    )


def cleanse_clients(raw: DataFrame) -> DataFrame:
    """Grain: client_id.  client_name is not a key (names collide after trim)."""
    return raw.select(
        key_string("client_id").alias("client_id"),
        trimmed("client_name").alias("client_name"),
        canonical_category(strip_non_ascii("primary_industry")).alias("primary_industry"),
        null_if_prefixed(blank_to_null("secondary_industry")).alias("secondary_industry"),
        trimmed("country").alias("country"),
    )


def cleanse_employees(raw: DataFrame) -> DataFrame:
    return raw.select(
        key_string("employee_id").alias("employee_id"),
        trimmed("employee_name").alias("employee_name"),
        blank_to_null("department_name").alias("department_name"),
        blank_to_null("team_name").alias("team_name"),
        _d("hourly_rate_eur").alias("hourly_rate_eur"),
        F.upper(trimmed("status")).alias("status"),
    )


def cleanse_projects(raw: DataFrame) -> DataFrame:
    return raw.select(
        key_string("project_id").alias("project_id"),
        key_string("client_id").alias("client_id"),
        trimmed("client_name").alias("client_name"),
        trimmed("project_name").alias("project_name"),
        F.col("project_start_date").cast("date").alias("project_start_date"),
        F.col("project_end_date").cast("date").alias("project_end_date"),
        _d("monthly_budget_eur").alias("monthly_budget_eur"),
    )


def cleanse_social_metrics(raw: DataFrame) -> DataFrame:
    """Grain: page x platform x report_date; campaign_id is a nullable FK."""
    counters = ("engaged_users", "new_followers", "total_followers", "impressions",
                "organic_impressions", "profile_views", "website_clicks")
    return raw.select(
        key_string("page_id").alias("page_id"),
        trimmed("page_name").alias("page_name"),
        float_key_string("campaign_id").alias("campaign_id"),
        F.col("report_date").cast("date").alias("report_date"),
        trimmed("platform").alias("platform"),
        *[_l(c).alias(c) for c in counters],
    )


def cleanse_time_tracking(raw: DataFrame) -> DataFrame:
    """Fact without a single key: employee x client x (project) x day x activity."""
    return raw.select(
        key_string("employee_id").alias("employee_id"),
        key_string("client_id").alias("client_id"),
        float_key_string("project_id").alias("project_id"),
        trimmed("employee_name").alias("employee_name"),
        trimmed("client_name").alias("client_name"),
        F.col("report_date").cast("date").alias("report_date"),
        _d("hours_worked").alias("hours_worked"),
        trimmed("department_name").alias("department_name"),
        _d("cost_eur").alias("cost_eur"),
        F.col("is_productive").cast("boolean").alias("is_productive"),
    )


CLEANSERS = {
    "ad_metrics": cleanse_ad_metrics,
    "campaigns": cleanse_campaigns,
    "clients": cleanse_clients,
    "employees": cleanse_employees,
    "projects": cleanse_projects,
    "social_metrics": cleanse_social_metrics,
    "time_tracking": cleanse_time_tracking,
}
