"""Explicit schemas of the seven raw sources (no schema inference).

Business keys are strings: they may hold letters, leading zeros or more digits
than a double keeps.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()
_L = T.LongType()
_D = T.DoubleType()
_DATE = T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "campaigns": _struct(
        ("campaign_id", _S), ("account_id", _S), ("account_name", _S),
        ("campaign_name", _S), ("platform", _S),
        ("start_date", T.TimestampNTZType()), ("campaign_status", _S),
        ("daily_budget_eur", _D)),
    "clients": _struct(
        ("client_id", _S), ("client_name", _S), ("primary_industry", _S),
        ("secondary_industry", _S), ("country", _S)),
    "employees": _struct(
        ("employee_id", _S), ("employee_name", _S), ("department_name", _S),
        ("team_name", _S), ("hourly_rate_eur", _D), ("status", _S)),
    "projects": _struct(
        ("project_id", _S), ("client_id", _S), ("client_name", _S),
        ("project_name", _S), ("project_start_date", _DATE),
        ("project_end_date", _DATE), ("monthly_budget_eur", _D)),
    "social_metrics": _struct(
        ("page_id", _S), ("page_name", _S), ("campaign_id", _S),
        ("report_date", _DATE), ("platform", _S),
        ("engaged_users", _L), ("new_followers", _L), ("total_followers", _L),
        ("impressions", _L), ("organic_impressions", _L),
        ("profile_views", _L), ("website_clicks", _L)),
    "ad_metrics": _struct(
        ("campaign_id", _S), ("client_id", _S), ("client_name", _S),
        ("platform", _S), ("report_date", _DATE), ("attribution_window", _S),
        ("spend_eur", _D), ("impressions", _L), ("clicks", _L),
        ("conversions", _L), ("cpm", _D), ("ctr", _D), ("cvr", _D),
        ("cpc", _D), ("cpa", _D), ("revenue_eur", _D), ("roas", _D)),
    "time_tracking": _struct(
        ("employee_id", _S), ("client_id", _S), ("project_id", _S),
        ("employee_name", _S), ("client_name", _S), ("report_date", _DATE),
        ("hours_worked", _D), ("department_name", _S), ("cost_eur", _D),
        ("is_productive", T.BooleanType())),
}

RAW_SOURCES = tuple(RAW_SCHEMAS)
