"""Cleansing rules per raw source on hand-made rows."""

import datetime as dt

from marginflow.operators import cleansing as C


def test_employees(spark):
    raw = spark.createDataFrame(
        [(7, "Ann Smith ", "  ", "", 80.0, " active "), (22, "bob lee", "Paid Media", "PC", None, "ACTIVE")],
        "employee_id long, employee_name string, department_name string, team_name string, "
        "hourly_rate_eur double, status string")
    rows = {r.employee_id: r for r in C.cleanse_employees(raw).collect()}
    assert rows["7"].employee_name == "Ann Smith" and rows["7"].department_name is None
    assert rows["7"].team_name is None and rows["7"].status == "ACTIVE"
    assert rows["22"].employee_name == "bob lee"       # case is kept, only trimmed
    assert rows["22"].hourly_rate_eur is None


def test_campaigns(spark):
    ts = dt.datetime(2024, 1, 1, 12, 30)
    raw = spark.createDataFrame(
        [(1, 9, " Acme ", " Spring ", " Meta Ads ", ts, "", 10.0), (2, 9, "Acme", "x", "TikTok Ads", None, " paused ", None)],
        "campaign_id long, account_id long, account_name string, campaign_name string, platform string, "
        "start_date timestamp_ntz, campaign_status string, daily_budget_eur double")
    rows = {r.campaign_id: r for r in C.cleanse_campaigns(raw).collect()}
    assert rows["1"].account_id == "9" and rows["1"].platform == "Meta Ads"
    assert rows["1"].campaign_status is None and rows["2"].campaign_status == "PAUSED"
    assert rows["1"].start_date == ts and rows["1"].start_timestamp == ts


def test_social_and_time_keys(spark):
    social = spark.createDataFrame(
        [(5, " P ", 102.0, dt.date(2024, 1, 2), " Instagram ", 1, 2, 3, 4, 5, 6, 7),
         (5, "P", None, dt.date(2024, 1, 3), "Facebook", 1, 2, 3, 4, 5, 6, 7)],
        "page_id long, page_name string, campaign_id double, report_date date, platform string, "
        "engaged_users long, new_followers long, total_followers long, impressions long, "
        "organic_impressions long, profile_views long, website_clicks long")
    got = [(r.campaign_id, r.platform) for r in C.cleanse_social_metrics(social).orderBy("report_date").collect()]
    assert got == [("102", "Instagram"), (None, "Facebook")]
    time = spark.createDataFrame(
        [(1, 2, 30.0, " e ", " c ", dt.date(2024, 1, 1), 1.5, " Dept ", 120.0, None)],
        "employee_id long, client_id long, project_id double, employee_name string, client_name string, "
        "report_date date, hours_worked double, department_name string, cost_eur double, is_productive boolean")
    r = C.cleanse_time_tracking(time).first()
    assert (r.project_id, r.department_name, r.is_productive) == ("30", "Dept", None)


def test_ad_metrics_types(spark, ws_small):
    schema = {f.name: f.dataType.simpleString() for f in ws_small.cl("ad_metrics").schema.fields}
    assert schema["campaign_id"] == "string" and schema["report_date"] == "date"
    assert schema["impressions"] == "bigint" and schema["spend_eur"] == "double"
    assert len(schema) == 17
