"""Sources and sinks: CSV reader, parquet table round trip, views, pipeline."""

import os

import pytest
from pyspark.sql import functions as F

from marginflow.plans import contracts
from marginflow.plans.context import Workspace
from marginflow.plans.pipeline import build_all, written_workspace
from marginflow.sources.readers import read_raw, register_interface_views
from marginflow.sources.sinks import materialize, published_version, register_view, write_table

CSV = (
    'client_id,client_name,primary_industry,secondary_industry,country\n'
    '1,Acme ,"\U0001F3DB️ Finance, Insurance & Institutions",#N/A (lookup failed),Germany\n'
    '2,Beta,,,"Austria"\n'
    '3.0,"Gamma, Inc","\U0001F9CD‍♀️ Fashion & Lifestyle",  tag  , Spain \n'
)


def test_csv_reader_quotes_emoji_empty_and_float_keys(spark, tmp_path):
    p = tmp_path / "clients.csv"
    p.write_text(CSV, encoding="utf-8")
    rows = read_raw(spark, "clients", str(p), fmt="csv").orderBy("client_id").collect()
    assert [r.client_id for r in rows] == ["1", "2", "3.0"]  # keys stay text
    assert rows[0].primary_industry.endswith("Finance, Insurance & Institutions")
    assert rows[1].primary_industry is None and rows[1].secondary_industry is None
    assert rows[2].client_name == "Gamma, Inc"

    from marginflow.operators.cleansing import cleanse_clients
    cl = cleanse_clients(read_raw(spark, "clients", str(p), fmt="csv")).orderBy("client_id").collect()
    assert [r.primary_industry for r in cl] == [
        "Finance, Insurance & Institutions", None, "Fashion & Lifestyle"]
    assert [r.secondary_industry for r in cl] == [None, None, "tag"]
    assert [r.client_name for r in cl] == ["Acme", "Beta", "Gamma, Inc"]


def test_table_round_trip_and_view(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    path = str(tmp_path / "t")
    write_table(df, path)
    write_table(df, path)  # full rebuild overwrites
    assert sorted(spark.read.parquet(path).collect()) == sorted(df.collect())
    register_view(df, "mf_test_view")
    assert spark.sql("SELECT count(*) FROM mf_test_view").first()[0] == 2


def test_materialize_cuts_lineage(spark):
    df = spark.range(10).selectExpr("id", "id * 2 AS v")
    m = materialize(spark, df, "probe")
    assert m.count() == 10
    plan = m._jdf.queryExecution().analyzed().toString()
    assert "Range" not in plan


def test_keys_and_booleans_of_csv(spark, tmp_path):
    """Keys pass as text, float-formatted foreign keys normalise without a
    double, quoted line breaks stay in their field, odd booleans fail."""
    from marginflow.operators.cleansing import cleanse_clients, cleanse_time_tracking
    p = tmp_path / "clients.csv"
    p.write_text('client_id,client_name,primary_industry,secondary_industry,country,note\n'
                 '9007199254740993,A,x,y,DE,extra\n007,"B\nb",x,y,DE,\nC-12,C,x,y,DE,\n', encoding="utf-8")
    raw = read_raw(spark, "clients", str(p), fmt="csv")
    assert "note" in raw.columns  # undeclared columns pass
    assert sorted(r.client_id for r in cleanse_clients(raw).collect()) == ["007", "9007199254740993", "C-12"]
    assert {r.client_name for r in raw.collect()} == {"A", "B\nb", "C"}

    head = ("employee_id,client_id,project_id,employee_name,client_name,report_date,hours_worked,department_name,"
            "cost_eur,is_productive\n")
    t = tmp_path / "time.csv"
    t.write_text(head + "1,1,102.0,e,c,2024-01-01,1,d,2,y\n1,1,9007199254740993.0,e,c,2024-01-01,1,d,2,no\n"
                 "1,1,007,e,c,2024-01-01,1,d,2,\n1,1,C-12,e,c,2024-01-01,1,d,2,T\n", encoding="utf-8")
    rows = cleanse_time_tracking(read_raw(spark, "time_tracking", str(t), fmt="csv")).collect()
    assert {(r.project_id, r.is_productive) for r in rows} == {
        ("102", True), ("9007199254740993", False), ("007", None), ("C-12", True)}
    t.write_text(head + "1,1,1,e,c,2024-01-01,1,d,2,on\n", encoding="utf-8")
    with pytest.raises(Exception, match="not a boolean"):
        read_raw(spark, "time_tracking", str(t), fmt="csv").collect()
    with pytest.raises(ValueError, match="lacks the columns"):
        read_raw(spark, "campaigns", str(t), fmt="csv")


def test_build_all_can_be_repeated(spark, tmp_path):
    """Two builds into one folder, with queries before and between."""
    from marginflow.plans.catalog import QUERIES, workspace
    sf = "/root/testdata/sf0.001"
    ws = workspace(spark, sf)
    before = QUERIES["ol_campaign_profitability"](spark, sf)
    expected = sorted(map(str, before.collect()))
    out = str(tmp_path / "warehouse")
    builds = []
    for _ in range(2):
        paths = build_all(ws, out)
        assert published_version(spark, out) in paths["dq_summary"]
        for name in ("cl_clients", "ol_campaign_profitability", "bl_client_performance_dashboard",
                     "bl_monthly_campaign_cohorts", "bl_resource_utilization", "dq_summary"):
            assert os.path.isdir(paths[name])
        builds.append(paths)
        again = QUERIES["ol_campaign_profitability"](spark, sf)
        assert sorted(map(str, again.collect())) == expected
        assert "warehouse" not in again._jdf.queryExecution().optimizedPlan().toString()
    assert builds[0]["cl_clients"] != builds[1]["cl_clients"]
    for name in builds[0]:
        a, b = (spark.read.parquet(x[name]) for x in builds)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    dash = spark.read.parquet(builds[1]["bl_client_performance_dashboard"])
    assert len(dash.columns) == 46 and dash.count() > 0
    assert spark.sql("SELECT count(*) FROM il_ad_metrics").first()[0] > 0
    # contracts on the written tables scan them and recompute no model
    plan = contracts.summary(written_workspace(ws, builds[1]))._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan and "bl_resource_utilization" in plan


def test_seeding_drops_what_was_derived(spark):
    from marginflow.plans import operational
    ws = Workspace.from_testdata(spark, "/root/testdata/sf0.001")
    operational.internal_cost_allocation(ws)
    table = operational.unified_ad_metrics(ws).limit(0)
    ws.seed("model:unified_ad_metrics", table)
    assert operational.internal_cost_allocation(ws).count() == 0


def test_repeated_dimension_rows_keep_shares(spark, tmp_path, ws_small):
    """A campaign or employee row that occurs twice repeats its facts; the
    allocation still gives out each day's cost once."""
    from marginflow.plans import operational
    from marginflow.sources.schemas import RAW_SOURCES
    raw = {n: ws_small.raw(n) for n in RAW_SOURCES}
    some = raw["ad_metrics"].select("campaign_id").limit(1).first()[0]
    worker = raw["employees"].select("employee_id").limit(1).first()[0]
    raw["campaigns"] = raw["campaigns"].unionByName(
        raw["campaigns"].where(F.col("campaign_id") == some).withColumn("campaign_name", F.lit("second")))
    raw["employees"] = raw["employees"].unionByName(raw["employees"].where(F.col("employee_id") == worker))
    ws = Workspace(spark, {n: (lambda df=df: df) for n, df in raw.items()})
    a = operational.internal_cost_allocation(ws)
    daily = (a.where((F.col("client_internal_cost_eur").isNotNull()) & (F.col("client_total_spend_eur") > 0))
             .groupBy("client_id", "report_date")
             .agg(F.sum("internal_cost_eur").alias("given"), F.first("client_internal_cost_eur").alias("cost")))
    assert daily.where(F.abs(F.col("given") - F.col("cost")) > 1e-6 * F.greatest(F.lit(1.0), F.col("cost"))).count() == 0
    hours = lambda w: operational.client_projects_with_time(w).agg(F.sum("total_hours")).first()[0]
    extra = ws_small.cl("time_tracking").where(F.col("employee_id") == str(worker)).agg(F.sum("hours_worked")).first()[0]
    assert hours(ws) == pytest.approx(hours(ws_small) + extra)


def test_interface_views(spark, ws_small):
    register_interface_views({"campaigns": ws_small.raw("campaigns")}, prefix="il_t_")
    assert spark.sql("SELECT count(*) FROM il_t_campaigns").first()[0] == ws_small.raw("campaigns").count()


def test_real_sources_path_gives_same_models(spark, tmp_path, ws_small):
    """Raw sources written as parquet and read back with their declared
    schemas give the same business models as the in-plan test adapter."""
    from marginflow.plans import business
    from marginflow.sources.schemas import RAW_SOURCES
    paths = {}
    for name in RAW_SOURCES:
        paths[name] = str(tmp_path / name)
        write_table(ws_small.raw(name), paths[name])
    ws = Workspace.from_sources(spark, paths)
    a = business.client_performance_dashboard(ws)
    b = business.client_performance_dashboard(ws_small)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
