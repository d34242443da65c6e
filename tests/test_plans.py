"""Physical-plan properties: pruning, pushdown, shared exchanges, skew."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from marginflow.operators.joins import spread_nulls
from marginflow.plans import business, operational
from marginflow.plans.context import Workspace
from marginflow.sources.schemas import RAW_SOURCES
from marginflow.sources.sinks import write_table


@contextmanager
def conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    """Execute through the DataFrame's own QueryExecution, then read the
    final adaptive plan."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(ws_small):
    plan = _plan(operational.unified_ad_metrics(ws_small))
    line_scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", plan)
    assert line_scans, plan
    for cols in line_scans:
        assert "l_partkey" not in cols and "l_suppkey" not in cols and "l_linestatus" not in cols


def test_scans_read_whole_tables(ws_small):
    """Only the declared orphan makers are filters of the mapping."""
    plan = _plan(ws_small.cl("time_tracking"))
    assert "l_linenumber#" in plan and not re.search(r"LessThanOrEqual\(l_linenumber", plan), plan


@pytest.fixture(scope="module")
def parquet_ws(spark, ws_small, tmp_path_factory):
    """The raw sources as parquet files: plans without the test adapter."""
    paths = {}
    for name in RAW_SOURCES:
        paths[name] = str(tmp_path_factory.mktemp("raw") / name)
        write_table(ws_small.raw(name), paths[name])
    return Workspace.from_sources(spark, paths)


def test_daily_aggregates_are_shared(spark, parquet_ws):
    """Facts are scanned once for the model and once per daily aggregate; the
    lifetime totals reuse the daily exchanges."""
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = _final_plan(operational.campaign_profitability(parquet_ws.fresh()))
    final = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet [^\n]*ad_metrics", final)) <= 2, final
    assert len(re.findall(r"FileScan parquet [^\n]*time_tracking", final)) <= 1, final
    assert "ReusedExchange" in final


def test_unified_aggregate_is_not_dealt_by_client(spark, parquet_ws):
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = _plan(operational.unified_ad_metrics(parquet_ws.fresh()))
    # the last exchange above the facts, below the aggregate, is by campaign
    assert re.search(r"SortMergeJoin \[campaign_id", plan), plan
    first = re.search(r"Exchange hashpartitioning\(([^)]*)\)", plan).group(1)
    assert first.startswith("campaign_id"), first


def test_null_projects_are_dealt_out(spark):
    facts = spark.createDataFrame([(str(i), None if i % 3 else "1", i) for i in range(300)],
                                  "client_id string, project_id string, n long")
    projects = spark.createDataFrame([("1", "one")], "project_id string, name string")
    out = spread_nulls(facts, projects, "project_id", by=["client_id", "n"])
    assert out.columns == ["client_id", "project_id", "n", "name"]
    rows = out.collect()
    assert len(rows) == 300
    assert all((r.name == "one") == (r.project_id == "1") for r in rows)


def test_unused_allocation_joins_are_pruned_from_monthly(ws_small):
    for model in (lambda ws: business.monthly_campaign_cohorts(ws, ordered=False), business.client_performance_dashboard):
        # fresh: a plan that another test has run shows both its stages
        plan = _plan(model(ws_small.fresh()))
        assert "client_total_spend_eur" not in plan, plan
        # the ad facts and the time facts once each
        assert len(re.findall(r"FileScan parquet [^\n]*lineitem", plan)) == 2, plan


def test_social_bridge_is_inner(ws_small):
    plan = _plan(business.client_social_pivot(ws_small))
    assert "LeftOuter" not in plan


def test_hot_key_is_split_by_aqe(spark):
    """A third of all rows on one campaign: AQE splits that partition of the
    lookup join and the grouped result stays complete."""
    n = 300000
    facts = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("campaign_id"),
        F.col("id").alias("d"), F.rand(1).alias("spend"))
    dims = (spark.range(5000).select(F.col("id").cast("string").alias("campaign_id"), F.lit("p").alias("platform"))
            .unionByName(spark.createDataFrame([("hot", "q")], "campaign_id string, platform string")))
    with conf(spark, **{"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
                        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                        "spark.sql.autoBroadcastJoinThreshold": "-1",
                        "spark.sql.shuffle.partitions": "32"}):
        out = facts.join(dims, "campaign_id", "left").groupBy("campaign_id", "platform", "d") \
            .agg(F.sum("spend").alias("s"))
        plan = _final_plan(out)
        assert "skew=true" in plan, plan
        assert out.count() == n
        assert out.where(F.col("campaign_id") == "hot").count() == n // 3


def test_building_models_runs_no_jobs(spark):
    """Model construction is lazy: building every model and the contract suite
    submits no Spark job (the test tables have declared schemas, so opening
    them needs no inference job either)."""
    from marginflow.plans import contracts
    from marginflow.plans.context import Workspace
    ws = Workspace.from_testdata(spark, "/root/testdata/sf0.001")
    sc = spark.sparkContext
    sc.setJobGroup("mf-build-only", "model construction")
    try:
        business.client_performance_dashboard(ws)
        business.monthly_campaign_cohorts(ws)
        business.resource_utilization(ws)
        contracts.summary(ws)
        jobs = list(sc.statusTracker().getJobIdsForGroup("mf-build-only"))
    finally:
        sc.setJobGroup(None, None)
    assert jobs == []
