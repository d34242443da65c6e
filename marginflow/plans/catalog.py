"""Registry of every published relation and report: key -> (spark, sf_dir) -> DataFrame.

Every query reads the whole test tables of the given folder (through the
session's Workspace for that folder), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginflow.plans import activity, analysis, business, contracts, operational, reconciliation, storage
from marginflow.plans.context import Workspace
from marginflow.session import apply_runtime_defaults
from marginflow.sources.readers import interface_view
from marginflow.sources.schemas import RAW_SOURCES
from marginflow.sources.sinks import Dealing

QueryFn = Callable[[SparkSession, str], DataFrame]


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """One workspace per session and test folder: the logical plans of the
    shared models are built once and reused by every query (no data is
    cached; each action re-reads the inputs).  A folder whose files changed
    gets a new workspace."""
    apply_runtime_defaults(spark)
    # kept on the session itself, so that they go with it
    own: dict[str, Workspace] = spark.__dict__.setdefault("_marginflow_workspaces", {})
    folder = sf_dir.rstrip("/")
    if folder not in own or own[folder].stale():
        own[folder] = Workspace.from_testdata(spark, folder)
    return own[folder]


# Test tables from this size on are worth dealing out: below, Spark broadcasts
# the lookups and nothing is shuffled for them.
DEAL_FROM_BYTES = 32 << 20
BUCKET_BYTES = 8 << 20
# Every writing task leaves a file per bucket, and small files compress badly:
# fewer tasks than buckets, but a task holds memory for each bucket that it writes from.
WRITER_BYTES, WRITERS = 32 << 20, 64


def dealing(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of a query over the facts: where the tables are large, a new
    one whose facts are written in buckets of the keys of their lookups.  Buckets
    and writing tasks grow with the tables, so what one task holds does not."""
    ws = workspace(spark, sf_dir)
    size = sum(length for _, length in ws.state)
    if size < DEAL_FROM_BYTES:
        return ws
    # two sides dealt out by one of several join keys need no exchange (no effect on results)
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    buckets = max(spark.sparkContext.defaultParallelism, 2, size // BUCKET_BYTES)
    return Workspace.from_testdata(spark, sf_dir, Dealing(buckets, max(WRITERS, size // WRITER_BYTES)))


def _dealt(fn: Callable[[Workspace], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(dealing(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _ws(fn: Callable[[Workspace], DataFrame]) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(workspace(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


# The operational models, each computed from the ones before.
_STAGES = {
    "unified_sums": operational.unified_sums,
    "unified_ad_metrics": operational.unified_ad_metrics,
    "client_projects_with_time": operational.client_projects_with_time,
    "campaign_profitability": operational.campaign_profitability,
}
# What is stored: the profitability and the KPIs follow from it, and most
# columns of both are not read by the checks.
_FACTS = ("unified_sums", "client_projects_with_time")


def _staged(fn: Callable[[Workspace], DataFrame], *models: str, **other: Callable[[Workspace], DataFrame]) -> QueryFn:
    """A query that uses operational models more than once: each is computed
    once per call, written to the shared folder and scanned from there.
    ``other``: models that this query computes in a way of its own."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(dealing(spark, sf_dir).staged({m: _STAGES[m] for m in models} | other))
    run.__doc__ = fn.__doc__
    return run


def _checked(fn: Callable[[Workspace], DataFrame]) -> QueryFn:
    """A query over all contracts: the client time and the utilisation add up the same rows."""
    return _staged(fn, *_FACTS, client_projects_with_time=partial(operational.client_projects_with_time, with_utilization=True))


def _il(name: str) -> QueryFn:
    return _ws(lambda ws: interface_view(ws.spark, name, ws.raw(name)))


def _cl(name: str) -> QueryFn:
    return _ws(lambda ws: ws.cl(name))


def _dq_grain_of(model: str, count_name: str = "row_count") -> Callable[[Workspace], DataFrame]:
    spec = contracts.CONTRACT_BY_MODEL[model]

    def run(ws: Workspace) -> DataFrame:
        from marginflow.operators.quality import unique_combination
        return unique_combination(contracts.model_frame(ws, model), spec.unique[0], count_name)
    return run


def _orphan_employees(ws: Workspace) -> DataFrame:
    """Utilisation rows whose employee has no master record (reported, not enforced)."""
    from marginflow.operators.quality import relationships
    util = business.resource_utilization(ws)
    orphans = relationships(util, "employee_id", ws.cl("employees"), "employee_id")
    return orphans.groupBy("employee_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("client_id").alias("n_clients"),
        F.sum(F.col("total_hours").cast("decimal(18,2)")).cast("double").alias("total_hours"))


QUERIES: dict[str, QueryFn] = {
    # interface layer (S1-S7, S10) and cleansed layer (M1-M7)
    **{f"il_{n}": _il(n) for n in sorted(RAW_SOURCES)},
    **{f"cl_{n}": _cl(n) for n in sorted(RAW_SOURCES)},
    # storage (S8-S10): a source through CSV files with bad rows, published versions
    "src_time_tracking_csv": _ws(storage.time_tracking_through_csv),
    "src_pinned_monthly_spend": _staged(storage.pinned_monthly_spend, "unified_sums"),
    # operational layer (M8-M10) and the allocation building blocks
    "ol_unified_ad_metrics": _dealt(operational.unified_ad_metrics),
    "ol_client_projects_with_time": _dealt(operational.client_projects_with_time),
    "client_day_internal_cost": _dealt(operational.client_day_internal_cost),
    "client_day_ad_spend": _dealt(operational.client_day_ad_spend),
    "client_total_internal_cost": _dealt(operational.client_total_internal_cost),
    "client_total_ad_spend": _dealt(operational.client_total_ad_spend),
    "internal_cost_allocation": _staged(operational.internal_cost_allocation, *_FACTS),
    "ol_campaign_profitability": _staged(operational.campaign_profitability, *_FACTS),
    # business layer (M11-M13) and their building blocks
    "client_paid_blended": _dealt(business.client_paid_blended),
    "client_internal_totals": _dealt(business.client_internal_totals),
    "client_social_pivot": _ws(business.client_social_pivot),
    "bl_client_performance_dashboard": _dealt(business.client_performance_dashboard),
    "campaign_monthly": _dealt(business.campaign_monthly),
    "client_internal_monthly": _dealt(business.client_internal_monthly),
    "bl_monthly_campaign_cohorts": _dealt(business.monthly_campaign_cohorts),
    "bl_resource_utilization": _dealt(business.resource_utilization),
    "client_activity_bitmap_rollup": _dealt(activity.client_activity),
    # data-quality contracts (Q1-Q20)
    "dq_summary": _checked(lambda ws: contracts.summary(ws)),
    "dq_cleansing_keys": _ws(lambda ws: contracts.summary(
        ws, models=["cl_clients", "cl_campaigns", "cl_employees", "cl_projects"])),
    "dq_unique_combination": _checked(lambda ws: contracts.summary(ws, kinds={"unique"})),
    "dq_not_null": _checked(lambda ws: contracts.summary(ws, kinds={"not_null"})),
    "dq_relationships": _checked(lambda ws: contracts.summary(ws, kinds={"relationship"})),
    "dq_expression_range": _checked(lambda ws: contracts.summary(ws, kinds={"expression"})),
    "dq_violating_rows": _checked(contracts.violating_grain_keys),
    "dq_allocation_reconciliation": _staged(reconciliation.allocation_reconciliation, *_FACTS),
    "dq_grain_dashboard": _dealt(_dq_grain_of("bl_client_performance_dashboard")),
    "dq_grain_utilization": _dealt(_dq_grain_of("bl_resource_utilization")),
    "dq_grain_monthly": _dealt(_dq_grain_of("bl_monthly_campaign_cohorts")),
    "dq_profit_consistency": _staged(lambda ws: contracts.violating_rows(
        ws, "ol_campaign_profitability", "profit_consistency"), *_FACTS),
    "dq_monthly_negative": _dealt(lambda ws: contracts.violating_rows(
        ws, "bl_monthly_campaign_cohorts", "no_negative_spend_or_revenue")),
    "dq_orphan_employees": _dealt(_orphan_employees),
    # analyst reports (AN1-AN19)
    "an_grain_coverage": _dealt(analysis.grain_coverage),
    "an_top_revenue_clients": _dealt(analysis.top_revenue_clients),
    "an_top_profit_rows": _dealt(analysis.top_profit_rows),
    "an_dashboard_negative": _dealt(analysis.dashboard_negative),
    "an_dashboard_missing_dims": _dealt(analysis.dashboard_missing_dims),
    "an_monthly_coverage": _dealt(analysis.monthly_coverage),
    "an_client_trend": _dealt(analysis.client_trend),
    "an_resource_consistency": _dealt(analysis.resource_consistency),
    "an_monthly_margins": _dealt(analysis.monthly_margins),
    "an_monthly_negative": _dealt(analysis.monthly_negative),
    "an_monthly_missing_keys": _dealt(analysis.monthly_missing_keys),
    "an_monthly_duplicate_grain": _dealt(analysis.monthly_duplicate_grain),
    "an_employee_utilization": _dealt(analysis.employee_utilization),
    "an_client_internal_cost": _dealt(analysis.client_internal_cost),
    "an_department_cost": _dealt(analysis.department_cost),
    "an_utilization_negative": _dealt(analysis.utilization_negative),
    "an_utilization_not_one": _dealt(analysis.utilization_not_one),
    "an_utilization_missing_ids": _dealt(analysis.utilization_missing_ids),
    "an_optimization_candidates": _dealt(analysis.optimization_candidates),
}
