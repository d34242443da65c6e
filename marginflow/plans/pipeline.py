"""Full rebuild of every layer: interface views, then cleansed, operational
and business tables written as parquet.

Each table is written once and read back before its consumers use it, so
the business jobs start from the operational files and the data-quality
contracts from the written models (lineage cut at every layer, no model
recomputed per consumer); an executor loss in a later job never re-runs an
earlier layer.  A build is a new version, published when it is complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from marginflow.operators.quality import row_checks
from marginflow.plans import business, contracts, operational
from marginflow.plans.context import Workspace
from marginflow.sources.readers import register_interface_views
from marginflow.sources.sinks import in_order, new_version, publish_version, write_bucketed, write_table

CLEANSED = ("ad_metrics", "campaigns", "clients", "employees", "projects", "social_metrics",
            "time_tracking")
OPERATIONAL = {
    "ol_unified_ad_metrics": operational.unified_ad_metrics,
    "ol_client_projects_with_time": operational.client_projects_with_time,
    "ol_campaign_profitability": operational.campaign_profitability,
}
BUSINESS = {
    "bl_client_performance_dashboard": business.client_performance_dashboard,
    "bl_monthly_campaign_cohorts": lambda ws: business.monthly_campaign_cohorts(ws, ordered=False),
    "bl_resource_utilization": business.resource_utilization,
}

# Tables stored in an order (ascending, NULLS LAST) that filters and readers rely on.
ORDERED = {"bl_monthly_campaign_cohorts": business.MONTHLY_ORDER}
# Tables that build_all(buckets=...) deals out by a key.
BUCKETED = {
    "ol_unified_ad_metrics": ["client_id", "report_date"],
    "ol_client_projects_with_time": ["client_id", "report_date"],
}
ROW_KINDS = {"not_null", "expression", "singular"}


def build_all(ws: Workspace, out_dir: str, run_checks: bool = True, buckets: int | None = None) -> dict[str, str]:
    """Rebuild every table as a new version under ``out_dir`` and publish it;
    return name -> path.

    ``ws`` gives the raw sources and is not changed: the build has a workspace
    of its own, so it can be repeated, and a failed build publishes nothing.

    With ``run_checks`` the contract summary is written too (``dq_summary``:
    model, check_name, violations).  The row-level checks are counted by the
    jobs that write the tables (observed metrics) and cost no scan of their
    own; uniqueness and relationships are checked on the written tables.

    ``buckets``: store the two operational fact tables in so many buckets of
    (client_id, report_date), as catalogue tables at their path.  The daily
    allocation then joins them without an exchange of the facts, and a hot
    client stays spread over its days.
    """
    spark = ws.spark
    build = ws.fresh()
    version = new_version(out_dir)
    paths: dict[str, str] = {}
    observed: list[tuple[str, str, int]] = []
    register_interface_views({n: build.raw(n) for n in CLEANSED})

    def write(name: str, df: DataFrame) -> DataFrame:
        path = paths[name] = f"{version}/{name}"
        checks = row_checks(contracts.to_contract(build, contracts.CONTRACT_BY_MODEL[name], ROW_KINDS)) \
            if run_checks and name in contracts.CONTRACT_BY_MODEL else {}
        bucketed = buckets is not None and name in BUCKETED
        if name in ORDERED:
            df = in_order(df, ORDERED[name])
        elif bucketed:
            df = df.repartition(buckets, *BUCKETED[name])
        # observed by the writing stage itself: what comes before an exchange
        # may run twice (the sampling of ranges, a lost executor's stage)
        metrics = Observation(name)
        if checks:
            df = df.observe(metrics, *[F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(checks.values())])
        if bucketed:
            table = f"{name}_{version.rsplit('/', 1)[-1]}"
            write_bucketed(df, table, path, BUCKETED[name], buckets)
            out = spark.table(table)
        else:
            write_table(df, path, mode="errorifexists")
            out = spark.read.schema(df.schema).parquet(path)
        observed.extend((name, check, metrics.get[f"c{i}"]) for i, check in enumerate(checks))
        return out

    for n in CLEANSED:
        build.seed("cl:" + n, write("cl_" + n, build.cl(n)))
    for name, model in {**OPERATIONAL, **BUSINESS}.items():
        build.seed(_key(name), write(name, model(build)))
        # from here on the bucketed tables are what the allocation joins
        build.co_located = bool(buckets) and all(b in paths for b in BUCKETED)
    if run_checks:
        rows = spark.createDataFrame(observed, "model string, check_name string, violations long")
        write("dq_summary", rows.unionByName(contracts.summary(build, kinds={"unique", "relationship"})))
    publish_version(spark, out_dir, version)
    return paths


def _key(table: str) -> str:
    return "cl:" + table.removeprefix("cl_") if table.startswith("cl_") else "model:" + table[3:]


def written_workspace(ws: Workspace, paths: dict[str, str]) -> Workspace:
    """A workspace whose models are the tables of a build: contracts and
    reports on it scan written tables and recompute no model."""
    out = ws.fresh()
    for name, path in paths.items():
        if name != "dq_summary":
            out.seed(_key(name), ws.spark.read.parquet(path))
    return out


def main(argv: list[str] | None = None) -> None:
    """``python -m marginflow.plans.pipeline --sf-dir DIR --out DIR`` (test tables), or
    ``--raw name=path ...`` for real raw sources (parquet; ``--format csv`` for CSV)."""
    import argparse
    import json

    from marginflow.session import get_session

    ap = argparse.ArgumentParser(description="Full rebuild of every layer")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--sf-dir", help="folder with the TPC-H-style test tables")
    ap.add_argument("--raw", nargs="*", default=[], help="raw sources as name=path")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--master", default=None)
    ap.add_argument("--no-checks", action="store_true")
    args = ap.parse_args(argv)
    spark = get_session(master=args.master)
    if args.raw:
        ws = Workspace.from_sources(spark, dict(a.split("=", 1) for a in args.raw), args.format)
    elif args.sf_dir:
        ws = Workspace.from_testdata(spark, args.sf_dir)
    else:
        ap.error("give --sf-dir or --raw")
    print(json.dumps(build_all(ws, args.out, run_checks=not args.no_checks), indent=2))


if __name__ == "__main__":
    main()
