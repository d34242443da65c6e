"""Quarantined CSV rows, stored order, observed checks, bucketed tables,
pinned versions."""

import datetime as dt
import glob
import json
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marginflow.plans import business, contracts, operational
from marginflow.plans.context import Workspace
from marginflow.plans.pipeline import build_all, written_workspace
from marginflow.sources.published import PinnedVersion, publish
from marginflow.sources.quarantine import has_quoted_line_breaks, read_quarantined
from tests.conftest import SF_SMALL

HEAD = "employee_id,client_id,project_id,employee_name,client_name,report_date,hours_worked,department_name,cost_eur,is_productive\n"


def test_bad_csv_rows_are_set_aside_with_their_reasons(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        HEAD + '1,007,102.0,"Ann, B",c,2024-01-01,1.5,d,2,yes\n2,1,,e,c,2024-02-30,1,d,2,no\n3,1\n'
        "4,1,5,e,c,2024-01-01,one,d,many,perhaps\n5,1,5,e,c,,,,,\n6,1,5,e,c,2024-01-01,1,d,2,true,too,many\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text(HEAD + "7,1,5,é😀,c,2024-01-01,1,d,2,F\n", encoding="utf-8")
    read = read_quarantined(spark, "time_tracking", str(tmp_path))
    good = {r.employee_id: r for r in read.good.collect()}
    assert set(good) == {"1", "5", "7"}
    assert good["1"].client_id == "007" and good["1"].employee_name == "Ann, B" and good["1"].is_productive is True
    assert good["1"].report_date == dt.date(2024, 1, 1) and good["5"].hours_worked is None and good["7"].employee_name == "é😀"
    bad = read.rejected.collect()
    assert all(r.source == "time_tracking" and r.file.endswith("a.csv") for r in bad)
    reasons = {}
    for r in bad:
        record = json.loads(r.record)["employee_id"] if r.record.startswith("{") else r.record.split(",")[0]
        reasons[record] = sorted(r.reasons)
    assert reasons == {"2": ["type:report_date"], "3": ["columns"], "6": ["columns"],
                       "4": ["type:cost_eur", "type:hours_worked", "type:is_productive"]}
    assert "6,1,5,e,c,2024-01-01,1,d,2,true,too,many" in {r.record for r in bad}


def test_quoted_line_breaks_decide_how_files_are_read(spark, tmp_path):
    plain, broken = tmp_path / "plain.csv", tmp_path / "broken.csv"
    plain.write_text('client_id,client_name,primary_industry,secondary_industry,country\n1,"a ""b"", c",x,y,DE\n', encoding="utf-8")
    broken.write_text('client_id,client_name,primary_industry,secondary_industry,country\n1,"a\nb",x,y,DE\n', encoding="utf-8")
    assert not has_quoted_line_breaks(spark, str(plain)) and has_quoted_line_breaks(spark, str(broken))
    assert [r.client_name for r in read_quarantined(spark, "clients", str(plain)).good.collect()] == ['a "b", c']
    assert [r.client_name for r in read_quarantined(spark, "clients", str(broken)).good.collect()] == ["a\nb"]
    with pytest.raises(ValueError, match="lacks the columns"):
        read_quarantined(spark, "campaigns", str(plain))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A bucketed build of dirty raw tables."""
    base = Workspace.from_testdata(spark, SF_SMALL)
    raw = {n: base.raw(n) for n in ("ad_metrics", "campaigns", "clients", "employees", "projects", "social_metrics", "time_tracking")}
    extra = raw["ad_metrics"].limit(3).withColumns({"spend_eur": F.lit(-7.0), "report_date": F.lit(None).cast("date")})
    raw["ad_metrics"] = raw["ad_metrics"].unionByName(extra)
    raw["clients"] = raw["clients"].unionByName(raw["clients"].limit(1).withColumn("client_name", F.lit(None).cast("string")))
    ws = Workspace(spark, {n: (lambda df=df: df) for n, df in raw.items()})
    return ws, build_all(ws, str(tmp_path_factory.mktemp("built")), buckets=4)


def test_observed_counts_equal_the_contracts_on_the_written_tables(spark, built):
    ws, paths = built
    rows = spark.read.parquet(paths["dq_summary"]).collect()
    got = {(r.model, r.check_name): r.violations for r in rows}
    want = {(r.model, r.check_name): r.violations for r in contracts.summary(written_workspace(ws, paths)).collect()}
    assert len(rows) == len(got) and got == want
    assert got["cl_clients", "not_null:client_name"] == 1 and got["ol_unified_ad_metrics", "expression:spend_eur >= 0"] >= 1


def test_monthly_table_is_stored_in_its_order(spark, built, ws_small):
    _, paths = built
    files = sorted(glob.glob(paths["bl_monthly_campaign_cohorts"] + "/part-*.parquet"))
    rows, months = [], []
    for f in files:
        table = pq.read_table(f, columns=business.MONTHLY_ORDER)
        rows += [tuple((v is None, v) for v in r.values()) for r in table.to_pylist()]
        if table.num_rows:
            months.append((table["cohort_month"].to_pylist()[0], table["cohort_month"].to_pylist()[-1]))
    known = [m for m in months if None not in m]
    assert rows == sorted(rows, key=lambda r: [(a, "" if b is None else str(b)) for a, b in r]) and len(rows) > 1000
    assert all(a[1] <= b[0] for a, b in zip(known, known[1:]))


def test_stored_order_in_many_files(spark, ws_small, tmp_path):
    from marginflow.sources.sinks import in_order, write_table
    monthly = business.monthly_campaign_cohorts(ws_small, ordered=False)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(in_order(monthly, business.MONTHLY_ORDER), str(tmp_path / "m"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = sorted(glob.glob(str(tmp_path / "m") + "/part-*.parquet"))
    assert len(files) > 3
    keys = [tuple("" if v is None else str(v) for v in r.values()) for f in files
            for r in pq.read_table(f, columns=business.MONTHLY_ORDER).to_pylist()]
    assert keys == sorted(keys)


def test_daily_allocation_of_bucketed_tables_exchanges_no_facts(spark, built):
    """Facts meet the daily rows without an exchange of theirs: no exchange
    stands between the scans of the bucketed tables and the daily sums, or
    between the facts' scan and the join with them."""
    ws, paths = built
    bucketed = ws.fresh()
    version = paths["ol_unified_ad_metrics"].split("/")[-2]
    for name in ("unified_ad_metrics", "client_projects_with_time"):
        bucketed.seed("model:" + name, spark.table(f"ol_{name}_{version}"))
    bucketed.co_located = True
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = operational._allocated(bucketed)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = out.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Bucketed: true" in plan and rows == spark.read.parquet(paths["ol_unified_ad_metrics"]).count()
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # the lifetime totals (by client), the daily rows that got them, and the
    # facts without a day; never a dated campaign row
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        below = "\n".join(lines[i + 1:i + 4])
        if "Exchange hashpartitioning" in line and "ReusedExchange" not in line and "campaign_id" in lines[i + 1]:
            assert "isnull(report_date" in below, below
    assert exchanges and all(re.match(r"client_id|_of|_all", e) for e in exchanges), exchanges


def test_bucketed_build_gives_the_same_models(spark, built, tmp_path):
    ws, paths = built
    plain = build_all(ws, str(tmp_path / "plain"), run_checks=False)
    for name in ("ol_campaign_profitability", "bl_client_performance_dashboard", "bl_monthly_campaign_cohorts"):
        a, b = spark.read.parquet(paths[name]), spark.read.parquet(plain[name])
        exact = [c for c, t in a.dtypes if t != "double"] + ["revenue_eur"] * (name == "ol_campaign_profitability")
        a, b = ([r for r in x.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in x.dtypes]).collect()] for x in (a, b))
        assert sorted(map(str, a)) == sorted(map(str, b)) and exact


def test_a_hot_client_is_spread_over_the_buckets(spark, tmp_path):
    """A third of the rows on one client: by client and day no bucket gets much
    more than its share."""
    from marginflow.sources.sinks import write_bucketed
    n = 30_000
    facts = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("client_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias("report_date"))
    write_bucketed(facts.repartition(8, "client_id", "report_date"), "hot_bucketed", str(tmp_path / "hot"), ["client_id", "report_date"], 8)
    sizes = [r[0] for r in spark.table("hot_bucketed").groupBy(F.input_file_name()).count().select("count").collect()]
    spark.sql("DROP TABLE hot_bucketed")
    assert len(sizes) == 8 and max(sizes) < 1.5 * n / 8


def test_a_session_stays_on_its_pinned_version(spark, tmp_path):
    out = str(tmp_path / "out")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int"))
    facts = spark.range(900).select("id", day.alias("day"))
    first = publish(spark, out, {"facts": facts, "small": spark.range(3)}, monthly={"facts": "day"})
    pinned = PinnedVersion(spark, out)
    second = publish(spark, out, {"facts": facts.where("id < 10"), "small": spark.range(1)}, monthly={"facts": "day"})
    assert pinned.version == first and PinnedVersion(spark, out).version == first
    assert pinned.table("facts").count() == 900 and pinned.table("small").count() == 3
    pinned.register_views(["facts"], prefix="pinned_")
    assert spark.sql("SELECT count(*) FROM pinned_facts WHERE report_month = DATE'2024-02-01'").first()[0] == 290
    assert pinned.repin() == second and pinned.table("facts").count() == 10
    stored = sorted(glob.glob(first + "/facts/report_month=*"))
    assert len(stored) == 3


def test_months_are_pruned_at_run_time(spark, tmp_path):
    out = str(tmp_path / "out")
    facts = spark.range(9000).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 360).cast("int")).alias("day"))
    publish(spark, out, {"facts": facts}, monthly={"facts": "day"})
    months = spark.range(40).select(F.add_months(F.lit("2024-01-01").cast("date"), (F.col("id") % 12).cast("int")).alias("report_month"),
                                    "id").where("id = 3").select("report_month")
    joined = PinnedVersion(spark, out).table("facts").join(months, "report_month").groupBy("report_month").count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan, plan
    assert [(r[0], r[1]) for r in joined.collect()] == [(dt.date(2024, 4, 1), 750)]
