"""Facts dealt out in bucketed tables: the same rows, and no exchange of facts."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marginflow.plans import activity, business, catalog, context, contracts, operational
from marginflow.plans.context import Workspace
from marginflow.sources import testdata
from marginflow.sources.sinks import Dealing, deal
from tests.conftest import SF_SMALL
from tests.test_plans import conf

FACTS = ["unified_ad_metrics", "client_projects_with_time", "campaign_profitability"]


@pytest.fixture(scope="module")
def dealt(spark):
    """Lookups are too large to broadcast, as at scale."""
    catalog.workspace(spark, SF_SMALL)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}):
        yield Workspace.from_testdata(spark, SF_SMALL, Dealing(buckets=5, writers=2)).staged(
            {m: catalog._STAGES[m] for m in FACTS})


def _rows(df):
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)


def _dealt_anew(df) -> list[str]:
    """Keys of the exchanges through which facts go (any but those of the lookups)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (?:hashpartitioning|rangepartitioning)\(([^)]*)\)[^\n]*\n(?:[^\n]*(?:Aggregate|Project|Filter|Sort|Scan parquet spark_catalog|ColumnarToRow|Codegen)[^\n]*\n)*?[^\n]*Scan parquet spark_catalog[^\n]*dealt_", plan)


@pytest.mark.parametrize("model", [
    operational.unified_ad_metrics, operational.client_projects_with_time, operational.campaign_profitability,
    business.client_performance_dashboard, lambda ws: business.monthly_campaign_cohorts(ws, ordered=False),
    business.resource_utilization, activity.client_activity, contracts.summary])
def test_dealt_models_have_the_same_rows(dealt, ws_small, model):
    # fresh: a plan of ws_small that has run would show other tests both its stages
    assert _rows(model(dealt)) == _rows(model(ws_small.fresh()))


@pytest.mark.parametrize("model", [
    business.client_paid_blended, business.campaign_monthly, business.resource_utilization, operational._allocated])
def test_dealt_facts_need_no_exchange(dealt, model):
    df = model(dealt)
    assert "Scan parquet spark_catalog" in df._jdf.queryExecution().executedPlan().toString()
    assert _dealt_anew(df) == []


def test_deal_keeps_rows_and_bounds_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 16).select(F.when(F.col("id") % 7 > 0, F.col("id") % 50).cast("string").alias("k"), "id")
    out = deal(spark, df, "k", Dealing(buckets=4, writers=3), "some-rows")
    assert _rows(out) == _rows(df)
    assert out.select(F.input_file_name()).distinct().count() <= 12
    assert "Exchange" not in out.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()


def test_small_tables_are_not_dealt(spark, monkeypatch):
    assert catalog.dealing(spark, SF_SMALL).dealing is None
    monkeypatch.setattr(catalog, "DEAL_FROM_BYTES", 0)
    with conf(spark, **{"spark.sql.requireAllClusterKeysForCoPartition": "true"}):
        assert catalog.dealing(spark, SF_SMALL).dealing is not None


def test_tables_in_folders_are_dealt_by_the_size_of_their_files(spark, tmp_path, monkeypatch):
    """Spark writes a table as a folder, whose own length says nothing of its files."""
    parts = {t: 3 if t in ("orders", "lineitem", "events") else 1 for t in testdata.TABLES}
    for t, n in parts.items():
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").repartition(n).write.parquet(f"{tmp_path}/{t}.parquet")
    size = sum(p.stat().st_size for p in Path(tmp_path).rglob("part-*.parquet"))
    found = sum(n for _, n in testdata.TestTables(spark, str(tmp_path)).state())
    assert size <= found < size + 1000  # the writer's markers
    monkeypatch.setattr(catalog, "DEAL_FROM_BYTES", size // 2)
    with conf(spark, **{"spark.sql.requireAllClusterKeysForCoPartition": "true"}):
        assert catalog.dealing(spark, str(tmp_path)).dealing is not None
    monkeypatch.setattr(catalog, "DEAL_FROM_BYTES", 2 * size)
    assert catalog.dealing(spark, str(tmp_path)).dealing is None


def test_activity_words_are_grouped_where_the_facts_were_dealt(spark, dealt, ws_small):
    ws = Workspace.from_testdata(spark, SF_SMALL, Dealing(buckets=5, writers=2))  # nothing stored before
    plan = activity.activity_words(ws)._jdf.queryExecution().executedPlan().toString()
    assert "dealt_activity_facts" in plan and "Exchange" not in plan, plan
    plan = activity.client_activity(ws)._jdf.queryExecution().executedPlan().toString()
    assert "dealt_activity_words" in plan and "Exchange" not in plan, plan
    assert _rows(activity.client_activity(ws)) == _rows(activity.client_activity(ws_small.fresh()))


def test_contracts_store_sums_only(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(catalog, "dealing", lambda *a: Recorder())

    class Recorder:
        def staged(self, models):
            stored.extend(models)
            raise StopIteration
    for name in ("dq_summary", "dq_not_null", "dq_unique_combination", "dq_relationships", "dq_expression_range",
                 "dq_violating_rows", "dq_profit_consistency", "internal_cost_allocation", "dq_allocation_reconciliation"):
        with pytest.raises(StopIteration):
            catalog.QUERIES[name](spark, SF_SMALL)
    assert set(stored) == {"unified_sums", "client_projects_with_time"}


def test_stored_sums_give_every_model(spark, ws_small):
    ws = ws_small.fresh().staged({m: catalog._STAGES[m] for m in catalog._FACTS})
    for model in (operational.unified_ad_metrics, business.client_paid_blended, operational.campaign_profitability):
        df = model(ws)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "unified_sums-" in plan and "lineitem" not in plan, plan
        assert _rows(df) == _rows(model(ws_small.fresh()))


def test_dealt_media_rows_hold_no_derived_column(spark, dealt, ws_small):
    ws = Workspace.from_testdata(spark, SF_SMALL, Dealing(buckets=5, writers=2))
    table = business.media_rows(ws)
    stored = re.search(r"dealt_media_rows_\w+", table._jdf.queryExecution().executedPlan().toString()).group()
    assert spark.table(stored).columns == business.SPEND_COLUMNS
    assert _rows(table) == _rows(business.media_rows(ws_small.fresh()))


def test_bucket_holds_as_much_at_every_size(spark, monkeypatch):
    """What one task holds doesn't grow from 0.1 GB (where buckets follow the cores) to 6 GB."""
    made = {}
    monkeypatch.setattr(Workspace, "from_testdata", lambda s, d, how=None: made.setdefault(d, how))
    for mb in (96, 960, 5760):
        monkeypatch.setattr(catalog, "workspace", lambda s, d, mb=mb: type("W", (), {"state": ((0, mb << 20),)}))
        with conf(spark, **{"spark.sql.requireAllClusterKeysForCoPartition": "true"}):
            catalog.dealing(spark, str(mb))
    assert all((int(mb) << 20) / how.buckets <= 8 << 20 for mb, how in made.items()), made


def test_files_of_a_bucket_do_not_multiply_with_the_tables(spark, monkeypatch):
    """Files stay large enough at 1 GB (small ones compress badly), and a writer meets few buckets."""
    made = {}
    monkeypatch.setattr(Workspace, "from_testdata", lambda s, d, how=None: made.setdefault(d, how))
    for mb in (960, 5760):
        monkeypatch.setattr(catalog, "workspace", lambda s, d, mb=mb: type("W", (), {"state": ((0, mb << 20),)}))
        with conf(spark, **{"spark.sql.requireAllClusterKeysForCoPartition": "true"}):
            catalog.dealing(spark, str(mb))
    assert (960 << 20) / (made["960"].buckets * made["960"].writers) >= 1 << 17, made
    assert all(how.buckets / how.writers <= 6 for how in made.values()), made


def test_contracts_deal_each_fact_out_once_per_lookup(spark, monkeypatch):
    """Client time and utilisation share their rows; facts meet order, campaign,
    employee, project and client without an exchange."""
    dealings, moved = [], {}

    def recorded(s, df, key, how, name):
        dealings.append((name, key))
        moved[name, key] = _dealt_anew(df)
        return deal(s, df, key, how, name)
    monkeypatch.setattr(context, "deal", recorded)
    monkeypatch.setattr(catalog, "DEAL_FROM_BYTES", 0)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "true"}):
        catalog.QUERIES["dq_unique_combination"](spark, SF_SMALL)
    assert sorted(d for d in dealings if d[0] != "parent-keys") == [
        ("ad-facts", "client_id"), ("client_projects_with_time", "client_id"), ("lines", "order_id"), ("lines", "order_id"),
        ("unified_sums", "client_id"), ("work-facts", "_fact_key"), ("work-facts", "_fact_key"), ("work-facts", "client_id")]
    assert not any(moved.values()), moved


def test_a_writer_holds_few_buckets_at_every_size(spark, monkeypatch):
    """A writing task adds up the memory of its buckets."""
    made = {}
    monkeypatch.setattr(Workspace, "from_testdata", lambda s, d, how=None: made.setdefault(d, how))
    for mb in (96, 960, 5760):
        monkeypatch.setattr(catalog, "workspace", lambda s, d, mb=mb: type("W", (), {"state": ((0, mb << 20),)}))
        with conf(spark, **{"spark.sql.requireAllClusterKeysForCoPartition": "true"}):
            catalog.dealing(spark, str(mb))
    assert all(how.buckets / how.writers <= 4 for how in made.values()), made


def test_entries_without_an_employee_keep_their_rows_when_dealt(spark):
    """They are dealt by a hash, not in one bucket, and match no employee."""
    def rows(dealing):
        ws = Workspace.from_testdata(spark, SF_SMALL, dealing)
        entries = ws.cl("time_tracking")
        ws.seed("cl:time_tracking", entries.withColumn("employee_id", F.when(F.col("hours_worked") > 2, F.col("employee_id"))))
        return operational.work_facts(ws)
    plain, dealt = rows(None), rows(Dealing(buckets=5, writers=2))
    assert _rows(dealt) == _rows(plain)
    assert plain.where("employee_id IS NULL").count() > 0 == plain.where("employee_id IS NULL AND employee_name IS NOT NULL").count()
