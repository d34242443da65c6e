"""Facts dealt out where buckets x writers would leave too many files: by exchanges, few of them kept in files."""

import pytest
from pyspark.sql import functions as F

from marginflow.plans import activity, business, catalog, context, contracts, operational
from marginflow.plans.context import Workspace
from marginflow.sources import sinks
from marginflow.sources.sinks import Dealing, deal
from tests.conftest import SF_SMALL
from tests.test_dealing import _rows
from tests.test_plans import conf


@pytest.fixture
def large(spark, monkeypatch):
    """Every dealing has more files than it may leave, and lookups are too large to broadcast."""
    monkeypatch.setattr(sinks, "MOST_FILES", 0)
    catalog.workspace(spark, SF_SMALL)
    with conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}):
        yield Workspace.from_testdata(spark, SF_SMALL, Dealing(buckets=5, writers=2))


def _some(spark, parts=24):
    return spark.range(0, 2400, 1, parts).select(F.when(F.col("id") % 7 > 0, F.col("id") % 500).cast("string").alias("k"), "id")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _files(df) -> int:
    return df.select(F.input_file_name()).distinct().count()


def test_rows_go_through_one_exchange_instead_of_too_many_files(spark, monkeypatch):
    monkeypatch.setattr(sinks, "MOST_FILES", 11)
    df = _some(spark)
    out = deal(spark, df, "k", Dealing(buckets=4, writers=3), "some-rows")
    assert "dealt_some_rows" not in _plan(out)
    assert _plan(out.groupBy("k").count()).count("Exchange") == 1
    assert _rows(out) == _rows(df)
    monkeypatch.setattr(sinks, "MOST_FILES", 12)
    assert "dealt_some_rows" in _plan(deal(spark, df, "k", Dealing(buckets=4, writers=3), "some-rows"))


def test_kept_rows_do_not_leave_buckets_x_writers_files(spark, monkeypatch):
    monkeypatch.setattr(sinks, "MOST_FILES", 0)
    cores = spark.sparkContext.defaultParallelism
    n = 3 * cores
    df = _some(spark, n)
    out = deal(spark, df, "k", Dealing(buckets=n, writers=n, keep=True), "some-rows")
    assert _rows(out) == _rows(df)
    assert _files(out) <= n * max(cores, n // sinks.BUCKETS_A_WRITER) < n * n


def test_placed_rows_have_a_file_per_bucket(spark, large):
    df = _some(spark).repartition(6, "k")
    out = deal(spark, df, "k", Dealing(buckets=6, writers=6, keep=True, placed=True), "some-rows")
    assert _files(out) == 6 and _rows(out) == _rows(df)
    assert _plan(deal(spark, df, "k", Dealing(buckets=6, writers=6, placed=True), "some-rows")) == _plan(df)


def test_files_at_6_gb_do_not_grow_with_buckets_x_writers(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(Workspace, "from_testdata", lambda s, d, how=None: made.setdefault(d, how))
    for mb in (96, 960, 5760):
        monkeypatch.setattr(catalog, "workspace", lambda s, d, mb=mb: type("W", (), {"state": ((0, mb << 20),)}))
        with conf(spark, **{"spark.sql.requireAllClusterKeysForCoPartition": "true"}):
            catalog.dealing(spark, str(mb))
    # as before up to 1 GB
    assert [made[str(mb)].fits for mb in (96, 960, 5760)] == [True, True, False]


@pytest.mark.parametrize("model", [
    business.client_performance_dashboard, business.monthly_campaign_cohorts, business.resource_utilization,
    activity.client_activity])
def test_exchanged_models_have_the_same_rows(large, ws_small, model):
    assert _rows(model(large)) == _rows(model(ws_small.fresh()))


@pytest.mark.parametrize("model", [operational.campaign_profitability, contracts.summary])
def test_staged_models_have_the_same_rows(large, ws_small, model):
    stages = {m: catalog._STAGES[m] for m in catalog._FACTS}
    assert _rows(model(large.staged(stages))) == _rows(model(ws_small.fresh()))


def test_a_query_has_few_exchanges_and_keeps_what_it_reads_twice(spark, large, monkeypatch):
    found = []

    def recorded(s, df, key, how, name):
        found.append((name, key, how.keep, how.placed))
        return deal(s, df, key, how, name)
    monkeypatch.setattr(context, "deal", recorded)
    monkeypatch.setattr(catalog, "dealing", lambda *a: large)
    catalog.QUERIES["dq_unique_combination"](spark, SF_SMALL)
    facts = [f for f in found if f[0] != "parent-keys"]
    assert sum(not (keep or placed) for *_, keep, placed in facts) == context.MOST_EXCHANGES
    assert ("work-facts", "client_id", True, False) in facts
    assert {f for f in facts if f[3]} == {(m, "client_id", True, True) for m in catalog._FACTS}


def test_monthly_sums_are_put_in_order_without_the_kpis(spark, ws_small):
    top = business.monthly_campaign_cohorts(ws_small.fresh())._jdf.queryExecution().optimizedPlan()
    below = top.children().head()
    assert (top.nodeName(), below.nodeName()) == ("Project", "Sort")
    assert "monthly_roas" in top.output().mkString() and "monthly_roas" not in below.output().mkString()
    rows = business.monthly_campaign_cohorts(ws_small.fresh()).select(*business.MONTHLY_ORDER).collect()
    assert rows == sorted(rows, key=lambda r: tuple((v is None, v) for v in r))
