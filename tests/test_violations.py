"""Violating rows, reconciliation and mergeable counts on hand-made frames."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marginflow.operators.allocation import allocate_two_tier
from marginflow.operators.bitmaps import bit_words, count_words, merge_words, numbered, text_word, word_of
from marginflow.operators.quality import Contract, Relationship, contract_summary, tag_violations, violating_keys
from marginflow.operators.reconciliation import reconcile
from marginflow.plans import business, contracts, operational
from marginflow.plans.context import Workspace
from marginflow.plans.reconciliation import allocation_reconciliation
from marginflow.sources.sinks import materialize
from tests.conftest import SF_SMALL

ROWS = [("a", "x", 1.0), ("a", "x", -2.0), ("a", "x", -3.0), (None, "y", -1.0), (None, "y", None), ("b", None, 0.5), ("c", "z", 2.0)]


@pytest.fixture(scope="module")
def dirty(spark):
    df = spark.createDataFrame(ROWS, "k string, p string, v double")
    parent = spark.createDataFrame([("a",), ("a",), ("c",)], "id string")
    return df, Contract(model="m", unique=[["k", "p"], ["p"]], not_null=["k", "p"], expressions={"v >= 0": F.col("v") >= 0},
                        violations={"neg": F.col("v") < 0}, relationships=[Relationship("k", parent, "id")],
                        reported=[Relationship("p", parent, "id")])


def test_rows_are_tagged_with_every_check_they_fail(dirty):
    df, contract = dirty
    got = sorted((str(r.k), str(r.p), str(r.v), tuple(r.failed_checks)) for r in tag_violations(df, contract).collect())
    neg = ("expression:v >= 0", "singular:neg")
    assert got == sorted([("a", "x", "-2.0", neg), ("a", "x", "-3.0", neg), ("None", "y", "-1.0", ("not_null:k", *neg)),
                          ("None", "y", "None", ("not_null:k",)), ("b", "None", "0.5", ("not_null:p", "relationships:k"))])
    assert tag_violations(df, contract).columns == [*df.columns, "failed_checks"]


def test_failing_keys_add_up_to_the_summary(dirty):
    df, contract = dirty
    rows = violating_keys(df, contract).collect()
    keys = {(r.check_name, r.key): r.violations for r in rows}
    ax, ny = '{"k":"a","p":"x"}', '{"k":null,"p":"y"}'
    assert keys == {("not_null:k", ny): 2, ("not_null:p", '{"k":"b","p":null}'): 1, ("expression:v >= 0", ax): 2,
                    ("expression:v >= 0", ny): 1, ("singular:neg", ax): 2, ("singular:neg", ny): 1,
                    ("relationships:k", '{"k":"b","p":null}'): 1, ("unique_combination:k,p", ax): 1,
                    ("unique_combination:k,p", ny): 1, ("unique:p", '{"p":"x"}'): 1, ("unique:p", '{"p":"y"}'): 1}
    totals = {}
    for r in rows:
        totals[r.check_name] = totals.get(r.check_name, 0) + r.violations
    assert totals == {r.check_name: r.violations for r in contract_summary(df, contract).collect() if r.violations}
    with_reported = {r.check_name for r in violating_keys(df, contract, reported=True).collect()}
    assert with_reported - set(totals) == {"reported:relationships:p"}


def test_contract_without_grain_or_rows(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", None)], "k string, v double")
    rows = violating_keys(df, Contract(model="m", not_null=["k", "v"])).collect()
    assert sorted((r.check_name, r.key, r.violations) for r in rows) == [("not_null:k", "{}", 1), ("not_null:v", "{}", 1)]
    assert violating_keys(df.limit(0), Contract(model="m", unique=[["k"]], not_null=["k"])).count() == 0


def planted_workspace(spark):
    """Business models with dirty rows in every column that a check reads."""
    ws = Workspace.from_testdata(spark, SF_SMALL)

    def plant(key, model, **values):
        rows = model(ws)
        clean = materialize(spark, rows.orderBy(*rows.columns), "clean")  # the same first rows whatever the plan
        bad = clean.limit(1).withColumns({c: F.lit(v).cast(clean.schema[c].dataType) for c, v in values.items()})
        ws.seed(key, materialize(spark, clean.limit(5).unionByName(bad).unionByName(bad), "dirty"))

    plant("model:unified_ad_metrics", operational.unified_ad_metrics, spend_eur=-1.0, campaign_id="no such campaign", report_date=None)
    plant("model:campaign_profitability", operational.campaign_profitability, media_only_profit_eur=1.0, revenue_eur=-1.0, ad_spend_eur=-5.0)
    plant("model:client_performance_dashboard", business.client_performance_dashboard, total_ad_spend_eur=-1.0,
          total_revenue_eur=-1.0, platform=None)
    plant("model:monthly_campaign_cohorts", lambda w: business.monthly_campaign_cohorts(w, ordered=False),
          monthly_ad_spend_eur=-1.0, platform=None, client_id="nobody")
    plant("model:resource_utilization", business.resource_utilization, total_hours=-1.0, employee_id=None, n_work_days=0,
          utilization_rate_billable_hours=1.5, project_id="P?")
    return ws


def test_contracts_list_the_planted_keys(spark):
    ws = planted_workspace(spark)
    found, counts = {}, {}
    for r in contracts.violating_grain_keys(ws).collect():
        found.setdefault((r.model, r.check_name), []).append(json.loads(r.key))
        counts[r.model, r.check_name] = counts.get((r.model, r.check_name), 0) + r.violations
    for r in contracts.summary(ws).collect():
        assert counts.get((r.model, r.check_name), 0) == r.violations, r
    assert {c for m, c in found if m == "bl_resource_utilization"} >= {
        "not_null:employee_id", "expression:total_hours >= 0", "expression:n_work_days >= 1",
        "expression:utilization_rate_billable_hours between 0 and 1", "reported:relationships:project_id",
        "unique_combination:employee_id,client_id,project_id"}
    assert found["bl_monthly_campaign_cohorts", "relationships:client_id"][0]["client_id"] == "nobody"
    assert counts["ol_campaign_profitability", "singular:profit_consistency"] == 2
    tagged = contracts.tagged_rows(ws, "bl_monthly_campaign_cohorts").collect()
    assert len(tagged) == 2 and set(tagged[0].failed_checks) == {
        "not_null:platform", "expression:monthly_ad_spend_eur >= 0", "singular:no_negative_spend_or_revenue", "relationships:client_id"}


def test_failing_keys_scan_a_model_once(spark, ws_small):
    table = materialize(spark, operational.unified_ad_metrics(ws_small), "scanned-once")
    ws = Workspace.from_testdata(spark, SF_SMALL)
    ws.seed("model:unified_ad_metrics", table)
    plan = contracts.violating_grain_keys(ws, ["ol_unified_ad_metrics"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("scanned-once") == 1 and "Window" not in plan


# -- reconciliation ---------------------------------------------------------------

def test_reconcile_keeps_groups_of_either_side_and_null_keys(spark):
    left = spark.createDataFrame([("a", 1, 10.0), ("b", None, 5.0), (None, 1, 2.0), ("c", 1, None)], "k string, d int, x double")
    right = spark.createDataFrame([("a", 1, 4.0), ("a", 1, 6.0 + 1e-9), ("b", None, 4.0), ("z", 3, 1.0), ("c", 1, 0.0)],
                                  "k string, d int, y double")
    got = {(r.k, r.d): (r.expected, r.actual and round(r.actual, 6), round(r.difference, 6), r.reconciled)
           for r in reconcile(left, right, ["k", "d"], "x", "y").collect()}
    assert got == {("a", 1): (10.0, 10.0, 0.0, True), ("b", None): (5.0, 4.0, -1.0, False), (None, 1): (2.0, None, -2.0, False),
                   ("z", 3): (None, 1.0, 1.0, False), ("c", 1): (None, 0.0, 0.0, False)}


def test_allocation_tiers_reconcile(spark, ws_small):
    rows = allocation_reconciliation(ws_small).collect()
    tiers = {t: [r for r in rows if r.tier == t] for t in ("daily", "lifetime", "withheld", "unmet")}
    assert all(tiers.values()) and not any(r.violation for r in rows)
    assert all(r.reconciled and r.difference_eur == 0 for t in ("daily", "lifetime", "withheld") for r in tiers[t])
    assert all(r.allocated_cost_eur is None and r.difference_eur == -r.expected_cost_eur for r in tiers["unmet"])


def test_every_tier_of_a_small_ledger(spark):
    """A: cost on one of two spend days (mixed).  B: cost on no spend day
    (lifetime).  C: a spend day without cost is none of C's; its other cost day
    has no ad row (unmet).  D: zero spend on the cost day (withheld)."""
    d = [dt.date(2024, 1, k) for k in range(1, 5)]
    facts = spark.createDataFrame([
        ("A", "c1", d[0], 30.0), ("A", "c2", d[0], 10.0), ("A", "c1", d[1], 60.0), ("B", "c3", d[0], 25.0), ("B", "c3", None, 75.0),
        ("C", "c4", d[0], 10.0), ("D", "c5", d[0], 0.0), (None, "c6", d[0], 5.0)],
        "client_id string, campaign_id string, report_date date, ad_spend_eur double").withColumns(
        {"platform": F.lit("p"), "attribution_window": F.lit("w")})
    costs = spark.createDataFrame([("A", d[0], 100.0), ("B", d[3], 80.0), ("C", d[0], 7.0), ("C", d[2], 9.0), ("D", d[0], 4.0),
                                   (None, d[0], 1.0)], "client_id string, report_date date, client_internal_cost_eur double")
    weights = facts.groupBy("client_id", "report_date").agg(F.sum("ad_spend_eur").alias("client_total_spend_eur"))
    for co_located in (False, True):
        ws = Workspace(spark, {})
        ws.seed("model:client_day_ad_spend", weights)
        ws.seed("model:client_day_internal_cost", costs)
        ws.seed("model:allocated", allocate_two_tier(facts, weights, costs, co_located=co_located))
        got = {(r.tier, r.client_id, r.report_date): (r.expected_cost_eur, r.allocated_cost_eur, r.difference_eur, r.violation)
               for r in allocation_reconciliation(ws).collect()}
        assert got == {("daily", "A", d[0]): (100.0, 100.0, 0.0, False), ("mixed", "A", None): (100.0, 160.0, 60.0, False),
                       ("lifetime", "B", None): (80.0, 80.0, 0.0, False), ("daily", "C", d[0]): (7.0, 7.0, 0.0, False),
                       ("unmet", "C", d[2]): (9.0, None, -9.0, False), ("withheld", "D", d[0]): (0.0, 0.0, 0.0, False)}


def test_a_wrong_allocation_is_a_violation(spark, ws_small):
    """A row that gets a cent too much, and a day whose cost nobody gets."""
    ws = Workspace.from_testdata(spark, SF_SMALL)
    right = materialize(spark, operational._allocated(ws), "allocated")
    day = right.where("client_internal_cost_eur > 0 AND client_total_spend_eur > 0 AND ad_spend_eur > 0").select(
        "client_id", "report_date").orderBy("client_id", "report_date").first()
    other = right.where((F.col("client_internal_cost_eur") > 0) & (F.col("client_total_spend_eur") > 0) & (F.col("client_id") != day.client_id)
                        ).select("client_id", "report_date").orderBy(F.desc("client_id"), "report_date").first()
    hit = (F.col("client_id") == day.client_id) & (F.col("report_date") == day.report_date)
    gone = (F.col("client_id") == other.client_id) & (F.col("report_date") == other.report_date)
    wrong = right.where(~gone).withColumn("internal_cost_eur", F.when(hit, F.col("internal_cost_eur") + 0.01).otherwise(F.col("internal_cost_eur")))
    ws.seed("model:client_day_ad_spend", materialize(spark, operational.client_day_ad_spend(ws), "weights"))
    ws.seed("model:client_day_internal_cost", materialize(spark, operational.client_day_internal_cost(ws), "costs"))
    ws.seed("model:allocated", wrong)
    bad = {(r.client_id, r.report_date): r for r in allocation_reconciliation(ws).collect() if r.violation}
    assert set(bad) == {(day.client_id, day.report_date), (other.client_id, other.report_date)}
    assert bad[other.client_id, other.report_date].allocated_cost_eur is None


# -- mergeable counts --------------------------------------------------------------

def test_words_roll_up_to_exact_distinct_counts(spark):
    import random
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.choice("xy"), dt.date(1969, 12, 1) + dt.timedelta(rng.randrange(400)),
             rng.choice([None, *map(str, range(300)), "no number"])) for _ in range(4000)]
    rows += [("d", "x", None, None), (None, "x", dt.date(2024, 1, 1), "5")]
    df = spark.createDataFrame(rows, "k string, p string, day date, id string")
    masters = spark.createDataFrame([(str(i), "o%d" % (i % 7)) for i in range(300)], "id string, owner string")
    position = materialize(spark, numbered(masters, "id", ["owner"]), "numbers")
    assert position.count() == position.select("position").distinct().count() == 300
    slot, word = text_word(F.col("id"))
    words = bit_words(df.join(position, "id", "left"), ["k", "p"], {
        "day": word_of(F.unix_date("day")), "id": word_of(F.col("position")),
        "unknown": (slot, F.when(F.col("position").isNull(), word))})
    for keys in (["k", "p"], ["k"], []):
        words = merge_words(words, keys)
        got = {tuple(r)[:len(keys)]: (r.days, r.ids) for r in count_words(words, keys, {"days": ["day"], "ids": ["id", "unknown"]}).collect()}
        want = df.groupBy(*keys).agg(F.countDistinct("day").alias("days"), F.countDistinct("id").alias("ids")).where("days + ids > 0")
        assert got == {tuple(r)[:len(keys)]: (r.days, r.ids) for r in want.collect()}


def test_activity_reads_the_facts_once(spark, ws_small):
    from marginflow.plans.activity import activity_words, client_activity
    plan = activity_words(ws_small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1
    levels = client_activity(ws_small)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem" not in levels and "Expand" not in plan
