"""Generic contract checks and their NULL semantics."""

from pyspark.sql import functions as F

from marginflow.operators.quality import (Contract, Relationship, contract_summary,
                                          relationships, unique_combination)


def _frame(spark):
    return spark.createDataFrame([
        ("a", "x", 1.0), ("a", "x", 2.0), (None, "y", -1.0), (None, "y", None), ("b", None, 0.5),
    ], "k string, p string, v double")


def test_combination_groups_nulls(spark):
    df = _frame(spark)
    # NULL groups together in a combination check
    dups = {(r.k, r.p): r.row_count for r in unique_combination(df, ["k", "p"]).collect()}
    assert dups == {("a", "x"): 2, (None, "y"): 2}


def test_relationships_ignore_null_children(spark):
    child = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    parent = spark.createDataFrame([("1",)], "id string")
    got = [r.k for r in relationships(child, "k", parent, "id").collect()]
    assert got == ["2"]


def test_contract_summary(spark):
    df = _frame(spark)
    parent = spark.createDataFrame([("a",)], "id string")
    c = Contract(model="m", unique=[["k", "p"]], not_null=["k", "p"],
                 expressions={"v >= 0": F.col("v") >= 0},
                 violations={"neg": F.col("v") < 0},
                 relationships=[Relationship("k", parent, "id")])
    got = {r.check_name: r.violations for r in contract_summary(df, c).collect()}
    assert got == {"not_null:k": 2, "not_null:p": 1, "expression:v >= 0": 1, "singular:neg": 1,
                   "unique_combination:k,p": 2, "relationships:k": 1}


def test_single_key_unique_ignores_nulls(spark):
    df = _frame(spark)
    c = Contract(model="m", unique=[["k"], ["p"]])
    got = {r.check_name: r.violations for r in contract_summary(df, c).collect()}
    assert got == {"unique:k": 1, "unique:p": 2}
    nulls = spark.createDataFrame([(None,), (None,), ("x",)], "k string")
    assert [r.violations for r in contract_summary(nulls, Contract(model="m", unique=[["k"]])).collect()] == [0]


def test_contract_predicates_are_columns_or_sql(spark):
    """A rounding predicate is used as declared, whatever its text begins with."""
    from marginflow.functions import r2
    from marginflow.plans.contracts import column_of
    df = spark.createDataFrame([(-0.004,), (-1.0,), (2.0,)], "media_only_profit_eur double")
    assert df.where(column_of("round(media_only_profit_eur, 2) < 0")).count() == 1
    assert df.where(column_of(lambda: r2("media_only_profit_eur") < 0)).count() == 1


def test_dirty_rows_reach_every_empty_report(spark):
    """The checks that find nothing in the test tables find planted rows."""
    import datetime as dt

    from marginflow.plans import analysis, catalog, contracts
    from marginflow.plans.context import Workspace
    from tests.conftest import SF_SMALL
    ws = Workspace.from_testdata(spark, SF_SMALL)

    def planted(key, model, **dirty):
        clean = model(ws)
        rows = clean.limit(1)
        bad = rows.withColumns({c: F.lit(v).cast(clean.schema[c].dataType) for c, v in dirty.items()})
        ws.seed(key, clean.limit(2).unionByName(bad).unionByName(bad))

    from marginflow.plans import business, operational
    day = dt.date(2024, 1, 1)
    planted("model:campaign_profitability", operational.campaign_profitability, media_only_profit_eur=1.0,
            revenue_eur=0.0, ad_spend_eur=5.0)
    planted("model:client_performance_dashboard", business.client_performance_dashboard, total_ad_spend_eur=-1.0,
            platform=None)
    planted("model:monthly_campaign_cohorts", lambda w: business.monthly_campaign_cohorts(w, ordered=False),
            monthly_ad_spend_eur=-1.0, platform=None, cohort_month=day)
    planted("model:resource_utilization", business.resource_utilization, total_hours=-1.0, employee_id=None)
    for name, report in {
        "dq_grain_dashboard": catalog._dq_grain_of("bl_client_performance_dashboard"),
        "dq_grain_utilization": catalog._dq_grain_of("bl_resource_utilization"),
        "dq_grain_monthly": catalog._dq_grain_of("bl_monthly_campaign_cohorts"),
        "dq_profit_consistency": lambda w: contracts.violating_rows(w, "ol_campaign_profitability", "profit_consistency"),
        "dq_monthly_negative": lambda w: contracts.violating_rows(
            w, "bl_monthly_campaign_cohorts", "no_negative_spend_or_revenue"),
        "an_dashboard_negative": analysis.dashboard_negative,
        "an_dashboard_missing_dims": analysis.dashboard_missing_dims,
        "an_monthly_negative": analysis.monthly_negative,
        "an_monthly_missing_keys": analysis.monthly_missing_keys,
        "an_monthly_duplicate_grain": analysis.monthly_duplicate_grain,
        "an_utilization_negative": analysis.utilization_negative,
        "an_utilization_missing_ids": analysis.utilization_missing_ids,
    }.items():
        assert report(ws).count() >= 1, name
