"""Two-tier allocation on hand-made frames (invariants 1-4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marginflow.operators.allocation import (AllocationColumns, allocate_two_tier, allocation_branch,
                                             daily_sum)

D1, D2, D0 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2023, 12, 1)


@pytest.fixture(scope="module")
def allocated(spark):
    facts = spark.createDataFrame([
        # client A: cost on D1 only, spend on D1 and D2, two windows
        ("A", "c1", D1, "1d", 30.0), ("A", "c1", D1, "7d", 10.0),
        ("A", "c2", D1, "1d", 60.0), ("A", "c2", D2, "1d", 40.0),
        # client B: costs only on a day without ad spend -> lifetime fallback
        ("B", "c3", D1, "1d", 25.0), ("B", "c3", D2, "1d", 75.0),
        # client C: no internal cost at all
        ("C", "c4", D1, "1d", 10.0),
        # client D: cost on a day whose spend is zero
        ("D", "c5", D1, "1d", 0.0), ("D", "c5", D2, "1d", 20.0),
        # NULL keys never match a cost
        (None, "c6", D1, "1d", 5.0), ("A", "c7", None, "1d", 50.0),
    ], "client_id string, campaign_id string, report_date date, attribution_window string, ad_spend_eur double")
    costs = spark.createDataFrame([
        ("A", D1, 100.0), ("A", D1, 20.0),
        ("B", D0, 80.0),
        ("D", D1, 9.0),
    ], "client_id string, report_date date, total_cost_eur double")
    cols = AllocationColumns()
    day_weight = daily_sum(facts, "client_id", "report_date", "ad_spend_eur", cols.day_weight)
    day_cost = daily_sum(costs, "client_id", "report_date", "total_cost_eur", cols.day_cost)
    out = allocate_two_tier(facts, day_weight, day_cost)
    return out.withColumn("branch", allocation_branch(cols)).cache()


def _rows(df, **eq):
    cond = None
    for k, v in eq.items():
        c = F.col(k).isNull() if v is None else (F.col(k) == v)
        cond = c if cond is None else cond & c
    return df.where(cond).collect()


def test_day_cost_split_across_campaigns_and_windows(allocated):
    rows = _rows(allocated, client_id="A", report_date=D1)
    assert sum(r.internal_cost_eur for r in rows) == pytest.approx(120.0)
    by = {(r.campaign_id, r.attribution_window): r.internal_cost_eur for r in rows}
    assert by[("c1", "1d")] == pytest.approx(120.0 * 30 / 100)
    assert all(r.branch == "daily" for r in rows)


def test_mixed_client_lifetime_rows_spread_total_cost(allocated):
    # A on D2 has no day cost: lifetime tier spreads the *total* cost (120)
    # by lifetime spend share (40 of 190), although D1 already got all of it.
    (r,) = _rows(allocated, client_id="A", report_date=D2)
    assert r.branch == "lifetime"
    assert r.internal_cost_eur == pytest.approx(120.0 * (40.0 / 190.0))


def test_lifetime_only_client_reconciles(allocated):
    rows = _rows(allocated, client_id="B")
    assert sum(r.internal_cost_eur for r in rows) == pytest.approx(80.0)
    assert {r.branch for r in rows} == {"lifetime"}


def test_client_without_cost_gets_null(allocated):
    (r,) = _rows(allocated, client_id="C")
    assert r.internal_cost_eur is None and r.branch == "no_cost"


def test_cost_day_with_zero_spend_is_null(allocated):
    (r,) = _rows(allocated, client_id="D", report_date=D1)
    assert r.internal_cost_eur is None and r.branch == "cost_day_without_spend"
    # D2 has no day cost but the client has some: the lifetime tier spreads
    # all of it (9) by lifetime spend share (20 of 20).
    (r2,) = _rows(allocated, client_id="D", report_date=D2)
    assert r2.branch == "lifetime" and r2.internal_cost_eur == pytest.approx(9.0)


def test_null_keys(allocated):
    (r,) = _rows(allocated, client_id=None)
    assert r.internal_cost_eur is None and r.client_total_internal_cost_eur is None
    (r,) = _rows(allocated, client_id="A", report_date=None)
    assert r.client_internal_cost_eur is None and r.client_total_spend_eur is None
    assert r.internal_cost_eur == pytest.approx(120.0 * (50.0 / 190.0))


def test_row_count_preserved(allocated):
    assert allocated.count() == 11
