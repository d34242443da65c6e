"""Allocation invariants on random frames (property-based)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marginflow.operators.allocation import AllocationColumns, allocate_two_tier, daily_sum

COLS = AllocationColumns()
DAYS = [dt.date(2024, 1, d) for d in range(1, 5)]

fact = st.tuples(st.sampled_from("ABC"), st.sampled_from(DAYS), st.sampled_from(["1d", "7d"]),
                 st.integers(0, 40).map(float))
cost = st.tuples(st.sampled_from("ABCD"), st.sampled_from(DAYS), st.integers(1, 16).map(lambda x: x / 8))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(fact, min_size=1, max_size=25), st.lists(cost, max_size=12))
def test_day_costs_reconcile_and_no_rows_change(spark, facts, costs):
    f = spark.createDataFrame(facts, "client_id string, report_date date, w string, ad_spend_eur double")
    c = spark.createDataFrame(costs, "client_id string, report_date date, total_cost_eur double")
    out = allocate_two_tier(
        f, daily_sum(f, "client_id", "report_date", "ad_spend_eur", COLS.day_weight),
        daily_sum(c, "client_id", "report_date", "total_cost_eur", COLS.day_cost))
    rows = out.collect()
    assert len(rows) == len(facts)                       # allocation never adds or drops rows
    day_cost = {}
    for k, d, x in costs:
        day_cost[(k, d)] = day_cost.get((k, d), 0.0) + x
    by_day = {}
    for r in rows:
        if r.internal_cost_eur is not None and r.client_internal_cost_eur is not None:
            by_day[(r.client_id, r.report_date)] = by_day.get((r.client_id, r.report_date), 0.0) + r.internal_cost_eur
        if r.client_internal_cost_eur is not None and not (r.client_total_spend_eur or 0) > 0:
            assert r.internal_cost_eur is None               # invariant 4: cost day without spend
    for key, total in by_day.items():                        # invariant 1
        assert abs(total - day_cost[key]) <= 1e-9 * max(1.0, day_cost[key])
    clients_with_cost = {k for k, _, _ in costs}
    for client in {r.client_id for r in rows}:
        mine = [r for r in rows if r.client_id == client]
        if client not in clients_with_cost:
            assert all(r.internal_cost_eur is None for r in mine)
        elif all(r.client_internal_cost_eur is None for r in mine) and sum(r.ad_spend_eur for r in mine) > 0:
            total = sum(x for k, _, x in costs if k == client)   # invariant 2
            got = sum(r.internal_cost_eur for r in mine)
            assert abs(got - total) <= 1e-9 * max(1.0, total)
