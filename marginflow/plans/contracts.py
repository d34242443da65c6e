"""Data-quality contracts of the cleansed, operational and business models.

Declared once as data; ``to_contract`` turns a declaration into Spark checks
(operators.quality).  A row-level predicate is SQL expression text that Spark
parses, or a function that builds the Column where Spark's SQL function
differs from the meaning of the check (rounding).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginflow.functions.numeric import r2
from marginflow.operators.quality import (Contract, Relationship, contract_summary, tag_violations,
                                          violating_keys)
from marginflow.plans import business, operational
from marginflow.plans.context import Workspace


Predicate = str | Callable[[], Column]


@dataclass
class ContractSpec:
    model: str
    unique: list[list[str]] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    # name -> predicate that must be true (NULL passes)
    expressions: dict[str, Predicate] = field(default_factory=dict)
    # name -> predicate selecting violating rows (singular tests)
    violations: dict[str, Predicate] = field(default_factory=dict)
    # (column, parent model, parent column)
    relationships: list[tuple[str, str, str]] = field(default_factory=list)
    # the same, but listed among the violating rows only (known orphans)
    reported: list[tuple[str, str, str]] = field(default_factory=list)


PROFIT_GRAIN = ["client_id", "campaign_id", "platform", "report_date", "attribution_window"]

CONTRACTS: list[ContractSpec] = [
    ContractSpec("cl_clients", unique=[["client_id"]], not_null=["client_id", "client_name"]),
    ContractSpec("cl_campaigns", unique=[["campaign_id"]], not_null=["campaign_id", "account_id"],
                 relationships=[("account_id", "cl_clients", "client_id")]),
    ContractSpec("cl_employees", unique=[["employee_id"]], not_null=["employee_id"]),
    ContractSpec("cl_projects", unique=[["project_id"]], not_null=["project_id"]),
    ContractSpec("ol_unified_ad_metrics", unique=[PROFIT_GRAIN],
                 not_null=["campaign_id", "report_date"],
                 expressions={"spend_eur >= 0": "spend_eur >= 0"},
                 relationships=[("campaign_id", "cl_campaigns", "campaign_id")]),
    ContractSpec("ol_campaign_profitability", unique=[PROFIT_GRAIN],
                 expressions={"ad_spend_eur >= 0": "ad_spend_eur >= 0",
                              "revenue_eur >= 0": "revenue_eur >= 0"},
                 violations={"profit_consistency": lambda: r2(
                     F.col("media_only_profit_eur") - (F.col("revenue_eur") - F.col("ad_spend_eur"))) != 0}),
    ContractSpec("bl_client_performance_dashboard",
                 unique=[["client_id", "platform", "attribution_window"]],
                 not_null=["client_id", "platform", "attribution_window"],
                 expressions={"total_ad_spend_eur >= 0": "total_ad_spend_eur >= 0",
                              "total_revenue_eur >= 0": "total_revenue_eur >= 0"}),
    ContractSpec("bl_monthly_campaign_cohorts",
                 unique=[["client_id", "platform", "attribution_window", "cohort_month"]],
                 not_null=["client_id", "platform", "attribution_window", "cohort_month"],
                 expressions={"monthly_ad_spend_eur >= 0": "monthly_ad_spend_eur >= 0"},
                 violations={"no_negative_spend_or_revenue":
                             "monthly_ad_spend_eur < 0 OR monthly_revenue_eur < 0"},
                 relationships=[("client_id", "cl_clients", "client_id")]),
    ContractSpec("bl_resource_utilization",
                 unique=[["employee_id", "client_id", "project_id"]],
                 not_null=["employee_id", "client_id"],
                 expressions={
                     "n_work_days >= 1": "n_work_days >= 1",
                     "total_hours >= 0": "total_hours >= 0",
                     "total_cost_eur >= 0": "total_cost_eur >= 0",
                     "avg_hours_per_work_day >= 0": "avg_hours_per_work_day >= 0",
                     "internal_cost_per_hour_eur >= 0": "internal_cost_per_hour_eur >= 0",
                     "utilization_rate_billable_hours between 0 and 1":
                         "utilization_rate_billable_hours BETWEEN 0 AND 1",
                     "utilization_rate_billable_cost between 0 and 1":
                         "utilization_rate_billable_cost BETWEEN 0 AND 1",
                 },
                 relationships=[("client_id", "cl_clients", "client_id")],
                 reported=[("employee_id", "cl_employees", "employee_id"), ("project_id", "cl_projects", "project_id")]),
]
CONTRACT_BY_MODEL = {c.model: c for c in CONTRACTS}


def model_frame(ws: Workspace, model: str) -> DataFrame:
    """The relation a contract applies to."""
    if model.startswith("cl_"):
        return ws.cl(model[3:])
    return {
        "ol_unified_ad_metrics": operational.unified_ad_metrics,
        "ol_client_projects_with_time": operational.client_projects_with_time,
        "ol_campaign_profitability": operational.campaign_profitability,
        "bl_client_performance_dashboard": business.client_performance_dashboard,
        "bl_monthly_campaign_cohorts": lambda w: business.monthly_campaign_cohorts(w, ordered=False),
        "bl_resource_utilization": business.resource_utilization,
    }[model](ws)


def parent_keys(ws: Workspace, model: str, column: str) -> DataFrame:
    """The keys that a relationship looks up, dealt out like its children."""
    return ws.model(f"keys:{model}.{column}", lambda: ws.dealt(
        model_frame(ws, model).select(column).distinct(), column, "parent-keys"))


def column_of(predicate: Predicate) -> Column:
    return predicate() if callable(predicate) else F.expr(predicate)


def to_contract(ws: Workspace, spec: ContractSpec, kinds: set[str] | None = None) -> Contract:
    want = (lambda k: kinds is None or k in kinds)
    expressions = ({n: column_of(s) for n, s in spec.expressions.items()}
                   if want("expression") else {})
    violations = ({n: column_of(s) for n, s in spec.violations.items()}
                  if want("singular") else {})
    def parents(found):
        return [Relationship(c, parent_keys(ws, pm, pc), pc) for c, pm, pc in found]
    return Contract(
        model=spec.model,
        unique=spec.unique if want("unique") else [],
        not_null=spec.not_null if want("not_null") else [],
        expressions=expressions,
        violations=violations,
        relationships=parents(spec.relationships) if want("relationship") else [],
        reported=parents(spec.reported) if want("relationship") else [])


def summary(ws: Workspace, models: list[str] | None = None, kinds: set[str] | None = None) -> DataFrame:
    """(model, check_name, violations) for every selected check."""
    out = None
    for spec in CONTRACTS:
        if models is not None and spec.model not in models:
            continue
        contract = to_contract(ws, spec, kinds)
        if not (contract.unique or contract.not_null or contract.expressions or contract.violations
                or contract.relationships):
            continue
        part = contract_summary(model_frame(ws, spec.model), contract)
        out = part if out is None else out.unionByName(part)
    return out


def violating_grain_keys(ws: Workspace, models: list[str] | None = None) -> DataFrame:
    """(model, check_name, key, violations) of every failing check and grain
    key of the selected models, reported orphans included; one pass per model."""
    out = None
    for spec in CONTRACTS:
        if models is None or spec.model in models:
            part = violating_keys(model_frame(ws, spec.model), to_contract(ws, spec), reported=True)
            out = part if out is None else out.unionByName(part)
    return out


def tagged_rows(ws: Workspace, model: str) -> DataFrame:
    """The model's whole rows that fail a row-level check, with failed_checks."""
    return tag_violations(model_frame(ws, model), to_contract(ws, CONTRACT_BY_MODEL[model]), reported=True)


def violating_rows(ws: Workspace, model: str, name: str) -> DataFrame:
    spec = CONTRACT_BY_MODEL[model]
    return model_frame(ws, model).where(column_of(spec.violations[name]))
