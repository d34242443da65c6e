"""Data-quality contracts as DataFrame checks.

Each check returns the violating rows (empty = pass), with the usual
semantics of declarative data tests:

* ``not_null``                 rows where the column is NULL
* ``unique``                  single key: values occurring more than once; NULLs are ignored
* ``unique_combination``      key groups occurring more than once (NULLs group together)
* ``relationships``           non-NULL child keys without a parent row
* ``expression_is_true``      rows where NOT(expr); a NULL result passes

``tag_violations`` marks the rows of a model with the row-level checks that
they fail; ``violating_keys`` lists the failing grain keys per check and
``contract_summary`` counts them.  All three evaluate every check of a contract
in one pass over the model.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_combination(df: DataFrame, columns: list[str], count_name: str = "row_count") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def unique_name(columns: list[str]) -> str:
    return ("unique:" if len(columns) == 1 else "unique_combination:") + ",".join(columns)


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias(column))
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


@dataclass
class Relationship:
    column: str
    parent: DataFrame
    parent_column: str


@dataclass
class Contract:
    model: str
    unique: list[list[str]] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    expressions: dict[str, Column] = field(default_factory=dict)   # check name -> must-be-true
    violations: dict[str, Column] = field(default_factory=dict)    # check name -> failing rows
    relationships: list[Relationship] = field(default_factory=list)
    reported: list[Relationship] = field(default_factory=list)     # listed, not enforced


def row_checks(contract: Contract) -> dict[str, Column]:
    """Checks that need nothing but the row: name -> it fails (never NULL)."""
    checks: dict[str, Column] = {}
    for c in contract.not_null:
        checks[f"not_null:{c}"] = F.col(c).isNull()
    for name, expr in contract.expressions.items():
        checks[f"expression:{name}"] = F.coalesce(~expr, F.lit(False))
    for name, pred in contract.violations.items():
        checks[f"singular:{name}"] = F.coalesce(pred, F.lit(False))
    return checks


def _with_parents(df: DataFrame, contract: Contract, reported: bool) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with a flag per relationship (a lookup of the parent's distinct
    keys, which AQE broadcasts or splits), and all row-level checks."""
    checks, rows = row_checks(contract), df
    found = [("relationships", r) for r in contract.relationships]
    found += [("reported:relationships", r) for r in contract.reported] if reported else []
    for i, (kind, rel) in enumerate(found):
        flag = f"_orphan{i}"
        keys = (rel.parent.select(F.col(rel.parent_column).alias(rel.column)).distinct()
                .withColumn(flag, F.lit(False)))
        rows = rows.join(keys, rel.column, "left")
        checks[f"{kind}:{rel.column}"] = F.col(rel.column).isNotNull() & F.col(flag).isNull()
    return rows, checks


def tag_violations(df: DataFrame, contract: Contract, column: str = "failed_checks", reported: bool = False) -> DataFrame:
    """The rows that fail a row-level check, whole, with the array of the names
    of the checks they fail.  One projection and filter; each relationship adds
    a lookup join."""
    rows, checks = _with_parents(df, contract, reported)
    tags = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in checks.items()]))
    return rows.withColumn(column, tags).where(F.size(column) > 0).select(*df.columns, column)


def _by_grain(df: DataFrame, contract: Contract, reported: bool) -> tuple[DataFrame, dict[str, Column]]:
    """One row per grain key (the contract's first unique key) with the failing
    rows of every check, and check name -> its count.  Map-side partial, so a
    hot or NULL key is no hot task."""
    rows, checks = _with_parents(df, contract, reported)
    grain = contract.unique[0] if contract.unique else []
    flags = rows.select(*grain, *[cond.cast("int").alias(f"c{i}") for i, cond in enumerate(checks.values())])
    counts = {name: F.col(f"c{i}") for i, name in enumerate(checks)}
    sums = [F.sum(f"c{i}").alias(f"c{i}") for i in range(len(checks))]
    if not grain:
        return flags.agg(*sums), counts
    repeated = F.col("_n") > 1
    if len(grain) == 1:
        repeated &= F.col(grain[0]).isNotNull()
    return flags.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n"), *sums), counts | {unique_name(grain): repeated.cast("bigint")}


def violating_keys(df: DataFrame, contract: Contract, reported: bool = False) -> DataFrame:
    """One row per failing check and grain key: (model, check_name, key,
    violations), key as a JSON object of the grain columns.

    violations counts the failing rows of the key (of a uniqueness check: 1),
    so its sum per check is what ``contract_summary`` gives.  The checks that
    fail are exploded after the filter: clean keys cost no row.  Without a
    grain the key is the empty object.
    """
    groups, counts = _by_grain(df, contract, reported)
    grain = contract.unique[0] if contract.unique else []
    found = _stacked(groups.select(*grain, *[n.alias(f"v{i}") for i, n in enumerate(counts.values())]),
                     list(counts), grain).where(F.col("violations") > 0)
    out = found.select("check_name", _key(grain), "violations")
    for extra in contract.unique[1:]:
        out = out.unionByName(_repeated(df, extra).select(F.lit(unique_name(extra)).alias("check_name"), _key(extra),
                                                          F.lit(1).cast("bigint").alias("violations")))
    return out.select(F.lit(contract.model).alias("model"), "check_name", "key", "violations")


def _key(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("key") if columns else F.lit("{}").alias("key")


def _stacked(df: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
    """Counts v0, v1, ... as rows (check_name, violations)."""
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.coalesce(F.col(f"v{i}").cast("bigint"), F.lit(0).cast("bigint")).alias("violations"))
        for i, n in enumerate(names)])).alias("s")).select(*keep, "s.*")


def _repeated(df: DataFrame, columns: list[str]) -> DataFrame:
    dup = unique_combination(df, columns)
    return dup.where(F.col(columns[0]).isNotNull()) if len(columns) == 1 else dup


def contract_summary(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per check: (model, check_name, violations).

    All checks of a contract are evaluated in a single pass over ``df``:
    relationship keys are flagged through a lookup join against the
    parents' distinct keys, rows are grouped once by the grain key (partial
    aggregation map-side), and the groups are reduced to one row of counts,
    which is unpivoted.  The model is therefore computed once, whatever the
    number of checks.
    """
    groups, counts = _by_grain(df, contract, reported=False)
    totals = groups.agg(*[F.sum(n).alias(f"v{i}") for i, n in enumerate(counts.values())])
    out = _stacked(totals, list(counts), [])
    for extra in contract.unique[1:]:
        out = out.unionByName(_repeated(df, extra).agg(F.count(F.lit(1)).alias("violations"))
                              .select(F.lit(unique_name(extra)).alias("check_name"), "violations"))
    return out.select(F.lit(contract.model).alias("model"), "check_name", "violations")
