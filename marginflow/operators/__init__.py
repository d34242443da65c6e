from marginflow.operators.aggregates import max_if, month_start, sum_if
from marginflow.operators.allocation import AllocationColumns, allocate_two_tier
from marginflow.operators.cleansing import CLEANSERS
from marginflow.operators.joins import spread_nulls
from marginflow.operators.quality import (Contract, Relationship, contract_summary, relationships,
                                          unique_combination)

__all__ = [
    "max_if", "month_start", "sum_if", "AllocationColumns", "allocate_two_tier", "CLEANSERS",
    "spread_nulls", "Contract", "Relationship", "contract_summary", "relationships",
    "unique_combination",
]
