"""Column expressions shared by the operators and models."""

from caremarts.functions.columns import (
    age_years,
    case_map,
    exact_ratio,
    flag_sum,
    hash_bucket,
    recode,
    surrogate_key,
)

__all__ = [
    "age_years",
    "case_map",
    "exact_ratio",
    "flag_sum",
    "hash_bucket",
    "recode",
    "surrogate_key",
]
