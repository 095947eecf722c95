"""Relational building blocks: ranking, validity intervals, surrogate ids, constraint checks."""

from tenure.operators.checks import declared_violations, duplicate_keys, length_violations, null_counts
from tenure.operators.numbering import assign_identity
from tenure.operators.ranking import (
    first_per_group,
    number_by_ranges,
    number_within,
    prefix_by_ranges,
    split_hot_groups,
)
from tenure.operators.temporal import valid_at

__all__ = [
    "assign_identity",
    "declared_violations",
    "duplicate_keys",
    "length_violations",
    "null_counts",
    "first_per_group",
    "number_by_ranges",
    "number_within",
    "prefix_by_ranges",
    "split_hot_groups",
    "valid_at",
]
