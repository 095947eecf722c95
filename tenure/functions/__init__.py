"""Scalar helpers built from Spark's native expressions."""

from tenure.functions.dates import as_of_date, parse_date, whole_days
from tenure.functions.text import (
    CASE_INSENSITIVE,
    EXACT,
    JOIN_KEY,
    key_column,
    stringify,
    with_join_key,
)

__all__ = [
    "as_of_date",
    "parse_date",
    "whole_days",
    "CASE_INSENSITIVE",
    "EXACT",
    "JOIN_KEY",
    "key_column",
    "stringify",
    "with_join_key",
]
