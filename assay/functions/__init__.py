"""Scalar helpers: ANSI-safe row predicates and threshold verdicts."""

from assay.functions.predicates import (
    as_of_sql,
    days_from,
    is_empty,
    is_integral_text,
    is_non_positive,
    is_null,
    is_zero,
    quote,
    sql_string,
)
from assay.functions.thresholds import OPERATORS, ConfigError, satisfies, status

__all__ = [
    "OPERATORS", "ConfigError", "as_of_sql", "days_from", "is_empty", "is_integral_text",
    "is_non_positive", "is_null", "is_zero", "quote", "satisfies", "sql_string", "status",
]
