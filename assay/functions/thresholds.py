"""Threshold predicates: turn a metric value into a pass/fail Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The comparison operators a check may use ("=" and "==" are the same).
OPERATORS = (">", ">=", "<", "<=", "=", "==")


class ConfigError(ValueError):
    """A check or metric configuration that cannot be run as written."""


def check_operator(op: str) -> str:
    if op not in OPERATORS:
        raise ConfigError(f"unknown operator {op!r}; expected one of {OPERATORS}")
    return op


def status_sql(value: str, op: str, threshold: float) -> str:
    """SQL text of the verdict: ``value <op> threshold`` as doubles; null never passes."""
    check_operator(op)
    sql_op = "=" if op == "==" else op
    return f"coalesce(try_cast(({value}) AS DOUBLE) {sql_op} CAST('{float(threshold)!r}' AS DOUBLE), false)"


def satisfies(value: Column, op: str, threshold: float) -> Column:
    """``value <op> threshold`` compared as doubles; a null value gives null."""
    v = value.cast("double")
    t = F.lit(float(threshold))
    check_operator(op)
    if op == ">":
        return v > t
    if op == ">=":
        return v >= t
    if op == "<":
        return v < t
    if op == "<=":
        return v <= t
    return v == t


def status(value: Column, op: str, threshold: float) -> Column:
    """Verdict Column: a null (absent, failed or empty) value never passes."""
    return F.coalesce(satisfies(value, op, threshold), F.lit(False))
