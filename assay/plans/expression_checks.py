"""Metric-expression checks: named metrics combined by arithmetic, then thresholded.

Metrics are expanded over the declared columns (``metricType`` ``Dataset`` ->
one metric keyed by its name; ``Column`` -> one per matching column keyed
``<name>_<column>``).  A check expression is Spark SQL over those keys, so
full arithmetic works (``countRows - countDistinctValues_${column}``,
``countNulls_x / countRows``); keys for odd column names are back-quoted
during expansion.  Null handling: distinct counts *drop* nulls here.
"""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import DataFrame

from assay.functions.predicates import quote
from assay.functions.thresholds import ConfigError
from assay.operators.metrics import DEFAULT_MAX_METRICS_PER_PASS, FAILED_AGG, Metric, NamedMetric
from assay.operators.schema import COLUMN_PLACEHOLDER, DeclaredColumn, declared_columns, matching_columns
from assay.plans.catalogue import EXPRESSION_CONFIG, ast_metric, definition_metric
from assay.plans.evaluate import CheckPlan, evaluate

STRATEGY = "expression"
_KEY_TOKEN = re.compile(r"`?([A-Za-z0-9_]*)\$\{column\}([A-Za-z0-9_]*)`?")


def _metric_for(entry: dict, columns: list[DeclaredColumn], as_of, dataset: bool = False) -> Metric:
    """The entry's metric; an entry that names nothing known becomes a failed metric, alone."""
    where = entry.get("condition") or entry.get("where") or None
    try:
        if entry.get("definitionName"):
            return definition_metric(entry["definitionName"], columns, as_of, where, dataset)
        if entry.get("aggFunction"):
            return ast_metric(entry["aggFunction"], entry.get("columnExpr", "*"), where)
        raise ConfigError(f"metric {entry.get('metricName')!r} has neither definitionName nor aggFunction")
    except (ConfigError, ValueError) as exc:
        return Metric(FAILED_AGG, (str(exc),))


def expand_metrics(config: dict, columns: list[DeclaredColumn], as_of=None) -> list[NamedMetric]:
    """Expand metric definitions over the declared columns (driver-side metadata)."""
    out: list[NamedMetric] = []
    for entry in config.get("metrics", []):
        name = entry["metricName"]
        if entry.get("metricType", "Column") == "Dataset":
            label = ",".join(c.name for c in columns)
            out.append(NamedMetric(name, label, name, _metric_for(entry, columns, as_of, dataset=True)))
            continue
        for col in matching_columns(columns, entry.get("types", [])):
            e = dict(entry)
            for k in ("columnExpr", "condition", "where"):
                if e.get(k):
                    e[k] = e[k].replace(COLUMN_PLACEHOLDER, quote(col.name))
            out.append(NamedMetric(name, col.name, f"{name}_{col.name}", _metric_for(e, [col], as_of)))
    return _distinct_keys(out)


def _distinct_keys(named: list[NamedMetric]) -> list[NamedMetric]:
    """Keys that different metrics would share (``a`` of column ``b_c``, ``a_b`` of column ``c``) become
    ``name[column]``; the joined key then names neither."""
    metrics: dict[str, set] = {}
    for nm in named:
        metrics.setdefault(nm.key, set()).add(nm.metric)
    return [replace(nm, key=f"{nm.name}[{nm.column}]") if len(metrics[nm.key]) > 1 else nm for nm in named]


def _bind_expression(expression: str, column: str, keys: dict[tuple[str, str], str]) -> str:
    """Substitute ``${column}`` inside metric keys, back-quoting the whole key."""
    def key(m):
        name, joined = m.group(1).removesuffix("_"), m.group(1) + column + m.group(2)
        return quote(keys.get((name, column), joined) if not m.group(2) else joined)
    return _KEY_TOKEN.sub(key, expression)


def expand_checks(config: dict, columns: list[DeclaredColumn], metrics: list[NamedMetric] = ()) -> list[tuple[str, str, str, float]]:
    """``(checkName, expression, operator, threshold)`` per check and matching column."""
    keys = {(nm.name, nm.column): nm.key for nm in metrics if nm.key.endswith("]")}
    out = []
    for entry in config.get("checks", []):
        types = entry.get("types", [])
        op, thr = entry["operator"], float(entry["threshold"])
        if not types:
            out.append((entry["checkName"], entry["expression"], op, thr))
            continue
        for col in matching_columns(columns, types):
            out.append((entry["checkName"].replace(COLUMN_PLACEHOLDER, col.name),
                        _bind_expression(entry["expression"], col.name, keys), op, thr))
    return out


def plan_expression_checks(df: DataFrame, config: dict | None = None, types=None, as_of=None) -> list[CheckPlan]:
    config = config or EXPRESSION_CONFIG
    columns = declared_columns(df, types)
    metrics = expand_metrics(config, columns, as_of)
    plans = []
    for name, expression, op, thr in expand_checks(config, columns, metrics):
        # Every check sees every metric: the expression may reference any key.
        plans.append(CheckPlan(name, metrics, expression, op, thr, STRATEGY))
    return plans


def run_expression_checks(
    df: DataFrame,
    config: dict | None = None,
    types=None,
    as_of=None,
    max_metrics_per_pass: int = DEFAULT_MAX_METRICS_PER_PASS,
    isolate_runtime_errors: bool = False,
) -> DataFrame:
    """Verdicts ``(checkName, value, status, error)`` of metric-expression checks."""
    return expression_report(df, config, types, as_of, max_metrics_per_pass, isolate_runtime_errors)[1]


def expression_report(df, config=None, types=None, as_of=None,
                      max_metrics_per_pass: int = DEFAULT_MAX_METRICS_PER_PASS,
                      isolate_runtime_errors: bool = False):
    """``(metrics, verdicts)`` for metric-expression checks."""
    return evaluate(df, plan_expression_checks(df, config, types, as_of), max_metrics_per_pass,
                    isolate_runtime_errors=isolate_runtime_errors)
