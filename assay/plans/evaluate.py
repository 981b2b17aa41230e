"""Shared evaluation: check plans -> one metrics table -> one verdict table.

Both the metric-expression strategy and the validator strategy compile each
check to a :class:`CheckPlan` (the metrics it needs plus a value expression
over them).  :func:`evaluate` computes every metric of every plan in one
fused engine run, pivots the metric table to a single wide row and evaluates
all check values and verdicts in one projection.  Nothing is collected; the
verdict DataFrame is the result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.functions.predicates import quote
from assay.functions.thresholds import OPERATORS, ConfigError, check_operator
from assay.operators.metrics import (
    DATA_ERRORS,
    DEFAULT_MAX_METRICS_PER_PASS,
    NamedMetric,
    _analysable,
    _build_or_error,
    _error_text,
    compute_metrics,
    compute_metrics_isolated,
    sql_literal,
    value_sql,
    wide_metrics,
)

VERDICT_SCHEMA = "checkName string, value double, status boolean, error string"


@dataclass
class CheckPlan:
    """A named check: metrics it needs, how to combine them, and its threshold.

    ``value`` is either SQL text evaluated over the wide metric row (metric keys
    are its column names) or a callable ``{metric_key: Column} -> Column``.
    """

    name: str
    metrics: list[NamedMetric]
    value: str | Callable[[dict[str, Column]], Column]
    operator: str
    threshold: float
    strategy: str = ""
    error: str | None = None          # set when the check could not be built
    frame: DataFrame | None = None    # a check over a one-row, one-column DataFrame instead of metrics


def _reject_duplicate_names(plans: list[CheckPlan]) -> None:
    seen: set[tuple[str, str]] = set()
    for p in plans:
        if (p.strategy, p.name) in seen:
            raise ConfigError(f"duplicate check name {p.name!r}")
        seen.add((p.strategy, p.name))


def metrics_of(plans: list[CheckPlan]) -> list[NamedMetric]:
    """All metrics the plans need, each key once (same key must mean same metric)."""
    out: dict[str, NamedMetric] = {}
    seen_lists: set[int] = set()
    for p in plans:
        if id(p.metrics) in seen_lists:  # plans often share one metric list
            continue
        seen_lists.add(id(p.metrics))
        for nm in p.metrics:
            prev = out.get(nm.key)
            if prev is not None and prev.metric != nm.metric:
                raise ConfigError(f"metric key {nm.key!r} is defined twice with different definitions")
            out.setdefault(nm.key, nm)
    return list(out.values())


def _value_column(plan: CheckPlan) -> Column:
    if callable(plan.value):
        return plan.value({nm.key: F.col(quote(nm.key)) for nm in plan.metrics})
    return F.expr(plan.value)


#: Checks that one stage of generated code evaluates: Spark compiles a method of at most 64 KB.
CHECKS_PER_ARRAY = 40


def _check_struct_sql(p: CheckPlan) -> str:
    """The check and its value, written once; the verdict is taken from the row."""
    return (f"named_struct('strategy', {sql_literal(p.strategy)}, 'checkName', {sql_literal(p.name)}, 'value', {value_sql(p.value)}, "
            f"'operator', {sql_literal(p.operator)}, 'threshold', CAST('{float(p.threshold)!r}' AS DOUBLE))")


def _check_struct(p: CheckPlan, value: Column) -> Column:
    return F.struct(F.lit(p.strategy).alias("strategy"), F.lit(p.name).alias("checkName"), value.alias("value"),
                    F.lit(p.operator).alias("operator"), F.lit(float(p.threshold)).alias("threshold"))


def _verdict_rows(checks: DataFrame, head: list[str]) -> DataFrame:
    """Verdicts of ``checkName, value, operator, threshold`` rows: a null value fails."""
    passed = " ".join(["CASE operator", *[f"WHEN '{op}' THEN value {'=' if op == '==' else op} threshold" for op in OPERATORS], "END"])
    return checks.selectExpr(*head, "checkName", "value", f"coalesce({passed}, false) AS status",
                             "CASE WHEN value IS NULL THEN 'no value' END AS error")


def _frame_rows(p: CheckPlan) -> DataFrame:
    """The frame's only column as ``value``, one row whatever the frame has: ``value, n`` rows."""
    if len(p.frame.columns) != 1:
        raise ConfigError(f"expected one column, got {len(p.frame.columns)}")
    rows = p.frame.toDF("v").selectExpr("first(try_cast(v AS DOUBLE)) AS value", "count(1) AS n")
    rows.schema  # noqa: B018  (analysed now, so that a bad frame fails here)
    return rows


def _frame_verdicts(p: CheckPlan, rows: DataFrame, head: list[str], isolate: bool) -> DataFrame:
    if isolate:  # run it at once, so that an error of its data fails it alone
        try:
            rows = rows.sparkSession.createDataFrame([tuple(rows.first())], rows.schema)
        except DATA_ERRORS as exc:
            rows = rows.sparkSession.createDataFrame([(None, 1, _error_text(exc))], "value double, n long, failed string")
    failed = "failed" if "failed" in rows.columns else "CAST(NULL AS STRING)"
    check = (f"named_struct('strategy', {sql_literal(p.strategy)}, 'checkName', {sql_literal(p.name)}, "
             f"'value', CASE WHEN n = 1 THEN value END, 'operator', {sql_literal(p.operator)}, "
             f"'threshold', CAST('{float(p.threshold)!r}' AS DOUBLE), 'n', n, 'failed', {failed})")
    checks = rows.selectExpr(f"inline(array({check}))")
    own = "coalesce(failed, CASE WHEN n <> 1 THEN concat('expected exactly one row, got ', CAST(n AS STRING)) END)"
    verdicts = _verdict_rows(checks, [*head, "n", "failed"])
    return verdicts.withColumn("error", F.expr(f"coalesce({own}, error)")).drop("n", "failed")


def evaluate(
    df: DataFrame,
    plans: list[CheckPlan],
    max_metrics_per_pass: int = DEFAULT_MAX_METRICS_PER_PASS,
    with_strategy: bool = False,
    isolate_runtime_errors: bool = False,
    compute: Callable[[DataFrame, list[NamedMetric], int], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Return ``(metrics, verdicts)`` for ``plans`` over ``df`` (both lazy).

    ``verdicts`` has one row per plan: ``checkName, value, status, error``.
    A null value (empty input, failed metric, unresolved expression) fails.
    With ``with_strategy`` a leading ``strategy`` column tells the plans'
    strategies apart, so several strategies share one metric pass.
    ``isolate_runtime_errors`` computes the metrics eagerly and isolates
    definitions that fail while running (see ``compute_metrics_isolated``).
    ``compute`` replaces the function that computes the metrics.
    """
    _reject_duplicate_names(plans)
    named = metrics_of(plans)
    compute = compute or (compute_metrics_isolated if isolate_runtime_errors else compute_metrics)
    metrics = compute(df, named, max_metrics_per_pass)
    if isolate_runtime_errors:  # the metrics are computed: a check says why its metric failed
        failed = {r.key: r.error for r in metrics.where("error IS NOT NULL").select("key", "error").collect()}
        plans = [replace(p, error=p.error or _own_error(p, failed)) for p in plans]
    return metrics, verdicts_of(metrics, named, plans, with_strategy, isolate_runtime_errors)


def _own_error(p: CheckPlan, failed: dict[str, str]) -> str | None:
    """The error of the first failed metric that the check's value names."""
    keys = [nm.key for nm in p.metrics if nm.key in failed]
    if not callable(p.value):
        keys = [k for k in keys if quote(k) in p.value or re.search(rf"(?<![\w`]){re.escape(k)}(?![\w`])", p.value)]
    return failed[keys[0]] if keys else None


def verdicts_of(metrics: DataFrame, named: list[NamedMetric], plans: list[CheckPlan], with_strategy: bool = False,
                isolate_runtime_errors: bool = False) -> DataFrame:
    """One verdict row per plan (see :func:`evaluate`) over a metrics table that holds ``named``, wherever its
    values come from (a pass over the data, stored states).  Plans with a ``frame`` take their value from it:
    they join the verdicts as sub-plans, each isolated like any other check."""
    _reject_duplicate_names(plans)
    for p in plans:
        check_operator(p.operator)
    spark = metrics.sparkSession
    wide = wide_metrics(metrics, [nm.key for nm in named])
    head = ["strategy"] if with_strategy else []

    # Checks whose value is SQL text are evaluated in one SQL projection (one JVM
    # call); checks with a Python value builder go through the Column API.
    errors: list[str | None] = [p.error for p in plans]
    values: list[Column | None] = [None] * len(plans)
    framed = []
    for i, p in enumerate(plans):
        if errors[i] is None and p.frame is not None:
            rows, errors[i] = _build_or_error(lambda p=p: _frame_rows(p))
            framed += [(p, rows)] if errors[i] is None else []
        elif errors[i] is None and callable(p.value):
            try:
                values[i] = _value_column(p).try_cast("double")
            except Exception as exc:  # a failing Python value builder
                errors[i] = _error_text(exc)

    def probe(i):
        p = plans[i]
        if callable(p.value):
            return _analysable(lambda: wide.select(values[i]))
        return _analysable(lambda: wide.selectExpr(value_sql(p.value)))

    live = [i for i, e in enumerate(errors) if e is None and plans[i].frame is None]

    def build():
        """The checks' rows out of the one wide row: arrays of checks are exploded one after the other, so
        the metrics are computed once and no generated method holds more than a few checks."""
        text = [i for i in live if not callable(plans[i].value)]
        cols = [i for i in live if callable(plans[i].value)]
        arrays = [F.expr("array(" + ", ".join(_check_struct_sql(plans[i]) for i in text[a:a + CHECKS_PER_ARRAY]) + ")")
                  for a in range(0, len(text), CHECKS_PER_ARRAY)]
        arrays += [F.array(*[_check_struct(plans[i], values[i]) for i in cols[a:a + CHECKS_PER_ARRAY]])
                   for a in range(0, len(cols), CHECKS_PER_ARRAY)]
        return _verdict_rows(wide.select(F.explode(F.array(*arrays)).alias("c")).selectExpr("inline(c)"), head)

    parts = []
    if live:
        built, err = _build_or_error(build)
        if err is not None:  # find the checks that do not analyse, then rebuild
            for i in live:
                errors[i] = probe(i)
            live = [i for i in live if errors[i] is None]
            built = build() if live else None
        parts += [built] if built is not None else []
    parts += [_frame_verdicts(p, rows, head, isolate_runtime_errors) for p, rows in framed]
    failed = [(p.strategy, p.name, e) for p, e in zip(plans, errors) if e is not None]
    if failed:
        parts.append(spark.range(1).selectExpr("inline(array(" + ", ".join(
            f"named_struct('strategy', {sql_literal(s)}, 'checkName', {sql_literal(n)}, 'error', {sql_literal(e)})" for s, n, e in failed) + "))")
            .selectExpr(*head, "checkName", "CAST(NULL AS DOUBLE) AS value", "false AS status", "error"))
    if not parts:
        return spark.createDataFrame([], ("strategy string, " if with_strategy else "") + VERDICT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)
