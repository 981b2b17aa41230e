"""Validator checks: a registry of named, pluggable table validators.

A validator is a Python function ``(column, ctx) -> Uses`` registered under a
name with :func:`validator`.  It returns the metrics it needs and how to
combine them; it never runs a job itself, so every validator of a run is
fused into the same metric pass as everything else.  Null handling: distinct
counts *keep* the null group here (a null is a value).

    @validator("MaxLengthValidator")
    def max_length(column, ctx):
        return Uses({"len": Metric("aggregate", (f"max(length({quote(column.name)}))",))})

What metrics cannot say (a join, a window) is a validator over the DataFrame, registered with
:func:`dataframe_validator`: ``(df, column, ctx)`` returns a DataFrame of one row and one column (a
sub-plan of the report, computed with it) or a number that it has computed itself.

    @dataframe_validator("OrphanOrders")
    def orphans(df, column, ctx):
        return df.join(customers, ..., "left_anti").select(F.count(F.lit(1)))

Modules with validators are loaded by name or file with :func:`load_validators`.
"""

from __future__ import annotations

import importlib
import importlib.util
import os
import re
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from assay.functions.predicates import quote
from assay.functions.thresholds import ConfigError
from assay.operators.metrics import DEFAULT_MAX_METRICS_PER_PASS, Metric, NamedMetric
from assay.operators.schema import COLUMN_PLACEHOLDER, DeclaredColumn, declared_columns, matching_columns
from assay.plans.catalogue import BUILT_INS, VALIDATOR_CONFIG, BuiltIn, definition_metric
from assay.plans.evaluate import CheckPlan, evaluate

STRATEGY = "validator"
_ALIAS = re.compile(r"\{(\w+)\}")


@dataclass(frozen=True)
class ValidatorContext:
    columns: list[DeclaredColumn]
    as_of: object = None


@dataclass
class Uses:
    """Metrics a validator needs (alias -> Metric) and its value over them.

    ``value`` is an alias (the value is that metric), Spark SQL text naming
    metrics as ``{alias}`` (e.g. ``"{rows} - {values}"``), or a callable
    ``{alias: Column} -> Column``; it defaults to the only metric.
    """

    metrics: dict[str, Metric]
    value: str | Callable[[dict[str, Column]], Column] | None = None


_REGISTRY: dict[str, Callable[[DeclaredColumn | None, ValidatorContext], Uses]] = {}


def validator(name: str):
    """Register a validator function under ``name`` (the name used in configs)."""
    def deco(fn):
        _REGISTRY[name] = fn
        return fn
    return deco


def dataframe_validator(name: str):
    """Register a validator over the DataFrame under ``name``."""
    def deco(fn):
        _REGISTRY[name] = _OverDataFrame(fn)
        return fn
    return deco


@dataclass(frozen=True)
class _OverDataFrame:
    fn: Callable


def registered_validators() -> list[str]:
    return sorted(_REGISTRY)


@contextmanager
def own_validators():
    """Validators registered inside the block are gone after it (plans made inside keep theirs)."""
    before = dict(_REGISTRY)
    try:
        yield
    finally:
        _REGISTRY.clear()
        _REGISTRY.update(before)


def load_validators(module: str) -> list[str]:
    """Import a module by name, or run the ``.py`` file at a path, and return the names it registered anew."""
    before = dict(_REGISTRY)
    if module.endswith(".py"):
        spec = importlib.util.spec_from_file_location(f"assay_validators_{len(before)}", module)
        if spec is None or not os.path.exists(module):
            raise ConfigError(f"no validator module at {module!r}")
        spec.loader.exec_module(importlib.util.module_from_spec(spec))
    else:
        importlib.import_module(module)
    return sorted(n for n, f in _REGISTRY.items() if before.get(n) is not f)


def _built_in(check: BuiltIn):
    """The built-in check's validator: nulls count as a value."""
    def plan(column, ctx):
        columns = ctx.columns if column is None else [column]
        measures = {a: definition_metric(d, columns, ctx.as_of, dataset=column is None)
                    for a, d in {**check.measures, **check.kept}.items()}
        return Uses(measures, " ".join(f"{{{w}}}" if w in measures else w for w in check.value.split()))
    return plan


for _check in BUILT_INS:
    validator(_check.validator)(_built_in(_check))


def definition_key(m: Metric) -> str:
    """Readable key that identifies a metric definition, e.g. ``size WHERE `a` IS NULL``."""
    key = m.agg + (f"({', '.join(m.target)})" if m.target else "")
    return key + (f" WHERE {m.where}" if m.where else "")


def _plan(df: DataFrame, name: str, description: str, column: DeclaredColumn | None, ctx: ValidatorContext,
          op: str, thr: float) -> CheckPlan:
    fn = _REGISTRY.get(name)
    if fn is None:
        return CheckPlan(description, [], "CAST(NULL AS DOUBLE)", op, thr, STRATEGY,
                         error=f"unknown validator {name!r}")
    try:
        if isinstance(fn, _OverDataFrame):
            return _framed(fn.fn(df, column, ctx), df, description, op, thr)
        return _planned(name, fn(column, ctx), description, column, ctx, op, thr)
    except Exception as exc:  # a validator is user code: one that raises fails its own check
        return CheckPlan(description, [], "CAST(NULL AS DOUBLE)", op, thr, STRATEGY, error=f"{type(exc).__name__}: {exc}")


def _framed(result, df: DataFrame, description: str, op: str, thr: float) -> CheckPlan:
    if isinstance(result, DataFrame):
        return CheckPlan(description, [], "", op, thr, STRATEGY, frame=result)
    value = "CAST(NULL AS DOUBLE)" if result is None else f"CAST('{float(result)!r}' AS DOUBLE)"
    return CheckPlan(description, [], value, op, thr, STRATEGY)


def _planned(name: str, uses: Uses, description: str, column: DeclaredColumn | None, ctx: ValidatorContext,
             op: str, thr: float) -> CheckPlan:
    label = column.name if column else ",".join(c.name for c in ctx.columns)
    # Keys name the definition itself: checks that need the same metric (the
    # row count, a column's distinct values) share one key, so the pivoted
    # metric row grows with the number of distinct definitions, not of checks.
    keyed = {alias: definition_key(m) for alias, m in uses.metrics.items()}
    named = [NamedMetric(alias, label, keyed[alias], m) for alias, m in uses.metrics.items()]
    value = uses.value
    if value is None:
        if len(uses.metrics) != 1:
            raise ConfigError(f"validator {name!r} uses several metrics but gives no value")
        value = next(iter(uses.metrics))
    if isinstance(value, str):
        if value in keyed:
            builder = quote(keyed[value])
        else:
            builder = _ALIAS.sub(lambda m: quote(keyed[m.group(1)]), value)
    else:
        builder = lambda cols, f=value, kk=keyed: f({a: cols[k] for a, k in kk.items()})
    return CheckPlan(description, named, builder, op, thr, STRATEGY)


def plan_validator_checks(df: DataFrame, config: dict | None = None, types=None, as_of=None) -> list[CheckPlan]:
    config = config or VALIDATOR_CONFIG
    columns = declared_columns(df, types)
    ctx = ValidatorContext(columns, as_of)
    plans = []
    for entry in config.get("validators", []):
        op, thr = entry["operator"], float(entry["threshold"])
        types_ = entry.get("types", [])
        if not types_:
            plans.append(_plan(df, entry["name"], entry["description"], None, ctx, op, thr))
            continue
        for col in matching_columns(columns, types_):
            desc = entry["description"].replace(COLUMN_PLACEHOLDER, col.name)
            plans.append(_plan(df, entry["name"], desc, col, ctx, op, thr))
    return plans


def validator_report(df, config=None, types=None, as_of=None,
                     max_metrics_per_pass: int = DEFAULT_MAX_METRICS_PER_PASS,
                     isolate_runtime_errors: bool = False):
    """``(metrics, verdicts)`` for validator checks."""
    return evaluate(df, plan_validator_checks(df, config, types, as_of), max_metrics_per_pass,
                    isolate_runtime_errors=isolate_runtime_errors)


def run_validator_checks(df: DataFrame, config: dict | None = None, types=None, as_of=None,
                         max_metrics_per_pass: int = DEFAULT_MAX_METRICS_PER_PASS,
                         isolate_runtime_errors: bool = False) -> DataFrame:
    """Verdicts ``(checkName, value, status, error)`` of validator checks."""
    return validator_report(df, config, types, as_of, max_metrics_per_pass, isolate_runtime_errors)[1]
