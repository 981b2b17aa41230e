"""SQL-template checks: each check is a Spark SQL query over the table.

A template names the table ``{table}`` and the column ``{column}`` (for
``Dataset`` templates: every declared column, comma separated) and returns
exactly one row with a column ``metricName``.  The table is registered once
as a temp view with a unique name; every expanded template becomes a
one-row subquery and all of them are unioned into a single statement, so one
action runs every check (instead of one blocking job per check).  A template
that does not analyse, or does not return exactly one row, fails its own
check and nothing else.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from assay.functions.predicates import as_of_sql, quote
from assay.functions.thresholds import ConfigError, check_operator, status_sql
from assay.operators.metrics import DATA_ERRORS, NamedMetric, _analysable, _build_or_error, _error_text, sql_literal, union_all
from assay.operators.schema import COLUMN_PLACEHOLDER, declared_columns, matching_columns
from assay.plans.catalogue import COMPILED_SQL, SQL_CONFIG, definition_metric
from assay.plans.evaluate import VERDICT_SCHEMA, CheckPlan, evaluate
from assay.plans.fold import METRIC_COLUMN, folded_metric, folds_into
from assay.plans.validator_checks import definition_key

STRATEGY = "sql"
# Spark's SQL parser rejects overly complex statements; very wide tables expand
# to thousands of templates, so they are parsed in statements of this many.
TEMPLATES_PER_STATEMENT = 100


def register_view(df: DataFrame, prefix: str = "assay_table") -> str:
    """Register ``df`` as a temp view under a fresh name; return the quoted name."""
    name = f"{prefix}_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return quote(name)


def bind_template(query: str, table: str, column: str, as_of=None) -> str:
    return (query.replace("{table}", table)
                 .replace("{column}", column)
                 .replace("{as_of}", as_of_sql(as_of)))


def expand_sql_checks(df: DataFrame, config: dict | None = None, types=None, as_of=None,
                      table: str = "{table}") -> list[tuple[str, str, str, float]]:
    """``(checkName, bound SQL, operator, threshold)`` per template and matching column."""
    return [(name, bind_template(entry["query"], table, cols, as_of), entry["operator"], float(entry["threshold"]))
            for name, entry, cols, _ in _expanded(df, config, types)]


def _expanded(df: DataFrame, config: dict | None, types) -> list[tuple]:
    """``(checkName, entry, column text, column or None for the table)`` per template and matching column."""
    columns = declared_columns(df, types)
    out = []
    for entry in (config or SQL_CONFIG).get("checks", []):
        check_operator(entry["operator"])
        if entry.get("metricType", "Column") == "Dataset":
            out.append((entry["checkName"], entry, ", ".join(quote(c.name) for c in columns), None))
            continue
        for col in matching_columns(columns, entry.get("types", [])):
            out.append((entry["checkName"].replace(COLUMN_PLACEHOLDER, col.name), entry, quote(col.name), col))
    names = [n for n, *_ in out]
    if len(set(names)) != len(names):
        raise ConfigError("duplicate check names after expansion")
    return out


def plan_sql_checks(df: DataFrame, config: dict | None = None, types=None, as_of=None, fold: bool = True) -> tuple[list[CheckPlan], list[tuple]]:
    """The checks with a built-in template, and (``fold``) the user's texts that are one aggregate over the
    table, as plans over fused metrics; the others as ``(checkName, SQL with {table}, operator, threshold)``."""
    columns = declared_columns(df, types)
    plans, texts = [], []
    for name, entry, cols, col in _expanded(df, config, types):
        op, thr = entry["operator"], float(entry["threshold"])
        check = COMPILED_SQL.get(entry["query"])
        if check is None or (col is None) == bool(check.types):
            texts.append((name, bind_template(entry["query"], "{table}", cols, as_of), op, thr))
            continue
        measures = {a: definition_metric(d, columns if col is None else [col], as_of, dataset=col is None)
                    for a, d in {**check.measures, **check.extra}.items()}
        value = check.indicator or check.value
        used = {a: m for a, m in measures.items() if a in value.split()}
        named = [NamedMetric(a, col.name if col else ",".join(c.name for c in columns), definition_key(m), m)
                 for a, m in used.items()]
        bound = " ".join(quote(definition_key(used[w])) if w in used else w for w in value.split())
        plans.append(CheckPlan(name, named, f"CAST(({bound}) AS INT)" if check.indicator else bound, op, thr, STRATEGY))
    if fold and texts:
        folded, texts = _folded(df, texts)
        plans += folded
    return plans, texts


def _folded(df: DataFrame, texts: list[tuple]) -> tuple[list[CheckPlan], list[tuple]]:
    """The texts that fold into the fused pass as plans, and the rest (see :mod:`assay.plans.fold`)."""
    spark, plans, rest = df.sparkSession, [], []
    view = register_view(df)
    try:
        for name, sql, op, thr in texts:
            metric = folded_metric(spark, sql.replace("{table}", view), view)
            if metric is None or not folds_into(df, metric):
                rest.append((name, sql, op, thr))
                continue
            key = definition_key(metric)
            plans.append(CheckPlan(name, [NamedMetric(METRIC_COLUMN, "*", key, metric)], quote(key), op, thr, STRATEGY))
    finally:
        spark.catalog.dropTempView(view.strip("`"))
    return plans, rest


def _check_sql(name: str, sql: str, op: str, thr: float) -> str:
    """One verdict row for one template: exactly one result row is required."""
    v = "first(try_cast(metricName AS DOUBLE))"
    value = f"CASE WHEN count(1) = 1 THEN {v} END"
    error = (f"CASE WHEN count(1) <> 1 THEN concat('expected exactly one row, got ', CAST(count(1) AS STRING)) "
             f"WHEN {v} IS NULL THEN 'no value' END")
    return (f"SELECT {sql_literal(name)} AS checkName, {value} AS value, "
            f"{status_sql(value, op, thr)} AS status, {error} AS error FROM ({sql}) AS template_result")


def _failed_sql(name: str, err: str) -> str:
    return (f"SELECT {sql_literal(name)} AS checkName, CAST(NULL AS DOUBLE) AS value, false AS status, "
            f"{sql_literal(err)} AS error")


def _statement_chunk(spark, checks, parts) -> DataFrame:
    """One ``UNION ALL`` statement; if it does not analyse, find and isolate the bad templates."""
    result, err = _build_or_error(lambda: spark.sql("\nUNION ALL\n".join(parts)))
    if err is None:
        return result
    fixed = []
    for (name, sql, op, thr), part in zip(checks, parts):
        bad = _analysable(lambda p=part: spark.sql(p))
        fixed.append(part if bad is None else _failed_sql(name, bad))
    return spark.sql("\nUNION ALL\n".join(fixed))


@contextmanager
def _ansi(spark: SparkSession, on: bool | None):
    """ANSI rules on or off while SQL text is analysed (``None``: as the session has them).  Expressions
    keep the rules under which they were analysed."""
    if on is None:
        yield
        return
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(on).lower())
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def run_templates(df: DataFrame, checks: list[tuple], isolate_runtime_errors: bool = False, ansi: bool | None = None) -> DataFrame:
    """Verdicts of SQL texts ``(checkName, SQL with {table}, operator, threshold)``, as one DataFrame.

    Texts that do not analyse fail their own check.  ``isolate_runtime_errors`` runs them at once, and
    halves a set that fails on the data until the failing texts stand alone."""
    spark = df.sparkSession
    if not checks:
        return spark.createDataFrame([], VERDICT_SCHEMA)
    view = register_view(df)

    def build(some: list[tuple]) -> DataFrame:
        bound = [(name, sql.replace("{table}", view), op, thr) for name, sql, op, thr in some]
        parts = [_check_sql(*c) for c in bound]
        return union_all([_statement_chunk(spark, bound[i:i + TEMPLATES_PER_STATEMENT], parts[i:i + TEMPLATES_PER_STATEMENT])
                          for i in range(0, len(parts), TEMPLATES_PER_STATEMENT)])

    def attempt(some: list[tuple]) -> list[tuple]:
        try:
            return [tuple(r) for r in build(some).collect()]  # one row per check
        except DATA_ERRORS as exc:
            if len(some) == 1:
                return [(some[0][0], None, False, _error_text(exc))]
            return attempt(some[:len(some) // 2]) + attempt(some[len(some) // 2:])

    try:
        with _ansi(spark, ansi):
            return spark.createDataFrame(attempt(checks), VERDICT_SCHEMA) if isolate_runtime_errors else build(checks)
    finally:
        # The analysed plan already holds the table; the name is no longer needed.
        spark.catalog.dropTempView(view.strip("`"))


def run_sql_checks(df: DataFrame, config: dict | None = None, types=None, as_of=None, isolate_runtime_errors: bool = False,
                   ansi: bool | None = None) -> DataFrame:
    """Verdicts ``(checkName, value, status, error)`` of SQL-template checks.

    Entries with a built-in template, and texts that are one aggregate over the table, are computed from
    fused metrics; the others become ``UNION ALL`` statements (up to ``TEMPLATES_PER_STATEMENT`` each)
    unioned into one DataFrame: one action.  ``ansi=False`` analyses the texts without ANSI rules, as texts
    written for older Spark versions expect; they then run as written.
    """
    plans, texts = plan_sql_checks(df, config, types, as_of, fold=ansi is None)
    out = run_templates(df, texts, isolate_runtime_errors, ansi) if texts or not plans else None
    if plans:
        built_in = evaluate(df, plans, isolate_runtime_errors=isolate_runtime_errors)[1]
        out = built_in if out is None else built_in.unionByName(out)
    return out
