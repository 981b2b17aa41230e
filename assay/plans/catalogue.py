"""Built-in metric definitions and the default check configurations.

Configurations are plain lists of dicts with the same shape as the JSON
config files users already keep (``{"metrics": [...], "checks": [...]}`` for
metric-expression checks, ``{"checks": [...]}`` for SQL templates,
``{"validators": [...]}`` for validators), so such a file can be passed in
unchanged via :func:`load_config`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from assay.functions.predicates import (
    days_from,
    is_empty,
    is_integral_text,
    is_non_positive,
    is_null,
    is_zero,
    quote,
)
from assay.functions.thresholds import ConfigError
from assay.operators.metrics import Metric
from assay.operators.schema import DeclaredColumn
from assay.sources.hocon import load


def load_config(path: str) -> dict:
    """Read a check configuration file (JSON or HOCON)."""
    return load(path)


# --- definition names -> metric definitions --------------------------------
# The definition names a metric config may use.
COUNT_ROWS = "count rows"
COUNT_NULLS = "count nulls"
COUNT_ZEROS = "count zeros"
COUNT_EMPTIES = "count empties"
COUNT_UNIQUES = "count uniques"
COUNT_DUPLICATES = "count duplicates"
COUNT_INTEGERS = "count integers"
MAX_DAYS = "max"
COUNT_MIN_NUMERIC = "count min numeric"
DISTINCTNESS = "Distinctness"
DUPLICATE_COLUMNS = "duplicate columns"


#: Definitions of one column; over a table's columns they have no meaning.
COLUMN_DEFINITIONS = (COUNT_NULLS, COUNT_ZEROS, COUNT_EMPTIES, COUNT_INTEGERS, COUNT_MIN_NUMERIC, MAX_DAYS)


def definition_metric(definition: str, columns: list[DeclaredColumn], as_of=None,
                      where: str | None = None, dataset: bool = False) -> Metric:
    """Metric for a definition name over one column, or (``dataset``) over the table's columns as one key."""
    if dataset and definition in COLUMN_DEFINITIONS:
        raise ConfigError(f"definition {definition!r} is of one column, not of a dataset")
    if not columns and definition in (*COLUMN_DEFINITIONS, COUNT_UNIQUES):
        raise ConfigError(f"definition {definition!r} needs a column")
    col = columns[0] if columns else None
    ident = quote(col.name) if col else None
    keys = tuple(quote(c.name) for c in columns)

    def filtered(cond: str) -> str:
        return f"({cond}) AND ({where})" if where else cond

    if definition == COUNT_ROWS:
        return Metric("size", where=where)
    if definition == COUNT_NULLS:
        return Metric("size", where=filtered(is_null(ident)))
    if definition == COUNT_ZEROS:
        return Metric("size", where=filtered(is_zero(ident, col.dtype)))
    if definition == COUNT_EMPTIES:
        return Metric("size", where=filtered(is_empty(ident)))
    if definition == COUNT_INTEGERS:
        return Metric("size", where=filtered(is_integral_text(ident)))
    if definition == COUNT_MIN_NUMERIC:
        return Metric("size", where=filtered(is_non_positive(ident, col.dtype)))
    if definition == MAX_DAYS:
        return Metric("max", (days_from(ident, as_of),), where)
    if definition == COUNT_UNIQUES:
        return Metric("distinct", keys, where)
    if definition == COUNT_DUPLICATES:
        return Metric("distinct_keep_nulls", keys, where)
    if definition == DISTINCTNESS:
        return Metric("distinctness", keys, where)
    if definition == DUPLICATE_GROUPS:  # of a table's rows the all-null row counts, of a column's values null does not
        return Metric("duplicate_groups_keep_nulls" if dataset else "duplicate_groups", keys, where)
    if definition == DUPLICATE_COLUMNS:
        return Metric("duplicate_columns")
    raise ConfigError(f"unknown metric definition {definition!r}")


# Aggregate names accepted in a user metric given as (aggFunction, columnExpr, condition).
AST_AGGREGATES = {
    "count": "count", "countdistinct": "distinct", "max": "max", "min": "min",
    "sum": "sum", "avg": "avg", "mean": "avg", "stddev": "stddev_pop", "stddev_pop": "stddev_pop",
}


def split_expressions(text: str) -> tuple[str, ...]:
    """SQL expressions separated by commas; commas in parentheses, back-quotes and quotes separate nothing."""
    out, depth, quoted = [""], 0, ""
    for c in text:
        if quoted:
            quoted = "" if c == quoted else quoted
        elif c in "`'\"":
            quoted = c
        depth += (c in "([") - (c in ")]") if not quoted else 0
        if c == "," and not quoted and not depth:
            out.append("")
        else:
            out[-1] += c
    return tuple(e.strip() for e in out)


def ast_metric(agg_function: str, column_expr: str, condition: str | None = None) -> Metric:
    agg = AST_AGGREGATES.get(agg_function.lower())
    if agg is None:
        raise ConfigError(f"unknown aggregate function {agg_function!r}")
    if agg == "count" and column_expr.strip() == "*":
        return Metric("size", where=condition or None)
    if agg == "distinct":
        return Metric("distinct", split_expressions(column_expr), condition or None)
    return Metric(agg, (column_expr,), condition or None)


# --- the built-in checks -----------------------------------------------------
# Check names, operators, thresholds and declared types of the built-in
# checks, and the validators' names.  "${column}" is replaced by each matching column's name.
NAME_ROWS = "Number of rows is larger than 0"
NAME_NULLS = "No Null/Missing values in data for column ${column}"
NAME_ZEROS = "No Zeros in columns for column ${column}"
NAME_INTEGRAL_TEXT = "No numeric values located on textual columns for column ${column}"
NAME_NON_POSITIVE = "No Numeric values are smaller than 0 for column ${column}"
NAME_CONSTANT = "No Columns with constant values for column ${column}"
NAME_DUPLICATE_ROWS = "No Duplicate rows in all columns"
NAME_DUPLICATE_VALUES = "No Duplicate rows in specific column ${column}"
NAME_DUPLICATE_COLUMNS = "No Duplicate column names"
NAME_FRESH = "Data is fresh for column ${column}"

NUMERIC = ["Double", "Int"]

DUPLICATE_GROUPS = "duplicate groups"


@dataclass(frozen=True)
class BuiltIn:
    """One built-in check: the columns it applies to (none: the table), its threshold, and its value by null
    policy, in terms of ``measures`` (name -> definition).  ``kept`` replaces measures where nulls count
    as a value.  ``indicator`` is the SQL strategy's value, over the same measures and ``extra`` ones."""

    name: str
    validator: str
    types: list
    operator: str
    threshold: float
    measures: dict
    value: str
    kept: dict = field(default_factory=dict)
    indicator: str | None = None
    extra: dict = field(default_factory=dict)


_ROWS = {"rows": COUNT_ROWS}
BUILT_INS = [
    BuiltIn(NAME_ROWS, "CountRowsValidator", [], ">", 0, _ROWS, "rows", indicator="rows > 0"),
    BuiltIn(NAME_NULLS, "NoNullsValidator", ["any"], "=", 0, {"nulls": COUNT_NULLS}, "nulls", indicator="nulls > 0"),
    BuiltIn(NAME_ZEROS, "NoZerosValidator", NUMERIC, "=", 0, {"zeros": COUNT_ZEROS}, "zeros", indicator="zeros > 0"),
    BuiltIn(NAME_INTEGRAL_TEXT, "NoNumericValuesTextualValidator", ["String"], "=", 0, {"whole": COUNT_INTEGERS},
            "whole", indicator="whole > 0"),
    BuiltIn(NAME_NON_POSITIVE, "NoNumericValuesSmaller0Validator", NUMERIC, "=", 0, {"low": COUNT_MIN_NUMERIC},
            "low", indicator="low > 0"),
    BuiltIn(NAME_CONSTANT, "NoColumnsWithConstantValuesValidator", ["any"], ">", 1, {"values": COUNT_UNIQUES}, "values",
            kept={"values": COUNT_DUPLICATES}, indicator="groups = 1", extra={"groups": COUNT_DUPLICATES}),
    BuiltIn(NAME_DUPLICATE_ROWS, "NoDuplicatesInRowsValidator", [], "=", 0, {**_ROWS, "different": DISTINCTNESS},
            "rows - different", kept={"different": COUNT_DUPLICATES},
            indicator="repeated > 0", extra={"repeated": DUPLICATE_GROUPS}),
    BuiltIn(NAME_DUPLICATE_VALUES, "NoDuplicatesInSpecificColumnValidator", ["any"], "=", 0,
            {**_ROWS, "values": COUNT_UNIQUES}, "rows - values", kept={"values": COUNT_DUPLICATES},
            indicator="repeated > 0", extra={"repeated": DUPLICATE_GROUPS}),
    BuiltIn(NAME_DUPLICATE_COLUMNS, "NoDuplicatesColumnsNamesValidator", [], "=", 0, {"names": DUPLICATE_COLUMNS}, "names"),
    BuiltIn(NAME_FRESH, "DataISFreshValidator", ["Date"], ">=", -2, {"days": MAX_DAYS}, "days"),
]
ROW_LEVEL = (COUNT_ROWS, DUPLICATE_COLUMNS)  # of the table, whatever columns a check has


def _measure_entries() -> list[dict]:
    """The measures of all built-in checks as metric entries: one per name and level."""
    out: dict[tuple, dict] = {}
    for check in BUILT_INS:
        for name, definition in check.measures.items():
            table = definition in ROW_LEVEL or not check.types
            key = (name, table)
            entry = out.setdefault(key, {"metricName": name, "definitionName": definition,
                                         "metricType": "Dataset" if table else "Column", "types": []})
            entry["types"] = ["any"] if table or "any" in check.types else sorted({*entry["types"], *check.types})
    return list(out.values())


def _bound_value(check: BuiltIn) -> str:
    """The value with each column measure's name followed by the column's."""
    if not check.types:
        return check.value
    words = [w if check.measures.get(w) in (*ROW_LEVEL, None) else f"{w}_${{column}}" for w in check.value.split()]
    return " ".join(words)


def _checked(check: BuiltIn, **entry) -> dict:
    return {**entry, "operator": check.operator, "threshold": check.threshold, "types": check.types}


EXPRESSION_CONFIG = {"metrics": _measure_entries(),
                     "checks": [_checked(c, checkName=c.name, expression=_bound_value(c)) for c in BUILT_INS]}

# Validators: the names are registry keys (see assay.plans.validator_checks).
VALIDATOR_CONFIG = {"validators": [_checked(c, name=c.validator, description=c.name) for c in BUILT_INS]}

# SQL templates.  {table} is the table under test, {column} the column (for
# table-level templates: every column, comma separated), {as_of} the
# freshness reference date.  Each returns one row with a column `metricName`;
# most are 0/1 indicators ("some offending row exists").  Numeric tests parse
# text with try_cast so they cannot raise under ANSI mode.  These texts say what
# the checks mean; run_sql_checks computes an entry with one of them from the
# fused metrics (BUILT_INS has its measures) and runs any other text as written.
_INDICATOR = "SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS metricName FROM {table}"
INTEGRAL_TEXT_SQL = is_integral_text("{column}")

SQL_CONFIG = {
    "checks": [
        {"checkName": NAME_ROWS, "query": _INDICATOR, "metricType": "Dataset", "types": ["any"],
         "operator": ">", "threshold": 0},
        {"checkName": NAME_NULLS, "query": _INDICATOR + " WHERE {column} IS NULL", "metricType": "Column",
         "types": ["any"], "operator": "=", "threshold": 0},
        {"checkName": NAME_ZEROS, "query": _INDICATOR + " WHERE try_cast({column} AS DOUBLE) = 0",
         "metricType": "Column", "types": NUMERIC, "operator": "=", "threshold": 0},
        {"checkName": NAME_INTEGRAL_TEXT, "query": _INDICATOR + " WHERE " + INTEGRAL_TEXT_SQL,
         "metricType": "Column", "types": ["String"], "operator": "=", "threshold": 0},
        {"checkName": NAME_NON_POSITIVE, "query": _INDICATOR + " WHERE try_cast({column} AS DOUBLE) <= 0",
         "metricType": "Column", "types": NUMERIC, "operator": "=", "threshold": 0},
        {"checkName": NAME_CONSTANT,
         "query": "SELECT CASE WHEN count_if(n > 0) = 1 THEN 1 ELSE 0 END AS metricName "
                  "FROM (SELECT count(*) AS n FROM {table} GROUP BY {column})",
         "metricType": "Column", "types": ["any"], "operator": "=", "threshold": 0},
        {"checkName": NAME_DUPLICATE_ROWS,
         "query": "SELECT CASE WHEN count_if(n > 1) > 0 THEN 1 ELSE 0 END AS metricName "
                  "FROM (SELECT count(*) AS n FROM {table} GROUP BY {column})",
         "metricType": "Dataset", "types": ["any"], "operator": "=", "threshold": 0},
        {"checkName": NAME_DUPLICATE_VALUES,
         "query": "SELECT CASE WHEN count_if(n > 1 AND v IS NOT NULL) > 0 THEN 1 ELSE 0 END AS metricName "
                  "FROM (SELECT {column} AS v, count(*) AS n FROM {table} GROUP BY {column})",
         "metricType": "Column", "types": ["any"], "operator": "=", "threshold": 0},
        {"checkName": NAME_FRESH,
         "query": "SELECT max(datediff(try_cast({column} AS DATE), {as_of})) AS metricName FROM {table}",
         "metricType": "Column", "types": ["Date"], "operator": ">=", "threshold": -2},
    ]
}

#: Built-in checks by the text of their template.
COMPILED_SQL = {e["query"]: next(c for c in BUILT_INS if c.name == e["checkName"]) for e in SQL_CONFIG["checks"]}
