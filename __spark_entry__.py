"""

Every query reads the driver tables (or tables derived from them by a fixed
formula, see ``assay.sources.derived``) in full.  Doubles are rounded on both
sides (6 decimals; 2 for large sums) so summation order cannot change a hash.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.functions.exact import exact_sum
from assay.functions.predicates import quote
from assay.operators.footers import table_metrics
from assay.operators.metrics import Metric, NamedMetric, compute_metrics
from assay.operators.schema import declared_columns
from assay.plans.catalogue import (
    COUNT_DUPLICATES,
    COUNT_EMPTIES,
    COUNT_INTEGERS,
    COUNT_MIN_NUMERIC,
    COUNT_NULLS,
    COUNT_UNIQUES,
    COUNT_ZEROS,
    DISTINCTNESS,
    EXPRESSION_CONFIG,
    MAX_DAYS,
    NAME_CONSTANT,
    NAME_DUPLICATE_COLUMNS,
    NAME_DUPLICATE_ROWS,
    NAME_DUPLICATE_VALUES,
    NAME_FRESH,
    NAME_INTEGRAL_TEXT,
    NAME_NON_POSITIVE,
    NAME_NULLS,
    NAME_ROWS,
    NAME_ZEROS,
    ast_metric,
    definition_metric,
)
from assay.plans.evaluate import CheckPlan, evaluate
from assay.plans.expression_checks import run_expression_checks
from assay.plans.report import check_report
from assay.plans.source_report import source_report
from assay.plans.sql_checks import run_sql_checks
from assay.plans.validator_checks import run_validator_checks
from assay.sources.derived import load, oracle_sql as derived_sql
from assay.sources.io import amplify, read_table, read_verdicts, write_comparison, write_metrics, write_verdicts
from assay.state import TableState, state_report

SF_SMOKE = "/root/testdata/sf0.001"
AS_OF = "2024-02-01"


# --------------------------------------------------------------------------- helpers
def _long(df: DataFrame, named: list[NamedMetric], **kw) -> DataFrame:
    m = compute_metrics(df, named, **kw)
    return m.select("metric", "column", F.round("value", 6).alias("value"))


def _per_column(df: DataFrame, metric_name: str, definition: str, cols: list[str] | None = None,
                as_of=None) -> list[NamedMetric]:
    decl = {c.name: c for c in declared_columns(df)}
    cols = cols or list(decl)
    return [NamedMetric(metric_name, c, f"{metric_name}_{c}", definition_metric(definition, [decl[c]], as_of))
            for c in cols]


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _src(table: str) -> str:
    return derived_sql(table)


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _metric_row(metric: str, column: str, value_sql: str, table: str, digits: int = 6) -> str:
    return (f"SELECT {_s(metric)} AS metric, {_s(column)} AS \"column\", "
            f"ROUND(CAST(({value_sql}) AS DOUBLE), {digits}) AS value FROM {_src(table)} t")


def _integral_sql(col: str) -> str:
    text = f"CAST({col} AS VARCHAR)"
    bare = f"trim({text}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    digits = f"ltrim(split_part({bare}, '.', 1), '+')"
    return (f"(regexp_full_match({bare}, '[-+]?[0-9]+([.]0*)?') AND "
            f"TRY_CAST({digits} AS BIGINT) IS NOT NULL)")


def _ndv_keep(table: str, cols: list[str], where: str = "TRUE") -> str:
    keys = ", ".join(_q(c) for c in cols)
    return f"(SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {_src(table)} s WHERE {where}))"


def _not_all_null(cols: list[str]) -> str:
    return "NOT (" + " AND ".join(f"{_q(c)} IS NULL" for c in cols) + ")"


def _ndv_drop(table: str, cols: list[str], where: str = "TRUE") -> str:
    return _ndv_keep(table, cols, f"({where}) AND {_not_all_null(cols)}")


def _distinctness(table: str, cols: list[str], where: str = "TRUE") -> str:
    keys = ", ".join(_q(c) for c in cols)
    return (f"(SELECT sum(1) FROM (SELECT DISTINCT {keys} FROM {_src(table)} s "
            f"WHERE ({where}) AND {_not_all_null(cols)}))")


def _dup_groups(table: str, cols: list[str], keep_nulls: bool) -> str:
    keys = ", ".join(_q(c) for c in cols)
    having = "count(*) > 1" if keep_nulls else f"count(*) > 1 AND {_not_all_null(cols)}"
    return f"(SELECT count(*) FROM (SELECT 1 FROM {_src(table)} s GROUP BY {keys} HAVING {having}))"


# Declared columns of the tables used by verdict oracles (mirrors df.schema).
TABLE_COLUMNS = {
    "dirty_customer": [("k", "Int"), ("seg", "String"), ("bal", "Double")],
    "events": [("event_id", "Int"), ("ts", "Date"), ("user_id", "Int"), ("event_type", "String"),
               ("value", "Double"), ("props", "String")],
    "constant_with_nulls": [("state", "String"), ("nothing", "Int"), ("size_band", "String"),
                            ("o_orderdate", "Date")],
    "orders": [("o_orderkey", "Int"), ("o_custkey", "Int"), ("o_orderstatus", "String"),
               ("o_totalprice", "Double"), ("o_orderdate", "Date"), ("o_orderpriority", "String")],
    "pages": [("page_id", "Int"), ("url", "String"), ("html", "String")],
    "conversations": [("conv_id", "Int"), ("turn", "Int"), ("role", "String"), ("text", "String")],
    "documents": [("doc_id", "Int"), ("text", "String"), ("lang", "String"), ("source", "String"),
                  ("n_chars", "Int")],
    "lineitem": [("l_orderkey", "Int"), ("l_partkey", "Int"), ("l_suppkey", "Int"), ("l_linenumber", "Int"),
                 ("l_quantity", "Double"), ("l_extendedprice", "Double"), ("l_discount", "Double"),
                 ("l_tax", "Double"), ("l_returnflag", "String"), ("l_linestatus", "String"),
                 ("l_shipdate", "Date")],
}

NUMERIC = ("Int", "Double")


def _verdict_rows(table: str, strategy: str) -> list[tuple[str, str, str, float]]:
    """(checkName, value SQL, operator, threshold) of the default checks, by strategy."""
    cols = TABLE_COLUMNS[table]
    names = [c for c, _ in cols]
    src = _src(table)
    rows_sql = f"(SELECT count(*) FROM {src} s)"

    def agg(expr: str) -> str:
        return f"(SELECT {expr} FROM {src} s)"

    out = []
    ind = (lambda cond: f"CASE WHEN {cond} THEN 1 ELSE 0 END")
    if strategy == "sql":
        out.append((NAME_ROWS, ind(f"{rows_sql} > 0"), ">", 0))
    else:
        out.append((NAME_ROWS, rows_sql, ">", 0))
    for c, t in cols:
        qc = _q(c)
        nulls = agg(f"count(*) FILTER (WHERE {qc} IS NULL)")
        zeros = agg(f"count(*) FILTER (WHERE TRY_CAST({qc} AS DOUBLE) = 0)")
        integral = agg(f"count(*) FILTER (WHERE {_integral_sql(qc)})")
        nonpos = agg(f"count(*) FILTER (WHERE TRY_CAST({qc} AS DOUBLE) <= 0)")
        fresh = agg(f"max(date_diff('day', DATE {_s(AS_OF)}, CAST({qc} AS DATE)))")
        ndv_drop = _ndv_drop(table, [c])
        ndv_keep = _ndv_keep(table, [c])
        name = lambda tmpl: tmpl.replace("${column}", c)
        if strategy == "sql":
            out.append((name(NAME_NULLS), ind(f"{nulls} > 0"), "=", 0))
        else:
            out.append((name(NAME_NULLS), nulls, "=", 0))
        if t in NUMERIC:
            for nm, v in ((NAME_ZEROS, zeros), (NAME_NON_POSITIVE, nonpos)):
                out.append((name(nm), ind(f"{v} > 0") if strategy == "sql" else v, "=", 0))
        if t == "String":
            out.append((name(NAME_INTEGRAL_TEXT), ind(f"{integral} > 0") if strategy == "sql" else integral, "=", 0))
        if strategy == "sql":
            out.append((name(NAME_CONSTANT), ind(f"{ndv_keep} = 1"), "=", 0))
            out.append((name(NAME_DUPLICATE_VALUES), ind(f"{_dup_groups(table, [c], False)} > 0"), "=", 0))
        elif strategy == "expression":
            out.append((name(NAME_CONSTANT), ndv_drop, ">", 1))
            out.append((name(NAME_DUPLICATE_VALUES), f"{rows_sql} - {ndv_drop}", "=", 0))
        else:
            out.append((name(NAME_CONSTANT), ndv_keep, ">", 1))
            out.append((name(NAME_DUPLICATE_VALUES), f"{rows_sql} - {ndv_keep}", "=", 0))
        if t == "Date":
            out.append((name(NAME_FRESH), fresh, ">=", -2))
    if strategy == "sql":
        out.append((NAME_DUPLICATE_ROWS, ind(f"{_dup_groups(table, names, True)} > 0"), "=", 0))
    elif strategy == "expression":
        out.append((NAME_DUPLICATE_ROWS, f"{rows_sql} - {_distinctness(table, names)}", "=", 0))
        out.append((NAME_DUPLICATE_COLUMNS, "0", "=", 0))
    else:
        out.append((NAME_DUPLICATE_ROWS, f"{rows_sql} - {_ndv_keep(table, names)}", "=", 0))
        out.append((NAME_DUPLICATE_COLUMNS, "0", "=", 0))
    return out


def _status_sql(value: str, op: str, thr: float) -> str:
    op = "=" if op == "==" else op
    return f"COALESCE(CAST(({value}) AS DOUBLE) {op} {float(thr)}, false)"


def _verdict_sql(table: str, strategy: str, with_table: bool = False, with_value: bool = True) -> str:
    parts = []
    for name, value, op, thr in _verdict_rows(table, strategy):
        cols = [f"{_s(strategy)} AS strategy"]
        if with_table:
            cols.append(f"{_s(table)} AS \"table\"")
        cols.append(f"{_s(name)} AS checkName")
        if with_value:
            cols.append(f"ROUND(CAST(({value}) AS DOUBLE), 6) AS value")
        cols.append(f"{_status_sql(value, op, thr)} AS status")
        parts.append("SELECT " + ", ".join(cols))
    return _union(parts)


def _verdicts(df: DataFrame, strategy: str, table: str | None = None, with_value: bool = True) -> DataFrame:
    if strategy == "sql":
        v = run_sql_checks(df, as_of=AS_OF)
    elif strategy == "expression":
        v = run_expression_checks(df, as_of=AS_OF)
    else:
        v = run_validator_checks(df, as_of=AS_OF)
    cols = [F.lit(strategy).alias("strategy")]
    if table:
        cols.append(F.lit(table).alias("table"))
    cols.append("checkName")
    if with_value:
        cols.append(F.round("value", 6).alias("value"))
    cols.append("status")
    return v.select(*cols)


# --------------------------------------------------------------------------- queries
def q_row_counts(spark, sf):
    li = load(spark, sf, "lineitem")
    return _long(li, [
        NamedMetric("rows", "*", "rows", Metric("size")),
        NamedMetric("returned", "l_returnflag", "returned", Metric("size", where="l_returnflag = 'R'")),
        NamedMetric("bulk", "l_quantity", "bulk", Metric("size", where="l_quantity > 25")),
    ])


def o_row_counts():
    return _union([
        _metric_row("rows", "*", "count(*)", "lineitem"),
        _metric_row("returned", "l_returnflag", "count(*) FILTER (WHERE l_returnflag = 'R')", "lineitem"),
        _metric_row("bulk", "l_quantity", "count(*) FILTER (WHERE l_quantity > 25)", "lineitem"),
    ])


LABELLED_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


def q_null_counts(spark, sf):
    df = load(spark, sf, "labelled_documents")
    return _long(df, _per_column(df, "countNulls", COUNT_NULLS))


def o_null_counts():
    return _union([_metric_row("countNulls", c, f"count(*) FILTER (WHERE {_q(c)} IS NULL)", "labelled_documents")
                   for c in LABELLED_COLS])


LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax"]


def q_zero_counts(spark, sf):
    li = load(spark, sf, "lineitem")
    return _long(li, _per_column(li, "countZeros", COUNT_ZEROS, LINEITEM_NUMERIC))


def o_zero_counts():
    return _union([_metric_row("countZeros", c, f"count(*) FILTER (WHERE {_q(c)} = 0)", "lineitem")
                   for c in LINEITEM_NUMERIC])


CUSTOMER_NUMERIC = ["c_custkey", "c_nationkey", "c_acctbal"]


def q_nonpositive_counts(spark, sf):
    c = load(spark, sf, "customer")
    return _long(c, _per_column(c, "countMinNumeric", COUNT_MIN_NUMERIC, CUSTOMER_NUMERIC))


def o_nonpositive_counts():
    return _union([_metric_row("countMinNumeric", c, f"count(*) FILTER (WHERE {_q(c)} <= 0)", "customer")
                   for c in CUSTOMER_NUMERIC])


DIRTY = ["k", "seg", "bal"]


def q_empty_counts(spark, sf):
    d = load(spark, sf, "dirty_customer")
    return _long(d, _per_column(d, "countEmpties", COUNT_EMPTIES))


def o_empty_counts():
    return _union([_metric_row("countEmpties", c, f"count(*) FILTER (WHERE CAST({_q(c)} AS VARCHAR) = '')",
                               "dirty_customer") for c in DIRTY])


STRINGLY = ["ok", "ck", "status", "price", "priority"]


def q_integral_text_counts(spark, sf):
    d = load(spark, sf, "dirty_customer")
    s = load(spark, sf, "stringly_orders")
    a = _long(d, _per_column(d, "countIntegers", COUNT_INTEGERS, ["seg"]))
    b = _long(s, _per_column(s, "countIntegers", COUNT_INTEGERS))
    return a.unionByName(b)


def o_integral_text_counts():
    parts = [_metric_row("countIntegers", "seg", f"count(*) FILTER (WHERE {_integral_sql(_q('seg'))})",
                         "dirty_customer")]
    parts += [_metric_row("countIntegers", c, f"count(*) FILTER (WHERE {_integral_sql(_q(c))})", "stringly_orders")
              for c in STRINGLY]
    return _union(parts)


def q_text_number_counts(spark, sf):
    """Zero and non-positive tests on numbers held as text (parsed, never raising)."""
    s = load(spark, sf, "stringly_orders")
    return _long(s, _per_column(s, "countZeros", COUNT_ZEROS) + _per_column(s, "countMinNumeric", COUNT_MIN_NUMERIC))


def o_text_number_counts():
    parts = [_metric_row("countZeros", c, f"count(*) FILTER (WHERE TRY_CAST({_q(c)} AS DOUBLE) = 0)",
                         "stringly_orders") for c in STRINGLY]
    parts += [_metric_row("countMinNumeric", c, f"count(*) FILTER (WHERE TRY_CAST({_q(c)} AS DOUBLE) <= 0)",
                          "stringly_orders") for c in STRINGLY]
    return _union(parts)


FRESH = [("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate")]


def q_freshness(spark, sf):
    parts = []
    for table, col in FRESH:
        df = load(spark, sf, table)
        parts.append(_long(df, _per_column(df, "freshness", MAX_DAYS, [col], as_of=AS_OF)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def o_freshness():
    return _union([_metric_row("freshness", c, f"max(date_diff('day', DATE {_s(AS_OF)}, CAST({_q(c)} AS DATE)))", t)
                   for t, c in FRESH])


CONDITIONAL = [
    # name, column label, metric, oracle aggregate, digits
    ("count_discount_returned", "l_discount", Metric("count", ("l_discount",), "l_returnflag = 'R'"),
     "count(l_discount) FILTER (WHERE l_returnflag = 'R')", 6),
    ("min_price_open", "l_extendedprice", Metric("min", ("l_extendedprice",), "l_linestatus = 'O'"),
     "min(l_extendedprice) FILTER (WHERE l_linestatus = 'O')", 6),
    ("max_discounted_qty", "l_quantity", Metric("max", ("l_quantity * l_discount",), "l_shipdate >= DATE '1998-01-01'"),
     "max(l_quantity * l_discount) FILTER (WHERE l_shipdate >= DATE '1998-01-01')", 6),
    ("sum_revenue_a", "l_extendedprice", Metric("sum", ("l_extendedprice * (1 - l_discount)",), "l_returnflag = 'A'"),
     "sum(l_extendedprice * (1 - l_discount)) FILTER (WHERE l_returnflag = 'A')", 2),
    ("avg_tax", "l_tax", Metric("avg", ("l_tax",)), "avg(l_tax)", 6),
    ("stddev_price_small", "l_extendedprice", Metric("stddev_pop", ("l_extendedprice",), "l_quantity < 10"),
     "stddev_pop(l_extendedprice) FILTER (WHERE l_quantity < 10)", 6),
    ("stddev_tax_closed_normal", "l_tax", Metric("stddev_pop", ("l_tax",), "l_returnflag = 'N' AND l_linestatus = 'F'"),
     "stddev_pop(l_tax) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'F')", 6),
]


def q_conditional_aggregates(spark, sf):
    li = load(spark, sf, "lineitem")
    named = [NamedMetric(n, c, n, m) for n, c, m, _, _ in CONDITIONAL]
    m = compute_metrics(li, named)
    digits = {n: d for n, _, _, _, d in CONDITIONAL}
    value = F.coalesce(*[F.when(F.col("metric") == n, F.round("value", d)) for n, d in digits.items()])
    return m.select("metric", "column", value.alias("value"))


def o_conditional_aggregates():
    return _union([_metric_row(n, c, o, "lineitem", d) for n, c, _, o, d in CONDITIONAL])


USER_METRICS = [
    ("max_name_length", "c_name", ast_metric("max", "length(c_name)"), "max(length(c_name))"),
    ("nations_positive", "c_nationkey", ast_metric("countdistinct", "c_nationkey", "c_acctbal > 0"),
     "count(DISTINCT c_nationkey) FILTER (WHERE c_acctbal > 0)"),
    ("building_rows", "*", ast_metric("count", "*", "c_mktsegment = 'BUILDING'"),
     "count(*) FILTER (WHERE c_mktsegment = 'BUILDING')"),
    ("min_balance", "c_acctbal", ast_metric("MIN", "c_acctbal"), "min(c_acctbal)"),
    ("avg_balance_low_nation", "c_acctbal", ast_metric("avg", "c_acctbal", "c_nationkey < 10"),
     "avg(c_acctbal) FILTER (WHERE c_nationkey < 10)"),
    ("negative_balances", "c_acctbal", ast_metric("count", "c_acctbal", "c_acctbal < 0"),
     "count(c_acctbal) FILTER (WHERE c_acctbal < 0)"),
    ("balance_range", "c_acctbal", Metric("aggregate", ("max(c_acctbal) - min(c_acctbal)",)),
     "max(c_acctbal) - min(c_acctbal)"),
]


def q_user_defined_metrics(spark, sf):
    c = load(spark, sf, "customer")
    return _long(c, [NamedMetric(n, col, n, m) for n, col, m, _ in USER_METRICS])


def o_user_defined_metrics():
    return _union([_metric_row(n, col, o, "customer") for n, col, _, o in USER_METRICS])


def q_distinct_drop_nulls(spark, sf):
    df = load(spark, sf, "labelled_documents")
    return _long(df, _per_column(df, "countDistinctValues", COUNT_UNIQUES))


def o_distinct_drop_nulls():
    return _union([_metric_row("countDistinctValues", c, f"count(DISTINCT {_q(c)})", "labelled_documents")
                   for c in LABELLED_COLS])


def q_distinct_keep_nulls(spark, sf):
    df = load(spark, sf, "labelled_documents")
    named = [NamedMetric("distinctWithNull", c, f"distinctWithNull_{c}", Metric("distinct_keep_nulls", (quote(c),)))
             for c in df.columns]
    return _long(df, named)


def o_distinct_keep_nulls():
    return _union([f"SELECT 'distinctWithNull' AS metric, {_s(c)} AS \"column\", "
                   f"CAST({_ndv_keep('labelled_documents', [c])} AS DOUBLE) AS value" for c in LABELLED_COLS])


MULTI = [("conversations", ["conv_id", "role"]), ("labelled_documents", ["quality", "toxic"]),
         ("all_null_rows", ["ok", "ck"])]


def q_distinct_multi_column(spark, sf):
    parts = []
    for table, cols in MULTI:
        df = load(spark, sf, table)
        m = ast_metric("countdistinct", ", ".join(cols))
        parts.append(_long(df, [NamedMetric("countDistinct", f"{table}:{','.join(cols)}", "k", m)]))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def o_distinct_multi_column():
    return _union([f"SELECT 'countDistinct' AS metric, {_s(t + ':' + ','.join(cols))} AS \"column\", "
                   f"CAST({_ndv_drop(t, cols)} AS DOUBLE) AS value" for t, cols in MULTI])


DISTINCTNESS_CASES = [
    ("lineitem", ["l_returnflag", "l_linestatus"], "l_quantity > 10"),
    ("labelled_documents", ["quality", "toxic"], "lang = 'en'"),
    ("all_null_rows", ["ok", "ck"], "ok IS NULL"),
]


def q_distinct_groups_where(spark, sf):
    parts = []
    for table, cols, where in DISTINCTNESS_CASES:
        df = load(spark, sf, table)
        decl = [c for c in declared_columns(df) if c.name in cols]
        m = definition_metric(DISTINCTNESS, decl, where=where)
        parts.append(_long(df, [NamedMetric("distinctGroups", f"{table}:{','.join(cols)}", "k", m)]))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def o_distinct_groups_where():
    return _union([f"SELECT 'distinctGroups' AS metric, {_s(t + ':' + ','.join(cols))} AS \"column\", "
                   f"CAST({_distinctness(t, cols, w)} AS DOUBLE) AS value" for t, cols, w in DISTINCTNESS_CASES])


ROWS_TABLES = ["dirty_customer", "all_null_rows", "lineitem"]
ALL_COLS = {"dirty_customer": DIRTY, "all_null_rows": ["ok", "ck"],
            "lineitem": [c for c, _ in TABLE_COLUMNS["lineitem"]],
            "constant_with_nulls": [c for c, _ in TABLE_COLUMNS["constant_with_nulls"]]}


def q_distinct_rows(spark, sf):
    parts = []
    for table in ROWS_TABLES:
        df = load(spark, sf, table)
        m = definition_metric(COUNT_DUPLICATES, declared_columns(df))
        parts.append(_long(df, [NamedMetric("distinctRows", table, "k", m)]))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def o_distinct_rows():
    return _union([f"SELECT 'distinctRows' AS metric, {_s(t)} AS \"column\", "
                   f"CAST({_ndv_keep(t, ALL_COLS[t])} AS DOUBLE) AS value" for t in ROWS_TABLES])


def q_duplicate_surplus(spark, sf):
    """Rows minus distinct values per column, with nulls dropped and with nulls kept."""
    d = load(spark, sf, "dirty_customer")
    r = check_report(d, as_of=AS_OF, strategies=("expression", "validator"))
    v = r.verdicts.where(F.col("checkName").startswith("No Duplicate rows in specific column"))
    return v.select("strategy", "checkName", F.round("value", 6).alias("value"))


def o_duplicate_surplus():
    parts = []
    rows = "(SELECT count(*) FROM " + _src("dirty_customer") + " s)"
    for c in DIRTY:
        name = NAME_DUPLICATE_VALUES.replace("${column}", c)
        parts.append(f"SELECT 'expression' AS strategy, {_s(name)} AS checkName, "
                     f"CAST({rows} - {_ndv_drop('dirty_customer', [c])} AS DOUBLE) AS value")
        parts.append(f"SELECT 'validator' AS strategy, {_s(name)} AS checkName, "
                     f"CAST({rows} - {_ndv_keep('dirty_customer', [c])} AS DOUBLE) AS value")
    return _union(parts)


SURPLUS_TABLES = ["dirty_customer", "all_null_rows"]


def q_duplicate_row_surplus(spark, sf):
    """Rows minus distinct rows: nulls-dropped (distinctness) and nulls-kept policies."""
    parts = []
    for table in SURPLUS_TABLES:
        df = load(spark, sf, table)
        cols = declared_columns(df)
        metrics = [NamedMetric("rows", table, "rows", Metric("size")),
                   NamedMetric("groups_drop", table, "groups_drop", definition_metric(DISTINCTNESS, cols)),
                   NamedMetric("groups_keep", table, "groups_keep", definition_metric(COUNT_DUPLICATES, cols))]
        plans = [CheckPlan(f"{table}:drop", metrics, "rows - groups_drop", "=", 0),
                 CheckPlan(f"{table}:keep", metrics, "rows - groups_keep", "=", 0)]
        _, v = evaluate(df, plans)
        parts.append(v.select("checkName", F.round("value", 6).alias("value"), "status"))
    return parts[0].unionByName(parts[1])


def o_duplicate_row_surplus():
    parts = []
    for t in SURPLUS_TABLES:
        rows = f"(SELECT count(*) FROM {_src(t)} s)"
        drop = f"{rows} - {_distinctness(t, ALL_COLS[t])}"
        keep = f"{rows} - {_ndv_keep(t, ALL_COLS[t])}"
        for label, v in (("drop", drop), ("keep", keep)):
            parts.append(f"SELECT {_s(t + ':' + label)} AS checkName, CAST(({v}) AS DOUBLE) AS value, "
                         f"{_status_sql(v, '=', 0)} AS status")
    return _union(parts)


def q_duplicate_groups_column(spark, sf):
    d = load(spark, sf, "dirty_customer")
    named = [NamedMetric("duplicateGroups", c, f"dg_{c}", Metric("duplicate_groups", (quote(c),))) for c in DIRTY]
    return _long(d, named)


def o_duplicate_groups_column():
    return _union([f"SELECT 'duplicateGroups' AS metric, {_s(c)} AS \"column\", "
                   f"CAST({_dup_groups('dirty_customer', [c], False)} AS DOUBLE) AS value" for c in DIRTY])


def q_duplicate_groups_rows(spark, sf):
    parts = []
    for table in SURPLUS_TABLES:
        df = load(spark, sf, table)
        keys = tuple(quote(c) for c in df.columns)
        parts.append(_long(df, [NamedMetric("duplicateRowGroups", table, "k",
                                            Metric("duplicate_groups_keep_nulls", keys))]))
    return parts[0].unionByName(parts[1])


def o_duplicate_groups_rows():
    return _union([f"SELECT 'duplicateRowGroups' AS metric, {_s(t)} AS \"column\", "
                   f"CAST({_dup_groups(t, ALL_COLS[t], True)} AS DOUBLE) AS value" for t in SURPLUS_TABLES])


def q_constant_columns(spark, sf):
    df = load(spark, sf, "constant_with_nulls")
    named = []
    for c in df.columns:
        named.append(NamedMetric("groupsWithNull", c, f"gk_{c}", Metric("distinct_keep_nulls", (quote(c),))))
        named.append(NamedMetric("groupsWithoutNull", c, f"gd_{c}", Metric("distinct", (quote(c),))))
    m = compute_metrics(df, named)
    return m.select("metric", "column", "value",
                    (F.col("value") == 1).alias("is_constant"))


def o_constant_columns():
    parts = []
    for c in ALL_COLS["constant_with_nulls"]:
        for metric, v in (("groupsWithNull", _ndv_keep("constant_with_nulls", [c])),
                          ("groupsWithoutNull", _ndv_drop("constant_with_nulls", [c]))):
            parts.append(f"SELECT {_s(metric)} AS metric, {_s(c)} AS \"column\", CAST({v} AS DOUBLE) AS value, "
                         f"({v}) = 1 AS is_constant")
    return _union(parts)


def q_duplicate_column_names(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    o = load(spark, sf, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey")
    joined = c.join(o, c["key"] == o["key"])
    named = [NamedMetric("rows", "joined", "rows", Metric("size")),
             NamedMetric("duplicateColumns", "joined", "dup", Metric("duplicate_columns"))]
    a = _long(joined, named)
    b = _long(c, [NamedMetric("rows", "customer", "rows", Metric("size")),
                  NamedMetric("duplicateColumns", "customer", "dup", Metric("duplicate_columns"))])
    return a.unionByName(b)


def o_duplicate_column_names():
    return _union([
        "SELECT 'rows' AS metric, 'joined' AS \"column\", CAST(count(*) AS DOUBLE) AS value "
        "FROM customer JOIN orders ON c_custkey = o_custkey",
        "SELECT 'duplicateColumns', 'joined', 1.0",
        "SELECT 'rows', 'customer', CAST(count(*) AS DOUBLE) FROM customer",
        "SELECT 'duplicateColumns', 'customer', 0.0",
    ])


def q_expanded_checks(spark, sf):
    li = load(spark, sf, "lineitem")
    r = check_report(li, as_of=AS_OF)
    return r.verdicts.select("strategy", "checkName", F.round("value", 6).alias("value"), "status")


def o_expanded_checks():
    return (f"SELECT v.* FROM ({_union([_verdict_sql('lineitem', s) for s in ('sql', 'expression', 'validator')])}) v "
            f"JOIN ({_expanded_names()}) n ON v.strategy = n.strategy AND v.checkName = n.checkName")


# Fixed values: (strategy, check name template, declared types; empty = table-level).
_EXPANSION = [
    (NAME_ROWS, ()), (NAME_NULLS, ("any",)), (NAME_ZEROS, NUMERIC), (NAME_INTEGRAL_TEXT, ("String",)),
    (NAME_NON_POSITIVE, NUMERIC), (NAME_CONSTANT, ("any",)), (NAME_DUPLICATE_ROWS, ()),
    (NAME_DUPLICATE_VALUES, ("any",)), (NAME_DUPLICATE_COLUMNS, ()), (NAME_FRESH, ("Date",)),
]


def _expanded_names():
    decl = ("CASE WHEN data_type IN ('BIGINT','INTEGER','SMALLINT','TINYINT') THEN 'Int' "
            "WHEN data_type IN ('DOUBLE','FLOAT','REAL') OR data_type LIKE 'DECIMAL%' THEN 'Double' "
            "WHEN data_type = 'VARCHAR' THEN 'String' "
            "WHEN data_type = 'DATE' OR data_type LIKE 'TIMESTAMP%' THEN 'Date' ELSE 'Other' END")
    cols = (f"(SELECT column_name, {decl} AS dtype FROM information_schema.columns "
            f"WHERE table_name = 'lineitem')")
    parts = []
    for strategy in ("sql", "expression", "validator"):
        for name, types in _EXPANSION:
            if strategy == "sql" and name == NAME_DUPLICATE_COLUMNS:
                continue
            if not types:
                parts.append(f"SELECT {_s(strategy)} AS strategy, {_s(name)} AS checkName")
                continue
            cond = "TRUE" if "any" in types else "dtype IN (" + ", ".join(_s(t) for t in types) + ")"
            parts.append(f"SELECT {_s(strategy)} AS strategy, replace({_s(name)}, '${{column}}', column_name) "
                         f"AS checkName FROM {cols} c WHERE {cond}")
    return _union(parts)


METRIC_EXPRESSION_CONFIG = {
    "metrics": [
        {"metricName": "countRows", "definitionName": "count rows", "metricType": "Dataset", "types": ["any"]},
        {"metricName": "countNulls", "definitionName": "count nulls", "metricType": "Column", "types": ["any"]},
        {"metricName": "countDistinctValues", "definitionName": "count uniques", "metricType": "Column",
         "types": ["any"]},
        {"metricName": "countZeros", "definitionName": "count zeros", "metricType": "Column",
         "types": ["Double", "Int"]},
        {"metricName": "countMinNumeric", "definitionName": "count min numeric", "metricType": "Column",
         "types": ["Double", "Int"]},
        {"metricName": "maxBalance", "aggFunction": "max", "columnExpr": "bal", "metricType": "Dataset",
         "types": ["any"]},
    ],
    "checks": [
        {"checkName": "null share ${column}", "expression": "countNulls_${column} / countRows",
         "operator": "<", "threshold": 0.05, "types": ["any"]},
        {"checkName": "distinct percent ${column}", "expression": "countDistinctValues_${column} * 100.0 / countRows",
         "operator": ">=", "threshold": 50, "types": ["any"]},
        {"checkName": "zero or negative ${column}", "expression": "countZeros_${column} + countMinNumeric_${column}",
         "operator": "<=", "threshold": 100, "types": ["Double", "Int"]},
        {"checkName": "rows minus null keys", "expression": "countRows - countNulls_k", "operator": ">",
         "threshold": 1500, "types": []},
        {"checkName": "balance headroom", "expression": "(maxBalance - 9000) * 2", "operator": ">=",
         "threshold": 0, "types": []},
    ],
}


def q_metric_expressions(spark, sf):
    d = load(spark, sf, "dirty_customer")
    v = run_expression_checks(d, METRIC_EXPRESSION_CONFIG)
    return v.select("checkName", F.round("value", 6).alias("value"), "status")


def o_metric_expressions():
    src = _src("dirty_customer")
    rows = f"(SELECT count(*) FROM {src} s)"
    parts = []

    def add(name, v, op, thr):
        parts.append(f"SELECT {_s(name)} AS checkName, ROUND(CAST(({v}) AS DOUBLE), 6) AS value, "
                     f"{_status_sql(v, op, thr)} AS status")

    for c, t in TABLE_COLUMNS["dirty_customer"]:
        nulls = f"(SELECT count(*) FILTER (WHERE {_q(c)} IS NULL) FROM {src} s)"
        add(f"null share {c}", f"CAST({nulls} AS DOUBLE) / {rows}", "<", 0.05)
    for c, t in TABLE_COLUMNS["dirty_customer"]:
        add(f"distinct percent {c}", f"{_ndv_drop('dirty_customer', [c])} * 100.0 / {rows}", ">=", 50)
    for c, t in TABLE_COLUMNS["dirty_customer"]:
        if t in NUMERIC:
            v = (f"(SELECT count(*) FILTER (WHERE TRY_CAST({_q(c)} AS DOUBLE) = 0) + "
                 f"count(*) FILTER (WHERE TRY_CAST({_q(c)} AS DOUBLE) <= 0) FROM {src} s)")
            add(f"zero or negative {c}", v, "<=", 100)
    add("rows minus null keys", f"{rows} - (SELECT count(*) FILTER (WHERE k IS NULL) FROM {src} s)", ">", 1500)
    add("balance headroom", f"((SELECT max(bal) FROM {src} s) - 9000) * 2", ">=", 0)
    return _union(parts)


THRESHOLD_EXPRESSIONS = [("zero", "rows - rows"), ("share", "zero_discount / rows"), ("missing", "nothing")]
THRESHOLDS = [-1, 0, 0.05, 1]
OPS = [">", ">=", "<", "<=", "=", "=="]


def q_threshold_matrix(spark, sf):
    li = load(spark, sf, "lineitem")
    metrics = [NamedMetric("rows", "*", "rows", Metric("size")),
               NamedMetric("zero_discount", "l_discount", "zero_discount", Metric("size", where="l_discount = 0")),
               NamedMetric("nothing", "l_quantity", "nothing", Metric("max", ("l_quantity",), "l_quantity < 0"))]
    plans = [CheckPlan(f"{label} {op} {thr}", metrics, expr, op, thr)
             for label, expr in THRESHOLD_EXPRESSIONS for op in OPS for thr in THRESHOLDS]
    _, v = evaluate(li, plans)
    return v.select("checkName", F.round("value", 6).alias("value"), "status")


def o_threshold_matrix():
    values = {
        "zero": "0",
        "share": "(SELECT CAST(count(*) FILTER (WHERE l_discount = 0) AS DOUBLE) / count(*) FROM lineitem)",
        "missing": "(SELECT max(l_quantity) FILTER (WHERE l_quantity < 0) FROM lineitem)",
    }
    parts = []
    for label, _ in THRESHOLD_EXPRESSIONS:
        v = values[label]
        for op in OPS:
            for thr in THRESHOLDS:
                parts.append(f"SELECT {_s(f'{label} {op} {thr}')} AS checkName, "
                             f"ROUND(CAST(({v}) AS DOUBLE), 6) AS value, {_status_sql(v, op, thr)} AS status")
    return _union(parts)


def q_deduped_metrics(spark, sf):
    """The same definition under several names is computed once and reported under each."""
    o = load(spark, sf, "orders")
    rows = Metric("size")
    urgent = Metric("size", where="o_orderpriority = '1-URGENT'")
    named = [NamedMetric("rows", "*", "rows", rows), NamedMetric("row_count", "*", "row_count", rows),
             NamedMetric("n", "*", "n", rows), NamedMetric("urgent", "o_orderpriority", "urgent", urgent),
             NamedMetric("urgent_again", "o_orderpriority", "urgent_again", urgent),
             NamedMetric("customers", "o_custkey", "customers", Metric("distinct", ("o_custkey",))),
             NamedMetric("customers_again", "o_custkey", "customers_again", Metric("distinct", ("o_custkey",)))]
    return _long(o, named)


def o_deduped_metrics():
    rows, urgent = "count(*)", "count(*) FILTER (WHERE o_orderpriority = '1-URGENT')"
    return _union([
        _metric_row("rows", "*", rows, "orders"), _metric_row("row_count", "*", rows, "orders"),
        _metric_row("n", "*", rows, "orders"), _metric_row("urgent", "o_orderpriority", urgent, "orders"),
        _metric_row("urgent_again", "o_orderpriority", urgent, "orders"),
        _metric_row("customers", "o_custkey", "count(DISTINCT o_custkey)", "orders"),
        _metric_row("customers_again", "o_custkey", "count(DISTINCT o_custkey)", "orders"),
    ])


BATCHED = [("min", "l_quantity"), ("max", "l_quantity"), ("min", "l_discount"), ("max", "l_discount"),
           ("min", "l_tax"), ("max", "l_tax"), ("avg", "l_quantity"), ("avg", "l_discount"), ("count", "l_tax"),
           ("min", "l_extendedprice"), ("max", "l_extendedprice"), ("avg", "l_tax")]


def q_batched_metrics(spark, sf):
    """Twelve metrics computed in passes of at most five aggregates each."""
    li = load(spark, sf, "lineitem")
    named = [NamedMetric(f"{a}_{c}", c, f"{a}_{c}", Metric(a, (c,))) for a, c in BATCHED]
    return _long(li, named, max_metrics_per_pass=5)


def o_batched_metrics():
    return _union([_metric_row(f"{a}_{c}", c, f"{a}({c})", "lineitem") for a, c in BATCHED])


EMPTY_WHERE = "l_quantity < 0"
EMPTY_METRICS = [
    ("rows", Metric("size"), "count(*)"),
    ("count_tax", Metric("count", ("l_tax",)), "count(l_tax)"),
    ("min_tax", Metric("min", ("l_tax",)), "min(l_tax)"),
    ("max_tax", Metric("max", ("l_tax",)), "max(l_tax)"),
    ("sum_tax", Metric("sum", ("l_tax",)), "sum(l_tax)"),
    ("avg_tax", Metric("avg", ("l_tax",)), "avg(l_tax)"),
    ("stddev_tax", Metric("stddev_pop", ("l_tax",)), "stddev_pop(l_tax)"),
    ("distinct_flags", Metric("distinct", ("l_returnflag",)), "count(DISTINCT l_returnflag)"),
]


def q_empty_table_metrics(spark, sf):
    """Empty input: count-like metrics are 0, all others null."""
    li = load(spark, sf, "lineitem").where(EMPTY_WHERE)
    named = [NamedMetric(n, "lineitem", n, m) for n, m, _ in EMPTY_METRICS]
    named.append(NamedMetric("distinctness_flags", "lineitem", "dn", Metric("distinctness", ("l_returnflag",))))
    named.append(NamedMetric("rows_with_nulls", "lineitem", "rk", Metric("distinct_keep_nulls", ("l_returnflag",))))
    return _long(li, named)


def o_empty_table_metrics():
    src = f"(SELECT * FROM lineitem WHERE {EMPTY_WHERE})"
    parts = [f"SELECT {_s(n)} AS metric, 'lineitem' AS \"column\", ROUND(CAST({o} AS DOUBLE), 6) AS value FROM {src} t"
             for n, _, o in EMPTY_METRICS]
    parts.append(f"SELECT 'distinctness_flags', 'lineitem', CAST((SELECT sum(1) FROM (SELECT DISTINCT l_returnflag "
                 f"FROM {src} s WHERE l_returnflag IS NOT NULL)) AS DOUBLE)")
    parts.append(f"SELECT 'rows_with_nulls', 'lineitem', CAST((SELECT count(*) FROM (SELECT DISTINCT l_returnflag "
                 f"FROM {src} s)) AS DOUBLE)")
    return _union(parts)


VERDICT_TABLES = ["dirty_customer", "events"]


def _verdict_query(strategy: str):
    def q(spark, sf):
        parts = [_verdicts(load(spark, sf, t), strategy, table=t) for t in VERDICT_TABLES]
        return parts[0].unionByName(parts[1])
    return q


def _verdict_oracle(strategy: str):
    return lambda: _union([_verdict_sql(t, strategy, with_table=True) for t in VERDICT_TABLES])


BAD_CONFIG = {
    "metrics": [
        {"metricName": "countRows", "definitionName": "count rows", "metricType": "Dataset", "types": ["any"]},
        {"metricName": "badColumn", "aggFunction": "max", "columnExpr": "no_such_column", "metricType": "Dataset",
         "types": ["any"]},
        {"metricName": "badType", "aggFunction": "sum", "columnExpr": "map('a', seg)", "metricType": "Dataset",
         "types": ["any"]},
        {"metricName": "countNulls", "definitionName": "count nulls", "metricType": "Column", "types": ["any"]},
    ],
    "checks": [
        {"checkName": "rows exist", "expression": "countRows", "operator": ">", "threshold": 0, "types": []},
        {"checkName": "bad column", "expression": "badColumn", "operator": ">", "threshold": 0, "types": []},
        {"checkName": "bad type", "expression": "badType", "operator": ">", "threshold": 0, "types": []},
        {"checkName": "unknown metric", "expression": "noSuchMetric + 1", "operator": ">", "threshold": 0,
         "types": []},
        {"checkName": "no nulls ${column}", "expression": "countNulls_${column}", "operator": "=", "threshold": 0,
         "types": ["any"]},
    ],
}


def q_failed_metric_isolated(spark, sf):
    """A metric or check that cannot run fails alone; the rest of the report is intact."""
    d = load(spark, sf, "dirty_customer")
    v = run_expression_checks(d, BAD_CONFIG)
    return v.select("checkName", F.round("value", 6).alias("value"), "status",
                    F.col("error").isNotNull().alias("failed"))


def o_failed_metric_isolated():
    src = _src("dirty_customer")
    parts = [f"SELECT 'rows exist' AS checkName, CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS status, "
             f"false AS failed FROM {src} s"]
    for name in ("bad column", "bad type", "unknown metric"):
        parts.append(f"SELECT {_s(name)}, CAST(NULL AS DOUBLE), false, true")
    for c in DIRTY:
        parts.append(f"SELECT {_s('no nulls ' + c)}, CAST(count(*) FILTER (WHERE {_q(c)} IS NULL) AS DOUBLE), "
                     f"count(*) FILTER (WHERE {_q(c)} IS NULL) = 0, false FROM {src} s")
    return _union(parts)


ALIGN_TABLE = "constant_with_nulls"


def q_aligned_verdicts(spark, sf):
    r = check_report(load(spark, sf, ALIGN_TABLE), as_of=AS_OF)
    return r.aligned


def _aligned_oracle_sql() -> str:
    per = {s: {n: (v, op, thr) for n, v, op, thr in _verdict_rows(ALIGN_TABLE, s)}
           for s in ("sql", "expression", "validator")}
    names = list(dict.fromkeys(n for s in per for n in per[s]))
    parts = []
    for n in names:
        cols = [f"{_s(n)} AS checkName"]
        for s in ("sql", "expression", "validator"):
            if n in per[s]:
                v, op, thr = per[s][n]
                cols.append(f"{_status_sql(v, op, thr)} AS {s}Status")
            else:
                cols.append(f"CAST(NULL AS BOOLEAN) AS {s}Status")
        parts.append("SELECT " + ", ".join(cols))
    return _union(parts)


def o_aligned_verdicts():
    return _aligned_oracle_sql()


def q_verdict_disagreements(spark, sf):
    return check_report(load(spark, sf, ALIGN_TABLE), as_of=AS_OF).disagreements


def o_verdict_disagreements():
    return (f"SELECT * FROM ({_aligned_oracle_sql()}) a WHERE "
            "sqlStatus IS DISTINCT FROM expressionStatus OR expressionStatus IS DISTINCT FROM validatorStatus")


def q_amplified_rows(spark, sf):
    li = amplify(load(spark, sf, "lineitem"), 5)
    keys = tuple(quote(c) for c in li.columns)
    return _long(li, [NamedMetric("rows", "lineitem x5", "rows", Metric("size")),
                      NamedMetric("distinctRows", "lineitem x5", "dr", Metric("distinct_keep_nulls", keys)),
                      NamedMetric("duplicateRowGroups", "lineitem x5", "dg", Metric("duplicate_groups_keep_nulls", keys))])


def o_amplified_rows():
    five = "(" + " UNION ALL ".join(["SELECT * FROM lineitem"] * 5) + ")"
    cols = ", ".join(_q(c) for c in ALL_COLS["lineitem"])
    return _union([
        f"SELECT 'rows' AS metric, 'lineitem x5' AS \"column\", CAST(count(*) AS DOUBLE) AS value FROM {five} f",
        f"SELECT 'distinctRows', 'lineitem x5', CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT {cols} FROM {five} f)",
        f"SELECT 'duplicateRowGroups', 'lineitem x5', CAST(count(*) AS DOUBLE) FROM "
        f"(SELECT 1 FROM {five} f GROUP BY {cols} HAVING count(*) > 1)",
    ])


def _scratch(spark: SparkSession, name: str) -> str:
    from assay.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def q_verdict_sink_roundtrip(spark, sf):
    d = load(spark, sf, "dirty_customer")
    path = _scratch(spark, "verdicts")
    write_verdicts(run_expression_checks(d, as_of=AS_OF).select("checkName", "status"), path)
    return read_verdicts(spark, path)


def o_verdict_sink_roundtrip():
    return f"SELECT checkName, status FROM ({_verdict_sql('dirty_customer', 'expression')}) v"


def q_metric_sink_roundtrip(spark, sf):
    d = load(spark, sf, "dirty_customer")
    path = _scratch(spark, "metrics")
    named = (_per_column(d, "countNulls", COUNT_NULLS) + _per_column(d, "countDistinctValues", COUNT_UNIQUES)
             + [NamedMetric("sumBalance", "bal", "sum_bal", Metric("sum", ("bal",)))])
    write_metrics(compute_metrics(d, named), path)
    back = read_table(spark, path, "csv")
    return back.select("name", "column", F.round(F.col("value").cast("double"), 2).alias("value"))


def o_metric_sink_roundtrip():
    src = "dirty_customer"
    parts = [f"SELECT 'countNulls' AS name, {_s(c)} AS \"column\", "
             f"CAST(count(*) FILTER (WHERE {_q(c)} IS NULL) AS DOUBLE) AS value FROM {_src(src)} s" for c in DIRTY]
    parts += [f"SELECT 'countDistinctValues', {_s(c)}, CAST(count(DISTINCT {_q(c)}) AS DOUBLE) FROM {_src(src)} s"
              for c in DIRTY]
    parts.append(f"SELECT 'sumBalance', 'bal', ROUND(sum(bal), 2) FROM {_src(src)} s")
    return _union(parts)


def q_odd_column_names(spark, sf):
    """Checks over columns whose names hold a space, a dot, a hyphen and a back-quote."""
    df = load(spark, sf, "odd_names")
    v = run_expression_checks(df, EXPRESSION_CONFIG, as_of=AS_OF)
    return v.select("checkName", F.round("value", 6).alias("value"), "status")


def o_odd_column_names():
    src = _src("odd_names")
    cols = [("cust key", "Int"), ("c.name", "String"), ("acct-bal", "Double"), ("seg`tick", "String")]
    rows = f"(SELECT count(*) FROM {src} s)"
    parts = []

    def add(name, v, op, thr):
        parts.append(f"SELECT {_s(name)} AS checkName, ROUND(CAST(({v}) AS DOUBLE), 6) AS value, "
                     f"{_status_sql(v, op, thr)} AS status")

    add(NAME_ROWS, rows, ">", 0)
    for c, t in cols:
        qc = _q(c)
        name = lambda tmpl: tmpl.replace("${column}", c)
        add(name(NAME_NULLS), f"(SELECT count(*) FILTER (WHERE {qc} IS NULL) FROM {src} s)", "=", 0)
        if t in NUMERIC:
            add(name(NAME_ZEROS), f"(SELECT count(*) FILTER (WHERE {qc} = 0) FROM {src} s)", "=", 0)
            add(name(NAME_NON_POSITIVE), f"(SELECT count(*) FILTER (WHERE {qc} <= 0) FROM {src} s)", "=", 0)
        if t == "String":
            add(name(NAME_INTEGRAL_TEXT), f"(SELECT count(*) FILTER (WHERE {_integral_sql(qc)}) FROM {src} s)", "=", 0)
        ndv = f"(SELECT count(DISTINCT {qc}) FROM {src} s)"
        add(name(NAME_CONSTANT), ndv, ">", 1)
        add(name(NAME_DUPLICATE_VALUES), f"{rows} - {ndv}", "=", 0)
    names = [c for c, _ in cols]
    add(NAME_DUPLICATE_ROWS, f"{rows} - {_distinctness('odd_names', names)}", "=", 0)
    add(NAME_DUPLICATE_COLUMNS, "0", "=", 0)
    return _union(parts)


def q_stream_batch_verdicts(spark, sf):
    """lineitem read as a file stream; every micro-batch is checked by all three strategies."""
    from assay.streaming.checks import check_stream

    schema = load(spark, sf, "lineitem").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet")
              .option("maxFilesPerTrigger", 1).parquet(sf))
    sink = _scratch(spark, "stream-verdicts")
    query = check_stream(stream, sink, as_of=AS_OF, trigger={"availableNow": True})
    query.awaitTermination()
    out = spark.read.parquet(sink)
    return out.select("batch_id", "strategy", "checkName", F.round("value", 6).alias("value"), "status")


def o_stream_batch_verdicts():
    parts = [f"SELECT 0 AS batch_id, * FROM ({_verdict_sql('lineitem', s)}) v" for s in ("sql", "expression", "validator")]
    return _union(parts)


def q_csv_source_checks(spark, sf):
    """orders written as CSV, read back as all-string columns with a sidecar schema, staged, checked."""
    path = _scratch(spark, "orders-csv")
    load(spark, sf, "orders").write.option("header", "true").csv(path)
    text = read_table(spark, path, "csv")
    sidecar = [{"columnName": c, "columnType": t} for c, t in TABLE_COLUMNS["orders"]]
    report = check_report(text, types=sidecar, as_of=AS_OF, stage_input=True)
    return report.verdicts.select("strategy", "checkName", F.round("value", 6).alias("value"), "status")


def o_csv_source_checks():
    return _union([_verdict_sql("orders", s) for s in ("sql", "expression", "validator")])


def q_hot_key_metrics(spark, sf):
    """Frequency metrics where one value holds about half of all rows (a skewed key)."""
    df = load(spark, sf, "hot_key_lineitem")
    named = []
    for c in ("line_key", "l_returnflag"):
        for agg in ("distinct", "distinct_keep_nulls", "duplicate_groups"):
            named.append(NamedMetric(agg, c, f"{agg}_{c}", Metric(agg, (quote(c),))))
    keys = tuple(quote(c) for c in ("line_key", "l_returnflag", "l_quantity"))
    named.append(NamedMetric("duplicate_groups_keep_nulls", "*", "rows_dup", Metric("duplicate_groups_keep_nulls", keys)))
    named.append(NamedMetric("hot_rows", "line_key", "hot_rows", Metric("size", where="line_key = 'hot'")))
    return _long(df, named)


def o_hot_key_metrics():
    t = "hot_key_lineitem"
    parts = []
    for c in ("line_key", "l_returnflag"):
        parts.append(f"SELECT 'distinct' AS metric, {_s(c)} AS \"column\", CAST({_ndv_drop(t, [c])} AS DOUBLE) AS value")
        parts.append(f"SELECT 'distinct_keep_nulls', {_s(c)}, CAST({_ndv_keep(t, [c])} AS DOUBLE)")
        parts.append(f"SELECT 'duplicate_groups', {_s(c)}, CAST({_dup_groups(t, [c], False)} AS DOUBLE)")
    parts.append(f"SELECT 'duplicate_groups_keep_nulls', '*', "
                 f"CAST({_dup_groups(t, ['line_key', 'l_returnflag', 'l_quantity'], True)} AS DOUBLE)")
    parts.append(_metric_row("hot_rows", "line_key", "count(*) FILTER (WHERE line_key = 'hot')", t))
    return _union(parts)


TEXT_TABLES = ["pages", "conversations", "documents"]


def q_text_table_checks(spark, sf):
    """All three strategies over whole texts: raw HTML pages, conversation turns, documents."""
    parts = []
    for t in TEXT_TABLES:
        r = check_report(load(spark, sf, t), as_of=AS_OF)
        parts.append(r.verdicts.select(F.lit(t).alias("table"), "strategy", "checkName",
                                       F.round("value", 6).alias("value"), "status"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def o_text_table_checks():
    return _union([_verdict_sql(t, s, with_table=True) for t in TEXT_TABLES
                   for s in ("sql", "expression", "validator")])


HASHED_TABLES = ["dirty_customer", "all_null_rows", "hot_key_lineitem"]
ROW_AGGS = ("distinct", "distinctness", "distinct_keep_nulls", "duplicate_groups", "duplicate_groups_keep_nulls")


def q_hashed_duplicate_rows(spark, sf):
    """Row-level distinct/duplicate counters through the two hash phases (exact)."""
    parts = []
    for t in HASHED_TABLES:
        df = load(spark, sf, t)
        keys = tuple(quote(c) for c in df.columns)
        parts.append(_long(df, [NamedMetric(a, t, f"{a}_{t}", Metric(a, keys)) for a in ROW_AGGS]))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def o_hashed_duplicate_rows():
    cols = {"dirty_customer": DIRTY, "all_null_rows": ["ok", "ck"],
            "hot_key_lineitem": ["line_key", "l_returnflag", "l_quantity"]}
    parts = []
    for t in HASHED_TABLES:
        c = cols[t]
        values = {"distinct": _ndv_drop(t, c), "distinctness": _distinctness(t, c), "distinct_keep_nulls": _ndv_keep(t, c),
                  "duplicate_groups": _dup_groups(t, c, False), "duplicate_groups_keep_nulls": _dup_groups(t, c, True)}
        parts += [f"SELECT {_s(a)} AS metric, {_s(t)} AS \"column\", CAST({values[a]} AS DOUBLE) AS value" for a in ROW_AGGS]
    return _union(parts)


# ---- cases of the configuration surface
WIDE_COPIES = 16


def q_wide_table_report(spark, sf):
    """96 columns, two more of one name, and one bad definition: everything else is as on a narrow table."""
    o = load(spark, sf, "orders")
    wide = o.select(*[F.col(c).alias(f"{c}_{i}") for i in range(WIDE_COPIES) for c in o.columns],
                    F.col("o_custkey").alias("again"), F.col("o_orderkey").alias("again"))
    config = {"metrics": EXPRESSION_CONFIG["metrics"] + [
                  {"metricName": "odd", "definitionName": "no such definition", "metricType": "Dataset", "types": ["any"]}],
              "checks": EXPRESSION_CONFIG["checks"] + [
                  {"checkName": "odd", "expression": "odd", "operator": "=", "threshold": 0, "types": []}]}
    r = check_report(wide, as_of=AS_OF, expression_config=config)
    return r.verdicts.select("strategy", "checkName", F.round("value", 6).alias("value"), "status",
                             F.col("error").isNotNull().alias("failed"))


def o_wide_table_report():
    parts, table_level = [], (NAME_ROWS, NAME_DUPLICATE_ROWS, NAME_DUPLICATE_COLUMNS)
    for s in ("sql", "expression", "validator"):
        v = f"({_verdict_sql('orders', s)}) v"
        names = ", ".join(_s(n) for n in table_level)
        parts.append(f"SELECT strategy, checkName || '_' || i AS checkName, value, status, false AS failed FROM {v}, "
                     f"range({WIDE_COPIES}) r(i) WHERE checkName NOT IN ({names})")
        parts.append(f"SELECT strategy, checkName, value, status, false FROM {v} WHERE checkName = {_s(NAME_ROWS)}")
        parts.append(f"SELECT {_s(s)}, {_s(NAME_DUPLICATE_ROWS)}, CAST(NULL AS DOUBLE), false, true")
        if s != "sql":
            parts.append(f"SELECT {_s(s)}, {_s(NAME_DUPLICATE_COLUMNS)}, 1.0, false, false")
        for n in (NAME_NULLS, NAME_ZEROS, NAME_NON_POSITIVE, NAME_CONSTANT, NAME_DUPLICATE_VALUES):
            parts.append(f"SELECT {_s(s)}, {_s(n.replace('${column}', 'again'))}, CAST(NULL AS DOUBLE), false, true")
    parts.append("SELECT 'expression', 'odd', CAST(NULL AS DOUBLE), false, true")
    return _union(parts)


def q_sql_runtime_failure_isolated(spark, sf):
    """A template that fails on the data fails alone; another reads the same text without ANSI rules."""
    d = load(spark, sf, "dirty_customer")
    config = {"checks": [
        {"checkName": "rows", "query": "SELECT count(*) AS metricName FROM {table}", "metricType": "Dataset",
         "types": ["any"], "operator": ">", "threshold": 0},
        {"checkName": "number in ${column}", "query": "SELECT max(CAST({column} AS BIGINT)) AS metricName FROM {table}",
         "metricType": "Column", "types": ["String"], "operator": ">", "threshold": 0}]}
    strict = run_sql_checks(d, config, isolate_runtime_errors=True)
    legacy = run_sql_checks(d, config, ansi=False)
    return (strict.select(F.lit("ansi").alias("rules"), "checkName", "value", "status", F.col("error").isNotNull().alias("failed"))
            .unionByName(legacy.select(F.lit("legacy").alias("rules"), "checkName", "value", "status",
                                       F.col("error").isNotNull().alias("failed"))))


def o_sql_runtime_failure_isolated():
    src = _src("dirty_customer")
    rows = f"CAST((SELECT count(*) FROM {src} s) AS DOUBLE)"
    number = f"CAST((SELECT max(TRY_CAST(seg AS BIGINT)) FROM {src} s) AS DOUBLE)"
    return _union([f"SELECT 'ansi' AS rules, 'rows' AS checkName, {rows} AS value, true AS status, false AS failed",
                   "SELECT 'ansi', 'number in seg', CAST(NULL AS DOUBLE), false, true",
                   f"SELECT 'legacy', 'rows', {rows}, true, false",
                   f"SELECT 'legacy', 'number in seg', {number}, true, false"])


def q_bad_config_isolated(spark, sf):
    """Unknown definitions and aggregates, and validators that raise, fail their own checks."""
    from assay.plans.validator_checks import own_validators, validator

    with own_validators():
        @validator("FailingValidator")
        def _failing(column, ctx):
            raise LookupError("this validator cannot be planned")

        return _bad_config(spark, sf)


def _bad_config(spark, sf):
    d = load(spark, sf, "dirty_customer")
    config = {"metrics": [{"metricName": "n", "definitionName": "count rows", "metricType": "Dataset", "types": ["any"]},
                          {"metricName": "unknown", "definitionName": "count of nothing", "metricType": "Dataset", "types": ["any"]},
                          {"metricName": "odd", "aggFunction": "median of", "columnExpr": "bal", "metricType": "Dataset", "types": ["any"]},
                          {"metricName": "column_only", "definitionName": "count nulls", "metricType": "Dataset", "types": ["any"]}],
              "checks": [{"checkName": c, "expression": c, "operator": ">", "threshold": 0, "types": []}
                         for c in ("n", "unknown", "odd", "column_only")]}
    validators = {"validators": [
        {"name": "FailingValidator", "description": "raises", "operator": "=", "threshold": 0, "types": []},
        {"name": "NoNullsValidator", "description": "no column given", "operator": "=", "threshold": 0, "types": []},
        {"name": "CountRowsValidator", "description": "rows", "operator": ">", "threshold": 0, "types": []}]}
    v = run_expression_checks(d, config).unionByName(run_validator_checks(d, validators))
    return v.select("checkName", "value", "status", F.col("error").isNotNull().alias("failed"))


def o_bad_config_isolated():
    rows = f"CAST((SELECT count(*) FROM {_src('dirty_customer')} s) AS DOUBLE)"
    return _union([f"SELECT 'n' AS checkName, {rows} AS value, true AS status, false AS failed",
                   f"SELECT 'rows', {rows}, true, false"]
                  + [f"SELECT {_s(c)}, CAST(NULL AS DOUBLE), false, true"
                     for c in ("unknown", "odd", "column_only", "raises", "no column given")])


DATASET_TABLES = ["all_null_rows", "labelled_documents"]


def q_dataset_distinct(spark, sf):
    """"count uniques" over all columns of a table: distinct rows, those of nulls only dropped."""
    parts = []
    for t in DATASET_TABLES:
        df = load(spark, sf, t)
        config = {"metrics": [{"metricName": "d", "definitionName": COUNT_UNIQUES, "metricType": "Dataset", "types": ["any"]}],
                  "checks": [{"checkName": t, "expression": "d", "operator": ">", "threshold": 0, "types": []}]}
        parts.append(run_expression_checks(df, config).select("checkName", "value", "status"))
    return parts[0].unionByName(parts[1])


def o_dataset_distinct():
    cols = {"all_null_rows": ["ok", "ck"], "labelled_documents": LABELLED_COLS}
    return _union([f"SELECT {_s(t)} AS checkName, CAST({_ndv_drop(t, cols[t])} AS DOUBLE) AS value, "
                   f"{_ndv_drop(t, cols[t])} > 0 AS status" for t in DATASET_TABLES])


def q_declared_schema_file(spark, sf):
    """Declared types from a sidecar file: text columns of numbers are checked as numbers."""
    import json
    import tempfile

    from assay.operators.schema import load_declared_schema

    with tempfile.NamedTemporaryFile("w", suffix=".json") as f:  # read on the driver only
        json.dump({"schema": [{"columnName": "ck", "columnType": "Int"}, {"columnName": "price", "columnType": "Double"}]}, f)
        f.flush()
        types = load_declared_schema(f.name)
    v = run_expression_checks(load(spark, sf, "stringly_orders"), types=types, as_of=AS_OF)
    return v.select("checkName", F.round("value", 6).alias("value"), "status")


def q_declared_schema_hocon(spark, sf):
    """As declared_schema_file, with the sidecar and a check configuration in HOCON."""
    import tempfile

    from assay.operators.schema import load_declared_schema
    from assay.plans.catalogue import load_config

    sidecar = "number { columnType = Double }\nschema = [ { columnName = ck, columnType = Int } // a key\n  ${number} { columnName = price } ]\n"
    checks = """
        # shares of rows, in percent
        base { operator = "<", types = [Int, Double] }
        metrics = [
          { metricName = rows, definitionName = count rows, metricType = Dataset }
          { metricName = zeros, definitionName = count zeros, metricType = Column, types = ${base.types} }
        ]
        checks = [ ${base} { checkName = "zeros of ${column}", expression = "100 * zeros_${column} / rows", threshold = 50 } ]
    """
    with tempfile.NamedTemporaryFile("w", suffix=".conf") as f, tempfile.NamedTemporaryFile("w", suffix=".conf") as g:  # read on the driver only
        f.write(sidecar), g.write(checks)
        f.flush(), g.flush()
        types, config = load_declared_schema(f.name), load_config(g.name)
    v = run_expression_checks(load(spark, sf, "stringly_orders"), config, types=types)
    return v.select("checkName", F.round("value", 6).alias("value"), "status")


def o_declared_schema_hocon():
    share = "100.0 * count(*) FILTER (WHERE TRY_CAST({c} AS DOUBLE) = 0) / count(*)"
    return _union([f"SELECT {_s('zeros of ' + c)} AS checkName, ROUND({share.format(c=c)}, 6) AS value, {share.format(c=c)} < 50 AS status "
                   f"FROM {_src('stringly_orders')} t" for c in ("ck", "price")])


def o_declared_schema_file():
    src, rows = _src("stringly_orders"), f"(SELECT count(*) FROM {_src('stringly_orders')} s)"
    values = [(NAME_ROWS, rows, ">", 0), (NAME_DUPLICATE_ROWS, f"{rows} - {_distinctness('stringly_orders', ['ck', 'price'])}", "=", 0),
              (NAME_DUPLICATE_COLUMNS, "0", "=", 0)]
    for c in ("ck", "price"):
        ndv = _ndv_drop("stringly_orders", [c])
        for n, v, op, t in ((NAME_NULLS, f"(SELECT count(*) FROM {src} s WHERE {c} IS NULL)", "=", 0),
                            (NAME_ZEROS, f"(SELECT count(*) FROM {src} s WHERE TRY_CAST({c} AS DOUBLE) = 0)", "=", 0),
                            (NAME_NON_POSITIVE, f"(SELECT count(*) FROM {src} s WHERE TRY_CAST({c} AS DOUBLE) <= 0)", "=", 0),
                            (NAME_CONSTANT, ndv, ">", 1), (NAME_DUPLICATE_VALUES, f"{rows} - {ndv}", "=", 0)):
            values.append((n.replace("${column}", c), v, op, t))
    return _union([f"SELECT {_s(n)} AS checkName, ROUND(CAST({v} AS DOUBLE), 6) AS value, {_status_sql(v, op, t)} AS status"
                   for n, v, op, t in values])


def q_comparison_sink_roundtrip(spark, sf):
    path = _scratch(spark, "comparison")
    write_comparison(check_report(load(spark, sf, ALIGN_TABLE), as_of=AS_OF).aligned, path)
    back = read_table(spark, path, "csv")
    return back.select("checkName", *[F.col(f"{s}Status").cast("boolean").alias(f"{s}Status")
                                      for s in ("sql", "expression", "validator")])


def q_custom_validator(spark, sf):
    """A validator of the user: the longest text of each text column."""
    from assay.plans.validator_checks import Uses, own_validators, validator

    config = {"validators": [{"name": "LongestTextValidator", "description": "longest ${column}", "operator": "<=",
                              "threshold": 20_000, "types": ["String"]}]}
    with own_validators():
        @validator("LongestTextValidator")
        def _longest(column, ctx):
            return Uses({"longest": Metric("aggregate", (f"max(length({quote(column.name)}))",))})

        return run_validator_checks(load(spark, sf, "documents"), config).select("checkName", "value", "status")


def o_custom_validator():
    return _union([f"SELECT {_s('longest ' + c)} AS checkName, CAST(max(length({c})) AS DOUBLE) AS value, "
                   f"max(length({c})) <= 20000 AS status FROM documents" for c in ("text", "lang", "source")])


def q_custom_sql_check(spark, sf):
    """SQL of the user, run as written: per text column the rows that are longer than the mean."""
    config = {"checks": [
        {"checkName": "long ${column}", "metricType": "Column", "types": ["String"], "operator": "<", "threshold": 500,
         "query": "SELECT count(*) AS metricName FROM {table} WHERE length({column}) > "
                  "(SELECT avg(length({column})) FROM {table})"},
        {"checkName": "roles", "metricType": "Dataset", "types": ["any"], "operator": "=", "threshold": 2,
         "query": "SELECT count(DISTINCT role) AS metricName FROM {table}"}]}
    return run_sql_checks(load(spark, sf, "conversations"), config).select("checkName", "value", "status")


def o_custom_sql_check():
    def longer(c):
        return f"(SELECT count(*) FROM conversations WHERE length({c}) > (SELECT avg(length({c})) FROM conversations))"
    return _union([f"SELECT {_s('long ' + c)} AS checkName, CAST({longer(c)} AS DOUBLE) AS value, {longer(c)} < 500 AS status"
                   for c in ("role", "text")]
                  + ["SELECT 'roles', CAST(count(DISTINCT role) AS DOUBLE), count(DISTINCT role) = 2 FROM conversations"])


def q_integral_text_forms(spark, sf):
    df = load(spark, sf, "number_texts")
    return _long(df, _per_column(df, "integralText", COUNT_INTEGERS))


def o_integral_text_forms():
    return _union([_metric_row("integralText", c, f"count(*) FILTER (WHERE {_integral_sql(c)})", "number_texts")
                   for c in ("form", "signed")])


# --------------------------------------------------------------------------- state that outlives a run
#: (metric, column, definition, oracle aggregate, digits) over a table that arrives in two parts.
INCREMENTAL = [
    ("rows", "*", Metric("size"), "count(*)", 6),
    ("returned", "l_returnflag", Metric("size", where="l_returnflag = 'R'"), "count(*) FILTER (WHERE l_returnflag = 'R')", 6),
    ("values", "l_tax", Metric("count", ("nullif(l_tax, 0)",)), "count(nullif(l_tax, 0))", 6),
    ("least", "l_extendedprice", Metric("min", ("l_extendedprice",)), "min(l_extendedprice)", 6),
    ("greatest", "l_extendedprice", Metric("max", ("l_extendedprice",), "l_discount > 0"), "max(l_extendedprice) FILTER (WHERE l_discount > 0)", 6),
    ("wholeSum", "l_suppkey", Metric("sum", ("l_suppkey",)), "sum(l_suppkey)", 6),
    ("sum", "l_extendedprice", Metric("sum", ("l_extendedprice",)), "sum(CAST(round(l_extendedprice, 2) AS DECIMAL(18, 2)))", 2),
    ("mean", "l_discount", Metric("avg", ("l_discount",)), "avg(l_discount)", 6),
    ("deviation", "l_quantity", Metric("stddev_pop", ("l_quantity",)), "stddev_pop(l_quantity)", 6),
    ("none", "l_tax", Metric("sum", ("l_tax",), "l_quantity < 0"), "sum(l_tax) FILTER (WHERE l_quantity < 0)", 6),
]


def _in_two_parts(spark: SparkSession, df: DataFrame, late: str, update: Callable[[str, str], None]) -> tuple[str, str]:
    """``df`` as a partitioned table that grows: the rows that are not ``late``, an update, the late ones, an update."""
    table, state = _scratch(spark, "growing"), _scratch(spark, "state")
    dated = df.withColumn("part", F.coalesce(F.expr(late), F.lit(False)).cast("int"))
    for part in (0, 1):
        dated.where(F.col("part") == part).write.mode("append").partitionBy("part").parquet(table)
        update(table, state)
    return table, state


def q_incremental_metrics(spark, sf):
    """States of the first part and of the second, merged."""
    named = [NamedMetric(n, c, n, m) for n, c, m, _, _ in INCREMENTAL]
    _, state = _in_two_parts(spark, load(spark, sf, "lineitem"), "l_shipdate >= TIMESTAMP_NTZ '1998-01-01'",
                             lambda table, path: TableState(spark, path, buckets=8).refresh(table, named))
    digits = {n: d for n, _, _, _, d in INCREMENTAL}
    value = F.coalesce(*[F.when(F.col("metric") == n, F.round("value", d)) for n, d in digits.items()])
    return TableState(spark, state, buckets=8).metrics(named).select("metric", "column", value.alias("value"))


def o_incremental_metrics():
    return _union([_metric_row(n, c, o, "lineitem", d) for n, c, _, o, d in INCREMENTAL])


FREQUENCIES = ("distinct", "distinctness", "distinct_keep_nulls", "duplicate_groups", "duplicate_groups_keep_nulls")


def q_incremental_frequencies(spark, sf):
    """Frequency tables of the first part, merged with the second part's counts."""
    keys = {"k": ("k",), "seg": ("seg",), "k, seg": ("k", "seg"), "all": ("k", "seg", "bal")}
    named = [NamedMetric(a, c, f"{a} {c}", Metric(a, k)) for c, k in keys.items() for a in FREQUENCIES]
    named += [NamedMetric(a, "k where bal > 0", f"{a} filtered", Metric(a, ("k",), "bal > 0")) for a in FREQUENCIES]
    _, state = _in_two_parts(spark, load(spark, sf, "dirty_customer"), "bal > 5000",
                             lambda table, path: TableState(spark, path, buckets=8).refresh(table, named))
    return TableState(spark, state, buckets=8).metrics(named).select("metric", "column", "value")


def o_incremental_frequencies():
    parts = []
    for label, cols, where in (("k", ["k"], "TRUE"), ("seg", ["seg"], "TRUE"), ("k, seg", ["k", "seg"], "TRUE"),
                               ("all", DIRTY, "TRUE"), ("k where bal > 0", ["k"], "bal > 0")):
        source = f"(SELECT {', '.join(cols)}, count(*) AS n FROM {_src('dirty_customer')} s WHERE {where} GROUP BY ALL)"
        some = _not_all_null(cols)
        for name, value in zip(FREQUENCIES, (f"count(*) FILTER (WHERE {some})", f"sum(1) FILTER (WHERE {some})", "count(*)",
                                             f"count(*) FILTER (WHERE n > 1 AND {some})", "count(*) FILTER (WHERE n > 1)")):
            parts.append(f"SELECT {_s(name)} AS metric, {_s(label)} AS \"column\", CAST({value} AS DOUBLE) AS value FROM {source} g")
    return _union(parts)


def q_incremental_report(spark, sf):
    """The three strategies' verdicts out of stored state, over a table that arrived in two parts."""
    types = [{"columnName": c, "columnType": t} for c, t in TABLE_COLUMNS["dirty_customer"]]
    last = {}
    _in_two_parts(spark, load(spark, sf, "dirty_customer"), "seg = 'AUTOMOBILE'",
                  lambda table, path: last.update(report=state_report(spark, table, path, types=types, as_of=AS_OF, buckets=8)))
    return last["report"].verdicts.select("strategy", "checkName", F.round("value", 6).alias("value"), "status")


def o_incremental_report():
    return _union([_verdict_sql("dirty_customer", s) for s in ("sql", "expression", "validator")])


#: Rows at most, on average, that a task of a partitioning holds (about 22 bytes each in the shuffle).
ROWS_PER_PART = 3_000_000


def _part_counts(rows: int) -> tuple[int, int, int]:
    """Three different numbers of parts: 1, 8 and 64, or as many more as keep each part bounded."""
    least = rows // ROWS_PER_PART + 1
    return least, max(8, 2 * least), max(64, 4 * least)


def q_order_independent_sums(spark, sf):
    """Exact sums over three partitionings of the rows: the same doubles, bit for bit."""
    li = load(spark, sf, "lineitem")
    prices = {"l_extendedprice": "l_extendedprice", "l_tax": "l_tax", "discounted": "l_extendedprice * (1 - l_discount)"}
    sums = [(F.lit(c), F.expr(exact_sum(e))) for c, e in prices.items()]
    once = None
    for parts in _part_counts(li.count()):
        one = li.repartition(parts, "l_orderkey", "l_linenumber").select(F.array(*[F.struct(c.alias("column"), v.alias("value")) for c, v in sums]).alias("s"))
        once = one if once is None else once.unionByName(one)
    rows = once.selectExpr("inline(s)")
    return rows.groupBy("column").agg(F.count_distinct("value").alias("n_values"), F.round(F.max("value"), 2).alias("value"))


def o_order_independent_sums():
    cents = {"l_extendedprice": "CAST(round(l_extendedprice, 2) AS DECIMAL(18, 2))", "l_tax": "CAST(round(l_tax, 2) AS DECIMAL(18, 2))",
             "discounted": "CAST(round(l_extendedprice, 2) AS DECIMAL(18, 2)) * (1 - CAST(round(l_discount, 2) AS DECIMAL(6, 2)))"}
    return _union([f"SELECT {_s(c)} AS \"column\", CAST(1 AS BIGINT) AS n_values, ROUND(CAST(sum({e}) AS DOUBLE), 2) AS value FROM lineitem"
                   for c, e in cents.items()])


# --------------------------------------------------------------------------- sources by their path
def q_footer_metrics(spark, sf):
    """Counts, null counts, minima and maxima out of the files' footers; a sum beside them out of the data."""
    out = []
    for table, cols in (("lineitem", LINEITEM_NUMERIC), ("customer", CUSTOMER_NUMERIC)):
        named = [NamedMetric("rows", table, f"rows {table}", Metric("size"))]
        for c in cols:
            named += [NamedMetric(n, c, f"{n} {c}", m) for n, m in (
                ("nulls", Metric("size", where=f"{quote(c)} IS NULL")), ("values", Metric("count", (quote(c),))),
                ("least", Metric("min", (quote(c),))), ("greatest", Metric("max", (quote(c),))))]
        named.append(NamedMetric("keys", table, f"keys {table}", Metric("sum", (quote(cols[0]),))))
        out.append(table_metrics(spark, f"{sf}/{table}.parquet", named).select("metric", "column", F.round("value", 6).alias("value")))
    return out[0].unionByName(out[1])


def o_footer_metrics():
    parts = []
    for table, cols in (("lineitem", LINEITEM_NUMERIC), ("customer", CUSTOMER_NUMERIC)):
        parts += [_metric_row("rows", table, "count(*)", table), _metric_row("keys", table, f"sum({_q(cols[0])})", table)]
        for c in cols:
            parts += [_metric_row(n, c, e, table) for n, e in (
                ("nulls", f"count(*) FILTER (WHERE {_q(c)} IS NULL)"), ("values", f"count({_q(c)})"),
                ("least", f"min({_q(c)})"), ("greatest", f"max({_q(c)})"))]
    return _union(parts)


def q_unreadable_source_verdicts(spark, sf):
    """A source that is there, one that is missing, and one whose files are of another format (found out when
    it is opened, and, with a given schema, when its rows are read)."""
    orders = load(spark, sf, "orders")
    text = _scratch(spark, "not-parquet")
    orders.select(F.to_csv(F.struct(*orders.columns)).alias("value")).write.text(text)
    types = [{"columnName": c, "columnType": t} for c, t in TABLE_COLUMNS["orders"]]
    cases = [("readable", f"{sf}/orders.parquet", None), ("missing", f"{text}-missing", None), ("corrupt", text, None),
             ("corrupt rows", text, orders.schema)]
    out = None
    for case, path, schema in cases:
        v = source_report(spark, path, types=types, as_of=AS_OF, schema=schema).verdicts
        v = v.select(F.lit(case).alias("case"), "strategy", "checkName", "status",
                     F.coalesce(F.col("error").startswith("cannot read"), F.lit(False)).alias("unread"))
        out = v if out is None else out.unionByName(v)
    return out


def o_unreadable_source_verdicts():
    every = _union([_verdict_sql("orders", s) for s in ("sql", "expression", "validator")])
    rows = [f"SELECT 'readable' AS \"case\", strategy, checkName, status, false AS unread FROM ({every}) v"]
    rows += [f"SELECT {_s(case)}, strategy, checkName, false, true FROM ({every}) v" for case in ("missing", "corrupt", "corrupt rows")]
    return _union(rows)


def q_dataframe_validator(spark, sf):
    """Validators over the DataFrame: one with a join inside, one that computes its own number, and two that fail alone."""
    from assay.plans.validator_checks import dataframe_validator, own_validators

    orders = load(spark, sf, "orders")
    with own_validators():
        @dataframe_validator("WithoutOrders")
        def _without(df, column, ctx):
            return df.join(orders, df["c_custkey"] == orders["o_custkey"], "left_anti").select(F.count(F.lit(1)))

        @dataframe_validator("WidestRange")
        def _widest(df, column, ctx):
            return df.groupBy("c_mktsegment").agg((F.max(column.name) - F.min(column.name)).alias("r")).agg(F.max("r"))

        @dataframe_validator("Segments")
        def _segments(df, column, ctx):
            return df.select("c_mktsegment").distinct().count()

        @dataframe_validator("Raising")
        def _raising(df, column, ctx):
            return df.select("no_such_column")

        @dataframe_validator("ManyRows")
        def _many(df, column, ctx):
            return df.select("c_custkey")

        config = {"validators": [
            {"name": "WithoutOrders", "description": "customers without orders", "operator": "=", "threshold": 0, "types": []},
            {"name": "WidestRange", "description": "range of ${column}", "operator": ">", "threshold": 0, "types": ["Double"]},
            {"name": "Segments", "description": "segments", "operator": "=", "threshold": 5, "types": []},
            {"name": "Raising", "description": "raises", "operator": "=", "threshold": 0, "types": []},
            {"name": "ManyRows", "description": "many rows", "operator": ">", "threshold": 0, "types": []},
            {"name": "CountRowsValidator", "description": "rows", "operator": ">", "threshold": 0, "types": []}]}
        v = run_validator_checks(load(spark, sf, "customer"), config)
    return v.select("checkName", F.round("value", 6).alias("value"), "status", F.col("error").isNotNull().alias("failed"))


def o_dataframe_validator():
    rows = [("customers without orders", "(SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))", "= 0"),
            ("range of c_acctbal", "(SELECT max(r) FROM (SELECT max(c_acctbal) - min(c_acctbal) AS r FROM customer GROUP BY c_mktsegment))", "> 0"),
            ("segments", "(SELECT count(DISTINCT c_mktsegment) FROM customer)", "= 5"), ("rows", "(SELECT count(*) FROM customer)", "> 0")]
    return _union([f"SELECT {_s(n)} AS checkName, ROUND(CAST({v} AS DOUBLE), 6) AS value, {v} {t} AS status, false AS failed" for n, v, t in rows]
                  + [f"SELECT {_s(n)}, CAST(NULL AS DOUBLE), false, true" for n in ("raises", "many rows")])


def q_clashing_keys(spark, sf):
    """Metric ``a`` of column ``b_c`` and metric ``a_b`` of column ``c`` have one joined key: each check gets its own
    metric, and an expression that names the joined key fails alone."""
    df = load(spark, sf, "customer").selectExpr("c_acctbal AS b_c", "c_nationkey AS c")
    config = {"metrics": [{"metricName": "a", "definitionName": "count zeros", "metricType": "Column", "types": ["any"]},
                          {"metricName": "a_b", "definitionName": "count uniques", "metricType": "Column", "types": ["any"]}],
              "checks": [{"checkName": "zeros ${column}", "expression": "a_${column}", "operator": ">=", "threshold": 0, "types": ["any"]},
                         {"checkName": "values ${column}", "expression": "a_b_${column}", "operator": ">", "threshold": 10, "types": ["any"]},
                         {"checkName": "either", "expression": "a_b_c", "operator": ">", "threshold": 0, "types": []},
                         {"checkName": "plain", "expression": "a_c + 0", "operator": ">", "threshold": 0, "types": []}]}
    return run_expression_checks(df, config).select("checkName", "value", "status", F.col("error").isNotNull().alias("failed"))


def o_clashing_keys():
    values = [("zeros b_c", "count(*) FILTER (WHERE c_acctbal = 0)", ">= 0"), ("zeros c", "count(*) FILTER (WHERE c_nationkey = 0)", ">= 0"),
              ("values b_c", "count(DISTINCT c_acctbal)", "> 10"), ("values c", "count(DISTINCT c_nationkey)", "> 10"),
              ("plain", "count(*) FILTER (WHERE c_nationkey = 0)", "> 0")]
    return _union([f"SELECT {_s(n)} AS checkName, CAST({v} AS DOUBLE) AS value, {v} {t} AS status, false AS failed FROM customer" for n, v, t in values]
                  + ["SELECT 'either', CAST(NULL AS DOUBLE), false, true"])


# --------------------------------------------------------------------------- SQL of the user in the fused pass
#: SQL checks (FROM and filter left out: aggregate, alias, filter); the same texts run in DuckDB.
FOLDED = [
    ("rows", "count(*)", "", ""), ("late rows", "count(*)", "", "l_shipdate >= TIMESTAMP '1998-01-01'"), ("widest tax", "max(l_tax)", "t", ""),
    ("range", "max(l_extendedprice) - min(l_extendedprice)", "", "l_quantity > 5 AND l_returnflag = 'R'"), ("flags", "count(DISTINCT l_returnflag)", "", ""),
    ("parts of returned", "count(DISTINCT l_partkey)", "t", "t.l_returnflag = 'R'"), ("any bulk", "CASE WHEN count(*) > 0 THEN 1 ELSE 0 END", "", "l_quantity > 49"),
    ("untaxed", "sum(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END)", "", ""), ("open", "count(*) FILTER (WHERE l_linestatus = 'O')", "", ""),
    ("open and taxed", "count(*)", "", "l_linestatus = 'O' AND NOT l_tax = 0"), ("first line", "min(l_linenumber)", "", ""),
    ("flag length", "max(length(l_returnflag))", "", "l_linestatus IN ('O', 'F')"), ("last year", "max(year(l_shipdate))", "", ""),
    ("none", "max(l_tax)", "", "l_quantity < 0"), ("lines a flag", "count(*) / count(DISTINCT l_returnflag)", "", ""),
]


def _folded_text(aggregate: str, alias: str, where: str, table: str) -> str:
    return f"SELECT {aggregate} AS metricName FROM {table} {alias}" + (f" WHERE {where}" if where else "")


def q_folded_sql_checks(spark, sf):
    """SQL checks of the user that scan the table once together, beside one that runs as written (a subquery)."""
    config = {"checks": [{"checkName": n, "query": _folded_text(a, t, w, "{table}").replace("TIMESTAMP '", "TIMESTAMP_NTZ '"), "metricType": "Dataset",
                          "types": [], "operator": ">", "threshold": 1} for n, a, t, w in FOLDED]}
    config["checks"].append({"checkName": "above the mean", "metricType": "Dataset", "types": [], "operator": ">", "threshold": 1,
                             "query": "SELECT count(*) AS metricName FROM {table} WHERE l_quantity > (SELECT avg(l_quantity) FROM {table})"})
    return run_sql_checks(load(spark, sf, "lineitem"), config).select("checkName", F.round("value", 6).alias("value"), "status")


def o_folded_sql_checks():
    texts = [(n, _folded_text(a, t, w, "lineitem")) for n, a, t, w in FOLDED]
    texts.append(("above the mean", "SELECT count(*) AS metricName FROM lineitem WHERE l_quantity > (SELECT avg(l_quantity) FROM lineitem)"))
    return _union([f"SELECT {_s(n)} AS checkName, ROUND(CAST(metricName AS DOUBLE), 6) AS value, coalesce(metricName > 1, false) AS status FROM ({t}) v"
                   for n, t in texts])


# --------------------------------------------------------------------------- contract
_QUERIES: dict[str, tuple[Callable, Callable | None]] = {
    "row_counts": (q_row_counts, o_row_counts),
    "null_counts": (q_null_counts, o_null_counts),
    "zero_counts": (q_zero_counts, o_zero_counts),
    "nonpositive_counts": (q_nonpositive_counts, o_nonpositive_counts),
    "empty_counts": (q_empty_counts, o_empty_counts),
    "integral_text_counts": (q_integral_text_counts, o_integral_text_counts),
    "text_number_counts": (q_text_number_counts, o_text_number_counts),
    "freshness": (q_freshness, o_freshness),
    "conditional_aggregates": (q_conditional_aggregates, o_conditional_aggregates),
    "user_defined_metrics": (q_user_defined_metrics, o_user_defined_metrics),
    "distinct_drop_nulls": (q_distinct_drop_nulls, o_distinct_drop_nulls),
    "distinct_multi_column": (q_distinct_multi_column, o_distinct_multi_column),
    "distinct_groups_where": (q_distinct_groups_where, o_distinct_groups_where),
    "distinct_keep_nulls": (q_distinct_keep_nulls, o_distinct_keep_nulls),
    "distinct_rows": (q_distinct_rows, o_distinct_rows),
    "duplicate_surplus": (q_duplicate_surplus, o_duplicate_surplus),
    "duplicate_row_surplus": (q_duplicate_row_surplus, o_duplicate_row_surplus),
    "duplicate_groups_column": (q_duplicate_groups_column, o_duplicate_groups_column),
    "duplicate_groups_rows": (q_duplicate_groups_rows, o_duplicate_groups_rows),
    "constant_columns": (q_constant_columns, o_constant_columns),
    "duplicate_column_names": (q_duplicate_column_names, o_duplicate_column_names),
    "expanded_checks": (q_expanded_checks, o_expanded_checks),
    "metric_expressions": (q_metric_expressions, o_metric_expressions),
    "threshold_matrix": (q_threshold_matrix, o_threshold_matrix),
    "deduped_metrics": (q_deduped_metrics, o_deduped_metrics),
    "batched_metrics": (q_batched_metrics, o_batched_metrics),
    "empty_table_metrics": (q_empty_table_metrics, o_empty_table_metrics),
    "sql_template_checks": (_verdict_query("sql"), _verdict_oracle("sql")),
    "expression_checks": (_verdict_query("expression"), _verdict_oracle("expression")),
    "validator_checks": (_verdict_query("validator"), _verdict_oracle("validator")),
    "failed_metric_isolated": (q_failed_metric_isolated, o_failed_metric_isolated),
    "aligned_verdicts": (q_aligned_verdicts, o_aligned_verdicts),
    "verdict_disagreements": (q_verdict_disagreements, o_verdict_disagreements),
    "amplified_rows": (q_amplified_rows, o_amplified_rows),
    "verdict_sink_roundtrip": (q_verdict_sink_roundtrip, o_verdict_sink_roundtrip),
    "metric_sink_roundtrip": (q_metric_sink_roundtrip, o_metric_sink_roundtrip),
    "odd_column_names": (q_odd_column_names, o_odd_column_names),
    "stream_batch_verdicts": (q_stream_batch_verdicts, o_stream_batch_verdicts),
    "csv_source_checks": (q_csv_source_checks, o_csv_source_checks),
    "hot_key_metrics": (q_hot_key_metrics, o_hot_key_metrics),
    "text_table_checks": (q_text_table_checks, o_text_table_checks),
    "hashed_duplicate_rows": (q_hashed_duplicate_rows, o_hashed_duplicate_rows),
    "wide_table_report": (q_wide_table_report, o_wide_table_report),
    "sql_runtime_failure_isolated": (q_sql_runtime_failure_isolated, o_sql_runtime_failure_isolated),
    "bad_config_isolated": (q_bad_config_isolated, o_bad_config_isolated),
    "dataset_distinct": (q_dataset_distinct, o_dataset_distinct),
    "declared_schema_file": (q_declared_schema_file, o_declared_schema_file),
    "declared_schema_hocon": (q_declared_schema_hocon, o_declared_schema_hocon),
    "comparison_sink_roundtrip": (q_comparison_sink_roundtrip, o_aligned_verdicts),
    "custom_validator": (q_custom_validator, o_custom_validator),
    "custom_sql_check": (q_custom_sql_check, o_custom_sql_check),
    "integral_text_forms": (q_integral_text_forms, o_integral_text_forms),
    "incremental_metrics": (q_incremental_metrics, o_incremental_metrics),
    "incremental_frequencies": (q_incremental_frequencies, o_incremental_frequencies),
    "incremental_report": (q_incremental_report, o_incremental_report),
    "order_independent_sums": (q_order_independent_sums, o_order_independent_sums),
    "footer_metrics": (q_footer_metrics, o_footer_metrics),
    "unreadable_source_verdicts": (q_unreadable_source_verdicts, o_unreadable_source_verdicts),
    "dataframe_validator": (q_dataframe_validator, o_dataframe_validator),
    "clashing_keys": (q_clashing_keys, o_clashing_keys),
    "folded_sql_checks": (q_folded_sql_checks, o_folded_sql_checks),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the full three-strategy check report on lineitem (sf0.001)."""
    li = load(spark, SF_SMOKE, "lineitem")
    return check_report(li, as_of=AS_OF).verdicts


try:  # the training-data operators are optional: the rest works without their subpackage
    import corpus_pipeline
    from assay.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if not re.fullmatch(r"corpus_pipeline|assay\.llm(\..*)?", missing.name or ""):
        raise
    corpus_pipeline = llm_queries = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: q for name, (q, _) in _QUERIES.items()}
    if llm_queries is not None:
        out |= llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return out


def oracle_sql() -> dict[str, str]:
    out = {name: o() for name, (_, o) in _QUERIES.items() if o is not None}
    if llm_queries is not None:
        out |= llm_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
