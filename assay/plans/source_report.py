"""The check report of a source by its path: footers first, and verdicts even if it cannot be read.

A source that cannot be read (no such path, files that are corrupt or not of
the format) does not end the run: every check that its declared schema calls
for fails, with the reader's message.  That holds for failures when the source
is opened and for those that only show while its rows are read.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from assay.functions.predicates import quote
from assay.operators.footers import footer_metrics
from assay.operators.metrics import METRICS_SCHEMA, _error_text, compute_metrics_isolated
from assay.plans.evaluate import VERDICT_SCHEMA, metrics_of, verdicts_of
from assay.plans.report import STRATEGIES, Report, check_report, plan_checks, report_of
from assay.sources.io import read_table, stage

#: Error conditions of Spark's readers: what they mean is that the source, not a check, is at fault.
READ_CONDITIONS = ("FAILED_READ_FILE", "PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FILE_NOT_EXIST", "CANNOT_READ_FILE_FOOTER",
                   "DATA_SOURCE_NOT_FOUND", "MALFORMED_CSV_RECORD", "MALFORMED_RECORD_IN_PARSING")
_READ_ERRORS = (PySparkException, Py4JJavaError)


def read_failure(exc: Exception) -> str | None:
    """The reader's message if ``exc`` says that a source could not be read, else None."""
    if isinstance(exc, Py4JJavaError):
        cause, found = exc.java_exception, []
        while cause is not None and len(found) < 20:
            found.append(str(cause.getMessage() or ""))
            cause = cause.getCause()
        return next((m.split("\n")[0] for m in found if any(f"[{c}" in m.split("\n")[0] for c in READ_CONDITIONS)), None)
    if isinstance(exc, PySparkException):
        return _error_text(exc) if (exc.getCondition() or "").startswith(READ_CONDITIONS) else None
    return None


def _declared(spark: SparkSession, types, schema) -> DataFrame:
    """An empty table with the columns that are declared for a source that cannot be read."""
    if schema:
        return spark.createDataFrame([], schema)
    names = [e["columnName"] for e in types] if isinstance(types, list) else list(types or {})
    return spark.range(0).selectExpr(*[f"CAST(NULL AS STRING) AS {quote(n)}" for n in names])


def failed_report(spark: SparkSession, error: str, types=None, as_of=None, expression_config=None, validator_config=None, sql_config=None,
                  strategies=STRATEGIES, schema=None) -> Report:
    """Every check that the declared columns call for, failed with ``error``."""
    df = _declared(spark, types, schema)
    plans, texts = plan_checks(df, types, as_of, expression_config, validator_config, sql_config, strategies, fold=False)
    named = metrics_of(plans)
    for p in plans:
        p.error = error
    metrics = spark.createDataFrame([(nm.name, nm.column, nm.key, None, error) for nm in named], METRICS_SCHEMA)
    own = spark.createDataFrame([(name, None, False, error) for name, *_ in texts], VERDICT_SCHEMA) if texts else None
    return report_of(metrics, verdicts_of(metrics, named, plans, with_strategy=True), own, strategies)


def source_report(
    spark: SparkSession,
    source: str,
    fmt: str = "parquet",
    types=None,
    as_of=None,
    expression_config: dict | None = None,
    validator_config: dict | None = None,
    sql_config: dict | None = None,
    strategies=STRATEGIES,
    stage_input: bool = False,
    ansi_sql: bool | None = None,
    schema=None,
    **options,
) -> Report:
    """``check_report`` of the files at ``source``, computed at once (its results are small).

    Unfiltered counts, null counts, minima and maxima of Parquet and ORC files come from their footers.
    ``schema`` (DDL or a StructType) is the physical schema to read with; ``types`` the declared one.  If
    the source cannot be read, every check of the declared columns fails with the reader's message.
    """
    given = {"types": types, "as_of": as_of, "expression_config": expression_config, "validator_config": validator_config,
             "sql_config": sql_config, "strategies": strategies}
    try:
        df = read_table(spark, source, fmt, schema, **options)
        if stage_input:
            df = stage(df)

        def compute(df, named, max_metrics_per_pass):
            found, rest = (None, named) if stage_input else footer_metrics(spark, source, named, fmt, schema, **options)
            computed = compute_metrics_isolated(df, rest, max_metrics_per_pass)
            return computed if found is None else found.unionByName(computed)

        report = check_report(df, **given, isolate_runtime_errors=True, ansi_sql=ansi_sql, compute=compute)
        return report
    except _READ_ERRORS as exc:
        message = read_failure(exc)
        if message is None:
            raise
        return failed_report(spark, f"cannot read {source}: {message}", **given, schema=schema)
