"""The check report out of stored state: an unchanged part of a table is not read again.

The checks' metrics are brought up to date in a :class:`TableState` (new and
changed partitions are read, once for the scan metrics and once per list of
grouping keys), and the verdicts are taken from the merged states.  Metrics
without a mergeable state (whole aggregate expressions, keys that cannot be
hashed, texts that depend on the time) are computed over the whole table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.functions.predicates import as_of_sql
from assay.operators.metrics import NamedMetric, _build_or_error, compute_metrics
from assay.plans.evaluate import metrics_of, verdicts_of
from assay.plans.report import STRATEGIES, Report, plan_checks, report_of
from assay.plans.source_report import failed_report, read_failure
from assay.plans.sql_checks import run_templates
from assay.sources.io import read_table
from assay.state.frequency import counted
from assay.state.scan import MERGEABLE
from assay.state.store import TableState, Update

#: Functions whose value depends on when or where they run: a state kept over them would grow stale.
_NOW = re.compile(r"\b(current_\w+|curdate|now|localtimestamp|unix_timestamp|rand\w*|uuid|shuffle|input_file_\w+|monotonically_increasing_id"
                  r"|spark_partition_id)\b", re.IGNORECASE)
EPOCH = "1970-01-01"


@dataclass
class StateReport(Report):
    update: Update = None  # what was read


def _mergeable(nm: NamedMetric, df: DataFrame) -> bool:
    m = nm.metric
    if _NOW.search(" ".join([*m.target, m.where or ""])):
        return False
    if m.kind == "frequency":
        return _build_or_error(lambda: counted(df, m.target, m.where))[1] is None
    return m.agg in MERGEABLE


def state_report(
    spark: SparkSession,
    source: str,
    state: str,
    fmt: str = "parquet",
    types=None,
    as_of=None,
    expression_config: dict | None = None,
    validator_config: dict | None = None,
    sql_config: dict | None = None,
    strategies=STRATEGIES,
    ansi_sql: bool | None = None,
    buckets: int = 64,
    **options,
) -> StateReport:
    """As ``check_report`` over the table of files at ``source``, with the state kept at ``state``.

    Freshness is kept as days since a fixed date and moved to ``as_of`` when it is read, so a state serves
    every day.  The user's own SQL texts run as written, over the whole table.  ``buckets`` (files per
    frequency table) must stay what the state was begun with.  A source that cannot be read fails every
    check that its declared columns call for, and leaves the state as it is.
    """
    try:
        return _state_report(spark, source, state, fmt, types, as_of, expression_config, validator_config, sql_config, strategies,
                             ansi_sql, buckets, options)
    except (PySparkException, Py4JJavaError) as exc:
        message = read_failure(exc)
        if message is None:
            raise
        failed = failed_report(spark, f"cannot read {source}: {message}", types, as_of, expression_config, validator_config, sql_config, strategies)
        return StateReport(failed.metrics, failed.verdicts, failed.aligned, Update())


def _state_report(spark, source, state, fmt, types, as_of, expression_config, validator_config, sql_config, strategies, ansi_sql, buckets,
                  options) -> StateReport:
    df = read_table(spark, source, fmt, **options)
    given = (expression_config, validator_config, sql_config, strategies)
    plans, texts = plan_checks(df, types, as_of, *given, fold=False)
    named = metrics_of(plans)
    # The same metrics with days counted from a fixed date: plans differ in nothing else.
    fixed = metrics_of(plan_checks(df, types, EPOCH, *given, fold=False)[0])
    kept = [(nm, replace(nm, metric=f.metric)) for nm, f in zip(named, fixed)]
    stored = [(nm, f) for nm, f in kept if _mergeable(f, df)]
    update = (store := TableState(spark, state, buckets)).refresh(source, [f for _, f in stored], fmt, **options)
    metrics = store.metrics([f for _, f in stored])
    moved = [nm.key for nm, f in stored if nm.metric != f.metric]
    if moved:
        days = F.expr(f"datediff({as_of_sql(as_of)}, DATE '{EPOCH}')")
        metrics = metrics.withColumn("value", F.when(F.col("key").isin(moved), F.col("value") - days).otherwise(F.col("value")))
    held = {nm.key for nm, _ in stored}
    rest = [nm for nm in named if nm.key not in held]
    if rest:
        metrics = metrics.unionByName(compute_metrics(df, rest))
    verdicts = verdicts_of(metrics, named, plans, with_strategy=True)
    done = report_of(metrics, verdicts, run_templates(df, texts, ansi=ansi_sql) if texts else None, strategies)
    return StateReport(done.metrics, done.verdicts, done.aligned, update)
