"""The fused check report: all three strategies over one table, compared.

All built-in checks of the three strategies share *one* metric pass (they
become plans over the same engine run, tagged by strategy); SQL texts of the
user run as one unioned plan; the alignment is one pivot.  Everything is
lazy: a single action on ``aligned`` computes the whole report.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators.compare import pivot_verdicts, verdict_disagreements
from assay.operators.metrics import DEFAULT_MAX_METRICS_PER_PASS
from assay.plans.evaluate import CheckPlan, evaluate
from assay.plans.expression_checks import STRATEGY as EXPRESSION
from assay.plans.expression_checks import plan_expression_checks
from assay.plans.sql_checks import STRATEGY as SQL
from assay.plans.sql_checks import plan_sql_checks, run_templates
from assay.plans.validator_checks import STRATEGY as VALIDATOR
from assay.plans.validator_checks import plan_validator_checks
from assay.sources.io import stage

STRATEGIES = (SQL, EXPRESSION, VALIDATOR)


@dataclass
class Report:
    metrics: DataFrame        # metric, column, key, value, error
    verdicts: DataFrame       # strategy, checkName, value, status, error
    aligned: DataFrame        # checkName, sqlStatus, expressionStatus, validatorStatus

    def strategy(self, name: str) -> DataFrame:
        return self.verdicts.where(F.col("strategy") == name).drop("strategy")

    @property
    def disagreements(self) -> DataFrame:
        return verdict_disagreements(self.aligned)

    def materialize(self) -> Report:
        """Compute the report once and keep its (small) results outside the lineage.

        Every action on a lazy report re-runs its plan over the input.  Here metrics and verdicts are one
        tagged table, written once to ``spark.checkpoint.dir`` (the verdicts' part of the plan reuses the
        metrics' shuffles) and split when read back; later actions read those files, even if executors
        are lost.  The table holds one row per check or metric.
        """
        metrics, verdicts = self.metrics.columns, self.verdicts.columns
        both = (self.metrics.select(F.struct(*metrics).alias("m"), F.lit(None).cast(self.verdicts.schema).alias("v"))
                .unionByName(self.verdicts.select(F.lit(None).cast(self.metrics.schema).alias("m"), F.struct(*verdicts).alias("v"))))
        kept = stage(both)
        verdicts = kept.where("v IS NOT NULL").select("v.*")
        labels = [c[: -len("Status")] for c in self.aligned.columns if c != "checkName"]
        aligned = pivot_verdicts(verdicts.select("strategy", "checkName", "status"), labels)
        return Report(kept.where("m IS NOT NULL").select("m.*"), verdicts, aligned)


def plan_checks(df: DataFrame, types=None, as_of=None, expression_config: dict | None = None, validator_config: dict | None = None,
                sql_config: dict | None = None, strategies=STRATEGIES, fold: bool = True) -> tuple[list[CheckPlan], list[tuple]]:
    """The checks of every requested strategy as plans over metrics, and the user's SQL texts that are none."""
    plans, texts = [], []
    if EXPRESSION in strategies:
        plans += plan_expression_checks(df, expression_config, types, as_of)
    if VALIDATOR in strategies:
        plans += plan_validator_checks(df, validator_config, types, as_of)
    if SQL in strategies:
        built_in, texts = plan_sql_checks(df, sql_config, types, as_of, fold)
        plans += built_in
    return plans, texts


def report_of(metrics: DataFrame, verdicts: DataFrame, texts: DataFrame | None, strategies=STRATEGIES) -> Report:
    """The report of a metrics table, the plans' verdicts and those of the user's SQL texts."""
    if texts is not None:
        verdicts = verdicts.unionByName(texts.select(F.lit(SQL).alias("strategy"), *texts.columns))
    labels = [s for s in STRATEGIES if s in strategies]
    return Report(metrics, verdicts, pivot_verdicts(verdicts.select("strategy", "checkName", "status"), labels))


def check_report(
    df: DataFrame,
    types=None,
    as_of=None,
    expression_config: dict | None = None,
    validator_config: dict | None = None,
    sql_config: dict | None = None,
    strategies=STRATEGIES,
    max_metrics_per_pass: int = DEFAULT_MAX_METRICS_PER_PASS,
    stage_input: bool = False,
    isolate_runtime_errors: bool = False,
    ansi_sql: bool | None = None,
    compute=None,
) -> Report:
    """Run every requested strategy's checks over ``df`` and align the verdicts.

    ``stage_input=True`` first writes ``df`` to parquet under
    ``spark.checkpoint.dir`` (see :func:`assay.sources.io.stage`); use it for
    row-oriented sources such as CSV, which every scan would re-parse.
    ``isolate_runtime_errors`` runs the checks at once, so that one that fails
    on the data fails alone; ``ansi_sql=False`` analyses the user's SQL texts
    without ANSI rules; ``compute`` replaces the function that computes the
    metrics (see ``evaluate``).
    """
    if stage_input:
        df = stage(df)
    plans, texts = plan_checks(df, types, as_of, expression_config, validator_config, sql_config, strategies, fold=ansi_sql is None)
    metrics, verdicts = evaluate(df, plans, max_metrics_per_pass, with_strategy=True,
                                 isolate_runtime_errors=isolate_runtime_errors, compute=compute)
    return report_of(metrics, verdicts, run_templates(df, texts, isolate_runtime_errors, ansi_sql) if texts else None, strategies)
