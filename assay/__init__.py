"""assay: data-quality checks as Spark DataFrames.

Metrics, verdicts and comparisons are all DataFrames.  Three ways to write a
check -- metric expressions, SQL templates, registered validators -- compile
to fused Spark plans; see :func:`check_report` for all three at once.
"""

from assay.operators import (
    Metric,
    NamedMetric,
    align_verdicts,
    compare_verdicts,
    compute_metrics,
    declared_columns,
    verdict_disagreements,
)
from assay.plans import (
    Uses,
    dataframe_validator,
    expression_report,
    load_validators,
    run_expression_checks,
    run_sql_checks,
    run_validator_checks,
    validator,
    validator_report,
)
from assay.plans.report import Report, check_report
from assay.plans.source_report import source_report
from assay.state import TableState, state_report

__all__ = [
    "Metric", "NamedMetric", "Report", "TableState", "Uses", "align_verdicts", "check_report", "compare_verdicts",
    "compute_metrics", "dataframe_validator", "declared_columns", "expression_report", "load_validators",
    "run_expression_checks", "run_sql_checks", "run_validator_checks", "source_report", "state_report", "validator",
    "validator_report", "verdict_disagreements",
]
