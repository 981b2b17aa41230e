"""Check strategies: metric expressions, SQL templates, validators; fused report."""

from assay.plans.evaluate import CheckPlan, evaluate
from assay.plans.expression_checks import expression_report, run_expression_checks
from assay.plans.sql_checks import run_sql_checks
from assay.plans.validator_checks import (
    Uses,
    dataframe_validator,
    load_validators,
    run_validator_checks,
    validator,
    validator_report,
)

__all__ = [
    "CheckPlan", "Uses", "dataframe_validator", "evaluate", "expression_report", "load_validators", "run_expression_checks",
    "run_sql_checks", "run_validator_checks", "validator", "validator_report",
]
