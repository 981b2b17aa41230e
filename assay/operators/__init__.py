"""DataFrame operators: metric engine, frequency metrics, schema routing, comparison."""

from assay.operators.compare import align_verdicts, compare_verdicts, verdict_disagreements
from assay.operators.metrics import Metric, NamedMetric, compute_metrics, wide_metrics
from assay.operators.schema import DeclaredColumn, declared_columns, duplicate_column_names

__all__ = [
    "DeclaredColumn", "Metric", "NamedMetric", "align_verdicts", "compare_verdicts", "compute_metrics",
    "declared_columns", "duplicate_column_names", "verdict_disagreements", "wide_metrics",
]
