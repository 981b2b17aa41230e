"""Metric and frequency state that outlives a run: a changed table is checked by reading what is new."""

from assay.state.report import StateReport, state_report
from assay.state.store import TableState

__all__ = ["StateReport", "TableState", "state_report"]
