"""Checks on streams (per micro-batch, via foreachBatch)."""

from assay.streaming.checks import check_stream, verdicts_of_batch

__all__ = ["check_stream", "verdicts_of_batch"]
