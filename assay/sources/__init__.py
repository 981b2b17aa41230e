"""Sources and sinks."""

from assay.sources.io import (
    amplify,
    read_table,
    read_verdicts,
    shared_folder,
    stage,
    write_comparison,
    write_metrics,
    write_verdicts,
)

__all__ = ["amplify", "read_table", "read_verdicts", "shared_folder", "stage", "write_comparison", "write_metrics",
           "write_verdicts"]
