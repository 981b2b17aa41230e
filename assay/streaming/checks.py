"""Checks on a stream: the same check report, run on every micro-batch.

``foreachBatch`` hands each micro-batch to the batch engine, so a stream is
checked with exactly the fused plans a table is.  Verdicts are written with
the micro-batch id as a partition, overwriting only that partition: if a
batch is replayed after a failure (Structured Streaming re-runs the last
uncommitted batch), its verdicts replace the earlier attempt instead of
being duplicated.  The streaming checkpoint lies beside the sink unless given,
so a restarted stream goes on counting and never replaces earlier verdicts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assay.plans.report import STRATEGIES, check_report


def verdicts_of_batch(batch: DataFrame, batch_id: int, types=None, as_of=None, strategies=STRATEGIES,
                      **configs) -> DataFrame:
    """Verdicts of one micro-batch, tagged with its id."""
    report = check_report(batch, types=types, as_of=as_of, strategies=strategies, **configs)
    return report.verdicts.withColumn("batch_id", F.lit(int(batch_id)))


def check_stream(
    stream: DataFrame,
    sink_path: str,
    checkpoint_location: str | None = None,
    types=None,
    as_of=None,
    strategies=STRATEGIES,
    fmt: str = "parquet",
    trigger: dict | None = None,
    **configs,
) -> StreamingQuery:
    """Start a streaming query that appends each micro-batch's verdicts to ``sink_path``."""
    checkpoint_location = checkpoint_location or f"{sink_path.rstrip('/')}-checkpoint"

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # The report scans the batch several times; the source reads the same offsets each time.
        out = verdicts_of_batch(batch, batch_id, types, as_of, strategies, **configs)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id").format(fmt).save(sink_path))

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
