"""Checks on a stream: one verdict partition per micro-batch, computed from that batch alone."""

import os
import tempfile

from assay.streaming.checks import check_stream


def test_each_micro_batch_is_checked(spark, frame):
    src = tempfile.mkdtemp(prefix="assay-test-")
    frame([(1, "a"), (2, "b")], "k int, s string").coalesce(1).write.parquet(os.path.join(src, "part1"))
    frame([(3, "c"), (3, "c"), (None, "d")], "k int, s string").coalesce(1).write.parquet(os.path.join(src, "part2"))
    schema = frame([], "k int, s string").schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    sink = os.path.join(tempfile.mkdtemp(prefix="assay-test-"), "verdicts")
    ckpt = os.path.join(tempfile.mkdtemp(prefix="assay-test-"), "ckpt")
    query = check_stream(stream, sink, checkpoint_location=ckpt, strategies=("expression", "validator"),
                         trigger={"availableNow": True})
    query.awaitTermination()
    out = spark.read.parquet(sink)
    assert sorted(r["batch_id"] for r in out.select("batch_id").distinct().collect()) == [0, 1]
    by = {(r["batch_id"], r["strategy"], r["checkName"]): r for r in out.collect()}
    nulls = "No Null/Missing values in data for column k"
    dups = "No Duplicate rows in all columns"
    statuses = {b: (by[(b, "expression", nulls)]["status"], by[(b, "validator", dups)]["status"]) for b in (0, 1)}
    # exactly one batch holds the null key and the duplicate row
    assert sorted(statuses.values()) == [(False, False), (True, True)]


def test_restart_keeps_earlier_verdicts(spark, frame):
    src = tempfile.mkdtemp(prefix="assay-test-")
    sink = os.path.join(tempfile.mkdtemp(prefix="assay-test-"), "verdicts")
    schema = frame([], "k int").schema

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        check_stream(stream, sink, strategies=("expression",), trigger={"availableNow": True}).awaitTermination()
        out = spark.read.parquet(sink).where("checkName = 'Number of rows is larger than 0'")
        return {r["batch_id"]: r["value"] for r in out.collect()}

    frame([(1,), (2,)], "k int").write.parquet(os.path.join(src, "one"))
    assert run() == {0: 2}
    frame([(1,)] * 5, "k int").write.parquet(os.path.join(src, "two"))
    assert run() == {0: 2, 1: 5}
