"""Sources, sinks, amplification and verdict comparison."""

import os
import tempfile

from assay.operators.compare import align_verdicts, verdict_disagreements
from assay.operators.schema import load_declared_schema
from assay.plans.expression_checks import run_expression_checks
from assay.sources.io import amplify, read_table, read_verdicts, write_comparison, write_metrics, write_verdicts


def test_csv_reads_all_strings_and_sidecar_types(spark):
    d = tempfile.mkdtemp(prefix="assay-test-")
    with open(os.path.join(d, "t.csv"), "w") as fh:
        fh.write("id,amount,day\n1,0,2024-01-31\n2,5.5,2024-01-30\n3,,2024-01-29\n")
    with open(os.path.join(d, "schema.json"), "w") as fh:
        fh.write('{"schema": [{"columnName": "id", "columnType": "Int"},'
                 ' {"columnName": "amount", "columnType": "Double"},'
                 ' {"columnName": "day", "columnType": "Date"}]}')
    df = read_table(spark, os.path.join(d, "t.csv"), "csv")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string"] * 3
    types = load_declared_schema(os.path.join(d, "schema.json"))
    v = {r["checkName"]: r for r in run_expression_checks(df, types=types, as_of="2024-02-01").collect()}
    assert v["No Zeros in columns for column amount"]["value"] == 1
    assert v["No Null/Missing values in data for column amount"]["value"] == 1
    assert v["Data is fresh for column day"]["value"] == -1


def test_verdict_and_metric_sinks_round_trip(spark, frame):
    df = frame([(1,), (2,)], "a int")
    v = run_expression_checks(df)
    d = tempfile.mkdtemp(prefix="assay-test-")
    write_verdicts(v.select("checkName", "status"), os.path.join(d, "v"))
    back = {r["checkName"]: r["status"] for r in read_verdicts(spark, os.path.join(d, "v")).collect()}
    assert back == {r["checkName"]: r["status"] for r in v.collect()}
    from assay.plans.expression_checks import expression_report
    metrics, _ = expression_report(df)
    write_metrics(metrics, os.path.join(d, "m"))
    assert read_table(spark, os.path.join(d, "m"), "csv").columns == ["name", "column", "value", "error"]


def test_amplify_is_bag_union(frame):
    df = frame([(1, "a"), (2, "b")], "k int, `odd name` string")
    out = amplify(df, 5)
    assert out.columns == df.columns
    assert sorted(out.collect()) == sorted(df.collect() * 5)


def test_align_and_disagreements(frame, spark):
    a = frame([("c1", True), ("c2", False)], "checkName string, status boolean")
    b = frame([("c1", True), ("c2", True), ("c3", True)], "checkName string, status boolean")
    aligned = align_verdicts({"left": a, "right": b})
    rows = {r["checkName"]: (r["leftStatus"], r["rightStatus"]) for r in aligned.collect()}
    assert rows == {"c1": (True, True), "c2": (False, True), "c3": (None, True)}
    diff = {r["checkName"] for r in verdict_disagreements(aligned).collect()}
    assert diff == {"c2", "c3"}
    d = tempfile.mkdtemp(prefix="assay-test-")
    write_comparison(aligned, os.path.join(d, "cmp"))
    assert read_table(spark, os.path.join(d, "cmp"), "csv").count() == 3


def test_cli_run_and_compare(spark):
    from assay.cli import main

    d = tempfile.mkdtemp(prefix="assay-test-")
    with open(os.path.join(d, "t.csv"), "w") as fh:
        fh.write("id,name\n1,a\n2,b\n2,b\n")
    main(["run", "--input", os.path.join(d, "t.csv"), "--format", "csv", "--stage", "--local", "--output", os.path.join(d, "out")])
    for s in ("sql", "expression", "validator", "metrics", "comparison"):
        assert read_table(spark, os.path.join(d, "out", s), "csv").count() > 0
    main(["compare", "--sql", os.path.join(d, "out", "sql"), "--expression", os.path.join(d, "out", "expression"),
          "--validator", os.path.join(d, "out", "validator"), "--output", os.path.join(d, "cmp")])
    diff = read_table(spark, os.path.join(d, "cmp", "disagreements"), "csv").collect()
    assert {r["checkName"] for r in diff} == {"No Duplicate column names"}


def test_repeated_verdicts_are_all_reported(frame):
    a = frame([("c1", True), ("c1", False), ("c2", True)], "checkName string, status boolean")
    b = frame([("c1", True), ("c2", True)], "checkName string, status boolean")
    rows = sorted(((r["checkName"], r["leftStatus"], r["rightStatus"]) for r in align_verdicts({"left": a, "right": b}).collect()), key=repr)
    assert rows == [("c1", False, True), ("c1", True, None), ("c2", True, True)]


def test_cli_takes_the_submitted_session(spark, monkeypatch):
    """Neither master nor shuffle partitions are set, and a cluster without a shared folder is refused."""
    import argparse

    import pytest

    import assay.cli as cli
    import assay.session as session

    monkeypatch.setattr(cli, "local_session", lambda: pytest.fail("a local session"))
    before = (spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"))
    got = cli._session(argparse.Namespace(local=False))
    assert (got.sparkContext.master, got.conf.get("spark.sql.shuffle.partitions")) == before
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.require_shared_folder(master, None)
        session.require_shared_folder(master, "hdfs://shared")
    session.require_shared_folder("local[4]", None)


def test_job_label(spark):
    from assay.session import job_label

    with job_label(spark, "a label, " + "x" * 200):
        assert spark.sparkContext.getLocalProperty("spark.job.description") == "a label, " + "x" * 200
    assert spark.sparkContext.getLocalProperty("spark.job.description") is None
