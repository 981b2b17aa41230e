"""Footers, sources that cannot be read, validators over the DataFrame, loaded modules, key clashes."""

import math

import pytest
from pyspark.sql import functions as F

from assay.cli import main
from assay.operators.footers import footer_metrics, pushed, pushing, table_metrics
from assay.operators.metrics import Metric, NamedMetric, compute_metrics
from assay.plans.expression_checks import run_expression_checks
from assay.plans.report import check_report
from assay.plans.source_report import source_report
from assay.plans.validator_checks import dataframe_validator, load_validators, own_validators, registered_validators, run_validator_checks
from assay.state import state_report

TYPES = [{"columnName": "x", "columnType": "Int"}, {"columnName": "t", "columnType": "String"}]


def nm(i, agg, *target, where=None):
    return NamedMetric(agg, ",".join(target), str(i), Metric(agg, target, where))


def asked():
    return [nm(0, "size"), nm(1, "size", where="`x` IS NULL"), nm(2, "count", "`x`"), nm(3, "min", "x"), nm(4, "max", "`x`"), nm(5, "sum", "x"),
            nm(6, "min", "t"), nm(7, "size", where="x > 1"), nm(8, "max", "x", where="x < 3"), nm(9, "distinct", "x"), nm(10, "max", "absent"),
            nm(11, "min", "x + 1")]


def test_footers_answer_plain_metrics_and_the_data_the_rest(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, f"t{i % 7}") if i % 5 else (None, None) for i in range(100)], "x long, t string")
    df.repartition(3).write.parquet(path)
    found, rest = footer_metrics(spark, path, asked())
    assert sorted(r.key for r in found.collect()) == ["0", "1", "2", "3", "4"] and [n.key for n in rest] == ["5", "6", "7", "8", "9", "10", "11"]
    want = {r.key: r.value for r in compute_metrics(spark.read.parquet(path), asked()).collect()}
    got = {r.key: r for r in table_metrics(spark, path, asked()).collect()}
    assert {k: r.value for k, r in got.items()} == want and "absent" in got["10"].error
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false" and "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_the_plan_reads_no_data_pages(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("x", F.col("id").cast("int")).write.parquet(path)
    with pushing(spark, "parquet"):
        df = spark.read.parquet(path)
        assert pushed(df.selectExpr("count(1)", "min(x)", "max(id)")) and not pushed(df.selectExpr("sum(x)"))


@pytest.mark.parametrize("rows", [[1.0, math.nan], [None, None], [0.0, -0.0], [], [math.inf, -1.0, None]])
def test_columns_without_statistics_are_read(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(v, 1) for v in rows], "x double, y int")
    df.write.parquet(path)
    named = [nm(0, "size"), nm(1, "size", where="x IS NULL"), nm(2, "count", "x"), nm(3, "min", "x"), nm(4, "max", "x"), nm(5, "min", "y"), nm(6, "max", "y")]
    want = {r.key: repr(r.value) for r in compute_metrics(df, named).collect()}
    assert {r.key: repr(r.value) for r in table_metrics(spark, path, named).collect()} == {k: v.replace("-0.0", "0.0") for k, v in want.items()}


def test_partition_columns_and_other_formats(spark, tmp_path):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "x int, p int")
    df.write.partitionBy("p").parquet(str(tmp_path / "t"))
    df.write.orc(str(tmp_path / "o"))
    df.write.option("header", "true").csv(str(tmp_path / "c"))
    named = [nm(0, "size"), nm(1, "max", "p"), nm(2, "max", "x")]
    for path, fmt in (("t", "parquet"), ("o", "orc"), ("c", "csv")):
        options = {"header": "true", "inferSchema": "true"} if fmt == "csv" else {}
        got = {r.key: r.value for r in table_metrics(spark, str(tmp_path / path), named, fmt, **options).collect()}
        assert got == {"0": 30.0, "1": 2.0, "2": 29.0}


def test_source_report_equals_the_report_of_its_table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(i % 9, f"{i}", i / 3) for i in range(60)] + [(None, None, None)], "x int, t string, d double").write.parquet(path)
    got, want = source_report(spark, path), check_report(spark.read.parquet(path))
    assert sorted(map(tuple, got.verdicts.collect())) == sorted(map(tuple, want.verdicts.collect()))
    assert {r.key: r.value for r in got.metrics.collect()} == {r.key: r.value for r in want.metrics.collect()}


@pytest.mark.parametrize("fmt", ["parquet", "csv", "nonsense"])
def test_a_missing_source_fails_every_check(spark, tmp_path, fmt):
    sql = {"checks": [{"checkName": "own", "query": "SELECT max(x) AS metricName FROM {table}", "metricType": "Dataset", "types": [], "operator": ">",
                       "threshold": 0}]}
    report = source_report(spark, str(tmp_path / "none"), fmt, types=TYPES, sql_config=sql)
    rows = report.verdicts.collect()
    there = check_report(spark.createDataFrame([("1", "a")], "x string, t string"), types=TYPES, sql_config=sql).verdicts.collect()
    assert sorted((r.strategy, r.checkName) for r in rows) == sorted((r.strategy, r.checkName) for r in there)
    assert not any(r.status for r in rows) and all(r.error.startswith("cannot read") and r.value is None for r in rows)
    assert report.metrics.count() and report.metrics.where("error IS NULL").count() == 0
    assert source_report(spark, str(tmp_path / "none"), fmt).verdicts.where("status").count() == 0  # nothing declared: the table's checks


def test_a_corrupt_file_fails_every_check_wherever_it_shows(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    spark.range(10).selectExpr("CAST(id AS INT) AS x", "CAST(id AS STRING) AS t").coalesce(1).write.parquet(str(good))
    bad.mkdir()
    (bad / "part.parquet").write_bytes(b"not a table, but long enough to look at")
    for schema in (None, "x int, t string"):  # found on opening, and while rows are read
        rows = source_report(spark, str(bad), types=TYPES, schema=schema).verdicts.collect()
        assert rows and not any(r.status for r in rows) and all("cannot read" in r.error for r in rows)
    (good / "zz.parquet").write_bytes(b"not a table, but long enough to look at")  # a table with one bad file
    rows = source_report(spark, str(good), types=TYPES, schema="x int, t string").verdicts.collect()
    assert rows and not any(r.status for r in rows)
    assert state_report(spark, str(tmp_path / "none"), str(tmp_path / "s"), types=TYPES, buckets=2).verdicts.where("status").count() == 0


def test_other_errors_are_not_taken_for_a_failed_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError):
        source_report(spark, path, expression_config={"checks": [{"checkName": "c", "expression": "1", "operator": "!=", "threshold": 0}]})


def test_dataframe_validators_join_the_report(spark, frame):
    df, other = frame([(1, "a"), (2, "b"), (2, None)], "x int, t string"), frame([(1,)], "y int")
    with own_validators():
        @dataframe_validator("Missing")
        def _missing(d, column, ctx):
            return d.join(other, d["x"] == other["y"], "left_anti").select(F.count(F.lit(1)))

        @dataframe_validator("Longest")
        def _longest(d, column, ctx):
            return d.select(F.max(F.length(column.name)))

        @dataframe_validator("Number")
        def _number(d, column, ctx):
            return d.count()

        @dataframe_validator("Nothing")
        def _nothing(d, column, ctx):
            return None

        @dataframe_validator("Bad")
        def _bad(d, column, ctx):
            return d.selectExpr("raise_error('on the data') AS v").limit(1)

        @dataframe_validator("TwoColumns")
        def _two(d, column, ctx):
            return d.selectExpr("max(x)", "min(x)")

        names = ("Missing", "Number", "Nothing", "TwoColumns")
        config = {"validators": [{"name": n, "description": n, "operator": ">", "threshold": 0, "types": []} for n in names] + [
            {"name": "Longest", "description": "longest ${column}", "operator": "<", "threshold": 5, "types": ["String"]}]}
        got = {r.checkName: r for r in run_validator_checks(df, config).collect()}
        assert {n: (r.value, r.status) for n, r in got.items()} == {
            "Missing": (2.0, True), "Number": (3.0, True), "Nothing": (None, False), "TwoColumns": (None, False), "longest t": (1.0, True)}
        assert "one column" in got["TwoColumns"].error and got["Nothing"].error == "no value"
        config["validators"].append({"name": "Bad", "description": "bad", "operator": ">", "threshold": 0, "types": []})
        rows = check_report(df, validator_config=config, isolate_runtime_errors=True).verdicts.collect()
        bad = next(r for r in rows if r.checkName == "bad")
        assert not bad.status and "on the data" in bad.error and next(r for r in rows if r.checkName == "Missing").status
    assert "Missing" not in registered_validators()


VALIDATORS = """
from assay import Metric, Uses, dataframe_validator, validator
from pyspark.sql import functions as F

@validator("LoadedMetric")
def loaded(column, ctx):
    return Uses({"n": Metric("size")})

@dataframe_validator("LoadedFrame")
def frame(df, column, ctx):
    return df.select(F.count_distinct("t"))
"""


def test_the_command_line_loads_validators_and_reports_failed_reads(spark, tmp_path):
    (tmp_path / "own_validators.py").write_text(VALIDATORS)
    (tmp_path / "config.json").write_text('{"validators": [{"name": "LoadedMetric", "description": "n", "operator": ">", "threshold": 0, "types": []},'
                                          ' {"name": "LoadedFrame", "description": "f", "operator": ">", "threshold": 1, "types": []}]}')
    (tmp_path / "schema.json").write_text('{"schema": [{"columnName": "x", "columnType": "Int"}, {"columnName": "t", "columnType": "String"}]}')
    (tmp_path / "in.csv").write_text("x,t\n1,a\n2,b\n")

    def run(source, out, *more):
        main(["run", "--input", str(source), "--format", "csv", "--schema", str(tmp_path / "schema.json"), "--validators",
              str(tmp_path / "own_validators.py"), "--validator-config", str(tmp_path / "config.json"), "--strategy", "validator",
              "--output", str(out), *more])
        return {r.checkName: r.status for r in spark.read.option("header", "true").csv(f"{out}/validator").collect()}

    with own_validators():
        assert run(tmp_path / "in.csv", tmp_path / "a") == {"n": "true", "f": "true"}
        assert run(tmp_path / "none.csv", tmp_path / "b") == {"n": "false", "f": "false"}
        for _ in range(2):
            assert run(tmp_path / "in.csv", tmp_path / "c", "--state", str(tmp_path / "state")) == {"n": "true", "f": "true"}
        with pytest.raises(ValueError):
            load_validators(str(tmp_path / "absent.py"))


def test_clashing_metric_keys_fail_no_other_check(frame):
    df = frame([(0, 5), (0, 6), (1, 6)], "b_c int, c int")
    config = {"metrics": [{"metricName": "a", "definitionName": "count zeros", "types": ["any"]}, {"metricName": "a_b", "definitionName": "count uniques", "types": ["any"]}],
              "checks": [{"checkName": "zeros ${column}", "expression": "a_${column}", "operator": ">=", "threshold": 0, "types": ["any"]},
                         {"checkName": "values ${column}", "expression": "a_b_${column} * 10", "operator": ">", "threshold": 0, "types": ["any"]},
                         {"checkName": "joined", "expression": "a_b_c", "operator": ">", "threshold": 0, "types": []}]}
    got = {r.checkName: r.value for r in run_expression_checks(df, config).collect()}
    assert got == {"zeros b_c": 2.0, "zeros c": 0.0, "values b_c": 20.0, "values c": 20.0, "joined": None}
