"""The three strategies and where their null semantics make verdicts differ."""

import pytest

from assay.functions.thresholds import ConfigError
from assay.operators.metrics import Metric
from assay.plans.catalogue import NAME_CONSTANT, NAME_DUPLICATE_ROWS, NAME_DUPLICATE_VALUES, NAME_FRESH
from assay.plans.evaluate import CheckPlan, evaluate
from assay.plans.expression_checks import expression_report, run_expression_checks
from assay.plans.report import check_report
from assay.plans.sql_checks import run_sql_checks
from assay.plans.validator_checks import Uses, run_validator_checks, validator

AS_OF = "2024-02-01"


def statuses(report, name):
    row = [r for r in report.aligned.collect() if r["checkName"] == name]
    assert row, name
    r = row[0]
    return (r["sqlStatus"], r["expressionStatus"], r["validatorStatus"])


# (case, rows, schema, check, (sql, expression, validator))
DIVERGENCE = [
    ("one value plus nulls", [("x",), ("x",), (None,)], "c string", NAME_CONSTANT, (True, False, True)),
    ("constant on empty table", [], "c string", NAME_CONSTANT, (True, False, False)),
    ("constant on all null", [(None,), (None,)], "c string", NAME_CONSTANT, (False, False, False)),
    ("unique plus one null", [("a",), ("b",), (None,)], "c string", NAME_DUPLICATE_VALUES, (True, False, True)),
    ("unique plus two nulls", [("a",), ("b",), (None,), (None,)], "c string", NAME_DUPLICATE_VALUES,
     (True, False, False)),
    ("one all-null row", [(1, "a"), (2, "b"), (None, None)], "a int, c string", NAME_DUPLICATE_ROWS,
     (True, False, True)),
    ("duplicate rows on empty table", [], "a int, c string", NAME_DUPLICATE_ROWS, (True, False, True)),
    ("fresh on all null", [(None,), (None,)], "c date", NAME_FRESH, (False, False, False)),
]


@pytest.mark.parametrize("case,rows,schema,check,expected", DIVERGENCE, ids=[d[0] for d in DIVERGENCE])
def test_divergence_table(frame, case, rows, schema, check, expected):
    df = frame(rows, schema)
    report = check_report(df, as_of=AS_OF)
    assert statuses(report, check.replace("${column}", "c")) == expected


def test_strategies_agree_on_clean_data(frame):
    import datetime as dt
    rows = [(i, f"s{i}", float(i) + 0.5, dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(1, 30)]
    df = frame(rows, "i int, s string, d double, day date")
    report = check_report(df, as_of=AS_OF)
    assert report.disagreements.count() == 1  # only "No Duplicate column names" lacks a SQL verdict
    assert all(r["expressionStatus"] for r in report.aligned.collect())


def test_freshness_is_signed_days(frame):
    import datetime as dt
    df = frame([(dt.date(2024, 1, 29),), (dt.date(2024, 1, 30),)], "day date")
    v = {r["checkName"]: r for r in run_expression_checks(df, as_of=AS_OF).collect()}
    fresh = v[NAME_FRESH.replace("${column}", "day")]
    assert fresh["value"] == -2 and fresh["status"] is True


def test_declared_type_override_routes_text_columns(frame):
    df = frame([("0",), ("5",), ("abc",)], "n string")
    v = {r["checkName"]: r for r in run_validator_checks(df, types={"n": "Int"}).collect()}
    assert v["No Zeros in columns for column n"]["value"] == 1
    assert v["No Numeric values are smaller than 0 for column n"]["value"] == 1
    assert "No numeric values located on textual columns for column n" not in v


def test_sidecar_schema_selects_columns(frame):
    df = frame([(1, "a")], "x int, y string")
    v = run_expression_checks(df, types=[{"columnName": "y", "columnType": "String"}]).collect()
    names = {r["checkName"] for r in v}
    assert "No Null/Missing values in data for column y" in names
    assert not any(n.endswith("column x") for n in names)


def test_duplicate_check_names_rejected(frame):
    df = frame([(1,)], "a int")
    cfg = {"metrics": [{"metricName": "r", "definitionName": "count rows", "metricType": "Dataset"}],
           "checks": [{"checkName": "same", "expression": "r", "operator": ">", "threshold": 0, "types": []},
                      {"checkName": "same", "expression": "r", "operator": ">", "threshold": 0, "types": []}]}
    with pytest.raises(ConfigError):
        run_expression_checks(df, cfg)


def test_unknown_operator_rejected(frame):
    df = frame([(1,)], "a int")
    with pytest.raises(ConfigError):
        evaluate(df, [CheckPlan("x", [], "1", "!=", 0)])


def test_sql_template_must_return_one_row(frame):
    df = frame([(1,), (2,)], "a int")
    cfg = {"checks": [
        {"checkName": "many rows", "query": "SELECT a AS metricName FROM {table}", "metricType": "Dataset",
         "types": ["any"], "operator": ">", "threshold": 0},
        {"checkName": "broken", "query": "SELECT nope AS metricName FROM {table}", "metricType": "Dataset",
         "types": ["any"], "operator": ">", "threshold": 0},
        {"checkName": "fine", "query": "SELECT max(a) AS metricName FROM {table}", "metricType": "Dataset",
         "types": ["any"], "operator": "=", "threshold": 2},
    ]}
    v = {r["checkName"]: r for r in run_sql_checks(df, cfg).collect()}
    assert v["many rows"]["status"] is False and "exactly one row" in v["many rows"]["error"]
    assert v["broken"]["status"] is False and v["broken"]["error"]
    assert v["fine"]["status"] is True and v["fine"]["error"] is None


def test_registered_validator_is_fused(frame):
    @validator("MaxLengthAtMost3")
    def _max_len(column, ctx):
        return Uses({"len": Metric("aggregate", (f"max(length(`{column.name}`))",))})

    df = frame([("ab",), ("abcd",)], "s string")
    cfg = {"validators": [{"name": "MaxLengthAtMost3", "description": "short ${column}", "operator": "<=",
                           "threshold": 3, "types": ["String"]},
                          {"name": "NoSuchValidator", "description": "ghost", "operator": "=", "threshold": 0,
                           "types": []}]}
    v = {r["checkName"]: r for r in run_validator_checks(df, cfg).collect()}
    assert v["short s"]["value"] == 4 and v["short s"]["status"] is False
    assert v["ghost"]["status"] is False and "unknown validator" in v["ghost"]["error"]


def test_python_value_builder(frame):
    df = frame([(1,), (None,)], "a int")
    from assay.operators.metrics import NamedMetric
    ms = [NamedMetric("rows", "*", "rows", Metric("size")), NamedMetric("nn", "a", "nn", Metric("count", ("a",)))]
    _, v = evaluate(df, [CheckPlan("ratio", ms, lambda m: m["nn"] / m["rows"], ">=", 0.5)])
    r = v.first()
    assert r["value"] == 0.5 and r["status"] is True


def test_report_survives_duplicate_column_names(frame):
    a = frame([(1, "x"), (2, "y")], "k int, v string")
    b = frame([(1, "p"), (2, "q")], "k int, w string")
    joined = a.join(b, a["k"] == b["k"])
    report = check_report(joined, as_of=AS_OF)
    rows = report.verdicts.collect()
    by = {(r["strategy"], r["checkName"]): r for r in rows}
    assert by[("expression", "No Duplicate column names")]["status"] is False
    assert by[("validator", "No Duplicate column names")]["value"] == 1
    assert by[("expression", "Number of rows is larger than 0")]["status"] is True
    # checks on the ambiguous name fail with an error instead of aborting the report
    assert any(r["error"] for r in rows if r["checkName"].endswith("column k"))


def test_map_and_array_columns(frame):
    df = frame([({"a": 1}, [1.0, 2.0]), ({"b": 2}, [1.0, 2.0]), (None, None)], "m map<string,int>, arr array<float>")
    report = check_report(df, as_of=AS_OF)
    by = {(r["strategy"], r["checkName"]): r for r in report.verdicts.collect()}
    # arrays group fine: two distinct values plus a null
    assert by[("validator", "No Columns with constant values for column arr")]["value"] == 2
    assert by[("expression", "No Columns with constant values for column arr")]["value"] == 1
    # Spark 4 groups maps by value too
    assert by[("expression", "No Columns with constant values for column m")]["value"] == 2
    assert by[("validator", "No Columns with constant values for column m")]["value"] == 3
    assert by[("expression", "No Null/Missing values in data for column m")]["value"] == 1
    assert not any(r["error"] for r in by.values())


def test_materialized_report_does_not_rescan_input(frame, spark):
    df = frame([(1, "a"), (2, "b"), (2, "b")], "k int, s string")
    report = check_report(df, as_of=AS_OF).materialize()
    for plan_df in (report.metrics, report.verdicts, report.aligned):
        plan = plan_df._jdf.queryExecution().optimizedPlan().toString()
        assert "LocalRelation" not in plan and "parquet" in plan  # only the staged table is read
    assert report.disagreements.count() == 1
    assert {r["checkName"] for r in report.strategy("sql").collect()} <= {r["checkName"] for r in report.aligned.collect()}


def test_bad_entries_fail_alone(frame):
    from assay.plans.validator_checks import run_validator_checks, validator

    @validator("RaisingValidator")
    def _raising(column, ctx):
        raise RuntimeError("no plan for " + column.name)

    df = frame([(1, "a"), (2, None)], "k int, s string")
    config = {"metrics": [{"metricName": "n", "definitionName": "count rows", "metricType": "Dataset"},
                          {"metricName": "u", "definitionName": "no such definition", "metricType": "Dataset"},
                          {"metricName": "a", "aggFunction": "no_such", "columnExpr": "k", "metricType": "Dataset"},
                          {"metricName": "c", "definitionName": "count nulls", "metricType": "Dataset"}],
              "checks": [{"checkName": x, "expression": x, "operator": ">", "threshold": 0} for x in "nuac"]}
    metrics, verdicts = expression_report(df, config)
    assert {r["checkName"]: r["status"] for r in verdicts.collect()} == {"n": True, "u": False, "a": False, "c": False}
    errors = {r["key"]: r["error"] for r in metrics.collect()}
    assert errors["n"] is None and "no such definition" in errors["u"] and "no_such" in errors["a"] and "not of a dataset" in errors["c"]
    v = {r["checkName"]: r for r in run_validator_checks(df, {"validators": [
        {"name": "RaisingValidator", "description": "raises ${column}", "operator": "=", "threshold": 0, "types": ["any"]},
        {"name": "NoNullsValidator", "description": "no column", "operator": "=", "threshold": 0, "types": []},
        {"name": "CountRowsValidator", "description": "rows", "operator": ">", "threshold": 0, "types": []}]}).collect()}
    assert "no plan for k" in v["raises k"]["error"] and v["no column"]["error"] and v["rows"]["status"] is True


def test_dataset_distinct_takes_all_columns(frame):
    df = frame([(1, "a", None), (1, "b", None), (1, "c", "x"), (1, "c", "x"), (None, None, None)], "i int, s string, t string")
    config = {"metrics": [{"metricName": "d", "definitionName": "count uniques", "metricType": "Dataset"}],
              "checks": [{"checkName": "d", "expression": "d", "operator": "=", "threshold": 3}]}
    assert run_expression_checks(df, config).collect()[0]["value"] == 3


def test_sql_that_fails_on_the_data_fails_alone(frame):
    from assay.plans.sql_checks import run_sql_checks

    df = frame([("1",), ("x",)], "s string")
    config = {"checks": [
        {"checkName": "bad", "query": "SELECT max(CAST({column} AS INT)) AS metricName FROM {table}", "metricType": "Column",
         "types": ["any"], "operator": ">", "threshold": 0},
        {"checkName": "good", "query": "SELECT count(*) AS metricName FROM {table}", "metricType": "Dataset", "types": ["any"],
         "operator": "=", "threshold": 2}]}
    v = {r["checkName"]: r for r in run_sql_checks(df, config, isolate_runtime_errors=True).collect()}
    assert v["good"]["status"] is True and v["bad"]["status"] is False and "CAST_INVALID_INPUT" in v["bad"]["error"]
    legacy = {r["checkName"]: r for r in run_sql_checks(df, config, ansi=False).collect()}
    assert legacy["bad"]["value"] == 1 and df.sparkSession.conf.get("spark.sql.ansi.enabled") == "true"
    report = check_report(df, sql_config=config, as_of=AS_OF, isolate_runtime_errors=True)
    assert {r["checkName"]: r["sqlStatus"] for r in report.aligned.collect()}["good"] is True
