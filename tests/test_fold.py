"""The user's SQL checks: which fold into the fused pass, with what result."""

import pytest

from assay.plans.fold import folded_metric
from assay.plans.report import check_report
from assay.plans.sql_checks import plan_sql_checks, run_sql_checks, run_templates

FOLDS = ["SELECT count(*) AS metricName FROM {table}", "SELECT max(a) - min(a) AS metricName FROM {table} WHERE b > 1",
         "SELECT CASE WHEN count(*) > 2 THEN 1 ELSE 0 END AS metricName FROM {table} t WHERE t.c = 'x' AND t.a IS NOT NULL",
         "SELECT count(DISTINCT c) AS metricName FROM {table}", "SELECT count(DISTINCT c) AS metricName FROM {table} WHERE a > 0",
         "SELECT sum(a) FILTER (WHERE c = 'x') AS metricName FROM {table}", "SELECT avg(1 / b) AS metricName FROM {table}",
         "SELECT max(length(c)) AS metricName FROM {table} WHERE c IN ('x', 'yy')", "SELECT min(a) AS metricName FROM {table} WHERE b > 100",
         "SELECT count(`odd name`) AS metricName FROM {table}", "SELECT percentile(a, 0.5) AS metricName FROM {table}"]
STAYS = ["SELECT sum(1 / (b - 1)) AS metricName FROM {table} WHERE b <> 1",  # would raise on rows that the filter drops
         "SELECT max(n) AS metricName FROM (SELECT count(*) AS n FROM {table} GROUP BY c)", "SELECT count(*) AS metricName FROM {table} HAVING count(*) > 1",
         "SELECT a AS metricName FROM {table} LIMIT 1", "SELECT count(*) AS metricName FROM {table} x JOIN {table} y ON x.a = y.a",
         "SELECT count(*) AS metricName FROM {table} WHERE a > (SELECT avg(a) FROM {table})", "SELECT max(a) AS metricName, 1 AS more FROM {table}",
         "SELECT max(rand()) AS metricName FROM {table}", "SELECT sum(a) + count(DISTINCT c) AS metricName FROM {table}", "SELECT max(a) AS other FROM {table}",
         "SELECT nothing AS metricName FROM {table}", "not SQL", "SELECT count(*) AS metricName FROM range(3)",
         "SELECT count(*) AS metricName FROM {table} t WHERE t.c = 't.c' AND t.a > 0", "SELECT count(DISTINCT a, b) AS metricName FROM {table}"]


@pytest.fixture()
def df(frame):
    return frame([(1.5, 1, "x", None), (2.5, 2, "x", 3), (None, 3, "yy", 4), (-1.0, 4, None, 4), (7.0, 2, "", None)], "a double, b int, c string, `odd name` int")


def config(texts):
    return {"checks": [{"checkName": t, "query": t, "metricType": "Dataset", "types": [], "operator": ">", "threshold": 1} for t in texts]}


def test_what_folds(spark, df):
    df.createOrReplaceTempView("folding")
    folded = {t: folded_metric(spark, t.replace("{table}", "`folding`"), "`folding`") for t in FOLDS + STAYS}
    assert [t for t in FOLDS if folded[t] is None] == [] and [t for t in STAYS if folded[t] is not None] == []


def test_folded_checks_give_what_the_texts_give(spark, df):
    texts = FOLDS + [t for t in STAYS if "LIMIT" not in t and "rand" not in t]
    got = {r.checkName: (r.value, r.status, r.error) for r in run_sql_checks(df, config(texts)).collect()}
    want = {r.checkName: (r.value, r.status, r.error) for r in run_templates(df, [(t, t, ">", 1.0) for t in texts]).collect()}
    assert {t: v[:2] for t, v in got.items()} == {t: v[:2] for t, v in want.items()}
    assert all((got[t][2] is None) == (want[t][2] is None) for t in texts)


def test_an_empty_table_gives_the_same(spark, df):
    empty = df.where("b > 1000")
    got = {r.checkName: (r.value, r.status) for r in run_sql_checks(empty, config(FOLDS)).collect()}
    assert got == {r.checkName: (r.value, r.status) for r in run_templates(empty, [(t, t, ">", 1.0) for t in FOLDS]).collect()}


def test_twenty_texts_scan_the_table_once(spark, df, tmp_path):
    df.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    texts = [f"SELECT max(a) + {i} AS metricName FROM {{table}} WHERE b > {i}" for i in range(20)]
    plan = run_sql_checks(table, config(texts))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    assert len(plan_sql_checks(table, config(texts))[1]) == 0


def test_legacy_rules_run_texts_as_written(spark, df):
    plans, texts = plan_sql_checks(df, config(FOLDS), fold=False)
    assert not plans and len(texts) == len(FOLDS)
    legacy = check_report(df, sql_config=config(["SELECT sum(CAST(c AS INT)) AS metricName FROM {table}"]), strategies=("sql",), ansi_sql=False)
    assert legacy.verdicts.first().error == "no value"
    assert spark.catalog.listTables() == [] or not any(t.name.startswith("assay_table") for t in spark.catalog.listTables())
