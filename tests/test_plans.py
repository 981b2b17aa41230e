"""Plan shape: what makes the report hold at scale (checked with Spark's own plans)."""

import os
import re

import pytest

from assay.operators.metrics import Metric, NamedMetric, compute_metrics
from assay.plans.report import check_report

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_report_has_no_cartesian_product_or_python(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = executed(check_report(li, as_of="2024-02-01").aligned)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert node not in plan, node


def test_scan_metrics_are_one_aggregate(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    named = [NamedMetric(f"n{i}", c, f"n{i}_{c}", Metric("size", where=f"{c} IS NULL"))
             for i, c in enumerate(li.columns)]
    named += [NamedMetric("mx", "l_tax", "mx", Metric("max", ("l_tax",))),
              NamedMetric("sd", "l_tax", "sd", Metric("stddev_pop", ("l_tax",), "l_discount > 0"))]
    plan = compute_metrics(li, named)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert len(re.findall(r"Relation \[", plan)) == 1


def test_frequency_branch_reads_only_its_column(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    m = compute_metrics(li, [NamedMetric("d", "l_tax", "d", Metric("distinct", ("l_tax",)))])
    plan = executed(m)
    assert set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)) == {"struct<l_tax:double>"}


def test_strategies_share_scans(spark):
    """One scan for the row-level metrics, one per column, three for whole rows, whatever the strategies."""
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = executed(check_report(li, as_of="2024-02-01").aligned)
    assert plan.split("== Initial Plan ==")[0].count("FileScan parquet") <= 1 + len(li.columns) + 6


def test_hot_key_holding_half_the_rows(frame):
    rows = [("hot",)] * 500 + [(f"k{i}",) for i in range(500)] + [(None,)] * 3
    df = frame(rows, "k string")
    m = {r["key"]: r["value"] for r in compute_metrics(df, [
        NamedMetric("d", "k", "d", Metric("distinct", ("k",))),
        NamedMetric("kn", "k", "kn", Metric("distinct_keep_nulls", ("k",))),
        NamedMetric("dg", "k", "dg", Metric("duplicate_groups", ("k",))),
        NamedMetric("dgk", "k", "dgk", Metric("duplicate_groups_keep_nulls", ("k",))),
    ]).collect()}
    assert m == {"d": 501, "kn": 502, "dg": 1, "dgk": 2}


def shuffles(plan):
    """Shuffles by a column's values in the final plan, not counting reused ones."""
    return len(re.findall(r"Exchange hashpartitioning", plan.split("== Initial Plan ==")[0]))


def test_shuffles_per_column_do_not_depend_on_the_width(spark):
    from pyspark.sql import functions as F

    customers = spark.read.parquet(f"{SF}/customer.parquet")
    counts = {}
    for n in (60, 66):
        wide = customers.select(*[F.concat_ws("-", F.lit(i), customers.columns[i % 5]).alias(f"c{i}") for i in range(n)])
        plan = check_report(wide, as_of="2024-02-01").aligned._jdf.queryExecution().executedPlan().toString()
        counts[n] = len(re.findall("Exchange hashpartitioning", plan))  # planned only: nothing needs to run
    assert counts[66] - counts[60] == 6


def test_materialized_report_shuffles_no_more_than_the_lazy_one(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    report = check_report(li, as_of="2024-02-01")
    lazy = shuffles(executed(report.aligned))
    kept = report.materialize()
    plan = executed(kept.verdicts) + executed(kept.metrics)
    assert "lineitem" not in plan and "assay-stage" in plan
    # metrics and verdicts as one plan: the verdicts' half reuses the metrics' shuffles
    both = (report.metrics.selectExpr("key").unionByName(report.verdicts.selectExpr("checkName AS key")))
    assert shuffles(executed(both)) <= lazy


DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
                 "labels conversations").split()


@pytest.mark.parametrize("table", DRIVER_TABLES)
def test_strategies_agree_on_clean_driver_tables(spark, table):
    """Differential check: on null-free data the three strategies give the same verdicts."""
    df = spark.read.parquet(f"{SF}/{table}.parquet")
    report = check_report(df, as_of="2024-02-01")
    verdicts = report.verdicts.collect()
    assert not [r for r in verdicts if r["error"]]
    diff = {r["checkName"] for r in report.disagreements.collect()}
    assert diff == {"No Duplicate column names"}  # the SQL strategy has no such template
