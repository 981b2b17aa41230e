"""Benchmark: the fused check report vs. the same checks run one action each.

Prints one JSON line:
  {"metric": "fused_report_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``value`` is the total of the fused queries (everything but ``*_one_action_per_check``,
which reproduces the reference's execution shape as the relative baseline).  Each
query is built from scratch and run twice; the faster run is reported (local
timings of second-long jobs vary by tens of percent between runs).
Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assay.plans.expression_checks import expand_metrics  # noqa: E402
from assay.plans.catalogue import EXPRESSION_CONFIG  # noqa: E402
from assay.operators.metrics import compute_metrics  # noqa: E402
from assay.operators.schema import declared_columns  # noqa: E402
from assay.plans.report import check_report  # noqa: E402
from assay.plans.sql_checks import run_sql_checks  # noqa: E402
from assay.session import local_session  # noqa: E402
from assay.sources.derived import load  # noqa: E402

AS_OF = "2024-02-01"


def fused_report(table):
    def run(spark, sf):
        df = load(spark, sf, table)
        return check_report(df, as_of=AS_OF).aligned.collect()
    return run


def fused_expression_validator(table):
    def run(spark, sf):
        df = load(spark, sf, table)
        return check_report(df, as_of=AS_OF, strategies=("expression", "validator")).aligned.collect()
    return run


def sql_templates(table):
    def run(spark, sf):
        return run_sql_checks(load(spark, sf, table), as_of=AS_OF).collect()
    return run


def csv_report(table):
    """The table as CSV text (all strings) with its declared types, staged once as parquet."""
    def run(spark, sf):
        from assay.sources.io import read_table, shared_folder
        import uuid

        path = f"{shared_folder(spark)}/bench-csv-{uuid.uuid4().hex}"
        load(spark, sf, table).write.option("header", "true").csv(path)
        df = read_table(spark, path, "csv")
        types = {f.name: t.type for f, t in zip(df.schema.fields, declared_columns(load(spark, sf, table)))}
        return check_report(df, types=types, as_of=AS_OF, stage_input=True).aligned.collect()
    return run


def distinct_all_columns(table):
    def run(spark, sf):
        from assay.functions.predicates import quote
        from assay.operators.metrics import Metric, NamedMetric

        df = load(spark, sf, table)
        named = [NamedMetric(agg, c, f"{agg}_{c}", Metric(agg, (quote(c),)))
                 for c in df.columns for agg in ("distinct", "distinct_keep_nulls")]
        return compute_metrics(df, named).collect()
    return run


def conditional_counts(table):
    def run(spark, sf):
        from assay.plans.catalogue import COUNT_MIN_NUMERIC, COUNT_NULLS, definition_metric
        from assay.operators.metrics import NamedMetric

        df = load(spark, sf, table)
        cols = declared_columns(df)
        named = [NamedMetric("nulls", c.name, f"nulls_{c.name}", definition_metric(COUNT_NULLS, [c])) for c in cols]
        named += [NamedMetric("nonpos", c.name, f"nonpos_{c.name}", definition_metric(COUNT_MIN_NUMERIC, [c]))
                  for c in cols if c.type in ("Int", "Double")]
        return compute_metrics(df, named).collect()
    return run


def one_action_per_check(table):
    """The reference's shape: every metric is its own Spark job, collected to the driver."""
    def run(spark, sf):
        df = load(spark, sf, table)
        named = expand_metrics(EXPRESSION_CONFIG, declared_columns(df), AS_OF)
        values = {}
        for nm in named:  # one job per metric, as a per-check runner would do
            values[nm.key] = compute_metrics(df, [nm]).collect()[0]["value"]
        return values
    return run


QUERIES = {
    "distinct_all_columns_lineitem": distinct_all_columns("lineitem"),
    "conditional_counts_lineitem": conditional_counts("lineitem"),
    "report_lineitem": fused_report("lineitem"),
    "report_orders": fused_report("orders"),
    "report_dirty_customer": fused_report("dirty_customer"),
    "report_labelled_documents": fused_report("labelled_documents"),
    "expression_validator_lineitem": fused_expression_validator("lineitem"),
    "sql_templates_lineitem": sql_templates("lineitem"),
    "expression_validator_labelled_documents": fused_expression_validator("labelled_documents"),
    "report_orders_csv_staged": csv_report("orders"),
    "lineitem_one_action_per_check": one_action_per_check("lineitem"),
}


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="assay-bench")
    fused_report("dirty_customer")(spark, sf)  # warm the JVM once
    times = {}
    for name, fn in QUERIES.items():
        runs = []
        for _ in range(2):
            t = time.time()
            fn(spark, sf)
            runs.append(time.time() - t)
        times[name] = round(min(runs), 3)
    headline = round(sum(v for k, v in times.items() if not k.endswith("one_action_per_check")), 3)
    m = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({"metric": "fused_report_sec", "value": headline, "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf}))


if __name__ == "__main__":
    main()
