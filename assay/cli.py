"""Command line: run checks over a table, or compare stored verdict tables.

    python -m assay run --input data.csv --format csv --schema schema.json --output out/
    python -m assay compare --sql out/sql --expression out/expression --validator out/validator --output cmp/

Runs in the session that spark-submit (or the Spark configuration) sets up; ``--local`` starts a
local one instead.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from assay.session import cluster_session, local_session


def _session(args) -> SparkSession:
    return local_session() if args.local else cluster_session()


def _cmd_run(args) -> None:
    from assay.operators.schema import load_declared_schema
    from assay.plans.catalogue import load_config
    from assay.plans.report import STRATEGIES
    from assay.plans.source_report import source_report
    from assay.plans.validator_checks import load_validators
    from assay.session import job_label
    from assay.sources.io import write_comparison, write_metrics, write_verdicts
    from assay.state import state_report

    spark = _session(args)
    for module in args.validators or []:
        load_validators(module)
    types = load_declared_schema(args.schema) if args.schema else None
    strategies = STRATEGIES if args.strategy == "all" else (args.strategy,)
    config = {f"{k}_config": load_config(path) if path else None for k, path in
              (("expression", args.expression_config), ("validator", args.validator_config), ("sql", args.sql_config))}
    given = {"fmt": args.format, "types": types, "as_of": args.as_of, "strategies": strategies, "ansi_sql": not args.legacy_sql, **config}
    with job_label(spark, f"assay checks on {args.input}"):
        if args.state:
            report = state_report(spark, args.input, args.state, **given)
        else:
            report = source_report(spark, args.input, stage_input=args.stage, **given)
    out = args.output.rstrip("/")
    with job_label(spark, f"assay checks on {args.input}"):
        report = report.materialize()  # one pass over the input for all outputs below
        for s in strategies:
            write_verdicts(report.strategy(s).select("checkName", "status", "value", "error"), f"{out}/{s}")
        write_metrics(report.metrics, f"{out}/metrics")
        if len(strategies) > 1:
            write_comparison(report.aligned, f"{out}/comparison")


def _cmd_compare(args) -> None:
    from assay.operators.compare import align_verdicts, verdict_disagreements
    from assay.sources.io import read_verdicts, write_comparison

    spark = _session(args)
    inputs = {label: read_verdicts(spark, path) for label, path in
              (("sql", args.sql), ("expression", args.expression), ("validator", args.validator)) if path}
    aligned = align_verdicts(inputs)
    write_comparison(aligned, args.output.rstrip("/") + "/all")
    write_comparison(verdict_disagreements(aligned), args.output.rstrip("/") + "/disagreements")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="assay")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="run checks over a table")
    r.add_argument("--input", required=True)
    r.add_argument("--format", default="parquet")
    r.add_argument("--schema", help="sidecar JSON {schema: [{columnName, columnType}]}")
    r.add_argument("--strategy", default="all", choices=["all", "sql", "expression", "validator"])
    r.add_argument("--expression-config")
    r.add_argument("--validator-config")
    r.add_argument("--sql-config")
    r.add_argument("--as-of", help="reference date for freshness (default: today)")
    r.add_argument("--stage", action="store_true", help="stage the input as parquet under spark.checkpoint.dir")
    r.add_argument("--state", help="folder of stored metric state: only new partitions of the input are read")
    r.add_argument("--validators", action="append", metavar="MODULE", help="module (name or .py file) that registers validators; repeatable")
    r.add_argument("--legacy-sql", action="store_true", help="analyse the SQL templates without ANSI rules")
    r.add_argument("--output", required=True)
    r.set_defaults(fn=_cmd_run)
    c = sub.add_parser("compare", help="align stored verdict tables")
    c.add_argument("--sql")
    c.add_argument("--expression")
    c.add_argument("--validator")
    c.add_argument("--output", required=True)
    c.set_defaults(fn=_cmd_compare)
    for command in (r, c):
        command.add_argument("--local", action="store_true", help="start a local session")
    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
