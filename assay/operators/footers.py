"""Metrics that a columnar file's footers already hold.

Parquet and ORC footers keep, per column, how many rows and nulls there are
and the least and greatest value.  Spark's v2 readers answer unfiltered
counts, minima and maxima from them (aggregate push-down) without reading a
data page.  The metrics that qualify go there in one aggregate; everything
else, and everything if a file lacks the statistics, is computed from the
data as usual, so the answer never depends on who wrote the files.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from assay.functions.predicates import is_null, quote
from assay.operators.metrics import DEFAULT_MAX_METRICS_PER_PASS, METRICS_SCHEMA, Metric, NamedMetric, compute_metrics
from assay.session import job_label

FORMATS = ("parquet", "orc")
#: Types whose footer statistics are exact and compare as the metric does.
RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


@contextmanager
def pushing(spark: SparkSession, fmt: str):
    """Read ``fmt`` with the v2 reader, aggregates pushed down, while a plan is built and run."""
    wanted = {"spark.sql.sources.useV1SourceList": ",".join(
        f for f in spark.conf.get("spark.sql.sources.useV1SourceList", "").split(",") if f.strip() != fmt),
        f"spark.sql.{fmt}.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _partition_columns(df: DataFrame, source: str) -> set[str]:
    """Columns whose values are in the folders' names, not in the files."""
    return {part.split("=")[0] for f in df.inputFiles()[:1] for part in f[f.find(source.rstrip("/").rsplit("/", 1)[-1]):].split("/")[:-1] if "=" in part}


def footer_aggregate(m: Metric, fields: dict[str, T.DataType]) -> dict[str, str] | None:
    """The push-down aggregates that ``m`` needs (name -> SQL), or None if footers cannot answer it."""
    columns = {quote(c): c for c in fields}
    if m.agg == "size" and m.where is None:
        return {"rows": "count(1)"}
    if m.agg == "size":
        name = next((c for q, c in columns.items() if m.where in (is_null(q), f"{c} IS NULL")), None)
        return {"rows": "count(1)", f"values of {name}": f"count({quote(name)})"} if name else None
    if m.where is not None or m.agg not in ("count", "min", "max") or len(m.target) != 1:
        return None
    name = columns.get(m.target[0], m.target[0] if m.target[0] in fields else None)
    if name is None or (m.agg != "count" and not isinstance(fields[name], RANGED)):
        return None
    return {f"values of {name}" if m.agg == "count" else f"{m.agg} of {name}": f"{m.agg}({quote(name)})"}


def _value(m: Metric, found: dict[str, object], needs: dict[str, str]) -> float | None:
    values = [found[n] for n in needs]
    if m.agg in ("size", "count"):  # no file has rows: null
        values = [v or 0 for v in values]
        return float(values[0] - sum(values[1:]))
    return None if values[0] is None else float(values[0]) + 0.0  # footers may hold -0.0 for 0.0


def footer_metrics(spark: SparkSession, source: str, named: list[NamedMetric], fmt: str = "parquet", schema=None,
                   **options) -> tuple[DataFrame, list[NamedMetric]]:
    """``(metrics, rest)``: the metrics of ``named`` that the footers at ``source`` answer (as
    ``compute_metrics``; a job over footers runs at once), and those left to compute from the data."""
    none = spark.createDataFrame([], METRICS_SCHEMA)
    if fmt not in FORMATS:
        return none, list(named)
    with pushing(spark, fmt):
        reader = spark.read.format(fmt).options(**options)
        df = (reader.schema(schema) if schema else reader).load(source)
        held = _partition_columns(df, source)
        names = [f.name for f in df.schema.fields]
        fields = {f.name: f.dataType for f in df.schema.fields if f.name not in held and names.count(f.name) == 1}
        asked = [(nm, needs) for nm in named if (needs := footer_aggregate(nm.metric, fields))]
        wanted = reduce(lambda a, b: a | b, (needs for _, needs in asked), {})
        found: dict[str, object] = {}

        def ask(some: list[tuple[str, str]]) -> None:
            one = df.selectExpr(*[f"{sql} AS v{i}" for i, (_, sql) in enumerate(some)])
            if not pushed(one):
                return
            try:
                with job_label(spark, f"assay: {len(some)} aggregates out of the footers of {source}"):
                    found.update(zip([n for n, _ in some], one.first()))
            except (PySparkException, Py4JJavaError) as exc:
                if "aggregatePushdown" not in str(exc):
                    raise
                if len(some) > 1:  # a file without the statistics of some column: halve until it stands alone
                    ask(some[:len(some) // 2])
                    ask(some[len(some) // 2:])

        every = list(wanted.items())
        for a in range(0, len(every), DEFAULT_MAX_METRICS_PER_PASS):
            ask(every[a:a + DEFAULT_MAX_METRICS_PER_PASS])
    rows = [(nm.name, nm.column, nm.key, _value(nm.metric, found, needs), None) for nm, needs in asked if needs.keys() <= found.keys()]
    answered = {r[2] for r in rows}
    return (spark.createDataFrame(rows, METRICS_SCHEMA) if rows else none), [nm for nm in named if nm.key not in answered]


def pushed(df: DataFrame) -> bool:
    """Whether the plan takes its aggregates from footers."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "PushedAggregation: [" in plan and "PushedAggregation: []" not in plan


def table_metrics(spark: SparkSession, source: str, named: list[NamedMetric], fmt: str = "parquet",
                  max_metrics_per_pass: int = DEFAULT_MAX_METRICS_PER_PASS, compute=compute_metrics, schema=None, **options) -> DataFrame:
    """``compute_metrics`` over the files at ``source``, footers first."""
    found, rest = footer_metrics(spark, source, named, fmt, schema, **options)
    if not rest:
        return found
    reader = spark.read.format(fmt).options(**options)
    df = (reader.schema(schema) if schema else reader).load(source)
    return found.unionByName(compute(df, rest, max_metrics_per_pass))
