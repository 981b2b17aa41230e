"""Metric definitions and the fused metric engine.

A :class:`Metric` says *what* to aggregate; :func:`compute_metrics` decides *how*:

* **scan metrics** (row counts, filtered counts, min/max/sum/avg/stddev, any
  user aggregate) become columns of one ``df.agg(...)``: one pass over the
  data, map-side partial aggregation, a single-row result.  Equal definitions
  are computed once and fanned back out to every name that asked for them.
* **frequency metrics** (distinct values, distinct rows, duplicate groups)
  need a group-by.  All frequency metrics over the same key list and filter
  share one ``groupBy(keys).count()``; each key set is reduced to one row of
  counters.  A hot key costs nothing extra: partial aggregation folds it to
  one row per map task before the shuffle.
* **schema metrics** (duplicate column names) are read from ``df.schema``.

Everything is unioned into one long table ``(metric, column, key, value,
error)`` -- still a lazy DataFrame, computed by a single action.  A
definition Spark cannot analyse (unknown column, bad type) does not abort the
run: it is found at plan time, without a job, and reported in ``error``.
"""

from __future__ import annotations

import logging
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import (
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    PythonException,
    SparkRuntimeException,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from assay.session import job_label

# Aggregates computed in the shared single pass.
SCAN_AGGS = ("size", "count", "min", "max", "sum", "avg", "stddev_pop", "aggregate")
# Aggregates over a frequency table (one group-by per key set and filter).
FREQUENCY_AGGS = (
    "distinct",                      # groups, rows whose keys are all null dropped; 0 when none
    "distinctness",                  # same count, but null when there is no group
    "distinct_keep_nulls",           # groups, the all-null group counted
    "duplicate_groups",              # groups with more than one row, all-null group excluded
    "duplicate_groups_keep_nulls",   # groups with more than one row, all-null group included
)
SCHEMA_AGGS = ("duplicate_columns",)
# A definition that could not be built: ``target`` holds the reason, which becomes its ``error``.
FAILED_AGG = "failed"

# Spark compiles a whole stage only while its rows stay under
# ``spark.sql.codegen.maxFields`` (100) fields; a pass keeps its aggregate
# buffers below that so every pass runs compiled code.
DEFAULT_MAX_METRICS_PER_PASS = 64

# Run-time errors that a definition's own expression raises on the data.
DATA_ERRORS = (ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, IllegalArgumentException,
               NumberFormatException, PythonException, SparkRuntimeException)

METRICS_SCHEMA = "metric string, column string, key string, value double, error string"


@dataclass(frozen=True)
class Metric:
    """One aggregate over a table.

    ``target`` is a tuple of Spark SQL expressions: the aggregated expression
    for scan aggregates, the grouping keys for frequency aggregates, or a full
    aggregate expression for ``agg="aggregate"`` (e.g. ``"max(length(text))"``).
    ``where`` is an optional SQL filter applied before aggregating.
    """

    agg: str
    target: tuple[str, ...] = ()
    where: str | None = None

    def __post_init__(self):
        if self.agg not in (*SCAN_AGGS, *FREQUENCY_AGGS, *SCHEMA_AGGS, FAILED_AGG):
            raise ValueError(f"unknown aggregate {self.agg!r}")
        if isinstance(self.target, str):
            object.__setattr__(self, "target", (self.target,))

    @property
    def kind(self) -> str:
        if self.agg in SCAN_AGGS:
            return "scan"
        if self.agg in FREQUENCY_AGGS:
            return "frequency"
        return "failed" if self.agg == FAILED_AGG else "schema"


@dataclass(frozen=True)
class NamedMetric:
    """A metric as reported: its name, the column label it describes, the key
    that metric expressions use to refer to it, and its definition."""

    name: str
    column: str
    key: str
    metric: Metric


def scan_sql(m: Metric) -> str:
    """Spark SQL text of a scan metric's aggregate, its filter folded into the aggregate."""
    if m.agg == "size":
        return f"count_if(({m.where}))" if m.where else "count(1)"
    if m.agg == "aggregate":
        if m.where:
            raise ValueError("an 'aggregate' metric carries its own filter; 'where' is not allowed")
        return m.target[0]
    e = m.target[0]
    if m.where:
        e = f"CASE WHEN ({m.where}) THEN ({e}) END"
    return f"{m.agg}({e})"  # count, min, max, sum, avg, stddev_pop are Spark SQL aggregates


def scan_column(m: Metric) -> Column:
    """The aggregate Column for a scan metric."""
    return F.expr(scan_sql(m))


def value_sql(text: str) -> str:
    return f"try_cast(({text}) AS DOUBLE)"


def sql_literal(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _error_text(exc: Exception) -> str:
    text = getattr(exc, "getMessage", lambda: str(exc))()
    return str(text).strip() or type(exc).__name__


# PySpark logs every analysis error it raises; probing for them is expected here.
_QUERY_CONTEXT_LOGGERS = ("DataFrameQueryContextLogger", "SQLQueryContextLogger")


@contextmanager
def _quiet_analysis_errors():
    # Fetch them as PySpark does, so PySpark later finds loggers of its own class.
    from pyspark.logger import PySparkLogger

    loggers = [PySparkLogger.getLogger(n) for n in _QUERY_CONTEXT_LOGGERS]
    levels = [lg.level for lg in loggers]
    for lg in loggers:
        lg.setLevel(logging.CRITICAL)
    try:
        yield
    finally:
        for lg, lvl in zip(loggers, levels):
            lg.setLevel(lvl)


def _analysable(build) -> str | None:
    """Run Spark's analyzer on ``build()``; return the error text or None. No job runs."""
    with _quiet_analysis_errors():
        try:
            build().schema
            return None
        except (AnalysisException, ValueError, TypeError) as exc:  # noqa: PERF203
            return _error_text(exc)
        except Exception as exc:  # Spark Connect / py4j wrappers
            return _error_text(exc)


def _row_sql(nm: NamedMetric, value: str, error: str | None = None) -> str:
    return (f"named_struct('metric', {sql_literal(nm.name)}, 'column', {sql_literal(nm.column)}, "
            f"'key', {sql_literal(nm.key)}, 'value', {value}, 'error', {sql_literal(error)})")


def _explode_rows(df: DataFrame, rows: list[str]) -> DataFrame:
    """One output row per struct, from a one-row frame (a single JVM call)."""
    return df.selectExpr(f"inline(array({', '.join(rows)}))")


def _unique(seq):
    return list(dict.fromkeys(seq))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union many frames of one schema as a balanced tree.

    A left-deep chain re-checks the whole growing plan at every step
    (quadratic in the number of pieces); a balanced tree keeps plan building
    near-linear for reports with thousands of pieces.
    """
    while len(frames) > 1:
        frames = [frames[i].union(frames[i + 1]) if i + 1 < len(frames) else frames[i]
                  for i in range(0, len(frames), 2)]
    return frames[0]


def _frequency_counters(df: DataFrame, keys: tuple[str, ...], where: str | None) -> DataFrame:
    """One row of counters over the frequency table ``groupBy(keys).count()``.

    The group-by is written exactly as ``SELECT keys, count(*) FROM t GROUP BY
    keys``: Spark then reuses its shuffle for any other part of the same plan
    that groups the same table by the same keys.
    """
    src = df.where(where) if where else df
    aliases = [f"_k{i}" for i in range(len(keys))]
    freq = (src.groupBy(*[F.expr(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
               .toDF(*aliases, "_n"))
    keep = "NOT (" + " AND ".join(f"{a} IS NULL" for a in aliases) + ")"
    # Every counter reads the group count (``_n > 0`` holds for every group), so
    # the optimizer never prunes it and the group-by keeps one canonical shape.
    return freq.selectExpr(
        f"count_if(_n > 0 AND {keep}) AS distinct",
        f"sum(CASE WHEN _n > 0 AND {keep} THEN 1 END) AS distinctness",
        "count_if(_n > 0) AS distinct_keep_nulls",
        f"count_if(_n > 1 AND {keep}) AS duplicate_groups",
        "count_if(_n > 1) AS duplicate_groups_keep_nulls",
    )


def _hashable(dtype: T.DataType) -> bool:
    """Whether equal values of the type hash equally (collated text and maps may not)."""
    if isinstance(dtype, T.StringType):
        return dtype.simpleString() == "string"
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.AtomicType) and not isinstance(dtype, getattr(T, "VariantType", ()))


def _row_hashes(parts: str) -> tuple[str, str]:
    """Two hashes of the key values."""
    return f"xxhash64({parts})", f"xxhash64('second', {parts})"


#: Groups joined by broadcast in the second phase of :func:`_row_counters`: the largest so many.
HOT_GROUPS = 10_000


def _row_counters(df: DataFrame, keys: tuple[str, ...], where: str | None) -> DataFrame:
    """The five counters of :func:`_frequency_counters` for several keys (whole rows), exactly,
    without shuffling the rows.

    Phase 1 shuffles two hashes per row and counts each hash group.  A group of one row is one distinct
    row, since equal rows hash equally.  Phase 2 takes
    the rows of the larger groups (true duplicates or, rarely, collisions) and groups only those by
    their full values.  Rows of the ``HOT_GROUPS`` largest groups are picked out by a broadcast of that
    many hashes, and meet only after partial aggregation; the other groups are small, and their rows
    come together by a shuffle on the hashes.

    Keys with types that have no such hash (maps, collated text) are grouped by their values.
    """
    src = (df.where(where) if where else df).selectExpr(*[f"{k} AS _k{i}" for i, k in enumerate(keys)])
    names = [f"_k{i}" for i in range(len(keys))]
    if not all(_hashable(f.dataType) for f in src.schema.fields):
        return _frequency_counters(src, tuple(names), None)
    all_null = " AND ".join(f"{n} IS NULL" for n in names)
    h1, h2 = _row_hashes(", ".join(names))
    hashed = src.selectExpr("*", f"{h1} AS _h1", f"{h2} AS _h2")
    census = (hashed.selectExpr("_h1", "_h2", f"{all_null} AS _null").groupBy("_h1", "_h2")
              .agg(F.count(F.lit(1)).alias("_n"), F.max("_null").alias("_null")))
    singles = census.where("_n = 1").selectExpr("count_if(NOT _null) AS distinct", "count(1) AS distinct_keep_nulls",
                                                "0L AS duplicate_groups", "0L AS duplicate_groups_keep_nulls")
    groups = census.where("_n > 1 AND _null IS NOT NULL")  # reads every column, so the census is shuffled once
    hot = F.broadcast(groups.orderBy(F.desc("_n"), "_h1", "_h2").limit(HOT_GROUPS).select("_h1", "_h2"))
    on = ["_h1", "_h2"]
    cold = hashed.join(hot, on, "left_anti").join(groups.select(*on), on, "left_semi")
    shared = hashed.join(hot, on, "left_semi").unionByName(cold)
    counters = ["distinct", "distinct_keep_nulls", "duplicate_groups", "duplicate_groups_keep_nulls"]
    exact = _frequency_counters(shared, tuple(names), None).select(*counters)
    total = singles.unionByName(exact).selectExpr(*[f"coalesce(sum({c}), 0L) AS {c}" for c in counters])
    return total.selectExpr("distinct", "CASE WHEN distinct > 0 THEN distinct END AS distinctness", *counters[1:])


def _build_or_error(build):
    """``(frame, None)`` or ``(None, error text)``: Spark analyses eagerly, no job runs."""
    with _quiet_analysis_errors():
        try:
            return build(), None
        except Exception as exc:  # AnalysisException, ParseException, py4j wrappers
            return None, _error_text(exc)


def compute_metrics(
    df: DataFrame,
    named: list[NamedMetric],
    max_metrics_per_pass: int = DEFAULT_MAX_METRICS_PER_PASS,
) -> DataFrame:
    """Long metrics table for ``named`` over ``df`` (lazy; one action computes all).

    Output columns: ``metric, column, key, value DOUBLE, error STRING``.
    """
    from assay.operators.schema import duplicate_column_names

    spark = df.sparkSession
    if not named:
        return spark.createDataFrame([], METRICS_SCHEMA)
    keys = [nm.key for nm in named]
    if len(set(keys)) != len(keys):
        dupes = sorted({k for k in keys if keys.count(k) > 1})
        raise ValueError(f"metric keys must be unique; repeated: {dupes}")

    by_metric: dict[Metric, list[NamedMetric]] = {}
    for nm in named:
        by_metric.setdefault(nm.metric, []).append(nm)

    errors: dict[Metric, str] = {}
    pieces: list[DataFrame] = []

    # Scan metrics: chunks of one fused aggregate each (usually a single chunk).
    def scan_chunk(chunk):
        return df.selectExpr(*[f"{value_sql(scan_sql(m))} AS _m{i}" for i, m in enumerate(chunk)])

    # Passes take metrics column by column, so each pass reads its own columns and
    # splitting a wide report into passes does not read any column twice.
    scan_specs = sorted((m for m in by_metric if m.kind == "scan"), key=lambda m: by_metric[m][0].column)
    step = max(1, int(max_metrics_per_pass))
    for start in range(0, len(scan_specs), step):
        chunk = scan_specs[start:start + step]
        wide, err = _build_or_error(lambda c=chunk: scan_chunk(c))
        if err is not None:  # isolate the definitions Spark cannot analyse
            for m in chunk:
                bad = _build_or_error(lambda m=m: scan_chunk([m]))[1]
                if bad is not None:
                    errors[m] = bad
            chunk = [m for m in chunk if m not in errors]
            if not chunk:
                continue
            wide = scan_chunk(chunk)
        rows = [_row_sql(nm, f"_m{i}") for i, m in enumerate(chunk) for nm in by_metric[m]]
        pieces.append(_explode_rows(wide, rows))

    # Frequency metrics: one group-by per (keys, filter), shared by all metrics on it, at every width.
    members_of: dict[tuple, list[Metric]] = {}
    for m in by_metric:
        if m.kind == "frequency":
            members_of.setdefault((m.target, m.where), []).append(m)
    for (keys_, where), members in members_of.items():
        counters, err = (None, "no grouping keys") if not keys_ else _build_or_error(
            lambda k=keys_, w=where: (_frequency_counters if len(k) == 1 else _row_counters)(df, k, w))
        if err is not None:
            for m in members:
                errors[m] = err
            continue
        rows = [_row_sql(nm, f"CAST({m.agg} AS DOUBLE)") for m in members for nm in by_metric[m]]
        pieces.append(_explode_rows(counters, rows))

    # Literal rows (schema metrics, analysis failures) ride on a one-row carrier.
    errors |= {m: " ".join(m.target) for m in by_metric if m.kind == "failed"}
    literal_rows = []
    for m, nms in by_metric.items():
        if m in errors:
            literal_rows += [_row_sql(nm, "CAST(NULL AS DOUBLE)", errors[m]) for nm in nms]
        elif m.kind == "schema":
            value = float(duplicate_column_names(df))
            literal_rows += [_row_sql(nm, f"CAST({value!r} AS DOUBLE)") for nm in nms]
    if literal_rows:
        pieces.append(_explode_rows(spark.range(1), literal_rows))

    return union_all(pieces)


def compute_metrics_isolated(
    df: DataFrame,
    named: list[NamedMetric],
    max_metrics_per_pass: int = DEFAULT_MAX_METRICS_PER_PASS,
) -> DataFrame:
    """Eager :func:`compute_metrics` that also survives *run-time* metric errors.

    Analysis errors are isolated by :func:`compute_metrics` without a job.  A
    definition that analyses but fails while running (e.g. an ANSI cast of
    bad text inside a user aggregate) would abort the whole fused pass; here
    the pass is retried on halves of the metric list until every failing
    definition stands alone and is reported in ``error``.  Only errors of the
    data are retried (``DATA_ERRORS``); lost executors, lack of memory and
    cancelled jobs are raised.  Only metric values (one row per metric,
    independent of the data size) reach the driver.
    """
    spark = df.sparkSession

    def attempt(group: list[NamedMetric]) -> list[tuple]:
        try:
            with job_label(spark, f"assay: {len(group)} metrics"):
                rows = compute_metrics(df, group, max_metrics_per_pass).collect()
            return [tuple(r) for r in rows]
        except DATA_ERRORS as exc:  # a run-time failure inside the fused pass
            if len(group) == 1:
                nm = group[0]
                return [(nm.name, nm.column, nm.key, None, _error_text(exc))]
            # Equal definitions fail together; split on distinct definitions.
            specs = _unique(nm.metric for nm in group)
            if len(specs) == 1:
                return [(nm.name, nm.column, nm.key, None, _error_text(exc)) for nm in group]
            half = set(specs[: len(specs) // 2])
            left = [nm for nm in group if nm.metric in half]
            right = [nm for nm in group if nm.metric not in half]
            return attempt(left) + attempt(right)

    rows = attempt(list(named)) if named else []
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def wide_metrics(metrics: DataFrame, keys: list[str]) -> DataFrame:
    """Pivot the long metrics table into one row with a column per metric key."""
    keys = _unique(keys)
    if not keys:
        return metrics.sparkSession.range(1).select()
    return metrics.groupBy().pivot("key", keys).agg(F.first("value"))
