"""Mergeable states of scan metrics.

The state of a metric over some rows is one row: the number of values, the
least and greatest, the exact sums (limbs of doubles, see
:mod:`assay.functions.exact`; decimals for whole numbers and decimals) and
the exact sums of squares around a fixed pivot.  States of disjoint rows
merge by adding, and the values that come out of merged states are bit for
bit those of a state over all rows at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.functions.exact import LIMBS, limb_sums, total
from assay.operators.metrics import DEFAULT_MAX_METRICS_PER_PASS, Metric, _build_or_error, scan_sql, sql_literal, union_all

MERGEABLE = ("size", "count", "min", "max", "sum", "avg", "stddev_pop")

#: One row per folder (or batch) and metric.  ``total`` is the sum of whole numbers, and of decimals in units
#: of their last of ``scale`` places; ``text`` the least or greatest value of a text column, which compares as text.
STATE_SCHEMA = ("batch string, metric string, n bigint, low double, high double, text string, total decimal(38,0), scale int, "
                "limbs array<bigint>, far double, n_far bigint, pivot double, squares array<bigint>, far_squares double, error string")
_STATE_TYPES = {c.split()[0]: c.split()[1] for c in STATE_SCHEMA.split(", ")}


def metric_key(m: Metric) -> str:
    """Names a definition: equal definitions share their state."""
    return m.agg + (f"({', '.join(m.target)})" if m.target else "") + (f" WHERE {m.where}" if m.where else "")


def target_sql(m: Metric) -> str:
    return f"CASE WHEN ({m.where}) THEN ({m.target[0]}) END" if m.where else f"({m.target[0]})"


def _array(parts: list[str]) -> str:
    return f"array({', '.join(parts)})"


def state_sql(m: Metric, dtype: T.DataType | None, pivot: float | None) -> dict[str, str]:
    """State column -> aggregate, for a mergeable metric whose target has the type ``dtype``."""
    if m.agg == "size":
        return {"n": scan_sql(m)}
    e = target_sql(m)
    out = {"n": f"count({e})"}
    if m.agg in ("min", "max"):
        if isinstance(dtype, T.StringType):
            return out | {"text": f"{m.agg}({e})"}
        return out | {"low" if m.agg == "min" else "high": f"try_cast({m.agg}({e}) AS DOUBLE)"}
    if m.agg in ("sum", "avg") and isinstance(dtype, T.IntegralType):
        return out | {"total": f"sum(CAST({e} AS DECIMAL(38, 0)))", "scale": "0"}
    if m.agg in ("sum", "avg") and isinstance(dtype, T.DecimalType) and dtype.precision + dtype.scale < 38:
        unit = f"CAST('1{'0' * dtype.scale}' AS DECIMAL({dtype.scale + 1}, 0))"
        return out | {"total": f"sum(CAST({e} * {unit} AS DECIMAL(38, 0)))", "scale": str(dtype.scale)}
    if m.agg in ("sum", "avg"):
        *limbs, far, n_far = limb_sums(f"CAST({e} AS DOUBLE)")
        return out | {"limbs": _array(limbs), "far": far, "n_far": n_far}
    if m.agg == "stddev_pop":
        away = f"(CAST({e} AS DOUBLE) - {float(pivot or 0.0)!r}D)"
        *limbs, far, n_far = limb_sums(away)
        *squares, far_squares, _ = limb_sums(f"({away} * {away})")
        return out | {"limbs": _array(limbs), "far": far, "n_far": n_far, "pivot": f"{float(pivot or 0.0)!r}D", "squares": _array(squares),
                      "far_squares": far_squares}
    return out


def _columns(m: Metric) -> int:
    return {"size": 1, "count": 1, "min": 2, "max": 2, "stddev_pop": 2 * LIMBS + 4}.get(m.agg, LIMBS + 3)


def _state_rows(chunk: list[tuple[Metric, dict[str, str]]], keyed: bool) -> str:
    rows = []
    for i, (m, sql) in enumerate(chunk):
        cells = ["'batch', _batch" if keyed else "'batch', CAST(NULL AS STRING)", f"'metric', {sql_literal(metric_key(m))}"]
        cells += [f"'{c}', " + (f"CAST(_s{i}_{c} AS {t})" if c in sql else f"CAST(NULL AS {t})")
                  for c, t in _STATE_TYPES.items() if c not in ("batch", "metric")]
        rows.append(f"named_struct({', '.join(cells)})")
    return f"inline(array({', '.join(rows)}))"


def scan_states(df: DataFrame, metrics: list[Metric], pivots: dict[str, float], per_batch: bool,
                max_per_pass: int = DEFAULT_MAX_METRICS_PER_PASS) -> DataFrame:
    """States of ``metrics`` over ``df`` (``STATE_SCHEMA``): per value of ``_batch``, or over all rows (one
    row per metric even without rows, ``batch`` null).  A metric that does not analyse or cannot be merged
    has its reason in ``error``."""
    spark = df.sparkSession
    ready, failed = [], []
    for m in metrics:
        if m.agg not in MERGEABLE:
            failed.append((m, "its value over new rows cannot be merged with an earlier one"
                           if m.kind != "failed" else " ".join(m.target)))
            continue

        def build(m=m):
            dtype = df.selectExpr(f"{target_sql(m)} AS v").schema[0].dataType if m.target else None
            sql = state_sql(m, dtype, pivots.get(metric_key(m)))
            df.selectExpr(*[f"{v} AS {c}" for c, v in sql.items()])
            return sql

        sql, error = _build_or_error(build)
        failed.append((m, error)) if error else ready.append((m, sql))

    pieces, chunk, width = [], [], 0

    def flush():
        if chunk:
            named = [f"{v} AS _s{i}_{c}" for i, (_, sql) in enumerate(chunk) for c, v in sql.items()]
            wide = df.groupBy("_batch").agg(*map(F.expr, named)) if per_batch else df.selectExpr(*named)
            pieces.append(wide.selectExpr(_state_rows(chunk, per_batch)))

    for m, sql in ready:
        if chunk and width + _columns(m) > max_per_pass:
            flush()
            chunk, width = [], 0
        chunk.append((m, sql))
        width += _columns(m)
    flush()
    if failed:
        pieces.append(spark.createDataFrame([(metric_key(m), e) for m, e in failed], "metric string, error string").selectExpr(
            *[(c if c in ("metric", "error") else f"CAST(NULL AS {t}) AS {c}") for c, t in _STATE_TYPES.items()]))
    return union_all(pieces) if pieces else spark.createDataFrame([], STATE_SCHEMA)


def merged(states: DataFrame) -> DataFrame:
    """One state row per metric (limbs and totals as decimals) out of rows of disjoint batches."""
    added = lambda c: F.expr(_array([f"sum(CAST({c}[{i}] AS DECIMAL(38, 0)))" for i in range(LIMBS)]))
    return states.groupBy("metric").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("text").alias("low_text"),
        F.max("text").alias("high_text"), F.sum("total").alias("total"), F.max("scale").alias("scale"), added("limbs").alias("limbs"),
        F.sum("far").alias("far"), F.max("pivot").alias("pivot"), added("squares").alias("squares"),
        F.sum("far_squares").alias("far_squares"), F.max("error").alias("error"))


def value_of(m: Metric) -> str:
    """The metric's value (double) out of its merged state row."""
    sums = total([f"limbs[{i}]" for i in range(LIMBS)], "far")
    some = lambda v: f"CASE WHEN n > 0 THEN {v} END"
    if m.agg in ("size", "count"):
        return "CAST(n AS DOUBLE)"
    if m.agg == "min":
        return "coalesce(low, try_cast(low_text AS DOUBLE))"
    if m.agg == "max":
        return "coalesce(high, try_cast(high_text AS DOUBLE))"
    whole = "CAST(total AS DOUBLE) / power(10D, scale)"
    if m.agg == "sum":
        return some(f"CASE WHEN total IS NOT NULL THEN {whole} ELSE {sums} END")
    if m.agg == "avg":
        return some(f"(CASE WHEN total IS NOT NULL THEN {whole} ELSE {sums} END) / n")
    squares = total([f"squares[{i}]" for i in range(LIMBS)], "far_squares")
    return some(f"sqrt(greatest(0D, {squares} / n - ({sums} / n) * ({sums} / n)))")
